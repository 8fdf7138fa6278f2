"""Byte-pair merging of many sequences at once, on ragged numpy arrays."""

from __future__ import annotations

import numpy as np


class PairMerges:
    """The merges of a vocabulary: (left, right) becomes ``made``, lower ranks first.

    One step looks up every pair that is new, takes each sequence's lowest rank and
    applies all sequences' winners together.  All places of the winning pair are
    merged in one step, except where ``careful`` says that the result may itself be
    more urgent than the places left, or where pairs share a rank: then only the
    leftmost place is.
    """

    def __init__(self, left: list[int], right: list[int], ranks: list[int], made: list[int], careful: list[bool]):
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        self.careful = np.array(careful, bool)[order]

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the pair that starts at each of ``at`` stands among the merges, -1 if nowhere."""
        after = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] << 32 | symbols[after]
        place = np.searchsorted(self.keys, pair)
        place[place == len(self.keys)] = 0
        place[(self.keys[place] != pair) | (owner[at] != owner[after]) | (after == at)] = -1
        return place

    def merge(self, symbols: np.ndarray, owner: np.ndarray, sequences: int) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols and the sequence each belongs to, in order.

        ``owner`` numbers the sequence of each symbol and does not fall.
        """
        finished = []
        place = self._pairs(symbols, owner, np.arange(len(symbols)))
        while True:
            # sequences without any pair left are finished
            busy = np.zeros(sequences, bool)
            busy[owner[place >= 0]] = True
            done = ~busy[owner]
            if done.any():
                finished.append((symbols[done], owner[done]))
                symbols, owner, place = symbols[~done], owner[~done], place[~done]
            if not len(symbols):
                break
            at = np.flatnonzero(place >= 0)
            which, whose = place[at], owner[at]
            ranks = self.ranks[which]
            # pairs are in order of their sequence: the lowest rank of each stretch
            starts = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            best = ranks == np.repeat(lowest, np.diff(np.r_[starts, len(at)]))
            at, which, whose = at[best], which[best], whose[best]
            first = np.r_[True, whose[1:] != whose[:-1]]
            # overlapping places of one pair (aaa): every second one of a run of neighbours
            run = first | np.r_[True, at[1:] != at[:-1] + 1]
            place_in_run = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            take = place_in_run % 2 == 0
            group = np.cumsum(first) - 1
            lone = self.careful[which] | (which != which[first][group])
            alone = np.bincount(group, lone, group[-1] + 1) > 0
            take &= first | ~alone[group]
            at, which = at[take], which[take]
            symbols[at] = self.made[which]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            now = np.cumsum(keep) - 1
            symbols, owner, place = symbols[keep], owner[keep], place[keep]
            # only pairs with a merged symbol have changed
            changed = now[at]
            changed = np.r_[changed, changed[changed > 0] - 1]
            place[changed] = self._pairs(symbols, owner, changed)
        if not finished:
            return symbols, owner
        symbols, owner = (np.concatenate(x) for x in zip(*finished))
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]
