"""Documents with unknown keys survive a merge."""

from __future__ import annotations

import json
import random

from bedside.sources import documents as doc

SCHEMA = "session bigint, block int, seq int, document string, extra string"


def folded(partials):
    """One document from the partials in order, as a plain loop."""
    out = {"ARRAYS": {}, "DEVICES": []}
    for text in partials:
        try:
            one = json.loads(text)
        except (TypeError, ValueError):
            continue
        for k, v in one.items():
            if k == "ARRAYS":
                out[k].update(v)
            elif k == "DEVICES":
                out[k] += [d for d in v if d not in out[k]]
            else:
                out[k] = v
    return out


def test_merge_equals_a_plain_loop(spark):
    rng = random.Random(3)
    rows = []
    for s in range(6):
        for b in range(3):
            for q in range(rng.randint(1, 12)):
                one = {"ARRAYS": {rng.choice("abc"): rng.choice([1, "x", None, {"deep": [1, 2]}])}, "DEVICES": rng.sample(range(9), 2)}
                for k in rng.sample(["t0", "T1", "new key", "ключ", "N"], 2):
                    one[k] = rng.choice([None, 1.5, "text", [1, {"a": 2}], {"p": {"q": "r"}}, True])
                rows.append((s, b, q, rng.choice([json.dumps(one)] * 8 + ["{broken", None, '{"a": 1, "a": 2}', "[1, 2]", "{}"]), "e"))
    want = {}
    for s, b, q, text, _ in rows:
        if text != '{"a": 1, "a": 2}' and text != "[1, 2]":
            want.setdefault((s, b), []).append((q, text))
        else:
            want.setdefault((s, b), [])
    partials = doc.parsed(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {}
    for r in doc.merged_documents(partials).selectExpr("session", "block", "to_json(document) AS d", "unread").collect():
        got[r.session, r.block] = (json.loads(r.d), r.unread)
    assert set(got) == set(want)
    for key, parts in want.items():
        expected = folded(t for _, t in sorted(parts, key=lambda p: p[0]))
        merged, unread = got[key]
        assert sorted(merged.pop("DEVICES")) == sorted(expected.pop("DEVICES"))
        assert merged == expected
        assert unread == sum((s, b) == key and t in (None, "{broken", '{"a": 1, "a": 2}') for s, b, _, t, _ in rows)


def test_merge_goes_on_from_a_merged_document(spark):
    first = [(1, 0, 0, '{"ARRAYS":{"a":1},"DEVICES":[10,9],"X":{"y":1}}', ""), (1, 0, 1, '{"DEVICES":[9,"b"]}', "")]
    before = doc.merged_documents(doc.parsed(spark.createDataFrame(first, SCHEMA))).selectExpr("session", "block", "-1 AS seq", "document")
    more = doc.parsed(spark.createDataFrame([(1, 0, 0, '{"ARRAYS":{"b":2},"X":null}', "")], SCHEMA)).drop("extra")
    out = doc.merged_documents(before.unionByName(more)).selectExpr("to_json(document) AS d").first().d
    assert out == '{"ARRAYS":{"a":1,"b":2},"DEVICES":[9,10,"b"],"X":null}'


def test_empty_and_wrong_kinds(spark):
    none = doc.parsed(spark.createDataFrame([], SCHEMA))
    assert doc.merged_documents(none).count() == 0 and doc.document_keys(none).count() == 0
    odd = doc.parsed(spark.createDataFrame([(1, 0, 0, '{"ARRAYS":[1],"DEVICES":{"a":1},"k":[]}', ""), (1, 0, 1, "7", "")], SCHEMA))
    r = doc.merged_documents(odd).selectExpr("to_json(document) AS d", "unread").first()
    assert (r.d, r.unread) == ('{"ARRAYS":{},"DEVICES":[],"k":[]}', 0)
    r = doc.merged_documents(odd, maps=(), sets=()).selectExpr("to_json(document) AS d").first()
    assert r.d == '{"ARRAYS":[1],"DEVICES":{"a":1},"k":[]}'


def test_keys_fields_and_lists(spark):
    rows = [(1, 0, 0, '{"n":1,"files":["meta-1","log-1",5],"blocks":[1,"x",null]}', ""), (1, 0, 1, '{"n":"a","blocks":3}', ""), (1, 0, 2, None, "")]
    df = doc.parsed(spark.createDataFrame(rows, SCHEMA))
    keys = {r.key: (r.documents, r.kind) for r in doc.document_keys(df, known=["files"]).collect()}
    assert keys["n"] == (2, "VARIANT") and set(keys) == {"n", "blocks"}
    assert [r[0] for r in df.select(doc.field("document", "$.n", "int")).collect()] == [1, None, None]
    assert [r.name for r in doc.listed_names(df).collect()] == ["meta-1"]
    assert [tuple(r) for r in doc.pending_in_documents(df.selectExpr("'F' AS status", "document")).collect()] == [("F", 3)]
