"""The form of a surrogate: digits stay digits, a script stays that script, prose stays prose."""

from __future__ import annotations

import re
import unicodedata

from bedside.llm import pii

NUMBERS = [f"{100 + i}-{10 + i % 80}-{5000 + 7 * i}" for i in range(200)]
SECRETS = [f"password={10**9 + 77 * i}" for i in range(50)]
SCRIPTS = {
    "Mr 王小明 left.": "CJK", "Mr محمد علي": "ARABIC", "Dr. משה כהן": "HEBREW", "Mrs अनीता": "DEVANAGARI", "Mr Ивано": "CYRILLIC", "Mr 김민수": "HANGUL",
    "Ms สมหญิง": "THAI",
}
LETTERS = pii.ALPHABETS["[\\u05D0-\\u05EA]"][:12]
PEOPLE = [f"Prof. {a}{b}" for a in LETTERS for b in LETTERS]
CLEAN = [
    "token: economy", "secret = sauce", "The secret: everyone knows.", "password: required", "Password: well-known words", "a token : of thanks",
    "secret: élégance", "the secret: don't tell",
]
GIVEN = {'password: "letmein"': "letmein", "password=letmein": "letmein", "token: k3jf93kf": "k3jf93kf", "secret: openSesame": "openSesame", "pwd: let$mein": "let$mein"}
HEXADECIMAL = 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"'


def test_forms(spark):
    texts = [f"His number is {n}." for n in NUMBERS] + SECRETS + list(SCRIPTS) + PEOPLE + CLEAN + list(GIVEN) + [HEXADECIMAL]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = iter(sorted(pii.surrogates(rows, "k").collect(), key=lambda r: r["doc_id"]))
    # digits stay digits, and all numbers stay apart
    numbers = [next(found) for _ in NUMBERS]
    new = [re.fullmatch(r"His number is (\d{3}-\d{2}-\d{4})\.", r["text"])[1] for r in numbers]
    assert {r["entities"][0]["kind"] for r in numbers} == {"ssn"} and len(set(new)) == len(new) and not set(new) & set(NUMBERS)
    assert all(re.fullmatch(r"password=\d{10}", next(found)["text"]) for _ in SECRETS)
    # a name stays in its script
    for text, script in SCRIPTS.items():
        r, (title, old) = next(found), text.split(" ", 1)
        changed = r["text"].split(" ", 1)[1]
        assert r["text"].startswith(title + " ") and changed != old and r["n_entities"] == 1
        letters = [c for c in changed.removesuffix("left.") if unicodedata.category(c)[0] == "L"]
        assert letters and all(unicodedata.name(c).startswith(script) for c in letters) and len(changed) == len(old), changed
    # names of few letters never share a surrogate, nor take that of a real person
    new = [next(found)["text"] for _ in PEOPLE]
    assert len(set(new)) == len(PEOPLE) and not set(new) & set(PEOPLE) and not any("*" in t for t in new)
    # prose stays, values go
    assert [(r["text"], r["n_entities"]) for r in (next(found) for _ in CLEAN)] == [(t, 0) for t in CLEAN]
    for secret in GIVEN.values():
        r = next(found)
        assert r["n_entities"] == 1 and secret not in r["text"]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', last := next(found)["text"]) and "0641917ea4" not in last
