"""The index of word pieces gives what trying every template gives."""

from __future__ import annotations

import random

from bedside.plans.log_search import matching_templates, search
from bedside.plans.template_index import candidates, save_index, template_index
from bedside.session import literal_table

SCHEMA = "id int, cipher string"
WORDS = ["alarm", "radio", "lead", "cuff", "on", "off", "low", "sensor", "größe", "温度計", "a.b"]


def found(df):
    return {(r.id, r.term, None if r.contents is None else tuple(r.contents)) for r in df.collect()}


def dictionary(spark):
    rng = random.Random(7)
    holders = ["([0-9]*)", "([a-z]*)", "([0-9.]*)"]
    rows = []
    for i in range(300):
        parts = [rng.choice(WORDS) + str(rng.randrange(40)) if rng.random() < 0.6 else rng.choice(holders) for _ in range(rng.randint(1, 5))]
        rows.append((i, " ".join(parts) + rng.choice(["$", "", " $"])))
    odd = ["", "(on|off) line", "colou?r of lead", "x", r"a\.b low", "[a-z]* free", ".* any", "^lead ([0-9]*)", None, "({3}", "ab", "lead12"]
    rows += [(300 + i, t) for i, t in enumerate(odd) if t != "({3}"]
    return spark.createDataFrame(rows, SCHEMA)


TERMS = ["lead12", "alarm3 77", "a.b low", "lead", "on", "cuff[0-9]", "温度計", "größe1", "ab", "radio5 ", "a1$", "xyz none", "colour of lead", ".", " ", "lead12"]


def test_same_templates_as_without(spark):
    templates = dictionary(spark)
    want = found(matching_templates(templates, TERMS))
    assert found(matching_templates(templates, TERMS, template_index(templates))) == want
    assert len({t for _, t, _ in want}) > 10


def test_a_term_meets_few_templates(spark, tmp_path):
    rows = [(i, f"device {i * 7919 % 100_003} took ([0-9]*) ms in step {chr(97 + i % 26)}$") for i in range(5000)]
    templates = spark.createDataFrame(rows, SCHEMA)
    save_index(template_index(templates), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    terms = [rows[4321][1].replace("([0-9]*)", "12").rstrip("$"), "device 7919 took"]
    pairs = candidates(index, templates, terms)
    assert pairs.count() <= 20  # of 10,000
    want = found(matching_templates(templates, terms))
    assert found(matching_templates(templates, terms, index)) == want and {i for i, _, _ in want} >= {4321, 1}
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides(spark):
    none = literal_table(spark, [(1, "radio on")], SCHEMA).where("id > 1")
    assert matching_templates(none, ["radio"], template_index(none)).count() == 0
    some = literal_table(spark, [(1, "radio on"), (2, None)], SCHEMA)
    assert matching_templates(some, "", template_index(some)).count() == 0
    assert found(matching_templates(some, "radio,", template_index(some))) == {(1, "radio", None)}


def test_search_takes_the_index(spark):
    templates = literal_table(spark, [(1, "radio on"), (2, "alarm ([a-z]*) cleared")], SCHEMA)
    logs = literal_table(
        spark, [(1, [], 0, 0), (2, ["low"], 0, 0), (2, ["high"], 0, 0)],
        "cipher_id int, message_content array<string>, log_level int, device_type int",
    ).selectExpr("*", "timestamp'2024-01-01' AS datetime_sent")
    names = literal_table(spark, [(0, "info")], "code int, cipher string")
    index = template_index(templates)
    out = search(logs, templates, names, names, message="alarm low cleared,radio", index=index).collect()
    assert sorted(r.message for r in out) == ["alarm low cleared", "radio on"]
    out = search(logs, templates, names, names, without="radio", index=index).collect()
    assert sorted(r.message for r in out) == ["alarm high cleared", "alarm low cleared"]


def test_one_pass_over_postings_on_all_cores(spark):
    templates = dictionary(spark).coalesce(1)
    index = template_index(templates)
    assert index.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    plan = candidates(index, templates, ["radio5 lead3", "cuff7"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
