"""Readers, writers, annotations and packets."""

from __future__ import annotations

import datetime as dt
import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.functions import clock, codes, device, text
from bedside.sources import annotations as notes
from bedside.sources import packets as pk
from bedside.sources import sinks, tables
from bedside.sources.log_files import read_log_files
from bedside.sources.logs_text import parsed_lines, read_log_text
from bedside.sources.tables import page, page_after, select_readings


def readings(spark):
    rows = [
        (s, b, p, i, float(i), float(i * 10))
        for s in (1, 2) for b in (0, 1) for p in ("HR", "ECG", "TIME_SYNC") for i in range(3)
        if not (s == 2 and b == 1 and p == "TIME_SYNC")
    ]
    return spark.createDataFrame(rows, "session bigint, block int, param string, sn bigint, t double, value double")


def test_saved_readings_come_back_pruned(spark, tmp_path):
    path = str(tmp_path / "readings")
    tables.save_readings(readings(spark), path, buckets=4)
    many = tables.load_readings(spark, path, sessions=[1], params=["HR", "ECG"], buckets=4)
    # what is named comes, and always the time sync
    assert {r.param for r in many.select("param").collect()} == {"HR", "ECG", "TIME_SYNC"}
    # several blocks and nothing named: no waveforms
    rest = tables.load_readings(spark, path, sessions=[1], buckets=4)
    assert {r.param for r in rest.select("param").collect()} == {"HR", "TIME_SYNC"}
    one = tables.load_readings(spark, path, sessions=[1], blocks=[0], params=["ECG"], buckets=4)
    assert {r.param for r in one.select("param").collect()} == {"ECG", "TIME_SYNC"}
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "session_bucket" in plan.split("PartitionFilters")[1]


def test_blocks_without_sync_are_skipped(spark):
    out = tables.merge_blocks(readings(spark))
    assert out.where("session = 2 and block = 1").count() == 0
    assert out.count() == 27


def test_rerun_replaces_only_its_sessions(spark, tmp_path):
    path = str(tmp_path / "facts")

    def write(rows):
        df = spark.createDataFrame(rows, "session bigint, v int")
        sinks.replace_sessions(df, path, df.select("session").distinct(), buckets=2)

    write([(1, 10), (2, 20), (3, 30)])
    write([(2, 21), (2, 22)])
    write([(2, 21), (2, 22)])
    out = spark.read.parquet(path).orderBy("session", "v").collect()
    assert [(r.session, r.v) for r in out] == [(1, 10), (2, 21), (2, 22), (3, 30)]


def test_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "facts")
    for rows in ([("a", 1), ("b", 2)], [("b", 3)]):
        sinks.replace_partitions(spark.createDataFrame(rows, "site string, v int"), path, ["site"])
    assert sorted((r.site, r.v) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 3)]


def test_upsert_matches_null_keys(spark):
    old = spark.createDataFrame([("A", None, 1, 5.0), ("A", "ICU", 2, 6.0)], "site string, unit string, n int, x double")
    new = spark.createDataFrame([("A", None, 9), ("B", None, 8)], "site string, unit string, n int")
    out = sinks.upserted(old, new, ["site", "unit"], {"x": 0.0})
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("A", None, 9, 5.0), ("A", "ICU", 2, 6.0), ("B", None, 8, 0.0)], key=str
    )


def test_csv_has_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame([(1, ["a", "b"])], "n int, tags array<string>").coalesce(1), path)
    assert [r.value for r in spark.read.text(path).collect()] == ["n,tags", "1,a b"]


def test_gzip_logs(spark, tmp_path):
    lines = [
        "x deviceID=123456 y Date=03 Feb 2020 04:05:06\t one \ttwo",
        "x deviceID=654321 y Date=03 Feb 2020 04:05:06\tother",
        "x deviceID=123456 y Date=99 Feb 2020 04:05:06\tbad date",
        "no tab deviceID=123456 Date=03 Feb 2020 04:05:06",
    ]
    with gzip.open(tmp_path / "log.gz", "wt") as f:
        f.write("\n".join(lines))
    out = read_log_text(spark, str(tmp_path), device=123456).collect()
    assert [(r.device_id, r.at, r.fields) for r in out] == [
        (123456, dt.datetime(2020, 2, 3, 4, 5, 6), ["one", "two"])
    ]
    assert read_log_text(spark, str(tmp_path)).count() == 2


def test_log_files_push_device_and_date(spark, tmp_path, capfd):
    lines = [
        "deviceID=123456 x Date=03 Feb 2020 04:05:06\t one \ttwo",
        "deviceID=123456 x Date=31 Feb 2020 04:05:06\tno such day",
        "deviceID=123457 Date=04 Feb 2020 00:00:00\t\u00a0kept\u00a0\t\t",
        "deviceID=12345 Date=04 Feb 2020 00:00:00\tshort id",
        "no head\tx", "", "deviceID=123458 Date=05 Foo 2020 00:00:00\tmonth", "deviceID=123458 Date=05 Mar 2020 23:59:59",
    ]
    with gzip.open(tmp_path / "a.gz", "wt", encoding="utf-8") as f:
        f.write("\n".join(lines))
    with gzip.open(tmp_path / "a.gz", "at", encoding="utf-8") as f:  # a second member
        f.write("\ndeviceID=123460 Date=06 Feb 2020 00:00:00\tsecond\r\n")
    (tmp_path / "b.txt").write_text("\n".join(f"deviceID={200000 + i} Date=01 Jan 2021 00:00:00\t{i}" for i in range(9000)))
    (tmp_path / "_SUCCESS").write_text(lines[0])
    (tmp_path / "empty.txt").write_text("")
    files, text = read_log_files(spark, str(tmp_path)), read_log_text(spark, str(tmp_path))
    columns = ["device_id", "at", "fields"]
    both = lambda cond: [sorted(map(str, df.where(cond).select(columns).collect())) for df in (files, text)]
    got, want = both("true")
    assert got == want and len(got) == 9003
    for condition in (
        "device_id = 123456", "device_id IN (123457, 123460)", "at > timestamp'2020-02-03 04:05:06' AND device_id < 200000",
        "at <= timestamp'2020-02-04 00:00:00'", "device_id > 200004 AND at = timestamp'2021-01-01 00:00:00' AND size(fields) = 1",
        "device_id <> 123456 AND device_id <= 123460", "device_id IS NULL",
    ):
        got, want = both(condition)
        assert got == want, condition
    capfd.readouterr()
    files.where("device_id = 123456 AND at >= timestamp'2020-02-03 04:05:06' AND size(fields) = 2").explain("formatted")
    plan = capfd.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(device_id,123456)" in pushed and "GreaterThanOrEqual(at,2020-02-03 04:05:06" in pushed
    conditions = [line for line in plan.splitlines() if line.startswith("Condition")]
    assert len(conditions) == 1 and "size(fields" in conditions[0] and "device_id" not in conditions[0]
    assert files.rdd.getNumPartitions() == 3
    assert read_log_files(spark, str(tmp_path / "b.txt")).count() == 9000


def test_a_head_of_another_format(spark, tmp_path):
    (tmp_path / "x.log").write_text("unit 77 on 01 Dec 2022 10:00:00\ta\tb\nunit x\ta")
    pattern = r"unit ([0-9]+) on ([0-9]{2} [A-Z][a-z]{2} [0-9]{4} [0-9:]{8})"
    rows = read_log_files(spark, str(tmp_path), pattern).drop("file").collect()
    assert [tuple(r) for r in rows] == [(77, dt.datetime(2022, 12, 1, 10), ["a", "b"])]
    lines = spark.read.text(str(tmp_path))
    assert parsed_lines(lines, head_pattern=pattern).collect() == rows


def chunks_by_hand(rows, limit):
    """rows: (seq, sn, tm, segment, size) of one stream, cut packet by packet."""
    out, number, last, now = [], 0, None, None
    for _, sn, tm, segment, size in rows:
        if sn is not None and segment is not None:
            if last is not None and last != segment:
                if now:
                    out.append((number, last, now))
                number, now = number + 1, None
            last = segment
        now = now or [0, [], []]
        now[0] += size
        now[1] += [tm] if tm is not None else []
        now[2] += [sn] if sn is not None else []
        if now[0] >= limit:
            out.append((number, last, now))
            number, now = number + 1, None
    if now:
        out.append((number, last, now))
    return [
        (n, seg, w[0], min(w[1]), max(w[1]), min(w[2], default=None), max(w[2], default=None)) for n, seg, w in out
    ]


@pytest.mark.parametrize("slice_rows", [1_000_000, 7])
def test_chunks_match_packet_by_packet(either, slice_rows):
    rng = random.Random(slice_rows)
    rows, want = [], {}
    for session in (1, 2, 3):
        stream, segment = [], 0
        for seq in range(150):
            segment += rng.random() < 0.05
            known = rng.random() > 0.1 or seq == 0
            stream.append((seq, seq * 3 if known else None, 1000 + seq, segment if known else None, rng.randint(1, 40)))
        want[session] = chunks_by_hand(stream, 100)
        rows += [(session, *r) for r in stream]
    df = either.createDataFrame(rows, "session bigint, seq bigint, sn bigint, tm bigint, segment bigint, size bigint")
    out = pk.chunk_manifest(df, limit=100, slice_rows=slice_rows).collect()
    for session, chunks in want.items():
        got = sorted(
            (r.num, r.segment, r.size, r.min_ts, r.max_ts, r.min_sn, r.max_sn) for r in out if r.session == session
        )
        assert got == chunks


def test_composed_steps_equal_the_whole():
    """Any grouping of slices gives the step function of their concatenation."""
    rng = np.random.default_rng(8)
    for trial in range(60):
        limit = int(rng.integers(5, 60))
        parts = [rng.integers(0, [4, 25, 2 * limit][trial % 3], int(rng.integers(1, 9))) for _ in range(5)]
        steps = [pk._transfer(np.cumsum(p), limit) for p in parts]
        left = steps[0]
        for s in steps[1:]:
            left = pk._composed(left, s)
        right = pk._composed(pk._composed(steps[0], steps[1]), pk._composed(pk._composed(steps[2], steps[3]), steps[4]))
        for carried in range(limit):
            _, open_, closed = pk._cuts(np.concatenate(parts), carried, limit)
            for inherit, rest, count in (left, right):
                i = int(np.searchsorted(inherit, carried, side="right")) - 1
                assert (rest[i] + (carried if count[i] == 0 else 0), count[i]) == (open_, closed)


def test_one_long_stretch_is_cut_through_a_tree(spark):
    """One stretch of 500 slices beside short ones: three levels of the tree."""
    rng = random.Random(3)
    rows, want = [], {}
    for session, n in ((1, 1500), (2, 2), (3, 40)):
        stream = [(q, q, 1000 + q, 0, rng.choice([0, 1, 9, 40, 130])) for q in range(n)]
        want[session] = chunks_by_hand(stream, 100)
        rows += [(session, *r) for r in stream]
    df = spark.createDataFrame(rows, "session bigint, seq bigint, sn bigint, tm bigint, segment bigint, size bigint")
    out = pk.chunk_manifest(df, limit=100, slice_rows=3).collect()
    for session, chunks in want.items():
        got = sorted(
            (r.num, r.segment, r.size, r.min_ts, r.max_ts, r.min_sn, r.max_sn) for r in out if r.session == session
        )
        # a last chunk without bytes is not written
        assert got == [c for c in chunks if c[2] > 0]


def test_annotation_versions(spark):
    tags = spark.createDataFrame([("afib",), ("noise",)], "tag string")
    schema = (
        "id bigint, session bigint, block int, start_time double, stop_time double, notes string, data string, "
        "tags array<string>, version bigint, deleted boolean"
    )
    first = spark.createDataFrame(
        [(1, 7, 0, 1.0, 2.0, "n", None, ["afib"], 1, False), (2, 7, 0, 3.0, 4.0, None, None, ["nope"], 1, False)], schema
    )
    v1 = notes.new_versions(first, None, tags, "review")
    assert [(r.id, r.tags) for r in v1.collect()] == [(1, ["afib", "source:review"])]
    change = spark.createDataFrame([(1, None, None, None, 9.0, None, None, ["noise"], 2, False)], schema)
    v2 = notes.new_versions(change, notes.current_view(v1), tags, "review")
    now = notes.current_view(v1.unionByName(v2)).collect()[0]
    assert (now.start_time, now.stop_time, now.notes, now.tags) == (1.0, 9.0, "n", ["noise", "source:review"])
    gone = v2.withColumn("version", F.lit(3).cast("bigint")).withColumn("deleted", F.lit(True))
    assert notes.current_view(v1.unionByName(v2).unionByName(gone)).count() == 0


def test_tag_search_needs_a_condition(spark):
    df = spark.createDataFrame([(1, 1.0)], "id bigint, start_time double")
    with pytest.raises(ValueError):
        notes.with_all_tags(df, spark.createDataFrame([], "annid bigint, tag string"))


def test_session_annotations(spark):
    a = spark.createDataFrame(
        [("x", 1, 0, 5), ("x", 1, 1, 6), ("y", 1, 0, 5)], "annotator string, session bigint, block int, type_id int"
    )
    types = spark.createDataFrame([(5, "AFIB")], "id int, name string")
    out = notes.session_annotations(a, types, "x", 1).orderBy("block").collect()
    assert [r.name for r in out] == ["AFIB", None]


def test_window_arguments():
    assert clock.window_arguments(1, 2.5) == (1, 2.5)
    assert clock.window_arguments("2024-01-01 00:00:00", zone="UTC") == (1704067200.0, None)
    with pytest.raises(ValueError):
        clock.window_arguments("2024-01-01 00:00:00")
    with pytest.raises(ValueError):
        clock.window_arguments("2024-01-01 00:00:00", 5, "UTC")


def test_serial_numbers(spark):
    df = spark.createDataFrame([("201403123".rjust(9),), ("140312345",), ("????20140312345",), ("120312345",), ("140399999",), ("14x312345",)], "s string")
    got = [r[0] for r in df.select(device.device_id(F.col("s"))).collect()]
    ident = (1 << 18) | (3 << 14) | 12345
    assert got[1:] == [ident, ident, -1, -1, -1]
    back = spark.range(1).select(device.serial_number(F.lit(ident))).collect()[0][0]
    assert back == "????20140312345"


def test_message_content_is_no_pattern(spark):
    df = spark.createDataFrame([(r"^a ([A-Z]*) b ([0-9]*)$", ["$1(x", "7"]), ("none$", ["z"]), ("a ([a-z]*)", [])], "t string, c array<string>")
    got = [r[0] for r in df.select(text.rebuilt_message(F.col("t"), F.col("c"))).collect()]
    assert got == ["a 1(x b 7", "none", "a ([a-z]*)"]


def test_recode_and_state(spark):
    df = spark.createDataFrame([(16383.0,), (16374.0,), (16373.0,), (75.5,), (16380.5,)], "v double")
    got = [r[0] for r in df.select(codes.recode(F.col("v"))).collect()]
    assert got == [-1.0, -10.0, 16373.0, 75.5, 16380.5]


def test_emptied_session_loses_its_rows(spark, tmp_path):
    path = str(tmp_path / "results")
    schema = "session bigint, v double"
    sessions = lambda *ids: spark.createDataFrame([(i,) for i in ids], "session bigint")
    sinks.replace_sessions(spark.createDataFrame([(i, float(i)) for i in range(20)], schema), path, sessions(*range(20)))
    # session 7 is mined again without any result, session 3 with a new one
    sinks.replace_sessions(spark.createDataFrame([(3, 33.0)], schema), path, sessions(3, 7))
    got = {r.session: r.v for r in spark.read.parquet(path).collect()}
    assert got == {**{float(i): float(i) for i in range(20) if i != 7}, 3: 33.0}


def test_only_a_missing_table_counts_as_none(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "bucket=1").mkdir()
    (path / "bucket=1" / "part-0.parquet").write_bytes(b"no parquet")
    rows = spark.createDataFrame([(1, 1.0)], "session bigint, v double")
    with pytest.raises(Exception):
        sinks.replace_sessions(rows, str(path), rows.select("session"))
    assert (path / "bucket=1" / "part-0.parquet").exists()


def test_covered_partitions_without_rows_go(spark, tmp_path):
    path = str(tmp_path / "by")
    frame = lambda rows: spark.createDataFrame(rows, "site string, day int, v int")
    sinks.replace_partitions(frame([("a b", 1, 1), ("a b", 2, 2), ("c", 1, 3)]), path, ["site", "day"])
    sinks.replace_partitions(frame([("a b", 1, 9)]), path, ["site", "day"], frame([("a b", 1, 0), ("a b", 2, 0)]))
    assert {(r.site, r.day, r.v) for r in spark.read.parquet(path).collect()} == {("a b", 1, 9), ("c", 1, 3)}


def test_named_waveforms_of_several_blocks(spark):
    rows = [(1, b, p, b * 10, 1.0) for b in (0, 1) for p in ("ECG_I", "PR", "TIME_SYNC")]
    df = spark.createDataFrame(rows, "session bigint, block int, param string, sn int, value double")
    names = lambda **k: sorted((r.block, r.param) for r in select_readings(df, **k).collect())
    assert names(params=["ECG_I"]) == [(b, p) for b in (0, 1) for p in ("ECG_I", "TIME_SYNC")]
    assert names() == names(blocks=[0, 1]) == [(b, p) for b in (0, 1) for p in ("PR", "TIME_SYNC")]
    assert len(names(waveforms=True)) == 6 and len(names(blocks=[1])) == 3 and len(names(blocks=[1], waveforms=False)) == 2


def test_every_field_of_a_packet(spark):
    one = "session bigint, param string, sn int, values array<double>"
    numeric = spark.createDataFrame([(1, "BP", 5, [1.0, 2.0, 3.0]), (1, "BP", 6, [])], one)
    passed = spark.createDataFrame([(1, "PR", 7, [0.0, 4.0, 5.0]), (1, "PR", 8, [0.0])], one)
    syncs = spark.createDataFrame([(1, 9, 2000, 77)], "session bigint, sn int, tm_ms long, device bigint")
    extra = spark.createDataFrame([(1, "x", 10, 3000, [6.0, 7.0])], "session bigint, subtype string, sn int, tm_ms long, values array<double>")
    got = sorted((r.sn, r.field, r.value, r.param, r.t) for r in pk.typed_readings(numeric, passed, syncs, extra).collect())
    assert got == [
        (5, 0, 1.0, "BP", None), (5, 1, 2.0, "BP", None), (5, 2, 3.0, "BP", None), (7, 0, 4.0, "PR", None), (7, 1, 5.0, "PR", None),
        (9, 0, 77.0, "TIME_SYNC", 2.0), (10, 0, 6.0, "ANALYTICS_x", 3.0), (10, 1, 7.0, "ANALYTICS_x", 3.0),
    ]


def test_pages_go_on_after_the_last_row(spark):
    df = spark.createDataFrame([(i // 3, i, None if i % 4 else "x") for i in range(20)], "a int, b int, c string")
    seen, last = [], None
    while True:
        rows = (page(df, ["a", "b"], 0, 7) if last is None else page_after(df, ["a", "b"], last, 7)).collect()
        if not rows:
            break
        seen += [r.b for r in rows]
        last = (rows[-1].a, rows[-1].b)
    assert seen == list(range(20))
