import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starflow.operators import load, tables
from starflow.operators.checks import KeyViolation
from starflow.schemas import Column, TableSpec
from conftest import rows

SPEC = TableSpec("t", (Column("k", "varchar", length=8, nullable=False),
                       Column("day", "timestamp", nullable=False),
                       Column("v", "numeric", precision=9, scale=2)), key=("k", "day"))


def src(spark, data):
    return spark.createDataFrame(data, "k string, day string, v string")


def read(spark, path):
    return rows(spark.read.parquet(path).select("k", "day", "v"), ["k", "day"])


D1, D2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"
T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)


@pytest.mark.parametrize("partition_by", [None, ["day"]])
def test_upsert_insert_update_idempotent(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    load.upsert(spark, src(spark, [("A", D1, "1"), ("B", D1, "2")]), path, SPEC,
                partition_by=partition_by)
    s2 = src(spark, [("B", D1, "20.555"), ("C", D2, "3")])   # existing key + new key
    load.upsert(spark, s2, path, SPEC, partition_by=partition_by)
    want = [("A", T1, Decimal("1.00")), ("B", T1, Decimal("20.56")), ("C", T2, Decimal("3.00"))]
    assert read(spark, path) == want
    load.upsert(spark, s2, path, SPEC, partition_by=partition_by)   # same input twice
    assert read(spark, path) == want
    load.upsert(spark, src(spark, []), path, SPEC, partition_by=partition_by)   # empty source
    assert read(spark, path) == want


def test_upsert_matches_after_cast(spark, tmp_path):
    path = str(tmp_path / "t")
    load.upsert(spark, src(spark, [("LONGSYMBOLX", D1, "1")]), path, SPEC)
    # key compared after the varchar(8) cast: this updates, not inserts
    load.upsert(spark, src(spark, [("LONGSYMBOLY", D1, "2")]), path, SPEC)
    assert read(spark, path) == [("LONGSYMB", T1, Decimal("2.00"))]


def test_upsert_rejects_bad_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(KeyViolation):
        load.upsert(spark, src(spark, [("A", D1, "1"), ("A", D1, "2")]), path, SPEC)
    with pytest.raises(KeyViolation):
        load.upsert(spark, src(spark, [(None, D1, "1")]), path, SPEC)


def test_append_replace_and_invalid(spark, tmp_path):
    path, log = str(tmp_path / "t"), TableSpec("log", SPEC.columns)  # no key: rows may repeat
    one = src(spark, [("A", D1, "1")])
    for _ in range(2):
        load.load(spark, "append", one, path, log, buckets=3)
    assert tables.read(spark, path).count() == 2
    load.load(spark, "replace", src(spark, [("B", D2, "5")]), path, SPEC, buckets=3)
    assert rows(tables.read(spark, path)) == [("B", T2, Decimal("5.00"))]
    load.load(spark, "upsert", src(spark, [("B", D2, "6"), ("A", D1, "1")]), path, SPEC)
    assert rows(tables.read(spark, path), ["k"]) == [("A", T1, Decimal("1.00")), ("B", T2, Decimal("6.00"))]
    with pytest.raises(ValueError):
        load.load(spark, "update", src(spark, []), path, SPEC)


def test_incremental(spark, tmp_path):
    path = str(tmp_path / "inc")
    df = spark.createDataFrame([(1, T1), (2, T2)], "id int, ts timestamp_ntz")
    load.incremental_append(spark, df.filter("id = 1"), path, "ts")       # first run: all
    late = spark.createDataFrame([(3, dt.datetime(2024, 12, 31)), (4, dt.datetime(2025, 1, 3))],
                                 "id int, ts timestamp_ntz")
    load.incremental_append(spark, df.unionByName(late), path, "ts")       # only past the max
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 4]


def test_high_water_filter_empty_target(spark):
    df = spark.createDataFrame([(1, T1)], "id int, ts timestamp_ntz")
    assert load.high_water_filter(df, df.filter("id < 0"), "ts").count() == 0


def test_truncate_load(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("x,y,z\nA,2025-01-01 00:00:00,1\nB,2025-01-01 00:00:00,2\n")
    b.write_text("x,y,z\nC,2025-01-02 00:00:00,3\n")
    target = str(tmp_path / "ingress")
    load.truncate_load(spark, str(a), SPEC, target)
    load.truncate_load(spark, str(b), SPEC, target)
    assert rows(tables.read(spark, target)) == [("C", "2025-01-02 00:00:00", "3")]
    b.write_text("x,y,z\nD,,3\n")  # a key column declared NOT NULL is empty: the table stays
    with pytest.raises(KeyViolation):
        load.truncate_load(spark, str(b), SPEC, target)
    assert rows(tables.read(spark, target)) == [("C", "2025-01-02 00:00:00", "3")]


def test_upsert_derived_partition(spark, tmp_path):
    path = str(tmp_path / "p")
    derive = {"d": F.to_date("day")}
    load.upsert(spark, src(spark, [("A", D1, "1"), ("B", D2, "2")]), path, SPEC,
                partition_by=["d"], derive=derive)
    load.upsert(spark, src(spark, [("A", D1, "9")]), path, SPEC, partition_by=["d"], derive=derive)
    assert read(spark, path) == [("A", T1, Decimal("9.00")), ("B", T2, Decimal("2.00"))]


def test_materialize_kinds(spark, tmp_path):
    df = spark.createDataFrame([(1, T1), (2, T2)], "id int, ts timestamp_ntz")
    assert load.materialize(df, "mat_view_t", "view").count() == 2
    assert spark.sql("select count(*) from mat_view_t").first()[0] == 2
    assert load.materialize(df, "mat_tab_t", "table").count() == 2
    assert load.materialize(df.filter("id = 1"), "mat_tab_t", "table").count() == 1   # rebuild
    p = str(tmp_path / "m")
    assert load.materialize(df, "x", "table", path=p).count() == 2
    inc = str(tmp_path / "inc")
    load.materialize(df.filter("id = 1"), "i", "incremental", path=inc, ts_col="ts")
    assert load.materialize(df, "i", "incremental", path=inc, ts_col="ts").count() == 2
    with pytest.raises(ValueError):
        load.materialize(df, "x", "ephemeral")


def test_partitioned_replace_empties_table(spark, tmp_path):
    path = str(tmp_path / "r")
    derive_src = src(spark, [("A", D1, "1"), ("B", D2, "2")])
    load.load(spark, "replace", derive_src, path, SPEC, partition_by=["day"])
    load.load(spark, "replace", src(spark, [("C", D2, "3")]), path, SPEC, partition_by=["day"])
    # replace deletes every row first, including the untouched day
    assert read(spark, path) == [("C", T2, Decimal("3.00"))]


def _files(root):
    import os
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs
                  if f.endswith(".parquet"))


def test_upsert_insert_only_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    load.upsert(spark, src(spark, [("A", D1, "1")]), path, SPEC, partition_by=["day"])
    before = _files(path)
    load.upsert(spark, src(spark, [("B", D1, "2"), ("C", D2, "3")]), path, SPEC,
                partition_by=["day"])
    after = _files(path)
    assert set(before) <= set(after)          # nothing rewritten, new files added
    load.upsert(spark, src(spark, [("A", D1, "9")]), path, SPEC, partition_by=["day"])
    final = _files(path)
    d2_files = [f for f in after if "day=2025-01-02" in f]
    assert set(d2_files) <= set(final)        # the day without a match is left alone
    assert read(spark, path) == [("A", T1, Decimal("9.00")), ("B", T1, Decimal("2.00")),
                                 ("C", T2, Decimal("3.00"))]


def test_upsert_identical_replay_rewrites_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    data = [("A", D1, "1"), ("B", D2, "2")]
    load.upsert(spark, src(spark, data), path, SPEC, partition_by=["day"])
    before = _files(path)
    load.upsert(spark, src(spark, data), path, SPEC, partition_by=["day"])   # replay
    assert _files(path) == before
    load.upsert(spark, src(spark, [("A", D1, "1"), ("B", D2, "5")]), path, SPEC,
                partition_by=["day"])
    after = _files(path)
    assert [f for f in after if "day=2025-01-01" in f] == [f for f in before if "day=2025-01-01" in f]
    assert read(spark, path) == [("A", T1, Decimal("1.00")), ("B", T2, Decimal("5.00"))]


def test_merge_table_needs_merge_capable_format(spark):
    spark.createDataFrame([("A", T1, Decimal("1.00"))], "k string, day timestamp_ntz, v decimal(9,2)") \
        .write.mode("overwrite").saveAsTable("merge_plain_parquet")
    with pytest.raises(Exception, match="MERGE"):
        load.merge_table(src(spark, [("A", D1, "2")]), "merge_plain_parquet", SPEC)


def test_materialize_partitioned_keeps_order_and_types(spark, tmp_path):
    df = spark.createDataFrame([(1, T1, "x"), (2, T2, "y")], "id int, ts timestamp_ntz, s string")
    out = load.materialize(df, "m", "table", path=str(tmp_path / "m"), partition_by=["ts"])
    assert out.columns == ["id", "ts", "s"]
    assert out.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert sorted(rows(out)) == [(1, T1, "x"), (2, T2, "y")]


PSPEC = TableSpec("p", (Column("k", "varchar", length=8, nullable=False), Column("day", "timestamp"),
                        Column("v", "numeric", precision=9, scale=2), Column("j", "json")), key=("k",))


def _psrc(spark, data):
    return spark.createDataFrame([(*r, '{"a":%s}' % r[2]) if len(r) == 3 else r for r in data],
                                 "k string, day string, v string, j string")


def _pread(spark, path):
    return rows(spark.read.parquet(path).select("k", "day", "v", F.to_json("j")), ["k"])


def test_upsert_null_and_moved_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    up = lambda *data: load.upsert(spark, _psrc(spark, data), path, PSPEC, partition_by=["day"])
    up(("A", D1, "1"), ("B", D1, "2"), ("N", None, "3"))
    up(("A", D1, "9"), ("M", None, "4"))            # a new key without a day beside an update
    assert [r[0] for r in _pread(spark, path)] == ["A", "B", "M", "N"]
    up(("N", None, "5"))                            # a stored key without a day is matched
    assert [r for r in _pread(spark, path) if r[0] == "N"] == [("N", None, Decimal("5.00"), '{"a":5}')]
    up(("A", D2, "9"), ("B", None, "2"))            # moved: the old partitions lose them, one is empty now
    assert [(r[0], r[1]) for r in _pread(spark, path)] == [("A", T2), ("B", None), ("M", None), ("N", None)]
    assert not [f for f in _files(path) if "2025-01-01" in f]
    before = _files(path)
    up(("A", D2, "9"), ("N", None, "5"))            # equal rows, json column included
    assert _files(path) == before
    up(("M", None, "4", '{"a":40}'))                # only the json differs
    assert [r[3] for r in _pread(spark, path) if r[0] == "M"] == ['{"a":40}']


def test_upsert_unreadable_target_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    load.upsert(spark, src(spark, [("A", D1, "1"), ("B", D2, "2")]), path, SPEC, partition_by=["day"])
    bad = [f for f in _files(path) if "2025-01-02" in f][0]
    whole = open(bad, "rb").read()
    with open(bad, "wb") as f:
        f.write(b"PAR1 not a footer")
    before = {f: open(f, "rb").read() for f in _files(path)}
    with pytest.raises(Exception):
        load.upsert(spark, src(spark, [("B", D2, "5")]), path, SPEC, partition_by=["day"])
    assert {f: open(f, "rb").read() for f in _files(path)} == before
    with open(bad, "wb") as f:
        f.write(whole)
    load.upsert(spark, src(spark, [("B", D2, "5")]), path, SPEC, partition_by=["day"])
    assert read(spark, path) == [("A", T1, Decimal("1.00")), ("B", T2, Decimal("5.00"))]


def test_upsert_leaves_no_staged_copy(spark, tmp_path):
    import os

    from starflow.session import checkpoint_root
    root = os.path.join(checkpoint_root(spark).removeprefix("file:"), "starflow")
    path = str(tmp_path / "t")
    old = set(os.listdir(root)) if os.path.isdir(root) else set()
    for v in ("1", "2"):
        load.upsert(spark, src(spark, [("A", D1, v)]), path, SPEC, partition_by=["day"])
    assert {x for x in set(os.listdir(root)) - old if x.startswith(("stage", "batch", "matches"))} == set()


def test_upsert_newer_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("n", (Column("k", "varchar", length=8, nullable=False), Column("day", "timestamp"),
                           Column("v", "numeric", precision=9, scale=2)), key=("k",))
    up = lambda *data: load.upsert(spark, src(spark, data), path, spec, partition_by=["day"], newer="day")
    up(("A", D2, "1"), ("B", D1, "1"), ("C", D1, "1"))
    up(("A", D1, "7"), ("B", D2, "7"), ("C", None, "7"))
    assert read(spark, path) == [("A", T2, Decimal("1.00")), ("B", T2, Decimal("7.00")), ("C", T1, Decimal("1.00"))]


@pytest.mark.parametrize("partition_by", [None, ["day"]])
def test_appends_and_replaces_are_checked(spark, tmp_path, partition_by):
    path = str(tmp_path / "t")
    how = {"partition_by": partition_by}
    load.load(spark, "append", src(spark, [("A", D1, "1")]), path, SPEC, **how)
    for op, data in (("append", [("A", D1, "2")]), ("append", [(None, D1, "2")]), ("append", [("B", D1, "2"), ("B", D1, "2")]),
                     ("replace", [("B", D1, "2"), ("B", D1, "3")])):
        with pytest.raises(KeyViolation):
            load.load(spark, op, src(spark, data), path, SPEC, **how)
    if partition_by:
        load.load(spark, "append", src(spark, [("A", D1, "2")]), path, SPEC, check=False, **how)
        assert len(read(spark, path)) == 2
    else:
        assert rows(tables.read(spark, path)) == [("A", T1, Decimal("1.00"))]


def test_incremental_on_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "e")
    df = spark.createDataFrame([(1, T1)], "id int, ts timestamp_ntz")
    load.incremental_append(spark, df.limit(0), path, "ts", partition_by=["id"])
    load.incremental_append(spark, df, path, "ts", partition_by=["id"])   # exists and is empty: no row passes
    assert load.open_table(spark, path, df.schema).count() == 0
    assert load.open_table(spark, str(tmp_path / "none"), df.schema) is None
