import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starflow.operators import tables
from starflow.operators.checks import KeyViolation
from starflow.schemas import Column, TableSpec

SPEC = TableSpec("t", (Column("k", "varchar", length=8, nullable=False), Column("day", "timestamp"),
                       Column("v", "numeric", precision=9, scale=2), Column("j", "json")), key=("k",))
LOG = TableSpec("log", SPEC.columns)
D1, D2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"
T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)


def src(spark, *data):
    return spark.createDataFrame([(*r, '{"a":%s}' % r[2]) if len(r) == 3 else r for r in data], "k string, day string, v string, j string")


def got(spark, root):
    return sorted([(k, d, int(v)) for k, d, v in rows(tables.read(spark, root).select("k", "day", "v"))], key=str)


def _files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_merge_outcomes_and_replay(spark, tmp_path):
    root = str(tmp_path / "t")
    first = tables.merge(spark, src(spark, ("A", D1, "1"), ("B", D1, "2"), ("N", None, "3")), root, SPEC, buckets=7)
    assert (first.inserted, first.updated, first.unchanged) == (3, 0, 0)
    batch = src(spark, ("B", D2, "20"), ("C", D2, "3"), ("N", None, "3"))
    done = tables.merge(spark, batch, root, SPEC)
    assert (done.inserted, done.updated, done.unchanged) == (1, 1, 1)
    want = [("A", T1, 1), ("B", T2, 20), ("C", T2, 3), ("N", None, 3)]
    assert got(spark, root) == want
    files, version = _files(root), tables.current(spark, root).seq
    again = tables.merge(spark, batch, root, SPEC)  # nothing changes, nothing is published
    assert (again.inserted, again.updated, again.unchanged) == (0, 0, 3) and again.version == version
    assert _files(root) == files
    done = tables.merge(spark, src(spark, ("C", D2, "3", '{"a":30}')), root, SPEC)  # only the json differs
    assert done.updated == 1
    assert tables.merge(spark, src(spark), root, SPEC).inserted == 0
    assert got(spark, root) == want
    assert tables.read(spark, root).schema["v"].dataType.simpleString() == "decimal(9,2)"


def test_merge_reads_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    many = [(f"k{i}", D1, str(i)) for i in range(400)]
    tables.replace(spark, src(spark, *many), root, SPEC, buckets=32)
    b = spark.range(1).select(F.lit("k7").alias("k")).select(tables.bucket_of(["k"], 32)).first()[0]
    others = [f for f in _files(os.path.join(root, "data")) if f"bucket={b}/" not in f]
    assert len(others) >= 25
    for f in others:  # unreadable: any attempt to read them fails
        with open(f, "wb") as out:
            out.write(b"PAR1 not a footer")
    done = tables.merge(spark, src(spark, ("k7", D2, "70")), root, SPEC)
    assert done.updated == 1
    version = tables.current(spark, root)
    assert {f for x, f in version.folders if x != b} == {f.split(root + "/")[1].rsplit("/", 1)[0] for f in others}
    rows_of_b = {r.k: int(r.v) for r in tables._read(spark, root, version, {b}).collect()}
    assert rows_of_b["k7"] == 70
    with pytest.raises(KeyViolation):  # an append reads no other bucket either
        tables.append(spark, src(spark, ("k7", D2, "1")), root, SPEC)


def test_newer_and_null_times(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.merge(spark, src(spark, ("A", D2, "1"), ("B", D1, "1"), ("C", D1, "1"), ("D", None, "1")), root, SPEC, newer="day", buckets=3)
    done = tables.merge(spark, src(spark, ("A", D1, "7"), ("B", D2, "7"), ("C", None, "7"), ("D", None, "7")), root, SPEC, newer="day")
    assert (done.updated, done.stale) == (2, 2)
    assert got(spark, root) == [("A", T2, 1), ("B", T2, 7), ("C", T1, 1), ("D", None, 7)]


def test_refused_batches_leave_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.replace(spark, src(spark, ("A", D1, "1"), ("B", D1, "2")), root, SPEC, buckets=4)
    before, files = got(spark, root), _files(root)
    doubled, nulls = src(spark, ("X", D1, "1"), ("X", D1, "1")), src(spark, (None, D1, "1"))
    for write in (tables.replace, tables.append, tables.merge):
        for bad in (doubled, nulls):
            with pytest.raises(KeyViolation, match="violated"):
                write(spark, bad, root, SPEC)
    with pytest.raises(KeyViolation, match="stored"):
        tables.append(spark, src(spark, ("A", D1, "9")), root, SPEC)
    assert got(spark, root) == before and _files(root) == files


def test_append_and_replace(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.append(spark, src(spark, ("A", D1, "1")), root, SPEC, buckets=4)
    tables.append(spark, src(spark, ("B", D1, "2")), root, SPEC)
    assert got(spark, root) == [("A", T1, 1), ("B", T1, 2)]
    tables.merge(spark, src(spark, ("A", D1, "5")), root, SPEC)
    tables.replace(spark, src(spark, ("Z", D2, "9")), root, SPEC)
    assert got(spark, root) == [("Z", T2, 9)]
    tables.replace(spark, src(spark), root, SPEC)
    assert got(spark, root) == []
    log = str(tmp_path / "log")  # no key: rows may repeat
    for _ in range(2):
        tables.append(spark, src(spark, ("A", D1, "1")), log, LOG)
    assert got(spark, log) == [("A", T1, 1)] * 2


def test_versions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(5):
        tables.replace(spark, src(spark, ("A", D1, str(i))), root, SPEC, buckets=2)
    assert len(os.listdir(os.path.join(root, "pointer"))) == tables.KEPT
    assert len(_files(os.path.join(root, "data"))) == tables.KEPT
    assert got(spark, root) == [("A", T1, 4)]


@pytest.mark.parametrize("step", ["_write", "_refuse", "publish", "prune"])
def test_a_failure_at_any_step_shows_old_or_new(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "t")
    old, new = [("A", T1, 1), ("B", T1, 2)], [("A", T2, 10), ("B", T1, 2), ("C", T1, 3)]
    tables.replace(spark, src(spark, ("A", D1, "1"), ("B", D1, "2")), root, SPEC, buckets=4)
    tables.replace(spark, src(spark, ("A", D1, "1"), ("B", D1, "2")), root, SPEC)
    batch = src(spark, ("A", D2, "10"), ("C", D1, "3"))
    whole = getattr(tables, step)

    def fails(*a, **k):
        whole(*a, **k) if step == "_write" else None  # rows are on disk, then the writer dies
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, step, fails)
    with pytest.raises(RuntimeError):
        tables.merge(spark, batch, root, SPEC)
    assert got(spark, root) == (new if step == "prune" else old)  # published before the clean-up
    monkeypatch.setattr(tables, step, whole)
    tables.merge(spark, batch, root, SPEC)
    assert got(spark, root) == new


def test_two_writers(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.replace(spark, src(spark, ("A", D1, "1")), root, SPEC, buckets=2)
    whole, done = tables._staged_batch, []

    def meanwhile(*a, **k):
        out = whole(*a, **k)
        if not done:
            done.append(1)
            tables.merge(spark, src(spark, ("B", D1, "2")), root, SPEC)
        return out

    monkeypatch.setattr(tables, "_staged_batch", meanwhile)
    with pytest.raises(tables.Conflict):
        tables.merge(spark, src(spark, ("A", D1, "9")), root, SPEC)
    assert got(spark, root) == [("A", T1, 1), ("B", T1, 2)]
    tables.merge(spark, src(spark, ("A", D1, "9")), root, SPEC)
    assert got(spark, root) == [("A", T1, 9), ("B", T1, 2)]


def test_other_keys_or_columns_are_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.replace(spark, src(spark, ("A", D1, "1")), root, SPEC, buckets=2)
    with pytest.raises(ValueError):
        tables.merge(spark, src(spark, ("A", D1, "1")), root, SPEC, key=["k", "day"])
    with pytest.raises(ValueError):
        tables.merge(spark, src(spark, ("A", D1, "1")), root, SPEC, derive={"x": F.lit(1)})
    with pytest.raises(FileNotFoundError):
        tables.read(spark, str(tmp_path / "none"))


def test_checks_scan_nothing_twice(spark, tmp_path):
    """A checked replace runs one job over its source: the rows are counted on their way."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    data = src(spark, *[(f"k{i}", D1, "1") for i in range(50)]).mapInArrow(count, "k string, day string, v string, j string")
    tables.replace(spark, data, str(tmp_path / "t"), SPEC, buckets=3)
    assert seen.value == 50
    assert Decimal(1) == tables.read(spark, str(tmp_path / "t")).first().v
