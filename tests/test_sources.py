import glob
import os
import time

import pytest
from pyspark.sql import types as T

from starflow.schemas import COMPANIES_DAILY
from starflow.sources.csv import read_positional_csv, read_quoted_csv, read_seed, write_csv_snapshot
from starflow.sources.files import (archive_load, check_scope, newest_file, newest_snapshot, read_loaded, snapshot_folder,
                                    snapshot_runs)
from starflow.sources.tables import parse_keys, subset
from conftest import rows

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.IntegerType())])


def write(path, text, bom=False):
    with open(path, "wb") as f:
        if bom:
            f.write(b"\xef\xbb\xbf")
        f.write(text.encode("utf-8"))


def test_positional_csv_traps(spark, tmp_path):
    p = tmp_path / "x.csv"
    write(p, 'totally,other,names\n'
             '"x, y","say ""hi""",1\n'
             '"line\nbreak",,2\n'
             '"",plain,3\n')
    df = read_positional_csv(spark, str(p), SCHEMA)
    assert rows(df, ["c"]) == [("x, y", 'say "hi"', 1), ("line\nbreak", None, 2), (None, "plain", 3)]


def test_positional_csv_with_spec_is_text(spark, tmp_path):
    p = tmp_path / "d.csv"
    header = ",".join(["symbol", "load_timestamp_utc", "previous_close", "open"] + [f"f{i}" for i in range(13)])
    vals = ",".join(["AAPL", "2025-04-01 00:00:00", "1.5", "2.5"] + [""] * 13)
    write(p, header + "\n" + vals + "\n")
    df = read_positional_csv(spark, str(p), COMPANIES_DAILY)
    r = df.first()
    assert df.columns == COMPANIES_DAILY.names
    assert (r.symbol, r.open_price, r.bid) == ("AAPL", "2.5", None)


def test_seed_bom_and_blanks(spark, tmp_path):
    p = tmp_path / "s.csv"
    write(p, "sector_id,sector_name\n1, Technology\n2,Energy \n", bom=True)
    schema = T.StructType([T.StructField("sector_id", T.IntegerType()),
                           T.StructField("sector_name", T.StringType())])
    assert rows(read_seed(spark, str(p), schema), ["sector_id"]) == [(1, "Technology"), (2, "Energy")]


def test_newest_file(spark, tmp_path):
    d = tmp_path / "daily"
    (d / "20250101-000000").mkdir(parents=True)
    (d / "20250102-000000").mkdir(parents=True)
    old = d / "20250101-000000" / "a.csv"
    new = d / "20250102-000000" / "b.csv"
    write(old, "x\n")
    write(new, "y\n")
    now = time.time()
    os.utime(old, (now - 100, now - 100))
    os.utime(new, (now, now))
    assert newest_file(spark, str(d)).endswith("b.csv")
    os.utime(old, (now, now))  # tie: first in path order wins
    assert newest_file(spark, str(d)).endswith("a.csv")


def test_newest_file_empty(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        newest_file(spark, str(tmp_path / "empty"))


def test_scope():
    assert check_scope("Daily") == "daily"
    assert snapshot_folder("/x/", "weekly", "20250101-000000") == "/x/weekly/20250101-000000"
    with pytest.raises(ValueError):
        check_scope("monthly")


def test_subset_string_and_frame(spark):
    df = spark.createDataFrame([(i, f"S{i}") for i in range(10)], "k long, s string")
    assert parse_keys(" 1, 3,,5 ") == ["1", "3", "5"]
    assert rows(subset(df, "k", "1,3, 5"), ["k"]) == [(1, "S1"), (3, "S3"), (5, "S5")]
    assert subset(df, "k", "").count() == 10
    keys = spark.createDataFrame([(2,), (2,), (4,)], "x long")
    assert rows(subset(df, "k", keys), ["k"]) == [(2, "S2"), (4, "S4")]
    big = [str(i) for i in range(0, 3000, 2)]  # long lists become a semi join
    assert subset(df, "k", big).count() == 5


def test_archive_load(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()
    ck, target = str(tmp_path / "ck"), str(tmp_path / "ingress")
    write(landing / "one.csv", "h1,h2,h3\na,b,1\n")
    assert archive_load(spark, str(landing), str(archive), ck, SCHEMA, target) >= 1
    assert rows(read_loaded(spark, target, SCHEMA)) == [("a", "b", 1)]
    write(landing / "two.csv", "h1,h2,h3\nc,d,2\n")
    archive_load(spark, str(landing), str(archive), ck, SCHEMA, target)
    # truncate-then-load: only the new file's rows remain
    assert rows(read_loaded(spark, target, SCHEMA)) == [("c", "d", 2)]
    moved = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "one.csv" in moved


@pytest.mark.parametrize("step", ["open_table", "publish", "remove_folder", "prune"])
def test_archive_load_stopped_at_any_step(spark, tmp_path, monkeypatch, step):
    """Stopped after the stream has drained, before or after publishing: readers see the old rows or
    the new ones, and the next arrival is all that is left after the next load."""
    from starflow import session
    from starflow.operators import load, tables
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()
    ck, target = str(tmp_path / "ck"), str(tmp_path / "ingress")
    run = lambda: archive_load(spark, str(landing), str(archive), ck, SCHEMA, target)
    kept = lambda: sorted(r.c for r in read_loaded(spark, target, SCHEMA).collect())
    write(landing / "old.csv", "h1,h2,h3\nx,y,0\n")
    run()
    write(landing / "a.csv", "h1,h2,h3\na,b,1\n")
    place = {"open_table": load, "publish": tables, "remove_folder": session, "prune": tables}[step]
    whole, calls = getattr(place, step), []

    def fails(*a, **k):
        calls.append(a)
        if step == "open_table" and (len(a) < 2 or not a[1].startswith(f"{target}/data/")):
            return whole(*a, **k)
        raise RuntimeError("lost")

    monkeypatch.setattr(place, step, fails)
    with pytest.raises(RuntimeError, match="lost"):
        run()
    monkeypatch.setattr(place, step, whole)
    published = step in ("remove_folder", "prune")
    assert kept() == ([1] if published else [0])
    write(landing / "b.csv", "h1,h2,h3\na,b,2\n")
    run()
    # a load that was not published is resumed with what came since; one that was is replaced
    assert kept() == ([2] if published else [1, 2])
    write(landing / "c.csv", "h1,h2,h3\na,b,3\n")
    run()
    assert kept() == [3]


def test_archive_load_resumes_after_a_failed_batch(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()
    ck, target = str(tmp_path / "ck"), str(tmp_path / "ingress")
    write(landing / "old.csv", "h1,h2,h3\nx,y,0\n")
    archive_load(spark, str(landing), str(archive), ck, SCHEMA, target)
    now = os.path.getmtime(landing) - 60
    for i in (1, 2, 3):  # the second of three batches cannot be read
        write(landing / f"f{i}.csv", f"h1,h2,h3\na,b,{i}\n" if i != 2 else "h1,h2,h3\na,b,no\n")
        os.utime(landing / f"f{i}.csv", (now + i, now + i))
    strict = {"mode": "FAILFAST"}
    with pytest.raises(Exception):
        archive_load(spark, str(landing), str(archive), ck, SCHEMA, target, files_per_batch=1, options=strict)
    assert [r.c for r in read_loaded(spark, target, SCHEMA).collect()] == [0]  # nothing of it is seen yet
    write(landing / "f2.csv", "h1,h2,h3\na,b,2\n")
    archive_load(spark, str(landing), str(archive), ck, SCHEMA, target, files_per_batch=1, options=strict)
    assert sorted(r.c for r in read_loaded(spark, target, SCHEMA).collect()) == [1, 2, 3]
    write(landing / "f6.csv", "h1,h2,h3\na,b,6\n")
    archive_load(spark, str(landing), str(archive), ck, SCHEMA, target, mode="append")
    assert sorted(r.c for r in read_loaded(spark, target, SCHEMA).collect()) == [1, 2, 3, 6]


def test_quoted_csv_in_blocks(spark, tmp_path):
    """One file with line breaks in cells, read by many tasks: the rows of the one-task reader."""
    import random

    rng = random.Random(9)
    cell = lambda: rng.choice(["plain", "", '"two\nlines"', '"a ""quoted"", cell"', '"\n\n"', '"x\r\ny"', '"' + "long " * 40 + '\nend"', "é"])
    lines = [f"{cell()},{cell()},{i}" for i in range(3000)]
    lines.insert(700, "")
    lines[1200] = '"' + "\n".join(f"line {i}" for i in range(3000)) + '",over many blocks,1200'
    write(tmp_path / "one.csv", "h1,h2,h3\n" + "\n".join(lines) + "\n", bom=True)
    write(tmp_path / "two.csv", "h1,h2,h3\r\nq,\"w\r\ne\",7\r\nlast,row,8")
    write(tmp_path / "three.csv", "h1,h2,h3\n")
    with_blocks = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = sorted(map(tuple, read_positional_csv(spark, str(tmp_path), SCHEMA).collect()), key=str)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = read_quoted_csv(spark, str(tmp_path), SCHEMA)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        got = sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", with_blocks)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # the one-task reader turns a line break in a cell into \n where the file's lines end in \r\n
    got = [tuple(c.replace("w\r\ne", "w\ne") if isinstance(c, str) else c for c in r) for r in got]
    assert len(got) == 3002 and got == want


def test_newest_snapshot(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(100).select("id").repartition(4)
    with pytest.raises(FileNotFoundError):
        write_csv_snapshot(df, f"{root}/daily/1")
        os.remove(glob.glob(f"{root}/daily/1.done/*.json")[0])
        newest_snapshot(spark, root)
    write_csv_snapshot(df, f"{root}/daily/2")
    df.write.csv(f"{root}/daily/3")                              # unfinished: no marker
    write_csv_snapshot(df, f"{root}/daily/4 b")
    os.remove(sorted(glob.glob(f"{root}/daily/4 b/part*.csv"))[0])  # copied in part
    assert newest_snapshot(spark, root).endswith("/daily/2")
    assert read_positional_csv(spark, newest_snapshot(spark, root), T.StructType([T.StructField("id", T.LongType())])).count() == 100
    write_csv_snapshot(df.limit(7).repartition(2), f"{root}/daily/5 %20x")
    assert spark.read.option("header", True).csv(newest_snapshot(spark, root)).count() == 7
    runs = {r.folder.rsplit("/", 1)[1]: (r.parts, r.complete) for r in snapshot_runs(spark, root).collect()}
    assert runs["2"] == (4, True) and runs["3"][1] is False and runs["4 b"] == (3, False)


def test_scale_conf_for_100tb():
    from starflow.session import scale_conf
    c = scale_conf(100 << 40, 8000)
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 512 << 20
    parts = int(c["spark.sql.shuffle.partitions"])
    assert 100_000 < parts < 150_000
    small = scale_conf(50 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
