import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from starflow.operators import star
from starflow.plans import marts
from conftest import rows

T0 = dt.datetime(2025, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def test_next_in_key_matches_window_under_skew(spark):
    # key "HOT" holds half of all rows: it must be split across slices yet give the same lead
    data = [("HOT", day(i)) for i in range(4000)] + [(f"K{i % 50}", day(i)) for i in range(4000)]
    df = spark.createDataFrame(data, "symbol string, ts timestamp_ntz")
    want = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("symbol").orderBy("ts")))
    got = star.next_in_key(df, "symbol", "ts", "nxt")
    assert sorted(rows(got.select("symbol", "ts", "nxt"))) == sorted(rows(want))
    # many slices: the hot key is cut into 16 time slices and stitched back
    got16 = star.next_in_key(df, "symbol", "ts", "nxt", slices=16)
    assert sorted(rows(got16.select("symbol", "ts", "nxt"))) == sorted(rows(want))
    # no window group holds more than a slice's share of the hot key
    groups = star.time_slices(df, "ts", 16).groupBy("symbol", "__slice").count()
    biggest = groups.agg(F.max("count")).first()[0]
    assert biggest <= 4000 / 16 * 1.5


def test_next_in_key_nulls_and_ties(spark):
    data = [("A", None), ("A", day(1)), ("A", day(1)), ("A", day(5)), (None, day(2)), (None, day(3))]
    df = spark.createDataFrame(data, "symbol string, ts timestamp_ntz")
    want = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("symbol").orderBy("ts")))
    got = star.next_in_key(df, "symbol", "ts", "nxt", slices=4)
    assert sorted(rows(got.select("symbol", "ts", "nxt")), key=str) == sorted(rows(want), key=str)


def test_employee_intervals(spark):
    weekly = spark.createDataFrame([("A", day(0), "10"), ("A", day(7), "12"), ("Z", day(0), "5")],
                                   "symbol string, load_timestamp_utc timestamp_ntz, "
                                   "company_full_time_employees string")
    comp = spark.createDataFrame([(1, "A", "Alpha")], "company_id int, company_symbol string, company_name string")
    got = rows(marts.trf_employee_intervals(weekly, comp), ["load_timestamp_utc_from", "company_id"])
    assert got == [(None, "5", day(0), None), (1, "10", day(0), day(7)), (1, "12", day(7), None)]


def _dims(spark):
    comp = spark.createDataFrame([(1, "A", "Alpha"), (2, "B", "Beta")],
                                 "company_id int, company_symbol string, company_name string")
    ind = spark.createDataFrame([(10, "Software")], "industry_id int, industry_name string")
    sec = spark.createDataFrame([(20, "Technology")], "sector_id int, sector_name string")
    st = spark.createDataFrame([(30, "CA", "California")], "state_id int, state_symbol string, state_name string")
    return comp, ind, sec, st


def test_stock_fact_lookups_and_latest_snapshot(spark):
    comp, ind, sec, st = _dims(spark)
    cols = star.FACT_MEASURES
    daily = spark.createDataFrame(
        [("A", day(20)), ("B", day(20)), ("C", day(20))], "symbol string, load_timestamp_utc timestamp_ntz")
    for c in cols[1:]:
        daily = daily.withColumn(c, F.lit(None).cast("string"))
    weekly = spark.createDataFrame(
        [("A", day(7), "Software", "Technology", "California"),
         ("A", day(0), "Old", "Old", "Old"),
         ("B", day(0), "Software", "Technology", "California"),   # missing from the latest run
         ("C", day(7), "Mining", "Technology", "CA")],
        "symbol string, load_timestamp_utc timestamp_ntz, company_industry string, "
        "company_sector string, company_state string")
    f = star.stock_fact(daily, weekly, comp, ind, sec, st)
    got = {r.company_id: (r.industry_id, r.sector_id, r.state_id) for r in f.collect()}
    assert got == {1: (10, 20, 30), 2: (None, None, None), None: (None, 20, None)}
    assert f.columns == star.FACT_COLUMNS
    f2 = star.stock_fact(daily, weekly, comp, ind, sec, st, state_match="name_or_symbol")
    assert {r.company_id: r.state_id for r in f2.collect()}[None] == 30


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("A", day(1)), ("B", day(2)), ("C", day(2))], "s string, ts timestamp_ntz")
    assert sorted(r.s for r in star.latest_snapshot(df, "ts").collect()) == ["B", "C"]
    assert star.latest_snapshot(df.filter("s = 'Q'"), "ts").count() == 0


def test_fact_view(spark):
    comp, ind, sec, st = _dims(spark)
    trf = spark.createDataFrame([(1, None, None, None)], "company_id int, industry_id int, sector_id int, state_id int")
    for c in star.FACT_MEASURES:
        trf = trf.withColumn(c, F.lit(None).cast("string"))
    v = marts.fact_stocks_view(trf, "fact_stocks_test")
    assert spark.sql("select count(*) from fact_stocks_test").first()[0] == 1
    assert v.columns == star.FACT_COLUMNS


def test_incremental_staging_and_fact(spark):
    from starflow.plans import staging
    from starflow.schemas import COMPANIES_DAILY
    from starflow.functions.casts import schema_cast
    base = {c: None for c in COMPANIES_DAILY.names}
    rows = [dict(base, symbol="A", load_timestamp_utc=f"2025-01-0{d} 00:00:00", bid=f"{d} x 1")
            for d in (1, 2, 3)]
    ods = schema_cast(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COMPANIES_DAILY.names)),
                      COMPANIES_DAILY)
    built = staging.stg_daily(ods.filter(F.col("load_timestamp_utc") < day(1)))
    assert built.count() == 1
    new = staging.stg_daily(ods, built=built)          # only rows past the built maximum
    assert sorted(r.bid_price for r in new.collect()) == ["2", "3"]
    comp, ind, sec, st = _dims(spark)
    weekly = spark.createDataFrame([("A", day(0), "Software", "Technology", "California")],
                                   "symbol string, load_timestamp_utc timestamp_ntz, "
                                   "company_industry string, company_sector string, company_state string")
    full = marts.trf_fact_stocks(staging.stg_daily(ods), weekly, comp, ind, sec, st)
    inc = marts.trf_fact_stocks(staging.stg_daily(ods), weekly, comp, ind, sec, st,
                                built=full.filter(F.col("load_timestamp_utc") < day(2)))
    assert [str(r.load_timestamp_utc) for r in inc.collect()] == ["2025-01-03 00:00:00"]


FROM, TO = "load_timestamp_utc_from", "load_timestamp_utc_to"


def _files(path):
    import os
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_intervals_in_order_and_late(spark, tmp_path):
    """Refreshes equal a rebuild; in-order loads leave closed rows as they are."""
    path = str(tmp_path / "iv")
    schema = f"symbol string, emp string, {FROM} timestamp_ntz"
    base = [(s, str(i), day(7 * i)) for s in ("X", "Y", None) for i in range(3)]

    def rebuilt(rows_):
        df = spark.createDataFrame(rows_, schema)
        w = Window.partitionBy("symbol").orderBy(FROM)
        return sorted(rows(df.withColumn(TO, F.lead(FROM).over(w))), key=str)

    def stored():
        return sorted(rows(star.read_intervals(spark, path).select("symbol", "emp", FROM, TO)), key=str)

    first = star.next_in_key(spark.createDataFrame(base, schema), "symbol", FROM, TO)
    star.write_intervals(first, path)
    assert stored() == rebuilt(base)
    closed = {f for f in _files(path) if "HIVE_DEFAULT" not in f}
    new = [("X", "3", day(21)), (None, "3", day(21)), ("Z", "0", day(21))]
    star.refresh_intervals_table(spark, path, spark.createDataFrame(new, schema), "symbol")
    assert stored() == rebuilt(base + new)
    assert closed <= _files(path)             # in order: closed rows untouched
    late = [("Y", "l", day(3)), ("Z", "1", day(30)), ("Y", "9", day(40))]
    star.refresh_intervals_table(spark, path, spark.createDataFrame(late, schema), "symbol")
    assert stored() == rebuilt(base + new + late)
    again = [("Y", "L", day(3)), ("Z", "1", day(30))]    # reloads: one changed, one equal
    star.refresh_intervals_table(spark, path, spark.createDataFrame(again, schema), "symbol")
    want = [r for r in base + new + late if r[:1] + r[2:] not in {x[:1] + x[2:] for x in again}] + again
    assert stored() == rebuilt(want)


def test_next_in_key_text_and_nan(spark):
    for kind, values in (("string", ["b", "a", "abcdefgh", "abcdefgi", None, "é"]),
                         ("double", [1.0, float("nan"), -2.0, None, float("inf"), 0.5])):
        df = spark.createDataFrame([(k, v) for k in ("A", "B") for v in values], f"k string, v {kind}")
        want = df.withColumn("n", F.lead("v").over(Window.partitionBy("k").orderBy("v")))
        got = star.next_in_key(df, "k", "v", "n", slices=3)
        assert sorted(map(str, rows(got.select("k", "v", "n")))) == sorted(map(str, rows(want)))


def test_fact_join_splits_a_hot_symbol(spark):
    """Half of the fact rows on one symbol: the final plan has a skew join on the fact side."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        comp, ind, sec, st = _dims(spark)
        sym = F.when(F.col("id") % 2 == 0, F.lit("A")).otherwise(F.concat(F.lit("s"), F.col("id") % 5000))
        daily = spark.range(400_000, numPartitions=8).select(sym.alias("symbol"), F.lit(day(20)).alias("load_timestamp_utc"),
                                            *[F.xxhash64("id", F.lit(c)).alias(c) for c in star.FACT_MEASURES[1:4]])
        weekly = spark.createDataFrame([("A", day(7), "Software", "Technology", "California")],
                                       "symbol string, load_timestamp_utc timestamp_ntz, company_industry string, "
                                       "company_sector string, company_state string")
        f = star.stock_fact(daily, weekly, comp, ind, sec, st, measures=star.FACT_MEASURES[:4])
        assert f.filter("company_id = 1 and state_id = 30").count() == 200_000
        f.write.format("noop").mode("overwrite").save()
        df = f.groupBy("company_id").count()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_half_a_million_cuts_are_planned_in_seconds(spark):
    """120,000 shuffle partitions, four slices each: the cuts are one value in the plan."""
    import time

    n = 480_000
    cuts = [float(i) for i in range(n)]
    t0 = time.perf_counter()
    df = spark.range(0, 2 * n, 7919).select("id", star.slice_index(F.col("id") - F.lit(1000.5), cuts).alias("s"))
    got = rows(df)
    assert time.perf_counter() - t0 < 20
    assert all(s == min(n, max(0, int(i - 1000.5) + 1 if i > 1000 else 0)) for i, s in got)


def test_slice_index_equals_a_count(spark):
    import random

    rng = random.Random(3)
    df = spark.createDataFrame([(float(i) / 2,) for i in range(-3, 900)] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    for size in (1, 5, 63, 64, 65, 130, 4096, 5000):
        cuts = sorted(rng.sample(range(6000), size))
        cuts = [c / 13 for c in cuts]
        for x, s in rows(df.select("x", star.slice_index(F.col("x"), cuts))):
            assert s == (0 if x is None else size if x != x else sum(c <= x for c in cuts)), (size, x)


def test_refresh_reads_only_days_from_the_late_rows_on(spark, tmp_path):
    """Closed days before the earliest late row are not read: they may be unreadable."""
    import glob

    path = str(tmp_path / "iv")
    at = lambda d, h=0: dt.datetime(2025, 1, d, h)
    first = spark.createDataFrame([(k, at(d), d) for k in ("A", "B") for d in range(1, 11)], "k string, load_timestamp_utc_from timestamp_ntz, v int")
    full = lambda rows_: star.next_in_key(rows_, "k", "load_timestamp_utc_from", "load_timestamp_utc_to")
    star.write_intervals(full(first), path)
    new = spark.createDataFrame([("A", at(6, 5), 60), ("A", at(11), 11), ("B", at(12), 12)], first.schema)
    for f in glob.glob(f"{path}/closed_on=2025-01-0[2-5]/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"PAR1 not a footer")
    star.refresh_intervals_table(spark, path, new, "k")
    want = [r for r in rows(full(first.unionByName(new))) if r[3] is None or r[3] >= at(6)]
    table = star._interval_table(spark, path, full(first).schema)
    assert sorted(rows(table.filter("closed_on is null or closed_on >= '2025-01-06'").drop("closed_on")), key=str) == sorted(
        want, key=str)
