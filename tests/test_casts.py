import datetime as dt
from decimal import Decimal

import pytest

from starflow.functions.casts import load_day, load_day_text, schema_cast, split_rejects
from starflow.schemas import Column, TableSpec
from conftest import rows

SPEC = TableSpec("t", (Column("k", "varchar", length=4, nullable=False),
                       Column("n", "numeric", precision=5, scale=2),
                       Column("ts", "timestamp"), Column("i", "int")), key=("k",))


def src(spark, data):
    return spark.createDataFrame(data, "k string, n string, ts string, i string")


def test_strict_cast_rounds_half_up_and_truncates(spark):
    df = schema_cast(src(spark, [("abcdef", "1.005", "2025-01-02 03:04:05", "7"),
                                 ("x", "-2.345", "2025-01-02T00:00:00", None)]), SPEC)
    got = rows(df, ["k"])
    assert got[0] == ("abcd", Decimal("1.01"), dt.datetime(2025, 1, 2, 3, 4, 5), 7)
    assert got[1] == ("x", Decimal("-2.35"), dt.datetime(2025, 1, 2), None)
    assert df.columns == ["k", "n", "ts", "i"]


@pytest.mark.parametrize("bad", ["1,234.50", "--", "123456.00"])
def test_strict_cast_raises(spark, bad):
    with pytest.raises(Exception):
        schema_cast(src(spark, [("a", bad, None, None)]), SPEC).collect()


def test_strict_bad_timestamp_raises(spark):
    with pytest.raises(Exception):
        schema_cast(src(spark, [("a", None, "not a time", None)]), SPEC).collect()


def test_lenient_cast_routes_rejects(spark):
    df = schema_cast(src(spark, [("a", "1,234.50", "2025-01-01", "1"), ("b", "1.5", "bad", "x"),
                                 ("c", "2.5", None, "3")]), SPEC, "lenient")
    good, bad = split_rejects(df)
    assert rows(good.select("k", "n")) == [("c", Decimal("2.50"))]
    errs = {r.k: sorted(r._cast_errors) for r in bad.collect()}
    assert errs == {"a": ["n"], "b": ["i", "ts"]}


def test_missing_column_is_error(spark):
    with pytest.raises(ValueError):
        schema_cast(spark.createDataFrame([("a",)], "k string"), SPEC)


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        schema_cast(src(spark, [("a", None, None, None)]), SPEC, "loose")


def test_load_day(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 4, 22, 59, 1),)], "ts timestamp_ntz")
    r = df.select(load_day("ts").alias("d"), load_day_text("ts").alias("t")).first()
    assert r.d == dt.datetime(2025, 3, 4) and r.t == "2025-03-04 00:00:00"
    assert df.select(load_day("ts")).schema.fields[0].dataType.simpleString() == "timestamp_ntz"


def test_json_kind(spark):
    spec = TableSpec("j", (Column("j", "json"),))
    df = schema_cast(spark.createDataFrame([('{"a": 1}',), ("nope",)], "j string"), spec, "lenient")
    got = sorted((r._cast_errors for r in df.collect()), key=len)
    assert got == [[], ["j"]]
