import datetime as dt

import pytest

from starflow.operators import checks
from conftest import rows


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, None)], "a int, b string")
    assert dict(rows(checks.null_counts(df))) == {"a": 2, "b": 2}
    assert checks.not_null_failures(df, "a").count() == 2


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("A", 2), ("B", 1)], "s string, t int")
    assert rows(checks.duplicate_keys(df, ["s", "t"])) == [("A", 1, 2)]
    assert checks.duplicate_keys(df.filter("t = 2"), ["s", "t"]).count() == 0


def test_key_violations_and_assert(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), (None, 2)], "s string, t int")
    got = dict(rows(checks.key_violations(df, ["s", "t"])))
    assert got == {"null:s": 1, "null:t": 0, "duplicate_keys": 1, "duplicate_rows": 2}
    with pytest.raises(checks.KeyViolation):
        checks.assert_keys(df, ["s", "t"])
    checks.assert_keys(df.filter("s = 'A' and t = 1").limit(1), ["s", "t"])


def test_freshness(spark):
    df = spark.createDataFrame([("a", dt.datetime(2025, 1, 1, 12)), ("b", dt.datetime(2025, 1, 1, 1)),
                                ("c", dt.datetime(2024, 12, 30))], "g string, ts timestamp_ntz")
    out = checks.freshness(df, "ts", "2025-01-02 00:00:00", dt.timedelta(hours=12),
                           dt.timedelta(hours=24), ["g"])
    got = {r.g: (r.age_seconds, r.status) for r in out.collect()}
    assert got == {"a": (43200, "pass"), "b": (82800, "warn"), "c": (259200, "error")}
    empty = checks.freshness(df.filter("g = 'z'"), "ts", "2025-01-02", 1, 2)
    assert [r.status for r in empty.collect()] == ["error"]
