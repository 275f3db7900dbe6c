"""Data checks: not-null, key uniqueness, declared-key violations, freshness.

Every check is one aggregation pass with map-side partial aggregation, so a
hot key is pre-combined in each task before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec


class KeyViolation(ValueError):
    """Raised when a write would break a declared key or NOT NULL column."""


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for each column, from a single pass."""
    cols = columns or df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast(T.LongType())).alias(c) for c in cols])
    wide = wide.select(*[F.coalesce(F.col(c), F.lit(0).cast(T.LongType())).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of a not-null test on one column."""
    return df.filter(F.col(column).isNull())


def duplicate_keys(df: DataFrame, key: list[str] | tuple[str, ...],
                   count_col: str = "count") -> DataFrame:
    """Keys that occur more than once, with their row count (``HAVING COUNT(*) > 1``)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def _key_summary_row(df: DataFrame, key, not_null=()) -> DataFrame:
    """One row: a column per violation kind, from a single aggregation.

    Rows are grouped by the key (map-side partial counts, one shuffle); the
    per-key counts and null counts then fold into one result row.
    """
    key = list(key)
    extra = [c for c in dict.fromkeys(not_null) if c not in key]
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.col(c).isNull().cast(T.LongType())).alias(f"__null_{c}") for c in extra])
    zero = F.lit(0).cast(T.LongType())
    cols = [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("__n"))), zero).alias(f"null:{c}")
            for c in key]
    cols += [F.coalesce(F.sum(f"__null_{c}"), zero).alias(f"null:{c}") for c in extra]
    cols += [F.count(F.when(F.col("__n") > 1, 1)).cast(T.LongType()).alias("duplicate_keys"),
             F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), zero).alias("duplicate_rows")]
    return per_key.agg(*cols)


def key_violations(df: DataFrame, key: list[str] | tuple[str, ...],
                   not_null: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(check, violations) rows: nulls per key/not-null column, duplicated key
    groups and the rows in them. All zeros means the key holds."""
    row = _key_summary_row(df, key, not_null)
    return row.unpivot([], row.columns, "check", "violations")


def spec_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    return key_violations(df, spec.key, spec.not_null)


def key_summary(df: DataFrame, key, not_null=()) -> dict[str, int]:
    """Violation counts as a dict (one small row reaches the driver)."""
    return {k: int(v or 0) for k, v in _key_summary_row(df, key, not_null).first().asDict().items()}


def assert_keys(df: DataFrame, key, not_null=()) -> None:
    """Raise :class:`KeyViolation` if ``df`` breaks the key or a NOT NULL column."""
    bad = {k: v for k, v in key_summary(df, key, not_null).items() if v > 0}
    if bad:
        detail = ", ".join(f"{k}={v}" for k, v in bad.items())
        raise KeyViolation(f"key {list(key)} violated: {detail}")


def _seconds(v) -> int:
    if isinstance(v, dt.timedelta):
        return int(v.total_seconds())
    return int(v)


def freshness(df: DataFrame, ts_col: str, now, warn_after, error_after,
              group_cols: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Age of the newest ``ts_col`` against warn/error limits.

    ``now`` is a parameter (a timestamp), so results are reproducible. Limits
    are ``timedelta`` or seconds. Output: group columns, ``max_loaded_at``,
    ``age_seconds``, ``status`` in ``pass``/``warn``/``error``.
    """
    warn_s, err_s = _seconds(warn_after), _seconds(error_after)
    now_col = F.lit(now).cast(T.TimestampNTZType())
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    agg = g.agg(F.max(ts_col).alias("max_loaded_at"))
    age = (F.unix_micros(now_col.cast(T.TimestampType()))
           - F.unix_micros(F.col("max_loaded_at").cast(T.TimestampType()))) / F.lit(1_000_000)
    agg = agg.withColumn("age_seconds", F.floor(age).cast(T.LongType()))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(F.col("age_seconds") > err_s, F.lit("error"))
              .when(F.col("age_seconds") > warn_s, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return agg.withColumn("status", status)
