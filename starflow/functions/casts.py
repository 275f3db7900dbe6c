"""Schema-driven casts from the all-text ingress layer to typed tables.

The type of each *target* column picks the cast: varchar(n) truncates to n
characters, numeric(p,s) rounds half-up and fails on overflow, timestamp
parses ISO text, json parses to a variant. ``strict`` keeps ANSI errors (as
the warehouse's ``::type`` casts do); ``lenient`` uses ``try_*`` forms and
records which columns failed so the rows can be routed to a reject table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Column as ColSpec
from ..schemas import TableSpec, spec_from_struct

CAST_ERRORS = "_cast_errors"
MODES = ("strict", "lenient")


def cast_to(src: Column, col: ColSpec, mode: str = "strict") -> Column:
    if mode not in MODES:
        raise ValueError(f"cast mode must be one of {MODES}, got {mode!r}")
    strict = mode == "strict"
    k = col.kind
    if k == "varchar":
        s = src.cast(T.StringType())
        return F.substring(s, 1, col.length) if col.length else s
    if k == "json":
        s = src.cast(T.StringType())
        return F.parse_json(s) if strict else F.try_parse_json(s)
    t = col.spark_type()
    return src.cast(t) if strict else src.try_cast(t)


def _as_spec(target: TableSpec | T.StructType) -> TableSpec:
    return target if isinstance(target, TableSpec) else spec_from_struct("target", target)


def schema_cast(df: DataFrame, target: TableSpec | T.StructType, mode: str = "strict",
                keep_extra: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``target``: columns matched by name, emitted in target order.

    In ``lenient`` mode a column ``_cast_errors`` (array of column names whose
    non-null text did not convert) is appended; see :func:`split_rejects`.
    """
    spec = _as_spec(target)
    missing = [c for c in spec.names if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    casts = [cast_to(F.col(c.name), c, mode).alias(c.name) for c in spec.columns]
    extra = [F.col(c) for c in keep_extra]
    if mode == "strict":
        return df.select(*casts, *extra)
    failed = [F.when(F.col(c.name).isNotNull() & cast_to(F.col(c.name), c, mode).isNull(),
                     F.lit(c.name)) for c in spec.columns]
    # dropping nulls of an array is not compiled by Spark: only for rows where something failed
    none = F.array().cast(T.ArrayType(T.StringType(), False))
    errors = F.when(F.concat_ws("", *failed) == "", none).otherwise(F.array_compact(F.array(*failed)))
    return df.select(*casts, *extra, errors.alias(CAST_ERRORS))


def split_rejects(cast_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, rejected rows with it)."""
    bad = F.size(F.col(CAST_ERRORS)) > 0
    return cast_df.filter(~bad).drop(CAST_ERRORS), cast_df.filter(bad)


def load_day(ts: Column | str) -> Column:
    """UTC start of day of a timestamp, kept as ``timestamp_ntz``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("day", c).cast(T.TimestampNTZType())


def load_day_text(ts: Column | str) -> Column:
    """Load day as ``YYYY-MM-DD HH:mm:ss`` text (the ingress form)."""
    return F.date_format(load_day(ts), "yyyy-MM-dd HH:mm:ss")


def snapshot_stamp(ts: Column | str) -> Column:
    """``YYYYMMDD-HHmmss`` stamp used in snapshot paths."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, "yyyyMMdd-HHmmss")
