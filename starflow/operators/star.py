"""Star-schema operators: latest snapshot, surrogate-key lookups, validity
intervals and the daily stock fact.

Join strategy: no hints. The planner broadcasts a dimension whose measured size
is under Spark's threshold, and AQE does so at run time. The fact side meets a
single join on its symbol, so that AQE's skew join can split a hot symbol.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_snapshot(df: DataFrame, ts_col: str = "load_timestamp_utc") -> DataFrame:
    """Rows at the single newest ``ts_col`` of the whole table.

    ``MAX`` is an uncorrelated scalar subquery evaluated once (partial + final
    aggregate), then a plain filter; rows of keys absent from that run are not
    carried forward.
    """
    return df.filter(F.col(ts_col) == df.select(F.max(ts_col)).scalar())


def lookup(left: DataFrame, dim: DataFrame, left_key: str, dim_key: str, take: list[str]) -> DataFrame:
    """Left outer equi lookup: natural key → dimension columns (null when unmatched)."""
    d = dim.select(F.col(dim_key).alias("__lk"), *take)
    return left.join(d, left[left_key] == d["__lk"], "left").drop("__lk")


def _slice_number(df: DataFrame, order_col: str):
    """The order column as a number whose order it follows (text: by its first seven bytes)."""
    dtype, oc = df.schema[order_col].dataType, F.col(f"`{order_col}`")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(oc.cast("timestamp")).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(oc).cast("double")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        lead7 = F.rpad(F.hex(F.substring(oc.cast("binary"), 1, 7)), 14, "0")
        return F.conv(lead7, 16, 10).cast("double")
    return oc.cast("double")


#: Values drawn: for each cut (a slice's share then varies by about a third), and at least.
DRAWN_A_CUT, LEAST_DRAWN = 8, 100_000


def slice_cuts(df: DataFrame, order_col: str, slices: int | None = None) -> list[float]:
    """Sorted cut points at quantiles of ``order_col``, ``slices`` or one per shuffle partition.

    The quantiles are those of a random draw of about ``DRAWN_A_CUT`` values a cut (30 MB for half a
    million cuts), which is all that reaches the driver; where cuts lie matters for balance only. Nulls and NaN are
    left out.
    """
    n = max(2, slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probe = df.select(_slice_number(df, order_col).alias("__o")).filter("__o is not null and not isnan(__o)")
    share = max(DRAWN_A_CUT * n, LEAST_DRAWN) / max(1, probe.count())
    drawn = probe.sample(share, seed=17) if share < 1 else probe
    values = sorted(drawn.toArrow()["__o"].to_pylist())
    cuts = {values[i * len(values) // n] for i in range(1, n)} if values else set()
    return sorted(c for c in cuts if c not in (float("-inf"), float("inf")))


#: Cuts compared at once by :func:`slice_index`.
FAN = 64


def slice_index(num, cuts: list[float]):
    """How many of the sorted ``cuts`` lie at or below ``num`` (null: 0; NaN: all).

    The cuts are one array value in the plan, however many they are, and so is every ``FAN``-th of
    them, and so on; the search goes down through ``FAN`` values a level with built-in functions.
    """
    if not cuts:
        return F.lit(0)
    num = F.coalesce(num.cast("double"), F.lit(float("-inf")))
    levels = [cuts]
    while len(levels[-1]) > FAN:
        levels.append(levels[-1][::FAN])
    found = None
    for level in reversed(levels):
        values = F.from_json(F.lit(json.dumps(level)), "array<double>")  # folded to one value
        if found is None:
            found = F.size(F.filter(values, lambda c: c <= num))
        else:
            start = F.greatest(found - 1, F.lit(0)) * FAN
            found = start + F.size(F.filter(F.slice(values, start + 1, FAN), lambda c: c <= num))
    return found.cast("int")


def time_slices(df: DataFrame, order_col: str, slices: int | None = None,
                slice_col: str = "__slice") -> DataFrame:
    """Add ``slice_col``: the row's slice of ``order_col`` at global quantiles.

    The slice is a function of the row's own value, so it is the same in every branch of a plan
    and on every retry. Nulls fall in the first slice (they order first), NaN in the last.
    """
    cuts = slice_cuts(df, order_col, slices)
    return df.withColumn(slice_col, slice_index(_slice_number(df, order_col), cuts))


# Slices per shuffle partition: hashed, several small ones even out.
SLICES_A_PARTITION = 4


def next_in_key(df: DataFrame, key: str, order_col: str, out_col: str,
                skew_safe: bool = True, slices: int | None = None) -> DataFrame:
    """``LEAD(order_col, 1) OVER (PARTITION BY key ORDER BY order_col)``.

    A plain window sends each key to one task, so a key holding a third of
    the rows would be one task. With ``skew_safe`` rows are cut into time
    slices (:func:`time_slices`). The lead is taken inside each
    ``(key, slice)``; the last row of a slice takes the first value of the
    key's next slice.
    """
    if not skew_safe:
        w = Window.partitionBy(key).orderBy(order_col)
        return df.withColumn(out_col, F.lead(order_col, 1).over(w))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = time_slices(df, order_col, slices or SLICES_A_PARTITION * n_parts)
    # null-safe key as plain columns, used alike by the window and the aggregate
    kdef = _type_default(df.schema[key].dataType)
    sliced = sliced.withColumns({"__kv": F.coalesce(F.col(key), kdef), "__kn": F.col(key).isNull()})
    part = ["__kv", "__kn", "__slice"]
    # first values come from the rows before the shuffle: one partial minimum a task, key and slice
    firsts = sliced.groupBy(*part).agg(F.min(order_col).alias("__first"))
    prior = Window.partitionBy("__kv", "__kn").orderBy("__slice")
    # a slice gets the first value of the key's next slice as an extra last row, dropped afterwards:
    # the rows cross one shuffle and meet no join
    extra = firsts.select("__kv", "__kn", F.lag("__slice").over(prior).alias("__slice"),
                          F.col("__first").alias(order_col), F.lit(True).alias("__extra")).filter("__slice is not null")
    both = sliced.withColumn("__extra", F.lit(False)).unionByName(extra, allowMissingColumns=True)
    w = Window.partitionBy(*part).orderBy("__extra", order_col)
    out = both.withColumn(out_col, F.lead(order_col, 1).over(w)).filter(~F.col("__extra"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], out_col)


def _type_default(dtype):
    """A non-null stand-in of the key's type (paired with an is-null flag)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(0).cast("timestamp").cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.BinaryType):
        return F.lit(b"")
    return F.lit(0).cast(dtype)


def employee_intervals(weekly: DataFrame, companies: DataFrame, skew_safe: bool = True,
                       keep_symbol: bool = False) -> DataFrame:
    """Employee-count dimension with validity intervals.

    ``load_timestamp_utc_to`` is the next load time of the same symbol (null on the newest row);
    the company id comes from a left lookup on symbol. ``keep_symbol`` keeps the symbol in front:
    a stored table is refreshed by it, as symbols without a company share the null id.
    """
    w = weekly.select("symbol", "load_timestamp_utc", "company_full_time_employees")
    w = next_in_key(w, "symbol", "load_timestamp_utc", "load_timestamp_utc_to", skew_safe)
    w = lookup(w, companies, "symbol", "company_symbol", ["company_id"])
    return w.select(*(["symbol"] if keep_symbol else []), "company_id", "company_full_time_employees",
                    F.col("load_timestamp_utc").alias("load_timestamp_utc_from"),
                    "load_timestamp_utc_to")


CLOSED_ON = "closed_on"


def _closed_on(to_col: str):
    return F.to_date(F.col(to_col))


def write_intervals(df: DataFrame, path: str, to_col: str = "load_timestamp_utc_to") -> str:
    """Store an interval table partitioned by the day its rows were closed on (open rows: null)."""
    from .load import write_table
    return write_table(df.withColumn(CLOSED_ON, _closed_on(to_col)), path, "overwrite", [CLOSED_ON])


def _interval_table(spark, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(CLOSED_ON, T.DateType())])).parquet(path)


def read_intervals(spark, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[c for c in df.columns if c != CLOSED_ON])


def refresh_intervals_table(spark, path: str, new_rows: DataFrame, key: str,
                            from_col: str = "load_timestamp_utc_from",
                            to_col: str = "load_timestamp_utc_to", skew_safe: bool = True) -> str:
    """Add ``new_rows`` (key, ``from_col``, attributes) to a stored interval table.

    Rows that come in order meet only the open row of their key: it is closed, and the closed row
    goes to the partition of that day; open rows are rewritten, one a key. Only keys with a late or
    reloaded row (not after their open row) have history recomputed, from their earliest new row on:
    intervals that end at or before it stay as they are, so only partitions from the least such day
    on are read (none, if nothing is late). Closed partitions
    are swapped in first and open rows last, so a run that failed in between can be repeated: it
    computes the same closed rows again and replaces them. The key may be null.
    """
    from ..session import remove_folder, workspace
    from .load import _in_range, null_safe_join, swap_partitions, write_table

    to_type = new_rows.schema[from_col].dataType
    fields = [f for f in new_rows.schema.fields] + [T.StructField(to_col, to_type)]
    cols = [f.name for f in fields]
    table = _interval_table(spark, path, T.StructType(fields))
    stage = workspace(spark, "new-rows")
    write_table(new_rows, stage)
    new = spark.read.schema(new_rows.schema).parquet(stage)
    touched = new.groupBy(key).agg(F.min(from_col).alias("__least"))
    open_rows = table.filter(F.col(CLOSED_ON).isNull())
    held = open_rows.alias("o").join(touched.alias("n"), F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")))
    late = held.filter(F.col(f"o.{from_col}") >= F.col("n.__least")).select(F.col(f"o.{key}").alias(key), "__least")
    old = held.select(*[F.col(f"o.{c}") for c in table.columns])
    since = late.agg(F.min(_closed_on("__least"))).first()[0]  # one value: the first day to read
    if since is not None:
        closed = table.filter(F.col(CLOSED_ON) >= F.lit(since)).alias("c").join(
            late.alias("l"), F.col(f"c.{key}").eqNullSafe(F.col(f"l.{key}")) & (F.col(f"c.{to_col}") > F.col("l.__least")))
        old = old.unionByName(closed.select(*[F.col(f"c.{c}") for c in table.columns]))
    was = workspace(spark, "old-intervals")
    write_table(old, was)
    old = spark.read.schema(old.schema).parquet(was)
    kept = null_safe_join(old, new, [key, from_col], "left_anti").select(*new.columns)  # a reload replaces
    redone = next_in_key(kept.unionByName(new), key, from_col, to_col, skew_safe).select(*cols)
    again = workspace(spark, "intervals")
    redone = redone.withColumn(CLOSED_ON, _closed_on(to_col))
    write_table(redone, again)
    redone = spark.read.schema(redone.schema).parquet(again)
    hit = old.select(CLOSED_ON).unionByName(redone.select(CLOSED_ON)).distinct()
    for some in (hit.filter(F.col(CLOSED_ON).isNotNull()), hit.filter(F.col(CLOSED_ON).isNull())):
        if some.isEmpty():
            continue
        table = _interval_table(spark, path, T.StructType(fields))  # as the swap before left it
        near = null_safe_join(_in_range(table, some, [CLOSED_ON]), some, [CLOSED_ON], "left_semi")
        # rows of recomputed intervals go, wherever an earlier run left them
        rest = null_safe_join(null_safe_join(near, old, [key, from_col], "left_anti"), redone, [key, from_col], "left_anti")
        rebuilt = rest.unionByName(null_safe_join(redone, some, [CLOSED_ON], "left_semi"))
        swap_partitions(spark, rebuilt, some, table, path, [CLOSED_ON])
    for folder in (stage, was, again):
        remove_folder(spark, folder)
    return path


STATE_MATCH = ("name", "name_or_symbol")


def weekly_keys(latest_weekly: DataFrame, industries: DataFrame, sectors: DataFrame,
                states: DataFrame, state_match: str = "name") -> DataFrame:
    """Resolve the latest weekly attributes to surrogate ids: (symbol, industry_id, sector_id, state_id).

    Done on the weekly side (one row per symbol) before it meets the fact, so
    the lookups touch companies, not fact rows. ``name_or_symbol`` matches the
    state name first and the two-letter symbol for the rest.
    """
    if state_match not in STATE_MATCH:
        raise ValueError(f"state_match must be one of {STATE_MATCH}")
    w = latest_weekly.select("symbol", "company_industry", "company_sector", "company_state")
    w = lookup(w, industries, "company_industry", "industry_name", ["industry_id"])
    w = lookup(w, sectors, "company_sector", "sector_name", ["sector_id"])
    w = lookup(w, states, "company_state", "state_name", ["state_id"])
    if state_match == "name_or_symbol":
        # a second equi lookup on the symbol for rows the name missed (an OR
        # join condition would force a nested-loop join)
        by_symbol = states.select("state_symbol", F.col("state_id").alias("__sid"))
        w = lookup(w, by_symbol, "company_state", "state_symbol", ["__sid"])
        w = w.withColumn("state_id", F.coalesce("state_id", "__sid")).drop("__sid")
    return w.select("symbol", "industry_id", "sector_id", "state_id")


# The fact's output columns.
FACT_MEASURES = [
    "load_timestamp_utc", "previous_close", "open_price", "bid_price", "bid_size", "ask_price",
    "ask_size", "day_range_low", "day_range_high", "volume", "avg_volume",
    "intraday_market_cap_trillions", "beta", "pe_ratio", "eps", "earnings_date_min",
    "earnings_date_max", "forward_dividend_and_yield", "ex_dividend_date",
    "one_year_target_estimate",
]
FACT_COLUMNS = ["company_id", "industry_id", "sector_id", "state_id"] + FACT_MEASURES


def stock_fact(daily: DataFrame, weekly: DataFrame, companies: DataFrame, industries: DataFrame,
               sectors: DataFrame, states: DataFrame, state_match: str = "name",
               measures: list[str] | None = None) -> DataFrame:
    """Daily fact rows with company, industry, sector and state surrogate ids.

    Every daily row is kept. Weekly attributes come from the one global latest
    weekly load (a symbol missing from it gets null industry/sector/state).
    """
    measures = measures or FACT_MEASURES
    wk = weekly_keys(latest_snapshot(weekly), industries, sectors, states, state_match)
    comp = companies.select(F.col("company_symbol").alias("__symbol"), "company_id")
    # one row a symbol from both sides, so that the fact is joined, and its hot symbols split, once
    keys = wk.join(comp, wk["symbol"] == comp["__symbol"], "full").select(
        F.coalesce("symbol", "__symbol").alias("symbol"), "company_id", "industry_id", "sector_id", "state_id")
    f = daily.select("symbol", *measures).join(keys, "symbol", "left")
    return f.select("company_id", "industry_id", "sector_id", "state_id", *measures)
