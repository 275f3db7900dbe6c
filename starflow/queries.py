"""Registered queries: one per operator of the inventory, each over whole tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise writes (loads, upserts, CSV round trips, streams) stage their tables
under the session's shared checkpoint folder and return the written result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from .functions import text as X
from .functions.casts import load_day, load_day_text, schema_cast
from .functions.frames import PayloadSchema, encode_frame, split_frames
from .operators import checks, load, star, tables
from .plans import ingest, marts, staging
from .schemas import SEED_SECTORS, SEED_STATES, Column, TableSpec
from .session import apply_defaults, workspace
from .sources import files
from .sources import pages as P
from .sources.csv import read_positional_csv, read_quoted_csv, read_seed, write_csv_snapshot
from .sources.tables import subset
from .streaming import trades

Query = Callable[[SparkSession, str], DataFrame]

# ------------------------------------------------------------------ star schema


def _weekly_model(spark, sf):
    """The weekly staging model, materialised once and partitioned by load time
    (as the staging layer is): the latest-snapshot filter then reads one
    partition, and the model is not recomputed for the scalar subquery."""
    return load.materialize(staging.stg_weekly(fx.weekly_from_orders(spark, sf)), "stg_weekly",
                            "table", path=workspace(spark, "stg-weekly"),
                            partition_by=["load_timestamp_utc"])


def star_fact(spark: SparkSession, sf: str) -> DataFrame:
    apply_defaults(spark)
    daily = staging.stg_daily(fx.daily_from_events(spark, sf))
    weekly = _weekly_model(spark, sf)
    return star.stock_fact(
        daily, weekly, fx.companies_dim(spark, sf), fx.industries_dim(spark),
        fx.sectors_dim(spark), fx.states_dim(spark, sf))


def latest_snapshot(spark, sf):
    apply_defaults(spark)
    w = _weekly_model(spark, sf)
    return star.latest_snapshot(w).select("symbol", "load_timestamp_utc", "company_industry",
                                         "company_sector", "company_state")


def surrogate_lookup(spark, sf):
    apply_defaults(spark)
    w = star.latest_snapshot(_weekly_model(spark, sf))
    return star.weekly_keys(w, fx.industries_dim(spark), fx.sectors_dim(spark),
                            fx.states_dim(spark, sf))


def scd_intervals(spark, sf):
    apply_defaults(spark)
    ev = fx.table(spark, sf, "events")
    weekly = ev.select(F.col("user_id").cast("string").alias("symbol"),
                       F.col("ts").alias("load_timestamp_utc"),
                       X.digits_only("props").alias("company_full_time_employees"))
    return marts.trf_employee_intervals(weekly, fx.companies_dim(spark, sf))


def dim_marts(spark, sf):
    """Customer → seed CSV with stray blanks → states dimension mart."""
    apply_defaults(spark)
    seed_dir = workspace(spark, "seed-states")
    c = fx.table(spark, sf, "customer")
    seed = c.select(F.col("c_custkey").alias("state_id"),
                    F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("state_symbol"),
                    F.concat(F.col("c_name"), F.lit(" ")).alias("state_name"))
    write_csv_snapshot(seed, seed_dir)
    return marts.dim_states(read_seed(spark, seed_dir, SEED_STATES))


def seed_dimension(spark, sf):
    """Part → seed CSV with stray blanks → sectors dimension."""
    apply_defaults(spark)
    seed_dir = workspace(spark, "seed-sectors")
    p = fx.table(spark, sf, "part")
    write_csv_snapshot(p.select(F.col("p_partkey").alias("sector_id"),
                                F.concat(F.lit(" "), F.col("p_name")).alias("sector_name")),
                       seed_dir)
    return marts.dim_sectors(read_seed(spark, seed_dir, SEED_SECTORS))


def _through_seed(spark, df, spec):
    folder = workspace(spark, "seed")
    write_csv_snapshot(df, folder)
    return read_seed(spark, folder, spec)


def dim_companies(spark, sf):
    """Customer → seed CSV → companies dimension mart."""
    return marts.dim_companies(_through_seed(spark, fx.companies_dim(spark, sf), T.StructType([
        T.StructField("company_id", T.LongType()), T.StructField("company_symbol", T.StringType()),
        T.StructField("company_name", T.StringType())])))


def dim_industries(spark, sf):
    """Supplier → seed CSV → industries dimension mart."""
    n = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("industry_id"), F.col("s_name").alias("industry_name"))
    return marts.dim_industries(_through_seed(spark, n, T.StructType([
        T.StructField("industry_id", T.LongType()), T.StructField("industry_name", T.StringType())])))


def dim_employees(spark, sf):
    """Employee-count dimension mart over the interval transform."""
    return marts.dim_employees_count(scd_intervals(spark, sf))


def fact_view(spark, sf):
    """The fact mart as a view, read by name."""
    marts.fact_stocks_view(star_fact(spark, sf), "fact_stocks")
    return spark.sql("SELECT * FROM fact_stocks WHERE company_id IS NOT NULL")


STAGED_BEFORE = "1997-01-01 00:00:00"


def stg_daily_incremental(spark, sf):
    """Incremental run of the daily model: rows past the newest one that is built."""
    ods = fx.daily_from_lineitem(spark, sf)
    before = F.lit(STAGED_BEFORE).cast(T.TimestampNTZType())
    return staging.stg_daily(ods, built=staging.stg_daily(ods.filter(F.col("load_timestamp_utc") < before)))


WEEKLY_BEFORE = "1997-01-01 00:00:00"
FACT_BEFORE = "2024-01-20 00:00:00"


def _incremental_run(spark, name, model, ods, before):
    """A model built from the even symbols' rows before a time, then run again over everything: the
    second run appends only rows past the newest one that is built, odd symbols' older rows are late."""
    path = workspace(spark, name)
    early = (F.col("load_timestamp_utc") < F.lit(before).cast(T.TimestampNTZType())) & (F.col("symbol").cast("int") % 2 == 0)
    load.write_table(model(ods.filter(early), None), path)
    built = spark.read.parquet(path)
    load.write_table(model(ods, built), path, "append")
    return spark.read.parquet(path)


def stg_weekly_incremental(spark, sf):
    """Two runs of the weekly model, the second one incremental."""
    return _incremental_run(spark, "stg-weekly-inc", lambda ods, built: staging.stg_weekly(ods, built=built),
                            fx.weekly_from_orders(spark, sf), WEEKLY_BEFORE)


def fact_incremental(spark, sf):
    """Two runs of the fact transform over the daily model, the second one incremental."""
    weekly = _weekly_model(spark, sf)
    dims = (fx.companies_dim(spark, sf), fx.industries_dim(spark), fx.sectors_dim(spark), fx.states_dim(spark, sf))
    return _incremental_run(spark, "fact-inc", lambda daily, built: marts.trf_fact_stocks(daily, weekly, *dims, built=built),
                            staging.stg_daily(fx.daily_from_events(spark, sf)), FACT_BEFORE)


# ------------------------------------------------------------------ cleaning


def stg_daily(spark, sf):
    apply_defaults(spark)
    return staging.stg_daily(fx.daily_from_lineitem(spark, sf))


def stg_weekly(spark, sf):
    apply_defaults(spark)
    return staging.stg_weekly(fx.weekly_from_customer(spark, sf))


def split_pair(spark, sf):
    d = fx.daily_from_lineitem(spark, sf)
    bp, bs = X.split_pair("bid", "x")
    ap, as_ = X.split_pair("ask", "x")
    lo, hi = X.split_pair("day_range", "-")
    return d.select("symbol", bp.alias("bid_price"), bs.alias("bid_size"), ap.alias("ask_price"),
                    as_.alias("ask_size"), lo.alias("day_range_low"), hi.alias("day_range_high"))


def date_range_parse(spark, sf):
    d = fx.daily_from_lineitem(spark, sf)
    lo, hi = X.date_range("earnings_date")
    return d.select("symbol", lo.alias("earnings_date_min"), hi.alias("earnings_date_max"))


def drop_suffix(spark, sf):
    d = fx.daily_from_lineitem(spark, sf)
    return d.select("symbol", X.drop_last_char("intraday_market_cap")
                    .alias("intraday_market_cap_trillions"))


def address_parts(spark, sf):
    w = fx.weekly_from_customer(spark, sf)
    a = X.address_parts("company_address")
    return w.select("symbol", a["street"].alias("company_street_address"),
                    a["city"].alias("company_city"), a["state"].alias("company_state"),
                    a["zip"].alias("company_zip_code"), a["country"].alias("company_country"))


def digits_only(spark, sf):
    w = fx.weekly_from_customer(spark, sf)
    return w.select("symbol", X.digits_only("company_phone_number").alias("company_phone_number"),
                    X.digits_only("company_full_time_employees")
                    .alias("company_full_time_employees"))


def strip_prefix(spark, sf):
    w = fx.weekly_from_customer(spark, sf)
    return w.select(
        "symbol",
        X.strip_literal("company_description", staging.DESCRIPTION_HEADING)
         .alias("company_description"),
        X.strip_literal("company_corporate_governance_score", staging.GOVERNANCE_HEADING)
         .alias("company_corporate_governance_score"))


def load_day_q(spark, sf):
    apply_defaults(spark)
    ev = fx.table(spark, sf, "events")
    return ev.select("event_id", load_day("ts").alias("load_timestamp_utc"),
                     load_day_text("ts").alias("load_day_text"))


def schema_cast_q(spark, sf):
    txt = fx.orders_text(spark, sf).withColumn("priority_rank", F.left("o_orderpriority", F.lit(1)))
    return schema_cast(txt, fx.CAST_SPEC, "strict")


# ------------------------------------------------------------------ loads


#: Buckets of the published tables in these queries.
BUCKETS = 16


def _typed_orders_path(spark, sf, name, pred, spec=fx.ORDERS_SPEC):
    path = workspace(spark, name)
    load.load(spark, "replace", fx.orders_text(spark, sf).filter(pred), path, spec, buckets=BUCKETS)
    return path


def csv_positional_scan(spark, sf):
    """Orders → CSV whose header names differ from the table's → positional read."""
    apply_defaults(spark)
    folder = workspace(spark, "csv")
    o = fx.table(spark, sf, "orders")
    out = o.select(
        F.col("o_orderkey").alias("c1"), F.col("o_custkey").alias("c2"),
        F.col("o_orderstatus").alias("c3"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("c4"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("c5"),
        F.concat(F.col("o_orderpriority"), F.lit(', "'), F.col("o_orderstatus"), F.lit('"'))
         .alias("c6"))
    write_csv_snapshot(out, folder)
    schema = T.StructType([
        T.StructField("orderkey", T.LongType()), T.StructField("custkey", T.LongType()),
        T.StructField("status", T.StringType()), T.StructField("totalprice", T.DecimalType(12, 2)),
        T.StructField("orderdate", T.TimestampNTZType()), T.StructField("priority_note", T.StringType()),
    ])
    return read_positional_csv(spark, folder, schema, timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
                               multiLine=False)  # no cell holds a line break


def csv_quoted_scan(spark, sf):
    """Orders → CSV with quotes and line breaks in its cells → read by blocks of the files."""
    folder = workspace(spark, "csv-quoted")
    o = fx.table(spark, sf, "orders")
    note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('",\n\n'), F.col("o_custkey").cast("string"))
    write_csv_snapshot(o.select("o_orderkey", note.alias("note"), "o_orderstatus"), folder)
    schema = T.StructType([T.StructField("orderkey", T.LongType()), T.StructField("note", T.StringType()),
                           T.StructField("status", T.StringType())])
    return read_quoted_csv(spark, folder, schema)


def truncate_load(spark, sf):
    """Load CSV A (every order), then truncate-load CSV B (keys not divisible by 3): only B remains."""
    apply_defaults(spark)
    a, b = workspace(spark, "csv-a"), workspace(spark, "csv-b")
    txt = fx.orders_text(spark, sf)
    write_csv_snapshot(txt, a)
    write_csv_snapshot(txt.filter(F.col("o_orderkey").cast("bigint") % 3 != 0), b)
    target = workspace(spark, "ingress-orders")
    load.truncate_load(spark, a, fx.ORDERS_SPEC, target, multiLine=False)
    load.truncate_load(spark, b, fx.ORDERS_SPEC, target, multiLine=False)
    return tables.read(spark, target)


def load_append(spark, sf):
    """Even keys, then keys divisible by 3 appended to a table without a declared key: keys in both
    stay twice."""
    apply_defaults(spark)
    key = F.col("o_orderkey").cast("bigint")
    path = _typed_orders_path(spark, sf, "append", key % 2 == 0, fx.ORDERS_LOG_SPEC)
    load.load(spark, "append", fx.orders_text(spark, sf).filter(key % 3 == 0), path, fx.ORDERS_LOG_SPEC)
    return tables.read(spark, path)


def append_keyed(spark, sf):
    """Odd keys appended to the even ones: the declared key is held against the stored keys of the
    buckets that the batch falls in."""
    apply_defaults(spark)
    key = F.col("o_orderkey").cast("bigint")
    path = _typed_orders_path(spark, sf, "append-keyed", key % 2 == 0)
    load.load(spark, "append", fx.orders_text(spark, sf).filter(key % 2 == 1), path, fx.ORDERS_SPEC)
    return tables.read(spark, path)


def load_replace(spark, sf):
    """Every order, replaced by the odd keys with their price raised: nothing else stays."""
    apply_defaults(spark)
    path = _typed_orders_path(spark, sf, "replace", F.lit(True))
    odd = fx.orders_text(spark, sf, price_bump=lambda p: p + 1).filter(F.col("o_orderkey").cast("bigint") % 2 == 1)
    load.load(spark, "replace", odd, path, fx.ORDERS_SPEC, buckets=BUCKETS)
    return tables.read(spark, path)


def _upsert_batches(spark, sf):
    key = F.col("o_orderkey").cast("bigint")
    first = fx.noted(fx.orders_text(spark, sf).filter(key % 2 == 0))
    raised = fx.orders_text(spark, sf, price_bump=lambda p: p + 1).filter(key % 4 == 0)
    second = fx.noted(fx.orders_text(spark, sf).filter((key % 2 == 1) | (key % 12 == 2))).unionByName(fx.noted(raised, days=400))
    return first, second


def _order_year():
    return {"order_year": F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))}


def _noted_rows(t):
    return t.select(*fx.ORDERS_SPEC.names, F.to_json("note").alias("note"), F.col("order_year").cast("int").alias("order_year"))


def upsert_merge(spark, sf):
    """Target: even keys. Source: odd keys (inserts), keys divisible by 4 with the price raised by 1
    (updates), of these keys divisible by 8 moved by 400 days, and keys with remainder 2 by 12
    unchanged. The table lies in buckets of its key; one json column."""
    apply_defaults(spark)
    first, second = _upsert_batches(spark, sf)
    path = workspace(spark, "upsert")
    tables.replace(spark, first, path, fx.NOTED_SPEC, derive=_order_year(), buckets=BUCKETS)
    tables.merge(spark, second, path, fx.NOTED_SPEC, derive=_order_year())
    return _noted_rows(tables.read(spark, path))


def upsert_partitioned(spark, sf):
    """The same merge into a parquet folder partitioned by order year, null for status P: rows move
    between partitions."""
    apply_defaults(spark)
    path = workspace(spark, "upsert-years")
    for batch in _upsert_batches(spark, sf):
        load.upsert(spark, batch, path, fx.NOTED_SPEC, partition_by=["order_year"], derive=_order_year())
    return _noted_rows(spark.read.parquet(path))


CUTOFF = "2000-01-01 00:00:00"


def incremental_append(spark, sf):
    """First run: even keys before 2000. Second run over every order appends only rows past the
    stored maximum: odd keys from before it come late and are left out."""
    apply_defaults(spark)
    typed = schema_cast(fx.orders_text(spark, sf), fx.ORDERS_SPEC)
    early = (F.col("o_orderdate") < F.lit(CUTOFF).cast(T.TimestampNTZType())) & (F.col("o_orderkey") % 2 == 0)
    path = workspace(spark, "incremental")
    load.incremental_append(spark, typed.filter(early), path, "o_orderdate")
    load.incremental_append(spark, typed, path, "o_orderdate")
    return spark.read.parquet(path)


def archive_load(spark, sf):
    """Two arrivals in a landing folder, each loaded and archived; the second load empties the table."""
    apply_defaults(spark)
    landing, archive, target, ck = (workspace(spark, n) for n in ("landing", "archive", "ingress", "ck-archive"))
    for rest in (0, 1):
        part = fx.orders_text(spark, sf).filter(F.col("o_orderkey").cast("bigint") % 2 == rest)
        part.write.mode("append").option("header", "true").option("escape", '"').csv(landing)
        files.archive_load(spark, landing, archive, ck, fx.ORDERS_SPEC.ingress_schema(), target, options={"multiLine": "false"})
    return files.read_loaded(spark, target, fx.ORDERS_SPEC.ingress_schema())


def newest_snapshot(spark, sf):
    """Snapshots of orders under one prefix, each of several parts: an older one, the newest whole
    one, and a newer one that was not finished. The newest whole one is loaded, with all its parts."""
    apply_defaults(spark)
    root = workspace(spark, "order-snapshots")
    txt, key = fx.orders_text(spark, sf), F.col("o_orderkey").cast("bigint")
    spread = lambda df: df.repartition(4, "o_orderkey")  # noqa: E731 - several parts
    write_csv_snapshot(spread(txt.filter(key % 5 == 0)), files.snapshot_folder(root, "daily", "20240101-190000"))
    write_csv_snapshot(spread(txt.filter(key % 3 != 0)), files.snapshot_folder(root, "daily", "20240102-190000"))
    spread(txt).write.option("header", "true").csv(files.snapshot_folder(root, "daily", "20240103-190000"))  # no marker
    return read_positional_csv(spark, files.newest_snapshot(spark, root), fx.ORDERS_SPEC, multiLine=False)


def refusals(spark, sf):
    """What must not be written is refused and leaves the table as it was: (case, outcome, rows_after)."""
    apply_defaults(spark)
    path = _typed_orders_path(spark, sf, "guarded", F.col("o_orderkey").cast("bigint") % 2 == 0)
    txt = fx.orders_text(spark, sf)
    doubled = txt.unionByName(txt)
    null_key = txt.withColumn("o_orderkey", F.lit(None).cast("string"))

    def run(name, op):
        try:
            op()
            outcome = "written"
        except (ValueError, checks.KeyViolation) as e:
            outcome = type(e).__name__
        return name, outcome, tables.read(spark, path).count()

    spec = fx.ORDERS_SPEC
    out = [run("append of stored keys", lambda: load.load(spark, "append", txt, path, spec)),
           run("replace by doubled keys", lambda: load.load(spark, "replace", doubled, path, spec)),
           run("upsert of doubled keys", lambda: load.load(spark, "upsert", doubled, path, spec)),
           run("append of null keys", lambda: load.load(spark, "append", null_key, path, spec)),
           run("unknown operation", lambda: load.load(spark, "update", txt, path, spec)),
           run("unknown scope", lambda: files.check_scope("monthly"))]
    return spark.createDataFrame(out, "case string, outcome string, rows_after long")


def high_water_filter(spark, sf):
    apply_defaults(spark)
    o = fx.table(spark, sf, "orders")
    stored = o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast(T.TimestampNTZType()))
    return load.high_water_filter(o, stored, "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_orderdate")


def symbol_list(spark, sf):
    """Customers of a comma-separated list of nations."""
    c = fx.table(spark, sf, "customer")
    return subset(c, "c_nationkey", "1, 3,5 ,,24").select("c_custkey", "c_name", "c_nationkey")


def symbol_subset(spark, sf):
    """Customers among the symbols active in the event stream (key list as a DataFrame)."""
    c = fx.table(spark, sf, "customer")
    keys = fx.table(spark, sf, "events").select("user_id")
    return subset(c, "c_custkey", keys).select("c_custkey", "c_name", "c_nationkey")


# ------------------------------------------------------------------ checks


def unique_check(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return checks.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def _nullable_lineitem(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif(F.col("l_suppkey"), F.lit(1)).alias("l_suppkey"),
                     F.nullif(F.col("l_returnflag"), F.lit("N")).alias("l_returnflag"),
                     "l_shipdate")


def not_null_check(spark, sf):
    return checks.null_counts(_nullable_lineitem(spark, sf))


def key_violations(spark, sf):
    li = checks.key_violations(_nullable_lineitem(spark, sf), ["l_orderkey", "l_linenumber"],
                               ["l_suppkey"]).withColumn("table_name", F.lit("lineitem"))
    o = checks.key_violations(fx.table(spark, sf, "orders"), ["o_orderkey"], ["o_custkey"]) \
        .withColumn("table_name", F.lit("orders"))
    return li.unionByName(o).select("table_name", "check", "violations")


FRESHNESS_NOW = "2024-01-31 00:00:00"


def freshness_check(spark, sf):
    apply_defaults(spark)
    ev = fx.table(spark, sf, "events")
    return checks.freshness(ev, "ts", FRESHNESS_NOW, warn_after=12 * 3600,
                            error_after=24 * 3600, group_cols=["event_type"])


# ------------------------------------------------------------------ pages

AD_RULE = P.AttrRule("ad_text", "div", "class", "ad")
TITLE_RULE = P.AttrRule("title", "h1")
THE_RULE = P.LabelRule("the_link", "a", None, "the")


def _pages(spark, sf):
    return fx.table(spark, sf, "pages")


def html_attr_extract(spark, sf):
    good, _ = P.split_rejects(P.extract_records(_pages(spark, sf), [AD_RULE]))
    return good


def html_label_extract(spark, sf):
    good, _ = P.split_rejects(P.extract_records(_pages(spark, sf), [THE_RULE]))
    return good


def html_record_extract(spark, sf):
    good, _ = P.split_rejects(P.extract_records(_pages(spark, sf), [TITLE_RULE, AD_RULE, THE_RULE]))
    return good


def html_rejects(spark, sf):
    """Pages blanked (ids divisible by 7) or lost (by 11) are rejected, the others go through."""
    html = F.when(F.col("page_id") % 11 == 0, F.lit(None)).when(F.col("page_id") % 7 == 0, F.lit(" ")).otherwise(F.col("html"))
    pg = _pages(spark, sf).select("page_id", html.alias("html"))
    _, bad = P.split_rejects(P.extract_records(pg, [TITLE_RULE, AD_RULE, THE_RULE]))
    return bad.select("page_id", "error")


def _marked_up(rule, value):
    """Markup in which ``rule`` finds ``value`` (a column)."""
    if isinstance(rule, P.AttrRule):
        attr = f' {rule.attribute}="{rule.value}"'
        if rule.tag == "fin-streamer":
            return F.concat(F.lit(f"<{rule.tag}{attr} data-value=\""), value, F.lit(f'">x</{rule.tag}>'))
        return F.concat(F.lit(f"<{rule.tag}{attr}> "), value, F.lit(f"</{rule.tag}>"))
    label = rule.label.replace("&", "&amp;")
    css = f' class="{rule.css_class}"'
    sib = f' class="{rule.sibling_class}"' if rule.sibling_class else ""
    return F.concat(F.lit(f"<li><{rule.tag}{css}> {label} </{rule.tag}><b>-</b><{rule.sibling_tag}{sib}>"), value,
                    F.lit(f"</{rule.sibling_tag}></li>"))


def _scope_rules(spark, sf, scope):
    rules = P.rules_for(scope)
    value = lambda r: F.concat(F.lit(f"{r.field}-"), F.col("page_id"), F.lit("-"), F.length("url"))
    page = F.concat(F.lit("<html><body><span>Bid</span>"), *[_marked_up(r, value(r)) for r in rules], F.lit("</body></html>"))
    good, _ = P.split_rejects(P.extract_records(_pages(spark, sf).select("page_id", page.alias("html")), rules))
    return good


def quote_rules(spark, sf):
    """All 15 rules of the quote page over pages marked up like it."""
    return _scope_rules(spark, sf, "daily")


def profile_rules(spark, sf):
    """All 9 rules of the profile page over pages marked up like it."""
    return _scope_rules(spark, sf, "weekly")


PAGE_SPEC = TableSpec(
    "pages_ods",
    (
        Column("symbol", "varchar", length=16, nullable=False),
        Column("load_timestamp_utc", "timestamp", nullable=False),
        Column("title", "varchar", length=65535),
        Column("ad_text", "varchar", length=65535),
        Column("the_link", "varchar", length=65535),
    ),
    key=("symbol", "load_timestamp_utc"),
)
INGEST_RUN_TS = "2024-01-07 19:00:00"


def page_ingest(spark, sf):
    """Pages → extracted records → CSV snapshot → ingress → typed, keyed ODS (run twice:
    the second run updates in place)."""
    apply_defaults(spark)
    root = workspace(spark, "snapshots")
    ingress, ods = workspace(spark, "ingress-pages"), workspace(spark, "ods-pages")
    pg = _pages(spark, sf)
    rules = [TITLE_RULE, AD_RULE, THE_RULE]
    for run in (INGEST_RUN_TS, "2024-01-07 21:30:00"):
        ingest.ingest_pages(spark, pg, rules, PAGE_SPEC, root, "daily", run, ingress, ods)
    return ingest.read_ods(spark, ods, PAGE_SPEC)


REFRESH_CUTOFF = "2024-01-20 00:00:00"


def scd_refresh(spark, sf):
    """Intervals built from events before a cutoff, then refreshed with the later events and with
    late ones held back from before it: must equal a full rebuild. Every fifth symbol has no
    company, so the table is refreshed by symbol."""
    apply_defaults(spark)
    ev = fx.table(spark, sf, "events")
    late = F.pmod(F.col("event_id"), F.lit(50)) == 0
    early = (ev["ts"] < F.lit(REFRESH_CUTOFF).cast(T.TimestampNTZType())) & ~late
    comp = fx.companies_dim(spark, sf).filter("company_id % 5 <> 0")
    path = workspace(spark, "intervals")

    def of(rows):
        return rows.select(F.col("user_id").cast("string").alias("symbol"), F.col("ts").alias("load_timestamp_utc"),
                           X.digits_only("props").alias("company_full_time_employees"))

    first = star.next_in_key(of(ev.filter(early)), "symbol", "load_timestamp_utc", "load_timestamp_utc_to")
    star.write_intervals(first.withColumnRenamed("load_timestamp_utc", "load_timestamp_utc_from"), path)
    new = of(ev.filter(~early)).withColumnRenamed("load_timestamp_utc", "load_timestamp_utc_from")
    star.refresh_intervals_table(spark, path, new, "symbol")
    w = star.lookup(star.read_intervals(spark, path), comp, "symbol", "company_symbol", ["company_id"])
    return w.select("symbol", "company_id", "company_full_time_employees", "load_timestamp_utc_from", "load_timestamp_utc_to")


# ------------------------------------------------------------------ stream


def frame_split(spark, sf):
    t = fx.trade_payload_json(fx.trade_fields(spark, sf))
    err = F.col("event_type") == "error"
    frames = t.select("event_id", encode_frame(
        F.lit(100000) + F.col("customer_id"), F.encode("payload_json", "UTF-8"),
    ).alias("good"), err.alias("is_err"))
    # error events carry a wrong first byte
    bad = F.concat(F.unhex(F.lit("01")), F.substring("good", 2, 2147483647))
    frames = frames.select("event_id", F.when(F.col("is_err"), bad).otherwise(F.col("good"))
                           .alias("value"))
    s = split_frames(frames, "value")
    return s.select("event_id", "magic", "schema_id",
                    F.decode("payload", "UTF-8").alias("payload"), "frame_error")


def _write_topic(spark, sf, folder, **how):
    fx.trade_topic_records(spark, sf, **how).write.mode("append").parquet(folder)


def stream_decode(spark, sf):
    """Topic files of two record shapes → stream → decoded trade fields (file sink, availableNow)."""
    apply_defaults(spark)
    topic, sink, ck = (workspace(spark, "topic"), workspace(spark, "decoded"),
                       workspace(spark, "ck-decode"))
    _write_topic(spark, sf, topic, two_shapes=True)
    src = trades.trade_source(spark, "parquet", topic)
    registry = {**trades.default_registry(), fx.VENUE_ID: PayloadSchema(fx.VENUE_SCHEMA)}
    dec = trades.decode_trades(src, registry)
    q = (dec.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).select(*trades.TEXT_COLUMNS, "record_json", "frame_error")


def stream_upsert(spark, sf):
    """Stream → keyed trades table; the query is stopped, the topic is sent again with corrections,
    older copies and unchanged rows, and the query is started from its checkpoint."""
    apply_defaults(spark)
    topic, table_path, rej, ck = (workspace(spark, "topic"), workspace(spark, "trades"),
                                  workspace(spark, "rejects"), workspace(spark, "ck-trades"))
    for change in (None, fx.replayed):
        _write_topic(spark, sf, topic, change=change)
        trades.run_trades(spark, trades.trade_source(spark, "parquet", topic), table_path, rej, ck, buckets=BUCKETS)
    return trades.read_trades(spark, table_path)


def _with_defaults(fn: Query) -> Query:
    """Apply the session settings the queries rely on (UTC etc.), whatever session calls."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        apply_defaults(spark)
        return fn(spark, sf)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


_QUERIES: dict[str, Query] = {
    "star_fact": star_fact,
    "latest_snapshot": latest_snapshot,
    "surrogate_lookup": surrogate_lookup,
    "scd_intervals": scd_intervals,
    "dim_marts": dim_marts,
    "seed_dimension": seed_dimension,
    "stg_daily": stg_daily,
    "stg_weekly": stg_weekly,
    "split_pair": split_pair,
    "date_range_parse": date_range_parse,
    "drop_suffix": drop_suffix,
    "address_parts": address_parts,
    "digits_only": digits_only,
    "strip_prefix": strip_prefix,
    "load_day": load_day_q,
    "schema_cast": schema_cast_q,
    "csv_positional_scan": csv_positional_scan,
    "csv_quoted_scan": csv_quoted_scan,
    "truncate_load": truncate_load,
    "load_append": load_append,
    "append_keyed": append_keyed,
    "load_replace": load_replace,
    "upsert_merge": upsert_merge,
    "upsert_partitioned": upsert_partitioned,
    "incremental_append": incremental_append,
    "high_water_filter": high_water_filter,
    "symbol_subset": symbol_subset,
    "unique_check": unique_check,
    "not_null_check": not_null_check,
    "key_violations": key_violations,
    "freshness_check": freshness_check,
    "html_attr_extract": html_attr_extract,
    "html_label_extract": html_label_extract,
    "html_record_extract": html_record_extract,
    "html_rejects": html_rejects,
    "page_ingest": page_ingest,
    "scd_refresh": scd_refresh,
    "frame_split": frame_split,
    "stream_decode": stream_decode,
    "stream_upsert": stream_upsert,
    "dim_companies": dim_companies,
    "dim_industries": dim_industries,
    "dim_employees": dim_employees,
    "fact_view": fact_view,
    "stg_daily_incremental": stg_daily_incremental,
    "stg_weekly_incremental": stg_weekly_incremental,
    "fact_incremental": fact_incremental,
    "symbol_list": symbol_list,
    "archive_load": archive_load,
    "newest_snapshot": newest_snapshot,
    "refusals": refusals,
    "quote_rules": quote_rules,
    "profile_rules": profile_rules,
}

QUERIES: dict[str, Query] = {k: _with_defaults(v) for k, v in _QUERIES.items()}
