"""Bindings of the warehouse layouts to the driver's test tables.

The reference's inputs (scraped quote and profile pages, seeds, a trade
topic) do not exist here, so each layer is fed from the TPC-H-like tables in
a fixed, documented way (see FIXTURES.md §3). Each Spark binding has a DuckDB
twin in ``oracle.py`` that builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.casts import load_day
from .functions.frames import encode_frame
from .schemas import Column, TableSpec

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# TPC-H fixes nation at 25 rows and region at 5 at every scale factor.
NATION_ROWS = 25
REGION_ROWS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c, p=12, s=2):
    return F.col(c).cast(T.DecimalType(p, s)) if isinstance(c, str) else c.cast(T.DecimalType(p, s))


def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast(T.StringType())


# --------------------------------------------------------------------------- daily
def daily_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed daily-quote rows (companies_daily layout) from lineitem."""
    li = table(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate")
    d_pad = F.date_format(ship, "MMM dd, yyyy")
    d_plus5 = F.date_format(F.date_add(ship.cast(T.DateType()), 5), "MMM d, yyyy")
    return li.select(
        _s("l_orderkey").alias("symbol"),
        ship.alias("load_timestamp_utc"),
        _dec("l_extendedprice", 9, 2).alias("previous_close"),
        _dec("l_quantity", 9, 2).alias("open_price"),
        F.concat(_s(_dec("l_extendedprice")), F.lit(" x "), _s("l_partkey")).alias("bid"),
        F.concat(_s(_dec("l_tax", 4, 2)), F.lit("x"), _s("l_linenumber")).alias("ask"),
        F.concat(_s(_dec("l_discount", 4, 2)), F.lit(" - "), _s(_dec("l_tax", 4, 2))).alias("day_range"),
        _s("l_suppkey").alias("volume"),
        _s("l_partkey").alias("avg_volume"),
        F.concat(_s("l_linenumber"), F.lit("."), _s("l_suppkey"),
                 F.when(F.col("l_returnflag") == "A", F.lit("T")).otherwise(F.lit("B")))
         .alias("intraday_market_cap"),
        _dec("l_discount", 5, 2).alias("beta"),
        _dec("l_tax", 7, 2).alias("pe_ratio"),
        _dec("l_linenumber", 7, 2).alias("eps"),
        F.when(F.col("l_orderkey") % 3 == 0, d_pad)
         .otherwise(F.concat(d_pad, F.lit(" - "), d_plus5)).alias("earnings_date"),
        F.concat(F.col("l_returnflag"), F.lit(" ("), F.col("l_linestatus"), F.lit(")"))
         .alias("forward_dividend_and_yield"),
        F.date_format(ship, "MMM d, yyyy").alias("ex_dividend_date"),
        _dec("l_extendedprice", 9, 2).alias("one_year_target_estimate"),
    )


def daily_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed daily-quote rows from events, one per (user, day)."""
    ev = table(spark, sf_dir, "events")
    v = _dec("value")
    g = ev.groupBy(F.col("user_id"), load_day("ts").alias("load_timestamp_utc"))
    a = g.agg(
        F.min(v).alias("vmin"), F.max(v).alias("vmax"), F.sum(v).alias("vsum"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)).alias("clicks"),
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("purchases"),
        F.sum(F.when(F.col("event_type") == "view", 1).otherwise(0)).alias("views"),
        F.min("ts").alias("tmin"), F.max("ts").alias("tmax"),
    )  # numeric buffers only: a hash aggregate with partial aggregation
    return a.select(
        _s("user_id").alias("symbol"), "load_timestamp_utc",
        _dec("vmin", 9, 2).alias("previous_close"),
        _dec("vmax", 9, 2).alias("open_price"),
        F.concat(_s("vmin"), F.lit(" x "), _s("n")).alias("bid"),
        F.concat(_s("vmax"), F.lit(" x "), _s("clicks")).alias("ask"),
        F.concat(_s("vmin"), F.lit(" - "), _s("vmax")).alias("day_range"),
        _s("n").alias("volume"),
        _s("vsum").alias("avg_volume"),
        F.concat(_s("n"), F.lit("T")).alias("intraday_market_cap"),
        F.lit(None).cast(T.DecimalType(5, 2)).alias("beta"),
        F.lit(None).cast(T.DecimalType(7, 2)).alias("pe_ratio"),
        F.lit(None).cast(T.DecimalType(7, 2)).alias("eps"),
        F.concat(F.date_format("tmin", "MMM dd, yyyy"), F.lit(" - "),
                 F.date_format("tmax", "MMM dd, yyyy")).alias("earnings_date"),
        F.concat(_s("purchases"), F.lit(" purchases")).alias("forward_dividend_and_yield"),
        F.concat(_s("views"), F.lit(" views")).alias("ex_dividend_date"),
        _dec("vmax", 9, 2).alias("one_year_target_estimate"),
    )


# --------------------------------------------------------------------------- weekly
def _address(key, auto_city, nation_name):
    city = F.when(auto_city, F.lit("New Town")).otherwise(F.lit("Town"))
    return F.concat(_s(key), F.lit(" Main St, "), city, F.lit(" "), nation_name, F.lit(" "),
                    F.lpad(_s(key), 5, "0"), F.lit(" US"))


def weekly_from_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weekly-profile rows (companies_weekly layout), one per customer."""
    c = table(spark, sf_dir, "customer")
    n = F.broadcast(table(spark, sf_dir, "nation"))  # fixed 25 rows
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select(
        _s("c_custkey").alias("symbol"),
        F.lit("2024-01-07 00:00:00").cast(T.TimestampNTZType()).alias("load_timestamp_utc"),
        F.col("c_name").alias("company_name"),
        _address("c_custkey", F.col("c_mktsegment") == "AUTOMOBILE", F.col("n_name"))
         .alias("company_address"),
        F.concat(F.lit("+1 ("), _s(F.col("c_nationkey") + 100), F.lit(") 555-"), _s("c_custkey"))
         .alias("company_phone_number"),
        F.concat(F.lit("https://c"), _s("c_custkey"), F.lit(".example.com")).alias("company_website"),
        F.col("c_mktsegment").alias("company_sector"),
        F.col("n_name").alias("company_industry"),
        F.concat(_s("c_custkey"), F.lit(","), F.lpad(_s("c_nationkey"), 3, "0"), F.lit(" employees"))
         .alias("company_full_time_employees"),
        F.concat(F.lit("Description   "), F.col("c_name"), F.lit(" serves "), F.col("c_mktsegment"))
         .alias("company_description"),
        F.concat(F.lit("Corporate Governance   ISS score "), _s(_dec("c_acctbal")))
         .alias("company_corporate_governance_score"),
    )


def weekly_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed weekly-profile rows, one per (customer, order year): the year's highest
    priority and status, the customer's nation in the address.

    Orders are aggregated to (customer, year) before meeting customer, so the
    join sees one row per customer-year instead of one per order.
    """
    o = table(spark, sf_dir, "orders")
    agg = (o.groupBy("o_custkey",
                     F.date_trunc("year", F.col("o_orderdate")).cast(T.TimestampNTZType())
                      .alias("load_timestamp_utc"))
            .agg(F.max("o_orderpriority").alias("company_industry"),
                 F.max("o_orderstatus").alias("company_sector")))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = (agg.join(c, agg["o_custkey"] == c["c_custkey"])
            .join(n, F.col("c_nationkey") == n["n_nationkey"]))
    none = F.lit(None).cast(T.StringType())
    return j.select(
        _s("o_custkey").alias("symbol"), "load_timestamp_utc",
        F.col("c_name").alias("company_name"),
        _address("o_custkey", F.col("c_mktsegment") == "AUTOMOBILE", F.col("n_name"))
         .alias("company_address"),
        none.alias("company_phone_number"), none.alias("company_website"),
        "company_sector", "company_industry",
        none.alias("company_full_time_employees"), none.alias("company_description"),
        none.alias("company_corporate_governance_score"),
    )


# --------------------------------------------------------------------------- dims
# Fixed values of the inline lookups used by the fact bindings.
PRIORITY_INDUSTRIES = [(1, "1-URGENT"), (2, "2-HIGH"), (3, "3-MEDIUM"), (5, "5-LOW")]
STATUS_SECTORS = [(1, "F"), (2, "O")]


def companies_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("company_id"), _s("c_custkey").alias("company_symbol"),
                    F.col("c_name").alias("company_name"))


def industries_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRIORITY_INDUSTRIES, "industry_id int, industry_name string")


def sectors_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUS_SECTORS, "sector_id int, sector_name string")


def states_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("state_id"),
                    F.concat(F.lit("N"), _s("n_nationkey")).alias("state_symbol"),
                    F.col("n_name").alias("state_name"))


# --------------------------------------------------------------------------- orders
ORDERS_SPEC = TableSpec(
    "orders_ods",
    (
        Column("o_orderkey", "bigint", nullable=False),
        Column("o_custkey", "bigint"),
        Column("o_orderstatus", "varchar", length=1),
        Column("o_totalprice", "numeric", precision=12, scale=2),
        Column("o_orderdate", "timestamp"),
        Column("o_orderpriority", "varchar", length=15),
    ),
    key=("o_orderkey",),
)

# The same columns without a declared key: what is appended may repeat.
ORDERS_LOG_SPEC = TableSpec("orders_log", ORDERS_SPEC.columns)

# The upsert target: a json column, and partitions that move and may be null.
NOTED_SPEC = TableSpec("orders_noted", (*ORDERS_SPEC.columns, Column("note", "json")), key=("o_orderkey",))


def noted(orders: DataFrame, days: int = 0) -> DataFrame:
    """Text orders with a json note; ``days`` moves those whose key is divisible by 8."""
    moved = F.to_timestamp_ntz("o_orderdate") + F.make_dt_interval(
        F.when(F.col("o_orderkey").cast("bigint") % 8 == 0, F.lit(days)).otherwise(F.lit(0)))
    return orders.withColumns({
        "o_orderdate": F.date_format(moved, "yyyy-MM-dd HH:mm:ss"),
        "note": F.concat(F.lit('{"p":"'), F.col("o_orderpriority"), F.lit('"}'))})


# The cast demo target: decimal(9,2), int, timestamp, and a varchar(4) that truncates.
CAST_SPEC = TableSpec(
    "orders_cast",
    (
        Column("o_orderkey", "bigint", nullable=False),
        Column("o_custkey", "bigint"),
        Column("o_totalprice", "numeric", precision=9, scale=2),
        Column("o_orderdate", "timestamp"),
        Column("o_orderpriority", "varchar", length=4),
        Column("priority_rank", "int"),
    ),
    key=("o_orderkey",),
)


def orders_text(spark: SparkSession, sf_dir: str, price_bump=None) -> DataFrame:
    """Orders in the all-text ingress form (what a CSV load yields)."""
    o = table(spark, sf_dir, "orders")
    price = _dec("o_totalprice")
    if price_bump is not None:
        price = price_bump(price)
    return o.select(
        _s("o_orderkey").alias("o_orderkey"), _s("o_custkey").alias("o_custkey"),
        F.col("o_orderstatus"), _s(price).alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        F.col("o_orderpriority"),
    )


# --------------------------------------------------------------------------- trades
def trade_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade records from events, as the text fields of the stream value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"), F.col("event_type"),
        F.concat(F.lit("T"), _s("event_id")).alias("transaction_id"),
        F.col("user_id").cast(T.IntegerType()).alias("customer_id"),
        F.floor("value").cast(T.IntegerType()).alias("company_id"),
        (_dec("value") * 100).cast(T.IntegerType()).alias("volume_traded"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("transaction_timestamp_utc"),
    )


def trade_payload_json(df: DataFrame) -> DataFrame:
    """JSON text of each trade, assembled field by field (stable formatting)."""
    js = F.concat(
        F.lit('{"transaction_id":"'), F.col("transaction_id"),
        F.lit('","customer_id":'), _s("customer_id"),
        F.lit(',"company_id":'), _s("company_id"),
        F.lit(',"volume_traded":'), _s("volume_traded"),
        F.lit(',"transaction_timestamp_utc":"'), F.col("transaction_timestamp_utc"), F.lit('"}'))
    return df.withColumn("payload_json", js)


#: A second record shape: other order, no volume, a field of its own.
VENUE_SCHEMA = T.StructType([
    T.StructField("company_id", T.IntegerType()), T.StructField("transaction_id", T.StringType()),
    T.StructField("venue", T.StringType()), T.StructField("customer_id", T.IntegerType()),
    T.StructField("transaction_timestamp_utc", T.StringType()),
])
VENUE_ID = 3


def replayed(t: DataFrame) -> DataFrame:
    """The same trades once more: of three one is corrected a day later, one is an older copy with
    another volume, one is unchanged."""
    third = F.pmod("event_id", F.lit(3))
    days = F.when(third == 0, F.lit(1)).when(third == 1, F.lit(-1)).otherwise(F.lit(0))
    ts = F.to_timestamp_ntz("transaction_timestamp_utc") + F.make_dt_interval(days)
    volume = F.when(third == 0, F.col("volume_traded") + 1).when(third == 1, F.col("volume_traded") - 7)
    return t.withColumns({"transaction_timestamp_utc": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                          "volume_traded": F.coalesce(volume, F.col("volume_traded"))})


def trade_topic_records(spark: SparkSession, sf_dir: str, good_id: int = 1,
                        unknown_id: int = 2, change=None, two_shapes: bool = False) -> DataFrame:
    """Topic records (key, value, topic, partition, offset, timestamp) carrying
    framed trades; ``error`` events carry an id the registry does not know.
    ``change`` maps the trade fields first; with ``two_shapes`` every fourth
    trade is sent in the second record shape. The trades are dealt out by id, as a
    small file of events would make one task build the topic, and one file of it."""
    fields = trade_fields(spark, sf_dir).repartition("event_id")
    t = trade_payload_json(change(fields) if change else fields)
    sid = F.when(F.col("event_type") == "error", F.lit(unknown_id)).otherwise(F.lit(good_id))
    if two_shapes:
        other = F.to_json(F.struct("company_id", "transaction_id", F.lit("X").alias("venue"), "customer_id",
                                   "transaction_timestamp_utc"))
        fourth = F.pmod("event_id", F.lit(4)) == 0
        t = t.withColumn("payload_json", F.when(fourth, other).otherwise(F.col("payload_json")))
        sid = F.when(fourth & (F.col("event_type") != "error"), F.lit(VENUE_ID)).otherwise(sid)
    key = encode_frame(F.lit(good_id), F.encode(
        F.concat(F.lit('{"company_id":'), _s("company_id"), F.lit("}")), "UTF-8"))
    return t.select(
        key.alias("key"),
        encode_frame(sid, F.encode(F.col("payload_json"), "UTF-8")).alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit("2024-02-01 00:00:00").cast(T.TimestampType()).alias("timestamp"),
    )
