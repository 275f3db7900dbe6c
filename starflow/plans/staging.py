"""Staging models: clean the typed daily and weekly tables.

Each model is one projection over its input (Catalyst collapses the chain of
column derivations into a single codegen'd ``Project``); incremental runs add
a high-water filter against the already-built model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.load import high_water_filter

# Output columns of the staging models.
STG_DAILY_COLUMNS = [
    "symbol", "load_timestamp_utc", "previous_close", "open_price", "bid_price", "bid_size",
    "ask_price", "ask_size", "day_range_low", "day_range_high", "volume", "avg_volume",
    "intraday_market_cap_trillions", "beta", "pe_ratio", "eps", "earnings_date_min",
    "earnings_date_max", "forward_dividend_and_yield", "ex_dividend_date",
    "one_year_target_estimate",
]

STG_WEEKLY_COLUMNS = [
    "symbol", "load_timestamp_utc", "company_name", "company_street_address", "company_city",
    "company_state", "company_zip_code", "company_country", "company_phone_number",
    "company_website", "company_sector", "company_industry", "company_full_time_employees",
    "company_description", "company_corporate_governance_score",
]

# Page headings stripped from the weekly profile text.
DESCRIPTION_HEADING = "Description   "
GOVERNANCE_HEADING = "Corporate Governance   "


def _incremental(src: DataFrame, built: DataFrame | None) -> DataFrame:
    if built is None:
        return src
    return high_water_filter(src, built, "load_timestamp_utc")


def stg_daily(ods_daily: DataFrame, built: DataFrame | None = None) -> DataFrame:
    """bid/ask → price and size; day range → low and high; earnings range → min
    and max date; market cap with its unit letter dropped."""
    d = _incremental(ods_daily, built)
    bid_p, bid_s = X.split_pair("bid", "x")
    ask_p, ask_s = X.split_pair("ask", "x")
    lo, hi = X.split_pair("day_range", "-")
    e_min, e_max = X.date_range("earnings_date", "-")
    return d.select(
        "symbol", "load_timestamp_utc", "previous_close", "open_price",
        bid_p.alias("bid_price"), bid_s.alias("bid_size"),
        ask_p.alias("ask_price"), ask_s.alias("ask_size"),
        lo.alias("day_range_low"), hi.alias("day_range_high"),
        "volume", "avg_volume",
        X.drop_last_char("intraday_market_cap").alias("intraday_market_cap_trillions"),
        "beta", "pe_ratio", "eps",
        e_min.alias("earnings_date_min"), e_max.alias("earnings_date_max"),
        "forward_dividend_and_yield", "ex_dividend_date", "one_year_target_estimate",
    )


def stg_weekly(ods_weekly: DataFrame, built: DataFrame | None = None) -> DataFrame:
    """Address → five parts; phone and employee count → digits; description and
    governance text without their page headings."""
    w = _incremental(ods_weekly, built)
    a = X.address_parts("company_address")
    return w.select(
        "symbol", "load_timestamp_utc", "company_name",
        a["street"].alias("company_street_address"),
        a["city"].alias("company_city"),
        a["state"].alias("company_state"),
        a["zip"].alias("company_zip_code"),
        a["country"].alias("company_country"),
        X.digits_only("company_phone_number").alias("company_phone_number"),
        "company_website", "company_sector", "company_industry",
        X.digits_only("company_full_time_employees").alias("company_full_time_employees"),
        X.strip_literal("company_description", DESCRIPTION_HEADING).alias("company_description"),
        X.strip_literal("company_corporate_governance_score", GOVERNANCE_HEADING)
         .alias("company_corporate_governance_score"),
    )


def market_cap_usd(c: str = "intraday_market_cap"):
    """Unit-aware market cap (T/B/M/K suffix) as a decimal, beside the reference's
    unit-blind column."""
    s = F.trim(F.col(c))
    unit = F.upper(F.right(s, F.lit(1)))
    num = F.left(s, F.length(s) - 1).try_cast("decimal(20,4)")
    mult = (F.when(unit == "T", F.lit(10 ** 12)).when(unit == "B", F.lit(10 ** 9))
             .when(unit == "M", F.lit(10 ** 6)).when(unit == "K", F.lit(10 ** 3)))
    return (num * mult).cast("decimal(24,2)")
