import datetime as dt

from pyspark.sql import functions as F

from starflow.functions import text as X
from starflow.plans import staging
from starflow.schemas import COMPANIES_DAILY, COMPANIES_WEEKLY
from starflow.functions.casts import schema_cast
from conftest import rows


def one_col(spark, values, name="s"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def test_split_pair_cases(spark):
    df = one_col(spark, ["1.5 x 200", "abc", "", None])
    p, s = X.split_pair("s", "x")
    assert rows(df.select("i", p, s), ["i"]) == [
        (0, "1.5", "200"), (1, "abc", ""), (2, "", ""), (3, None, None)]


def test_date_range_cases(spark):
    df = one_col(spark, ["Jul 31, 2025 - Aug 4, 2025", "Aug 04, 2025", "", None, "garbage"])
    lo, hi = X.date_range("s")
    got = rows(df.select("i", lo, hi), ["i"])
    assert got == [
        (0, dt.date(2025, 7, 31), dt.date(2025, 8, 4)),
        (1, dt.date(2025, 8, 4), None),
        (2, None, None),
        (3, None, None),
        (4, None, None),
    ]


def test_drop_last_char(spark):
    df = one_col(spark, ["3.1T", "500B", "", None])
    assert rows(df.select("i", X.drop_last_char("s")), ["i"]) == [
        (0, "3.1"), (1, "500"), (2, ""), (3, None)]


def test_address_parts(spark):
    df = one_col(spark, ["1 Apple Park Way, Cupertino CA 95014 United States",
                         "No comma here", "1 Main St, New York NY 10001 US", None])
    a = X.address_parts("s")
    got = rows(df.select("i", a["street"], a["city"], a["state"], a["zip"], a["country"]), ["i"])
    assert got[0] == (0, "1 Apple Park Way", "Cupertino", "CA", "95014", "United")
    assert got[1] == (1, "No comma here", "", "", "", "")
    # a two-word city shifts the later parts, as the reference does
    assert got[2] == (2, "1 Main St", "New", "York", "NY", "10001")
    assert got[3] == (3, None, None, None, "", "")


def test_digits_and_strip(spark):
    df = one_col(spark, ["(408) 996-1010", "164,000", "", None])
    assert rows(df.select("i", X.digits_only("s")), ["i"]) == [
        (0, "4089961010"), (1, "164000"), (2, ""), (3, None)]
    df2 = one_col(spark, ["Description   Apple designs", "no heading", None])
    assert rows(df2.select("i", X.strip_literal("s", "Description   ")), ["i"]) == [
        (0, "Apple designs"), (1, "no heading"), (2, None)]


def test_stg_daily_columns_and_values(spark):
    raw = spark.createDataFrame([{
        "symbol": "AAPL", "load_timestamp_utc": "2025-04-01 00:00:00", "previous_close": "222.13",
        "open_price": "221.32", "bid": "223.80 x 100", "ask": "223.95 x 200",
        "day_range": "220.56 - 225.02", "volume": "1,000", "avg_volume": "2,000",
        "intraday_market_cap": "3.353T", "beta": "1.18", "pe_ratio": "35.52", "eps": "6.30",
        "earnings_date": "Apr 30, 2025 - May 5, 2025", "forward_dividend_and_yield": "1.04 (0.47%)",
        "ex_dividend_date": "Feb 10, 2025", "one_year_target_estimate": "252.59"}])
    ods = schema_cast(raw, COMPANIES_DAILY)
    out = staging.stg_daily(ods)
    assert out.columns == staging.STG_DAILY_COLUMNS
    r = out.first()
    assert (r.bid_price, r.bid_size, r.ask_price, r.ask_size) == ("223.80", "100", "223.95", "200")
    assert (r.day_range_low, r.day_range_high) == ("220.56", "225.02")
    assert r.intraday_market_cap_trillions == "3.353"
    assert (r.earnings_date_min, r.earnings_date_max) == (dt.date(2025, 4, 30), dt.date(2025, 5, 5))


def test_stg_weekly_columns(spark):
    raw = spark.createDataFrame([{
        "symbol": "AAPL", "load_timestamp_utc": "2025-04-06 00:00:00", "company_name": "Apple Inc.",
        "company_address": "One Apple Park Way, Cupertino CA 95014 United States",
        "company_phone_number": "(408) 996-1010", "company_website": "https://www.apple.com",
        "company_sector": "Technology", "company_industry": "Consumer Electronics",
        "company_full_time_employees": "164,000",
        "company_description": "Description   Apple Inc. designs",
        "company_corporate_governance_score": "Corporate Governance   ISS rating 1"}])
    out = staging.stg_weekly(schema_cast(raw, COMPANIES_WEEKLY))
    assert out.columns == staging.STG_WEEKLY_COLUMNS
    r = out.first()
    assert (r.company_city, r.company_state, r.company_zip_code) == ("Cupertino", "CA", "95014")
    assert r.company_phone_number == "4089961010"
    assert r.company_full_time_employees == "164000"
    assert r.company_description == "Apple Inc. designs"
    assert r.company_corporate_governance_score == "ISS rating 1"


def test_market_cap_usd(spark):
    df = one_col(spark, ["3.1T", "500B", "12M", "", None])
    got = [r[1] for r in rows(df.select("i", staging.market_cap_usd("s")), ["i"])]
    assert [None if v is None else float(v) for v in got] == [3.1e12, 5e11, 1.2e7, None, None]
