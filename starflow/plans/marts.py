"""Marts: dimension tables, the employee-count interval dimension and the fact view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import star


def dim_companies(seed: DataFrame) -> DataFrame:
    return seed.select("company_id", "company_symbol", "company_name")


def dim_industries(seed: DataFrame) -> DataFrame:
    return seed.select("industry_id", "industry_name")


def dim_sectors(seed: DataFrame) -> DataFrame:
    return seed.select("sector_id", "sector_name")


def dim_states(seed: DataFrame) -> DataFrame:
    return seed.select("state_id", "state_symbol", "state_name")


def dim_employees_count(trf: DataFrame) -> DataFrame:
    return trf.select("company_id", "company_full_time_employees",
                      "load_timestamp_utc_from", "load_timestamp_utc_to")


def trf_employee_intervals(stg_weekly: DataFrame, companies: DataFrame,
                           keep_symbol: bool = False) -> DataFrame:
    return star.employee_intervals(stg_weekly, companies, keep_symbol=keep_symbol)


def trf_fact_stocks(stg_daily: DataFrame, stg_weekly: DataFrame, companies: DataFrame,
                    industries: DataFrame, sectors: DataFrame, states: DataFrame,
                    built: DataFrame | None = None, **kw) -> DataFrame:
    """The fact transform; an incremental run takes daily rows past the built maximum."""
    d = stg_daily
    if built is not None:
        d = d.filter(F.col("load_timestamp_utc")
                     > built.select(F.max("load_timestamp_utc")).scalar())
    return star.stock_fact(d, stg_weekly, companies, industries, sectors, states, **kw)


def fact_stocks_view(trf: DataFrame, name: str = "fact_stocks") -> DataFrame:
    """The fact mart as a view: registered for SQL users, no data copied."""
    v = trf.select(*star.FACT_COLUMNS)
    v.createOrReplaceTempView(name)
    return v.sparkSession.table(name)
