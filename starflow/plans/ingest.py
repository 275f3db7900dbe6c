"""Batch ingest: pages → extracted records → CSV snapshot → ingress → typed ODS.

``pages → extract (mapInPandas) → snapshot → positional scan → cast → upsert``;
every step is a Spark job over the whole input, and rejected pages are
returned as a DataFrame rather than stopping the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import snapshot_stamp
from ..operators import tables
from ..operators.load import materialize, truncate_load, upsert
from ..schemas import TableSpec
from ..session import workspace
from ..sources.csv import write_csv_snapshot
from ..sources.files import snapshot_folder
from ..sources.tables import subset
from ..sources.pages import Rule, extract_records, split_rejects


def extract_to_snapshot(pages: DataFrame, rules: Sequence[Rule], spec: TableSpec, root: str,
                        scope: str, run_ts: str, symbol: F.Column | None = None
                        ) -> tuple[str, DataFrame]:
    """Extract every page and write the good records as a timestamped CSV snapshot.

    Columns are written in the table's ordinal order (symbol, load time, then
    the rule fields), because the load binds them by position. Returns the
    snapshot folder and the rejected pages.
    """
    sym = symbol if symbol is not None else F.col("page_id").cast("string")
    src = pages.withColumn("__symbol", sym)
    # parsed once: good records and rejects are read from the staged result
    rec = extract_records(src, rules, keep=("__symbol",), load_ts=run_ts)
    good, bad = split_rejects(materialize(rec, "records", path=workspace(pages.sparkSession, "records")))
    fields = [r.field for r in rules]
    out = good.select(F.col("__symbol").alias(spec.names[0]),
                      F.date_format("load_timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias(spec.names[1]),
                      *fields)
    stamp = pages.sparkSession.range(1).select(
        snapshot_stamp(F.lit(run_ts).cast("timestamp_ntz"))).first()[0]
    folder = snapshot_folder(root, scope, stamp)
    write_csv_snapshot(out, folder)
    return folder, bad.select(F.col("__symbol").alias("symbol"), "error")


LOAD_DATE = "load_date"


def ingest_pages(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule], spec: TableSpec,
                 root: str, scope: str, run_ts: str, ingress_path: str, ods_path: str,
                 symbol: F.Column | None = None, symbols=None,
                 by_load_day: bool = True) -> tuple[str, DataFrame]:
    """The daily/weekly load: snapshot, truncate-load the ingress table, upsert the ODS.

    ``symbols`` (comma-separated text, list or DataFrame) restricts the run to
    those symbols, as a backfill does. With ``by_load_day`` the ODS is
    partitioned by the load date, so a run rewrites only the day it loads.
    Returns the ODS path and the rejected pages.
    """
    sym = symbol if symbol is not None else F.col("page_id").cast("string")
    pages = pages.withColumn("__sym", sym)
    if symbols is not None:
        pages = subset(pages, "__sym", symbols)
    folder, rejects = extract_to_snapshot(pages, rules, spec, root, scope, run_ts, F.col("__sym"))
    truncate_load(spark, folder, spec, ingress_path)
    derive = {LOAD_DATE: F.to_date(F.col(spec.names[1]))} if by_load_day else None
    upsert(spark, tables.read(spark, ingress_path), ods_path, spec,
           partition_by=[LOAD_DATE] if by_load_day else None, derive=derive)
    return ods_path, rejects


def read_ods(spark: SparkSession, ods_path: str, spec: TableSpec) -> DataFrame:
    """The ODS table in its declared column order (the load-date partition column dropped)."""
    return spark.read.parquet(ods_path).select(*spec.names)
