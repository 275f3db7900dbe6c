"""Table scans by logical name and key-subset selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet folder/file by path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def parse_keys(keys: str | Iterable[str] | None) -> list[str]:
    """``'A,B, C'`` → ``['A', 'B', 'C']``; empty/None → ``[]`` (meaning all)."""
    if keys is None:
        return []
    if isinstance(keys, str):
        items = keys.split(",")
    else:
        items = list(keys)
    return [k.strip() for k in items if k is not None and k.strip() != ""]


def subset(df: DataFrame, key_col: str, keys: str | Iterable | DataFrame | None) -> DataFrame:
    """Rows whose ``key_col`` is among ``keys``; no keys means every row.

    A list becomes a table of keys; both forms are a left-semi join, whose strategy (broadcast or
    shuffle) Spark picks from the key side's measured size.
    """
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias("__k"))
        return df.join(k, df[key_col] == k["__k"], "left_semi")
    items = parse_keys(keys)
    if not items:
        return df
    kdf = df.sparkSession.createDataFrame([(i,) for i in items], T.StructType([T.StructField("__k", T.StringType())]))
    kdf = kdf.select(F.col("__k").cast(df.schema[key_col].dataType).alias("__k"))
    return df.join(kdf, df[key_col] == kdf["__k"], "left_semi")
