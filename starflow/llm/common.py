"""Helpers shared by the corpus operators."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, workspace

__all__ = ["read", "staged", "numbered", "named", "free_name", "blocks_for", "hash_block", "ranked", "safe_key", "components",
           "ship_package", "workspace"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its work is done once and a lost
    executor costs no recomputation."""
    path = workspace(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, ... (so that no name an operator adds can clash), and
    the new name of each old one. :func:`named` puts the names back."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def named(names: dict[str, str], leave_out: str | None = None) -> list[Column]:
    """The columns of :func:`numbered` under their own names."""
    return [F.col(n).alias(c) for c, n in names.items() if leave_out is None or c.lower() != leave_out.lower()]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def blocks_for(spark: SparkSession) -> int:
    """Bits of a hash that split a group holding a third of all rows into shares of a partition."""
    return (int(spark.conf.get("spark.sql.shuffle.partitions")) // 3).bit_length()


def hash_block(h: Column, bits: int) -> Column:
    """The leading ``bits`` of a 63-bit hash: blocks follow the order of the hash."""
    return F.shiftrightunsigned(h, 63 - bits)


def safe_key(c: Column, name: str) -> dict[str, Column]:
    """A text key that may be null, as two columns that never are: usable in any join."""
    return {f"{name}_null": c.isNull(), name: F.coalesce(c.cast("string"), F.lit(""))}


def ranked(df: DataFrame, part: list[str], block: list[str], order: list, out: str) -> DataFrame:
    """1-based rank of each row within ``part`` in the order of ``block``, then ``order``.

    A group is cut into its blocks: rows are counted per block before the shuffle, blocks get
    running totals, and only a block is sorted in one place. All of ``part`` and ``block`` must
    be non-null.
    """
    keys = [*part, *block]
    before = Window.partitionBy(*part).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inner = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return inner.join(sizes, keys).withColumn(
        out, F.col(out).cast("long") + F.col("__before")).drop("__before")


def components(links: DataFrame, a: str, b: str, max_rounds: int = 64) -> DataFrame:
    """Connected components of an undirected graph given by its links.

    Returns (node, component) for every node of a link; a component is its smallest node.
    Alternates the large-star and small-star steps (Kiveris and others, 2014): each node's
    neighbours are hung on the smallest one, so that a component becomes a star after about
    log(n) rounds. Rounds are written to the shared folder. Only a count reaches the driver.
    A node's neighbours are aggregated (``min``) and joined, never collected into a list; both sides
    of every join are read from files, so that adaptive execution splits the node in the middle of a
    large component over several tasks.
    """
    spark = links.sparkSession
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter(F.col("u") != F.col("v"))
    e = staged(e.distinct(), "links")
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written first: a join with an aggregate on its own key has no shuffle that could be split
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # large star: larger neighbours of u move to u's least neighbour
        large = (both.filter(F.col("v") > F.col("u")).join(least, "u")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        # small star: smaller neighbours of u, and u itself, move to the least of them
        large = staged(large, "large-star")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(low, "u")
        e2 = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))))
        e = staged(e2.filter(F.col("u") != F.col("v")).distinct(), "links")
        mark = e.agg(F.count(F.lit(1)), F.sum(F.col("u").cast("decimal(38,0)")),
                     F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if tuple(mark) == last:
            break
        last = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def settings(spark: SparkSession, **conf):
    """Set session settings inside a ``with`` block, then put back what was there."""
    return _Settings(spark, {k.replace("__", "."): str(v) for k, v in conf.items()})


class _Settings:
    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf = spark, conf

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


@functools.cache
def _letters():
    import numpy as np

    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def letters():
    """Table over code points: is it a letter."""
    return _letters()
