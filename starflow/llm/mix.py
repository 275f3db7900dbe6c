"""Mixing sources to target weights by systematic sampling.

Within a source every document is expected ``target / source_size`` times. These expected copies
are summed up along the documents, one random offset per source is added, and a document is
emitted once per integer boundary its interval crosses. Its copies thus differ from the expected
number by less than one, and so do the copies of any run of documents.

Documents of a source are ordered by size class (the size's five leading bits), then by a hash of
id and text. Each stretch of the order then holds similar sizes, which keeps the words taken near
the target. The order, and so the sample, depends on the rows alone, not on partitions.

Edge cases: a null text has size 0; a null source is a source of its own, the last one; sources of
size 0 have target 0 and their documents 0 copies; repeated rows are documents of their own; an
empty table gives an empty result. Input columns stay as they are under any name; what :func:`mix`
adds is one struct column, which replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, free_name, hash_block, named, numbered, ranked, read, safe_key

WORD = r"[^\x20\x09-\x0D]+"
#: Expected copies are kept in units of 2^-28, so that boundaries are counted in whole numbers.
UNIT_BITS = 28
UNIT = 1 << UNIT_BITS
#: Hex digits of the hash that orders documents (60 bits).
HASH_DIGITS = 15


def source_targets(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source: (__src_null, __src, __source_size, __target, __rate).

    ``sized`` has (__src_null, __src, __size). Sources by code point, null last, weigh ``weights``,
    repeating. They share all words by weight; a target stops at ``most`` times the source's size
    and the excess is shared by weight among the others, until none is above. Sorted by
    ``most * size / weight`` the stopped sources come first, so one pass of running sums finds
    them. One row per source is ordered in one place: that table is as long as there are sources.
    ``__rate`` is the expected copies of a document in units of 2^-28, rounded down.
    """
    big = "decimal(38,0)"
    s = sized.groupBy("__src_null", "__src").agg(F.sum("__size").alias("__source_size"))
    by_name = Window.orderBy("__src_null", "__src")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("__w", w.cast("long")).withColumn("__cap", F.col("__source_size") * most)
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("__cap").cast("double") / F.col("__w")), "__src_null", "__src")
    prior = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "__num": F.sum("__source_size").over(everything).cast(big)
        - F.coalesce(F.sum("__cap").over(prior), F.lit(0)).cast(big),
        "__den": F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(prior), F.lit(0)),
    })
    # stopped while cap / w < num / den; the first that isn't sets the rate of all that follow
    stopped = F.col("__cap").cast(big) * F.col("__den") < F.col("__w") * F.col("__num")
    s = s.withColumn("__stopped", stopped)
    free = F.min(F.when(~F.col("__stopped"), F.struct(
        F.lit(0) - F.col("__den"), F.col("__num"), F.col("__den")))).over(everything)
    s = s.withColumn("__free", free)
    target = F.when(F.col("__stopped"), F.col("__cap").cast("double")).otherwise(
        (F.col("__w") * F.col("__free")["__num"]).cast("double") / F.col("__free")["__den"].cast("double"))
    s = s.withColumn("__target", target)
    rate = F.least(F.floor(F.col("__target") / F.col("__source_size") * F.lit(float(UNIT))),
                   F.lit(most * UNIT))
    return s.select("__src_null", "__src", "__source_size", "__target",
                    F.when(F.col("__source_size") > 0, rate).otherwise(F.lit(0)).cast("long").alias("__rate"))


def offset(seed: int):
    """The source's random offset in units of 2^-28, from the seed and its name."""
    name = F.concat(F.lit(f"{seed}:"), F.col("__src_null").cast("int").cast("string"), F.lit(":"), F.col("__src"))
    return F.conv(F.substring(F.md5(name), 1, UNIT_BITS // 4), 16, 10).cast("long")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (1, 2, 3), most: int = 3, seed: int = 42, out: str = "mixed") -> DataFrame:
    """Every row of ``df`` with the struct ``out``: size, source_size, target, copies, taken words.

    A source holding a third of all rows is spread over its size classes and hash blocks; the
    counts per block are pre-aggregated and only they are summed up along the source.
    """
    d, names = numbered(df)
    text = F.coalesce(F.col(names[text_col]), F.lit(""))
    d = d.withColumns(
        {"__size": F.regexp_count(text, F.lit(WORD)).cast("long"), **safe_key(F.col(names[source_col]), "__src")})
    targets = source_targets(d.select("__src_null", "__src", "__size"), weights, most)
    digest = F.md5(F.concat(F.coalesce(F.col(names[id_col]).cast("string"), F.lit("")), F.lit(":"), text))
    bits = blocks_for(df.sparkSession)
    d = (d.withColumn("__h", F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long"))
          .withColumn("__rest", F.greatest(F.length(F.bin("__size")) - 5, F.lit(0)))
          .withColumn("__class", F.col("__rest") * 32 + F.expr("shiftright(__size, __rest)"))
          .withColumn("__block", hash_block(F.col("__h") * 8, bits))
          .drop("__rest"))
    part = ["__src_null", "__src"]
    d = ranked(d, part, ["__class", "__block"], ["__h", "__size"], "__rank").join(targets, part)
    r, i = F.col("__rate"), F.col("__rank") - 1
    low = F.pmod(offset(seed) + F.pmod(r, F.lit(UNIT)) * F.pmod(i, F.lit(UNIT)), F.lit(UNIT))
    d = d.withColumn("__copies", F.shiftright(low + r, UNIT_BITS))
    return d.select(*named(names, out), F.struct(
        F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), F.col("__copies").alias("copies"),
        (F.col("__copies") * F.col("__size")).alias("taken")).alias(out))


def draw(df: DataFrame, **how) -> DataFrame:
    """The mix itself: each document as many times as it is drawn, with its columns as they were."""
    name = free_name(df, "mixed")
    d, names = numbered(mix(df, out=name, **how))
    copies = F.col(f"{names[name]}.copies")
    taken = d.filter(copies > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return taken.select(*named(names, name))


def op1(spark, sf_dir: str) -> DataFrame:
    """Query ``op1_mix_sources``."""
    m = mix(read(spark, sf_dir, "documents"))
    return m.select("doc_id", "mixed.size", "mixed.source_size", "mixed.target", "mixed.taken")


ORACLE = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS h
  FROM documents),
srcs AS (SELECT source, sum(size)::HUGEINT AS s FROM docs GROUP BY source),
weighed AS (SELECT source, s, 3 * s AS cap,
                   1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w FROM srcs),
prior AS (
  SELECT *, sum(s) OVER () - coalesce(sum(cap) OVER o, 0) AS num, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS den
  FROM weighed
  WINDOW o AS (ORDER BY cap::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
free AS (SELECT num AS fnum, den AS fden FROM prior WHERE NOT cap * den < w * num ORDER BY den DESC LIMIT 1),
targets AS (
  SELECT source, s::BIGINT AS source_size,
         CASE WHEN cap * den < w * num THEN cap::DOUBLE ELSE (w * fnum)::DOUBLE / fden::DOUBLE END AS target,
         ('0x' || substr(md5('42:' || CASE WHEN source IS NULL THEN '1:' ELSE '0:' || source END), 1, 7))::BIGINT AS u
  FROM prior LEFT JOIN free ON true),
rates AS (
  SELECT *, CASE WHEN source_size > 0
                 THEN least(floor(target / source_size * 268435456.0)::BIGINT, 3 * 268435456) ELSE 0 END AS r
  FROM targets),
ranks AS (
  SELECT *, row_number() OVER (
    PARTITION BY source
    ORDER BY greatest(length(bin(size)) - 5, 0) * 32 + (size >> greatest(length(bin(size)) - 5, 0)), h, size) - 1 AS i
  FROM docs)
SELECT d.doc_id, d.size, t.source_size, t.target,
       ((((t.u + (t.r % 268435456) * (d.i % 268435456)) % 268435456) + t.r) >> 28) * d.size AS taken
FROM ranks d JOIN rates t ON d.source IS NOT DISTINCT FROM t.source
"""
