"""Token ids as Parquet list columns.

Format, version 1: a folder of Parquet files, documents in ascending id order over the files in
name order. Columns:

* ``doc_id``
* ``part`` int, ``part_start`` long: the range partition the document was written in, and the ids
  of that partition before it
* ``n_tokens`` long: ids of the document, its end id included
* ``ids`` list of int: dictionary-encoded (the vocabulary fits in one dictionary page), zstd

Row groups are cut at ``ROW_GROUP`` bytes and pages at ``PAGE`` bytes, and the writer adds page
indexes. A reader that filters on ``doc_id`` skips row groups and pages by their bounds, and one
that selects ``doc_id`` and ``n_tokens`` never touches ``ids``.

A document's place in the whole corpus (``start``) is ``part_start`` plus the ids of the parts
before; those sums, one a part, are added up when reading. No task sees more than its own range.

Edge cases: a null or empty text is the end id alone; null ids come first; rows of one id are
ordered by a hash of their text, equal rows any way; an empty table gives an empty result. Columns
besides id and text are not written.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, ship_package, workspace
from .tokens import VOCABULARY, encoder

END_ID = 0
ROW_GROUP = 32 << 20
PAGE = 256 << 10
FLUSH_IDS = 2_000_000


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 vocabulary: str = VOCABULARY) -> str:
    """Encode every text, append ``end_id``, and write the ids in ascending id order."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    id_arrow, end = to_arrow_type(id_type), array("I", [end_id]).tobytes()

    def encode(batches):
        from pyspark import TaskContext

        enc, part, at = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            first, ids, size = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                ids.append(enc.encode(text.as_py()) + end)
                size += len(ids[-1]) // 4
                if size >= FLUSH_IDS or i == batch.num_rows - 1:
                    n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    flat = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(ids)).cast(id_arrow), pa.array(np.full(len(n), part, np.int32)),
                         pa.array(at + np.cumsum(n) - n), pa.array(n), pa.ListArray.from_arrays(offsets, flat)],
                        ["doc_id", "part", "part_start", "n_tokens", "ids"])
                    at += int(n.sum())
                    first, ids, size = i + 1, [], 0

    d = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("t"))
    h = F.xxhash64("t")
    # the hash also parts an id that holds many rows
    d = d.repartitionByRange(F.col(id_col), h).sortWithinPartitions(F.col(id_col), h)
    out = d.mapInArrow(encode, f"doc_id {id_type.simpleString()}, part int, part_start long, n_tokens long, ids array<int>")
    (out.write.option("compression", "zstd").option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(ROW_GROUP)).option("parquet.page.size", str(PAGE)).parquet(path))
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files as written; select and filter to read columns, row groups and pages in part."""
    return spark.read.parquet(path)


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the ids as read."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(tokens.sparkSession)
    id_type = tokens.schema["doc_id"].dataType
    id_arrow = to_arrow_type(id_type)

    def crc(batches):
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_arrow), batch.column(1), batch.column(2),
                 pa.array(np.diff(at).astype(np.int64)), pa.array(crcs, pa.int64())],
                ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    rows = tokens.select("doc_id", "part", "part_start", "ids").mapInArrow(
        crc, f"doc_id {id_type.simpleString()}, part int, part_start long, n_tokens long, ids_crc32 long")
    # one row a part; its ids are a list of metadata columns only
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def op4(spark, sf_dir: str) -> DataFrame:
    """Query ``op4_token_files``."""
    path = write_tokens(read(spark, sf_dir, "documents"), workspace(spark, "tokens"))
    return digest(read_tokens(spark, path))
