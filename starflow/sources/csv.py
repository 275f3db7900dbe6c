"""CSV scans bound to a declared schema.

Columns bind by *position*: the header line is skipped and its names are
ignored (``enforceSchema``), exactly like ``COPY t (cols) FROM f WITH (FORMAT
csv, HEADER)``. Unquoted empty cells and ``""`` both read as null; ``""``
inside a quoted cell is an escaped quote; quoted cells may span lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableSpec

CSV_READ_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
}


def _schema(schema: TableSpec | T.StructType, text: bool) -> T.StructType:
    if isinstance(schema, TableSpec):
        return schema.ingress_schema() if text else schema.ods_schema()
    return schema


def read_positional_csv(spark: SparkSession, path: str | list[str],
                        schema: TableSpec | T.StructType, text: bool = True,
                        **options) -> DataFrame:
    """Read CSV file(s) binding columns by position to ``schema``.

    With a :class:`TableSpec` and ``text=True`` the all-text ingress layout is
    used (the typed cast happens later, see ``functions.casts``).
    """
    opts = dict(CSV_READ_OPTIONS)
    opts.update({k: str(v) for k, v in options.items()})
    return spark.read.schema(_schema(schema, text)).options(**opts).csv(path)


def _parity(text: F.Column) -> F.Column:
    """1 if the text has an odd number of quotes."""
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2


def _records(batches):
    """Lines of file blocks, in their order → records: whole ones, and the ends of those that a block
    boundary cuts (``begin``, ``middle``, ``end``), numbered within their block."""
    import pyarrow as pa

    names = ["file", "start", "seq", "kind", "record"]
    block, held, began_here, quoted, seq = None, [], True, False, 0
    out: list[tuple] = []

    def close():
        """The block ends: what is held goes on in the next one."""
        nonlocal held
        if block is not None and held:
            out.append((*block, seq, "begin" if began_here else "middle", "\n".join(held)))
        held = []

    def batch_of():
        columns = list(zip(*out)) if out else [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names)

    for batch in batches:
        for file, start, open_, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, start) != block:
                close()
                block, began_here, quoted, seq = (file, start), not open_, bool(open_), 0
            held.append(text)
            if text.count('"') % 2:
                quoted = not quoted
            if not quoted:
                out.append((*block, seq, "whole" if began_here else "end", "\n".join(held)))
                held, began_here, seq = [], True, seq + 1
        yield batch_of()
    close()
    yield batch_of()


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: TableSpec | T.StructType,
                    text: bool = True, **options) -> DataFrame:
    """As :func:`read_positional_csv` with ``multiLine``, but a file is read by as many tasks as it has
    blocks, also where quoted cells hold line breaks.

    A line break ends a record only outside of quotes, and a block cannot tell by itself whether it
    starts inside of them. Every block's number of quotes, odd or even, is counted first (a partial
    count, one row a block); the running parity of the blocks before says how a block starts. Then each
    block puts its lines together to records. A record that a block boundary cuts comes in pieces, which
    alone are shuffled and joined. Quotes must be balanced within a cell, as ``escape`` = ``quote`` has
    it; blank lines are skipped; line breaks in cells are kept as they are. The table of blocks is
    broadcast, so that lines stay in their order: about 100 MB for 100 TB in blocks of 128 MB.
    """
    opts = {k: v for k, v in CSV_READ_OPTIONS.items() if k in ("quote", "escape", "mode")}
    opts.update({k: str(v) for k, v in options.items()})
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "start").agg((F.sum(_parity(F.col("line"))) % 2).alias("odd"))
    blocks = blocks.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("open"))
    # one row a block: lines stay in their order and their tasks
    records = lines.join(F.broadcast(blocks), ["file", "start"]).select("file", "start", "open", "line").mapInArrow(
        _records, "file string, start long, seq long, kind string, record string")
    order = Window.partitionBy("file").orderBy("start", "seq")
    cut = records.filter("kind <> 'whole'").withColumn("n", F.sum((F.col("kind") == "begin").cast("long")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("start", "seq", "record")))
    joined = cut.groupBy("file", "n").agg(F.min(F.struct("start", "seq")).alias("at"),
                                          F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"))
    every = records.filter("kind = 'whole'").select("start", "seq", "record").unionByName(joined.select("at.start", "at.seq", "record"))
    if str(opts.get("header", CSV_READ_OPTIONS["header"])).lower() == "true":
        every = every.filter("start > 0 or seq > 0")
    body = F.regexp_replace("record", "\\r$", "")
    struct = _schema(schema, text)
    row = F.from_csv(body, _ddl(struct), opts)
    return every.filter(F.trim(body) != "").select(row.alias("r")).select(*[F.col(f"r.`{c}`") for c in struct.names])


def _ddl(struct: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)


def read_seed(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Seed CSV (comma, header) into a dimension table.

    Leading/trailing blanks are cut from the raw cells and from string values
    (seeds carry names with stray spaces); a byte-order mark is dropped by the
    reader itself.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = read_positional_csv(spark, path, raw, ignoreLeadingWhiteSpace="true",
                             ignoreTrailingWhiteSpace="true")
    return df.select(*[F.trim(F.col(f.name)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def write_csv_snapshot(df: DataFrame, folder: str) -> str:
    """Timestamped CSV snapshot with a header and no index column.

    Every task writes its own parts, of a bounded number of rows; readers take the folder. When all
    parts are there a marker beside the folder says so, with their number and the rows counted on
    their way (``files.newest_snapshot`` takes only snapshots with a marker that fits).
    """
    from .files import mark_complete

    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
       .write.mode("errorifexists").option("header", "true").option("maxRecordsPerFile", "1000000")
       .option("quote", '"').option("escape", '"').option("emptyValue", "")
       .csv(folder))
    mark_complete(df.sparkSession, folder, seen.get["rows"])
    return folder
