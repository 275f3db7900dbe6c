"""File listing as a Spark job: newest file, newest complete snapshot, archive on load."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCOPES = ("daily", "weekly")


def list_files(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """(path, modificationTime, length) of every file under ``prefix``.

    The binary-file source lists in parallel and, with ``content`` pruned,
    never opens the files.
    """
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(prefix)
            .select("path", "modificationTime", "length"))


def newest_file(spark: SparkSession, prefix: str, glob: str = "*") -> str:
    """Path of the file with the greatest modification time under ``prefix``.

    Ties go to the first path in listing (lexical) order. Raises when the
    prefix holds no file. Only the single winning row reaches the driver.
    """
    top = (list_files(spark, prefix, glob)
           .orderBy(F.col("modificationTime").desc(), F.col("path").asc())
           .select("path").limit(1).collect())
    if not top:
        raise FileNotFoundError(f"no file under {prefix!r} matching {glob!r}")
    return top[0]["path"]


def check_scope(daily_or_weekly: str) -> str:
    s = (daily_or_weekly or "").lower()
    if s not in SCOPES:
        raise ValueError(f"invalid scope {daily_or_weekly!r}: must be 'daily' or 'weekly'")
    return s


def snapshot_folder(root: str, scope: str, stamp: str) -> str:
    """``{root}/{scope}/{stamp}`` — one folder per extraction run."""
    scope = check_scope(scope)
    return f"{root.rstrip('/')}/{scope}/{stamp}"


#: Sibling of a snapshot's folder that says the snapshot is whole.
MARKER = ".done"
_MARKER_TYPE = "parts long, rows long"


def mark_complete(spark: SparkSession, folder: str, rows: int) -> None:
    """Write the marker of a snapshot: how many parts it has and how many rows."""
    parts = list_files(spark, folder).count()
    spark.createDataFrame([(parts, rows)], _MARKER_TYPE).coalesce(1).write.json(folder.rstrip("/") + MARKER)


def snapshot_runs(spark: SparkSession, prefix: str) -> DataFrame:
    """(folder, parts, bytes, finished, complete) of every snapshot run under ``prefix``.

    A run is a folder of parts. It is complete if its marker is there and names as many parts as the
    listing finds (a run that is still written, or copied in part, is not). One listing; the only
    contents read are the markers'.
    """
    parent = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    files = list_files(spark, prefix).withColumn("folder", parent).filter(~F.col("folder").endswith(MARKER))
    runs = files.groupBy("folder").agg(F.count(F.lit(1)).alias("parts"), F.sum("length").alias("bytes"),
                                       F.max("modificationTime").alias("finished"))
    marks = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(prefix)
             .withColumn("folder", parent).filter(F.col("folder").endswith(MARKER))
             .select(F.regexp_replace("folder", r"\Q" + MARKER + r"\E$", "").alias("folder"),
                     F.from_json(F.decode("content", "UTF-8"), _MARKER_TYPE).alias("mark")))
    whole = F.coalesce(F.col("mark.parts") == F.col("parts"), F.lit(False))
    return runs.join(marks, "folder", "left").select("folder", "parts", "bytes", "finished", whole.alias("complete"))


def newest_snapshot(spark: SparkSession, prefix: str) -> str:
    """Folder of the newest complete snapshot under ``prefix``: all its parts are read with it.

    The newest is the one whose last part has the greatest modification time; ties go to the first
    folder in lexical order. Raises when no run is complete. Only the winning row reaches the driver.
    """
    top = (snapshot_runs(spark, prefix).filter("complete")
           .orderBy(F.col("finished").desc(), F.col("folder").asc()).select("folder").limit(1).collect())
    if not top:
        raise FileNotFoundError(f"no complete snapshot under {prefix!r}")
    return top[0]["folder"]


LOAD_EPOCH = "load_epoch"


def archive_load(spark: SparkSession, landing: str, archive: str, checkpoint: str, schema,
                 target_path: str, mode: str = "overwrite", fmt: str = "csv",
                 options: dict | None = None, files_per_batch: int | None = None) -> int:
    """Load the files that arrived in ``landing`` and move them to ``archive``.

    A file stream drained with ``availableNow``: every new file is read once (the checkpoint
    remembers which), written under ``target_path``, and moved under ``archive`` by Spark. A second
    run sees only files that arrived since. Returns the number of micro-batches written.

    The target is a published table (:mod:`..operators.tables`). A load writes each micro-batch into
    a folder of its own, under the load's name; a batch that is tried again replaces that folder.
    When all are in, one pointer publishes them, in ``overwrite`` mode in place of what was there:
    until then readers see the old rows. The load's name is noted beside the checkpoint before
    anything is written. A load that failed is resumed by the next run under the same name; a noted
    load that is published already is over, whether or not its note was removed. Read the table with
    :func:`read_loaded`.
    """
    from ..operators import tables
    from ..operators.load import open_table
    from ..session import remove_folder
    from .csv import CSV_READ_OPTIONS

    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    opts = dict(CSV_READ_OPTIONS) if fmt == "csv" else {}
    opts.update(options or {})
    reader = (spark.readStream.format(fmt).schema(schema).options(**opts)
              .option("cleanSource", "archive").option("sourceArchiveDir", archive))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    root, note = target_path.rstrip("/"), f"{checkpoint.rstrip('/')}-load"
    name_type = T.StructType([T.StructField("load", T.StringType())])
    noted = open_table(spark, note, name_type)
    name = max((r[0] for r in noted.collect()), default=None) if noted is not None else None  # one row
    old = tables.current(spark, root)
    if name and old and any(f.startswith(f"data/{name}/") for _, f in old.folders):
        name = None  # published; only its note was left
    if name is None:
        name = uuid.uuid4().hex
        spark.createDataFrame([(name,)], name_type).coalesce(1).write.mode("overwrite").parquet(note)
    batches: list[int] = []

    def write_batch(df, epoch_id):
        df.write.mode("overwrite").parquet(f"{root}/data/{name}/{LOAD_EPOCH}={epoch_id}")
        batches.append(epoch_id)

    q = (reader.load(landing).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    written = open_table(spark, f"{root}/data/{name}", T.StructType([T.StructField(LOAD_EPOCH, T.LongType())]))
    epochs = sorted(r[0] for r in written.distinct().collect()) if written is not None else []  # earlier tries' too
    if epochs or (batches and mode == "overwrite"):
        folders = [(0, f"data/{name}/{LOAD_EPOCH}={e}") for e in epochs]
        before = old.folders if old and mode == "append" else []
        tables.publish(spark, root, tables.Version(old.seq + 1 if old else 0, 1, [], schema, before + folders))
    remove_folder(spark, note)
    tables.prune(spark, root)
    return len(batches)


def read_loaded(spark: SparkSession, target_path: str, schema: T.StructType) -> DataFrame:
    """The rows of a table loaded by :func:`archive_load`."""
    from ..operators import tables

    return tables.read(spark, target_path).select(*schema.names)
