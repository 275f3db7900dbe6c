"""Load operations: truncate-load, append, replace, keyed upsert, incremental.

Targets are published tables in buckets of their key (:mod:`.tables`), or parquet folders, optionally
partitioned. Parquet has no MERGE: the upsert of a folder stages the batch, finds the target rows of its keys in one join, rebuilds
only the partitions that hold a changed key and swaps them in, then appends the
rest. The swap is not atomic across partitions: after a failed run, running the
same batch again gives the whole table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import schema_cast
from ..schemas import TableSpec
from ..session import remove_folder, workspace
from ..sources.csv import read_positional_csv, read_quoted_csv
from . import tables
from .checks import KeyViolation, assert_keys

OPERATIONS = ("append", "replace", "upsert")


def open_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path`` with its declared schema, or None if there is no such folder.

    Only a missing path counts as absent: an empty folder is an empty table, and any other error
    (a denied listing, a throttled store) is raised, as is an unreadable file once rows are read.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, only_present_partitions: bool = False,
                rebalance: bool = True) -> str:
    """Materialise ``df`` as a parquet table (``overwrite`` = rebuild, ``append``).

    ``only_present_partitions`` turns an overwrite into a replacement of just
    the partitions ``df`` holds (dynamic partition overwrite, set on this write
    only); otherwise an overwrite empties the whole table first. ``rebalance``
    may be turned off when ``df`` is read from files already laid out one
    partition per file.
    """
    if partition_by and rebalance:
        # Without this every task writes a file into every partition it holds
        # (tasks x partitions small files). The rebalance hint lets AQE size the
        # write tasks per partition: a hot partition is split over several
        # tasks, small ones are merged.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
        w = w.option("partitionOverwriteMode", "dynamic" if only_present_partitions else "static")
    w.parquet(path)
    return path


def truncate_load(spark: SparkSession, csv_path: str | list[str], spec: TableSpec,
                  target_path: str, **options) -> str:
    """Empty the ingress table and load CSV files into it, columns by position, as one step.

    The rows are written aside and published (:mod:`.tables`): readers (``tables.read``) see the old
    rows until all new ones are there. Columns declared NOT NULL are checked on the way. ``options``
    go to the reader, e.g. ``multiLine=False`` where no cell holds a line break; otherwise quoted
    line breaks are found over blocks of the files (``csv.read_quoted_csv``).
    """
    plain = str(options.get("multiLine", True)).lower() == "false"
    options = {k: v for k, v in options.items() if k != "multiLine"}
    if plain:
        df = read_positional_csv(spark, csv_path, spec, text=True, multiLine=False, **options)
    else:
        df = read_quoted_csv(spark, csv_path, spec, text=True, **options)
    tables.replace(spark, df, target_path, spec, key=(), cast_mode=None)
    return target_path


def _same(a: str, b: str, cols: Iterable[str]) -> Column:
    """Null-safe equality of columns on two aliased sides."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Semi or anti join on ``cols``; nulls match nulls."""
    on = _same("__l", "__r", cols)
    return left.alias("__l").join(right.select(*cols).distinct().alias("__r"), on, how)


def swap_partitions(spark: SparkSession, rebuilt: DataFrame, hit: DataFrame, target: DataFrame,
                    target_path: str, parts: list[str]) -> None:
    """Replace the partitions named in ``hit`` by the rows of ``rebuilt``.

    A plan cannot overwrite the folder it reads, so the result is staged first; dynamic overwrite
    then replaces the partitions it holds. Partitions of ``hit`` that no row is left in are
    deleted. The staged copy is removed at the end.
    """
    stage = workspace(spark, "stage")
    write_table(rebuilt, stage, "overwrite", parts)
    # explicit schema: an empty result leaves no data file to infer from
    staged = spark.read.schema(rebuilt.schema).parquet(stage).select(*rebuilt.columns)
    emptied = null_safe_join(hit.select(*parts), staged, parts, "left_anti")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    gone = null_safe_join(target.withColumn("__folder", folder), emptied, parts, "left_semi")
    folders = [r[0] for r in gone.select("__folder").distinct().toLocalIterator()]  # one each emptied partition
    write_table(staged, target_path, "overwrite", parts, only_present_partitions=True, rebalance=False)
    for f in folders:
        remove_folder(spark, f, encoded=True)
    remove_folder(spark, stage)


def _rebuild_all(spark: SparkSession, result: DataFrame, target_path: str) -> None:
    stage = workspace(spark, "stage")
    write_table(result, stage, "overwrite")
    write_table(spark.read.schema(result.schema).parquet(stage), target_path, "overwrite")
    remove_folder(spark, stage)


def _in_range(target: DataFrame, src: DataFrame, parts: list[str]) -> DataFrame:
    """Target partitions between the batch's lowest and highest value of each partition column
    (null partitions if it holds nulls). Two values a column reach the plan."""
    aggs = [f(c).alias(f"{n}_{c}") for c in parts for n, f in (("lo", F.min), ("hi", F.max))]
    aggs += [F.max(F.col(c).isNull()).alias(f"null_{c}") for c in parts]
    seen = src.agg(*aggs).first()
    for c in parts:
        kind = src.schema[c].dataType
        within = F.lit(False)
        if seen[f"lo_{c}"] is not None:
            within = F.col(c).between(F.lit(seen[f"lo_{c}"]).cast(kind), F.lit(seen[f"hi_{c}"]).cast(kind))
        if seen[f"null_{c}"]:
            within = within | F.col(c).isNull()
        target = target.filter(within)
    return target


def upsert(spark: SparkSession, source: DataFrame, target_path: str, spec: TableSpec,
           key: list[str] | tuple[str, ...] | None = None, partition_by: list[str] | None = None,
           check: bool = True, cast_mode: str = "strict",
           derive: dict | None = None, skip_unchanged: bool = True,
           newer: str | None = None) -> str:
    """Keyed merge: matched keys take every column from the cast source, new keys are inserted.

    1. The source is cast to the target layout and staged: it is read once.
    2. Null or duplicated source keys are refused (a MERGE could not pick a row).
    3. One join finds the target's rows of these keys, with their partition and whether all
       columns are equal. If the partition columns are part of the key, only partitions within the
       batch's range are read; otherwise keys are matched across the whole table.
    4. Partitions that hold an older version are rebuilt and swapped in, also when the new version
       belongs to another partition. All other rows are appended afterwards, so a batch of new keys
       is a plain append.

    A matched row equal to its source row is left alone (``skip_unchanged``). With ``newer`` a
    source row changes a stored one only if its value of that column is not below the stored one.
    ``derive`` adds computed columns after the cast (e.g. a partition column from a timestamp).
    Without partitions a changed key rebuilds the whole table.
    """
    key = list(key or spec.key)
    if not key:
        raise ValueError("upsert needs a key")
    cast = schema_cast(source, spec, cast_mode)
    if derive:
        cast = cast.withColumns(derive)
    batch = workspace(spark, "batch")
    write_table(cast, batch, "overwrite")
    src = spark.read.schema(cast.schema).parquet(batch)
    try:
        if check:
            assert_keys(src, key, spec.not_null)
        target = open_table(spark, target_path, cast.schema)
        if target is None:
            write_table(src, target_path, "append", partition_by)  # never replaces anything
        else:
            _merge_into(spark, src, target, target_path, key, list(partition_by or []), skip_unchanged, newer)
    finally:
        remove_folder(spark, batch)
    return target_path


def _merge_into(spark: SparkSession, src: DataFrame, target: DataFrame, target_path: str,
                key: list[str], parts: list[str], skip_unchanged: bool, newer: str | None) -> None:
    scope = _in_range(target, src, parts) if parts and set(parts) <= set(key) else target
    flat = {f.name: F.to_json for f in src.schema if isinstance(f.dataType, T.VariantType)}
    as_key = lambda side, c: flat.get(c, lambda x: x)(F.col(f"{side}.{c}"))  # noqa: E731 - a variant has no equality
    equal = F.lit(skip_unchanged)
    for c in src.columns:
        if c not in key:
            equal = equal & as_key("s", c).eqNullSafe(as_key("t", c))
    stale = F.lit(False)
    if newer:
        stale = F.coalesce(F.col(f"s.{newer}") < F.col(f"t.{newer}"), F.col(f"s.{newer}").isNull() & F.col(f"t.{newer}").isNotNull())
    found = (scope.alias("t").join(src.alias("s"), _same("s", "t", key))
             .select(*[F.col(f"s.{c}").alias(c) for c in key], *[F.col(f"t.{c}").alias(f"__old_{c}") for c in parts],
                     (equal | stale).alias("__keep")))
    at = workspace(spark, "matches")
    write_table(found, at, "overwrite")
    found = spark.read.schema(found.schema).parquet(at)
    per_key = found.groupBy(*key).agg((F.min("__keep") & (F.count(F.lit(1)) == 1)).alias("__keep"))
    fresh = null_safe_join(src, per_key.filter("__keep"), key, "left_anti")  # new and changed rows
    changed = per_key.filter(~F.col("__keep")).select(*key)
    if not parts:
        if changed.isEmpty():
            write_table(fresh, target_path, "append")
        else:
            _rebuild_all(spark, null_safe_join(target, changed, key, "left_anti").unionByName(fresh), target_path)
    else:
        hit = null_safe_join(found, changed, key, "left_semi").select(
            *[F.col(f"__old_{c}").alias(c) for c in parts]).distinct()
        if not hit.isEmpty():
            rebuilt = null_safe_join(null_safe_join(target, hit, parts, "left_semi"), changed, key, "left_anti")
            rebuilt = rebuilt.unionByName(null_safe_join(fresh, hit, parts, "left_semi"))
            swap_partitions(spark, rebuilt, hit, target, target_path, parts)
        # after the swap: a run that fails before this line is made whole by running it again
        write_table(null_safe_join(fresh, hit, parts, "left_anti"), target_path, "append", parts)
    remove_folder(spark, at)


def merge_table(source: DataFrame, table: str, spec: TableSpec,
                key: list[str] | tuple[str, ...] | None = None, cast_mode: str = "strict") -> None:
    """Keyed merge into a catalog table whose format supports MERGE.

    ``DataFrame.mergeInto`` updates matched keys with every source column and
    inserts the rest in one atomic commit, with no staging copy. Plain parquet
    tables refuse it (use :func:`upsert` on a folder instead). The source is
    cast and key-checked as in :func:`upsert`.
    """
    key = list(key or spec.key)
    src = schema_cast(source, spec, cast_mode)
    assert_keys(src, key, spec.not_null)
    tgt = table.split(".")[-1]
    cond = F.lit(True)
    for k in key:
        cond = cond & (F.col(f"{tgt}.{k}") == F.col(f"__src.{k}"))
    (src.alias("__src").mergeInto(table, cond)
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge())


def load(spark: SparkSession, operation: str, source: DataFrame, target_path: str,
         spec: TableSpec, key=None, partition_by=None, cast_mode: str = "strict",
         check: bool = True, buckets: int | None = None) -> str:
    """Move an ingress table into the typed layer by ``append``, ``replace`` or ``upsert``.

    The target is a published table in buckets of its key (:mod:`.tables`; read it with
    ``tables.read``), or, with ``partition_by``, a parquet folder in those partitions. Unless
    ``check`` is off, rows are held against the declared key and NOT NULL columns, an append also
    against the keys that are stored; a batch that breaks them leaves the target as it was.
    """
    if operation not in OPERATIONS:
        raise ValueError(f"invalid operation {operation!r}: must be 'append', 'replace' or 'upsert'")
    if not partition_by:
        how = {"append": tables.append, "replace": tables.replace, "upsert": tables.merge}[operation]
        how(spark, source, target_path, spec, key, cast_mode, check=check, buckets=buckets)
        return target_path
    if operation == "upsert":
        return upsert(spark, source, target_path, spec, key, partition_by, check, cast_mode)
    df = schema_cast(source, spec, cast_mode)
    key = list(key or spec.key)
    if check:
        assert_keys(df, key, spec.not_null)
        stored = open_table(spark, target_path, df.schema) if operation == "append" and key else None
        if stored is not None:
            known = stored.select(*key).join(df.select(*key), key, "left_semi").count()
            if known:
                raise KeyViolation(f"key {key} violated: {known} stored rows have a key of the batch")
    return write_table(df, target_path, "append" if operation == "append" else "overwrite", partition_by)


def high_water_filter(source: DataFrame, target: DataFrame, ts_col: str,
                      target_ts_col: str | None = None) -> DataFrame:
    """Rows of ``source`` newer than the newest ``target`` row.

    The maximum is an uncorrelated scalar subquery: computed once, then used
    as a plain predicate. On an empty target it is null and no row passes.
    """
    mx = target.select(F.max(target_ts_col or ts_col)).scalar()
    return source.filter(F.col(ts_col) > mx)


def incremental_append(spark: SparkSession, source: DataFrame, target_path: str, ts_col: str,
                       target_ts_col: str | None = None,
                       partition_by: list[str] | None = None) -> str:
    """First run materialises everything; later runs append rows past the stored maximum.

    The stored maximum is resolved first (one aggregate; a single value
    reaches the driver), so the append plan no longer reads the folder it
    writes and needs no staging copy. An empty target gives a null maximum
    and, as with the scalar-subquery form, no row passes.
    """
    target = open_table(spark, target_path, source.schema if not target_ts_col else T.StructType(
        [T.StructField(target_ts_col, source.schema[ts_col].dataType)]))
    if target is None:
        return write_table(source, target_path, "append", partition_by)
    mx = target.agg(F.max(target_ts_col or ts_col)).first()[0]
    inc = source.filter(F.col(ts_col) > F.lit(mx).cast(source.schema[ts_col].dataType))
    return write_table(inc, target_path, "append", partition_by)


MATERIALIZATIONS = ("table", "view", "incremental")


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None,
                ts_col: str | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Materialise a model as a rebuilt table, a view, or an incremental table.

    ``table`` rebuilds (parquet at ``path``, or a catalog table ``name``);
    ``view`` registers a temporary view and copies nothing; ``incremental``
    appends only rows past the stored maximum of ``ts_col`` (all rows on the
    first run). Returns the materialised result.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if path:
            write_table(df, path, "overwrite", partition_by)
            # declared schema: partition columns keep their type and the model its column order
            return spark.read.schema(df.schema).parquet(path).select(*df.columns)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.saveAsTable(name)
        return spark.table(name)
    if kind == "incremental":
        if not path or not ts_col:
            raise ValueError("incremental materialisation needs path and ts_col")
        incremental_append(spark, df, path, ts_col, partition_by=partition_by)
        return spark.read.parquet(path)
    raise ValueError(f"kind must be one of {MATERIALIZATIONS}, got {kind!r}")
