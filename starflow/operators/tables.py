"""Published tables: versions written aside, made current by one small file.

A table is a folder with two parts. ``data/<write>/bucket=<b>/`` holds rows, dealt into buckets by a
hash of the key; files are never changed. ``pointer/seq=<n>/`` holds one small file that lists the
folders of version ``n``. Readers take the greatest ``seq``, so they see one version or the next and
never a mix; a write that fails at any step leaves the version before it in place.

* :func:`replace` writes all rows aside and points to them (truncate-and-load as one step).
* :func:`merge` reads and rewrites only the buckets that the batch's keys fall in. The other buckets
  are listed again, not read. One shuffle puts the old rows beside the new ones.
* :func:`append` adds folders to buckets; a table with a key reads the key column of the touched
  buckets, no more.

Declared keys and NOT NULL columns are checked in the pass that writes the rows (observed metrics);
a batch that breaks them is not published. The current version and the one before it are kept, so
that a reader who has just resolved a version can finish; what only older ones list is deleted. A
crashed write may leave a folder under ``data`` that no version lists. Writers are told apart by the
version they publish: of two at once, the later one is refused and may be run again.

Buckets are fixed when a table is first written (``buckets``, else one per shuffle partition); a
full replace may change them. At 100 TB and 120,000 shuffle partitions a bucket is about 0.8 GB.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import schema_cast
from ..schemas import TableSpec
from ..session import remove_folder, workspace
from .checks import KeyViolation

BUCKET = "bucket"
_POINTER = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType()),
                         T.StructField("seq", T.LongType())])
#: Versions that stay readable.
KEPT = 2


class Conflict(RuntimeError):
    """Another writer has published the version this one was about to publish."""


@dataclass
class Version:
    """One version: its number, its bucket count, its key, its columns, and its folders by bucket."""

    seq: int
    buckets: int
    key: list[str]
    schema: T.StructType
    folders: list[tuple[int, str]]


def _at(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _pointers(spark: SparkSession, root: str) -> dict[int, list[tuple[int, str]]]:
    """Folders of each version that is still listed (at most ``KEPT`` and a few left by a crash)."""
    from .load import open_table

    listed = open_table(spark, _at(root, "pointer"), _POINTER)
    out: dict[int, list[tuple[int, str]]] = {}
    for r in listed.collect() if listed is not None else []:  # a row a bucket
        out.setdefault(r.seq, []).append((r.bucket, r.folder))
    return out


def _version(seq: int, rows: list[tuple[int, str]]) -> Version:
    head = json.loads(next(f for b, f in rows if b < 0))
    return Version(seq, head["buckets"], head["key"], T.StructType.fromJson(head["schema"]), [(b, f) for b, f in rows if b >= 0])


def current(spark: SparkSession, root: str) -> Version | None:
    """The version readers see, or None if nothing was ever published."""
    found = _pointers(spark, root)
    return _version(max(found), found[max(found)]) if found else None


def _read(spark: SparkSession, root: str, version: Version, buckets: set[int] | None = None) -> DataFrame:
    paths = [_at(root, f) for b, f in version.folders if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the current version."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root!r}")
    return _read(spark, root, version)


def bucket_of(key: list[str], buckets: int) -> Column:
    """The bucket of a key; a table without a key has one bucket."""
    if not key:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def publish(spark: SparkSession, root: str, version: Version) -> None:
    """Make ``version`` the current one: one file, there or not."""
    from pyspark.errors import AnalysisException

    head = json.dumps({"buckets": version.buckets, "key": version.key, "schema": version.schema.jsonValue()})
    rows = spark.createDataFrame([(-1, head), *version.folders], T.StructType(_POINTER.fields[:2]))
    try:
        rows.coalesce(1).write.mode("errorifexists").parquet(_at(root, "pointer", f"seq={version.seq}"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_ALREADY_EXISTS":
            raise Conflict(f"version {version.seq} of {root!r} is there already") from e
        raise


def prune(spark: SparkSession, root: str) -> None:
    """Delete the versions before the kept ones, and the folders that only they list."""
    found = _pointers(spark, root)
    kept = sorted(found)[-KEPT:]
    used = {f for s in kept for _, f in found[s]}
    for seq in sorted(found)[:-KEPT]:
        # the pointer goes last: what it lists is found again if this stops in between
        for b, folder in found[seq]:
            if b >= 0 and folder not in used:
                remove_folder(spark, _at(root, folder))
        remove_folder(spark, _at(root, "pointer", f"seq={seq}"))


# ------------------------------------------------------------------ checks in the write pass

def _observed_nulls(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation | None]:
    if not columns:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(f"null:{c}") for c in columns]), seen


def _one_a_key(df: DataFrame, key: list[str], cols: list[str]) -> tuple[DataFrame, Observation]:
    """One row a key, rows of a repeated key observed. Partial aggregation: a key that holds a third
    of a faulty batch is one row a task before the shuffle."""
    seen, rest = Observation(), [c for c in cols if c not in key]
    per = df.groupBy(BUCKET, *key).agg(F.first(F.struct(*rest, F.lit(True).alias("__any"))).alias("__row"),
                                       F.count(F.lit(1)).alias("__n"))
    many = F.col("__n") > 1
    per = per.observe(seen, F.count(F.when(many, 1)).alias("duplicate_keys"),
                      F.coalesce(F.sum(F.when(many, F.col("__n"))), F.lit(0)).alias("duplicate_rows"))
    return per.select(*[F.col(c) if c in key else F.col(f"__row.`{c}`").alias(c) for c in cols], BUCKET), seen


def _refuse(key: list[str], *seen: Observation | None) -> None:
    bad = {k: v for s in seen if s is not None for k, v in s.get.items() if v}
    if bad:
        raise KeyViolation(f"key {key} violated: " + ", ".join(f"{k}={v}" for k, v in bad.items()))


def _checked(df: DataFrame, key: list[str], not_null: tuple[str, ...], check: bool):
    """``df`` (with its bucket column) one row a key, and the observations of what breaks the rules."""
    cols = [c for c in df.columns if c != BUCKET]
    if not check:
        return df, ()
    df, nulls = _observed_nulls(df, list(dict.fromkeys([*key, *not_null])))
    if not key:
        return df, (nulls,)
    df, twice = _one_a_key(df, key, cols)
    return df, (nulls, twice)


# ------------------------------------------------------------------ writes

def _write(df: DataFrame, root: str, write: str, spread: bool) -> None:
    """``spread``: rows come in any order; AQE then sizes the write tasks by bucket."""
    if spread:
        df = df.hint("rebalance", BUCKET)
    df.write.mode("errorifexists").partitionBy(BUCKET).parquet(_at(root, "data", write))


def _new_folders(buckets: list[int], write: str) -> list[tuple[int, str]]:
    return [(b, f"data/{write}/{BUCKET}={b}") for b in sorted(buckets)]


def _buckets_in(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a write has made: its folders, read from the listing (at most a bucket each)."""
    from .load import open_table

    made = open_table(spark, path, T.StructType([T.StructField(BUCKET, T.IntegerType())]))
    return [r[0] for r in made.distinct().collect()] if made is not None else []


def _prepared(source: DataFrame, spec: TableSpec, key, cast_mode: str | None, derive: dict | None):
    """The batch in the table's layout; ``cast_mode`` None takes it as it is (an ingress table's text)."""
    cast = schema_cast(source, spec, cast_mode) if cast_mode else source
    if derive:
        cast = cast.withColumns(derive)
    if BUCKET in cast.columns:
        raise ValueError(f"a published table cannot have a column named {BUCKET!r}")
    return cast, list(spec.key if key is None else key)


def replace(spark: SparkSession, source: DataFrame, root: str, spec: TableSpec, key=None, cast_mode: str | None = "strict",
            derive: dict | None = None, check: bool = True, buckets: int | None = None) -> Version:
    """The table holds the rows of ``source`` and nothing else, once this returns; until then, what it held."""
    cast, key = _prepared(source, spec, key, cast_mode, derive)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = current(spark, root)
    rows, seen = _checked(cast.withColumn(BUCKET, bucket_of(key, n)), key, spec.not_null, check)
    write = uuid.uuid4().hex
    try:
        if key:
            _write(rows, root, write, spread=True)
        else:  # one bucket, as many files as there are tasks
            rows.drop(BUCKET).write.parquet(_at(root, "data", write, f"{BUCKET}=0"))
        _refuse(key, *seen)
        made = _buckets_in(spark, _at(root, "data", write)) if key else [0]
        version = Version(old.seq + 1 if old else 0, n, key, cast.schema, _new_folders(made, write))
        publish(spark, root, version)
    except Exception:
        remove_folder(spark, _at(root, "data", write))
        raise
    prune(spark, root)
    return version


def _staged_batch(spark: SparkSession, cast: DataFrame, key: list[str], spec: TableSpec, check: bool, buckets: int):
    """The batch, read once, checked on the way to a staged copy; the copy and its buckets."""
    rows, seen = _checked(cast.withColumn(BUCKET, bucket_of(key, buckets)), key, spec.not_null, check)
    path = workspace(spark, "batch")
    try:
        rows.write.parquet(path)
        _refuse(key, *seen)
    except Exception:
        remove_folder(spark, path)
        raise
    batch = spark.read.schema(rows.schema).parquet(path)
    return path, batch, {r[0] for r in batch.select(BUCKET).distinct().collect()}  # at most a bucket each


def append(spark: SparkSession, source: DataFrame, root: str, spec: TableSpec, key=None, cast_mode: str | None = "strict",
           derive: dict | None = None, check: bool = True, buckets: int | None = None) -> Version:
    """Add the rows of ``source``. Keys that are stored already are refused: only the key columns of the
    buckets that the batch falls in are read for it."""
    cast, key = _prepared(source, spec, key, cast_mode, derive)
    old = current(spark, root)
    if old is None:
        return replace(spark, source, root, spec, key, cast_mode, derive, check, buckets)
    _same_layout(old, key, cast.schema)
    path, batch, touched = _staged_batch(spark, cast, key, spec, check, old.buckets)
    write = uuid.uuid4().hex
    try:
        if not touched:
            return old
        if key and check:
            stored = _read(spark, root, old, touched).select(*key)
            known = stored.join(batch.select(*key), key, "left_semi").count()
            if known:
                raise KeyViolation(f"key {key} violated: {known} stored rows have a key of the batch")
        if key:
            _write(batch, root, write, spread=True)
        else:
            batch.drop(BUCKET).write.parquet(_at(root, "data", write, f"{BUCKET}=0"))
        version = Version(old.seq + 1, old.buckets, key, old.schema, old.folders + _new_folders(list(touched), write))
        publish(spark, root, version)
    except Exception:
        remove_folder(spark, _at(root, "data", write))
        raise
    finally:
        remove_folder(spark, path)
    prune(spark, root)
    return version


def _same_layout(old: Version, key: list[str], schema: T.StructType) -> None:
    if key != old.key:
        raise ValueError(f"the table's key is {old.key}, not {key}")
    if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in old.schema]:
        raise ValueError("the batch has other columns than the table")


@dataclass
class Merged:
    """What a merge did with the rows of its batch."""

    version: int
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    stale: int = 0


def merge(spark: SparkSession, source: DataFrame, root: str, spec: TableSpec, key=None, cast_mode: str | None = "strict",
          derive: dict | None = None, check: bool = True, newer: str | None = None, buckets: int | None = None) -> Merged:
    """Keyed upsert: matched keys take every column from the cast source, new keys are inserted.

    With ``newer``, a source row whose value of that column is below the stored one (or null where
    that is known) changes nothing. A batch that changes nothing publishes nothing.
    """
    cast, key = _prepared(source, spec, key, cast_mode, derive)
    if not key:
        raise ValueError("a merge needs a key")
    old = current(spark, root)
    if old is None:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        old = Version(-1, n, key, cast.schema, [])
    _same_layout(old, key, cast.schema)
    path, batch, touched = _staged_batch(spark, cast, key, spec, check, old.buckets)
    write = uuid.uuid4().hex
    try:
        if not touched and old.seq >= 0:
            return Merged(old.seq)
        rows, seen = _merged(_read(spark, root, old, touched), batch, key, old.buckets, newer)
        _write(rows, root, write, spread=False)
        done = Merged(old.seq, **seen.get)
        if old.seq >= 0 and not done.inserted and not done.updated:
            remove_folder(spark, _at(root, "data", write))
            return done
        rest = [(b, f) for b, f in old.folders if b not in touched]
        done.version = old.seq + 1
        publish(spark, root, Version(done.version, old.buckets, key, cast.schema, rest + _new_folders(list(touched), write)))
    except Exception:
        remove_folder(spark, _at(root, "data", write))
        raise
    finally:
        remove_folder(spark, path)
    prune(spark, root)
    return done


def _merged(stored: DataFrame, batch: DataFrame, key: list[str], buckets: int, newer: str | None):
    """Old and new rows of the touched buckets, one row a key, in one shuffle by bucket."""
    cols = [c for c in batch.columns if c != BUCKET]
    rest = [c for c in cols if c not in key]
    row = F.struct(*rest, F.lit(True).alias("__any")).alias("__row")
    old = stored.select(bucket_of(key, buckets).alias(BUCKET), *key, row, F.lit(False).alias("__new"))
    new = batch.select(BUCKET, *key, row, F.lit(True).alias("__new"))
    both = old.unionByName(new).repartition(BUCKET)
    pick = lambda flag: F.first(F.when(F.col("__new") == flag, F.col("__row")), ignorenulls=True)
    per = both.groupBy(BUCKET, *key).agg(pick(True).alias("n"), pick(False).alias("o"))
    # a variant has no equality: by its JSON text
    value = lambda side, c: (F.to_json if isinstance(batch.schema[c].dataType, T.VariantType) else lambda x: x)(F.col(f"{side}.`{c}`"))
    equal = F.lit(True)
    for c in rest:
        equal = equal & value("n", c).eqNullSafe(value("o", c))
    stale = F.lit(False)
    if newer:
        n, o = F.col(f"n.`{newer}`"), F.col(f"o.`{newer}`")
        stale = F.coalesce(n < o, n.isNull() & o.isNotNull())
    what = (F.when(F.col("n").isNull(), "kept").when(F.col("o").isNull(), "inserted").when(equal, "unchanged")
            .when(stale, "stale").otherwise("updated"))
    per = per.withColumn("__what", what)
    seen = Observation()
    per = per.observe(seen, *[F.count(F.when(F.col("__what") == w, 1)).alias(w) for w in ("inserted", "updated", "unchanged", "stale")])
    take = F.when(F.col("__what").isin("inserted", "updated"), F.col("n")).otherwise(F.col("o"))
    per = per.select(BUCKET, *key, take.alias("__row"))
    return per.select(*[F.col(c) if c in key else F.col(f"__row.`{c}`").alias(c) for c in cols], BUCKET), seen
