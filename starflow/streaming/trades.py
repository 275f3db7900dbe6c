"""Trade stream: framed messages from a topic into a keyed table.

``source → split frames → decode by schema id → cast → newest copy → keyed merge`` runs as a
Structured Streaming query. The newest copy of each trade is kept in the state store, so older copies
never reach the table; what is left of a micro-batch is merged by ``foreachBatch`` (idempotent) into
the buckets of its keys. Bad frames and failed casts go to reject files instead of stopping the
query. Progress and state are checkpointed under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import schema_cast
from ..functions.frames import FRAME_ERROR, PayloadSchema, decode_frames, record_json
from ..operators import tables
from ..schemas import TRADE_VALUE_SCHEMA, TRANSACTIONS, TableSpec
from ..session import task_slots

# Column layout of a topic record (what the Kafka source yields).
TOPIC_RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

TEXT_COLUMNS = [f.name for f in TRADE_VALUE_SCHEMA.fields]


def kafka_options(spark: SparkSession, options: dict | None = None) -> dict[str, str]:
    """Reader options of a topic: from the earliest offsets, and, as producers key by company and one
    hot company fills one topic partition, with ``minPartitions`` at the cluster's parallelism, so that
    Spark reads a large topic partition with several tasks. What the caller gives comes first."""
    opts = {k: str(v) for k, v in (options or {}).items()}
    if "kafka.bootstrap.servers" not in opts or not {"subscribe", "subscribePattern", "assign"} & set(opts):
        raise ValueError("a topic source needs kafka.bootstrap.servers and one of subscribe, subscribePattern, assign")
    return {"startingOffsets": "earliest", "minPartitions": str(task_slots(spark)), **opts}


def trade_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of topic records, read from the earliest offsets.

    ``kafka`` needs the Kafka connector on the classpath; ``parquet``/``json``
    read files with the same record layout (used for tests and replays).
    """
    opts = dict(options or {})
    if fmt == "kafka":
        return spark.readStream.format("kafka").options(**kafka_options(spark, opts)).load()
    r = spark.readStream.format(fmt).schema(TOPIC_RECORD_SCHEMA).options(**opts)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if path is None:
        raise ValueError("file sources need a path")
    return r.load(path)


def default_registry(schema_id: int = 1) -> dict[int, PayloadSchema]:
    return {schema_id: PayloadSchema(TRADE_VALUE_SCHEMA, "json")}


def decode_trades(records: DataFrame, registry: dict[int, PayloadSchema]) -> DataFrame:
    """Topic records → text trade fields + ``frame_error`` (null when good).

    Keeps ``partition`` and ``offset`` so later steps can pick the newest copy.
    """
    d = decode_frames(records, registry, "value", "record")
    # a record whose fields are all null did not decode
    all_null = None
    for c in TEXT_COLUMNS:
        cond = F.col(f"record.{c}").isNull()
        all_null = cond if all_null is None else all_null & cond
    err = F.when(F.col(FRAME_ERROR).isNotNull(), F.col(FRAME_ERROR)).when(
        all_null, F.lit("undecodable payload"))
    return d.select(
        *[F.col(f"record.{c}").cast(T.StringType()).alias(c) for c in TEXT_COLUMNS],
        F.when(err.isNull(), record_json("record")).alias("record_json"),
        "partition", "offset", err.alias(FRAME_ERROR))


def cast_trades(decoded: DataFrame, spec: TableSpec = TRANSACTIONS) -> DataFrame:
    """Typed trade fields beside the text that arrived (``raw``), ``partition``, ``offset`` and
    ``reason``: why the record is rejected, or null.

    ``reason`` comes out of an ``explode`` (of one element), as Spark pushes no filter below that. A
    filter on a projected ``reason`` is rewritten in terms of the message, and its payload is then
    decoded dozens of times, once for each mention of a field.
    """
    raw = F.struct(*[F.col(c) for c in TEXT_COLUMNS]).alias("raw")
    cast = schema_cast(decoded.withColumn("raw", raw), spec, "lenient", keep_extra=("partition", "offset", "raw", FRAME_ERROR))
    null_key = F.lit(False)
    for c in spec.not_null:
        null_key = null_key | F.col(c).isNull()
    reason = (F.when(F.col(FRAME_ERROR).isNotNull(), F.col(FRAME_ERROR))
              .when(F.size("_cast_errors") > 0, F.concat(F.lit("cast failed: "), F.array_join("_cast_errors", ",")))
              .when(null_key, F.lit("null key or required column")))
    return cast.select(*spec.names, "raw", "partition", "offset", F.explode(F.array(reason)).alias("reason"))


def rejects_of(cast: DataFrame) -> DataFrame:
    """The rejected records as they arrived, and why."""
    return cast.filter("reason is not null").select(*[F.col(f"raw.{c}").alias(c) for c in TEXT_COLUMNS], "reason")


def newest_per_key(df: DataFrame, key: str, order_cols=("partition", "offset")) -> DataFrame:
    """One row per key, the one with the greatest ``order_cols`` (partial-aggregated)."""
    cols = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*cols), F.struct(*order_cols))
    return df.groupBy(key).agg(best.alias("__r")).select(key, "__r.*").select(*df.columns)


EVENT_TIME = "transaction_timestamp_utc"


def newest_state(cast: DataFrame, spec: TableSpec = TRANSACTIONS, event_time: str = EVENT_TIME) -> DataFrame:
    """Good records that are the newest copy of their key so far: by event time, then micro-batch (of
    copies of one time the one that came later), then offset.

    Of a stream this keeps one row a key in the state store (checkpointed with the query): a copy that
    is older than what was seen before is dropped here, in whatever micro-batch it comes, and reaches
    no table (a replay of equal time goes on, and the merge finds it unchanged). Each row is stamped with the time of its micro-batch; a key comes out of a batch (update
    mode) only if the newest copy carries that batch's stamp. A retried batch has the same stamp.
    """
    key = list(spec.key)
    rest = [c for c in spec.names if c not in key]
    good = cast.filter("reason is null").withColumn("__at", F.current_timestamp())
    order = F.struct(F.col(event_time).isNotNull().alias("known"), event_time, "__at", "partition", "offset")
    best = good.groupBy(*key).agg(F.max_by(F.struct(*rest, "__at"), order).alias("r"))
    return best.filter(F.col("r.__at") == F.current_timestamp()).select(
        *[F.col(c) if c in key else F.col(f"r.{c}").alias(c) for c in spec.names])


def merge_batch_fn(spark: SparkSession, target_path: str, spec: TableSpec = TRANSACTIONS,
                   event_time: str = EVENT_TIME, buckets: int | None = None):
    """A ``foreachBatch`` function merging newest copies into the published table ``target_path``.

    The table lies in buckets of the key, so a batch reads and rewrites only the buckets of its
    trades, and a corrected time moves nothing. Keys are unique and non-null by construction. A batch
    that is tried again changes nothing; where the state of an earlier query is gone, the table's own
    copy decides (``newer``).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        tables.merge(spark, batch, target_path, spec, check=False, newer=event_time, buckets=buckets)

    return run


#: Keeps state on the executors' disks: it may outgrow their memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_trades(spark: SparkSession, records: DataFrame, target_path: str, rejects_path: str,
               checkpoint: str, registry: dict[int, PayloadSchema] | None = None,
               available_now: bool = True, buckets: int | None = None, state_store: str = ROCKSDB):
    """Start the stream → table query; with ``available_now`` it drains and stops.

    Two queries read the source, each with its own checkpoint under ``checkpoint``: good records go
    through the state of newest copies into the table, rejects into files (``rejects_path``), once
    each. Returns the first query.
    """
    cast = cast_trades(decode_trades(records, registry or default_registry()))
    bad = rejects_of(cast).writeStream.format("parquet").option("path", rejects_path).option(
        "checkpointLocation", f"{checkpoint}/rejects")
    good = (newest_state(cast).writeStream.outputMode("update").foreachBatch(merge_batch_fn(spark, target_path, buckets=buckets))
            .option("checkpointLocation", f"{checkpoint}/trades"))
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, state_store)  # a query keeps the settings it was started with
    try:
        queries = [w.trigger(availableNow=True).start() if available_now else w.trigger(processingTime="5 seconds").start()
                   for w in (good, bad)]
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    if available_now:
        for q in queries:
            q.awaitTermination()
    return queries[0]


def read_trades(spark: SparkSession, target_path: str, spec: TableSpec = TRANSACTIONS) -> DataFrame:
    return tables.read(spark, target_path).select(*spec.names)
