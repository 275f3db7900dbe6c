import json

from starflow.functions import frames
from starflow.operators import tables
from starflow.streaming import trades
from conftest import rows


def frame(sid, payload, magic=0):
    return bytes([magic]) + sid.to_bytes(4, "big") + payload


REC = {"transaction_id": "t1", "customer_id": 5, "company_id": 7, "volume_traded": -3,
       "transaction_timestamp_utc": "2025-04-01T10:00:00"}


def test_frame_split_cases(spark):
    good = frame(70000, json.dumps(REC).encode())
    data = [(1, good), (2, b""), (3, b"\x01" + good[1:]), (4, b"\x00\x01"), (5, None)]
    df = spark.createDataFrame(data, "id int, value binary")
    got = {r.id: (r.schema_id, r.frame_error) for r in frames.split_frames(df).collect()}
    assert got == {1: (70000, None), 2: (None, "empty message"), 3: (None, "bad magic byte"),
                   4: (None, "short frame"), 5: (None, "empty message")}


def test_decode_registry(spark):
    data = [(1, frame(1, json.dumps(REC).encode())), (2, frame(9, b"{}")), (3, frame(1, b"not json"))]
    df = spark.createDataFrame(data, "id int, value binary")
    out = frames.decode_frames(df, trades.default_registry(1))
    got = {r.id: r.frame_error for r in out.collect()}
    assert got[1] is None and got[2] == "unknown schema id"
    r1 = out.filter("id = 1").select(frames.record_json().alias("j")).first().j
    assert json.loads(r1) == REC


def _write_topic(spark, path, recs, bad=()):
    data = [(None, frame(1, json.dumps(r).encode()), "t", 0, i, None) for i, r in enumerate(recs)]
    data += [(None, b, "t", 0, 100 + i, None) for i, b in enumerate(bad)]
    spark.createDataFrame(data, trades.TOPIC_RECORD_SCHEMA).write.mode("append").parquet(path)


def test_stream_upsert_replay_and_rejects(spark, tmp_path):
    topic, table, rej, ck = (str(tmp_path / x) for x in ("topic", "table", "rej", "ck"))
    recs = [dict(REC, transaction_id=f"t{i}", volume_traded=i) for i in range(5)]
    _write_topic(spark, topic, recs, bad=[b"\x05zzzzz", b""])
    trades.run_trades(spark, trades.trade_source(spark, "parquet", topic), table, rej, ck)
    assert trades.read_trades(spark, table).count() == 5
    assert spark.read.parquet(rej).count() == 2
    # replayed copy plus one changed trade: no new rows, the change wins
    _write_topic(spark, topic, recs[:2] + [dict(recs[3], volume_traded=99)])
    trades.run_trades(spark, trades.trade_source(spark, "parquet", topic), table, rej, ck)
    got = dict(rows(trades.read_trades(spark, table).select("transaction_id", "volume_traded")))
    assert got == {"t0": 0, "t1": 1, "t2": 2, "t3": 99, "t4": 4}
    assert trades.read_trades(spark, table).schema["customer_id"].dataType.simpleString() == "int"


def test_newest_per_key(spark):
    df = spark.createDataFrame([("a", 1, 0, 5), ("a", 2, 0, 9), ("b", 3, 1, 1)],
                               "k string, v int, partition int, offset long")
    assert rows(trades.newest_per_key(df, "k").select("k", "v"), ["k"]) == [("a", 2), ("b", 3)]


def test_kafka_source_requires_connector(spark):
    import pytest
    # the Kafka connector is not on this classpath: the source fails at load, not later
    with pytest.raises(Exception):
        trades.trade_source(spark, "kafka", options={"kafka.bootstrap.servers": "localhost:1",
                                                     "subscribe": "x"})


def test_kafka_options(spark):
    import pytest

    where = {"kafka.bootstrap.servers": "h:9092", "subscribe": "trades"}
    got = trades.kafka_options(spark, where)
    assert got == {**where, "startingOffsets": "earliest", "minPartitions": str(spark.sparkContext.defaultParallelism)}
    own = trades.kafka_options(spark, {**where, "startingOffsets": "latest", "minPartitions": 3, "maxOffsetsPerTrigger": 10})
    assert (own["startingOffsets"], own["minPartitions"], own["maxOffsetsPerTrigger"]) == ("latest", "3", "10")
    for bad in ({}, {"subscribe": "x"}, {"kafka.bootstrap.servers": "h:1"}):
        with pytest.raises(ValueError):
            trades.kafka_options(spark, bad)


def test_file_source_needs_path(spark):
    import pytest
    with pytest.raises(ValueError):
        trades.trade_source(spark, "parquet")


def test_cast_reject_keeps_text(spark, tmp_path):
    topic, table, rej, ck = (str(tmp_path / x) for x in ("topic", "table", "rej", "ck"))
    bad = dict(REC, transaction_id="tb", transaction_timestamp_utc="not a time")
    nokey = dict(REC, transaction_id=None)
    _write_topic(spark, topic, [REC, bad, nokey])
    trades.run_trades(spark, trades.trade_source(spark, "parquet", topic), table, rej, ck)
    assert [r.transaction_id for r in trades.read_trades(spark, table).collect()] == ["t1"]
    got = {r.reason: r.transaction_timestamp_utc for r in spark.read.parquet(rej).collect()}
    assert got["cast failed: transaction_timestamp_utc"] == "not a time"
    assert "null key or required column" in got


def test_retried_batch_and_older_copies(spark, tmp_path):
    """A retried batch changes nothing; without state, the table's own copy decides."""
    table = str(tmp_path / "table")
    run = trades.merge_batch_fn(spark, table, buckets=4)

    def batch(*recs):
        data = [(None, frame(1, json.dumps(r).encode()), "t", 0, i, None) for i, r in enumerate(recs)]
        records = spark.createDataFrame(data, trades.TOPIC_RECORD_SCHEMA)
        return trades.newest_state(trades.cast_trades(trades.decode_trades(records, trades.default_registry())))

    run(batch(REC, dict(REC, transaction_timestamp_utc="2025-03-01T10:00:00", volume_traded=1)), 0)
    run(batch(REC), 0)
    assert tables.current(spark, table).seq == 0
    day2 = dict(REC, transaction_timestamp_utc="2025-04-02T10:00:00", volume_traded=8)
    run(batch(day2), 1)                                                  # a corrected time
    run(batch(dict(REC, volume_traded=99)), 2)                           # an older copy
    run(batch(dict(REC, transaction_timestamp_utc=None, volume_traded=5)), 3)
    got = [(r.transaction_id, r.volume_traded) for r in trades.read_trades(spark, table).collect()]
    assert got == [("t1", 8)]


def test_older_copies_are_dropped_before_the_table_is_read(spark, tmp_path):
    """Stopped and started from its checkpoint, the query knows the newest copies: a batch of older
    ones and replays publishes nothing and reads no file of the table (they may be unreadable)."""
    import glob

    topic, table, rej, ck = (str(tmp_path / x) for x in ("topic", "table", "rej", "ck"))
    go = lambda: trades.run_trades(spark, trades.trade_source(spark, "parquet", topic), table, rej, ck, buckets=4)
    recs = [dict(REC, transaction_id=f"t{i}", volume_traded=i) for i in range(9)]
    _write_topic(spark, topic, recs, bad=[b"\x05zzzzz"])
    go()
    seq = tables.current(spark, table).seq
    files = glob.glob(f"{table}/data/*/*/*.parquet")
    whole = {f: open(f, "rb").read() for f in files}
    for f in files:
        with open(f, "wb") as out:
            out.write(b"PAR1 not a footer")
    old = [dict(r, transaction_timestamp_utc="2025-03-01T10:00:00", volume_traded=-1) for r in recs]
    _write_topic(spark, topic, old + [dict(recs[0], transaction_timestamp_utc=None)])
    go()
    assert tables.current(spark, table).seq == seq
    for f, data in whole.items():
        with open(f, "wb") as out:
            out.write(data)
    _write_topic(spark, topic, [dict(recs[4], transaction_timestamp_utc="2025-05-01T10:00:00", volume_traded=44)])
    go()
    got = dict(rows(trades.read_trades(spark, table).select("transaction_id", "volume_traded")))
    assert got == {f"t{i}": 44 if i == 4 else i for i in range(9)}
    assert spark.read.parquet(rej).count() == 1


def test_registry_with_two_record_shapes(spark):
    from starflow.fixtures import VENUE_SCHEMA
    from starflow.functions.frames import PayloadSchema
    other = {"company_id": 7, "transaction_id": "t2", "venue": "X", "customer_id": 6, "transaction_timestamp_utc": "2025-04-01T11:00:00"}
    data = [(None, frame(1, json.dumps(REC).encode()), "t", 0, 0, None), (None, frame(3, json.dumps(other).encode()), "t", 0, 1, None)]
    df = spark.createDataFrame(data, trades.TOPIC_RECORD_SCHEMA)
    out = trades.decode_trades(df, {**trades.default_registry(), 3: PayloadSchema(VENUE_SCHEMA)})
    assert rows(out.select("transaction_id", "customer_id", "volume_traded", "frame_error"), ["transaction_id"]) == [
        ("t1", "5", "-3", None), ("t2", "6", None, None)]


def test_filters_on_the_reason_decode_a_payload_once(spark):
    """What is kept or rejected is decided on a payload that was decoded once, in both queries."""
    late = dict(REC, transaction_id="t2", transaction_timestamp_utc="not a time")
    values = [frame(1, json.dumps(REC).encode()), frame(1, json.dumps(late).encode()), frame(9, b"{}"), b"", None,
              frame(1, json.dumps(dict(REC, transaction_id=None)).encode()), frame(1, b"[")]
    records = spark.createDataFrame([(None, v, "t", 0, i, None) for i, v in enumerate(values)], trades.TOPIC_RECORD_SCHEMA)
    cast = trades.cast_trades(trades.decode_trades(records.repartition(2), trades.default_registry()))
    good, bad = trades.newest_state(cast), trades.rejects_of(cast)
    for df in (good, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows(good.select("transaction_id", "volume_traded")) == [("t1", -3)]
    assert sorted((r.reason, r.transaction_id) for r in bad.collect() if r.transaction_id) == [("cast failed: transaction_timestamp_utc", "t2")]
    assert sorted(r.reason for r in bad.collect() if not r.transaction_id) == [
        "empty message", "empty message", "null key or required column", "undecodable payload", "unknown schema id"]
