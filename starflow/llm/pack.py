"""Packing documents into training sequences by cutting-stock column generation.

1. Each document is encoded once, ends with an end id, and is cut into full sequences and one
   remainder; the pieces are written to the shared folder.
2. The lengths of all pieces are counted into classes of ``GRAIN`` ids, rounded up. This histogram
   (at most ``capacity / GRAIN`` numbers) is all that reaches the driver.
3. There a linear program chooses how often to use each pattern (a multiset of classes that fits a
   sequence). Patterns are generated as needed: a knapsack dynamic program over the classes finds
   the pattern of greatest dual value. It stops within ``gap`` of a lower bound.
4. The counts are rounded down; a class for which the patterns hold more slots than pieces leaves
   the slots empty. What is left, less than a pattern's pieces for each pattern, goes best-fit into
   further patterns.
5. Pieces are ranked within their class, and ranks are dealt out to the slots of the patterns:
   the sequence of a piece follows from its class, its rank and the plan.

A class that holds a third of all pieces is ranked in hash blocks (``common.ranked``). A sequence
holds at most ``capacity`` pieces, so the window that lays pieces out is bounded.

Edge cases: a null or empty text is the end id alone; repeated rows are documents of their own
(``piece`` numbers tell their pieces apart); null ids stay null; an empty table gives an empty
result. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_for, hash_block, ranked, read, ship_package, staged
from .tokens import VOCABULARY, encoder

CAPACITY = 2048
END_ID = 1
#: Width of a length class in ids: at most GRAIN - 1 ids are lost a piece.
GRAIN = 8
#: The linear program stops this near to a proven lower bound, or after MOST_ROUNDS columns
#: (whole either way; an early stop costs padding only).
GAP = 2e-3
MOST_ROUNDS = 3_000

PIECES = ("doc_id {id}, piece long, start long, length long, ids_crc32 long, doc_tokens long, "
          "input_ids array<int>")


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
        end_id: int = END_ID, with_ids: bool = False, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of every document: full sequences, then the remainder."""
    id_type = docs.schema[id_col].dataType
    schema = PIECES.format(id=id_type.simpleString())
    end = array("I", [end_id]).tobytes()
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(id_type)

    def pieces(batches):
        from pyspark import TaskContext

        enc = encoder(vocabulary)
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            out = [[] for _ in range(7)]
            for i, text in enumerate(batch.column(1)):
                ids = enc.encode(text.as_py()) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    part = ids[start * 4:(start + capacity) * 4]
                    row = (i, number, start, len(part) // 4, zlib.crc32(part), n,
                           np.frombuffer(part, dtype="<i4") if with_ids else None)
                    number += 1
                    for o, v in zip(out, row):
                        o.append(v)
                if len(out[0]) >= 8000:
                    yield _batch(batch, out, id_arrow)
                    out = [[] for _ in range(7)]
            if out[0]:
                yield _batch(batch, out, id_arrow)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(pieces, schema)


def _batch(batch: pa.RecordBatch, out: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    cols = [batch.column(0).take(pa.array(out[0], pa.int64())).cast(id_type)]
    cols += [pa.array(x, pa.int64()) for x in out[1:6]]
    cols.append(pa.array(out[6], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(
        cols, ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "input_ids"])


def best_pattern(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack dynamic program: the multiset of lengths within ``capacity`` of greatest value."""
    by_length = np.zeros(capacity + 1)
    by_length[lengths] = np.maximum(value, 0.0)
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, dtype=np.int64)  # the last length taken; 0: leave a place free
    for c in range(1, capacity + 1):
        total = best[c - 1::-1] + by_length[1:c + 1]
        k = int(total.argmax())
        best[c], took[c] = total[k], (k + 1 if by_length[k + 1] > 0 else 0)
    at = np.zeros(capacity + 1, dtype=np.int64)
    c = capacity
    while c > 0:
        at[took[c]] += took[c] > 0
        c -= max(int(took[c]), 1)
    return float(best[capacity]), at[lengths]


def plan(demand: np.ndarray, lengths: np.ndarray, capacity: int, gap: float = GAP,
         most_rounds: int = MOST_ROUNDS) -> list[tuple[np.ndarray, int]]:
    """Patterns and how often to use each, so that all ``demand`` of the ``lengths`` has a slot.

    The linear program min sum(x), A x >= demand is solved by the revised simplex method with the
    explicit inverse of the basis; its columns come from :func:`best_pattern`. Rounding errors of
    the inverse can cost padding but no piece: slots are counted in whole numbers below. ``demand``
    and ``lengths`` have one entry a class, all positive.
    """
    m = len(lengths)
    if m == 0:
        return []
    need = demand.astype(float)
    basis = [np.zeros(m, dtype=np.int64) for _ in range(m)]
    cost = np.ones(m)
    for i, length in enumerate(lengths):  # to begin with: a pattern of one length for each
        basis[i][i] = capacity // length
    inverse = np.diag([1.0 / (capacity // length) for length in lengths])
    x = inverse @ need
    bound = float(need @ lengths) / capacity  # all sequences full
    for _ in range(most_rounds):
        if float(cost @ x) <= bound * (1 + gap):
            break
        duals = cost @ inverse
        low = int(np.argmin(duals))
        if duals[low] < -1e-9:  # a free slot of that class is worth more than a filled one
            column, price = np.zeros(m, dtype=np.int64), 0.0
            column[low] = -1
        else:
            value, column = best_pattern(duals, lengths, capacity)
            price = 1.0
            bound = max(bound, float(duals @ need) / value)  # duals over the value are feasible
            if value <= 1.0 + 1e-7:
                break
        u = inverse @ column
        rows = np.flatnonzero(u > 1e-9)
        if not len(rows):
            break
        ratio = x[rows] / u[rows]
        out = int(rows[np.argmin(ratio)])
        theta = max(float(ratio.min()), 0.0)
        x -= theta * u
        x[out] = theta
        pivot = inverse[out] / u[out]
        inverse -= np.outer(u, pivot)
        inverse[out] = pivot
        basis[out], cost[out] = column, price
    left = demand.astype(np.int64).copy()
    chosen = []
    for j in np.argsort(-x):
        pattern = basis[j]
        if cost[j] == 0 or not pattern.any():
            continue
        times = int(np.floor(x[j] + 1e-6))
        while times > 0 and pattern.any():
            used = pattern > 0
            fit = min(times, int((left[used] // pattern[used]).min()))
            if fit > 0:
                chosen.append((pattern.copy(), fit))
                left -= pattern * fit
                times -= fit
            pattern = np.minimum(pattern, left)  # a class with more slots than pieces: the others go on
    return chosen + _best_fit(left, lengths, capacity)


def _best_fit(left: np.ndarray, lengths: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """What rounding left, longest first, each piece where the least room remains."""
    room_of: dict[int, list[int]] = {}
    bins: list[np.ndarray] = []
    for i in np.argsort(-lengths):
        n = int(lengths[i])
        for _ in range(int(left[i])):
            room = min((r for r, b in room_of.items() if r >= n and b), default=None)
            if room is None:
                bins.append(np.zeros(len(lengths), dtype=np.int64))
                b, room = len(bins) - 1, capacity
            else:
                b = room_of[room].pop()
            bins[b][i] += 1
            room_of.setdefault(room - n, []).append(b)
    return [(b, 1) for b in bins]


def slots(patterns: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """The plan as sorted runs of slots: ranks ``rank`` .. of class ``cls`` go ``per`` to a
    sequence, from sequence ``sequence`` on."""
    cls, rank, per, first = [], [], [], []
    used: dict[int, int] = {}
    at = 0
    for pattern, times in patterns:
        for c in np.flatnonzero(pattern):
            cls.append(int(c))
            rank.append(used.get(int(c), 0))
            per.append(int(pattern[c]))
            first.append(at)
            used[int(c)] = rank[-1] + per[-1] * times
        at += times
    order = np.lexsort((rank, cls)) if cls else np.zeros(0, dtype=np.int64)
    return {k: np.array(v, dtype=np.int64)[order]
            for k, v in (("cls", cls), ("rank", rank), ("per", per), ("first", first))}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, grain: int = GRAIN, gap: float = GAP, with_ids: bool = False,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, piece; with ``with_ids``
    also input_ids). Sequences are numbered from 0; each holds at most ``capacity`` ids.
    """
    spark = docs.sparkSession
    ship_package(spark)
    pieces = staged(cut(docs, id_col, text_col, capacity, end_id, with_ids, vocabulary), "pieces")
    cls = F.ceil(F.col("length") / grain).cast("int")
    narrow = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", cls.alias("__cls"))
    seen = sorted((r[0], r[1]) for r in narrow.groupBy("__cls").count().collect())  # one row a class
    lengths = np.array([c for c, _ in seen], dtype=np.int64)
    deal = slots(plan(np.array([n for _, n in seen], dtype=np.int64), lengths, capacity // grain, gap))
    h = F.shiftrightunsigned(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), 1)
    bits = blocks_for(spark)
    narrow = narrow.withColumn("__h", h).withColumn("__block", hash_block(F.col("__h"), bits))
    narrow = ranked(narrow, ["__cls"], ["__block"], ["__h", "doc_id", "start", "ids_crc32"], "__rank")
    class_no = {int(c): i for i, c in enumerate(lengths)}
    runs = deal["cls"] * (1 << 40) + deal["rank"]

    def place(batches):
        for batch in batches:
            c = np.array([class_no[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            rank = batch.column(1).to_numpy() - 1
            run = np.searchsorted(runs, c * (1 << 40) + rank, side="right") - 1
            seq = deal["first"][run] + (rank - deal["rank"][run]) // deal["per"][run]
            yield pa.RecordBatch.from_arrays([pa.array(seq), *batch.columns[2:]],
                                             ["sequence_id", *batch.schema.names[2:]])

    keep = ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens"]
    types = {f.name: f.dataType.simpleString() for f in narrow.schema}
    placed = narrow.select("__cls", "__rank", *keep).mapInArrow(
        place, "sequence_id long, " + ", ".join(f"{k} {types[k]}" for k in keep))
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "piece")
    at = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = placed.withColumn("offset", at.cast("long"))
    out = out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "piece")
    if with_ids:
        out = out.join(pieces.select("piece", "input_ids"), "piece").select(*out.columns, "input_ids")
    return out


def op10(spark, sf_dir: str) -> DataFrame:
    """Query ``op10_pack_sequences``."""
    return pack(read(spark, sf_dir, "documents")).drop("piece")
