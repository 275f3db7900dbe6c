"""Cross-tokenizer alignment by merge-path partitioning.

A text is encoded by two tokenizers, A (byte-level BPE, a blank put in front) and B (pieces with
byte fallback, which puts the blank there itself). Both cut the same bytes, so each is a sorted list
of byte ends. Merging the two lists gives everything: every distinct end is one *link*, of the A and
the B token that hold the byte before it, and the ends that both have cut the tokens into *groups*.

Merge path. The merge of two sorted lists is a path through a grid; the diagonal ``i + j = d`` is
crossed at the place a binary search finds. Cutting the path at every ``STEPS`` diagonals gives
independent pieces of equal work, whatever the tokens look like (equal ends stay together). A piece
needs only its tokens, the next one of each side, and the byte it starts at. It emits its links and
its groups; the group that a cut goes through is stitched from the open ends of the pieces.

Spark. A text of one piece is aligned where it is encoded. The pieces of longer texts are rows: they
are dealt over all tasks, aligned there, and stitched per text. Documents are held in blocks of about
``BLOCK_PAIRS`` distinct (document, id pair) entries, and a block shuffles each id pair once, with
the number of its documents. Counts are summed over the blocks, the highest count of each A id is
taken, and the counts come back to the blocks by a join. Nothing is broadcast or collected.

Edge cases: texts that are null or empty, or whose tokens' bytes differ from a blank and the text
(a text that holds U+2581), have no tokens: zeros and an empty digest. The strings of special tokens
are plain text. Every row is a document of its own in the counts, repeated rows and ids too, and a
null id is kept. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, ship_package, staged
from .tokens import _byte_chars

VOCABULARY_A, RANKS_A, VOCABULARY_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
LONG_RUN = 2_000
#: Merged ends in a piece.
STEPS = 1 << 15
#: (document, id pair) entries in a block, about.
BLOCK_PAIRS = 1_000_000
#: An id pair as one number: A id * PAIR + B id.
PAIR = 1 << 20


# ------------------------------------------------------------------ tokenizers

class Tokenizers:
    """Both tokenizers, the byte lengths of their ids, and the ids in decimal with each mark.

    A's vocabulary is also there as ranks, which give the same ids faster; a text with a run of more
    than ``LONG_RUN`` characters between blanks is left to the vocabulary's own library."""

    def __init__(self, a: str = VOCABULARY_A, ranks: str = RANKS_A, b: str = VOCABULARY_B):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(a))
        self.whole.encode_special_tokens = True  # their strings in a text are text
        chars = set(_byte_chars().values())  # one a byte
        size = self.whole.get_vocab_size()
        self.a_len = np.array([sum(c in chars for c in self.whole.id_to_token(i)) for i in range(size)])
        with open(public_tokenizers.path(ranks), "rb") as f:
            merges = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(b))
        self.raw = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                    else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.b_len = np.array(list(map(len, self.raw)))
        ids = np.arange(max(size, len(self.raw))).astype(np.bytes_)
        self.marked = {m: np.char.add(ids, m.encode()) for m in ",|;"}

    def encode(self, text: str | None):
        """(A ids, B ids) as unsigned 32-bit numbers, or None for a text without tokens."""
        if not text:
            return None
        b = self.b.encode(text, num_threads=1) if "▁" not in text else []
        blank = " " + text
        if b"".join(map(self.raw.__getitem__, b)) != blank.encode():
            return None
        if max(map(len, text.split()), default=0) > LONG_RUN:
            a = self.whole.encode(blank, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(blank)
        a, b = np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32)
        return (a, b) if self.a_len[a].sum() == self.b_len[b].sum() else None


@lru_cache(maxsize=1)
def tokenizers() -> Tokenizers:
    """One pair a Python worker."""
    return Tokenizers()


# ------------------------------------------------------------------ merge path

def crossing(a_ends: np.ndarray, b_ends: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many ends of A and of B lie before the merge path's ``diagonal``-th step (A first where
    both are equal; an equal pair is not cut apart)."""
    lo, hi = max(0, diagonal - len(b_ends)), min(diagonal, len(a_ends))
    while lo < hi:
        mid = (lo + hi) // 2
        if a_ends[mid] <= b_ends[diagonal - 1 - mid]:
            lo = mid + 1
        else:
            hi = mid
    i, j = lo, diagonal - lo
    if i and j < len(b_ends) and b_ends[j] == a_ends[i - 1]:
        j += 1
    return i, j


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, steps: int) -> list[tuple[int, int]]:
    """The places that cut the merge path into pieces of ``steps`` merged ends."""
    total = len(a_ends) + len(b_ends)
    places = [(0, 0)]
    for d in range(steps, total, steps):
        place = crossing(a_ends, b_ends, d)
        if place != places[-1] and place != (len(a_ends), len(b_ends)):
            places.append(place)
    return [*places, (len(a_ends), len(b_ends))]


def _listed(tok: Tokenizers, a, a_group, b, b_group, groups: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` of complete groups, their tokens in order."""
    if not groups:
        return b""
    of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    out = np.empty(len(a) + len(b), dtype=tok.marked[","].dtype)
    last = np.zeros(len(a), dtype=bool)
    last[np.cumsum(of_a) - 1] = True
    out[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[a_group]] = np.where(last, tok.marked["|"][a], tok.marked[","][a])
    last = np.zeros(len(b), dtype=bool)
    last[np.cumsum(of_b) - 1] = True
    out[np.arange(len(b)) + np.cumsum(of_a)[b_group]] = np.where(last, tok.marked[";"][b], tok.marked[","][b])
    return _unpadded(out)[:-1]


def _unpadded(out: np.ndarray) -> bytes:
    """The texts of an array, one after the other."""
    chars = out.view(np.uint8)
    return chars[chars != 0].tobytes()


def _plain(tok: Tokenizers, ids) -> bytes:
    return _unpadded(tok.marked[","][ids])


def align_piece(tok: Tokenizers, a, b, a_own: int, b_own: int, a_start: int, b_start: int) -> dict:
    """One piece: its first ``a_own`` and ``b_own`` tokens end in it, one more of each may follow."""
    a_ends, b_ends = a_start + np.cumsum(tok.a_len[a]), b_start + np.cumsum(tok.b_len[b])
    a_in, b_in = a_ends[:a_own], b_ends[:b_own]
    ends = np.concatenate([a_in, b_in])
    ends.sort(kind="stable")
    new = np.ones(len(ends), dtype=bool)
    new[1:] = ends[1:] != ends[:-1]
    common, ends = ends[~new], ends[new]
    pair = a[np.searchsorted(a_ends, ends)].astype(np.int64) * PAIR + b[np.searchsorted(b_ends, ends)]
    codes, times = np.unique(pair, return_counts=True)
    a_group, b_group = np.searchsorted(common, a_in), np.searchsorted(common, b_in)
    a_id, b_id, n = a[:a_own], b[:b_own], len(common)
    # group 0 may have begun in an earlier piece, group n ends in a later one
    a0, b0 = np.searchsorted(a_group, 1), np.searchsorted(b_group, 1)
    an, bn = np.searchsorted(a_group, n), np.searchsorted(b_group, n)
    if n == 0:
        a0 = b0 = an = bn = 0
    body = _listed(tok, a_id[a0:an], a_group[a0:an] - 1, b_id[b0:bn], b_group[b0:bn] - 1, n - 1) if n else b""
    return {"n_links": len(ends), "n_groups": n, "codes": codes, "times": times, "body": body,
            "head": (_plain(tok, a_id[:a0]), _plain(tok, b_id[:b0])), "tail": (_plain(tok, a_id[an:]), _plain(tok, b_id[bn:]))}


def stitch(pieces: list[dict]) -> dict:
    """The pieces of one text, in order, as one: counts summed, groups joined where they were cut."""
    out, open_a, open_b = [], b"", b""
    for p in pieces:
        if p["n_groups"]:
            out.append((open_a + p["head"][0])[:-1] + b"|" + (open_b + p["head"][1])[:-1])
            if p["n_groups"] > 1:
                out.append(p["body"])
            open_a = open_b = b""
        open_a, open_b = open_a + p["tail"][0], open_b + p["tail"][1]
    codes, at = np.unique(np.concatenate([p["codes"] for p in pieces]), return_inverse=True)
    times = np.bincount(at, weights=np.concatenate([p["times"] for p in pieces]), minlength=len(codes)).astype(np.int64)
    return {"n_links": sum(p["n_links"] for p in pieces), "n_groups": sum(p["n_groups"] for p in pieces),
            "codes": codes, "times": times, "text": b";".join(out)}


def pieces_of(tok: Tokenizers, a: np.ndarray, b: np.ndarray, steps: int):
    """Arguments of :func:`align_piece` for every piece of a text."""
    a_ends, b_ends = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
    places = cuts(a_ends, b_ends, steps)
    for (i, j), (i1, j1) in zip(places, places[1:]):
        yield (a[i:i1 + 1], b[j:j1 + 1], i1 - i, j1 - j, int(a_ends[i - 1]) if i else 0, int(b_ends[j - 1]) if j else 0)


# ------------------------------------------------------------------ rows

_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_NUMBERS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_PIECE = [("text", pa.int64()), ("piece", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("a_own", pa.int64()),
          ("b_own", pa.int64()), ("a_start", pa.int64()), ("b_start", pa.int64())]
_PIECE_DDL = "text long, piece int, a binary, b binary, a_own long, b_own long, a_start long, b_start long"


def _rows(fields: list, **columns) -> pa.RecordBatch:
    """A batch of the columns given; the others are null."""
    n = len(next(iter(columns.values())))
    arrays = [columns[k] if isinstance(columns.get(k), pa.Array) else pa.array(columns[k], t) if k in columns else pa.nulls(n, t)
              for k, t in fields]
    return pa.RecordBatch.from_arrays(arrays, [k for k, _ in fields])


class _Block:
    """Documents held until their entries fill a block; then one batch of documents, one of id pairs."""

    def __init__(self, fields: list, id_arrow, most: int):
        self.fields, self.id_arrow, self.most = fields, id_arrow, most
        self.docs: list[tuple] = []
        self.codes: list[np.ndarray] = []
        self.entries = 0

    def add(self, doc_id, n_a: int, n_b: int, found: dict | None) -> bool:
        """Take a document in; is the block full?"""
        text, codes, times = (found["text"], found["codes"], found["times"]) if found else (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
        digest = hashlib.sha256(text).hexdigest() if found else ""
        self.docs.append((doc_id, n_a, n_b, found["n_groups"] if found else 0, found["n_links"] if found else 0, digest,
                          times.astype(np.uint32).tobytes()))
        self.codes.append(codes)
        self.entries += len(codes) + 1
        return self.entries >= self.most

    def batches(self, block: int):
        if not self.docs:
            return
        sizes = np.array(list(map(len, self.codes)))
        pairs, at = np.unique(np.concatenate(self.codes), return_inverse=True)
        where = [x.astype(np.uint32).tobytes() for x in np.split(at, np.cumsum(sizes)[:-1])]
        ids, *numbers, times = zip(*self.docs)
        yield _rows(self.fields, block=np.full(len(ids), block), doc_id=pa.array(ids, self.id_arrow),
                    **{k: list(v) for (k, _), v in zip(_NUMBERS, numbers)}, at=where, times=list(times))
        counts = np.bincount(at, minlength=len(pairs))
        for i in range(0, len(pairs), 100_000):
            part = slice(i, i + 100_000)
            yield _rows(self.fields, block=np.full(len(pairs[part]), block), pair=pairs[part], docs=counts[part])
        self.docs, self.codes, self.entries = [], [], 0


def _fields(id_arrow) -> list:
    return [("block", pa.int64()), ("doc_id", id_arrow), *_NUMBERS, ("at", pa.binary()), ("times", pa.binary()),
            ("pair", pa.int64()), ("docs", pa.int64()), *_PIECE]


def _ddl(id_type: str) -> str:
    return f"block long, doc_id {id_type}, {_DOC}, at binary, times binary, pair long, docs long, {_PIECE_DDL}"


def _first_number() -> int:
    """Numbers from here on are this task's alone (what is written is one attempt's)."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 32


# ------------------------------------------------------------------ Spark

def blocks_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS,
              block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Aligned documents and their id pairs in blocks: rows of documents have ``at`` and ``times``
    (entries into the block's sorted pairs), rows of pairs ``pair`` and ``docs``."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship_package(spark)
    kind = docs.schema[id_col].dataType
    id_arrow, id_type = to_arrow_type(kind), kind.simpleString()
    fields = _fields(id_arrow)

    def encode(batches):
        tok, block, number = tokenizers(), _Block(fields, id_arrow, block_pairs), _first_number()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                number += 1
                ids = tok.encode(text.as_py())
                if ids is None:
                    full = block.add(doc_id, 0, 0, None)
                else:
                    pieces = list(pieces_of(tok, *ids, steps))
                    if len(pieces) > 1:
                        for i in range(len(pieces)):
                            a, b, *rest = pieces[i]
                            yield _rows(fields, doc_id=pa.array([doc_id], id_arrow), n_a=[len(ids[0])], n_b=[len(ids[1])],
                                        text=[number], piece=[i], a=[a.tobytes()], b=[b.tobytes()],
                                        **{k: [v] for k, v in zip(("a_own", "b_own", "a_start", "b_start"), rest)})
                        continue
                    full = block.add(doc_id, len(ids[0]), len(ids[1]), stitch([align_piece(tok, *pieces[0])]))
                if full:
                    yield from block.batches(number)
        yield from block.batches(number)

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    first = staged(rows.mapInArrow(encode, _ddl(id_type)), "aligned", compression="zstd")

    piece_ddl = (f"doc_id {id_type}, n_a long, n_b long, text long, piece int, n_links long, n_groups long, codes binary, "
                 "times binary, body binary, head_a binary, head_b binary, tail_a binary, tail_b binary")
    names = [x.split()[0] for x in piece_ddl.split(", ")]

    def align(batches):
        tok = tokenizers()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                found = align_piece(tok, np.frombuffer(row["a"], np.uint32), np.frombuffer(row["b"], np.uint32),
                                    *(row[k] for k in ("a_own", "b_own", "a_start", "b_start")))
                out = [row["doc_id"], row["n_a"], row["n_b"], row["text"], row["piece"], found["n_links"], found["n_groups"],
                       found["codes"].tobytes(), found["times"].tobytes(), found["body"], *found["head"], *found["tail"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], id_arrow if k == "doc_id" else pa.binary() if isinstance(v, bytes) else
                              pa.int32() if k == "piece" else pa.int64()) for k, v in zip(names, out)], names)

    def stitched(text: pa.Table) -> pa.Table:
        rows = sorted(text.to_pylist(), key=lambda r: r["piece"])
        found = stitch([{"n_links": r["n_links"], "n_groups": r["n_groups"], "codes": np.frombuffer(r["codes"], np.int64),
                         "times": np.frombuffer(r["times"], np.int64), "body": r["body"], "head": (r["head_a"], r["head_b"]),
                         "tail": (r["tail_a"], r["tail_b"])} for r in rows])
        block = _Block(fields, id_arrow, 1)
        block.add(rows[0]["doc_id"], rows[0]["n_a"], rows[0]["n_b"], found)
        return pa.Table.from_batches(block.batches(-rows[0]["text"]))  # a block of its own

    pieces = first.filter("text is not null").select("doc_id", "n_a", "n_b", *[k for k, _ in _PIECE])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long = pieces.repartition(parts, "text", "piece").mapInArrow(align, piece_ddl).groupBy("text").applyInArrow(stitched, _ddl(id_type))
    second = staged(long, "stitched", compression="zstd")
    return first.filter("text is null").unionByName(second).drop(*[k for k, _ in _PIECE])


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", steps: int = STEPS,
          block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_kind)
    blocks = blocks_of(docs, id_col, text_col, steps, block_pairs)
    pairs = blocks.filter("pair is not null").select("block", "pair", "docs")
    counts = staged(pairs.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    own = F.floor(F.col("pair") / PAIR)
    top = counts.groupBy(own.alias("a")).agg(F.max("n").alias("top"))
    known = counts.withColumn("a", own).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    back = pairs.drop("docs").join(known, "pair")
    held = blocks.filter("pair is null").drop("pair", "docs").withColumnRenamed("block", "of_block")

    def weigh(values: pa.Table, rows: pa.Table) -> pa.Table:
        order = np.argsort(values["pair"].to_numpy(), kind="stable")
        n = values["n"].to_numpy()[order].astype(np.int64) if len(order) else np.zeros(0, np.int64)
        best = values["best"].to_numpy()[order].astype(bool) if len(order) else np.zeros(0, bool)
        n_best, total = [], []
        for at, times in zip(rows["at"].to_pylist(), rows["times"].to_pylist()):
            at, times = np.frombuffer(at, np.uint32), np.frombuffer(times, np.uint32).astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            total.append(int((times * n[at]).sum()))
        return pa.table([rows["doc_id"].cast(id_arrow), *[rows[k] for k in ("n_a", "n_b", "n_groups", "n_links")],
                         pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), rows["groups_sha256"]],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return back.groupBy("block").cogroup(held.groupBy("of_block")).applyInArrow(
        weigh, f"doc_id {id_kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
               "count_sum long, groups_sha256 string")


def op11(spark, sf_dir: str) -> DataFrame:
    """Query ``op11_token_alignment``."""
    return align(read(spark, sf_dir, "documents"))
