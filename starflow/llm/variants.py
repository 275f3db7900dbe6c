"""Spelling variant grouping by a trie of letter-group counts.

Words are runs of letters of the texts, counted over the whole corpus. Two words are near if one
inserted, deleted or replaced code point turns one into the other; a word's *form* is its most
frequent near word that is frequent enough, its *root* the last word that forms lead to.

Method. The alphabet is dealt into ``GROUPS`` letter groups. A word's frequency vector says how
often each group occurs in it. The trie arranges words by these counts, one group a level. One edit
adds at most one to a single count and takes at most one from a single count, so a depth-first
search for a word may follow, at every level, its own count, one more (spending its *surplus*) or
one less (spending its *deficit*), each once on the whole path. The words of a leaf that is reached
are verified: the untouched half of a word (its first or its last code points) must be equal, which
is a look-up in the leaf, and then the whole words are compared.

Spark. The upper trie levels are the shuffle key. A prefix of the vector is one 64-bit number, the
counts weighed by fixed odd numbers, so that a surplus or deficit in a group is one addition. Words
lie in the shard of the shortest of the prefixes (``STAGES``) that holds at most ``SHARD_WORDS``
words; a word asks every shard that its budget reaches, going down only below prefixes that were
too full. A shard's questions are dealt into blocks of about ``BLOCK_QUERIES``, each with the
shard's words, so neither side of a group is unbounded; words of one whole vector beyond the limit
are dealt into blocks too. What a block finds is aggregated per word before it is shuffled.

Bounds. A word asks at most 7 shards of the first prefix (2 groups); the number of candidates a
leaf gives is bounded by words that share half of their letters in place.

Edge cases: a null or empty text has no runs; a null id counts as an empty one in the crc; repeated
rows are documents of their own and count again; very long runs are words like any other; ties go to
the word that is smaller in code-point order. Columns besides id and text are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, ship_package, staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_CHARS, MIN_COUNT, DAMAGE = 5, 3, 97
GROUPS = 16
#: Letters in about the order of their frequency (any order gives the same result): dealt to the
#: groups in turn, so that frequent letters lie in different groups.
LETTERS = "etaoinshrdlcumwfgypbvkxjqz"
#: Prefix lengths of the vector that may be a shard.
STAGES = (2, 4, 8, GROUPS)
SHARD_WORDS, BLOCK_QUERIES = 40_000, 80_000
#: Counts of words that a task holds before it hands them on.
HELD_WORDS = 400_000
#: Partial paths that the search expands at once.
FRONTIER = 200_000

_M64 = (1 << 64) - 1
#: Odd weights of the groups in a prefix number: no two ways to spend the budget add the same.
WEIGHTS = [int.from_bytes(hashlib.sha256(b"group %d" % i).digest()[:8], "big") | 1 for i in range(GROUPS)]


def _signed(x: int) -> int:
    x &= _M64
    return x - (1 << 64) if x >> 63 else x


def _group_table() -> np.ndarray:
    table = np.arange(0x100) % GROUPS
    for i, c in enumerate(LETTERS):
        table[ord(c)] = table[ord(c.upper())] = i % GROUPS
    return table


_GROUP = _group_table()


# ------------------------------------------------------------------ words

def words_of(doc_id, text: str | None) -> Counter:
    """Words of a text and their counts: runs lower-cased (A-Z only), some with one letter lost."""
    out: Counter = Counter()
    if not text:
        return out
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text)).items():
        low = run.encode().lower()  # bytes: ASCII letters only
        word = low.decode()
        h = zlib.crc32(low, seed)
        if h % DAMAGE == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= MIN_CHARS:
            out[word] += n
    return out


def _counted(batches):
    held: Counter = Counter()

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                           ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            held.update(words_of(doc_id, text.as_py()))
            if len(held) >= HELD_WORDS:
                yield out()
    if held:
        yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    parts = rows.mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# ------------------------------------------------------------------ vectors

def vectors(words: list[str]) -> np.ndarray:
    """Row i: how often each letter group occurs in word i."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    group = np.where(flat < 0x100, _GROUP[np.minimum(flat, 0xFF)], flat % GROUPS)
    at = np.repeat(np.arange(len(words)), sizes) * GROUPS + group
    return np.bincount(at, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def prefix_numbers(vecs: np.ndarray) -> list[np.ndarray]:
    """The number of each prefix in ``STAGES``, as signed 64-bit integers."""
    weights = np.array(WEIGHTS, dtype=np.uint64)
    sums = np.cumsum(vecs.astype(np.uint64) * weights, axis=1, dtype=np.uint64)
    return [np.ascontiguousarray(sums[:, s - 1]).view(np.int64) for s in STAGES]


def _keyed(batches):
    names = ["word", "n", *[f"k{i}" for i in range(len(STAGES))]]
    for batch in batches:
        keys = prefix_numbers(vectors(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, keys)], names)


def _steps(stage: int) -> list[tuple[int, int, int]]:
    """(what is added to the prefix number, surplus spent, deficit spent) by one stage's groups."""
    groups = range(STAGES[stage - 1] if stage else 0, STAGES[stage])
    out = [(0, 0, 0)]
    out += [(_signed(WEIGHTS[i]), 1, 0) for i in groups] + [(_signed(-WEIGHTS[i]), 0, 1) for i in groups]
    out += [(_signed(WEIGHTS[i] - WEIGHTS[j]), 1, 1) for i in groups for j in groups if i != j]
    return out


# ------------------------------------------------------------------ the trie of one shard

def is_near(a: str, b: str) -> bool:
    """Does exactly one inserted, deleted or replaced code point turn ``a`` into ``b``?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


class Trie:
    """Words arranged by successive letter-group counts. Level ``d`` keeps the sorted keys
    (parent node, count) of its nodes; a node is its place among them."""

    def __init__(self, words: list[str]):
        vecs = vectors(words)
        order = np.lexsort(vecs.T[::-1])
        self.words = [words[i] for i in order]
        vecs = vecs[order]
        self.base = int(vecs.max(initial=0)) + 3
        self.levels = []
        node = np.zeros(len(words), dtype=np.int64)
        for d in range(GROUPS):
            keys, node = np.unique(node * self.base + vecs[:, d] + 1, return_inverse=True)
            self.levels.append(keys)
        self.sizes = vecs.sum(axis=1)
        self.length = np.zeros(len(self.levels[-1]), dtype=np.int64)  # of a leaf's words
        self.length[node] = self.sizes
        # the leaf's words by their first and their last code points: (leaf, hash) in order
        self.by_half = {}
        for short in (0, 1):  # a word that asks is at least as long, or one shorter
            for last in (False, True):
                key = self._mix(node, self.halves(self.words, self.sizes, short, last))
                by = np.argsort(key, kind="stable")
                self.by_half[short, last] = key[by], by

    @staticmethod
    def halves(words: list[str], sizes: np.ndarray, short: int, last: bool) -> np.ndarray:
        cut = ((sizes - short) // 2).tolist()
        each = ((w[len(w) - h:] if last else w[:h]) for w, h in zip(words, cut))
        return np.fromiter(map(hash, each), dtype=np.int64, count=len(words))

    @staticmethod
    def _mix(leaf: np.ndarray, half: np.ndarray) -> np.ndarray:
        return (leaf.astype(np.uint64) * np.uint64(WEIGHTS[3])) ^ half.view(np.uint64)

    def leaves(self, vecs: np.ndarray):
        """(asking row, leaf) pairs within the budget, depth first and a block of paths at a time."""
        n = len(vecs)
        zero = np.zeros(n, dtype=bool)
        stack = [(0, np.arange(n), np.zeros(n, dtype=np.int64), zero, zero)]
        while stack:
            depth, row, node, surplus, deficit = stack.pop()
            if depth == GROUPS:
                yield row, node
                continue
            if len(row) > FRONTIER:
                for i in range(0, len(row), FRONTIER):
                    part = slice(i, i + FRONTIER)
                    stack.append((depth, row[part], node[part], surplus[part], deficit[part]))
                continue
            keys = self.levels[depth]
            found = []
            for step in (0, 1, -1):
                free = ~surplus if step > 0 else ~deficit if step < 0 else slice(None)
                count = vecs[row[free], depth] + step
                inside = (count >= 0) & (count + 1 < self.base)
                want = node[free] * self.base + np.where(inside, count + 1, 0)
                at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                hit = inside & (keys[at] == want)
                s, d = surplus[free][hit], deficit[free][hit]
                found.append((row[free][hit], at[hit], s | (step > 0), d | (step < 0)))
            stack.append((depth + 1, *map(np.concatenate, zip(*found))))

    def near(self, words: list[str]):
        """(asking word's place, near word's place) pairs, verified, each once."""
        if not self.words:
            return
        vecs = vectors(words)
        sizes = vecs.sum(axis=1)
        half = {(short, last): self.halves(words, sizes, short, last) for short in (0, 1) for last in (False, True)}
        mine = self.words
        for row, leaf in self.leaves(vecs):
            shorter = self.length[leaf] < sizes[row]  # the leaf's words are one shorter than the asking word
            longer = self.length[leaf] > sizes[row]
            for kind in (False, True):
                # both sides cut at half of the shorter word
                some = longer == kind
                r, f, less = row[some], leaf[some], shorter[some]
                for last in (False, True):
                    keys, by = self.by_half[int(kind), last]
                    asked = np.where(less, half[1, last][r], half[0, last][r])
                    want = self._mix(f, asked)
                    lo, hi = np.searchsorted(keys, want, "left"), np.searchsorted(keys, want, "right")
                    n = hi - lo
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    for q, t in zip(np.repeat(r, n).tolist(), by[at].tolist()):
                        a, b = words[q], mine[t]
                        h = min(len(a), len(b)) // 2
                        if is_near(a, b) and not (last and a[:h] == b[:h]):  # found by its first half
                            yield q, t


_FOUND = "word string, n_near long, best struct<least: long, form: string>"


def _search(shard, asking):
    """One block: what its asking words find among the shard's words."""
    import pandas as pd

    trie = Trie(shard["word"].tolist())
    n_of = dict(zip(shard["word"], shard["n"]))
    words = asking["word"].tolist()
    near: Counter = Counter()
    best: dict[int, tuple[int, str]] = {}
    for q, t in trie.near(words):
        near[q] += 1
        word = trie.words[t]
        mark = (-int(n_of[word]), word)
        if q not in best or mark < best[q]:
            best[q] = mark
    rows = [(words[q], n, {"least": best[q][0], "form": best[q][1]}) for q, n in near.items()]
    return pd.DataFrame(rows, columns=["word", "n_near", "best"])


# ------------------------------------------------------------------ Spark

def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(word, n_near, best) of the words that have near words; ``words`` is (word, n), no repeats.
    ``best`` is (-n, word) of the most frequent near word."""
    vec = staged(words.select("word", F.col("n").cast("long").alias("n")).mapInArrow(
        _keyed, "word string, n long, " + ", ".join(f"k{i} long" for i in range(len(STAGES)))), "vectors")
    rest = vec.withColumn("level", F.lit(-1))  # words that have no shard yet
    ask = vec.select("word", *[f"k{i}" for i in range(len(STAGES))], F.lit(0).cast("long").alias("off"),
                     F.lit(0).alias("su"), F.lit(0).alias("de"))
    placed, asked = [], []
    for s in range(len(STAGES)):
        at_end = s == len(STAGES) - 1
        size = staged(rest.groupBy(F.col(f"k{s}").alias("key")).agg(F.count(F.lit(1)).alias("size")), "prefixes")
        full = F.col("size") > shard_words
        blocks = F.ceil(F.col("size") / shard_words).cast("int") if at_end else F.lit(1)
        here = rest.withColumn("key", F.col(f"k{s}")).join(size, "key")
        steps = F.array(*[F.struct(F.lit(o).cast("long").alias("o"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                          for o, a, b in _steps(s)])
        moves = ask.withColumn("step", F.explode(steps)).filter("su + step.a <= 1 and de + step.b <= 1")
        # numbers wrap around: hashes, not sums
        moves = moves.withColumns({"off": _wrapped("off", "step.o"),
                                   "su": F.expr("su + step.a"), "de": F.expr("de + step.b")}).drop("step")
        moves = moves.withColumn("key", _wrapped(f"k{s}", "off")).join(size, "key")
        done = F.lit(True) if at_end else ~full
        placed.append(here.filter(done).select(
            F.lit(s).alias("level"), "key", F.pmod(F.xxhash64("word"), blocks).cast("int").alias("part"), "word", "n"))
        asked.append(moves.filter(done).select(
            F.lit(s).alias("level"), "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("part"), "word"))
        if at_end or size.filter(full).isEmpty():
            break
        rest = here.filter(full).drop("key", "size")
        ask = moves.filter(full).drop("key", "size")
    shards, asks = placed[0], asked[0]
    for p, a in zip(placed[1:], asked[1:]):
        shards, asks = shards.unionByName(p), asks.unionByName(a)
    place = ["level", "key", "part"]
    asks = staged(asks, "asks")
    dealt = asks.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("blocks"))
    dealt = staged(dealt, "blocks")
    shards = shards.join(dealt, place).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    shards = staged(shards, "shards")
    asks = asks.join(dealt, place).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    keys = [*place, "block"]
    found = (shards.groupBy(*keys).cogroup(asks.groupBy(*keys))
             .applyInPandas(lambda x, y: _search(x, y), _FOUND))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def _wrapped(a: str, b: str):
    """Sum modulo 2^64 of two longs (a plain sum raises on overflow): added in halves."""
    low = f"(({a}) & 4294967295) + (({b}) & 4294967295)"
    high = f"shiftrightunsigned({a}, 32) + shiftrightunsigned({b}, 32) + shiftrightunsigned({low}, 32)"
    return F.expr(f"shiftleft({high}, 32) | (({low}) & 4294967295)")


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, by doubling the steps each round."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = staged(at.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")
    raise RuntimeError("forms did not settle")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_COUNT,
             factor: int = 2, shard_words: int = SHARD_WORDS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus."""
    words = staged(word_counts(docs, id_col, text_col, least), "words")
    near = near_words(words, shard_words, block_queries)
    form = F.when(-F.col("best.least") >= factor * F.col("n"), F.col("best.form"))
    known = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), -F.col("best.least")).alias("form_n")), "variants")
    ends = roots(known.filter("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    """Query ``op13_spelling_variants``."""
    return variants(read(spark, sf_dir, "documents"))
