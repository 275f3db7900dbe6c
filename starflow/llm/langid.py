"""Language identification of mixed-language text, span by span.

Learning: character trigrams of words (blank-padded, lower case) are counted per language over all
training documents; the counts become log probabilities in a hashed table. The scripts that the
letters of each language's training text use are learned with them.

Predicting: the script of a word's letters narrows the languages that may stand for it. Each word
gets a score per language, the sum over its trigrams. A Viterbi pass over the words, with a penalty
for each change of language, labels them; runs of equal labels are the spans. A document's language
is the one that labels most of its letters, the score that share.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and has no spans; words
without letters take the label of their neighbours; a script that no language was seen in narrows
nothing; ties go to the language first by name; repeated rows get equal results. A null language
teaches nothing; a null id counts as held in; without any training document all is ``und``. Whole
texts are read, in blocks of documents that bound memory. Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import letters, read, ship_package

#: Size of the hashed trigram table; with four languages it holds a million numbers.
TABLE_BITS = 18
SWITCH = 9.0
#: Characters scored together (a longer document goes alone).
BLOCK_CHARS = 1_500_000
UNKNOWN = "und"

#: Unicode blocks of scripts (fixed values): name, first and last code point.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF),
    ("arabic", 0x750, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = sorted({s for s, _, _ in SCRIPTS})


@lru_cache(maxsize=1)
def _script_table() -> np.ndarray:
    """Code point -> bit of its script, for letters (0: no letter or another script)."""
    t = np.zeros(0x110000, dtype=np.uint32)
    for name, a, b in SCRIPTS:
        t[a:b + 1] = 1 << SCRIPT_NAMES.index(name)
    return np.where(letters(), t, 0).astype(np.uint32)


class Words:
    """The words of a block of texts: their trigram slots, letters and scripts."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        self.lowered = lowered
        code = np.frombuffer((" " + " ".join(lowered) + "  ").encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = letters()[np.minimum(code, 0x10FFFF)]
        blank = (code == 32) | ((code >= 9) & (code <= 13))
        start = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
        self.start = start
        ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        self.end = ends
        # the document of each word
        sizes = np.array([len(t) + 1 for t in lowered], dtype=np.int64)
        first = np.concatenate([[1], 1 + np.cumsum(sizes)])
        self.first = first
        self.doc = np.searchsorted(first, start, side="right") - 1
        # trigrams of letters (others count as blanks): centred on each character of a word
        plain = np.where(letter, code, 32).astype(np.uint64)
        mixed = plain[:-2] * np.uint64(0x9E3779B1) ^ plain[1:-1] * np.uint64(0x85EBCA77) << np.uint64(7) \
            ^ plain[2:] * np.uint64(0xC2B2AE3D) << np.uint64(13)
        mixed ^= mixed >> np.uint64(29)
        self.slot = (mixed & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)  # slot[i - 1]: centre i
        self.centre = letter
        count = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
        self.letters = count[ends] - count[start]
        scripts = np.where(letter, _script_table()[np.minimum(code, 0x10FFFF)], 0).astype(np.uint32)
        self.scripts = np.bitwise_or.reduceat(scripts, start) if len(start) else np.zeros(0, np.uint32)

    def trigrams(self) -> np.ndarray:
        """Slots of all letters' trigrams."""
        return self.slot[np.flatnonzero(self.centre[1:-1])]

    def scores(self, table: np.ndarray) -> np.ndarray:
        """Sum of the table's rows over each word's trigrams: (words, languages)."""
        n, langs = len(self.start), table.shape[1]
        if n == 0:
            return np.zeros((0, langs), dtype=np.float32)
        at = np.flatnonzero(self.centre[1:-1]) + 1
        out = np.zeros((n, langs), dtype=np.float32)
        word = np.searchsorted(self.start, at, side="right") - 1
        edges = np.flatnonzero(np.diff(word, prepend=-1)) if len(at) else np.zeros(0, np.int64)
        if len(at):
            gained = table[self.slot[at - 1]]
            out[word[edges]] = np.add.reduceat(gained, edges, axis=0)
        return out


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float) -> np.ndarray:
    """Best label of every word: all documents of a block advance together, word by word.

    Staying costs nothing, any change ``penalty``. Documents are sorted by length, so that the ones
    still running are a prefix.
    """
    n, langs = scores.shape
    labels = np.zeros(n, dtype=np.int16)
    if n == 0:
        return labels
    length = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    longest = int(length[order[0]])
    running = np.searchsorted(-length[order], -np.arange(longest), side="left")  # documents longer than t
    best = scores[first[order]].astype(np.float64)
    stay = np.ones((n, langs), dtype=bool)
    switch = np.zeros(n, dtype=np.int16)  # the label to come from when not staying
    for t in range(1, longest):
        k = int(running[t])
        at = first[order[:k]] + t
        b = best[:k]
        top = b.argmax(axis=1)
        other = b[np.arange(k), top] - penalty
        keep = b >= other[:, None]
        stay[at], switch[at] = keep, top
        best[:k] = np.where(keep, b, other[:, None]) + scores[at]
    now = best.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        k = int(running[t])
        at = first[order[:k]] + t
        labels[at] = now[:k]
        if t:
            now[:k] = np.where(stay[at, now[:k]], now[:k], switch[at])
    return labels


class Model:
    """Languages, their trigram table (slots, languages) and the scripts each was seen in."""

    def __init__(self, langs: list[str], table: np.ndarray, scripts: np.ndarray):
        self.langs, self.table, self.scripts = langs, table, scripts

    def label(self, texts: list[str]) -> tuple[Words, np.ndarray]:
        w = Words(texts)
        s = w.scores(self.table)
        possible = (w.scripts[:, None] & self.scripts[None, :]) != 0
        narrowed = possible.any(axis=1)[:, None] & ~possible
        s[narrowed] -= 1e4
        return w, viterbi(s, w.doc, len(texts), SWITCH)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        n, langs = len(texts), len(self.langs)
        if not langs:
            return [UNKNOWN] * n, [0.0] * n
        w, labels = self.label([t or "" for t in texts])
        weight = np.bincount(w.doc * langs + labels, weights=w.letters, minlength=n * langs).reshape(n, langs)
        total = weight.sum(axis=1)
        top = weight.argmax(axis=1)
        share = weight[np.arange(n), top] / np.maximum(total, 1)
        return ([self.langs[k] if t > 0 else UNKNOWN for k, t in zip(top, total)],
                [float(x) if t > 0 else 0.0 for x, t in zip(share, total)])

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """(start, end, language) of the runs of a text's words, in code points."""
        if not text or not self.langs or len(text.lower()) != len(text):
            return [] if not text or not self.langs else self.spans("".join(c.lower()[:1] for c in text))
        w, labels = self.label([text])
        if not w.letters.sum():
            return []
        out: list[list] = []
        for a, b, k in zip(w.start.tolist(), w.end.tolist(), labels.tolist()):
            if out and out[-1][2] == k:
                out[-1][1] = b - 1
            else:
                out.append([a - 1, b - 1, k])
        return [(a, b, self.langs[k]) for a, b, k in out]


def _blocks(texts: list):
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= BLOCK_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Count trigrams per language over all of ``docs`` (null languages are left out).

    Each task adds up its documents per language in a table of fixed size and emits the slots it
    has filled; they are added up by slot. Slots times languages is what reaches the driver.
    """
    ship_package(docs.sparkSession)

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        script: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [t for x, t in zip(langs, texts) if x == lang and t]
                table = seen.setdefault(lang, np.zeros(1 << TABLE_BITS, dtype=np.int64))
                scripts = script.setdefault(lang, np.zeros(len(SCRIPT_NAMES), dtype=np.int64))
                for a, b in _blocks(own):
                    w = Words(own[a:b])
                    table += np.bincount(w.trigrams(), minlength=1 << TABLE_BITS)
                    for i in range(len(SCRIPT_NAMES)):
                        scripts[i] += int(w.letters[(w.scripts >> i) & 1 == 1].sum())
        for lang, table in seen.items():
            at = np.concatenate([np.flatnonzero(table), (1 << TABLE_BITS) + np.arange(len(SCRIPT_NAMES))])
            n = np.concatenate([table, script[lang]])[at]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int64)), pa.array(n)],
                                             ["lang", "slot", "n"])

    known = docs.filter(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    t = known.mapInArrow(count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    t = t.toArrow()
    names, slots, n = np.array(t["lang"].to_pylist(), dtype=object), t["slot"].to_numpy(), t["n"].to_numpy()
    langs = sorted(set(names.tolist()))
    table = np.zeros((1 << TABLE_BITS, len(langs)))
    scripts = np.zeros(len(langs), dtype=np.uint32)
    for k, lang in enumerate(langs):
        own = names == lang
        s, c = slots[own], n[own]
        tri = s < (1 << TABLE_BITS)
        table[s[tri], k] = c[tri]
        per = np.zeros(len(SCRIPT_NAMES))
        per[s[~tri] - (1 << TABLE_BITS)] = c[~tri]
        for i in np.flatnonzero(per > 0.01 * max(1.0, per.sum())):
            scripts[k] |= np.uint32(1 << int(i))
    used = max(1, int((table.sum(axis=1) > 0).sum()))
    p = (table + 0.5) / (table.sum(axis=0) + 0.5 * used)
    return Model(langs, np.log(p).astype(np.float32), scripts)


def held_out(id_col: str = "doc_id"):
    """Is the document kept from learning: crc32 of its id's text leaves remainder 1 by 3."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, from its text alone."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship_package(spark)
    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)
    shared = spark.sparkContext.broadcast(model)  # a table of fixed size

    def go(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            names, scores = [], []
            for a, b in _blocks(texts):
                x, y = shared.value.predict(texts[a:b])
                names += x
                scores += y
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_arrow), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col), held_out(id_col).alias("h"), F.col(text_col).cast("string")).mapInArrow(
        go, f"doc_id {id_type.simpleString()}, held_out boolean, lang_pred string, score double")


def op8(spark, sf_dir: str) -> DataFrame:
    """Query ``op8_language_spans``."""
    docs = read(spark, sf_dir, "documents")
    return identify(docs, learn(docs.filter(~held_out())))
