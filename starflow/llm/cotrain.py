"""Quality classifier by co-training.

Two views of a document are scored by two logistic regressions:

* content: how its text is written (character shares, repetition and variety of its words);
* metadata: what is known of the page without reading it: language, source, length, line layout.

Both are fitted on a bounded sample of labelled documents. Then, over ``ROUNDS`` rounds, each view
scores all unlabelled documents and marks those it is surest of, a share ``STEP`` of them in the
classes' proportions; these pseudo-labels are added to the other view's training rows. Where the
share ends is read from a histogram of all scores. A mark is a function of the models and limits so
far, so no state is kept a document. Each view is calibrated on
labelled documents that were held back (logistic calibration). A document's score is the
probability of good quality from both calibrated views, weighed by a third, two-input regression
on the documents held back.

Bounds: a fit uses at most about ``LABELLED`` labelled documents and ``POOL`` pseudo-labelled ones a
view; they are drawn by a hash over its full range, so the draw is the same on every run, does not
depend on the order of rows, and is as large on a table of any size. One row an id, and one of equal
rows, is drawn. Their features (some 100 numbers a row) and the histograms are all that reaches the
driver. Features are computed once, from whole texts, and written; every document is scored.

Edge cases: a null text counts as empty; null metadata is a value of its own; a repeated label row
counts once, with the lowest label; null labels and ids are left out of the fit. Without labelled
documents of both classes nothing can be learned: every document then gets score 1 (labelled
documents of which none was drawn are an error). Repeated rows get
equal scores; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, numbered, read, ship_package, staged

LABELLED = 12_000
POOL = 12_000
ROUNDS = 5
#: Share of the unlabelled documents that a view marks for the other one in a round.
STEP = 0.04
#: Bins of the score histogram: their width, and the scores from which all lie in the last ones.
BIN, FARTHEST = 1 / 64, 512.0
#: Documents below this probability of good quality are rejected.
KEEP_FROM = 0.5
LANG_SLOTS, SOURCE_SLOTS = 8, 32

_ASCII = [c for c in range(33, 127) if not chr(c).isalpha() and not chr(c).isdigit()]
_END = re.compile(r"[.!?:;\"')]\Z")


# ------------------------------------------------------------------ features

def content_features(text: str) -> list[float]:
    """The content view: shares of marks and character kinds, repetition and variety of words."""
    raw = text.encode("utf-8", "replace")
    size = max(1, len(raw))
    seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / size
    marks = seen[_ASCII]
    words = text.split()
    n = len(words)
    kinds = Counter(words)
    twice = sum(a == b for a, b in zip(words, words[1:]))
    top = max(kinds.values(), default=0)
    letters = seen[65:91].sum() + seen[97:123].sum() + seen[128:].sum()
    plain = sum(w.isalpha() for w in kinds)
    return [
        *np.sqrt(marks),
        math.sqrt(seen[48:58].sum()), seen[65:91].sum(), seen[97:123].sum(), seen[128:].sum(), letters,
        math.log1p(n), len(kinds) / max(1, n), len(kinds) / max(1.0, math.sqrt(n)),
        twice / max(1, n), math.sqrt(twice / max(1, n)), top / max(1, n),
        plain / max(1, len(kinds)), size / max(1, n), max(map(len, kinds), default=0) / 50,
    ]


def metadata_features(text: str, lang: str | None, source: str | None) -> list[float]:
    """The metadata view: language and source (hashed), length and line layout."""
    out = [0.0] * (LANG_SLOTS + SOURCE_SLOTS)
    out[zlib.crc32(("l:" + (lang or "")).encode()) % LANG_SLOTS] = 1.0
    out[LANG_SLOTS + zlib.crc32(("s:" + (source or "")).encode()) % SOURCE_SLOTS] = 1.0
    lines = text.split("\n")
    n = len(lines)
    sizes = [len(x) for x in lines]
    kept = [x for x in lines if x]
    mean = sum(sizes) / n
    spread = math.sqrt(sum((s - mean) ** 2 for s in sizes) / n)
    return out + [
        math.log1p(len(text)), math.log1p(n), math.log1p(mean), spread / (mean + 1), math.log1p(max(sizes)),
        1 - len(set(kept)) / max(1, len(kept)),
        sum(s < 20 for s in sizes) / n, sum(s > 400 for s in sizes) / n,
        sum(bool(_END.search(x)) for x in kept) / max(1, len(kept)),
        sum(not x[:1].isupper() for x in kept) / max(1, len(kept)),
    ]


def views(text: str | None, lang: str | None, source: str | None) -> tuple[list[float], list[float]]:
    text = text or ""
    return content_features(text), metadata_features(text, lang, source)


# ------------------------------------------------------------------ models

@dataclass
class Logistic:
    """Standardised logistic regression with a calibration line on its log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    a: float = 1.0
    b: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return (z * self.weights[:-1]).sum(axis=1) + self.weights[-1]  # the same for any batch

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.a * self.raw(x) + self.b, -6, 6)


def _newton(x: np.ndarray, y: np.ndarray, sure: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Weighted logistic regression (last column of ``x`` is 1, not penalised)."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (sure * (p - y)) + penalty * w
        # einsum: no threaded matrix library beside the JVM's threads
        h = np.einsum("ij,i,ik->jk", x, sure * np.maximum(p * (1 - p), 1e-6), x, optimize=False) + np.diag(penalty)
        step = _solve(h, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Conjugate gradients with a diagonal preconditioner for a positive definite system."""
    x = np.zeros_like(b)
    r = b.copy()
    d = 1 / np.diag(a)
    z = d * r
    p = z.copy()
    rz = float((r * z).sum())
    for _ in range(4 * len(b)):
        ap = (a * p).sum(axis=1)
        alpha = rz / max(float((p * ap).sum()), 1e-300)
        x += alpha * p
        r -= alpha * ap
        if np.abs(r).max() < 1e-10:
            break
        z = d * r
        new = float((r * z).sum())
        p = z + (new / max(rz, 1e-300)) * p
        rz = new
    return x


def fit_logistic(x: np.ndarray, y: np.ndarray, sure: np.ndarray, ridge: float = 2.0) -> Logistic:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    w = _newton(np.hstack([z, np.ones((len(z), 1))]), y, sure, ridge)
    return Logistic(mean, scale, w)


def _smoothed(y: np.ndarray) -> np.ndarray:
    """Targets a little inside 0 and 1: fits stay finite where the classes are separable."""
    good, bad = float(y.sum()), float(len(y) - y.sum())
    return np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))


def calibrate(model: Logistic, x: np.ndarray, y: np.ndarray) -> Logistic:
    """Fit the line that turns raw log odds into probabilities, on rows the model was not fitted to."""
    if len(y) >= 10 and 0 < y.sum() < len(y):
        raw = model.raw(x)
        line = np.stack([raw, np.ones(len(raw))], axis=1)
        w = _newton(line, _smoothed(y), np.ones(len(raw)), 1e-3)
        model.a, model.b = (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)
    return model


@dataclass
class CoTrained:
    content: Logistic | None
    metadata: Logistic | None
    #: Weights of both views' calibrated log odds, and what is added.
    combine: tuple[float, float, float] = (1.0, 1.0, 0.0)

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality: by content, by metadata, by both."""
        if self.content is None:
            one = np.ones(len(content))
            return one, one, one
        c, m = self.content.log_odds(content), self.metadata.log_odds(metadata)
        both = self.combine[0] * c + self.combine[1] * m + self.combine[2]
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (c, m, both))


@dataclass
class Mark:
    """What a view marks in a round, for the other view: raw scores up to ``low`` as bad, from
    ``high`` on as good."""

    view: int
    model: Logistic
    low: float
    high: float


def marks_of(marks: list[Mark], content: np.ndarray, metadata: np.ndarray) -> list[np.ndarray]:
    """Pseudo-labels (0, 1, or nan) of some rows for each view; the first mark of a row holds."""
    views_of = (content, metadata)
    out = [np.full(len(content), np.nan), np.full(len(content), np.nan)]
    for m in marks:
        raw, mine = m.model.raw(views_of[m.view]), out[1 - m.view]
        free = np.isnan(mine)
        mine[free & (raw <= m.low)] = 0.0
        mine[free & (raw >= m.high)] = 1.0
    return out


def bins_of(raw: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(raw, -FARTHEST, FARTHEST) / BIN).astype(np.int64)


def limits(bins: dict[int, int], total: int, share: float, step: float) -> tuple[float, float, int]:
    """(low, high, rows marked) from a histogram of the scores of rows without a mark: about ``step``
    of all rows, ``share`` of them good; only what lies on its own side of even odds."""
    n = max(1, int(step * total))
    low, high, marked = -math.inf, math.inf, 0
    left = max(1, round(n * (1 - share)))
    for b in sorted(x for x in bins if x < 0):
        if left <= 0:
            break
        low, left, marked = np.nextafter((b + 1) * BIN, -math.inf), left - bins[b], marked + bins[b]
    left = max(1, round(n * share))
    for b in sorted((x for x in bins if x >= 0), reverse=True):
        if left <= 0:
            break
        high, left, marked = max(b * BIN, np.nextafter(0.0, 1.0)), left - bins[b], marked + bins[b]
    return low, high, marked


class ArrayPool:
    """Unlabelled rows in memory (what :class:`SparkPool` does over a table)."""

    def __init__(self, content: np.ndarray, metadata: np.ndarray):
        self.views, self.total = (content, metadata), len(content)

    def histograms(self, marks: list[Mark], models: list[Logistic]) -> list[dict[int, int]]:
        marked, out = marks_of(marks, *self.views), []
        for v in (0, 1):
            free = np.isnan(marked[1 - v])
            b, n = np.unique(bins_of(models[v].raw(self.views[v][free])), return_counts=True)
            out.append(dict(zip(b.tolist(), n.tolist())))
        return out

    def rows(self, marks: list[Mark], sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        marked = marks_of(marks, *self.views)
        return [(x[~np.isnan(t)], t[~np.isnan(t)]) for x, t in zip(self.views, marked)]


def co_train(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, held: np.ndarray,
             pool_content: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS,
             step: float = STEP) -> CoTrained:
    """Fit both views on arrays; ``held`` marks the labelled rows kept back for calibration."""
    return co_train_over(ArrayPool(pool_content, pool_metadata), content, metadata, y, held, rounds, step)


def co_train_over(pool, content: np.ndarray, metadata: np.ndarray, y: np.ndarray, held: np.ndarray,
                  rounds: int = ROUNDS, step: float = STEP) -> CoTrained:
    """Fit both views, exchanging pseudo-labels of the rows of ``pool``."""
    if not 0 < y.sum() < len(y):
        return CoTrained(None, None)
    if not 0 < y[~held].sum() < (~held).sum():
        held = np.zeros(len(y), dtype=bool)
    xs = [content[~held], metadata[~held]]
    labels = y[~held].astype(float)
    share = labels.mean()
    marks: list[Mark] = []
    sizes = [0, 0]  # rows marked for each view
    models: list[Logistic] = []
    for r in range(rounds + 1):
        marked = pool.rows(marks, sizes) if marks else [(x[:0], labels[:0]) for x in xs]
        models = []
        for v in (0, 1):
            x, t = np.vstack([xs[v], marked[v][0]]), np.concatenate([labels, marked[v][1]])
            sure = np.concatenate([np.ones(len(labels)), np.full(len(marked[v][1]), 0.5)])
            models.append(fit_logistic(x, t, sure))
        if r == rounds or not pool.total:
            break
        for v, bins in enumerate(pool.histograms(marks, models)):
            low, high, n = limits(bins, pool.total, share, step)
            marks = [*marks, Mark(v, models[v], low, high)]
            sizes[1 - v] += n
    back = held if held.any() else np.ones(len(y), dtype=bool)
    full = (content, metadata)
    models = [calibrate(m, full[v][back], y[back].astype(float)) for v, m in enumerate(models)]
    c, m, t = models[0].log_odds(content[back]), models[1].log_odds(metadata[back]), _smoothed(y[back])
    w = _newton(np.stack([c, m, np.ones(len(t))], axis=1), t, np.ones(len(t)), 1e-2)
    return CoTrained(models[0], models[1], (max(float(w[0]), 0.0), max(float(w[1]), 0.0), float(w[2])))


# ------------------------------------------------------------------ Spark

def threshold(n: int, most: int) -> int:
    """Rows whose 63-bit hash lies below it are a draw of about ``most`` of ``n`` rows."""
    return (1 << 63) - 1 if n <= most else max(1, (most << 63) // n)


def _hash63(*cols):
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def _unpacked(column) -> np.ndarray:
    """Feature rows, kept as bytes, as a matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float32).reshape(len(rows), -1).astype(float) if rows else np.zeros((0, 0))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """(doc, id, h, content, metadata) of every row, written: the id as it is and as text, a hash of
    the row, and both views as float32 bytes."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    arrow = to_arrow_type(kind)

    def go(batches):
        for batch in batches:
            pairs = [views(*x) for x in zip(*(c.to_pylist() for c in batch.columns[1:]))]
            packed = [[np.array(p[v], dtype=np.float32).tobytes() for p in pairs] for v in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow), *[pa.array(x, pa.binary()) for x in packed]],
                                             ["doc", "content", "metadata"])

    rows = docs.select(F.col(id_col), *[F.col(c).cast("string") for c in (text_col, lang_col, source_col)])
    out = rows.mapInArrow(go, f"doc {kind.simpleString()}, content binary, metadata binary")
    key = F.col("doc").cast("string")
    return staged(out.select("doc", key.alias("id"), _hash63(key, "content", "metadata").alias("h"), "content", "metadata"),
                  "features", compression="zstd")


class SparkPool:
    """All unlabelled documents: their features, scored by a Spark job each round."""

    def __init__(self, rows: DataFrame, most: int):
        self.df, self.total, self.most = rows.select("h", "content", "metadata"), rows.count(), most

    def histograms(self, marks: list[Mark], models: list[Logistic]) -> list[dict[int, int]]:
        def go(batches):
            for batch in batches:
                both = [_unpacked(batch.column(i)) for i in (1, 2)]
                if not len(both[0]):
                    continue
                marked = marks_of(marks, *both)
                for v in (0, 1):
                    b, n = np.unique(bins_of(models[v].raw(both[v])[np.isnan(marked[1 - v])]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), v)), pa.array(b), pa.array(n)], ["v", "b", "n"])

        counted = self.df.mapInArrow(go, "v long, b long, n long").groupBy("v", "b").agg(F.sum("n").alias("n"))
        out: list[dict[int, int]] = [{}, {}]
        for r in counted.collect():  # a row a bin
            out[r.v][r.b] = r.n
        return out

    def rows(self, marks: list[Mark], sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        below = [threshold(n, self.most) for n in sizes]

        def go(batches):
            for batch in batches:
                h = batch.column(0).to_numpy()
                near = np.flatnonzero(h < max(below))
                if not len(near):
                    continue
                part = batch.take(pa.array(near))
                both = [_unpacked(part.column(i)) for i in (1, 2)]
                for v, t in enumerate(marks_of(marks, *both)):
                    hit = np.flatnonzero(~np.isnan(t) & (h[near] < below[v]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), v)), pa.array(h[near][hit]), pa.array(t[hit]),
                         part.column(1 + v).take(pa.array(hit))], ["v", "h", "t", "x"])

        drawn = self.df.mapInArrow(go, "v long, h long, t double, x binary").dropDuplicates(["v", "h"]).toArrow()
        out = []
        for v, width in enumerate(map(len, views("", None, None))):
            mine = drawn.filter(pa.compute.equal(drawn["v"], v)).sort_by("h")
            x = _unpacked(mine["x"]) if len(mine) else np.zeros((0, width))
            out.append((x, mine["t"].to_numpy().astype(float)))
        return out


def _fit(docs: DataFrame, labels: DataFrame, label_col: str, labelled: int, pool: int, rounds: int,
         id_col: str, text_col: str, lang_col: str, source_col: str) -> tuple[CoTrained, DataFrame]:
    every = features(docs, id_col, text_col, lang_col, source_col)
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).cast("string").alias("id")).agg(F.min(label_col).cast("int").alias("y"))
    drawn = known.filter(_hash63("id") < threshold(known.count(), labelled))  # about `labelled` rows
    rows = every.join(drawn, "id").groupBy("id").agg(  # one row an id: any of them, the same on every run
        F.first("y").alias("y"), F.min_by(F.struct("content", "metadata"), "h").alias("x"))
    t = rows.select("id", "y", "x.content", "x.metadata").toArrow().sort_by("id")
    if not len(t):
        if not every.join(known, "id", "left_semi").isEmpty():
            raise RuntimeError("there are labelled documents, but none was drawn")
        return CoTrained(None, None), every
    held = np.array([zlib.crc32(b"held:" + i.encode()) % 4 == 0 for i in t["id"].to_pylist()], dtype=bool)
    y = (np.array(t["y"].to_pylist()) > 0).astype(int)
    free = every.filter("id is not null").join(known, "id", "left_anti")
    model = co_train_over(SparkPool(staged(free, "unlabelled", compression="zstd"), pool), _unpacked(t["content"]),
                          _unpacked(t["metadata"]), y, held, rounds)
    return model, every


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", labelled: int = LABELLED,
        pool: int = POOL, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source") -> CoTrained:
    """Co-train on a bounded draw of labelled documents and all unlabelled ones."""
    return _fit(docs, labels, label_col, labelled, pool, rounds, id_col, text_col, lang_col, source_col)[0]


def score(model: CoTrained, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"):
    """Column of struct(content double, metadata double, score double)."""
    @F.pandas_udf("content double, metadata double, score double")
    def go(text, lang, source):
        import pandas as pd

        pairs = [views(*x) for x in zip(*(c.where(c.notna(), None) for c in (text, lang, source)))]
        c = np.array([p[0] for p in pairs], dtype=np.float32).astype(float)
        m = np.array([p[1] for p in pairs], dtype=np.float32).astype(float)
        return pd.DataFrame(dict(zip(("content", "metadata", "score"), model.scores(c, m))))

    return go(*(F.col(c).cast("string") for c in (text_col, lang_col, source_col)))


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, content_score, metadata_score, score, keep) for every document."""
    how = {"label_col": "quality", "labelled": LABELLED, "pool": POOL, "rounds": ROUNDS, "id_col": "doc_id",
           "text_col": "text", "lang_col": "lang", "source_col": "source"} | how
    model, every = _fit(docs, labels, **how)
    kind = every.schema["doc"].dataType.simpleString()

    def go(batches):
        for batch in batches:
            if batch.num_rows:
                found = model.scores(_unpacked(batch.column(1)), _unpacked(batch.column(2)))
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found), pa.array(found[2] >= KEEP_FROM)],
                                                 ["doc_id", "content_score", "metadata_score", "score", "keep"])

    return every.select("doc", "content", "metadata").mapInArrow(
        go, f"doc_id {kind}, content_score double, metadata_score double, score double, keep boolean")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns as they were."""
    model = fit(docs, labels)
    d, names = numbered(docs)
    s = d.withColumn("__s", score(model, names["text"], names["lang"], names["source"]))
    return s.filter(F.col("__s.score") >= KEEP_FROM).select(*named(names))


def op6(spark, sf_dir: str) -> DataFrame:
    """Query ``op6_cotrain_quality``."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
