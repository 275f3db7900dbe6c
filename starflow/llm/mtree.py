"""Exact top-k search by inner product with an M-tree, searched best first.

Metric. Integer vectors x get one more coordinate, sqrt(M^2 - |x|^2), M the greatest norm; a query
gets 0. Then the squared distance is |q|^2 + M^2 - 2 q.x: the nearest vectors are those of the
highest inner product, and distances obey the triangle inequality.

Tree. Vectors go to the nearest of a bounded sample of pivots; a pivot's vectors are cut by a hash
into subtrees of at most ``SUBTREE`` vectors, so that neither a dense region nor many copies of a
vector make a large one. Within a subtree, pages of at most ``PAGE`` entries are built bottom-up;
each holds its routing vector, its covering radius and its entries' distances to the routing
vector. Pages are written to the shared folder; every vector is in exactly one leaf page.

Search. Queries, in blocks of at most ``QUERIES``, meet the subtrees. First each query searches the
subtree nearest to it, which gives a bound on its k-th distance. Then every other subtree whose
covering ball reaches within that bound is searched. Inside a subtree pages wait in a queue by
their least possible distance; a page whose bound is beyond the k-th distance is not opened, and an
entry is skipped without a distance computation when its stored distance to the routing vector
already rules it out. Bounds have a margin for rounding; scores are computed in whole numbers, so
results are exact.

Edge cases: vectors that are null, empty, or hold null or non-finite components take no part; nor do rows
without an id; rows of one id are separate candidates, and none of them is a candidate of that id's
own query, which asks once (with the least vector of its rows); of vectors of other lengths than the commonest, each length is searched by itself. Ties go to
the smaller id. Fewer than k candidates: all. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, ship_package, staged

K = 20
SCALE = 64
SUBTREE = 4096
PAGE = 512
QUERIES = 4096
#: Pivots are drawn from a sample of at most this many vectors.
SAMPLE = 20_000
#: Added to distance bounds for rounding; neighbouring scores lie farther apart.
MARGIN = 1e-3


def vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array of long): floor(scale * x) of every usable vector."""
    x = F.col(vec_col)
    ok = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return df.filter(F.coalesce(ok, F.lit(False)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column]) if len(column) else np.zeros((0, 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products of rows; floats carry them exactly below 2^53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2 ** 53:
        return np.rint(np.einsum("ij,kj->ik", a.astype(float), b.astype(float), optimize=True)).astype(np.int64)
    return np.einsum("ij,kj->ik", a, b)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Data vectors with the coordinate that turns inner products into distances."""
    rest = np.sqrt(np.maximum(top - (x.astype(float) ** 2).sum(axis=1), 0.0))
    return np.hstack([x.astype(float), rest[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * np.einsum("ij,kj->ik", a, b, optimize=True)
    return np.sqrt(np.maximum(d, 0.0))


# ------------------------------------------------------------------ pages

def build(x: np.ndarray, page: int = PAGE) -> list[dict]:
    """Pages of an M-tree over lifted vectors: leaves first, the root last.

    Entries are put next to their like by repeated halving along the two vectors farthest apart,
    then cut into pages; the level above treats the pages' routing vectors likewise. An entry is a
    row number (leaf) or a page number.
    """
    pages: list[dict] = []

    def halves(points: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        todo, done = [at], []
        while todo:
            part = todo.pop()
            if len(part) <= page:
                done.append(part)
                continue
            p = points[part]
            a = p[int(((p - p[0]) ** 2).sum(axis=1).argmax())]
            b = p[int(((p - a) ** 2).sum(axis=1).argmax())]
            side = np.argsort(((p - a) ** 2).sum(axis=1) - ((p - b) ** 2).sum(axis=1), kind="stable")
            cut = len(part) // 2
            todo += [part[side[:cut]], part[side[cut:]]]
        return done

    points, reach, level = x, np.zeros(len(x)), 0
    entries = np.arange(len(x))
    while True:
        groups = halves(points, np.arange(len(points)))
        first = len(pages)
        new_points, new_reach = [], []
        for g in groups:
            p = points[g]
            middle = p.mean(axis=0)
            centre = p[int(((p - middle) ** 2).sum(axis=1).argmin())]  # routing vectors are members
            d = np.sqrt(((p - centre) ** 2).sum(axis=1))
            pages.append({"level": level, "centre": centre, "radius": float((d + reach[g]).max()),
                          "entries": entries[g], "to_parent": d, "reach": reach[g]})
            new_points.append(centre)
            new_reach.append(pages[-1]["radius"])
        if len(groups) == 1:
            return pages
        points, reach, level = np.array(new_points), np.array(new_reach), level + 1
        entries = np.arange(first, len(pages))


@dataclass
class Subtree:
    """The pages of one subtree, its vectors in leaf order."""

    ids: np.ndarray
    vecs: np.ndarray
    pages: list[dict]
    top: float

    def __post_init__(self):
        """Leaf pages get their rows side by side."""
        self.most = float(np.abs(self.vecs).max()) * self.vecs.shape[1] if self.vecs.size else 0.0
        self._hold(float)

    def _hold(self, kind) -> None:
        for p in self.pages:
            if p["level"] == 0:
                p["rows"], p["ids"] = self.vecs[p["entries"]].astype(kind), self.ids[p["entries"]]

    def search(self, q: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """The k best (score, id) of each query among those at least as good as ``bound``."""
        if q.size and self.most * float(np.abs(q).max()) >= 2 ** 53:
            self._hold(np.int64)  # floats would not carry these products exactly
        zq = np.hstack([q.astype(float), np.zeros((len(q), 1))])
        norms = (zq ** 2).sum(axis=1) + self.top
        # the routing vectors' distances are computed once for all queries of the block
        centres = np.array([p["centre"] for p in self.pages])
        to_page = distances(zq, centres)
        root = len(self.pages) - 1
        out = []
        for i in range(len(q)):
            least = bound[i]  # the k-th best score so far
            limit = np.sqrt(max(norms[i] - 2 * least, 0.0)) + MARGIN if np.isfinite(least) else np.inf
            best: list[tuple[int, int]] = []  # heap of (score, -id)
            queue = [(max(0.0, to_page[i, root] - self.pages[root]["radius"]), root)]
            while queue:
                low, n = heapq.heappop(queue)
                if low > limit + MARGIN:
                    break
                p = self.pages[n]
                # |d(q, centre) - d(centre, entry)| - reach is the least distance to what is below it
                reachable = np.abs(to_page[i, n] - p["to_parent"]) - p["reach"] <= limit + MARGIN
                if p["level"]:
                    hit = p["entries"][reachable]
                    lows = np.maximum(to_page[i, hit] - np.array([self.pages[e]["radius"] for e in hit]), 0.0)
                    for e, v in zip(hit.tolist(), lows.tolist()):
                        if v <= limit + MARGIN:
                            heapq.heappush(queue, (v, e))
                    continue
                few = reachable.mean() < 0.5  # else reading the page through is cheaper
                rows, ids = (p["rows"][reachable], p["ids"][reachable]) if few else (p["rows"], p["ids"])
                scores = (rows @ q[i].astype(rows.dtype)).astype(np.int64)
                good = (ids != own[i]) & (scores >= least)
                for s, v in zip(scores[good].tolist(), ids[good].tolist()):
                    if len(best) < k:
                        heapq.heappush(best, (s, -v))
                    elif (s, -v) > best[0]:
                        heapq.heapreplace(best, (s, -v))
                if len(best) == k and best[0][0] > least:
                    least = best[0][0]
                    limit = np.sqrt(max(norms[i] - 2 * least, 0.0)) + MARGIN
            out.append([(s, -v) for s, v in best])
        return out


# ------------------------------------------------------------------ Spark

_PAGES = ("subtree string, page int, level int, radius double, centre array<double>, entries array<int>, "
          "to_parent array<double>, reach array<double>, ids array<{id}>, vecs array<array<long>>")


def _pivots(v: DataFrame, top: float, dim: int) -> np.ndarray:
    """Up to about sqrt(n) pivots, far apart, from a bounded sample drawn by a hash of the id."""
    n = v.count()
    share = min(1.0, SAMPLE / max(1, n))
    rows = v.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000))).select("v").toPandas()
    x = lifted(matrix(rows["v"]), top) if len(rows) else np.zeros((0, dim + 1))
    x = x[np.lexsort(x.T)] if len(x) else x
    want = max(1, min(len(x), 2 * -(-n // SUBTREE), 4096))
    if not len(x):
        return np.zeros((1, dim + 1))
    chosen = [0]
    d = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < want and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def build_index(v: DataFrame, top: float, dim: int) -> tuple[DataFrame, np.ndarray]:
    """Pages of all subtrees, written once, and the pivots."""
    pivots = _pivots(v, top, dim)

    @F.pandas_udf("int")
    def nearest(col):
        return pd.Series(distances(lifted(matrix(col), top), pivots).argmin(axis=1))

    cells = staged(v.withColumn("cell", nearest("v")), "cells")
    sizes = cells.groupBy("cell").count()
    parts = F.ceil(F.col("count") / (SUBTREE * 3 // 4)).cast("int")
    cells = cells.join(F.broadcast(sizes.select("cell", parts.alias("parts"))), "cell")  # a row a pivot
    cells = cells.withColumn("subtree", F.concat_ws(
        "-", "cell", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("string")))

    def pages(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        x = matrix(rows["v"])
        ids = rows["vec_id"].to_numpy()
        name = rows["subtree"].iloc[0]
        return pd.DataFrame([{
            "subtree": name, "page": i, "level": p["level"], "radius": p["radius"], "centre": p["centre"].tolist(),
            "entries": p["entries"].tolist(), "to_parent": p["to_parent"].tolist(), "reach": p["reach"].tolist(),
            "ids": ids[p["entries"]].tolist() if p["level"] == 0 else [],
            "vecs": x[p["entries"]].tolist() if p["level"] == 0 else [],
        } for i, p in enumerate(build(lifted(x, top)))])

    schema = _PAGES.format(id=v.schema["vec_id"].dataType.simpleString())
    return staged(cells.groupBy("subtree").applyInPandas(pages, schema), "mtree"), pivots


def _load(rows: pd.DataFrame, top: float) -> Subtree:
    rows = rows.sort_values("page")
    n = int(sum(len(e) for e, lv in zip(rows["entries"], rows["level"]) if lv == 0))
    leaf = rows[rows["level"] == 0]
    at = np.concatenate([np.asarray(e, int) for e in leaf["entries"]])
    ids = np.empty(n, dtype=np.asarray(leaf["ids"].iloc[0]).dtype)
    ids[at] = np.concatenate([np.asarray(e) for e in leaf["ids"]])
    vecs = np.empty((n, len(leaf["vecs"].iloc[0][0])), dtype=np.int64)
    vecs[at] = np.concatenate([matrix(e) for e in leaf["vecs"]])
    pages = [{"level": lv, "centre": np.asarray(c, float), "radius": r, "entries": np.asarray(e, int),
              "to_parent": np.asarray(d, float), "reach": np.asarray(h, float)}
             for lv, c, r, e, d, h in zip(rows["level"], rows["centre"], rows["radius"], rows["entries"], rows["to_parent"], rows["reach"])]
    return Subtree(ids, vecs, pages, top)


def _search(pages: DataFrame, asked: DataFrame, top: float, k: int) -> DataFrame:
    """Search (subtree, block) groups of queries: ``asked`` has subtree, block, query_id, q, least."""
    id_type = pages.schema["ids"].dataType.elementType.simpleString()

    def go(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        tree = _load(rows, top)
        own = queries["query_id"].to_numpy()
        least = queries["least"].to_numpy(dtype=float, na_value=-np.inf)
        found = tree.search(matrix(queries["q"]), own, np.where(np.isnan(least), -np.inf, least), k)
        flat = [(o, v, s) for o, f in zip(own.tolist(), found) for s, v in f]
        return pd.DataFrame(flat, columns=["query_id", "vec_id", "score"])

    # a subtree's pages go to each block of queries that asks for it
    blocks = asked.select(F.col("subtree").alias("__s"), F.col("block").alias("__b")).distinct()
    copies = pages.join(blocks, F.col("subtree") == F.col("__s")).withColumnRenamed("__b", "block").drop("__s")
    return asked.groupBy("subtree", "block").cogroup(copies.groupBy("subtree", "block")).applyInPandas(
        go, f"query_id {id_type}, vec_id {id_type}, score long")


def top_k(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` for each row of ``queries``."""
    spark = df.sparkSession
    ship_package(spark)
    v, q = staged(vectors(df, id_col, vec_col, scale), "vectors"), vectors(queries, id_col, vec_col, scale)
    out = None
    dims = [r[0] for r in v.select(F.size("v")).distinct().collect()]  # as many rows as there are lengths
    for dim in sorted(dims):
        part = _top_k(v.filter(F.size("v") == dim), q.filter(F.size("v") == dim), dim, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        t = v.schema["vec_id"].dataType
        out = v.select(F.lit(None).cast(t).alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    return out


def _top_k(v: DataFrame, q: DataFrame, dim: int, k: int) -> DataFrame:
    top = float(v.select(F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, c: a + c * c))).first()[0] or 0)
    pages, _ = build_index(v, top, dim)
    roots = pages.groupBy("subtree").agg(F.max_by("centre", "page").alias("centre"), F.max_by("radius", "page").alias("radius"))
    n_roots = roots.count()
    q = q.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    blocks = max(1, -(-q.count() // (QUERIES // 2)))
    per_block = staged(q.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")), "queries")

    id_type = q.schema["query_id"].dataType.simpleString()
    chunks = max(1, -(-n_roots // 1024))
    tops = roots.withColumn("chunk", F.pmod(F.xxhash64("subtree"), F.lit(chunks)).cast("int"))

    def reach(_, queries: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        """Subtrees that a query has to search: the nearest of the chunk while no bound is known,
        then all whose least possible distance is within the bound."""
        none = pd.DataFrame({"query_id": [], "subtree": [], "low": []})
        if not len(queries) or not len(trees):
            return none
        trees = trees.sort_values("subtree")
        names = trees["subtree"].to_numpy()
        z = matrix(queries["q"]).astype(float)
        d = distances(np.hstack([z, np.zeros((len(z), 1))]), np.stack(trees["centre"].to_numpy()))
        low = np.maximum(d - trees["radius"].to_numpy()[None, :], 0.0)
        if "done" not in queries:
            at = d.argmin(axis=1)
            return pd.DataFrame({"query_id": queries["query_id"].to_numpy(), "subtree": names[at], "low": d[np.arange(len(z)), at]})
        least = queries["least"].to_numpy(dtype=float, na_value=np.nan)
        limit = np.sqrt(np.maximum((z ** 2).sum(axis=1) + top - 2 * least, 0.0)) + 2 * MARGIN
        open_ = ~(low > limit[:, None]) & (names[None, :] != queries["done"].to_numpy()[:, None])
        row, tree = np.nonzero(open_)  # no bound known (fewer than k found): all
        return pd.DataFrame({"query_id": queries["query_id"].to_numpy()[row], "subtree": names[tree], "low": low[row, tree]})

    def asked(queries: DataFrame) -> DataFrame:
        # (block, chunk of subtrees): neither all queries nor all roots meet in one task
        left = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        right = tops.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(
            reach, f"query_id {id_type}, subtree string, low double")

    nearest = Window.partitionBy("query_id").orderBy("low", "subtree")
    first = asked(per_block).withColumn("r", F.row_number().over(nearest)).filter("r = 1").select("query_id", "subtree")
    first = staged(first, "first-subtrees")
    one = first.join(per_block, "query_id").withColumn("least", F.lit(None).cast("double"))
    found = staged(_search(pages, one, top, k), "nearest")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") == k).select("query_id", F.col("score").cast("double").alias("least"))
    bounded = per_block.join(first.withColumnRenamed("subtree", "done"), "query_id").join(kth, "query_id", "left")
    bounded = staged(bounded, "bounded-queries")
    rest = asked(bounded).select("query_id", "subtree").join(bounded.drop("done"), "query_id")
    more = _search(pages, staged(rest, "asked"), top, k)
    every = found.unionByName(more).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return every.select("query_id", "rank", "vec_id", "score")


def op5(spark, sf_dir: str) -> DataFrame:
    """Query ``op5_mtree_topk``: rows whose id is divisible by 20, against all others."""
    e = read(spark, sf_dir, "embeddings")
    return top_k(e, e.filter(F.col("vec_id") % 20 == 0))
