"""M-tree search against brute force."""
import numpy as np
from conftest import rows as tuples
from starflow.llm import mtree as T


def brute(rows, queries, k=20, scale=64):
    ok = [(i, np.floor(np.array(v, dtype=float) * scale).astype(np.int64)) for i, v in rows
          if i is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, x in ok:
        if q not in queries:
            continue
        found = sorted((-int(x @ y), i) for i, y in ok if i != q and len(y) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = tuples(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding"))
    got = sorted(tuples(T.op5(spark, sf).select("query_id", "rank", "vec_id", "score")))
    assert got == brute(rows, {i for i, _ in rows if i % 20 == 0})


def test_ties_copies_and_pruning(spark, monkeypatch):
    monkeypatch.setattr(T, "SUBTREE", 64)
    monkeypatch.setattr(T, "QUERIES", 32)
    monkeypatch.setattr(T, "PAGE", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 4)) * 3
    x = np.vstack([centres[i % 6] + rng.normal(size=4) * 0.1 for i in range(500)] + [centres[0]] * 250)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuples(T.top_k(df, df.filter("vec_id % 20 = 0"), k=7)))
    assert got == brute(rows, set(range(0, 750, 20)), k=7)


def test_pages_hold_every_entry():
    x = np.random.default_rng(0).normal(size=(333, 5))
    pages = T.build(x, 16)
    leaves = np.concatenate([p["entries"] for p in pages if p["level"] == 0])
    assert sorted(leaves.tolist()) == list(range(333))
    for p in pages:
        if p["level"] == 0:
            d = np.sqrt(((x[p["entries"]] - p["centre"]) ** 2).sum(axis=1))
            assert np.allclose(d, p["to_parent"]) and d.max() <= p["radius"] + 1e-9
        else:
            for e, d in zip(p["entries"], p["to_parent"]):
                assert d + pages[e]["radius"] <= p["radius"] + 1e-9


def test_search_skips_pages():
    """Bounds rule most pages out where there is structure, with equal results."""
    rng = np.random.default_rng(1)
    x = np.rint(np.vstack([c + rng.normal(size=(64, 3)) for c in rng.normal(size=(40, 3)) * 300])).astype(np.int64)
    top = float((x ** 2).sum(axis=1).max())
    t = T.Subtree(np.arange(len(x)), x, T.build(T.lifted(x, top), 16), top)
    opened = []
    t.pages = [_Seen(p, opened) for p in t.pages]
    q = x[:5]
    found = t.search(q, np.arange(5), np.full(5, -np.inf), 10)
    for i, f in enumerate(found):
        want = sorted((-int(s), j) for j, s in enumerate(x @ q[i]) if j != i)[:10]
        assert sorted((-s, j) for s, j in f) == want
    assert len(opened) < 5 * len(t.pages) / 2


class _Seen(dict):
    def __init__(self, page, opened):
        super().__init__(page)
        self.opened = opened

    def __getitem__(self, k):
        if k == "to_parent":
            self.opened.append(1)
        return super().__getitem__(k)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [0.5, -1.0]), (1, [1.0, None]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (40, [1.0, 2.0, 3.0]), (41, [0.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, subtree string, score int")
    got = sorted(tuples(T.top_k(df, df.filter("vec_id % 20 = 0"))))
    assert got == brute(rows, {0, 20, 40})
    assert T.top_k(df.limit(0), df.limit(0)).count() == 0
    one = df.filter("vec_id = 20")
    assert T.top_k(one, one).count() == 0
