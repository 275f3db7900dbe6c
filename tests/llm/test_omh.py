import hashlib

import xxhash
from conftest import rows as tuples
from pyspark.sql import functions as F
from starflow.llm import omh as O

SF = "/root/testdata/sf0.001"
M = (1 << 64) - 1


def h(*values):
    """Column hash: seeds chain from 42; longs and ints as little-endian bytes, texts as UTF-8."""
    seed = 42
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else v
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def long(x):
    return x.to_bytes(8, "little")


def signature(text, k=5, l=2):  # noqa: E741
    import re
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    wh = [h(w) for w in words]
    n = len(wh) - k + 1 if len(wh) >= k else min(len(wh), 1)
    km = [h(*[long(x) for x in wh[i:i + k]]) for i in range(n)]
    seen, bins = {}, {}
    low = len(format(n, "b"))
    for i, x in enumerate(km):
        number = seen[x] = seen.get(x, -1) + 1
        key = h(long(x), number.to_bytes(4, "little"))
        bins.setdefault(key >> 59, []).append((((key >> low) << low) - (1 << 64 if key >> 63 else 0), i))
    out = []
    for b in sorted(bins):
        at = sorted(i for _, i in sorted(bins[b])[:l])
        out.append(b << 32 | h(*[long(km[i]) for i in at]) & 0xFFFFFFFF)
    return sorted(out)


def test_signature_equals_loops(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", None, "a", "a b c d", "a b c d e", "a a a a a a a a a a b a a a a a a", "x y " * 3000, " lead  two\tthree\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for i, s in tuples(O.with_signature(df, "t", "s").select("i", "s")):
        assert list(s) == signature(texts[i]), texts[i] and texts[i][:60]


def test_query_against_loops(spark):
    docs = sorted(tuples(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")), reverse=True)
    want = {}
    for (d, t), (_, nxt) in zip(docs, docs[1:] + docs[:1]):
        third = len(t) // 3
        edited = t[:len(t) - third] + nxt[:third]
        a, b, c = signature(t), signature(edited), signature(nxt)

        def near(x, y):
            either = {v >> 32 for v in x} | {v >> 32 for v in y}
            return len(set(x) & set(y)) / len(either) if either else 1.0

        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(f"{v:010x}" for v in a),
                   "".join(f"{v:010x}" for v in b), near(a, b), near(a, c))
    q = O.op3(spark, SF)
    got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
           for r in q.collect()}
    assert got == want
    assert not any(x in q._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))
    near = [v[4] for v in want.values() if v[0] > 400]
    assert 0.1 < sum(near) / len(near) < 0.9


def test_order_matters(spark):
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join([f"w{i}" for i in range(200, 400)] + [f"w{i}" for i in range(200)])
    df = spark.createDataFrame([(a, b)], "a string, b string")
    df = O.with_signature(O.with_signature(df, "a", "s"), "b", "t")
    v = df.select(O.likeness(F.col("s"), F.col("t")), O.likeness(F.col("s"), F.col("s"))).first()
    assert v[0] < 0.75 and v[1] == 1.0


def test_odd_rows(odd, none, spark):
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    got = O.with_next(docs, "doc_id", "tie", ["text"])
    order = sorted(tuples(docs), key=lambda r: (r[0] is None, -(r[0] or 0), -r[2]))
    want = [(a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])]
    assert sorted(tuples(got.select("doc_id", "text", "__next_text")), key=str) == sorted(want, key=str)
    assert O.with_next(docs.limit(0), "doc_id", "tie", ["text"]).count() == 0
    assert tuples(O.with_next(docs.filter("doc_id = 3"), "doc_id", "tie", ["text"]).select("__next_text")) == [("",)]
    f = {(r.doc_id, r.fingerprint) for r in O.fingerprints(odd).collect()}
    assert (2, "") in f and (3, "") in f and len([x for x in f if x[0] == 1]) == 2


def test_next_by_text_ids(spark):
    """Ids that are texts, some with the same leading bytes, some null, in many slices."""
    ids = [f"{'doc-number-' if i % 3 else ''}{i * 7919 % 1000:04d}" for i in range(300)] + [None, None, ""]
    df = spark.createDataFrame([(d, i, f"t{i}") for i, d in enumerate(ids)], "id string, tie int, t string")
    got = {r.tie: r["__next_t"] for r in O.with_next(df, "id", "tie", ["t"]).collect()}
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, (ids[i] or "").encode(), i), reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
