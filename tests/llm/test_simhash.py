import itertools

import numpy as np
import xxhash
from conftest import rows as tuples
from pyspark.sql import functions as F
from starflow.llm import common as C
from starflow.llm import simhash as S
from starflow.llm.common import components

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Component label of each distinct fingerprint by comparing all pairs."""
    fps = sorted(set(fps))
    top = {f: f for f in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    a = np.array(fps, dtype=np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= 4):
            x, y = find(fps[i]), find(fps[i + 1 + int(j)])
            top[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def expected(rows):
    fp = [plain_fingerprint(t) for _, t in rows]
    group = groups(fp)
    least = {}
    for (d, _), f in zip(rows, fp):
        g = group[f]
        least[g] = d if least.get(g) is None else least[g] if d is None else min(d, least[g])
    return sorted(((d, format(f, "016x"), least[group[f]]) for (d, _), f in zip(rows, fp)), key=str)


def got(df):
    n = S.near_duplicates(df)
    return sorted(tuples(n.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"), "component_id")), key=str)


def test_every_near_pair_shares_a_key():
    rng = np.random.default_rng(3)
    f = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    g = f.copy()
    for i in range(len(g)):
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            g[i] ^= np.uint64(1 << int(b))
    a, b = (set(zip(*map(np.ndarray.tolist, S.keys(x)))) for x in (f, g))
    assert {r for r, _ in a & b} == set(range(len(f)))
    assert len(S.keys(f)[0]) <= 64 * len(f)


def test_code_is_perfect():
    words = np.arange(1 << 12, dtype=np.int64) << 11
    code = words ^ S._syndromes(words)  # the 4096 codewords
    assert min(int(np.bitwise_count(code[1:]).min()), 7) == 7
    rng = np.random.default_rng(0)
    for flips in range(4):
        c = code[rng.integers(0, 4096, 200)]
        v = c.copy()
        for i in range(200):
            for b in rng.choice(23, flips, replace=False):
                v[i] ^= 1 << int(b)
        assert (S.codeword(v) == c >> 11).all()


def test_equals_all_pairs_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert sorted(tuples(S.op2(spark, SF)), key=str) == expected(tuples(docs))


def test_dense_groups_and_chains(spark):
    """Balls of near fingerprints, chains, and strays, against all pairs."""
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 1 << 62, 300).tolist())
    for centre in rng.integers(0, 1 << 62, 4).tolist():
        for _ in range(150):
            x = centre
            for b in rng.choice(12, int(rng.integers(0, 6)), replace=False):
                x ^= 1 << (5 * int(b))
            fps.add(x)
    x = 12345
    for i in range(40):
        fps.add(x)
        for b in rng.choice(62, 4, replace=False):
            x ^= 1 << int(b)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    comp = dict(tuples(S.links_of(df)))
    want = groups(fps)
    named = {f: comp.get(f, f) for f in fps}
    by = lambda m: sorted(sorted(g) for g in _classes(m))
    assert by(named) == by(want)


def _classes(label):
    out = {}
    for k, v in label.items():
        out.setdefault(v, []).append(k)
    return out.values()


def test_components(spark):
    pairs = [(1, 2), (2, 3), (10, 9), (9, 8), (8, 7), (7, 6), (5, 5), (20, 1), (100, 101)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)]
    got = dict(tuples(components(spark.createDataFrame(pairs, "a long, b long"), "a", "b")))
    assert {got[k] for k in (1, 2, 3, 20)} == {1} and {got[k] for k in range(6, 11)} == {6}
    assert {got[1000 + i] for i in range(61)} == {1000} and got[101] == 100 and 5 not in got


def test_odd_rows(odd, none):
    assert got(odd) == expected([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert got(none) == []


def test_deduplicate(odd, none, spark):
    kept = S.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    fp = [plain_fingerprint(t) for _, t in rows]
    group = groups(fp)
    want = {}  # the least id of each component, null last
    for (d, _), f in zip(rows, fp):
        key = (d is None, d or 0)
        want[group[f]] = min(want.get(group[f], key), key)
    assert sorted((d is None, d or 0) for d in (r.doc_id for r in kept.collect())) == sorted(want.values())
    assert S.deduplicate(none).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {c for _, _, c in expected(tuples(docs.select("doc_id", "text")))}
    assert {r.doc_id for r in S.deduplicate(docs).collect()} == want


def test_near_copies_without_ids_are_one_group(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1] + ["other"]), "quite another text of its own " * 9]
    fps = [plain_fingerprint(t) for t in texts]
    assert 0 < (fps[0] ^ fps[1]).bit_count() <= 4 < (fps[0] ^ fps[2]).bit_count()
    docs = spark.createDataFrame([(None, t, "a") for t in texts], "doc_id long, text string, source string")
    kept = sorted(r.text for r in S.deduplicate(docs).collect())
    assert len(kept) == 2 and texts[2] in kept


def test_ties_do_not_depend_on_partitions(spark):
    text = "the same text under one id many times"
    docs = spark.createDataFrame([(1, text, f"src{i}", i) for i in range(40)] + [(1, text, "src3", 3)],
                                 "doc_id long, text string, source string, n_chars long")
    got = {tuples(S.deduplicate(docs.repartition(n, "source")))[0] for n in (1, 3, 7, 20)}
    assert len(got) == 1 and S.deduplicate(docs).count() == 1


def test_a_bucket_of_far_members_is_not_compared_pair_by_pair(spark):
    """Fingerprints that share a 32-bit half key, or a segment and more, and lie far apart, with a few
    near pairs hidden among them: all pairs are found, by parts of the bucket."""
    rng = np.random.default_rng(11)
    halves = rng.integers(0, 1 << 32, 500, dtype=np.uint64)
    spread = np.zeros(500, dtype=np.uint64)
    for i in range(4):  # the upper byte of each segment stays, the lower one varies
        spread |= ((halves >> np.uint64(8 * i)) & np.uint64(0xFF)) << np.uint64(16 * i)
    far = [int(x) | 0x5A00_3300_1100_7700 for x in spread]
    near = [f ^ 0x0001_0004_0010_0080 for f in far[:6]] + [f ^ 0x0000_0000_0000_000F for f in far[6:9]]
    shared = [0x1234 << 48 | int(x) for x in rng.integers(0, 1 << 25, 400)]
    fps = {*far, *near, *shared, *(f ^ 0x0000_0000_0300_0003 for f in shared[:5])}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    comp = {k % (1 << 64): v % (1 << 64) for k, v in tuples(S.links_of(df, direct=8))}
    want = groups(fps)
    by = lambda m: sorted(sorted(g) for g in _classes(m))
    assert by({f: comp.get(f, f) for f in fps}) == by(want)
    key = np.full(500, (8 + 0b1111) << 40 | 7)
    rows, parts = S.part_keys(key, np.array(far, dtype=np.uint64))
    assert len(rows) == 70 * 500 and np.unique(parts, return_counts=True)[1].max() < 20


def test_every_near_pair_of_a_bucket_shares_a_part():
    rng = np.random.default_rng(2)
    f = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    g = f.copy()
    for i in range(len(g)):
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            g[i] ^= np.uint64(1 << int(b))
    mine, theirs = (list(zip(*map(np.ndarray.tolist, S.keys(x)))) for x in (f, g))
    both = sorted(set(mine) & set(theirs))
    assert {r for r, _ in both} == set(range(300))
    key, at = np.array([k for _, k in both]), np.array([r for r, _ in both])
    a, b = (set(zip(*map(np.ndarray.tolist, S.part_keys(key, x[at])))) for x in (f, g))
    assert {r for r, _ in a & b} == set(range(len(key)))


def test_hot_node_is_split(spark):
    """The node in the middle of a large component is read by several tasks: both sides of the join
    come from files."""
    with C.settings(spark, spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
                    spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB", spark__sql__autoBroadcastJoinThreshold="-1"):
        v = F.xxhash64("id")
        e = spark.range(200_000).select(F.when(F.col("id") < 100_000, F.lit(7)).otherwise(v).alias("u"), v.alias("v"))
        e = C.staged(e, "links")
        least = C.staged(e.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = e.join(least, "u")
        assert len(out.collect()) == 200_000
        assert "skew" in out._jdf.queryExecution().executedPlan().toString()


def test_odd_texts():
    for t in ["a", "a b c", "A b C d", "İx K k", "x y z w v", "a\x1cb c d e f", None, "  ", "é È " * 9]:
        assert S.fingerprint(t) == plain_fingerprint(t), t
    assert list(itertools.islice((S.fingerprint("p q r s " * n) for n in (1, 50)), 2))
