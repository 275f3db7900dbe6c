import hashlib
import re

from conftest import rows as tuples
from starflow.llm import mix

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, weights=(1, 2, 3), most=3, seed=42):
    """(doc_id, size, source_size, target, taken) by plain loops."""
    sized = [(d, s, len(WORD.findall(t or "")),
              hashlib.md5(f"{'' if d is None else d}:{t or ''}".encode()).hexdigest()[:15]) for d, t, s in docs]
    names = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(x[2] for x in sized if x[1] == s) for s in names}
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, free = set(), set(names)
    while True:  # share what is left by weight until no target is above its limit
        left = sum(total.values()) - sum(most * total[s] for s in stopped)
        rate = left / max(1, sum(w[s] for s in free))
        over = {s for s in free if w[s] * rate > most * total[s]}
        if not over:
            break
        stopped |= over
        free -= over
    out = []
    for s in names:
        target = float(most * total[s]) if s in stopped else w[s] * left / sum(w[x] for x in free)
        r = min(int(target / total[s] * 2 ** 28), most << 28) if total[s] else 0
        u = int(hashlib.md5(f"{seed}:{int(s is None)}:{s or ''}".encode()).hexdigest()[:7], 16)

        def order(x):
            rest = max(x[2].bit_length() - 5, 0) if x[2] else 0
            return rest * 32 + (x[2] >> rest), x[3], x[2]

        at = u
        for d, _, n, _ in sorted((x for x in sized if x[1] == s), key=order):
            out.append((d, n, total[s], target, (((at + r) >> 28) - (at >> 28)) * n))
            at += r
    return out


def digest(df):
    m = mix.mix(df)
    return m.select("doc_id", "mixed.size", "mixed.source_size", "mixed.target", "mixed.taken")


def key(r):
    return tuple((x is None, 0 if x is None else round(x, 6)) for x in r)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute(tuples(docs.select("doc_id", "text", "source")))
    got = tuples(mix.op1(spark, SF))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_targets_and_limits(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "big") for i in range(900)]
                                 + [(1000 + i, "w " * 10, f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    per = mix.mix(docs).select("source", "mixed.*").groupBy("source", "source_size", "target")
    got = tuples(per.agg({"taken": "sum"}).drop("source"))
    assert abs(sum(t for _, t, _ in got) - 9300) < 1e-6
    assert all(t <= 3 * s + 1e-9 and abs(k - t) <= 30 for s, t, k in got)
    assert all(r[4] <= 3 * r[1] for r in tuples(digest(docs)))


def test_same_for_other_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = sorted(tuples(digest(docs)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert sorted(tuples(digest(docs.repartition(5)))) == a
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_odd_rows(odd, none):
    want = brute([(r.doc_id, r.text, r.source) for r in odd.collect()])
    assert sorted(map(key, tuples(digest(odd)))) == sorted(map(key, want))
    assert digest(none).count() == 0
    drawn = mix.draw(odd)
    assert drawn.columns == odd.columns
    copies = mix.mix(odd).agg({"mixed.copies": "sum"}).first()[0]
    assert drawn.count() == copies
