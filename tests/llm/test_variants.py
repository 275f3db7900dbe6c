import random
import re
import zlib
from collections import Counter

import pytest
from conftest import rows as tuples
from starflow.llm import variants as V

SF = "/root/testdata/sf0.001"


def plain_words(rows):
    out = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1:]
            if len(low) >= 5:
                out[low] += 1
    return {w: n for w, n in out.items() if n >= 3}


def edits(word, letters):
    """Everything one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    return out - {word}


def near_of(counts):
    """All near words of each word: words that become equal if one place of either is left out."""
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    near = {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            hole = w[:i] + w[i + 1:]
            near[w] |= holes[i, hole]  # replaced
            if hole in counts:
                near[w].add(hole)
                near[hole].add(w)
    return {w: xs - {w} for w, xs in near.items()}


def expected(counts):
    near = near_of(counts)
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]]))
    return sorted(out)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = sorted(tuples(V.op13(spark, sf)))
    assert got == expected(plain_words(tuples(docs)))
    assert any(r[1] for r in got) and any(r[1] and r[1] != r[2] for r in got)


def test_full_prefixes_and_blocks(spark):
    """Shards of a few words, so that every stage, split leaves and blocks of questions are used."""
    rng = random.Random(5)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 9))) for _ in range(300)}
    words |= {"".join(rng.choices("abcdeé", k=rng.randint(5, 7))) for _ in range(400)}
    counts = {w: rng.randint(3, 60) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = {w: (n, (-m, f)) for w, n, (m, f) in ((r[0], r[1], (-r[2][0], r[2][1])) for r in tuples(V.near_words(df, 5, 7)))}
    want = {}
    letters = sorted({c for w in counts for c in w})
    for w in counts:
        xs = [x for x in edits(w, letters) if x in counts]
        if xs:
            best = min(xs, key=lambda x: (-counts[x], x))
            want[w] = (len(xs), (-counts[best], best))
    assert near == want


def test_ways_to_spend_the_budget_differ():
    ways = [(0, 0, 0)]
    for s in range(len(V.STAGES)):
        ways = [((o + x) % 2**64, a + y, b + z) for o, a, b in ways for x, y, z in V._steps(s) if a + y <= 1 and b + z <= 1]
        assert len({o for o, _, _ in ways}) == len(ways)
    assert len(ways) == 1 + 2 * V.GROUPS + V.GROUPS * (V.GROUPS - 1)


def test_is_near():
    rng = random.Random(2)
    for _ in range(3000):
        a, b = ("".join(rng.choices("ab", k=rng.randint(1, 5))) for _ in range(2))
        assert V.is_near(a, b) == (b in edits(a, "ab")), (a, b)


def test_roots(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(30)] + [("x", "w05"), ("y", "z")]
    got = dict(tuples(V.roots(spark.createDataFrame(chain, "word string, form string"))))
    assert got["w00"] == got["x"] == "w30" and got["y"] == "z" and len(got) == len(chain)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(tuples(V.variants(odd))) == expected(plain_words(rows))
    assert V.variants(none).count() == 0
