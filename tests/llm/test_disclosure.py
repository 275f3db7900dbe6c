import hashlib
import math
import random
import re

from conftest import rows as tuples
from starflow.llm import disclosure as D

SF = "/root/testdata/sf0.01"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1])]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text):
    out = [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0]), s[2]))


def expected(rows, share=0.8, contexts=3, window=6):
    """All spans, from counts over all documents made one by one."""
    words = [{w.lower() for w in re.findall(r"\w{4,}", t or "")} for _, t in rows]
    words = [ws | {w[:2] + "*" for w in ws} for ws in words]
    df = lambda t: sum(t in ws for ws in words)
    near, held = [], {}
    for i, (_, t) in enumerate(rows):
        for e, w, a, b, c in D.terms_near(t or "", plain_base(t), window):
            held.setdefault(e, set()).add(i)
            near.append((i, e, w.lower(), a, b, c))
    seen = {}
    for i, e, w, _, _, c in near:
        for t in (w, w[:2] + "*"):
            seen.setdefault((e, t), []).append((i, c))
    n, kinds = len(rows), {}
    shares = {}
    for (e, t), xs in seen.items():
        if len({c for _, c in xs}) >= contexts and len(held[e]) < n:
            p = len({i for i, _ in xs})
            shares[e, t] = math.log2(n * p / (len(held[e]) * df(t))) / math.log2(n / len(held[e]))
    for (e, t), s in shares.items():
        if not t.endswith("*") and s >= share:
            kinds[e, t] = "general" if shares[e, t[:2] + "*"] < share else "remove"
    out = []
    for i, (d, t) in enumerate(rows):
        added = {}
        for j, e, w, a, b, _ in near:
            if j == i and (e, w) in kinds:
                added[a, b] = max(added.get((a, b), ""), kinds[e, w])
        base = plain_base(t)
        every = sorted(base + [(k, a, b) for (a, b), k in added.items()], key=lambda s: (s[1], D.KINDS.index(s[0]), s[2]))
        out.append((d, *(sum(k == x for x, _, _ in base) for k in PLAIN),
                    hashlib.sha256(D.joined(base).encode()).hexdigest(), D.joined(every)))
    return sorted(out, key=str)


def got(docs):
    found = D.find(docs)
    return sorted(tuples(found.select("doc_id", D._text_of(found["spans"]))), key=str)


def corpus():
    """An account name and a club stand beside one phone number in several passages; the club is
    also spoken of elsewhere, and one passage is copied many times."""
    rng = random.Random(7)
    say = lambda k: " ".join(rng.choice(["alpha", "bravo", "carol", "delta", "eagle", "fancy", "green", "house"]) for _ in range(k))
    rows = [(i, say(30)) for i in range(120)]
    rows += [(200 + i, f"{say(9)} call wolfgang on +1 (555) 010-{7000:04d} {say(9)}") for i in range(6)]
    rows += [(300 + i, f"{say(5)} woodland path {say(5)}") for i in range(20)]
    rows += [(400 + i, "mail zebrafish at one.two@mail.example.org now") for i in range(9)]  # copies: one context
    rows += [(500 + i, f"{say(8)} quokka1 10.0.0.{i % 2 + 1} {say(8)}") for i in range(8)]
    return rows


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(3)
    docs = tuples(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    odd = ["a@b.c@d.e", "@x.y", "a@b", "a@-.-", "1.2.3.4.5.6.7.8", "01.002.3.255", "1.2.3.256", "9" * 4000 + ".1.1.1", "+1 ((((",
           "+12 345 678 901 x", "4111-1111 1111 1111", "4111 1111  1111 1111", "4111111111111111 0", "+" * 50 + "1 23456789 0", None, ""]
    marks = ["@", ".", "-", " ", "+", "(", "1", "22", "255", "a", "b_", "%", "4111111111111111"]
    odd += ["".join(rng.choice(marks) for _ in range(rng.randint(1, 25))) for _ in range(20000)]
    for t in [t for _, t in docs] + odd:
        assert D.base_spans(t or "") == plain_base(t), repr(t)[:200]


def test_long_runs_are_read_in_linear_time():
    for t in ("a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "+1" + "(" * 2_000_000, "a@" * 500_000, "1 " * 1_000_000):
        D.base_spans(t)


def test_disclosing_terms_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert got(docs) == sorted(((r[0], r[-1]) for r in want), key=str)
    spans = {d: s for d, *_, s in want}
    assert any("general" in s or "remove" in s for d, s in spans.items() if 200 <= d < 206)  # wolfgang
    assert not any("general" in s or "remove" in s for d, s in spans.items() if 400 <= d < 409)  # copies prove nothing
    assert all(s == "" for d, s in spans.items() if d < 200 or 300 <= d < 400)  # clean documents


def test_sanitise(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, uid string")
    out = {r.doc_id: r.text for r in D.sanitise(docs).collect()}
    assert D.sanitise(docs).columns == docs.columns
    assert len(out) == len(rows)
    for d, t in rows:
        if 200 <= d < 206:
            assert "wolfgang" not in out[d] and "<phone>" in out[d] and "555" not in out[d]
        elif 400 <= d < 409:
            assert out[d] == "mail zebrafish at <email> now"
        elif d < 200:
            assert out[d] == t


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    q = D.op12(spark, "/root/testdata/sf0.001")
    assert q.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted(tuples(q), key=str) == expected(tuples(docs))


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == sorted(((r[0], r[-1]) for r in expected(rows)), key=str)
    assert D.find(none).count() == 0
    assert sorted(D.sanitise(odd).columns) == sorted(odd.columns)
