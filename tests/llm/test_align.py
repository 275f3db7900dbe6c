import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from conftest import rows as tuples
from starflow.llm import align as A
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
A_TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
A_TOK.encode_special_tokens = True
B_TOK = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in BYTES} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in BYTES)}
ODD_TEXTS = ["", " ", "  a", "a  b ", "x ", " x", "<|endoftext|> a<|endoftext|>", "</s><s><unk>", "<0x41>", "a▁b", "\x00\x01",
             "tab\there\r\nnext", "\U0001f600‍\U0001f468 　 x", "éé ﬁ", "\n\n a\n b", "ab" * 300, "xy" * 3000 + " z", "1234567890 " * 30]


def plain(text):
    """(A ids, A ends, B ids, B ends) by one call each, or None."""
    if not text:
        return None
    a = A_TOK.encode(" " + text, add_special_tokens=False)
    raw_a = [bytes(BYTE_OF[c] for c in t) for t in a.tokens]
    b = B_TOK.encode(text)
    raw_b = []
    for i in b:
        piece = B_TOK.id_to_piece(i)
        raw_b.append(bytes([int(piece[3:5], 16)]) if B_TOK.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(raw_a) != want or b"".join(raw_b) != want:
        return None
    return a.ids, np.cumsum(list(map(len, raw_a))).tolist(), list(b), np.cumsum(list(map(len, raw_b))).tolist()


def linked(a, ae, b, be):
    """All overlapping pairs and the groups, one token after the other."""
    links, groups, j0 = [], [], 0
    ga, gb = [], []
    sa = sb = i = j = 0
    while i < len(a) and j < len(b):
        assert max(sa, sb) < min(ae[i], be[j])
        links.append((a[i], b[j]))
        x, y = ae[i], be[j]
        if x <= y:
            ga.append(a[i])
            sa, i = x, i + 1
        if y <= x:
            gb.append(b[j])
            sb, j = y, j + 1
        if x == y:
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            ga, gb = [], []
    assert i == len(a) and j == len(b) and not ga and not gb
    return links, groups


def expected(rows):
    each = []
    for d, text in rows:
        p = plain(text)
        each.append((d, p, *(linked(*p) if p else ([], []))))
    count = Counter(x for *_, links, _ in each for x in set(links))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    return sorted(((d, len(p[0]) if p else 0, len(p[2]) if p else 0, len(groups), len(links),
                    sum(count[x] == top[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if p else "") for d, p, links, groups in each), key=str)


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = A.op11(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuples(got), key=str) == expected(tuples(docs))


@pytest.mark.parametrize("steps,block", [(7, 50), (64, 4000)])
def test_short_pieces_and_small_blocks(spark, steps, block):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(40)
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD_TEXTS)], docs.schema)
    docs = docs.unionByName(more)
    assert sorted(tuples(A.align(docs, steps=steps, block_pairs=block)), key=str) == expected(tuples(docs))


def test_encoders_equal_plain_calls():
    tok = A.Tokenizers()
    rng = np.random.default_rng(4)
    marks = ["a", "B", "the", " ", "  ", "\n", "\t", "é", "ß", "　", "'s", "12", "<s>", "|", " ", "\x1c", "\U0001f600", "."]
    texts = ODD_TEXTS + ["".join(rng.choice(marks, int(rng.integers(1, 12)))) for _ in range(4000)]
    for t in texts:
        p, got = plain(t), tok.encode(t)
        assert (p is None) == (got is None), repr(t)
        if p:
            assert p[0] == got[0].tolist() and p[2] == got[1].tolist(), repr(t)


def test_merge_path_cuts():
    rng = np.random.default_rng(1)
    for _ in range(300):
        end = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, int(rng.integers(0, 40))), end)) for _ in range(2))
        steps = int(rng.integers(1, 12))
        places = A.cuts(a, b, steps)
        assert places[0] == (0, 0) and places[-1] == (len(a), len(b))
        for (i, j), (i1, j1) in zip(places, places[1:]):
            assert i1 >= i and j1 >= j and 0 < i1 + j1 - i - j <= steps + 1
            if (i1, j1) != places[-1]:  # what lies before is smaller than what lies after
                assert max([*a[:i1], *b[:j1]], default=0) < min([*a[i1:], *b[j1:]])


def test_odd_rows(odd, none):
    assert sorted(tuples(A.align(odd)), key=str) == expected([(r.doc_id, r.text) for r in odd.collect()])
    assert A.align(none).count() == 0
