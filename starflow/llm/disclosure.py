"""Personal data: fixed patterns, and information-theoretic sanitisation of what gives them away.

Protected entities are the values that four fixed patterns find (``email``, ``ip``, ``card``,
``phone``); their spans are always reported. A term near an entity may reveal it although it is no
such value itself (an account name, a customer number, a place). How much is estimated from the
whole corpus: with documents as the unit, the information content of an entity is
``IC(e) = log2(N / df(e))`` and what a term tells of it is the pointwise mutual information
``PMI(e, t) = log2(N * df(e, t) / (df(e) * df(t)))``. A term discloses the share ``PMI / IC`` of the
entity. Terms whose share reaches ``SHARE`` are sanitised where they stand near the entity: a term
whose general form (its first letters, or first digits) stays below the threshold is *generalised*
to that form, any other is *removed*.

Evidence. A pair counts only if it was seen in ``CONTEXTS`` different contexts (the words around,
digits and the entity left out), so that copies of one passage, in however many documents, say
nothing. Terms are looked for within ``WINDOW`` words of the entity; ``df(t)`` counts all documents.

Spark. One pass over the texts gives the base spans and the terms near entities. (entity, term) pairs
are aggregated with partial counts, which also holds for an entity that stands in a third of all
documents; only pairs with enough contexts have their terms counted over the corpus. The disclosing
pairs meet the occurrences in a join on both, entity and term; nothing is collected.

Words are runs of letters, digits and low lines, in lower case.

Spans count code points, the end is exclusive. Their order is by start, then kind as in ``KINDS``;
a span of two kinds stands once for each. Added spans may lie only outside of base spans.

Edge cases: a null or empty text has no spans (the digest of an empty list); a null id is kept;
repeated rows are documents of their own; very long texts and runs are read in linear time; ties in
counts change nothing. Columns besides id and text are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, read, ship_package, staged

KINDS = ("email", "ip", "card", "phone", "general", "remove")
#: The base patterns, written so that a failed start costs a constant (a run of
#: digits, or of name characters before an @, is read once).
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_LAST = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

WINDOW = 6
SHARE = 0.8
CONTEXTS = 3
#: Shortest term, and how much of it its general form keeps.
TERM_CHARS, KEPT_CHARS = 4, 2
_TERM = re.compile(r"\w+")
_NOT_DIGIT = re.compile(r"[^0-9]")


# ------------------------------------------------------------------ base patterns

def luhn(digits: str) -> bool:
    """Does the check digit fit?"""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``local@domain``: read outwards from every @."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        else:
            end = at + 1  # a name cannot reach over this @
        at = text.find("@", max(end, at + 1))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns; matches that fail their test are dropped."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def entity(kind: str, value: str) -> str:
    """The protected value, whatever way it is written."""
    if kind == "email":
        return "email:" + value.lower()
    if kind == "ip":
        return "ip:" + ".".join(p.lstrip("0") or "0" for p in value.split("."))
    return f"{kind}:" + _NOT_DIGIT.sub("", value)


# ------------------------------------------------------------------ terms near entities

def general_form(term: str) -> str:
    """What is left of a term that is generalised: its first letters, the rest open."""
    return term[:KEPT_CHARS] + "*"


def terms_near(text: str, spans: list[tuple[str, int, int]], window: int = WINDOW):
    """(entity, term, start, end, context hash) of the words around every span, outside of all spans."""
    words = [m for m in _TERM.finditer(text)] if spans else []
    starts = [m.start() for m in words]
    cover = sorted((a, b) for _, a, b in spans)
    free = []  # words that lie in no span
    at, reach = 0, 0
    for m in words:
        while at < len(cover) and cover[at][0] < m.end():
            reach = max(reach, cover[at][1])
            at += 1
        free.append(m.start() >= reach)
    for kind, a, b in spans:
        left = [i for i in range(bisect_left(starts, a) - 1, -1, -1)[:4 * window] if free[i]][:window][::-1]
        first = bisect_left(starts, b)
        right = [i for i in range(first, min(len(words), first + 4 * window)) if free[i]][:window]
        around = [words[i] for i in (*left, *right)]
        said = " ".join(m[0].lower() for m in around if not m[0].isdigit())
        context = int.from_bytes(hashlib.blake2b(said.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
        value = entity(kind, text[a:b])
        for m in around:
            if len(m[0]) >= TERM_CHARS:
                yield value, m[0], m.start(), m.end(), context


def _near_entities(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Per row: doc_id, uid, base spans, and the terms near them as a list."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)
    near_arrow = pa.list_(pa.struct([("e", pa.string()), ("t", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("c", pa.int64())]))
    span_arrow = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())]))

    def go(batches):
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            spans, near = [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                found = base_spans(text)
                spans.append([{"kind": k, "a": a, "b": b} for k, a, b in found])
                near.append([dict(zip("etabc", x)) for x in terms_near(text, found, window)] if found else [])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_arrow), pa.array(range(uid, uid + n), pa.int64()),
                 pa.array(spans, span_arrow), pa.array(near, near_arrow)], ["doc_id", "uid", "spans", "near"])
            uid += n

    ddl = (f"doc_id {id_type.simpleString()}, uid long, spans array<struct<kind: string, a: int, b: int>>, "
           "near array<struct<e: string, t: string, a: int, b: int, c: long>>")
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(go, ddl)


def _words_of(text_col: str):
    """The distinct words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(r"(?U)\w{4,}"), F.lit(0)))


def _corpus_words(docs: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """(t, df): number of documents that hold each of the words ``terms``. All words are counted, with
    partial aggregation, and the counts, not the words, meet the table of terms."""
    each = docs.select(F.explode(_words_of(text_col)).alias("t"))
    return each.groupBy("t").agg(F.count(F.lit(1)).alias("df")).join(terms, "t")


def _corpus_forms(docs: DataFrame, text_col: str) -> DataFrame:
    """(t, df): number of documents that hold a word of each general form; there are few forms."""
    forms = F.array_distinct(F.transform(_words_of(text_col), _form))
    return docs.select(F.explode(forms).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))


def _form(word):
    return F.concat(F.substring(word, 1, KEPT_CHARS), F.lit("*"))


def disclosing(docs: DataFrame, near: DataFrame, text_col: str = "text", share: float = SHARE,
               contexts: int = CONTEXTS) -> DataFrame:
    """(e, t, kind) of the terms that disclose an entity, kind ``general`` or ``remove``.

    ``near`` is (uid, e, t, c): document, entity, term and context of every occurrence. A word is
    counted over the corpus only if it could reach ``share`` were it in no document but those where it
    stands near an entity: ``df`` can only be higher, and the share lower."""
    total = F.lit(docs.count())

    def told(pairs: DataFrame, df: str):
        """Share of the entity's information: null for one that every document holds."""
        pmi = F.log2(total * F.col("df_et") / (F.col("df_e") * F.col(df)))
        return pairs.withColumn("share", F.try_divide(pmi, F.log2(total / F.col("df_e"))))

    def distinct_count(rows: DataFrame, by: list[str], what: str, name: str):
        # distinct first, then counted: partial aggregation at both steps
        return rows.groupBy(*by, what).agg(F.lit(1).alias("x")).groupBy(*by).agg(F.count(F.lit(1)).alias(name))

    both = near.unionByName(near.withColumn("t", _form(F.col("t"))))
    seen = distinct_count(both, ["e", "t"], "c", "contexts").filter(F.col("contexts") >= contexts)
    df_e = distinct_count(near, ["e"], "uid", "df_e")
    pairs = staged(distinct_count(both, ["e", "t"], "uid", "df_et").join(seen, ["e", "t"]).join(df_e, "e"), "pairs")
    is_form = F.col("t").endswith("*")
    least = distinct_count(near, ["t"], "uid", "df_near")
    words = staged(told(pairs.filter(~is_form).join(least, "t"), "df_near").filter(F.col("share") >= share).drop("share"), "words")
    df_w = staged(_corpus_words(docs, text_col, staged(words.select("t").distinct(), "terms")), "word-counts")
    words = told(words.join(df_w, "t"), "df").filter(F.col("share") >= share).select("e", "t", _form(F.col("t")).alias("form"))
    forms = told(pairs.filter(is_form).join(_corpus_forms(docs, text_col), "t"), "df").select(
        "e", F.col("t").alias("form"), F.col("share").alias("form_share"))
    kind = F.when(F.col("form_share") < share, "general").otherwise("remove")
    return words.join(forms, ["e", "form"]).select("e", "t", kind.alias("kind"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE,
         contexts: int = CONTEXTS, window: int = WINDOW) -> DataFrame:
    """(doc_id, uid, base, spans): spans are arrays of struct(kind, a, b) in order, base ones and all."""
    rows = staged(_near_entities(docs, id_col, text_col, window), "near-entities")
    near = rows.select("uid", F.explode("near").alias("n")).select(
        "uid", "n.e", F.lower("n.t").alias("t"), "n.a", "n.b", "n.c")
    told = disclosing(docs, near.select("uid", "e", "t", "c"), text_col, share, contexts)
    hits = near.join(staged(told, "disclosing"), ["e", "t"])
    # a word near two entities is one span, removed if either asks for it; few rows a document
    per = hits.groupBy("uid", "a", "b").agg(F.max("kind").alias("kind"))
    added = per.groupBy("uid").agg(F.collect_list(F.struct("kind", "a", "b")).alias("added"))
    out = rows.drop("near").join(added, "uid", "left")
    every = F.concat("spans", F.coalesce("added", F.array().cast("array<struct<kind: string, a: int, b: int>>")))
    order = F.transform(every, lambda s: F.struct(s["a"].alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"),
                                                  s["b"].alias("b"), s["kind"].alias("kind")))
    spans = F.transform(F.array_sort(order), lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("a"), s["b"].alias("b")))
    return out.select("doc_id", "uid", F.col("spans").alias("base"), spans.alias("spans"))


def _text_of(spans):
    one = lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op12(spark, sf_dir: str) -> DataFrame:
    """Query ``op12_disclosure``."""
    found = find(read(spark, sf_dir, "documents"))
    n = [F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return found.select("doc_id", *n, F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
                        _text_of(F.col("spans")).alias("spans"))


# ------------------------------------------------------------------ sanitised texts

def replaced(text: str | None, spans) -> str | None:
    """The text with its spans replaced: values by their kind, terms by their general form or by
    nothing. Of overlapping spans the first one's replacement stands for all."""
    if not text or spans is None:
        return text
    out, end = [], 0
    for s in spans:
        kind, a, b = s["kind"], s["a"], s["b"]
        if a >= end:
            out += [text[end:a], general_form(text[a:b]) if kind == "general" else "" if kind == "remove" else f"<{kind}>"]
        end = max(end, b)
    return "".join(out) + text[end:]


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """All rows of ``docs`` with their columns, the texts sanitised. Rows of one id and text get the
    same spans, so they are matched by these."""
    d, names = numbered(docs)
    i, t = names[id_col], names[text_col]
    tag = F.xxhash64(F.col(i), F.col(t))
    found = find(d.select(F.struct(F.col(i).alias("id"), tag.alias("tag")).alias("key"), F.col(t).alias("text")), "key", "text", **how)
    one = Window.partitionBy("tag").orderBy("uid")
    spans = (found.filter(F.size("spans") > 0).select(F.col("doc_id.tag").alias("tag"), "uid", "spans")
             .withColumn("r", F.row_number().over(one)).filter("r = 1").select("tag", "spans"))

    @F.pandas_udf("string")
    def go(text, spans):
        import pandas as pd

        return pd.Series([replaced(x, s) for x, s in zip(text.where(text.notna(), None), spans)], dtype=object)

    out = d.withColumn("tag", tag).join(spans, "tag", "left")
    text = F.when(F.col("spans").isNull(), F.col(t)).otherwise(go(F.col(t), F.col("spans")))
    return out.select(*[(text if n == t else F.col(n)).alias(c) for c, n in names.items()])
