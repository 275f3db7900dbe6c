"""Order MinHash fingerprints, sensitive to edit distance. DataFrame functions only.

A text's k-mers are its runs of ``K`` words. Equal k-mers are told apart by their occurrence number
in the text. A hash of (k-mer, number) deals them into ``2^BIN_BITS`` bins and orders each bin; the
``L`` least of a bin are selected, put back in text order, and hashed together: one entry of the
signature. Two texts agree in an entry when the same k-mers are selected and stand in the same
order, so that moved and edited passages both show. Their likeness is the share of equal entries
among the bins that either text fills. (Marcais and others, 2019; bins in place of independent
hash functions make it one pass.)

All work on a text happens inside its row, on arrays: k-mer hashes are packed with their position
into longs and sorted as such. Nothing is exploded, so no shuffle grows with the number of k-mers.

Edge cases: a null text is an empty one; it has an empty signature, and two empty signatures are
alike (1). A text of fewer than ``K`` words is one k-mer. Repeated rows are rows of their own: one
may be the other's next document. Null ids come last. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.star import _slice_number, slice_cuts, slice_index
from .common import read

K = 5
L = 2
BIN_BITS = 5
SLICES_A_PARTITION = 4
BLANKS = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pack(h: Column, at: Column, bits: Column) -> Column:
    """A hash with its low ``bits`` replaced by a position."""
    return F.expr("0L") + F.call_function("shiftleft", F.call_function("shiftright", h, bits), bits) + at


def _position(packed: Column, bits: Column) -> Column:
    mask = F.call_function("shiftleft", F.expr("1L"), bits) - F.expr("1L")
    return packed.bitwiseAND(mask).cast("int")


def _bin(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - BIN_BITS)


def with_signature(df: DataFrame, text: str, out: str, k: int = K, l: int = L) -> DataFrame:  # noqa: E741
    """``df`` with ``out``: the signature, an array of longs (bin in the upper, hash in the lower half).

    Steps are separate projections that use the step before more than once, so each is worked out
    once a row.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != out]
    t = F.btrim(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(BLANKS))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != F.lit(""))
    d = df.select(*cols, F.transform(words, lambda w: F.xxhash64(w)).alias("__w"))
    n = F.when(F.size("__w") >= k, F.size("__w") - F.lit(k - 1)).otherwise(F.least(F.size("__w"), F.lit(1)))
    kmers = F.transform(F.slice("__w", F.lit(1), n), lambda x, i: F.xxhash64(
        x, *[F.get("__w", i + F.lit(j)) for j in range(1, k)]))
    d = d.select(*cols, kmers.alias("__k"))
    d = d.select(*cols, "__k", F.length(F.bin(F.size("__k").cast("long"))).alias("__b"),
                 (F.size(F.array_distinct("__k")) == F.size("__k")).alias("__once"))
    kmer, bits = F.col("__k"), F.col("__b")
    once = F.transform(kmer, lambda x, i: _pack(F.xxhash64(x, F.lit(0)), i, bits))

    def numbered(s: Column) -> Column:  # s: sorted, so that equal k-mers are neighbours in text order
        same = lambda x, j: F.call_function("shiftright", x, bits) == F.call_function(
            "shiftright", F.get(s, j - F.lit(1)), bits)
        starts = F.filter(F.transform(s, lambda x, j: F.when((j > 0) & same(x, j), F.lit(-1)).otherwise(j)),
                          lambda j: j >= 0)
        return _let(starts, lambda st: F.flatten(F.transform(st, lambda a, r: F.transform(
            F.slice(s, a + F.lit(1), F.coalesce(F.get(st, r + F.lit(1)), F.size(s)) - a),
            lambda x, number: _pack(F.xxhash64(F.get(kmer, _position(x, bits)), number), _position(x, bits), bits)))))

    repeated = _let(F.sort_array(F.transform(kmer, lambda x, i: _pack(x, i, bits))), numbered)
    d = d.select(*cols, "__k", "__b", F.sort_array(F.when(F.col("__once"), once).otherwise(repeated)).alias("__s"))
    least = F.filter("__s", lambda x, j: (j < l) | (_bin(x) != _bin(F.get("__s", j - F.lit(l)))))
    # bin first, then text order
    order = F.sort_array(F.transform(least, lambda x: F.call_function(
        "shiftleft", _bin(x), F.lit(40)) + _position(x, bits)))
    d = d.select(*cols, "__k", order.alias("__o"))
    bin_of = lambda x: F.shiftright(x, 40)
    at = lambda x: F.get("__k", x.bitwiseAND(F.expr("(1L << 40) - 1")).cast("int"))

    def entry(x: Column, j: Column) -> Column:
        rest = [F.get("__o", j + F.lit(i)) for i in range(1, l)]
        tuple_hash = F.xxhash64(at(x), *[F.when(bin_of(y) == bin_of(x), at(y)) for y in rest])
        first = (j == 0) | (bin_of(F.get("__o", j - F.lit(1))) != bin_of(x))
        return F.when(first, F.call_function("shiftleft", bin_of(x), F.lit(32)) + tuple_hash.bitwiseAND(F.expr("4294967295L")))

    return d.select(*cols, F.filter(F.transform("__o", entry), lambda x: x.isNotNull()).alias(out))


def as_text(signature) -> Column:
    """A signature as hex digits: ten an entry."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 10, "0")), "")


def likeness(a, b) -> Column:
    """Share of equal entries among the bins that either signature fills; 1 if both are empty."""
    bins = lambda s: F.transform(s, lambda x: F.shiftright(x, 32))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(F.lit(1.0))


def with_next(df: DataFrame, id_col: str, tie: str, carry: list[str], prepare=lambda d: d) -> DataFrame:
    """``df`` with ``__next_<c>`` for each carried column: the next row by descending id.

    ``prepare`` adds columns to carry before rows are shuffled. Ids are cut into slices at
    quantiles, a few to a partition; within a slice the next row is a window's. Each slice also gets the first row of the slice after it, as a sentinel that is
    dropped afterwards, so rows cross the shuffle once and no window spans the table. The table of
    slices, a few for each shuffle partition, is what is broadcast.
    """
    cuts = slice_cuts(df, id_col, SLICES_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cols = df.columns
    d = df.withColumns({"__slot": slice_index(_slice_number(df, id_col), cuts), "__known": F.col(f"`{id_col}`").isNotNull()})
    key = F.struct(F.col("__known"), F.col(f"`{id_col}`").alias("__id"), F.col(tie).alias("__tie"))
    firsts = d.groupBy("__slot").agg(F.max(key).alias("f"))
    every = Window.partitionBy().orderBy(F.desc("__slot"))
    to = F.coalesce(F.lag("__slot").over(every), F.min("__slot").over(Window.partitionBy()))
    firsts = firsts.select(to.alias("__to"), F.col("__slot").alias("__from"), F.col("f.__id").alias("__fid"),
                           F.col("f.__tie").alias("__ftie"))
    match = ((F.col("__slot") == F.col("__from")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__fid"))
             & F.col(tie).eqNullSafe(F.col("__ftie")))
    sentinels = d.join(F.broadcast(firsts), match).select(
        *[F.col(f"`{c}`") for c in cols], F.col("__to").alias("__slot"), "__known", F.lit(True).alias("__extra"))
    both = prepare(d.withColumn("__extra", F.lit(False)).unionByName(sentinels))
    w = Window.partitionBy("__slot").orderBy("__extra", F.desc("__known"), F.desc(id_col), F.desc(tie))
    both = both.withColumns({f"__next_{c}": F.lead(c).over(w) for c in carry})
    return both.filter(~F.col("__extra")).drop("__extra", "__slot", "__known")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, signature array of longs, fingerprint) of every text."""
    s = with_signature(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text")), "__text", "signature")
    return s.select("doc_id", "signature", as_text(F.col("signature")).alias("fingerprint"))


def op3(spark, sf_dir: str) -> DataFrame:
    """Query ``op3_order_minhash``."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    d = with_next(docs, "doc_id", "tie", ["text", "sig"], lambda x: with_signature(x, "text", "sig"))
    d = d.withColumn("n", F.length("text").cast("long"))
    third = F.floor(F.col("n") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n") - third).cast("int")),
                      F.substring(F.col("__next_text"), F.lit(1), third))
    d = d.select("doc_id", "n", "sig", "__next_sig", edited.alias("edited"))
    d = d.select("doc_id", "n", "sig", "__next_sig", "edited", F.sha2("edited", 256).alias("edited_sha256"))
    d = with_signature(d, "edited", "edited_sig")
    return d.select("doc_id", F.col("n").alias("n_chars"), "edited_sha256",
                    as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
                    likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                    likeness(F.col("sig"), F.col("__next_sig")).alias("near_next"))
