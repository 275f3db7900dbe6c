"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint has 64 bits; documents whose fingerprints differ in at most ``MAX_BITS``
= 4 bits are linked, and linked documents form components.

Keys. The perfect binary Golay code (23, 12, 7) decodes any 23 bits to the one codeword within
distance 3. The key set of a 23-bit window is the codeword indices of all vectors within one bit of
it (1 or 6 keys). Two windows that differ in at most two bits have a vector within one bit of
both, and so a key in common. By the pigeonhole principle on the four 16-bit segments of a
fingerprint, at most four differing bits leave

* a segment without any: that segment, and the 46 bits next to it in two windows, of which one has
  at most two of the four bits. Key: segment, window, codeword index (28 bits).
* or one bit in every segment: one half of each segment is without. Key: which halves, and their
  32 bits.

That is at most 4 * 2 * 6 + 16 = 64 keys a fingerprint, however many documents there are. Rows that
share a key are candidates and are verified on all 64 bits.

Large buckets. Equal fingerprints are one row from the start. In a bucket every member is held
against one pivot (the least member, an aggregate), not against every other. Components of those
links are found; only buckets that still hold more than one component go on. There the members
outside the bucket's largest component are held against the bucket, directly where it has at most
``DIRECT`` members. A larger one is parted by further exact keys: its members share 16 or 32 bits,
and of the other six bytes two, or of the other eight half bytes four, are equal in any link, which
gives 15 or 70 keys of 16 more bits. So a dense bucket of n near members costs n comparisons, one
of n members far from each other at most 70 n key rows and the few that meet on 16 more bits, and no
link between different components is lost.

Aggregates are written before they are joined back on their own key, so that both sides of such a
join are shuffled and adaptive execution can split a key that many rows share.

Edge cases: null, empty or blank text has fingerprint zero, linked like any other; fewer than four
words are one shingle; repeated rows and ids are linked as their fingerprints are equal; a null id
takes part and is its component's id only if the component has no other. Columns besides id and
text are not read; :func:`deduplicate` breaks ties between rows of one id by a hash of all their
columns, whatever the partitions. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, named, numbered, read, ship_package, staged

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: Generator polynomial of the (23, 12, 7) Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1 (fixed value).
GENERATOR = 0b110001110101
SEGMENT = 16
WINDOW = 23
#: Members up to which a bucket of several components is compared directly.
DIRECT = 64


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash over word shingles (repeats counted); A-Z count as a-z."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []  # ASCII case and blanks only
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed)
                  for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = np.array(hashes[i:i + 65_536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint",
                     shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with the fingerprint as a signed long; the text column is dropped."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    rest = docs.drop(text_col, out)
    kept = to_arrow_schema(rest.schema)

    def go(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(0)], dtype=np.uint64)
            cols = [batch.column(i + 1).cast(kept.field(i).type) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fps.view(np.int64))], [*kept.names, out])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    text = F.col(text_col).cast("string").alias("__text")
    return docs.select(text, *[F.col(f"`{c}`") for c in rest.columns]).mapInArrow(go, f"{ddl}, `{out}` long")


# ------------------------------------------------------------------ Golay keys

def _syndromes(v: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator."""
    v = v.copy()
    for bit in range(WINDOW - 1, 10, -1):
        v ^= np.where((v >> bit) & 1, GENERATOR << (bit - 11), 0)
    return v


def _errors() -> np.ndarray:
    """Syndrome -> the error pattern of at most three bits that has it (the code is perfect)."""
    one = 1 << np.arange(WINDOW)
    table = np.zeros(1 << 11, dtype=np.int64)
    patterns = [np.zeros(1, dtype=np.int64), one]
    two = np.array([a | b for i, a in enumerate(one) for b in one[:i]])
    three = np.array([a | b | c for i, a in enumerate(one) for j, b in enumerate(one[:i]) for c in one[:j]])
    for p in [*patterns, two, three]:
        table[_syndromes(p)] = p
    return table


_ERRORS = _errors()


def codeword(v: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    return (v ^ _ERRORS[_syndromes(v)]) >> 11


def fuzzy_keys(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs: the codeword indices of all words within one bit of each word."""
    near = np.stack([codeword(v)] + [codeword(v ^ (1 << b)) for b in range(WINDOW)], axis=1)
    near.sort(axis=1)
    new = np.ones(near.shape, dtype=bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    rows, at = np.nonzero(new)
    return rows, near[rows, at]


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of unsigned 64-bit fingerprints; the key names its kind in the top bits."""
    fps = fps.astype(np.uint64)
    seg = [((fps >> np.uint64(48 - SEGMENT * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    out_rows, out_keys = [], []
    for i in range(4):
        a, b, c = (seg[j] for j in range(4) if j != i)
        rest = (a << 32) | (b << 16) | c
        for w, window in enumerate(((rest >> 25) & 0x7FFFFF, (rest >> 2) & 0x7FFFFF)):
            rows, code = fuzzy_keys(window)
            out_rows.append(rows)
            out_keys.append(((i * 2 + w) << 40) | (seg[i][rows] << 12) | code)
    everyone = np.arange(len(fps))
    for halves in range(16):
        key = np.zeros(len(fps), dtype=np.int64)
        for i in range(4):
            key = (key << 8) | ((seg[i] >> (8 * ((halves >> i) & 1))) & 0xFF)
        out_rows.append(everyone)
        out_keys.append(((8 + halves) << 40) | key)
    return np.concatenate(out_rows), np.concatenate(out_keys)


def _with_keys(batches):
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for i in range(0, len(fps), 20_000):
            part = fps[i:i + 20_000]
            rows, key = keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[rows])], ["key", "fp"])


def part_keys(key: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, part) by which the members of a large bucket meet: which of the bits that the bucket's
    key leaves open are taken (two of six bytes, or four of eight half bytes), and those 16 bits."""
    kind, fps = key >> 40, fps.astype(np.uint64)
    rows, parts = [], []
    for k in np.unique(kind).tolist():
        at = np.flatnonzero(kind == k)
        if k < 8:  # one segment of the four is shared
            units = [8 * u for u in range(8) if u // 2 != 3 - k // 2]
            width, take = 8, 2
        else:  # a half of each segment is shared
            low = [16 * (3 - i) + (0 if ((k - 8) >> i) & 1 else 8) for i in range(4)]
            units = [x + h for x in low for h in (0, 4)]
            width, take = 4, 4
        value = {u: ((fps[at] >> np.uint64(u)) & np.uint64((1 << width) - 1)).astype(np.int64) for u in units}
        for n, chosen in enumerate(itertools.combinations(units, take)):
            part = np.full(len(at), n, dtype=np.int64)
            for u in chosen:
                part = (part << width) | value[u]
            rows.append(at)
            parts.append(part)
    return (np.concatenate(rows), np.concatenate(parts)) if rows else (np.zeros(0, int), np.zeros(0, np.int64))


def _parted(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 10_000):
            some = batch.slice(i, 10_000)
            rows, part = part_keys(some.column(0).to_numpy(), some.column(1).to_numpy().view(np.uint64))
            t = some.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(part)], ["key", "fp", "c", "other", "part"])


# ------------------------------------------------------------------ links and components

def _near(a: str, b: str, max_bits: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links_of(fps: DataFrame, max_bits: int = MAX_BITS, direct: int = DIRECT) -> DataFrame:
    """Component of every fingerprint that is linked: (node, component).

    ``fps`` has one column ``fp`` without repeats. ``max_bits`` may be at most 4, which the keys
    are made for.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    # a row becomes up to 64: spread the rows by count, not by their own small size
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.repartition(parts, "fp").mapInArrow(_with_keys, "key long, fp long")
    pivots = keyed.groupBy("key").agg(F.min("fp").alias("pivot"), F.count(F.lit(1)).alias("n"))
    pivots = staged(pivots.filter("n > 1"), "pivots")
    buckets = staged(keyed.join(pivots, "key"), "buckets")
    to_pivot = buckets.filter((F.col("fp") != F.col("pivot")) & _near("fp", "pivot", max_bits))
    first = staged(to_pivot.select("fp", "pivot").distinct(), "pivot-links")
    comp = components(first, "fp", "pivot")
    # a bucket of two was checked in full; so was one whose members all hang on one component
    named = (buckets.filter("n > 2").join(comp.withColumnRenamed("node", "fp"), "fp", "left")
             .select("key", "fp", "n", F.coalesce("component", "fp").alias("c")))
    named = staged(named, "named")
    per = named.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m"))
    main = per.groupBy("key").agg(F.max(F.struct("m", "c")).alias("main"), F.count(F.lit(1)).alias("cs"))
    main = staged(main.filter("cs > 1").select("key", F.col("main.c").alias("main")), "main")
    split = staged(named.join(main, "key").select("key", "fp", "c", "n", (F.col("c") != F.col("main")).alias("other")), "split-buckets")
    small = split.filter(F.col("n") <= direct).withColumn("part", F.lit(0).cast("long")).drop("n")
    large = split.filter(F.col("n") > direct).drop("n").mapInArrow(_parted, "key long, fp long, c long, other boolean, part long")
    links = []
    for rows in (small, staged(large, "parted")):
        mine = rows.filter("other").select("key", "part", F.col("fp").alias("x"), F.col("c").alias("cx"))
        links.append(mine.join(rows.select("key", "part", "fp", "c"), ["key", "part"])
                     .filter((F.col("cx") != F.col("c")) & _near("x", "fp", max_bits))
                     .select(F.col("x").alias("fp"), F.col("fp").alias("pivot")))
    more = staged(links[0].unionByName(links[1]).distinct(), "cross-links")
    if more.isEmpty():
        return comp
    return components(first.unionByName(more), "fp", "pivot")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, keep: list[str] | None = None,
                    component: str | None = None) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row, and the columns named in ``keep``;
    ``component`` names a column for the component itself (its least fingerprint), which is there
    even if all its ids are null."""
    cols = [F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *[F.col(c) for c in keep or []]]
    fp = staged(with_fingerprint(docs.select(*cols), "__text", "__fp", shingle), "fingerprints")
    by_fp = staged(fp.groupBy("__fp").agg(F.min("__id").alias("least")), "by-fingerprint")
    comp = links_of(by_fp.select(F.col("__fp").alias("fp")), max_bits)
    named = staged(by_fp.join(comp, F.col("__fp") == F.col("node"), "left").select(
        "__fp", "least", F.coalesce("component", "__fp").alias("__c")), "by-component")
    ids = staged(named.groupBy("__c").agg(F.min("least").alias("component_id")), "component-ids")
    of_fp = staged(named.join(ids, "__c").select("__fp", "__c", "component_id"), "of-fingerprint")
    out = fp.join(of_fp, "__fp")
    return out.select(F.col("__id").alias("doc_id"), F.col("__fp").alias("fingerprint"), "component_id",
                      *(keep or []), *([F.col("__c").alias(component)] if component else []))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component: the one with the least id (null last), of rows with that id
    the one with the least hash of all columns, of equal rows one."""
    d, names = numbered(docs)
    id_col, text_col = names[id_col], names[text_col]
    tagged = d.withColumn("__tag", F.xxhash64(*names.values()))
    near = near_duplicates(tagged, id_col, text_col, keep=["__tag"], component="__component")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("__tag").alias("t"))
    best = near.groupBy("__component").agg(F.min(order).alias("m"))
    best = best.select(F.col("m.b").alias("__id"), F.col("m.t").alias("__t"))
    kept = tagged.join(best, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__tag") == F.col("__t")), "left_semi")
    one = Window.partitionBy(id_col, "__tag").orderBy(F.lit(0))  # equal rows
    return kept.withColumn("__row", F.row_number().over(one)).filter("__row = 1").select(*named(names))


def op2(spark, sf_dir: str) -> DataFrame:
    """Query ``op2_simhash_golay``."""
    near = near_duplicates(read(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
