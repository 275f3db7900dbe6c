"""Secret scan by assignment-aware lexing.

A text is read as source code or configuration. A lexer finds assignments ``name = literal``
(also ``:``, ``:=``, ``=>``, quoted names, ``export``, literals in quotes or back quotes, bare words,
other names, and joins of these by ``+``), ``<name>literal</name>`` and ``setName("literal")``.
Constants are propagated: a name used as a value stands for the literals it was assigned, however
many names lie between. A literal's score is the sensitivity of the most telling name it reaches,
plus what its form shows (length, mixed character classes, entropy); from ``THRESHOLD`` on its span is
reported as kind ``named``. A value that is joined from several literals, constants among them, is
also scored as a whole; if it reaches the threshold the spans of all its parts are reported.

Three fixed patterns are reported in any case: ``assign``, ``access`` and ``hex`` (see ``BASE``).

Edge cases: a null or empty text has no spans; spans count code points, the end is exclusive;
overlapping spans of different kinds are all kept; a text of any length is read in one pass, with
the table of its names bounded by the names it assigns. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, read, ship_package

KINDS = ("assign", "access", "hex", "named")
#: The base patterns and the least length of what they find.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

#: Parts of a target name and how far they point to a secret.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "private": 1.5, "auth": 1.5, "bearer": 2.0,
    "signature": 1.0, "access": 1.0, "key": 1.5, "salt": 1.5, "session": 1.0, "cookie": 1.0, "pass": 2.0,
}
#: Name parts that take the sting out (a place, a count, a kind of), and values that are stand-ins.
HARMLESS = {"name": -2.0, "file": -2.0, "path": -2.0, "url": -1.5, "id": -1.0, "count": -2.0, "length": -2.0,
            "type": -2.0, "field": -2.0, "max": -2.0, "min": -2.0, "public": -2.0, "label": -2.0, "limit": -2.0}
STAND_IN = re.compile(r"(?i)^(?:x{3,}|\*{3,}|<.*>|\$\{.*\}|changeme|example.*|your[-_ ].*|none|null|true|false|todo|n/?a)$")
#: Words that tell at the end of a longer lower-case name, too (dbpassword, userpwd).
ENDINGS = ("password", "passwd", "passphrase", "secret", "token", "apikey", "pwd", "credential", "credentials")
#: Calls that ask for a thing rather than set it.
ASKING = ("get", "find", "is", "has", "read", "load", "fetch", "print", "log", "check")
THRESHOLD = 4.0
#: A value joined from more literals than this is scored literal by literal only.
MOST_PARTS = 64
LEAST_CHARS = 8

#: name, optional quote after it, operator, then the value's first token.
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
_ASSIGNMENT = re.compile(rf"(?<![A-Za-z0-9_.\-])([\"']?)({_NAME})\1[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*(?=[\"'`A-Za-z0-9_+/$])")
_TERM = re.compile(rf"\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([A-Za-z0-9_+/=.$\-]+)")
_ELEMENT = re.compile(rf"<({_NAME})>([^<>\s]+)</\1>")
_CALL = re.compile(rf"(?<![A-Za-z0-9_.\-])({_NAME})\([ \t]*(?:\"([^\"\n]*)\"|'([^'\n]*)')[ \t]*\)")
_PLUS = re.compile(r"[ \t]*\+[ \t]*")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_WORDS = re.compile(rf"^{_NAME}$")


def name_score(name: str) -> float:
    """How far a target name points to a secret, by its parts (camelCase and _ split)."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = "".join(parts)
    found = [SENSITIVE.get(p, 0.0) for p in parts] + [SENSITIVE.get(e, 0.0) for p in parts for e in ENDINGS if p.endswith(e)]
    score = max([*found, 3.0 if "apikey" in joined else 0.0], default=0.0)
    return score + min([HARMLESS.get(p, 0.0) for p in parts[-1:]], default=0.0) if score > 0 else 0.0


def literal_score(value: str) -> float:
    """How far a literal looks like a secret by itself: up to 3; negative for stand-ins."""
    if len(value) < LEAST_CHARS or STAND_IN.match(value) or any(c.isspace() for c in value):
        return -5.0
    classes = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))
    n = len(value)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    return min(1.0, n / 24) + (0.7 if classes >= 2 else -0.5) + (0.3 if classes >= 3 else 0.0) + min(1.0, entropy / 4)


def assignments(text: str) -> list[tuple[str, list[tuple[str, int, int, bool]]]]:
    """(name, terms) pairs in order; a term is (text, start, end, is a bare word)."""
    found = []
    at = 0
    while (m := _ASSIGNMENT.search(text, at)) is not None:
        terms, pos = [], m.end()
        while (t := _TERM.match(text, pos)) is not None:
            group = t.lastindex
            terms.append((t[group], t.start(group), t.end(group), group == 4))
            plus = _PLUS.match(text, t.end())
            pos = t.end()
            if plus is None:
                break
            pos = plus.end()
        if terms:
            found.append((m[2], terms))
        # a bare value may itself be the next assignment's name (a: b = c)
        at = max(m.end(), terms[0][1] if terms and terms[0][3] else pos)
    if "</" in text:
        found += [(m[1], [(m[2], m.start(2), m.end(2), False)]) for m in _ELEMENT.finditer(text)]
    if "(" in text:
        for m in _CALL.finditer(text):
            g = m.lastindex
            if (_PARTS.findall(m[1].rsplit(".", 1)[-1]) or [""])[0].lower() not in ASKING:
                found.append((m[1], [(m[g], m.start(g), m.end(g), False)]))
    return found


def literals_of(terms, by_name: dict, seen: set) -> list[tuple[str, int, int]] | None:
    """The literals that terms are joined from, constants replaced by theirs; None for too many.
    ``seen`` are the names being replaced: a name within its own value stands for itself."""
    out = []
    if len(seen) > MOST_PARTS:
        return None
    for value, start, end, bare in terms:
        if bare and value in by_name and value not in seen:
            inner = literals_of(by_name[value], by_name, seen | {value})
            if inner is None:
                return None
            out += inner
        else:
            out.append((value, start, end))
        if len(out) > MOST_PARTS:
            return None
    return out


def named_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
    """(start, end, score) of the literals that reach a sensitive name.

    A name's score passes on to every name in its value, the most telling names first, so that each
    pair of names is looked at once, in whatever order the text assigns them.
    """
    pairs = assignments(text)
    if not pairs:
        return []
    used: dict[str, float] = {}  # name -> score of the most telling name its value reaches
    values: dict[str, list[str]] = {}
    for name, terms in pairs:
        values.setdefault(name, []).extend(t for t, _, _, bare in terms if bare and _WORDS.match(t))
    for start in sorted((n for n in values if name_score(n) > 0), key=lambda n: (-name_score(n), n)):
        score, todo = name_score(start), [start]
        while todo:
            for value in values.get(todo.pop(), ()):
                if value not in used:
                    used[value] = score
                    todo.append(value)
    constants = {}  # name -> the terms of its first assignment
    for name, terms in pairs:
        constants.setdefault(name, terms)
    assigned = set(constants)
    out = {}
    for name, terms in pairs:
        score = max(name_score(name), used.get(name, 0.0))
        if score <= 0:
            continue
        for value, start, end, bare in terms:
            if bare and value in assigned:
                continue  # a constant's name; its own literals are scored
            total = score + literal_score(value)
            if total >= threshold:
                out[start, end] = max(total, out.get((start, end), 0.0))
        if (len(terms) > 1 or terms[0][3]) and name_score(name) > 0:
            parts = literals_of(terms, constants, {name})
            total = score + literal_score("".join(v for v, _, _ in parts)) if parts and len(parts) > 1 else 0.0
            if total >= threshold:
                for value, start, end in parts:
                    if value:
                        out[start, end] = max(total, out.get((start, end), 0.0))
    return [(s, e, v) for (s, e), v in sorted(out.items())]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, sorted by start, then kind as listed."""
    low = text.lower()
    found = []
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of a text, each sorted by start, then kind as listed."""
    if not text:
        return [], []
    base = base_spans(text)
    added = [(s, e, "named") for s, e, _ in named_spans(text)] if any(c in text for c in "=:(<") else []
    every = sorted([*base, *added], key=lambda x: (x[0], KINDS.index(x[2])))
    return base, every


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def masked(text: str | None, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str | None:
    """The text with every span replaced; for ``assign`` only the value goes, its name stays."""
    if not spans:
        return text
    cuts = []
    for s, e, kind in spans:
        if kind == "assign":
            s = ASSIGN.match(text, s).start(2)
        cuts.append((s, e))
    out, at = [], 0
    for s, e in sorted(cuts):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, counts, digest of the base spans, all spans."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    id_arrow = to_arrow_type(id_type)

    def go(batches):
        for batch in batches:
            rows = []
            for t in batch.column(1):
                base, every = scan(t.as_py())
                n = Counter(k for _, _, k in base)
                rows.append((n["assign"], n["access"], n["hex"],
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_arrow), *[pa.array(c, pa.int64()) for c in cols[:3]],
                 *[pa.array(c, pa.string()) for c in cols[3:]]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        go, f"doc_id {id_type.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def mask_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """All documents, secrets in their texts replaced, and the character count brought up to date."""
    ship_package(docs.sparkSession)
    d, names = numbered(docs)

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: masked(t, scan(t)[1]) if t else t)

    text = F.col(names[text_col])
    d = d.withColumn("__clean", clean(text))
    out = {text_col: F.col("__clean")}
    if chars_col and chars_col in names:
        n = F.col(names[chars_col])
        kind = docs.schema[chars_col].dataType
        out[chars_col] = F.when(text.eqNullSafe(F.col("__clean")), n).otherwise(F.length("__clean").cast(kind))
    return d.select(*[out.get(c, F.col(n)).alias(c) for c, n in names.items()])


def op9(spark, sf_dir: str) -> DataFrame:
    """Query ``op9_secret_scan``."""
    return find_secrets(read(spark, sf_dir, "documents"))
