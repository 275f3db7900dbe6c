"""Config-driven field extraction from raw web pages.

Each page is parsed once (standard-library ``html.parser``) into a light
element tree; every rule of the chosen rule set is then evaluated on it. The
work runs in ``mapInPandas`` so pages are processed where they sit, in Arrow
batches, one output row per page. A page that fails is kept with its
``error`` text and null fields, so callers can split good rows from rejects
without stopping the job.

Rule kinds:

* :class:`AttrRule` — first ``<tag attribute=value>`` in document order; its
  ``data-value`` attribute if present, else its text; stripped; null if absent.
* :class:`LabelRule` — first ``<tag class=...>`` whose only text, stripped,
  equals the label; the label itself, or (``nested``) the text of its next
  sibling matching ``(sibling_tag, sibling_class)``; null if absent.

A class condition matches the whole attribute value or any one of its
space-separated words. Text of ``script``/``style`` descendants and comments is
not part of an element's text. Cut-off pages yield whatever was parsed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import load_day
from ..session import ship_package
from .files import check_scope

ERROR_COL = "error"

# Elements without content of the HTML living standard and of HTML 4, and those
# whose text is no text of the page.
VOID_TAGS = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "spacer", "track", "wbr", "basefont",
    "bgsound", "command", "frame", "image", "isindex", "nextid",
})
OPAQUE_TEXT_TAGS = frozenset({"script", "style", "template"})


# --------------------------------------------------------------------------- tree
class _Comment(str):
    """A comment node: a child for ``.string`` purposes, never part of text."""


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent

    # single text child (down a chain of single children), like a parser's ``.string``
    @property
    def string(self):
        el = self
        while True:
            if len(el.children) != 1:
                return None
            ch = el.children[0]
            if isinstance(ch, str):
                return ch
            el = ch

    def text(self) -> str:
        """Concatenated descendant text in document order (iterative: deep pages are fine)."""
        out: list[str] = []
        opaque_self = self.tag in OPAQUE_TEXT_TAGS
        stack = [iter(self.children)]
        while stack:
            ch = next(stack[-1], None)
            if ch is None:
                stack.pop()
            elif isinstance(ch, str):
                if not isinstance(ch, _Comment):
                    out.append(ch)
            elif ch.tag in OPAQUE_TEXT_TAGS and not opaque_self:
                continue
            else:
                stack.append(iter(ch.children))
        return "".join(out)

    def next_siblings(self):
        if self.parent is None:
            return
        sibs = self.parent.children
        i = next(k for k, c in enumerate(sibs) if c is self)
        for c in sibs[i + 1:]:
            if not isinstance(c, str):
                yield c


class Document:
    """A parsed page: the element tree and its elements by tag, in document order."""
    __slots__ = ("root", "by_tag")

    def __init__(self, root: Element, by_tag: dict):
        self.root = root
        self.by_tag = by_tag

    def elements(self, tag: str) -> list[Element]:
        return self.by_tag.get(tag, [])


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element(None, {}, None)
        self.cur = self.root
        self.by_tag: dict[str, list[Element]] = {}

    def _add_text(self, s: str, comment: bool = False):
        kids = self.cur.children
        if not comment and kids and isinstance(kids[-1], str) and not isinstance(kids[-1], _Comment):
            kids[-1] = kids[-1] + s
        else:
            kids.append(_Comment(s) if comment else s)

    def _open(self, tag, attrs) -> Element:
        el = Element(tag, {k: ("" if v is None else v) for k, v in attrs}, self.cur)
        self.cur.children.append(el)
        self.by_tag.setdefault(tag, []).append(el)  # start tags arrive in document order
        return el

    def handle_starttag(self, tag, attrs):
        el = self._open(tag, attrs)
        if tag not in VOID_TAGS:
            self.cur = el

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)

    def handle_endtag(self, tag):
        el = self.cur
        while el is not self.root and el.tag != tag:
            el = el.parent
        if el is not self.root:
            self.cur = el.parent

    def handle_data(self, data):
        self._add_text(data)

    def handle_comment(self, data):
        self._add_text(data, comment=True)


def parse_document(html: str) -> Document:
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return Document(b.root, b.by_tag)



def _class_matches(value: str | None, want: str) -> bool:
    if value is None:
        return False
    words = value.split()
    return want in words or want == " ".join(words) or want == value


def _attr_matches(el: Element, attribute: str, want: str | None) -> bool:
    if attribute not in el.attrs:
        return False
    v = el.attrs[attribute]
    if want is None:
        return True
    if attribute == "class":
        return _class_matches(v, want)
    return v == want


# --------------------------------------------------------------------------- rules
@dataclass(frozen=True)
class AttrRule:
    field: str
    tag: str
    attribute: str | None = None
    value: str | None = None

    def apply(self, doc: Document) -> str | None:
        for el in doc.elements(self.tag):
            if self.attribute is None or _attr_matches(el, self.attribute, self.value):
                if "data-value" in el.attrs:
                    return el.attrs["data-value"].strip()
                return el.text().strip()
        return None


@dataclass(frozen=True)
class LabelRule:
    field: str
    tag: str
    css_class: str | None
    label: str
    sibling_tag: str | None = None
    sibling_class: str | None = None
    nested: bool = False

    def apply(self, doc: Document) -> str | None:
        want = self.label.strip()
        hit = None
        for el in doc.elements(self.tag):
            if self.css_class is not None and not _class_matches(el.attrs.get("class"), self.css_class):
                continue
            s = el.string
            if s and s.strip() == want:
                hit = el
                break
        if hit is None:
            return None
        if not self.nested:
            return hit.text().strip()
        for sib in hit.next_siblings():
            if self.sibling_tag is not None and sib.tag != self.sibling_tag:
                continue
            if self.sibling_class is not None and not _class_matches(sib.attrs.get("class"), self.sibling_class):
                continue
            return sib.text().strip()
        return None


Rule = AttrRule | LabelRule


def rule_from_config(cfg: dict) -> Rule:
    """Build a rule from a config entry shaped like the scraper's field configs."""
    fieldname = cfg.get("target_field")
    if cfg.get("is_data_value"):
        return AttrRule(fieldname, cfg["html_element_tag"], cfg.get("identifier_attribute"),
                        cfg.get("identifier_value"))
    if cfg.get("is_text_value"):
        return LabelRule(fieldname, cfg["html_element_tag"], cfg.get("text_class_name"),
                         cfg["text_class_filter"], cfg.get("sibling_html_element_value_tag"),
                         cfg.get("sibling_html_element_value_class"),
                         bool(cfg.get("is_nested_text_value")))
    raise ValueError(f"unspecified rule kind for field {fieldname!r}")


def extract_fields(html: str | None, rules: Sequence[Rule]) -> tuple[list, str | None]:
    """All rule values of one page and an error text (None when fine)."""
    if html is None or (isinstance(html, str) and html.strip() == ""):
        return [None] * len(rules), "empty page"
    try:
        doc = parse_document(html)
        vals = []
        for r in rules:
            try:
                vals.append(r.apply(doc))
            except Exception as e:  # one rule failing fails the page
                raise RuntimeError(f"rule {r.field!r} failed: {e}") from e
        return vals, None
    except Exception as e:
        return [None] * len(rules), f"{type(e).__name__}: {e}"


def extract_records(pages: DataFrame, rules: Sequence[Rule | dict], html_col: str = "html",
                    keep: Sequence[str] = ("page_id",), load_ts=None) -> DataFrame:
    """One row per page: ``keep`` columns, one string column per rule, ``error``.

    ``load_ts`` (a timestamp literal or column) adds ``load_timestamp_utc``,
    its UTC start of day.
    """
    rules = [r if isinstance(r, (AttrRule, LabelRule)) else rule_from_config(r) for r in rules]
    names = [r.field for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("rule fields must be unique")
    keep = list(keep)
    in_df = pages.select(*keep, F.col(html_col).alias("__html"))
    out_fields = [f for f in in_df.schema.fields if f.name in keep]
    out_schema = T.StructType(out_fields + [T.StructField(n, T.StringType()) for n in names]
                              + [T.StructField(ERROR_COL, T.StringType())])
    rules_t = tuple(rules)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cols = {n: [] for n in names}
            errs = []
            for html in pdf["__html"]:
                vals, err = extract_fields(html, rules_t)
                for n, v in zip(names, vals):
                    cols[n].append(v)
                errs.append(err)
            out = pdf[keep].copy()
            for n in names:
                out[n] = pd.Series(cols[n], index=pdf.index, dtype=object)
            out[ERROR_COL] = pd.Series(errs, index=pdf.index, dtype=object)
            yield out

    ship_package(pages.sparkSession)
    res = in_df.mapInPandas(run, out_schema)
    if load_ts is not None:
        ts = load_ts if not isinstance(load_ts, str) else F.lit(load_ts).cast(T.TimestampNTZType())
        res = res.withColumn("load_timestamp_utc", load_day(ts))
    return res


def split_rejects(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``error``, rejected rows: keys and ``error``)."""
    good = records.filter(F.col(ERROR_COL).isNull()).drop(ERROR_COL)
    bad = records.filter(F.col(ERROR_COL).isNotNull())
    return good, bad


def rules_for(scope: str) -> list[Rule]:
    """Rule set of a scope (``daily`` quotes page or ``weekly`` profile page)."""
    from .page_rules import DAILY_RULES, WEEKLY_RULES
    return list(DAILY_RULES if check_scope(scope) == "daily" else WEEKLY_RULES)
