"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host and path are cut from the url with column functions. A rule names a host and a path; it fits
that host and its subdomains when the url's path starts with the rule's. The longest rule that
fits decides. All other urls are judged by the model, from the n-grams of host and of path, each
in slots of their own.

The model is trained on the driver from a small labelled table of urls, ``seeds()`` unless another is
given (``labelled``: url, block; read up to ``MOST_LABELLED`` rows, in the order of a hash).

Edge cases: a null url, or one without ``://``, has empty host and path, fits no rule and is judged
by the model's bias alone (allowed); host letters A-Z are lower-cased, others stay; repeated rows
get equal results; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, numbered, read, ship_package

#: (verdict, host, path): the query's rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SLOT_BITS = 13
GRAMS = (3, 4, 5)
MOST_LABELLED = 5_000
#: A url is blocked only on fairly clear evidence.
BLOCK_FROM = 0.6

#: The small labelled table: words dealt by `seeds` over neutral hosts and paths. They are chosen
#: by subject, not from a table of pages.
BLOCK_WORDS = ["casino", "poker", "betting", "slots", "jackpot", "lottery", "pills", "viagra", "adult", "porn", "sex", "ads",
               "tracker", "popup", "spam", "malware", "phishing", "warez", "crack", "torrent", "loans", "prize", "dates",
               "replica", "bonus", "escort", "xxx", "bets", "linkfarm", "advert", "keygen", "gambling", "cheap-watches",
               "free-money"]
ALLOW_WORDS = ["news", "library", "museum", "weather", "science", "history", "garden", "school", "recipes", "travel",
               "health", "books", "music", "city", "council", "research", "journal", "forum", "wiki", "docs", "archive",
               "university", "theatre", "nature", "kitchen", "maps", "radio", "gazette", "academy", "village", "ferry",
               "planet", "stories", "letters", "market", "harbour", "football"]
#: What stands around a word, the same for both classes.
FILLERS = ["online", "best", "shop", "tips", "page", "my", "club", "site"]
SITES = [("", "example.com"), ("www.", "example.net"), ("m.", "example.org"), ("blog.", "site.info")]
PLAIN_HOSTS = ["site.example.org", "www.example.com", "m.site.info", "pages.example.net"]
PATHS = ["/{lang}/{word}", "/{word}/", "/{lang}/{word}.html", "/{word}-{n}"]


def seeds() -> list[tuple[str, int]]:
    """The labelled table: every word, alone or beside a filler, in hosts with neutral paths, in
    paths under neutral hosts, and in both."""
    out = []
    for block, words in ((1, BLOCK_WORDS), (0, ALLOW_WORDS)):
        for i, w in enumerate(words):
            for k in range(4):
                j = (i + k) % 4
                lang, n = ("en", "de", "fr", "es")[j], (37 * i + 11 * j) % 1000
                end, filler = ("", "/", ".html", "?page=2")[(i + 2 * j) % 4], FILLERS[(3 * i + j) % len(FILLERS)]
                word = w if j % 2 == 0 else f"{w}-{filler}" if (i + j // 2) % 2 else f"{filler}-{w}"
                host = f"{SITES[j][0]}{word}.{SITES[j][1]}"
                for site, path in ((host, f"/{lang}/{n}{end}"), (PLAIN_HOSTS[(i + j) % 4], PATHS[j].format(lang=lang, n=n, word=word)),
                                   (host, PATHS[(j + 1) % 4].format(lang=lang, n=n, word=w))):
                    out.append((f"https://{site}{path}", block))
    return out


# ------------------------------------------------------------------ url parts and rules

def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    at = F.locate("://", url) if isinstance(url, str) else F.call_function("locate", F.lit("://"), url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule = verdict = None
    for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)) if rule is None else rule.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(action)) if verdict is None else verdict.when(fits, F.lit(action))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


# ------------------------------------------------------------------ model

def grams(part: str, text: str) -> list[int]:
    """Slots of a part's n-grams; the part's name keeps host and path apart."""
    t = f"^{text}$"
    return [zlib.crc32(f"{part}:{t[i:i + n]}".encode("utf-8", "replace")) & ((1 << SLOT_BITS) - 1)
            for n in GRAMS for i in range(len(t) - n + 1)]


def split_url(url: str | None) -> tuple[str, str]:
    """The same cut as :func:`url_parts`, for training urls on the driver."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    stop = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, part: str, text: str) -> float:
        """What a part adds to the log odds of blocking."""
        if not text:
            return 0.0
        g = grams(part, text)
        return float(self.weights[g].sum()) / max(1.0, len(g) ** 0.5) if g else 0.0

    def probability(self, host: str, path: str) -> float:
        return 1 / (1 + np.exp(-(self.bias + self.score("host", host) + self.score("path", path))))


def train(rows: list[tuple[str, int]], rounds: int = 60, rate: float = 0.5, ridge: float = 1e-3) -> UrlModel:
    """Logistic regression by full-batch gradient steps (Adagrad) on the labelled urls."""
    at, row, value = [], [], []
    y = np.array([float(b > 0) for _, b in rows])
    for i, (url, _) in enumerate(rows):
        for part, text in zip(("host", "path"), split_url(url)):
            g = grams(part, text) if text else []
            at += g
            row += [i] * len(g)
            value += [1 / max(1.0, len(g) ** 0.5)] * len(g)
    at, row, value = np.array(at, dtype=int), np.array(row, dtype=int), np.array(value)
    w, bias = np.zeros(1 << SLOT_BITS), 0.0
    if not 0 < y.sum() < len(y):
        return UrlModel(w, -1.0)
    past, past_bias = np.full(len(w), 1e-8), 1e-8
    for _ in range(rounds):
        z = bias + np.bincount(row, weights=w[at] * value, minlength=len(y))
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        grad = np.bincount(at, weights=miss[row] * value, minlength=len(w)) / len(y) + ridge * w
        past += grad ** 2
        w -= rate * grad / np.sqrt(past)
        g = float(miss.mean())
        past_bias += g ** 2
        bias -= rate * g / past_bias ** 0.5
    return UrlModel(w, min(bias, -1e-3))


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``pages`` with the struct ``verdict``: host, path, rule, verdict, probability."""
    ship_package(pages.sparkSession)
    if labelled is None:
        rows = seeds()
    else:
        rows = [(r[0], r[1]) for r in labelled.select("url", "block").filter("url is not null and block is not null")
                .orderBy(F.xxhash64("url"), "url", "block").limit(MOST_LABELLED).collect()]
    model = train(rows)

    @F.pandas_udf("double")
    def blocked(hosts, paths):
        import pandas as pd

        host = {h: model.score("host", h) for h in hosts.unique()}
        z = model.bias + hosts.map(host).to_numpy(dtype=float) + np.array([model.score("path", p) for p in paths])
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    d, names = numbered(pages)
    host, path = url_parts(F.col(names[url_col]).cast("string"))
    d = d.withColumns({"__host": host, "__path": path})
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    d = d.withColumns({"__rule": rule, "__ruled": verdict, "__p": blocked("__host", "__path")})
    by_model = F.when(F.col("__p") >= BLOCK_FROM, F.lit("block")).otherwise(F.lit("allow"))
    return d.select(*named(names, "verdict"), F.struct(
        F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"),
        F.coalesce("__ruled", by_model).alias("verdict"), F.col("__p").alias("probability")).alias("verdict"))


def op7(spark, sf_dir: str) -> DataFrame:
    """Query ``op7_url_filter``."""
    d = judge(read(spark, sf_dir, "pages").select("page_id", "url"))
    return d.select("page_id", "verdict.host", "verdict.path", "verdict.rule", "verdict.verdict", "verdict.probability")
