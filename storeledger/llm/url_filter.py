"""URL filters: listed rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import ascii_lower

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
# The labelled table is small; at most so many rows of it are fitted on the driver.
MAX_LABELLED = 50_000


@dataclass(frozen=True)
class UrlRule:
    """allow or block for a host, its subdomains, and paths that start with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: tuple[UrlRule, ...], host: Column, path: Column) -> Column:
    """The longest fitting rule's name, or null; ties go to the longer host, then list order."""
    chosen = F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host)))
    for rule in reversed(order):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(rule.name)).otherwise(chosen)
    return chosen


def _hashed(part: str, text: str) -> list[int]:
    """Buckets of the n-grams of a host or path; digits all read as 0."""
    text = "^" + re.sub(r"[0-9]+", "0", text.lower()) + "$"
    return [
        zlib.crc32(f"{part}{text[i : i + n]}".encode("utf-8", "surrogatepass")) % BUCKETS
        for n in GRAMS
        for i in range(len(text) - n + 1)
    ]


def features(host: str, path: str) -> np.ndarray:
    """The distinct buckets of a URL: host n-grams and path n-grams hash apart."""
    return np.unique(np.array(_hashed("h", host) + _hashed("p", path), dtype=np.int64))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Log-odds of block; each URL's buckets share a length of 1."""
        found = features(host, path)
        return float(self.weights[found].sum() / np.sqrt(max(1, len(found))) + self.bias)


def split_url(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", "")


def train(
    labelled: DataFrame, max_labelled: int = MAX_LABELLED, rounds: int = 400, l2: float = 1e-4
) -> UrlModel:
    """Fit on (url, blocked) rows: full-batch gradient steps, the same on every run.

    Rows with a null url or label are left out. Beyond `max_labelled` rows, those with
    the smallest hash of their url are taken.
    """
    rows = (
        labelled.select("url", F.col("blocked").cast("int").alias("blocked"))
        .dropna()
        .orderBy(F.xxhash64("url"), "url", "blocked")
        .limit(max_labelled)
        .collect()
    )
    weights, bias = np.zeros(BUCKETS), 0.0
    if not rows:
        return UrlModel(weights, bias)
    found = [features(*split_url(r["url"])) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    col = np.concatenate(found)
    value = 1 / np.sqrt(np.array([max(1, len(f)) for f in found]))[row]
    truth = np.array([r["blocked"] for r in rows], dtype=np.float64)
    # Both classes weigh the same, whatever their counts.
    share = np.where(truth == 1, 0.5 / max(1, truth.sum()), 0.5 / max(1, (1 - truth).sum()))
    step = 8.0
    for _ in range(rounds):
        odds = np.bincount(row, weights[col] * value, minlength=len(rows)) + bias
        wrong = (1 / (1 + np.exp(-odds)) - truth) * share
        weights -= step * (np.bincount(col, wrong[row] * value, minlength=BUCKETS) + l2 * weights)
        bias -= step * wrong.sum()
    return UrlModel(weights, float(bias))


def url_filter(
    pages: DataFrame,
    rules: tuple[UrlRule, ...],
    model: UrlModel,
    threshold: float = 0.0,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, and the model's log-odds.

    A null url, or one without ://, has an empty host and path, fits no rule and is
    judged by the model as an empty text. Repeated rows and null ids are passed through;
    other columns are ignored. An empty table gives an empty result.
    """
    weights = model.weights
    bias = model.bias

    @F.pandas_udf("double")
    def log_odds(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        known = UrlModel(weights, bias)
        seen: dict[tuple[str, str], float] = {}
        out = np.empty(len(hosts))
        for i, key in enumerate(zip(hosts, paths, strict=True)):
            if key not in seen:
                seen[key] = known.score(*key)
            out[i] = seen[key]
        return pd.Series(out)

    url = F.col("_url")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select(
        "_id", host_of(url).alias("host"), path_of(url).alias("path")
    )
    rows = rows.withColumn("rule", rule_for(rules, F.col("host"), F.col("path")))
    rows = rows.withColumn("log_odds", log_odds("host", "path"))
    verdict = F.when(F.col("log_odds") >= threshold, "block").otherwise("allow")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.name, rule.verdict).otherwise(verdict)
    return rows.select(
        F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "log_odds"
    )


# A small labelled table of invented URLs. Common words of names that sites
# worth blocking carry, and of plain sites. No name is taken from a table that is judged.
BLOCKED_NAMES = (
    "adult adultvideo sexyadults adultsite xxx xxxtube porn pornhd sexcams escort escortgirls hotsingles "
    "casino grandcasino casinoroyal poker pokerstar bet bets betting sportbets betonline jackpot "
    "megajackpot slots freeslots lottery winlottery "
    "pharma cheappharma pills dietpills viagra buyviagra cialis replicawatches cheapwatches "
    "spam spammail ads tracker linkfarm linkfarms clickfarm freemoney moneyfree payday paydayloan "
    "adserver adsnetwork trackads adtracker clicktrack trackerpixel popads popunder "
    "warez cracks crackz torrentz keygen malware phishing phishlogin getrich richquick"
).split()
PLAIN_NAMES = (
    "news library museum weather school university garden recipes travel music history "
    "science health sports city cinema forum shop docs journal radio theatre kitchen "
    "bakery mountain river harbour village painter teacher engineer physics chemistry "
    "biology gardening cycling railway aviation poetry novels archive council parliament "
    "hospital dentist carpenter plumber florist bookshop orchestra gallery festival"
).split()
_SHAPES = ("https://{}.{}/", "http://www.{}.{}/about.htm", "https://{}.{}/list/all", "http://my.{}.{}")
_ENDS = ("com", "net", "org")


# Parts of made-up names, which stand for the many plain sites whose names say nothing.
_ONSETS = "b c d f g h l m n p r s t v w th sh ch st tr br pl".split()
_VOWELS = "a e i o u ea ou ie".split()
_ENDINGS = "n r s t l nd st ng m".split()
MADE_UP_NAMES = 250


def made_up_names(count: int = MADE_UP_NAMES) -> list[str]:
    """Names of two or three syllables, drawn by a fixed seed."""
    draw = random.Random(20)

    def syllable() -> str:
        return draw.choice(_ONSETS) + draw.choice(_VOWELS) + draw.choice(_ENDINGS)

    return ["".join(syllable() for _ in range(draw.choice((2, 2, 3)))) for _ in range(count)]


# Neutral company that names of both classes keep.
_FORMS = ("{}", "my{}", "the-{}", "{}online", "best-{}", "{}24", "{}-now", "{}host", "{}world")


def labelled_urls() -> list[tuple[str, int]]:
    """(url, blocked) rows: every listed name in every form, shapes and ends in turn."""
    listed = [
        (form.format(name), label)
        for label, names in ((1, BLOCKED_NAMES), (0, PLAIN_NAMES))
        for name in names
        for form in _FORMS
    ]
    named = listed + [(name, 0) for name in made_up_names()]
    return [
        (_SHAPES[i % len(_SHAPES)].format(name, _ENDS[i % len(_ENDS)]), label)
        for i, (name, label) in enumerate(named)
    ]
