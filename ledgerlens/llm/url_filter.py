"""URL filter: domain rules first, then a weighted vocabulary of strict and soft terms.

The vocabulary is one Aho-Corasick automaton per worker.  A hit counts only between boundaries
(the ends of the URL, or any sign but A-Z, a-z, 0-9), each distinct term once; a URL is blocked when
its weights reach 1, so by one strict term or by several distinct soft ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, built_once

STRICT = ("porn", "xxx", "nsfw", "casino", "viagra", "escort", "adult", "spam", "warez", "malware", "phishing", "hentai")
SOFT = (
    "ads track pills cheap bets bet win free sex nude girls hot live cam poker slots jackpot loan loans payday replica "
    "crack keygen torrent bonus dating hookup pharmacy discount farm click popup"
).split()
#: (host, path) -> verdict; a rule fits its host and all subdomains.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}
VERDICTS = "hits array<string>, weight double"


def vocabulary(strict: Sequence[str] = STRICT, soft: Sequence[str] = tuple(SOFT), soft_hits: int = 2) -> dict[str, float]:
    """Weights of the terms: 1 for a strict one, and for a soft one the share that ``soft_hits`` of them need."""
    return {t.lower(): 1.0 / soft_hits for t in soft} | {t.lower(): 1.0 for t in strict}


class Matcher:
    def __init__(self, weights: Mapping[str, float]):
        self.weights, self.automaton = weights, ahocorasick.Automaton()
        for term in weights:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[str]:
        """Distinct terms of a lower-cased text, in alphabetical order."""
        found = set()
        edge = lambda i: not (0 <= i < len(text) and text[i].isascii() and text[i].isalnum())
        for end, term in self.automaton.iter(text) if self.weights else ():
            if edge(end + 1) and edge(end - len(term)):
                found.add(term)
        return sorted(found)


def term_hits(url: Column, weights: Mapping[str, float]) -> Column:
    """struct(hits, weight) of each URL; NULL has none.  The vocabulary travels with the function: keep it small."""
    weights = dict(weights)

    @F.pandas_udf(VERDICTS)
    def run(urls: pd.Series) -> pd.DataFrame:
        matcher = built_once(("urls", tuple(sorted(weights.items()))), lambda: Matcher(weights))
        hits = [matcher.hits(u) for u in urls]
        return pd.DataFrame({"hits": hits, "weight": [sum(weights[t] for t in h) for h in hits]})

    return run(F.coalesce(ascii_lower(url), F.lit("")))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(
    df: DataFrame,
    rules: Mapping[tuple[str, str], str] = RULES,
    weights: Mapping[str, float] | None = None,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per input row: ``key``, host, path, rule, verdict, hits, weight.

    The longest rule that fits decides, else the vocabulary.  Row by row, without a shuffle, so hot
    hosts do not matter.  A NULL URL and one without ``://`` have an empty host and path and fit no
    rule; the vocabulary still reads the latter.  Repeated rows are judged alike, an empty table
    gives an empty result, other columns are not read.
    """
    weights = vocabulary() if weights is None else weights
    rows = df.select(F.col(key), F.col(url).cast("string").alias("_url"))
    rows = rows.select(key, host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"), term_hits(F.col("_url"), weights).alias("_found"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("_found.weight") >= 1 - 1e-9, "block").otherwise("allow")
    for (at, start), said in sorted(rules.items(), key=lambda r: (len(r[0][0]) + len(r[0][1]), r[0])):
        fits = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rows.select(key, "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.col("_found.hits").alias("hits"), F.col("_found.weight").alias("weight"))
