"""URL filter: host and path rules, then a weighted vocabulary.

The rule with the longest text that fits decides. Urls without a fitting rule go to the
vocabulary: an Aho-Corasick automaton finds its terms in one pass over the lower-cased url,
a hit counts only between characters that are not letters or digits, and the url is
rejected on one strict term or on several distinct soft ones.

Defined results: a url without ``://`` has an empty host and path and no rule, so the
vocabulary decides over the whole of it; a null url has no terms and is allowed; repeated
rows are judged one by one; extra columns pass through, and a column named like a new one is
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import append_columns

# Host and path prefixes with their verdicts.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Vocabulary:
    """Terms in lower case; ``soft_limit`` distinct soft hits reject a url."""

    strict: tuple[str, ...] = (
        "porn", "xxx", "hentai", "camgirls", "escorts", "casino", "warez", "keygen", "phishing",
    )
    soft: tuple[str, ...] = (
        "ads", "ad", "track", "tracker", "click", "promo", "bet", "poker", "slots", "sex",
        "adult", "nude", "pills", "crack", "torrent", "spam", "loan", "payday",
    )
    soft_limit: int = 2


def split_url(url: str | None) -> tuple[str, str]:
    """Host, with A-Z in lower case, and path."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    at += 3
    host_end = min((i for i in (url.find(c, at) for c in "/?#") if i >= 0), default=len(url))
    path_end = min(
        (i for i in (url.find(c, host_end) for c in "?#") if i >= 0), default=len(url)
    )
    return url[at:host_end].translate(_UPPER), url[host_end:path_end]


class RuleIndex:
    """Rules by host; a url tries its host and each parent domain."""

    def __init__(self, rules: dict[str, str]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for rule, verdict in rules.items():
            host, slash, rest = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + rest, rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        domain = host
        while domain:
            for prefix, rule, verdict in self.by_host.get(domain, ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            domain = domain.partition(".")[2]
        return best


class TermCounter:
    """Aho-Corasick over both kinds of terms."""

    def __init__(self, vocabulary: Vocabulary):
        self.limit = vocabulary.soft_limit
        self.automaton = ahocorasick.Automaton()
        kinds = {t: False for t in vocabulary.soft} | {t: True for t in vocabulary.strict}
        for term, strict in kinds.items():
            self.automaton.add_word(term, (term, strict))
        self.empty = not kinds
        if kinds:
            self.automaton.make_automaton()

    def hits(self, url: str) -> tuple[set[str], set[str]]:
        """Distinct strict and soft terms that stand alone in ``url``."""
        strict_hits: set[str] = set()
        soft_hits: set[str] = set()
        if self.empty:
            return strict_hits, soft_hits
        text = url.translate(_UPPER)
        for last, (term, strict) in self.automaton.iter(text):
            first = last - len(term) + 1
            if first and text[first - 1].isalnum():
                continue
            if last + 1 < len(text) and text[last + 1].isalnum():
                continue
            (strict_hits if strict else soft_hits).add(term)
        return strict_hits, soft_hits

    def rejects(self, hits: tuple[set[str], set[str]]) -> bool:
        return bool(hits[0]) or len(hits[1]) >= self.limit


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: dict[str, str] | None = None,
    vocabulary: Vocabulary | None = None,
) -> DataFrame:
    """Add host, path, rule, verdict, and the distinct strict and soft terms that were hit."""
    chosen = RULES if rules is None else rules
    terms = vocabulary or Vocabulary()
    new = (
        T.StructType()
        .add("host", "string")
        .add("path", "string")
        .add("rule", "string")
        .add("verdict", "string")
        .add("n_strict", "long")
        .add("n_soft", "long")
    )

    def compute():
        index, counter = RuleIndex(chosen), TermCounter(terms)

        def judge(value: str | None) -> tuple:
            host, path = split_url(value)
            found = index.find(host, path)
            hits = counter.hits(value or "")
            rule, verdict = found or (None, "block" if counter.rejects(hits) else "allow")
            return host, path, rule, verdict, len(hits[0]), len(hits[1])

        def step(columns: list[pa.Array]) -> list:
            rows = [judge(x) for x in columns[0].to_pylist()]
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6

        return step

    return append_columns(pages, [url], new, compute)
