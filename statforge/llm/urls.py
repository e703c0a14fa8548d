"""URL filter: host and path rules first, then a weighted vocabulary matched with an Aho-Corasick automaton.

A URL without a fitting rule is judged by its words. All terms are found in one pass over the URL, as whole words
only: a neighbour that is a letter or digit makes a hit void. One strict term blocks; so do ``soft_limit`` different
soft ones. Strict terms never occur in innocent URLs, soft ones do, and only several of them together tell.

Defined results: a NULL URL, or one without ``://``, has an empty host and path, fits no rule, and is judged by its words (a
NULL has none: allow). Repeated rows are judged each. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import map_columns

ALLOW, BLOCK = "allow", "block"
_LETTERS = frozenset(string.ascii_lowercase + string.digits)

# Terms of adult, gambling and piracy sites.
STRICT = ("porn", "porno", "xxx", "hentai", "camgirls", "escorts", "casino", "slots", "warez", "keygen")
SOFT = ("adult", "sex", "sexy", "nude", "hot", "girls", "cams", "dating", "bet", "betting", "poker", "bonus", "jackpot", "crack", "torrent", "pills", "loan", "cheap")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


class Vocabulary:
    """Counts the different strict and soft terms of a URL."""

    def __init__(self, strict: Sequence[str], soft: Sequence[str]):
        self.automaton = ahocorasick.Automaton()
        for weight, terms in ((0, soft), (1, strict)):  # a term in both lists is strict
            for term in terms:
                self.automaton.add_word(term.lower(), (term.lower(), weight))
        if len(self.automaton):
            self.automaton.make_automaton()

    def count(self, url: str | None) -> tuple[int, int]:
        text = (url or "").lower()
        if not text or not len(self.automaton):
            return 0, 0
        found = set()
        for end, (term, weight) in self.automaton.iter(text):
            start = end - len(term) + 1
            if (start == 0 or text[start - 1] not in _LETTERS) and (end + 1 == len(text) or text[end + 1] not in _LETTERS):
                found.add((term, weight))
        strict = sum(weight for _, weight in found)
        return strict, len(found) - strict


class RuleTable:
    """Rules by host; the longest that fits decides, counted in characters of host and path."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
            self.by_host.setdefault(rule.host, []).append(rule)

    def find(self, host: str, path: str) -> Rule | None:
        best, rest = None, host
        while rest:
            for rule in self.by_host.get(rest, ()):
                if path.startswith(rule.path):
                    if best is None or len(rule.name) > len(best.name):
                        best = rule
                    break
            rest = rest.partition(".")[2]
        return best


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_limit: int = 2) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits) for every row; no shuffle."""

    def work(ids, urls, hosts, paths):
        vocabulary, table = Vocabulary(strict, soft), RuleTable(rules)
        hits = [vocabulary.count(url) for url in urls]
        fitting = [table.find(host, path) for host, path in zip(hosts, paths, strict=True)]
        return {
            "page_id": ids,
            "host": hosts,
            "path": paths,
            "rule": [rule and rule.name for rule in fitting],
            "verdict": [rule.verdict if rule else BLOCK if hard or loose >= soft_limit else ALLOW for rule, (hard, loose) in zip(fitting, hits, strict=True)],
            "strict_hits": [hard for hard, _ in hits],
            "soft_hits": [loose for _, loose in hits],
        }

    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return map_columns(parts, "page_id bigint, host string, path string, rule string, verdict string, strict_hits int, soft_hits int", work)


def url_sql(rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_limit: int = 2) -> str:
    """The same in DuckDB's SQL."""
    fits = " UNION ALL ".join(f"SELECT '{r.verdict}' AS verdict, '{r.host}' AS rule_host, '{r.path}' AS rule_path, '{r.name}' AS rule" for r in rules)

    def hits(terms: Sequence[str]) -> str:
        return " + ".join(f"CAST(regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INTEGER)" for term in terms)

    return f"""
        WITH rules AS ({fits}),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
                   {hits(strict)} AS strict_hits, {hits([t for t in soft if t not in strict])} AS soft_hits
            FROM pages),
        ruled AS (
            SELECT p.*, (SELECT struct_pack(rule := r.rule, verdict := r.verdict) FROM rules r
                         WHERE (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
                         ORDER BY length(r.rule) DESC, r.rule LIMIT 1) AS fit
            FROM parts p)
        SELECT page_id, host, path, fit.rule AS rule,
               coalesce(fit.verdict, CASE WHEN strict_hits > 0 OR soft_hits >= {soft_limit} THEN 'block' ELSE 'allow' END) AS verdict,
               CAST(strict_hits AS INTEGER) AS strict_hits, CAST(soft_hits AS INTEGER) AS soft_hits
        FROM ruled"""
