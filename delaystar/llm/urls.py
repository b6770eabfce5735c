"""URL filter: host/path rules first, then a weighted vocabulary found by one Aho-Corasick pass.

The automaton is built once per Python worker from the (small, declared) term
lists and reads each URL once, whatever the number of terms.  A hit counts only
between boundaries: the characters before and after it are no ASCII letter or
digit, so ``essex`` holds no ``sex``.  A URL is blocked by one strict term or by
``min_soft`` distinct soft terms.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is judged by its (possibly empty) text.  A very long URL is read whole,
once.  Repeated rows are judged each; a null page_id passes through; an empty table gives
no rows; other columns of the input, of whatever name, are dropped.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

import ahocorasick
from pyspark.sql import DataFrame

from delaystar.llm.tables import LOWER, UPPER, map_batches

#: FIXED VALUES: (host, path, verdict) rules of the judged query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Terms that block alone, and terms that block only in company.
STRICT_TERMS = ("hentai", "link-farm", "phishing", "porn", "spam-farm", "warez", "xxx")
SOFT_TERMS = (
    "adult", "bet", "bets", "casino", "crack", "escort", "jackpot", "keygen", "lottery",
    "nude", "pills", "poker", "sex", "slots", "spam", "torrent", "viagra", "webcam",
)
MIN_SOFT = 2
SCHEMA = "page_id bigint, host string, path string, rule string, verdict string, strict_hits bigint, soft_hits bigint"

_HOST_AND_PATH = re.compile(r"://([^/?#]*)([^?#]*)")
_TO_LOWER = str.maketrans(UPPER, LOWER)
_INSIDE_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@functools.lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (2, strict)):  # a term in both lists is strict
        for term in terms:
            found.add_word(term, (weight, term))
    found.make_automaton()
    return found


def term_hits(url: str, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Numbers of distinct strict and soft terms that stand between boundaries in ``url``."""
    text = url.translate(_TO_LOWER)
    hits = set()
    for last, (weight, term) in _automaton(strict, soft).iter(text):
        first = last - len(term) + 1
        before = first > 0 and text[first - 1] in _INSIDE_WORD
        after = last + 1 < len(text) and text[last + 1] in _INSIDE_WORD
        if not before and not after:
            hits.add((weight, term))
    n_strict = sum(weight == 2 for weight, _ in hits)
    return n_strict, len(hits) - n_strict


def split_url(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    m = _HOST_AND_PATH.search(url)
    return (m[1].translate(_TO_LOWER), m[2]) if m else ("", "")


def longest_rule(host: str, path: str, by_host: dict) -> tuple[str | None, str | None]:
    """The longest rule (host and path together) that fits, by looking up the host and its parents."""
    best: tuple = (-1, None, None)
    suffix = host
    while suffix:
        for rule_path, verdict in by_host.get(suffix, ()):
            if path.startswith(rule_path):
                best = max(best, (len(suffix) + len(rule_path), suffix + rule_path, verdict))
        _, _, suffix = suffix.partition(".")
    return best[1], best[2]


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    min_soft: int = MIN_SOFT,
) -> DataFrame:
    """One verdict per row of ``pages`` (page_id, url); map-only, no shuffle."""
    strict, soft = tuple(strict), tuple(soft)
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        by_host.setdefault(host, []).append((path, verdict))

    def judge(batch) -> dict:
        out: dict[str, list] = {k: [] for k in ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")}
        for url in batch.column("url").to_pylist():
            url = url or ""
            host, path = split_url(url)
            rule, verdict = longest_rule(host, path, by_host)
            n_strict, n_soft = term_hits(url, strict, soft)
            bad = n_strict >= 1 or n_soft >= min_soft
            for k, v in zip(out, (host, path, rule, verdict or ("block" if bad else "allow"), n_strict, n_soft), strict=True):
                out[k].append(v)
        return {"page_id": batch.column("page_id")} | out

    return map_batches(pages.select("page_id", "url"), judge, SCHEMA)


def _sql_list(terms: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


def _sql_hits(terms: Sequence[str]) -> str:
    return f"""len(list_filter({_sql_list(terms)}, lambda t: regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)')))"""


def oracle() -> str:
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
        for h, p, _ in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    )
    verdicts = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE {fits} END AS rule,
         CAST({_sql_hits(STRICT_TERMS)} AS BIGINT) AS strict_hits, CAST({_sql_hits(SOFT_TERMS)} AS BIGINT) AS soft_hits
  FROM parts)
SELECT page_id, host, path, rule,
       CASE {verdicts} WHEN strict_hits >= 1 OR soft_hits >= {MIN_SOFT} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM ruled"""
