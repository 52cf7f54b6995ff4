"""Block and allow rules for hosts and paths, and a weighted vocabulary for the URLs that no rule fits.

The vocabulary has strict and soft terms. An Aho-Corasick automaton finds all terms of a URL in one pass; an
occurrence counts if no letter or digit stands beside it. One strict term or several distinct soft terms reject.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm.batches import per_text


# Rules as (kind, host, path), in order of the contract.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

# The vocabulary; own choice.
STRICT = (
    "casino casinos porn porno pornography xxx hentai nsfw milf escorts viagra cialis phishing malware ransomware "
    "warez keygen torrents spam spammer sexcam sexcams camgirls jackpot gambling"
).split()
SOFT = (
    "adult adults ad ads advert adverts affiliate bet bets betting bingo bonus cash cheap click clicks coupon coupons "
    "crack cracked credit dating deal deals diet discount earn farm fast free girls hot live loan loans lottery lucky "
    "money nude nudes offer offers payday pharma pharmacy pill pills poker popup prize prizes promo sale sex sexy slots "
    "strip teen track tracker tracking weight win winner winners x"
).split()


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_for(host: F.Column, path: F.Column, rules: Sequence[tuple[str, str, str]]) -> tuple[F.Column, F.Column]:
    """Text and kind of the longest rule that fits; of equal rules the first. Null if none fits."""
    text, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, h, p in sorted(reversed(list(rules)), key=lambda r: len(r[1]) + len(r[2])):  # the last that fits stays
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, kind = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(k)).otherwise(kind)
    return text, kind


def _automaton(strict: Sequence[str], soft: Sequence[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for term in soft:
        automaton.add_word(term, (term, False))
    for term in strict:
        automaton.add_word(term, (term, True))
    automaton.make_automaton()
    return automaton


def _terms(automaton: ahocorasick.Automaton, text: str) -> Iterator[tuple[str, bool]]:
    for last, (term, is_strict) in automaton.iter(text):
        first = last - len(term) + 1
        if (first == 0 or not text[first - 1].isalnum()) and (last + 1 == len(text) or not text[last + 1].isalnum()):
            yield term, is_strict


def _searched(url: str) -> str:
    """All behind the first ``://`` in lower case, query and fragment included; a URL without it, or with nothing behind it, as a whole."""
    return (url.partition("://")[2] or url).lower()


def judge(
    pages: DataFrame,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_hits: int = 2,
) -> DataFrame:
    """Per row: ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``n_strict`` and ``n_soft`` (distinct terms).

    A fitting rule decides; otherwise the vocabulary does: a strict term or ``soft_hits`` distinct soft terms block.
    Terms are looked for in lower case in all behind ``://``, query and fragment too (without it, in the whole). Null URLs have empty host and path, no terms, and are allowed. Repeated rows stay; kept columns named
    like a result give way.
    """

    def start():
        automaton = _automaton(strict, soft)

        def compute(urls: pa.Array):
            found = []
            for text in urls.to_pylist():
                found.append(set(_terms(automaton, _searched(text or ""))))
            return (
                [sum(hard for _, hard in x) for x in found],
                [sum(not hard for _, hard in x) for x in found],
                urls,
            )

        return compute

    names = ["host", "path", "rule", "verdict"]
    found = per_text(pages, url, [c for c in keep if c not in names], "n_strict long, n_soft long, _url string", start)
    host, path = host_and_path(F.col("_url"))
    found = found.withColumns({"host": host, "path": path})
    rule, kind = rule_for(F.col("host"), F.col("path"), rules)
    vocabulary = F.when((F.col("n_strict") > 0) | (F.col("n_soft") >= soft_hits), "block").otherwise("allow")
    found = found.withColumns({"rule": rule, "verdict": F.coalesce(kind, vocabulary)})
    kept = [c for c in dict.fromkeys(keep) if c not in (*names, "n_strict", "n_soft", "_url")]
    return found.select(*(q(c) for c in kept), *names, "n_strict", "n_soft")


def oracle() -> str:
    """The same in SQL; terms are found by one regular expression per term."""

    def counted(terms: Sequence[str]) -> str:
        tests = [f"regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::BIGINT" for t in terms]
        return " + ".join(tests)

    ordered = sorted(RULES, key=lambda r: -(len(r[1]) + len(r[2])))
    cases = [
        (f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN", h + p, k)
        for k, h, p in ordered
    ]
    texts = " ".join(f"{w} '{text}'" for w, text, _ in cases)
    kinds = " ".join(f"{w} '{kind}'" for w, _, kind in cases)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH cut AS (SELECT page_id, url, instr(url, '://') AS p FROM pages),
    rest AS (
      SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS r,
        lower(CASE WHEN p > 0 AND length(url) > p + 2 THEN substr(url, p + 3) ELSE coalesce(url, '') END) AS low
      FROM cut),
    parts AS (
      SELECT page_id, low, translate(regexp_extract(r, '^[^/?#]*'), '{upper}', '{lower}') AS host,
        regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    hits AS (SELECT page_id, host, path, {counted(STRICT)} AS n_strict, {counted(SOFT)} AS n_soft FROM parts)
    SELECT page_id, host, path, CASE {texts} ELSE NULL END AS rule,
      CASE {kinds} WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft
    FROM hits"""
