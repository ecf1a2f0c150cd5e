"""URL filter: host and path rules first, then a weighted vocabulary counted by one Aho-Corasick automaton.

The host and the path are scanned once, lower-cased, for all terms together. A hit counts only where it is bounded: neither
the character before nor the one after it is a letter a-z, so that `essex` holds no `sex` while `casino777` and `win-casino`
hold `casino`. A strict term rejects alone, soft terms when several different ones occur; in weights, a strict term weighs the
whole threshold and a soft term one, and the weights of the distinct terms of a URL are added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 2  # weight that rejects: one strict term, or this many different soft ones
STRICT = ("adult", "bets", "casino", "escort", "gambling", "hentai", "jackpot", "malware", "pharmacy", "phishing", "pills", "poker", "porn", "porno", "roulette", "sex", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "banner", "bet", "bonus", "buy", "cheap", "click", "coupon", "crack", "dating", "deal", "discount", "earn", "farm", "free", "loan", "lottery", "money", "naked", "nude", "promo", "prize", "slots", "tits", "track", "win", "winner")
VOCABULARY = {t: THRESHOLD for t in STRICT} | {t: 1 for t in SOFT}
_OUT = "page_id long, host string, path string, rule string, strict array<string>, soft array<string>, weight long, verdict string"
_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
    ("strict", pa.list_(pa.string())), ("soft", pa.list_(pa.string())), ("weight", pa.int64()), ("verdict", pa.string()),
])
_LOWER = {c: c + 32 for c in range(65, 91)}
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: str, path: str) -> bool:
        return (host == self.host or host.endswith(f".{self.host}")) and path.startswith(self.path)


#: The rules of the query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or a text without `://`."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    whole = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    slash = rest.find("/", 0, whole)
    return rest[: slash if slash >= 0 else whole].translate(_LOWER), rest[slash:whole] if slash >= 0 else ""


def build(vocabulary: Mapping[str, int]) -> ahocorasick.Automaton | None:
    """The automaton of the terms, lower-cased; a match gives the term. None if there is none."""
    automaton = ahocorasick.Automaton()
    for term in vocabulary:
        if term:
            automaton.add_word(term.translate(_LOWER), term)
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def terms_in(automaton: ahocorasick.Automaton | None, text: str) -> set[str]:
    """The terms that occur in the text with a bound on both sides; every occurrence is looked at."""
    if automaton is None or not text:
        return set()
    low = text.translate(_LOWER)
    found: set[str] = set()
    for end, term in automaton.iter(low):
        before = end - len(term)
        if (before < 0 or low[before] not in _LETTERS) and (end + 1 == len(low) or low[end + 1] not in _LETTERS):
            found.add(term)
    return found


def rule_for(rules: Sequence[Rule], host: str, path: str) -> Rule | None:
    """The longest rule that fits; of equally long ones that with the longer host."""
    return max((r for r in rules if r.fits(host, path)), key=lambda r: (len(r.name), len(r.host)), default=None)


def judge(
    pages: DataFrame, vocabulary: Mapping[str, int] = VOCABULARY, rules: Sequence[Rule] = RULES, threshold: int = THRESHOLD,
) -> DataFrame:
    """One row a page: host, path, the rule that decides (or null), strict and soft terms found, their weight and the verdict.

    A term is strict if it weighs `threshold` or more. A rule overrides the terms, which are reported all the same. A null
    URL, an empty one and one without `://` have an empty host and path, no rule and no terms, and are allowed. Rows are judged
    each for itself, so repeated page ids and null ones stay as they are. Columns but page_id and url are not read. Vocabulary
    and rules go to the tasks with the function; their size does not depend on the pages.
    """
    weights = {t.translate(_LOWER): w for t, w in vocabulary.items()}
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build(weights)
        for batch in batches:
            rows = []
            for page, url in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist()):
                host, path = parts(url)
                rule = rule_for(rules, host, path)
                found = terms_in(automaton, host + path)
                weight = sum(weights[t] for t in found)
                rows.append((
                    page, host, path, rule and rule.name, sorted(t for t in found if weights[t] >= threshold),
                    sorted(t for t in found if weights[t] < threshold), weight,
                    rule.verdict if rule else "block" if weight >= threshold else "allow",
                ))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * len(_SCHEMA), _SCHEMA)], schema=_SCHEMA)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).mapInArrow(run, _OUT)
