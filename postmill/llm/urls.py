"""URL filter: host/path rules first, then pattern rules found through their rarest literal token.

Each pattern rule names the literal tokens that any URL it fits must hold, or several such sets, one of which it must.
The corpus says how often each of these tokens occurs; a rule is filed under the rarest one of each set. A URL's own tokens then fetch the few rules that may fit, and only
their regular expressions run. Nothing is shuffled but one count per rule token.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits a host with all its subdomains, where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL. Each of `ways` names whole tokens that a match of that way holds; every match is of some way."""

    name: str
    pattern: str
    ways: tuple[tuple[str, ...], ...]


# The host/path rules of the query's contract.
HOST_RULES = (
    HostRule("com", "/", "allow"),
    HostRule("example.com", "/en/", "block"),
    HostRule("www.example.com", "/en/", "allow"),
    HostRule("net", "/es/", "block"),
    HostRule("net", "/fr/", "block"),
)
# The default pattern rules, each of which blocks.
PATTERN_RULES = (
    PatternRule("tracker", r"://([a-z0-9-]+[.])*ads-track[.]", (("ads", "track"),)),
    PatternRule("casino", r"://([a-z0-9-]+[.])*casino(-[a-z0-9]+)*[.]", (("casino",),)),
    PatternRule("bets", r"://([a-z0-9-]+[.])*(free-)?bets[.]", (("bets",),)),
    PatternRule("pills", r"://([a-z0-9-]+[.])*cheap-pills[.]", (("cheap", "pills"),)),
    PatternRule("executable", r"/[^?#]*[.](exe|msi|apk)([?#]|$)", (("exe",), ("msi",), ("apk",))),
    PatternRule("feed-print", r"/en/[0-9]+[.]html[?]print=1(&|$)", (("print", "html"),)),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct lower-case alphanumeric runs of a URL."""
    return F.array_distinct(F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def token_counts(pages: DataFrame, url: str, rules: Sequence[PatternRule]) -> dict[str, int]:
    """In how many URLs each rule token occurs. At most one row per rule token comes to the driver."""
    wanted = sorted({t for r in rules for way in r.ways for t in way})
    if not wanted:
        return {}
    known = F.array(*[F.lit(t) for t in wanted])
    found = pages.select(F.explode(F.array_intersect(url_tokens(F.col(url)), known)).alias("token")).groupBy("token").count()
    return dict.fromkeys(wanted, 0) | {row["token"]: row["count"] for row in found.collect()}


def rare_token_index(rules: Sequence[PatternRule], counts: dict[str, int]) -> dict[str, list[PatternRule]]:
    """Each rule under the rarest token of each of its ways, ties to the first by name."""
    index: dict[str, list[PatternRule]] = defaultdict(list)
    for rule in rules:
        if not rule.ways or not all(rule.ways):
            raise ValueError(f"rule {rule.name} has a way without a literal token")
        for token in sorted({min(way, key=lambda t: (counts.get(t, 0), t)) for way in rule.ways}):
            index[token].append(rule)
    return dict(index)


def fitting_pattern(index: dict[str, list[PatternRule]], rules: Sequence[PatternRule]):
    """A pandas UDF: name of the first rule in rule order whose expression fits, or null."""
    order = {r.name: i for i, r in enumerate(rules)}
    filed = {t: [(order[r.name], r.name, r.pattern) for r in found] for t, found in index.items()}

    def fit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compiled = {t: [(i, name, re.compile(p)) for i, name, p in found] for t, found in filed.items()}
        to_lower = str.maketrans(UPPER, LOWER)
        split = re.compile("[^a-z0-9]+").split

        def first(url: str | None) -> str | None:
            if url is None:
                return None
            url = url.translate(to_lower)
            hits = [(i, name) for t in set(split(url)) for i, name, p in compiled.get(t, ()) if p.search(url)]
            return min(hits)[1] if hits else None

        for urls in batches:
            yield pd.Series([first(u) for u in urls], dtype="object")

    return F.pandas_udf(fit, "string")


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    host_rules: Sequence[HostRule] = HOST_RULES,
    pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
) -> DataFrame:
    """Add host, path, rule, pattern and verdict to every row.

    The longest host/path rule that fits decides; where none fits, the first fitting pattern rule blocks, and what no
    rule fits is allowed. A null URL, and one without "://", has an empty host and path; a null one fits nothing and is
    allowed. Columns of the input that have one of the new names are replaced; repeated rows stay repeated.
    """
    index = rare_token_index(pattern_rules, token_counts(pages, url, pattern_rules))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(host_rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    pattern = fitting_pattern(index, pattern_rules)(F.col(url))
    return pages.withColumns({"host": host, "path": path, "rule": rule, "pattern": pattern}).withColumn(
        "verdict", F.coalesce(verdict.cast("string"), F.when(F.col("pattern").isNotNull(), "block").otherwise("allow"))
    )
