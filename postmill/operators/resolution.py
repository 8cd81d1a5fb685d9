"""Entity resolution: verified exact names first, then patterns in order of priority, then fallbacks.

Only the distinct texts are resolved and joined back, since the same text comes many times. Catalogs are small
dimensions, and their patterns are tried in one expression with the first hit winning, so nothing is multiplied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Pattern:
    """One catalog pattern and what it stands for; a lower section comes first, then the longer pattern."""

    pattern: str
    attributes: Mapping[str, str] = field(default_factory=dict)
    section: int = 0


def by_priority(patterns: Sequence[Pattern]) -> list[Pattern]:
    """Section, then length of the pattern, longest first; ties keep catalog order."""
    return sorted(patterns, key=lambda p: (p.section, -len(p.pattern)))


def first_pattern(text: Column, patterns: Sequence[Pattern], names: Sequence[str]) -> Column:
    """A struct of the attributes of the first pattern that fits, with the pattern; null if none does."""
    out = F.lit(None)
    for p in reversed(by_priority(patterns)):
        hit = F.struct(*[F.lit(p.attributes.get(n)).cast("string").alias(n) for n in names], F.lit(p.pattern).alias("pattern"))
        out = F.when(text.rlike("(?i)" + p.pattern), hit).otherwise(out)
    return out


def resolved(rows: DataFrame, text: str, lookup: DataFrame, patterns: Sequence[Pattern], names: Sequence[str]) -> DataFrame:
    """Add match (struct of names and pattern) and match_type: exact by lower-case lookup (key, names), else regex, else null.

    The distinct texts meet the lookup by hash join, whose side is broadcast only within Spark's size check.
    """
    distinct = rows.select(F.lower(text).alias("_key")).where("_key IS NOT NULL").distinct()
    exact = lookup.select(F.col("key").alias("_key"), F.struct(*names, F.lit(None).cast("string").alias("pattern")).alias("_exact"))
    found = distinct.join(exact, "_key", "left").withColumn("_regex", first_pattern(F.col("_key"), patterns, names) if patterns else F.col("_exact"))
    found = found.select("_key", F.coalesce("_exact", "_regex").alias("match"), F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_regex").isNotNull(), "regex").alias("match_type"))
    return rows.withColumn("_key", F.lower(text)).join(found, "_key", "left").drop("_key")


# Words of each fibre, and of mixtures.
_BADGER, _BOAR, _HORSE, _SYNTHETIC = r"badg(?:er)?", r"(?:boar|shoat)", r"horse(?:hair)?", r"syn(?:th(?:etic)?)?"
SYNTHETIC_WORDS = ("synt", "synbad", "acrylic", "nylon", "fibre", "faux (?:horse|boar|badger)", "timber", "tuxedo", "cashmere", "plissoft", "trafalgar", "quartermoon", "mother ?(?:lode|load)", "g5[abc]", r"\b[gt][0-9]\b")
BADGER_WORDS = ("badger", "silvertip", "(?:2|3|two|three)[ -]*band", "high.?mo(?:untain)?", "gelo", "finest", "ultralux", "[fm]anchuria")


def _mixture(a: str, b: str) -> str:
    joint = "[ ]*[/+&-][ ]*"
    return f"{a}{joint}{b}|{b}{joint}{a}"


#: Fibre by the first expression that fits; mixtures come before pure ones.
FIBERS = (
    ("Mixed Badger/Synthetic", _mixture(_BADGER, _SYNTHETIC)),
    ("Mixed Badger/Horse", _mixture(_BADGER, _HORSE)),
    ("Mixed Boar/Horse", _mixture(_BOAR, _HORSE)),
    ("Mixed Badger/Boar", f"{_mixture(_BADGER, _BOAR)}|hybrid|mixed|fusion"),
    ("Synthetic", "|".join(SYNTHETIC_WORDS)),
    ("Badger", "|".join(BADGER_WORDS)),
    ("Boar", r"\b(?:boar|shoat)\b"),
    ("Horse", r"\bhorse(?:hair)?\b"),
)


def fiber(text: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(FIBERS):
        out = F.when(text.rlike("(?i)" + pattern), F.lit(name)).otherwise(out)
    return out


def knot_size(text: Column) -> Column:
    """Millimetres: the first of NNxMM and NNmm, else a bare number from 20 to 35."""
    part = lambda p: F.expr("try_cast(null as double)") if p is None else F.nullif(F.regexp_extract(text, p, 1), F.lit("")).try_cast("double")
    bare = part(r"(?:^|[^0-9.])([0-9]{2}(?:\.[0-9]+)?)(?:[^0-9.x]|$)")
    return F.coalesce(part(r"(?i)([0-9]{2}(?:\.[0-9]+)?)[ ]*(?:mm)?[ ]*[x×][ ]*[0-9]{2}"), part(r"(?i)([0-9]{2}(?:\.[0-9]+)?)[ ]*mm"), F.when(bare.between(20, 35), bare))


def component_score(brand: Column, model: Column, fiber_: Column, size: Column, priority: Column) -> Column:
    """5 each for brand, model and fibre, 2 for a size, and 2 or 1 for a known or other section."""
    one = lambda c, n: F.when(c.isNotNull() & (c.cast("string") != ""), n).otherwise(0)
    return one(brand, 5) + one(model, 5) + one(fiber_, 5) + one(size, 2) + F.when(priority == 1, 2).when(priority == 2, 1).otherwise(0)
