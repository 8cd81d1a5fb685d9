"""Attributes derived from what was matched and from what is left of the text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_USES = 899


def remainder(original: Column, normalized: Column) -> Column:
    """The original without the first occurrence, in any case, of the normalised text."""
    at = F.position(F.lower(normalized), F.lower(original))
    return F.trim(F.when((at > 0) & (F.length(normalized) > 0), F.concat(F.substring(original, F.lit(1), at - 1), F.substring(original, at + F.length(normalized), F.length(original)))).otherwise(original))


def use_count(rest: Column) -> Column:
    """Uses named in a remainder: new or fresh is 1, else the first of (3), 3x, x3, 3rd, #3; more than MOST_USES is null."""
    part = lambda p: F.nullif(F.regexp_extract(F.lower(rest), p, 1), F.lit("")).try_cast("int")
    number = F.coalesce(part(r"[(\[{][ ]*x?([0-9]+)x?[ ]*(?:uses?)?[ ]*[)\]}]?"), part(r"\b([0-9]+)[ ]*x\b"), part(r"\bx[ ]*([0-9]+)\b"), part(r"\b([0-9]+)(?:st|nd|rd|th)\b"), part(r"#([0-9]+)"))
    return F.when(F.lower(rest).rlike(r"\b(new|fresh)\b"), 1).when(number <= MOST_USES, number)


def sample(text: Column) -> Column:
    """Struct of type (sample or tester), number and total of remarks like "(sample 2 of 5)"; null without one."""
    t = F.lower(text)
    kind = F.when(t.rlike(r"\b(sample|samp|smush)\b"), "sample").when(t.rlike(r"\btester\b"), "tester")
    part = lambda g: F.nullif(F.regexp_extract(t, r"([0-9]+)[ ]*(?:of|/)[ ]*([0-9]+)", g), F.lit("")).try_cast("int")
    return F.when(kind.isNotNull(), F.struct(kind.alias("type"), part(1).alias("number"), part(2).alias("total")))


def razor_format(razor: Column, blade: Column) -> Column:
    """The format of a post from those of razor and blade; the empty text counts as none."""
    r, b = F.nullif(F.trim(razor), F.lit("")), F.nullif(F.trim(blade), F.lit(""))
    return (
        F.when(r == "Cartridge/Disposable", r)
        .when(F.lower(r).startswith("shavette (") | r.startswith("Half DE"), r)
        .when(F.lower(r) == "shavette", F.concat(F.lit("Shavette ("), F.when(b == "DE", "Half DE").otherwise(F.coalesce(b, F.lit("Unspecified"))), F.lit(")")))
        .otherwise(F.coalesce(b, r, F.lit("DE")))
    )


def compatibility(razor: Column, blade: Column) -> Column:
    """ok, warning or error for a razor and a blade format."""
    r, b = F.nullif(F.trim(razor), F.lit("")), F.nullif(F.trim(blade), F.lit(""))
    known = r.isin("DE", "Half DE", "AC", "GEM", "Injector", "Hair Shaper")
    fits = F.when(r == "DE", b.isin("DE", "Half DE")).when(r == "Half DE", b == "DE").otherwise(r == b)
    return (
        F.when(r.isNull() | F.lower(r).startswith("shavette"), "ok")
        .when(r.isin("Cartridge/Disposable", "Straight"), F.when(b.isNull(), "ok").otherwise("warning"))
        .when(b.isNull(), "warning")
        .when(known & ~fits, "error")
        .otherwise("ok")
    )


# Quarters of a hollow by number, kinds of hollows and other grinds, and points.
QUARTERS = ("quarter", "half", "three quarter", "full")
HOLLOWS = ("extra", "full", "pretty", "three quarter", "half", "quarter")
POINTS, PLAIN_POINTS = ("round", "square", "spike", "french", "spanish", "spear"), ("round", "square", "spike")


def _title(name: str) -> str:
    return " ".join(w.capitalize() for w in name.split())


#: Grinds and points by the first expression that fits a text in lower case: the more special ones come first.
GRIND_FORMS = (
    *((rf"\b{n}/4[ ]*hollow\b", _title(f"{q} hollow")) for n, q in enumerate(QUARTERS, 1)),
    *((rf"\b{h.replace(' ', '[ ]*')}[ ]*hollow\b", _title(f"{h} hollow")) for h in HOLLOWS),
    (r"\bhollow\b", "Hollow"), (r"\bnear[ ]*wedge\b", "Near Wedge"), (r"\bwedge\b", "Wedge"), (r"\bframeback\b", "Frameback"),
)
POINT_FORMS = (*((rf"\b{p}[ ]*(?:point|tip)\b", _title(p)) for p in POINTS), (r"\bbarber.?s[ ]*notch\b", "Barber's Notch"), *((rf"\b{p}\b", _title(p)) for p in PLAIN_POINTS))


def _first_form(text: Column, forms: tuple[tuple[str, str], ...]) -> Column:
    t = F.lower(text)
    out = F.lit(None).cast("string")
    for pattern, name in reversed(forms):
        out = F.when(t.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def straight_razor(text: Column) -> Column:
    """Struct of width in eighths, grind, point and steel; steel is carbon unless stainless is named."""
    width = F.nullif(F.regexp_extract(text, r"\b([0-9]{1,2}/(?:8|16))\b", 1), F.lit(""))
    steel = F.when(F.lower(text).contains("stainless"), "Stainless").otherwise("Carbon")
    return F.struct(width.alias("width"), _first_form(text, GRIND_FORMS).alias("grind"), _first_form(text, POINT_FORMS).alias("point"), steel.alias("steel"))


def plates(text: Column) -> Column:
    """Struct of gap, plate level, plate kind and tip colour as far as a text names them."""
    t = F.lower(text)
    gap = F.nullif(F.regexp_extract(t, r"(?:^|[^0-9])0?(\.68|\.76|\.84|1\.05)(?:[^0-9]|$)", 1), F.lit(""))
    level = F.upper(F.nullif(F.regexp_extract(t, r"\b(aa|[a-g])[ -]?plate", 1), F.lit("")))
    kind = F.when(t.rlike(r"\b(oc|open[ -]?comb)\b"), "OC").when(t.contains("lite"), "Lite").otherwise("Standard")
    tip = F.initcap(F.nullif(F.regexp_extract(t, r"\b(red|blue|black)[ -]?tip", 1), F.lit("")))
    return F.struct(gap.alias("gap"), level.alias("level"), kind.alias("kind"), tip.alias("tip"))


def preferred(user: Column, catalog: Column) -> Column:
    """Struct of the value, the user's before the catalog's, and where it comes from."""
    u, c = F.nullif(user, F.lit("")), F.nullif(catalog, F.lit(""))
    source = F.concat_ws(" + ", F.when(u.isNotNull(), "user_comment"), F.when(c.isNotNull(), "catalog_data"))
    return F.struct(F.coalesce(u, c).alias("value"), F.nullif(source, F.lit("")).alias("source"))


def mismatch_reasons(pairs: Mapping[str, tuple[Column, Column]], tolerance: float = 0.1) -> Column:
    """Names of the attributes that two sources give unlike values; numbers may differ by the tolerance."""

    def differ(a: Column, b: Column) -> Column:
        x, y = a.try_cast("double"), b.try_cast("double")
        return F.when(x.isNotNull() & y.isNotNull(), F.abs(x - y) > tolerance).otherwise(F.lower(a) != F.lower(b))

    return F.array_compact(F.array(*[F.when(differ(a.cast("string"), b.cast("string")), F.lit(name)) for name, (a, b) in pairs.items()]))


def intent(text: Column, handle: Column, knot: Column) -> Column:
    """Which of two parts a text names first: handle_primary or knot_primary; null where one is missing."""
    h, k = F.position(F.lower(handle), F.lower(text)), F.position(F.lower(knot), F.lower(text))
    return F.when((h > 0) & (k > 0), F.when(h <= k, "handle_primary").otherwise("knot_primary"))


def with_enrichment_overrides(rows: DataFrame, overrides: DataFrame, key: str, catalog: str) -> DataFrame:
    """Values by (month, id, key, value, use_catalog) rows; use_catalog takes the catalog's column."""
    mine = overrides.where(F.col("key") == key).select("month", "id", F.col("value").alias("_value"), F.col("use_catalog").alias("_catalog"))
    joined = rows.join(mine, ["month", "id"], "left")
    return joined.withColumn(key, F.when(F.col("_catalog"), F.col(catalog)).otherwise(F.coalesce(F.col("_value"), F.col(key)))).drop("_value", "_catalog")
