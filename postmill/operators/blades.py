"""Blades under the context of their razor: a staged search as one rank over the candidates of the catalog index.

Each step of the search looks at one format of blade, first at verified names, then at patterns. The steps of a context
are an array of formats, so a candidate's step is its format's place there; the least rank over all candidates is what
the search would have stopped at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats in order of how common they are, what goes with which, and what a razor's format asks for.
COMMON = ("DE", "HALF DE", "AC", "GEM", "INJECTOR", "FHS", "HAIR SHAPER", "A77", "CARTRIDGE")
SISTERS = {"DE": "HALF DE", "HALF DE": "DE", "OTHER": "FHS"}
#: Single edges that come first in a shavette, by its own format; where there is none, the order of the last.
SINGLE_EDGES = {"AC": ("AC", "GEM", "INJECTOR"), "INJECTOR": ("INJECTOR", "GEM", "AC"), "HAIR SHAPER": ("HAIR SHAPER", "INJECTOR", "GEM", "AC"), "": ("INJECTOR", "AC", "GEM")}
SHAVETTE_LAST = ("HAIR SHAPER", "FHS", "A77", "HALF DE", "DE")
#: Formats of razors that do not name their blade, and those that hold any blade or none.
ASKS = {"DISPOSABLE": "CARTRIDGE", "UNSPECIFIED": "DE", "PREDEFINED": "DE", "HALF DE (MULTI-BLADE)": "HALF DE"}
GENERIC, BLADELESS, OWN_BLADE = ("SHAVETTE", "OTHER"), "STRAIGHT", ("CARTRIDGE", "CARTRIDGE/DISPOSABLE")
SHAVETTE = r"^SHAVETTE\s*\((.*)\)$"


def target(razor: Column) -> Column:
    """The format of blade that a razor's format asks for, in capitals; DE where nothing is known."""
    name = F.upper(F.trim(F.coalesce(razor, F.lit(""))))
    name = F.when(name.rlike(SHAVETTE), F.regexp_extract(name, SHAVETTE, 1)).otherwise(name)
    out = F.when(name == "", "DE")
    for asked, blade in ASKS.items():
        out = out.when(name == asked, blade)
    return out.otherwise(name)


def steps(razor: Column) -> Column:
    """Formats in the order in which they are searched; formats that are not named come after these. Null: no search; empty: all at once."""
    name, asked = F.upper(F.trim(F.coalesce(razor, F.lit("")))), target(razor)
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    sister, single = texts(()), texts(SINGLE_EDGES[""])
    for one, other in SISTERS.items():
        sister = F.when(asked == one, texts((other,))).otherwise(sister)
    for one, others in SINGLE_EDGES.items():
        single = F.when(asked == one, texts(others)).otherwise(single) if one else single
    fallback = F.when(name.startswith("SHAVETTE"), F.concat(single, texts(SHAVETTE_LAST))).otherwise(texts(COMMON))
    order = F.array_distinct(F.concat(F.array(asked), sister, fallback))
    return F.when(asked == BLADELESS, F.lit(None)).when(name.isin(*GENERIC), texts(())).otherwise(order)


def route(razor: Column) -> Column:
    """What becomes of a razor's blade: `auto_cartridge` where the razor brings its own, `irrelevant_razor_format` where it takes none, else `match`."""
    asked = target(razor)
    return F.when(asked.isin(*OWN_BLADE), "auto_cartridge").when(asked == BLADELESS, "irrelevant_razor_format").otherwise("match")


def best_blades(rows: DataFrame, text: str, razor: str, verified: DataFrame, candidates: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add match (struct of names, format and pattern), match_type (exact or regex) and step to rows, by text and razor.

    verified: (key, format, names), key in lower case; candidates: as catalog.candidates gives them, with format among
    the attributes. Within a step verified names come first, then patterns by section, length and order. A razor that
    takes any blade is searched by patterns alone, over all formats at once; a straight razor has none.
    """
    distinct = rows.select(F.col(text).alias("_t"), F.col(razor).alias("_r")).distinct().withColumn("_steps", steps(F.col("_r"))).where("_steps IS NOT NULL AND _t IS NOT NULL")
    fields = lambda pattern: F.struct(*[F.col(n) for n in names], F.col("format"), pattern.alias("pattern"))
    exact = verified.select(F.col("key").alias("_key"), F.upper("format").alias("_f"), F.lit(0).alias("_kind"), F.lit(0).alias("section"), F.lit(0).alias("less"), F.lit(0).alias("ord"), fields(F.lit(None).cast("string")).alias("_m"))
    fits = candidates.select(F.col(text).alias("_key"), F.upper("format").alias("_f"), F.lit(1).alias("_kind"), "section", "less", "ord", fields(F.col("pattern")).alias("_m"))
    met = distinct.withColumn("_key", F.lower("_t")).join(exact.unionByName(fits.withColumn("_key", F.lower("_key"))), "_key").where((F.size("_steps") > 0) | (F.col("_kind") == 1))
    place = F.array_position("_steps", F.col("_f"))
    step = F.when(F.size("_steps") == 0, 0).when(place > 0, place).otherwise(F.size("_steps") + 1).cast("int")
    best = met.groupBy("_t", "_r").agg(F.min(F.struct(step.alias("step"), "_kind", "section", "less", "ord", "_m")).alias("_b"))
    found = best.select("_t", "_r", F.col("_b._m").alias("match"), F.when(F.col("_b._kind") == 0, "exact").otherwise("regex").alias("match_type"), "_b.step")
    return rows.join(found, F.col(text).eqNullSafe(F.col("_t")) & F.col(razor).eqNullSafe(F.col("_r")), "left").drop("_t", "_r")
