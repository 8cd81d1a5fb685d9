"""Mixing sources to target weights by pivotal dependent rounding; DataFrame functions only.

Every document of a source gets the same expected number of copies, its source's target over its source's size. The
whole part is certain; the fraction is rounded by pivoting: two fractions meet, chance moves mass from one to the other
until one of them is 0 or 1, and the other goes on. Within a block that is a fold over the documents in order of size;
what is left of each block meets the leftovers of its neighbours at the next level of a tree, until each source has one
leftover, which chance decides. Since mass only moves between documents of like size, the words taken stay near target.
Blocks are cut by source, size class and a hash, so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import cut, word_count

#: Shares of the sources in code point order, null last, again and again.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words to take, over all words; and the most that a source or a document may give, over its size.
SHARE, MOST = 1.5, 2.0
#: Leftovers of about so many blocks meet in one block of the next level.
FAN_IN = 32
#: Size classes of an octave; neighbouring classes become one from level to level.
CLASSES = 5


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """From (source, source_size), one row per source, the targets in words.

    Sources fill up by weight to one common level, each stopping at `most` times its size. In order of the level at
    which a source stops, those that stop are the ones below the level that the rest would reach without them.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumn("_stop", F.col("cap") / F.col("weight"))
    before = Window.orderBy("_stop", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    words, mass = share * F.sum("source_size").over(everything), F.sum("weight").over(everything)
    rows = rows.withColumns({
        "_words": words,
        "_mass": mass,
        "_level": (words - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (mass - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    }).withColumn("_stops", F.col("_stop") < F.col("_level"))
    gone = lambda c: F.sum(F.when(F.col("_stops"), F.col(c)).otherwise(0.0)).over(everything)
    rows = rows.withColumns({"_left": F.col("_words") - gone("cap"), "_over": F.col("_mass") - gone("weight")})
    target = F.when(F.col("_stops"), F.col("cap")).otherwise(F.col("_left") * F.col("weight") / F.nullif(F.col("_over"), F.lit(0.0)))
    return rows.select("source", "source_size", target.alias("target"))


def chance(*keys: Column) -> Column:
    """A number from 0 up to 1 that depends on the keys alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 53)) / float(1 << 53)


def pivoted(units: Column, seed: int) -> Column:
    """Fold units (size, key, p, ...), each of some size, by pivoting.

    Gives a struct of `done`, twice the number of each decided unit plus its decision, and the number and fraction of
    the unit that is left.
    """

    def meet(left: Column, index: Column, unit: Column) -> Column:
        a, b, size = left["p"], unit["p"], F.get(units, left["at"])["size"]
        give, take = F.least(a * size, (1.0 - b) * unit["size"]), F.least((1.0 - a) * size, b * unit["size"])
        gives = chance(F.lit(seed), F.get(units, left["at"])["key"], unit["key"]) * (give + take) < take
        # the one that is left gives until it has 0 or the unit has 1, or takes until it has 1 or the unit has 0
        left_ends = F.when(gives, a * size <= (1.0 - b) * unit["size"]).otherwise((1.0 - a) * size <= b * unit["size"])
        decided = F.when(left_ends, left["at"] * 2 + F.when(gives, 0).otherwise(1)).otherwise(index * 2 + F.when(gives, 1).otherwise(0))
        moved = F.when(gives, give).otherwise(-take)
        p = F.when(left_ends, b + moved / unit["size"]).otherwise(a - moved / size)
        return F.struct(
            F.array_append(left["done"], decided).alias("done"),
            F.when(left_ends, index).otherwise(left["at"]).alias("at"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)).alias("p"),
        )

    start = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("at"), F.get(units, F.lit(0))["p"].alias("p"))
    numbered = F.sequence(F.lit(1), F.size(units) - 1)
    return F.when(F.size(units) < 2, start).otherwise(F.aggregate(numbered, start, lambda left, i: meet(left, i, F.get(units, i))))


def round_fractions(units: DataFrame, rows: int, widest: int, seed: int = 17) -> DataFrame:
    """Round column p of units (source, class, key, size, p and others), keeping each source's expected words: adds x, 0 or 1.

    A block holds about FAN_IN ** 2 units at most, even where one class of one source has all.

    rows is the number of units and widest the largest class; they set how many levels the tree has.
    """
    levels = max(1, math.ceil(math.log(max(rows, 2), FAN_IN)) - 1)
    merge = math.ceil((widest + 1) ** (1 / max(1, levels - 1)))
    plain = [c for c in units.columns if c not in ("source", "class", "size", "key", "p")]
    packed = F.struct("size", "key", "p", "class", *plain)
    done = None
    for level in range(1, levels + 1):
        last = level == levels
        blocks = 1 if last else math.ceil(rows / FAN_IN ** (level + 1))
        near = F.lit(0) if last else F.floor(F.col("class") / merge ** (level - 1))
        block = F.pmod(F.xxhash64(F.lit(seed + level), "key"), F.lit(blocks))
        folded = units.groupBy("source", near.alias("_near"), block.alias("_block")).agg(F.sort_array(F.collect_list(packed), asc=False).alias("_units"))
        folded = cut(folded.select("source", "_units", pivoted(F.col("_units"), seed).alias("_fold")))
        decided = folded.select("source", "_units", F.explode("_fold.done").alias("_d"))
        decided = decided.select("source", F.get("_units", F.floor(F.col("_d") / 2).cast("int")).alias("_u"), (F.col("_d") % 2).alias("x")).select("source", "_u.*", "x")
        left = folded.select("source", F.get("_units", F.col("_fold.at")).alias("_u"), F.col("_fold.p").alias("_p"))
        units = left.select("source", "_u.*", "_p").withColumn("p", F.col("_p")).drop("_p")
        done = decided if done is None else done.unionByName(decided)
    final = units.withColumn("x", (chance(F.lit(seed), F.lit("last"), F.col("key")) < F.col("p")).cast("int"))
    return done.unionByName(final)


def mix(docs: DataFrame, text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """How often the mix takes each document: doc_id, key (a hash of id and text), source, size, source_size, target, copies, repeats.

    Null texts count as empty and null sources as one source. Rows alike in id, text and source are one unit that is
    taken alike; `repeats` says how many they are, and targets count them all. An empty table gives no rows.
    """
    sized = docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), "source", word_count(F.col(text)).alias("size"))
    units = cut(sized.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("repeats")))
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    units = units.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    expected = F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0))
    units = units.withColumn("_near", F.when(F.abs(expected - F.round(expected)) < 1e-12, F.round(expected)).otherwise(expected))
    units = units.withColumns({"whole": F.floor("_near").cast("int"), "p": F.col("_near") - F.floor("_near")}).drop("_near")
    units = units.withColumn("class", F.floor(F.log2(F.col("size") + 1) * CLASSES).cast("int"))
    meets = (F.col("p") > 0) & (F.col("size") > 0)
    count = units.where(meets).agg(F.count("*").alias("n"), F.max("class").alias("c")).first()
    alone = units.where(~meets).withColumn("x", (chance(F.lit("empty"), F.col("key")) < F.col("p")).cast("int"))
    taken = round_fractions(units.where(meets), count["n"], count["c"] or 0).unionByName(alone)
    return taken.select("doc_id", "key", "source", "size", "source_size", "target", (F.col("whole") + F.col("x")).alias("copies"), "repeats")


def mixed_documents(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """The documents as often as the mix takes them; rows taken no time go. Columns stay as they are."""
    # names that no input column is likely to have
    taken = mix(docs, text, **how).where("copies > 0").select(*[F.col(c).alias(f"__mix_{c}") for c in ("doc_id", "key", "source", "copies")])
    keyed = docs.withColumn("__mix_hash", F.xxhash64("doc_id", text))
    same = (F.col("__mix_hash") == F.col("__mix_key")) & docs["doc_id"].eqNullSafe(F.col("__mix_doc_id")) & docs["source"].eqNullSafe(F.col("__mix_source"))
    copies = F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))
    return keyed.join(taken, same).withColumn("__mix_n", copies).select(*docs.columns)
