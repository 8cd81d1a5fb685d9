"""Fuzzy comparison. Pairs come from blocks, never from all rows; the measures that Spark lacks run in Arrow batches."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from postmill.functions.text import for_alignment, strip_last_soap
from postmill.sources.store import scratch, shared_folder


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


@F.pandas_udf(DoubleType())
def sequence_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Matching characters by longest common blocks, twice their number over both lengths."""
    for a, b in batches:
        yield pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


@F.pandas_udf(DoubleType())
def indel_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Twice the longest common subsequence over both lengths, in hundredths.

    A row of the table of lengths is one number: its zero bits are the places where the length grows, so that a character
    takes one addition. The places of a text's characters are kept for as long as the same text comes.
    """

    def ratio(x: str, y: str, places: dict[str, int]) -> float:
        if not x and not y:
            return 100.0
        full = (1 << len(x)) - 1
        row = full
        for c in y:
            here = row & places.get(c, 0)
            row = (row + here | row - here) & full
        return 200.0 * (len(x) - row.bit_count()) / (len(x) + len(y))

    last, places = None, {}
    for a, b in batches:
        out = []
        for x, y in zip(a, b):
            x, y = x or "", y or ""
            if x != last:
                last, places = x, {}
                for i, c in enumerate(x):
                    places[c] = places.get(c, 0) | 1 << i
            out.append(ratio(x, y, places))
        yield pd.Series(out, dtype="float64")


def token_sorted(text: Column) -> Column:
    """Words in alphabetical order, so that their order does not matter in a comparison."""
    return F.array_join(F.array_sort(F.split(F.lower(text), r"\s+")), " ")


def blocked_pairs(rows: DataFrame, key: str, block: Column) -> DataFrame:
    """Pairs (a, b) of rows, a before b by key, that share a block: a join on the block, which Spark can split where it is large."""
    sided = lambda s: rows.withColumn("_block", block).select("_block", *[F.col(c).alias(f"{s}_{c}") for c in rows.columns])
    return sided("a").join(sided("b"), "_block").where(F.col(f"a_{key}") < F.col(f"b_{key}")).drop("_block")


def bag(text: Column) -> Column:
    """A text's characters as a set, the second "a" being another one than the first."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    # sorted, equal characters follow each other, and a character's number is its distance from the first of its kind
    numbered = lambda all_: F.transform(all_, lambda c, i: F.concat(c, (i + 2 - F.array_position(all_, c)).cast("string")))
    return F.get(F.transform(F.array(F.array_sort(chars)), numbered), F.lit(0))


def bag_keys(texts: DataFrame, column: str, least: float, counts: DataFrame) -> DataFrame:
    """(column, _key): keys of which two texts share one wherever twice their common characters over both lengths are `least` or more.

    Such texts share at least the part least / (2 - least) of either bag, so of each bag, in one order for all texts, all
    but that many and one more are enough; the rarest ones, by counts (_key, _n), come first, so that few texts meet. No
    ratio of matching blocks or of a common subsequence exceeds that of the bags. Empty texts meet each other.
    """
    spread = texts.select(column, F.explode_outer(bag(F.col(column))).alias("_key")).join(counts, "_key", "left")
    lists = spread.groupBy(column).agg(F.array_sort(F.collect_list(F.struct("_n", "_key"))).alias("_keys"))  # as long as a text
    n = F.length(column)
    first = F.slice(F.col("_keys._key"), F.lit(1), F.greatest(F.lit(1), n - F.ceil(n * (least / (2 - least)) - 1e-9) + 1).cast("int"))
    return lists.select(column, F.explode(F.when(n == 0, F.array(F.lit(""))).otherwise(first)).alias("_key"))


def like_bags(one: DataFrame, a: str, other: DataFrame, b: str, least: float) -> DataFrame:
    """Pairs (a, b) of distinct texts of either side whose bags can reach `least`: a superset of those whose ratio does."""
    one, other = one.select(a).where(F.col(a).isNotNull()).distinct(), other.select(b).where(F.col(b).isNotNull()).distinct()
    both = one.select(F.explode(bag(F.col(a))).alias("_key")).union(other.select(F.explode(bag(F.col(b))).alias("_key")))
    counts = both.groupBy("_key").agg(F.count("*").alias("_n"))
    la, lb = F.length(a), F.length(b)
    pairs = bag_keys(one, a, least, counts).join(bag_keys(other, b, least, counts), "_key").where(2 * F.least(la, lb) >= least * (la + lb) - 1e-9).select(a, b).distinct()
    common = F.size(F.array_intersect(bag(F.col(a)), bag(F.col(b))))
    return pairs.where(2 * common >= least * (la + lb) - 1e-9)


def like_texts(rows: DataFrame, column: str, least: float) -> DataFrame:
    """(a, b, ratio) of all ordered pairs of distinct texts, equal ones too, with a matching-block ratio of `least` or more."""
    one, other = rows.select(F.col(column).alias("a")), rows.select(F.col(column).alias("b"))
    return like_bags(one, "a", other, "b", least).withColumn("ratio", sequence_ratio("a", "b")).where(F.col("ratio") >= least)


def like_products(products: DataFrame, maker: str, name: str, least: float) -> DataFrame:
    """Pairs of products of different but like makers: maker ratio from 0.8 * least, mean of maker and name ratio from least.

    Columns maker, name, other_maker, other_name and similarity. A pair comes in both orders, as the ratio depends on it;
    products without a maker or a name have no pairs.
    """
    rows = products.select(F.lower(maker).alias("m"), F.lower(name).alias("n")).where("m <> '' AND n <> ''").distinct()
    makers = like_texts(rows, "m", 0.8 * least).where("a <> b").select(F.col("a").alias("maker"), F.col("b").alias("other_maker"), F.col("ratio").alias("maker_ratio"))
    # makers differ, so their ratio is below 1
    names = like_texts(rows, "n", max(0.0, 2 * least - 1)).select(F.col("a").alias("name"), F.col("b").alias("other_name"), F.col("ratio").alias("name_ratio"))
    one, other = rows.toDF("maker", "name"), rows.toDF("other_maker", "other_name")
    pairs = one.join(makers, "maker").join(names, "name").withColumn("similarity", (F.col("maker_ratio") + F.col("name_ratio")) / 2).where(F.col("similarity") >= least)
    return pairs.join(other, ["other_maker", "other_name"]).select("maker", "name", "other_maker", "other_name", "similarity")


def like_keys(products: DataFrame, maker: str, name: str, least: float) -> DataFrame:
    """(a, b) of 'maker|name' keys, trimmed and in lower case, whose makers and whose names are each alike by more than `least`."""
    rows = products.select(F.lower(F.trim(maker)).alias("m"), F.lower(F.trim(name)).alias("n")).where("m IS NOT NULL AND n IS NOT NULL").distinct()
    likes = lambda c: like_texts(rows, c, least).where(F.col("ratio") > least)
    makers, names = likes("m").select(F.col("a").alias("m"), F.col("b").alias("om")), likes("n").select(F.col("a").alias("n"), F.col("b").alias("on"))
    pairs = rows.join(makers, "m").join(names, "n").join(rows.toDF("om", "on"), ["om", "on"]).where("m <> om OR n <> on")
    return pairs.select(F.concat_ws("|", "m", "n").alias("a"), F.concat_ws("|", "om", "on").alias("b"))


#: Shares of the brand and of the name in a score.
BRAND_SHARE, NAME_SHARE = 0.6, 0.4


def aligned(parts: DataFrame, catalog: DataFrame, least: float, aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Pairs of (p_brand, p_name) and (c_brand, c_name) with score = 0.6 brand + 0.4 sorted-word ratio from `least`, above 40.

    A brand of the catalog also goes by its aliases and by its name without "soap" at the end; the best of these counts.
    As a name gives 40 at most, brands must be alike by (least - 40) / 60: their pairs come from shared rare characters.
    Names meet only below such brands, where the score can still be reached by their lengths, each pair of names once.
    """
    if least <= 100 * NAME_SHARE:
        raise ValueError("below this, any two products are a pair")
    needed = (least - 100 * NAME_SHARE) / (100 * BRAND_SHARE)
    brand, name = lambda c: for_alignment(c), lambda c: token_sorted(for_alignment(F.col(c)))
    p = parts.withColumns({"_pb": brand(F.col("p_brand")), "_pn": name("p_name")}).where("_pb IS NOT NULL AND _pn IS NOT NULL")
    known = F.lit(None).cast("array<string>")
    for title, others in (aliases or {}).items():
        known = F.when(F.col("c_brand") == title, F.array(*[F.lit(o) for o in others])).otherwise(known)
    forms = F.array_compact(F.concat(F.array("c_brand", strip_last_soap(F.col("c_brand"))), F.coalesce(known, F.array().cast("array<string>"))))
    c = catalog.withColumns({"_cn": name("c_name"), "_form": F.explode(F.array_distinct(F.transform(forms, brand)))}).where("_cn IS NOT NULL")

    brands = like_bags(p, "_pb", c, "_form", needed - 1e-6).withColumn("_b", indel_ratio("_pb", "_form")).where(F.col("_b") >= 100 * needed - 1e-3)
    met = p.join(brands, "_pb").join(c, "_form").groupBy("p_brand", "p_name", "c_brand", "c_name", "_pn", "_cn").agg(F.max("_b").alias("_b"))
    lp, lc = F.length("_pn"), F.length("_cn")
    most = F.when(lp + lc == 0, 100.0).otherwise(200.0 * F.least(lp, lc) / (lp + lc))
    met = met.where(BRAND_SHARE * F.col("_b") + NAME_SHARE * most >= least - 1e-3)
    names = met.select("_pn", "_cn").distinct().withColumn("_n", indel_ratio("_pn", "_cn"))
    scored = met.join(names, ["_pn", "_cn"]).withColumn("score", F.round(BRAND_SHARE * F.col("_b") + NAME_SHARE * F.col("_n"), 4))
    return scored.where(F.col("score") >= least).select("p_brand", "p_name", "c_brand", "c_name", "score")


def with_neighbours(rows: DataFrame, column: str) -> DataFrame:
    """Rows with the values before and after in the order of a column of distinct values, null at either end.

    Rows are dealt out by ranges of the column and written, each range is put in order by itself, and gets the last value
    of the range before and the first one of the range after; of those there are only as many as ranges.
    """
    spark = rows.sparkSession
    path = scratch(spark, "ranges")
    rows.repartitionByRange(F.col(column)).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    ends = placed.groupBy("_range").agg(F.min(column).alias("first"), F.max(column).alias("last")).agg(F.array_sort(F.collect_list(F.struct("_range", "first", "last"))).alias("all"))
    borders = ends.select("all", F.posexplode("all").alias("k", "r")).select("r._range", F.when(F.col("k") > 0, F.get("all", F.col("k") - 1)["last"]).alias("_last"), F.get("all", F.col("k") + 1)["first"].alias("_next"))
    order = Window.partitionBy("_range").orderBy(column)
    near = placed.withColumns({"before": F.lag(column).over(order), "after": F.lead(column).over(order)}).join(borders, "_range")
    return near.withColumns({"before": F.coalesce("before", "_last"), "after": F.coalesce("after", "_next")}).drop("_range", "_last", "_next")


def sorted_neighbours(rows: DataFrame, column: str, apart: DataFrame, least: float) -> DataFrame:
    """Likeness of each distinct value to its neighbours in order, in two passes: (column, first_pass, before, after, similarity).

    Pairs of `apart` (a, b), in either order, are known not to be the same and count 0. Values that are like a neighbour by
    `least` or more stay, and meet their neighbours anew among what is left; similarity is that of the second pass.
    """
    known = apart.select("a", "b").union(apart.select("b", "a")).distinct()

    def likeness(near: DataFrame, side: str) -> DataFrame:
        marked = near.join(known.withColumnsRenamed({"a": column, "b": side}).withColumn("_apart", F.lit(True)), [column, side], "left")
        return marked.withColumn(f"_{side}", F.when(F.col("_apart") | F.col(side).isNull(), 0.0).otherwise(edit_ratio(F.col(column), F.col(side)))).drop("_apart")

    def run(values: DataFrame) -> DataFrame:
        return likeness(likeness(with_neighbours(values, column), "before"), "after").withColumn("similarity", F.greatest("_before", "_after"))

    first = run(rows.select(column).where(F.col(column).isNotNull()).distinct())
    kept = first.where(F.col("similarity") >= least).select(column, F.col("similarity").alias("first_pass"))
    return run(kept).select(column, "first_pass", "before", "after", "similarity")


def _cut(frame: DataFrame) -> DataFrame:
    """Go on from a written copy, so that the plan does not grow with the rounds."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def clusters(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, cluster): the least node that links reach, by large-star and small-star steps in turn until nothing changes."""
    edges = _cut(pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = None
    while True:
        # large star: each node sends its larger neighbours to the least node that it knows
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: each node sends its smaller neighbours, and itself, to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("cluster")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("cluster")).union(roots)
