"""Comparison of ranked tables between periods: moves, tiers, splits and merges, pivots, first and last appearance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def months_before(month: Column, n: int) -> Column:
    """The month n months earlier, as yyyy-MM."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), -n), "yyyy-MM")


def move_text(delta: Column) -> Column:
    """↑n, ↓n, = or n/a."""
    return F.when(delta.isNull(), "n/a").when(delta > 0, F.concat(F.lit("↑"), delta)).when(delta < 0, F.concat(F.lit("↓"), -delta)).otherwise("=")


def earlier_ranks(tables: DataFrame, keys: Sequence[str], later: Mapping[str, Column], period: str) -> DataFrame:
    """Add, for each name, the rank of the same key in an earlier period; `later` says in which period a row is the earlier one.

    Each row is sent to its own period and to those in which it is an earlier one, and all meet in one grouping, so the
    table is computed and shuffled once however many periods are compared. Keys are unique within a period; null keys
    meet nothing.
    """
    own = F.struct(F.lit("").alias("as"), F.col(period).alias("at"))
    sent = F.explode(F.array(own, *[F.struct(F.lit(n).alias("as"), at.alias("at")) for n, at in later.items()]))
    rows = tables.select(F.struct(*tables.columns).alias("_row"), sent.alias("_s"))
    met = rows.groupBy("_s.at", *[F.col(f"_row.{k}").alias(k) for k in keys]).agg(
        F.max(F.when(F.col("_s.as") == "", F.col("_row"))).alias("_row"), *[F.min(F.when(F.col("_s.as") == n, F.col("_row.rank"))).alias(n) for n in later]
    )
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"_row.{k}").isNotNull()
    return met.where("_row IS NOT NULL").select("_row.*", *[F.when(known, F.col(n)).alias(n) for n in later])


def rank_moves(tables: DataFrame, keys: Sequence[str], backs: Sequence[int], period: str = "month") -> DataFrame:
    """Add delta_k and move_k, the earlier rank minus the rank, against the table k months before; all periods at once."""
    out = earlier_ranks(tables, keys, {f"_then_{k}": months_before(F.col(period), -k) for k in backs}, period)
    for k in backs:
        out = out.withColumn(f"delta_{k}", F.col(f"_then_{k}") - F.col("rank")).withColumn(f"move_{k}", move_text(F.col(f"delta_{k}")))
    return out.drop(*[f"_then_{k}" for k in backs])


def paired_ranks(tables: DataFrame, key: str, back: int = 1, period: str = "month") -> DataFrame:
    """(period, key, now_rank, then_rank) of what a period and the one `back` months before both have, for all periods at once."""
    met = earlier_ranks(tables, [key], {"then_rank": months_before(F.col(period), -back)}, period)
    return met.where("then_rank IS NOT NULL").select(period, key, F.col("rank").alias("now_rank"), "then_rank")


def tier_moves(pairs: DataFrame, period: str = "month") -> DataFrame:
    """Per period and earlier rank: its members now, whether any moved, and whether the tier was split over several ranks."""
    return pairs.groupBy(period, "then_rank").agg(F.count("*").alias("members"), F.bool_or(F.col("now_rank") != F.col("then_rank")).alias("changed"), (F.count_distinct("now_rank") > 1).alias("split"))


def tier_merges(pairs: DataFrame, period: str = "month") -> DataFrame:
    """Per period and rank now: its members, and whether they come from several earlier ranks."""
    return pairs.groupBy(period, "now_rank").agg(F.count("*").alias("members"), (F.count_distinct("then_rank") > 1).alias("merged"))


def rank_history(tables: DataFrame, key: str, period: str, periods: Sequence, best: int = 3) -> DataFrame:
    """One row per key that was ever among the best, with its rank in each period."""
    ever = tables.where(F.col("rank") <= best).select(key).distinct()
    return tables.join(ever, key, "left_semi").groupBy(key).pivot(period, list(periods)).agg(F.min("rank"))


def appearances(rows: DataFrame, key: Column, period: str) -> DataFrame:
    """First and last period, number of periods, and the spelling of the first appearance, by key in lower case."""
    return rows.groupBy(F.lower(key).alias("key")).agg(
        F.min(period).alias("first_seen"), F.max(period).alias("last_seen"), F.count_distinct(period).alias("periods"), F.min_by(key, F.struct(period, key)).alias("display")
    )
