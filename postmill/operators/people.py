"""What is measured per person: how much they use of what, how varied, and on which days they did not post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators.ranking import numbered, ranked


def per_person_table(rows: DataFrame, period: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """shaves, unique_users, and mean and median of a person's posts, by key; numbered within the period."""
    people = rows.groupBy(*period, *keys, "author").agg(F.count("*").alias("n"))
    table = people.groupBy(*period, *keys).agg(
        F.sum("n").alias("shaves"),
        F.count("*").alias("unique_users"),
        F.bround(F.sum("n") / F.count("*"), 1).alias("avg_shaves_per_user"),
        F.bround(F.median("n"), 1).alias("median_shaves_per_user"),
    )
    return numbered(table, [F.desc("shaves"), F.desc("unique_users"), *[F.asc(k) for k in keys]], period)


def diversity(rows: DataFrame, product: Column, period: Sequence[str], count_name: str, digits: int = 1) -> DataFrame:
    """Per person: distinct products, posts, and posts per product."""
    used = rows.groupBy(*period, F.col("author").alias("user"), product.alias("_product")).agg(F.count("*").alias("n"))
    table = used.groupBy(*period, "user").agg(F.count("_product").alias(count_name), F.sum("n").alias("shaves"))
    return table.withColumn("avg_shaves_per_item", F.bround(F.col("shaves") / F.col(count_name), digits))


def concentration(rows: DataFrame, product: Column, countable: Column, period: Sequence[str]) -> DataFrame:
    """Per person: distinct countable products, all posts, sum of squared shares (hhi), and 1 / hhi.

    Shares are of all posts, so posts that are not countable dilute them. People without a countable product do not appear.
    """
    used = rows.groupBy(*period, F.col("author").alias("user"), F.when(countable, product).alias("_product")).agg(F.count("*").alias("n"))
    people = used.groupBy(*period, "user").agg(
        F.count("_product").alias("unique_combinations"),
        F.sum("n").alias("shaves"),
        F.sum(F.when(F.col("_product").isNotNull(), (F.col("n") * F.col("n")).cast("double"))).alias("_squares"),
    )
    hhi = F.col("_squares") / (F.col("shaves") * F.col("shaves"))
    return people.where("unique_combinations > 0").select(
        *period,
        "user",
        "unique_combinations",
        "shaves",
        F.bround(F.col("shaves") / F.col("unique_combinations"), 2).alias("avg_shaves_per_combination"),
        F.bround(hhi, 4).alias("hhi"),
        F.bround(1 / hhi, 2).alias("effective_soaps"),
    )


def missed_days(rows: DataFrame, month: str = "month", day: str = "posted_date") -> DataFrame:
    """Per month and person: posts, days of the month without one, and which; ranked by fewest, then most posts."""
    first = F.to_date(F.concat(F.col(month), F.lit("-01")))
    people = rows.groupBy(month, F.col("author").alias("user")).agg(F.count("*").alias("shaves"), F.collect_set(day).alias("_posted"))
    days = F.array_sort(F.array_except(F.sequence(first, F.last_day(first)), "_posted"))
    table = people.withColumn("_missed", days).select(
        month, "user", "shaves", F.size("_missed").cast("long").alias("missed_days"), F.array_join(F.transform("_missed", lambda d: F.date_format(d, "yyyy-MM-dd")), ",").alias("missed_dates")
    )
    return ranked(table, [F.asc("missed_days"), F.desc("shaves")], [month])
