"""Tables of a year, built from the tables of its months and from its posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.ranking import ranked


def annual_products(posts: DataFrame, monthly: DataFrame, name: str = "name") -> DataFrame:
    """shaves and ranks of a year's products.

    The rank is by the sums of the months' posts and people; the people shown are those of the year, each once, with the
    mean and median of their posts. posts has year, author and the name column; monthly has year, shaves and unique_users.
    """
    sums = monthly.groupBy("year", name).agg(F.sum("shaves").alias("shaves"), F.sum("unique_users").alias("sum_monthly_users"))
    order = ranked(sums, [F.desc("shaves"), F.desc("sum_monthly_users")], ["year"])
    people = posts.groupBy("year", name, "author").agg(F.count("*").alias("n"))
    true = people.groupBy("year", name).agg(F.count("*").alias("unique_users"), F.bround(F.median("n"), 1).alias("median_shaves_per_user"))
    return order.join(true, ["year", name]).withColumn("avg_shaves_per_user", F.bround(F.col("shaves") / F.col("unique_users"), 1))


def annual_specialised(posts: DataFrame, name: str) -> DataFrame:
    """A year's posts and people by an identifier; the rank is by posts alone."""
    table = posts.groupBy("year", name).agg(F.count("*").alias("shaves"), F.count_distinct("author").alias("unique_users"))
    return ranked(table, [F.desc("shaves")], ["year"])


def annual_users(posts: DataFrame) -> DataFrame:
    """A year's posts and missed days by person; a year counts 365 days, and months without posts are missed wholly."""
    table = posts.groupBy("year", F.col("author").alias("user")).agg(F.count("*").alias("shaves"), (F.lit(365) - F.count_distinct("posted_date")).alias("missed_days"))
    return ranked(table, [F.asc("missed_days"), F.desc("shaves")], ["year"])
