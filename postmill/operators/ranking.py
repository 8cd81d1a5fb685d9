"""Ranks and what is cut off by them. Windows are partitioned by period or group wherever there is one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.sources.store import scratch


def _window(partition: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*partition).orderBy(*order)


def ranked(frame: DataFrame, order: Sequence[Column], partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Competition rank: ties share the rank, and a gap follows (1, 2, 2, 4)."""
    return frame.withColumn(name, F.rank().over(_window(partition, order)))


def numbered(frame: DataFrame, order: Sequence[Column], partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Position 1 to n; the order should name a tie-break, or equal rows come in any order."""
    return frame.withColumn(name, F.row_number().over(_window(partition, order)))


def numbered_all(frame: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Position 1 to n over all rows, without one task for them all; the order should name a tie-break.

    Rows are dealt out by ranges of the order and written, each range is numbered by itself, and begins after as many as
    the ranges before it hold; of those there are only as many as ranges.
    """
    spark = frame.sparkSession
    path = scratch(spark, "order")
    frame.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = placed.groupBy("_range").agg(F.count("*").alias("n")).agg(F.array_sort(F.collect_list(F.struct("_range", "n"))).alias("all"))
    before = F.aggregate(F.slice("all", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    starts = sizes.select("all", F.posexplode("all").alias("k", "r")).select("r._range", before.alias("_before"))
    numbered_ = placed.withColumn("_n", F.row_number().over(_window(["_range"], order))).join(starts, "_range")
    return numbered_.withColumn(name, (F.col("_n") + F.col("_before")).cast("int")).drop("_range", "_n", "_before")


def within_ranks(frame: DataFrame, most: int, name: str = "rank") -> DataFrame:
    """Rows up to a rank."""
    return frame.where(F.col(name) <= most)


def rows_with_ties(frame: DataFrame, rows: int, partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """The first rows by rank, and all that tie with the last of them."""
    # a competition rank says how many rows come before the tie, so the tie is in if it starts within the limit
    return frame.where(F.col(name) <= rows)


def rows_with_capped_tie(frame: DataFrame, rows: int, factor: float = 1.5, partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """As rows_with_ties, but where the last tie would bring more than factor times the rows, the whole tie goes."""
    ties = Window.partitionBy(*partition, name)
    through = F.col(name) + F.count("*").over(ties) - 1
    return frame.withColumn("_through", through).where((F.col(name) <= rows) & (F.col("_through") <= factor * rows)).drop("_through")


def tie_marks(frame: DataFrame, partition: Sequence[str] = (), name: str = "rank", to: str = "rank_text") -> DataFrame:
    """Ranks as text: "3=" where tied, else "3 "."""
    tied = F.count("*").over(Window.partitionBy(*partition, name)) > 1
    return frame.withColumn(to, F.concat(F.col(name).cast("string"), F.when(tied, "=").otherwise(" ")))


def reranked(frame: DataFrame, order: Sequence[Column], partition: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Drop a rank and rank anew by other columns."""
    return ranked(frame.drop(name), order, partition, name)


def limited_field(frame: DataFrame, column: str, bound) -> DataFrame:
    """At least the bound, or at most it for columns in which less is better."""
    less = ("missed", "days", "errors", "failures", "cost", "time")
    test = F.col(column) <= bound if any(w in column.lower() for w in less) else F.col(column) >= bound
    return frame.where(test)
