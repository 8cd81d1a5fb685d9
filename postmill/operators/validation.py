"""Checks of filed matches against what resolves now."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUES = ("no_match", "structural_change", "data_mismatch", "duplicate_string", "cross_section_conflict")


def filed_issues(filed: DataFrame, found: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(section, text, issue, detail) of filed rows (section, text, fields) against found ones (text, fields) of the same text in any case.

    no_match: nothing resolves any more. structural_change: fields that one side has and the other has not.
    data_mismatch: fields that both have, with other values; case does not count. duplicate_string: filed several times in
    one section. cross_section_conflict: filed in several sections; the detail has them all. A row can have several
    issues; a filed null text resolves to nothing.
    """
    key = F.lower(F.trim("text"))
    now = found.select(key.alias("_key"), F.struct(*fields).alias("_now"))
    rows = filed.select("section", "text", key.alias("_key"), F.struct(*fields).alias("_filed"))
    times = rows.groupBy("_key", "section").agg(F.count("*").alias("_times"))
    places = times.groupBy("_key").agg(F.array_sort(F.collect_set("section")).alias("_sections"))  # a handful of sections
    both = rows.join(now, "_key", "left").join(times.withColumnsRenamed({"_key": "_k", "section": "_s"}), F.col("_key").eqNullSafe(F.col("_k")) & F.col("section").eqNullSafe(F.col("_s")))
    both = both.join(places.withColumnRenamed("_key", "_p"), F.col("_key").eqNullSafe(F.col("_p")))

    def named(test: Callable[[Column, Column], Column]) -> Column:
        return F.concat_ws(",", *[F.when(test(F.col(f"_filed.{f}"), F.col(f"_now.{f}")), F.lit(f)) for f in fields])

    gone = F.coalesce(*[F.col(f"_now.{f}") for f in fields]).isNull()
    changed = named(lambda a, b: a.isNull() != b.isNull())
    differ = named(lambda a, b: a.isNotNull() & b.isNotNull() & (F.lower(a) != F.lower(b)))
    sections = F.array_join("_sections", ",")
    found_issues = (
        F.when(gone, F.struct(F.lit(ISSUES[0]).alias("issue"), F.lit("").alias("detail"))),
        F.when(~gone & (changed != ""), F.struct(F.lit(ISSUES[1]).alias("issue"), changed.alias("detail"))),
        F.when(~gone & (differ != ""), F.struct(F.lit(ISSUES[2]).alias("issue"), differ.alias("detail"))),
        F.when(F.col("_times") > 1, F.struct(F.lit(ISSUES[3]).alias("issue"), F.col("_times").cast("string").alias("detail"))),
        F.when(F.size("_sections") > 1, F.struct(F.lit(ISSUES[4]).alias("issue"), sections.alias("detail"))),
    )
    return both.select("section", "text", F.explode(F.array_compact(F.array(*found_issues))).alias("i")).select("section", "text", "i.issue", "i.detail")
