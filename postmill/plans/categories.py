"""Category tables of each month, one query per specification."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.operators.categories import SPECS, CategorySpec, category_table
from postmill.plans.base import query
from postmill.sources.posts import posts


def category_sql(spec: CategorySpec, period: str = "month") -> str:
    keys = ", ".join(f"{e} AS {k}" for k, e in spec.keys.items())
    names = ", ".join(spec.keys)
    shown = "".join(f", arg_min({e}, id) AS {k}" for k, e in spec.display.items())
    given = " AND ".join(f"({e}) IS NOT NULL" for e in spec.keys.values())
    by = ", ".join(str(i) for i in range(1, len(spec.keys) + 2))
    return f"""WITH g AS (SELECT {period}, {keys}, count(author) AS shaves, count(DISTINCT author) AS unique_users{shown} FROM posts
        WHERE ({spec.where}) AND {given} GROUP BY {by})
        SELECT {period}, {names}, shaves, unique_users{''.join(', ' + k for k in spec.display)},
          rank() OVER (PARTITION BY {period} ORDER BY shaves DESC, unique_users DESC)::INTEGER AS rank FROM g"""


for _spec in SPECS.values():
    query(_spec.name, category_sql(_spec), posts=True)(lambda spark, sf, spec=_spec: category_table(posts(spark, sf), spec))


@query("blade_usage_distribution", """WITH g AS (SELECT month, coalesce(use_count, 1) AS use_count, count(author) AS shaves, count(DISTINCT author) AS unique_users
    FROM posts WHERE blade_brand IS NOT NULL AND coalesce(use_count, 1) >= 1 GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY month ORDER BY use_count)::INTEGER AS rank FROM g""", posts=True)
def blade_usage_distribution(spark, sf):
    from postmill.operators.ranking import numbered

    spec = CategorySpec("use_count", {"use_count": "coalesce(use_count, 1)"}, "blade_brand IS NOT NULL AND coalesce(use_count, 1) >= 1")
    return numbered(category_table(posts(spark, sf), spec).drop("rank"), [F.asc("use_count")], ["month"])


@query("sample_usage_metrics", """SELECT month, count(*) AS total_shaves, count(*) FILTER (sample_type IS NOT NULL) AS sample_shaves,
    round_even(100.0 * count(*) FILTER (sample_type IS NOT NULL) / count(*), 2) AS sample_percentage,
    count(DISTINCT author) FILTER (sample_type IS NOT NULL) AS unique_sample_users, count(DISTINCT lower(soap_brand)) FILTER (sample_type IS NOT NULL) AS unique_sample_brands,
    coalesce(array_to_string(list_sort(list(DISTINCT sample_type) FILTER (sample_type IS NOT NULL)), ','), '') AS sample_types FROM posts GROUP BY month""", posts=True)
def sample_usage_metrics(spark, sf):
    sampled = F.col("sample_type").isNotNull()
    return posts(spark, sf).groupBy("month").agg(
        F.count("*").alias("total_shaves"),
        F.count_if(sampled).alias("sample_shaves"),
        F.bround(100.0 * F.count_if(sampled) / F.count("*"), 2).alias("sample_percentage"),
        F.count_distinct(F.when(sampled, F.col("author"))).alias("unique_sample_users"),
        F.count_distinct(F.when(sampled, F.lower("soap_brand"))).alias("unique_sample_brands"),
        F.array_join(F.array_sort(F.collect_set("sample_type")), ",").alias("sample_types"),
    )


@query("sample_usage_by_type", """SELECT month, sample_type, count(*) AS shaves, count(DISTINCT author) AS unique_users, count(DISTINCT lower(soap_brand)) AS unique_brands
    FROM posts WHERE sample_type <> '' GROUP BY 1, 2""", posts=True)
def sample_usage_by_type(spark, sf):
    return posts(spark, sf).where("sample_type <> ''").groupBy("month", "sample_type").agg(
        F.count("*").alias("shaves"), F.count_distinct("author").alias("unique_users"), F.count_distinct(F.lower("soap_brand")).alias("unique_brands")
    )


@query("brand_diversity", """WITH n AS (SELECT DISTINCT month, split_part(lower(soap_brand) || ' - ' || lower(soap_scent), ' - ', 1) AS brand, lower(soap_scent) AS scent
      FROM posts WHERE soap_brand IS NOT NULL AND soap_scent IS NOT NULL),
    g AS (SELECT month, brand, count(*) AS unique_soaps FROM n GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY month ORDER BY unique_soaps DESC)::INTEGER AS rank FROM g""", posts=True)
def brand_diversity(spark, sf):
    from postmill.operators.ranking import ranked

    view = posts(spark, sf)
    soaps = category_table(view, SPECS["soaps"]).select("month", F.split_part(F.concat_ws(" - ", "brand_key", "scent_key"), F.lit(" - "), F.lit(1)).alias("brand"))
    makers = view.where("soap_brand IS NOT NULL").select("month", F.lower("soap_brand").alias("brand")).distinct()
    counts = soaps.join(makers, ["month", "brand"], "left_semi").groupBy("month", "brand").agg(F.count("*").alias("unique_soaps"))
    return ranked(counts, [F.desc("unique_soaps")], ["month"])


@query("razor_formats", """WITH u AS (SELECT month, razor_format AS format, author, count(*) AS n FROM posts WHERE razor_format <> '' GROUP BY 1, 2, 3),
    g AS (SELECT month, format, sum(n)::BIGINT AS shaves, count(*) AS unique_users, round_even(sum(n) / count(*), 1) AS avg_shaves_per_user, round_even(median(n), 1) AS median_shaves_per_user FROM u GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY month ORDER BY shaves DESC, unique_users DESC, format)::INTEGER AS rank FROM g""", posts=True)
def razor_formats(spark, sf):
    from postmill.operators.people import per_person_table

    return per_person_table(posts(spark, sf).where("razor_format <> ''").withColumnRenamed("razor_format", "format"), ["month"], ["format"])


for _name, _column, _as in (("razor_format_users", "razor_format", "format"), ("brush_fiber_users", "fiber", "fiber")):

    @query(_name, f"""WITH g AS (SELECT month, {_column} AS {_as}, author AS "user", count(*) AS shaves FROM posts WHERE {_column} <> '' GROUP BY 1, 2, 3)
        SELECT *, row_number() OVER (PARTITION BY month, {_as} ORDER BY shaves DESC, "user")::INTEGER AS rank FROM g""", posts=True)
    def _group_users(spark, sf, column=_column, to=_as):
        from postmill.operators.ranking import numbered

        counts = posts(spark, sf).where(f"{column} <> ''").groupBy("month", F.col(column).alias(to), F.col("author").alias("user")).agg(F.count("*").alias("shaves"))
        return numbered(counts, [F.desc("shaves"), F.asc("user")], ["month", to])


@query("highest_use_count_per_blade", """WITH g AS (SELECT month, blade_brand || ' ' || blade_model AS blade, blade_format AS format, author AS "user", max(use_count) AS uses
      FROM posts WHERE use_count IS NOT NULL GROUP BY 1, 2, 3, 4)
    SELECT *, rank() OVER (PARTITION BY month ORDER BY uses DESC)::INTEGER AS rank FROM g""", posts=True)
def highest_use_count_per_blade(spark, sf):
    from postmill.operators.ranking import ranked

    most = posts(spark, sf).where("use_count IS NOT NULL").groupBy("month", F.concat_ws(" ", "blade_brand", "blade_model").alias("blade"), F.col("blade_format").alias("format"), F.col("author").alias("user")).agg(F.max("use_count").alias("uses"))
    return ranked(most, [F.desc("uses")], ["month"])
