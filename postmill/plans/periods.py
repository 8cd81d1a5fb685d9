"""Queries over years and between periods."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Window
from pyspark.sql import functions as F

from postmill.operators import annual, periods, similarity
from postmill.operators.categories import SPECS, category_table
from postmill.operators.ranking import limited_field, numbered, ranked, reranked, rows_with_capped_tie, rows_with_ties, tie_marks, within_ranks
from postmill.plans.base import query
from postmill.plans.categories import category_sql
from postmill.sources.posts import posts, table

RAZOR_NAME = "concat(razor_brand, ' ', razor_model)"
for _name, _expr, _where in (
    ("annual_razors", RAZOR_NAME, "razor_brand IS NOT NULL"),
    ("annual_blades", "concat(blade_brand, ' ', blade_model)", "blade_brand IS NOT NULL"),
    ("annual_soaps", "concat(lower(soap_brand), ' - ', lower(soap_scent))", "soap_brand IS NOT NULL"),
):

    @query(_name, f"""WITH x AS (SELECT year, month, author, {_expr} AS name FROM posts WHERE {_where}),
        m AS (SELECT year, month, name, count(*) AS shaves, count(DISTINCT author) AS users FROM x GROUP BY 1, 2, 3),
        s AS (SELECT year, name, sum(shaves)::BIGINT AS shaves, sum(users)::BIGINT AS sum_monthly_users FROM m GROUP BY 1, 2),
        p AS (SELECT year, name, author, count(*) AS n FROM x GROUP BY 1, 2, 3), t AS (SELECT year, name, count(*) AS unique_users, round_even(median(n), 1) AS median_shaves_per_user FROM p GROUP BY 1, 2)
        SELECT year, name, shaves, sum_monthly_users, rank() OVER (PARTITION BY year ORDER BY shaves DESC, sum_monthly_users DESC)::INTEGER AS rank, unique_users, median_shaves_per_user,
          round_even(shaves / unique_users, 1) AS avg_shaves_per_user FROM s JOIN t USING (year, name)""", posts=True)
    def _annual(spark, sf, expr=_expr, where=_where):
        named = posts(spark, sf).where(where).select("year", "month", "author", F.expr(expr).alias("name"))
        monthly = named.groupBy("year", "month", "name").agg(F.count("*").alias("shaves"), F.count_distinct("author").alias("unique_users"))
        return annual.annual_products(named, monthly)


for _name, _column, _where in (("annual_fibers", "fiber", "true"), ("annual_plates", "gap", "razor_brand = 'Brand#13'"), ("annual_knot_sizes", "knot_size_mm", "knot_size_mm BETWEEN 15 AND 50")):

    @query(_name, f"""WITH g AS (SELECT year, {_column}, count(*) AS shaves, count(DISTINCT author) AS unique_users FROM posts WHERE {_where} GROUP BY 1, 2)
        SELECT *, rank() OVER (PARTITION BY year ORDER BY shaves DESC)::INTEGER AS rank FROM g""", posts=True)
    def _specialised(spark, sf, column=_column, where=_where):
        return annual.annual_specialised(posts(spark, sf).where(where), column)


@query("annual_users", """WITH g AS (SELECT year, author AS "user", count(*) AS shaves, 365 - count(DISTINCT posted_date) AS missed_days FROM posts GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY year ORDER BY missed_days, shaves DESC)::INTEGER AS rank FROM g""", posts=True)
def annual_users(spark, sf):
    return annual.annual_users(posts(spark, sf))


@query("annual_median_formats", """WITH u AS (SELECT year, razor_format AS format, author, count(*) AS n FROM posts GROUP BY 1, 2, 3),
    g AS (SELECT year, format, sum(n)::BIGINT AS shaves, count(*) AS unique_users, round_even(sum(n) / count(*), 1) AS avg_shaves_per_user, round_even(median(n), 1) AS median_shaves_per_user FROM u GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY year ORDER BY shaves DESC, unique_users DESC, format)::INTEGER AS rank FROM g""", posts=True)
def annual_median_formats(spark, sf):
    from postmill.operators.people import per_person_table

    return per_person_table(posts(spark, sf).withColumnRenamed("razor_format", "format"), ["year"], ["format"])


@query("annual_highest_use", """WITH m AS (SELECT year, month, blade_brand || ' ' || blade_model AS blade, blade_format AS format, author AS "user", max(use_count) AS uses FROM posts GROUP BY 1, 2, 3, 4, 5),
    g AS (SELECT year, blade, format, "user", max(uses) AS uses FROM m GROUP BY 1, 2, 3, 4) SELECT *, rank() OVER (PARTITION BY year ORDER BY uses DESC)::INTEGER AS rank FROM g""", posts=True)
def annual_highest_use(spark, sf):
    most = posts(spark, sf).groupBy("year", F.concat_ws(" ", "blade_brand", "blade_model").alias("blade"), F.col("blade_format").alias("format"), F.col("author").alias("user")).agg(F.max("use_count").alias("uses"))
    return ranked(most, [F.desc("uses")], ["year"])


@query("annual_metadata", """WITH u AS (SELECT year, author, count(*) AS n FROM posts GROUP BY 1, 2), m AS (SELECT year, round_even(median(n), 1) AS median_shaves_per_user FROM u GROUP BY 1),
    c AS (SELECT y AS year, list_filter(list_transform(range(1, 13), lambda k: y || '-' || lpad(k::VARCHAR, 2, '0')), lambda k: true) AS every FROM (SELECT DISTINCT year AS y FROM posts))
    SELECT p.year, count(*) AS total_shaves, count(DISTINCT author) AS unique_shavers, round_even(count(*) / count(DISTINCT author), 1) AS avg_shaves_per_user, any_value(m.median_shaves_per_user) AS median_shaves_per_user,
      round_even(100.0 * count(*) FILTER (sample_type IS NOT NULL) / count(*), 2) AS sample_percentage, array_to_string(list_sort(list(DISTINCT month)), ',') AS included_months,
      coalesce(array_to_string(list_filter(any_value(every), lambda k: NOT list_contains(list(DISTINCT month), k)), ','), '') AS missing_months
    FROM posts p JOIN m USING (year) JOIN c USING (year) GROUP BY p.year""".replace("coalesce(array_to_string(list_filter(any_value(every), lambda k: NOT list_contains(list(DISTINCT month), k)), ','), '') AS missing_months", "list(DISTINCT month) AS seen, any_value(every) AS every").replace("SELECT p.year", "SELECT year, total_shaves, unique_shavers, avg_shaves_per_user, median_shaves_per_user, sample_percentage, included_months, coalesce(array_to_string(list_filter(every, lambda k: NOT list_contains(seen, k)), ','), '') AS missing_months FROM (SELECT p.year") + ")", posts=True)
def annual_metadata(spark, sf):
    view = posts(spark, sf)
    medians = view.groupBy("year", "author").agg(F.count("*").alias("n")).groupBy("year").agg(F.bround(F.median("n"), 1).alias("median_shaves_per_user"))
    every = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda k: F.concat_ws("-", "year", F.lpad(k.cast("string"), 2, "0")))
    totals = view.groupBy("year").agg(
        F.count("*").alias("total_shaves"),
        F.count_distinct("author").alias("unique_shavers"),
        F.bround(F.count("*") / F.count_distinct("author"), 1).alias("avg_shaves_per_user"),
        F.bround(100.0 * F.count("sample_type") / F.count("*"), 2).alias("sample_percentage"),
        F.array_sort(F.collect_set("month")).alias("_months"),
    )
    return totals.join(medians, "year").withColumns({"included_months": F.array_join("_months", ","), "missing_months": F.array_join(F.array_except(every, "_months"), ",")}).drop("_months")


MAKERS = category_sql(SPECS["razor_manufacturers"])


def makers(spark, sf):
    return category_table(posts(spark, sf), SPECS["razor_manufacturers"])


def _moves_sql(key: str, backs: tuple[int, ...], source: str) -> str:
    joins = "".join(f" LEFT JOIN t b{k} ON b{k}.{key} = t.{key} AND b{k}.month = strftime(strptime(t.month || '-01', '%Y-%m-%d') - INTERVAL {k} MONTH, '%Y-%m')" for k in backs)
    columns = "".join(
        f", b{k}.rank - t.rank AS delta_{k}, CASE WHEN b{k}.rank IS NULL THEN 'n/a' WHEN b{k}.rank > t.rank THEN '↑' || (b{k}.rank - t.rank) WHEN b{k}.rank < t.rank THEN '↓' || (t.rank - b{k}.rank) ELSE '=' END AS move_{k}" for k in backs
    )
    return f"WITH g0 AS ({source}), t AS (SELECT * FROM g0) SELECT t.*{columns} FROM t{joins}"


# DuckDB takes a WITH inside a common table expression, so a category's SQL can be nested whole
@query("delta_columns", _moves_sql("brand", (1, 12, 60), MAKERS), posts=True)
def delta_columns(spark, sf):
    """Moves against the month before, the same month a year before, and five years before."""
    return periods.rank_moves(makers(spark, sf), ["brand"], (1, 12, 60))


@query("flagship_report", f"""WITH g0 AS ({category_sql(SPECS['razors'])}), t AS (SELECT * FROM g0),
    d AS (SELECT t.*, b.rank - t.rank AS delta_1, CASE WHEN b.rank IS NULL THEN 'n/a' WHEN b.rank > t.rank THEN '↑' || (b.rank - t.rank) WHEN b.rank < t.rank THEN '↓' || (t.rank - b.rank) ELSE '=' END AS move_1
      FROM t LEFT JOIN t b ON b.name = t.name AND b.month = strftime(strptime(t.month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m')) SELECT * FROM d WHERE rank <= 50""", posts=True)
def flagship_report(spark, sf):
    """The fifty first products of each month with their moves against the month before."""
    return within_ranks(periods.rank_moves(category_table(posts(spark, sf), SPECS["razors"]), ["name"], (1,)), 50)


PAIRS = f"""g0 AS MATERIALIZED ({MAKERS}), e AS (SELECT *, strftime(strptime(month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m') AS earlier FROM g0),
    p AS (SELECT a.month, a.brand, a.rank AS now_rank, b.rank AS then_rank FROM e a JOIN g0 b ON a.brand = b.brand AND b.month = a.earlier)"""


@query("delta_rank", f"""WITH {PAIRS} SELECT a.month, a.brand, a.rank, b.rank - a.rank AS delta, CASE WHEN b.rank IS NULL THEN 'n/a' WHEN b.rank > a.rank THEN '↑' || (b.rank - a.rank) WHEN b.rank < a.rank THEN '↓' || (a.rank - b.rank) ELSE '=' END AS move
    FROM e a LEFT JOIN g0 b ON a.brand = b.brand AND b.month = a.earlier""", posts=True)
def delta_rank(spark, sf):
    """Each month's ranks with the moves against the month before."""
    moved = periods.rank_moves(makers(spark, sf), ["brand"], (1,))
    return moved.select("month", "brand", "rank", F.col("delta_1").alias("delta"), F.col("move_1").alias("move"))


@query("delta_tier", f"WITH {PAIRS} SELECT month, then_rank, count(*) AS members, bool_or(now_rank <> then_rank) AS changed, count(DISTINCT now_rank) > 1 AS split FROM p GROUP BY 1, 2", posts=True)
def delta_tier(spark, sf):
    return periods.tier_moves(periods.paired_ranks(makers(spark, sf), "brand"))


@query("tier_splits_merges", f"WITH {PAIRS} SELECT month, now_rank, count(*) AS members, count(DISTINCT then_rank) > 1 AS merged FROM p GROUP BY 1, 2", posts=True)
def tier_splits_merges(spark, sf):
    return periods.tier_merges(periods.paired_ranks(makers(spark, sf), "brand"))


@query("delta_category_batch", f"""WITH a0 AS ({MAKERS}), b0 AS ({category_sql(SPECS['brush_fibers'])}), c0 AS ({category_sql(SPECS['soap_makers'])}),
    u AS MATERIALIZED (SELECT 'razor_manufacturers' AS category, brand AS name, month, rank FROM a0 UNION ALL SELECT 'brush_fibers', fiber, month, rank FROM b0 UNION ALL SELECT 'soap_makers', brand, month, rank FROM c0),
    t AS MATERIALIZED (SELECT *, strftime(strptime(month || '-01', '%Y-%m-%d') - INTERVAL 1 MONTH, '%Y-%m') AS earlier FROM u)
    SELECT a.category, a.name, a.month, a.rank, b.rank - a.rank AS delta_1, CASE WHEN b.rank IS NULL THEN 'n/a' WHEN b.rank > a.rank THEN '↑' || (b.rank - a.rank) WHEN b.rank < a.rank THEN '↓' || (a.rank - b.rank) ELSE '=' END AS move_1
    FROM t a LEFT JOIN t b ON a.category = b.category AND a.name = b.name AND b.month = a.earlier""", posts=True)
def delta_category_batch(spark, sf):
    view, parts = posts(spark, sf), None
    for name, key in (("razor_manufacturers", "brand"), ("brush_fibers", "fiber"), ("soap_makers", "brand")):
        one = category_table(view, SPECS[name]).select(F.lit(name).alias("category"), F.col(key).alias("name"), "month", "rank")
        parts = one if parts is None else parts.unionByName(one)
    return periods.rank_moves(parts, ["category", "name"], (1,))


@query("delta_annual", """WITH g AS (SELECT year, razor_brand AS brand, count(*) AS shaves FROM posts GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY shaves DESC)::INTEGER AS rank FROM g)
    SELECT a.year, a.brand, a.shaves, a.rank, b.rank - a.rank AS delta_1, c.rank - a.rank AS delta_5 FROM r a LEFT JOIN r b ON a.brand = b.brand AND b.year = a.year - 1 LEFT JOIN r c ON a.brand = c.brand AND c.year = a.year - 5""", posts=True)
def delta_annual(spark, sf):
    """Years are compared by name; one column per comparison year."""
    table_ = ranked(posts(spark, sf).groupBy("year", F.col("razor_brand").alias("brand")).agg(F.count("*").alias("shaves")), [F.desc("shaves")], ["year"])
    out = periods.earlier_ranks(table_, ["brand"], {f"_then_{k}": F.col("year") + k for k in (1, 5)}, "year")
    return out.select("year", "brand", "shaves", "rank", *[(F.col(f"_then_{k}") - F.col("rank")).alias(f"delta_{k}") for k in (1, 5)])


YEARS = tuple(range(1995, 2002))


@query("rank_history_pivot", f"""WITH g AS (SELECT year, razor_brand AS brand, count(*) AS shaves FROM posts GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY shaves DESC)::INTEGER AS rank FROM g)
    SELECT brand, {', '.join(f'min(CASE WHEN year = {y} THEN rank END) AS "{y}"' for y in YEARS)} FROM r WHERE brand IN (SELECT brand FROM r WHERE rank <= 3) GROUP BY brand""", posts=True)
def rank_history_pivot(spark, sf):
    table_ = ranked(posts(spark, sf).groupBy("year", F.col("razor_brand").alias("brand")).agg(F.count("*").alias("shaves")), [F.desc("shaves")], ["year"])
    return periods.rank_history(table_, "brand", "year", YEARS)


@query("head_to_head", """WITH g AS (SELECT month, razor_brand AS brand, count(*) AS n FROM posts WHERE razor_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1, 2),
    p AS (SELECT month, coalesce(max(n) FILTER (brand = 'Brand#1'), 0) AS a, coalesce(max(n) FILTER (brand = 'Brand#2'), 0) AS b, coalesce(max(n) FILTER (brand = 'Brand#3'), 0) AS c FROM g GROUP BY 1)
    SELECT *, CASE WHEN a > b THEN 'a' WHEN b > a THEN 'b' ELSE 'tie' END AS winner, count(*) FILTER (a > b) OVER () AS wins_a, count(*) FILTER (b > a) OVER () AS wins_b, count(*) FILTER (a = b) OVER () AS ties FROM p""", posts=True)
def head_to_head(spark, sf):
    """Posts of three brands by month, the winner of the first two, and how often each won."""
    brands = {"Brand#1": "a", "Brand#2": "b", "Brand#3": "c"}
    counts = posts(spark, sf).where(F.col("razor_brand").isin(*brands)).groupBy("month").pivot("razor_brand", list(brands)).count().na.fill(0)
    counts = counts.withColumnsRenamed(brands).withColumn("winner", F.when(F.col("a") > F.col("b"), "a").when(F.col("b") > F.col("a"), "b").otherwise("tie"))
    # one row a month: few enough for one window
    over_all = lambda hit: F.count_if(hit).over(Window.partitionBy())
    return counts.withColumns({"wins_a": over_all(F.col("a") > F.col("b")), "wins_b": over_all(F.col("b") > F.col("a")), "ties": over_all(F.col("a") == F.col("b"))})


@query("search_index", """SELECT lower('razor:' || razor_brand || ':' || razor_model) AS key, min(month) AS first_seen, max(month) AS last_seen, count(DISTINCT month) AS periods, arg_min('razor:' || razor_brand || ':' || razor_model, month || razor_brand) AS display FROM posts GROUP BY 1
    UNION ALL SELECT lower('user:' || author), min(month), max(month), count(DISTINCT month), arg_min('user:' || author, month) FROM posts GROUP BY 1""", posts=True)
def search_index(spark, sf):
    view = posts(spark, sf)
    products = periods.appearances(view, F.concat(F.lit("razor:"), "razor_brand", F.lit(":"), "razor_model"), "month")
    return products.unionByName(periods.appearances(view, F.concat(F.lit("user:"), "author"), "month"))


@query("limit_ranks", f"WITH g0 AS ({MAKERS}) SELECT * FROM g0 WHERE rank <= 5", posts=True)
def limit_ranks(spark, sf):
    return within_ranks(makers(spark, sf), 5)


@query("limit_rows_with_ties", f"WITH g0 AS ({MAKERS}) SELECT * FROM g0 WHERE rank <= (SELECT max(r.rank) FROM (SELECT month, rank, row_number() OVER (PARTITION BY month ORDER BY rank) AS n FROM g0) r WHERE r.n <= 7 AND r.month = g0.month)", posts=True)
def limit_rows_with_ties(spark, sf):
    return rows_with_ties(makers(spark, sf), 7, ["month"])


@query("limit_rows_tie_cap", f"WITH g0 AS ({MAKERS}), c AS (SELECT *, rank + count(*) OVER (PARTITION BY month, rank) - 1 AS through FROM g0) SELECT * EXCLUDE through FROM c WHERE rank <= 4 AND through <= 6", posts=True)
def limit_rows_tie_cap(spark, sf):
    return rows_with_capped_tie(makers(spark, sf), 4, 1.5, ["month"])


@query("tie_suffix", f"WITH g0 AS ({MAKERS}) SELECT *, rank || CASE WHEN count(*) OVER (PARTITION BY month, rank) > 1 THEN '=' ELSE ' ' END AS rank_text FROM g0", posts=True)
def tie_suffix(spark, sf):
    return tie_marks(makers(spark, sf), ["month"])


@query("rerank_by_columns", f"WITH g0 AS ({MAKERS}) SELECT * EXCLUDE rank, rank() OVER (PARTITION BY month ORDER BY unique_users DESC, shaves)::INTEGER AS rank FROM g0", posts=True)
def rerank_by_columns(spark, sf):
    return reranked(makers(spark, sf), [F.desc("unique_users"), F.asc("shaves")], ["month"])


@query("numeric_threshold", f"WITH g0 AS ({MAKERS}) SELECT * EXCLUDE rank, rank() OVER (PARTITION BY month ORDER BY unique_users DESC)::INTEGER AS rank FROM g0 WHERE shaves >= 30", posts=True)
def numeric_threshold(spark, sf):
    """The threshold is on another column than the sort, so it comes before the new rank."""
    return reranked(makers(spark, sf).where("shaves >= 30"), [F.desc("unique_users")], ["month"])


@query("field_limit", """WITH g AS (SELECT year, author AS "user", count(*) AS shaves, 365 - count(DISTINCT posted_date) AS missed_days FROM posts GROUP BY 1, 2)
    SELECT *, rank() OVER (PARTITION BY year ORDER BY missed_days, shaves DESC)::INTEGER AS rank FROM g QUALIFY missed_days <= 360 AND shaves >= 8""", posts=True)
def field_limit(spark, sf):
    return limited_field(limited_field(annual.annual_users(posts(spark, sf)), "missed_days", 360), "shaves", 8)


@query("topk_examples", """WITH g AS (SELECT razor_brand AS brand, razor_model AS model, count(*) AS n FROM posts GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY n DESC, model) AS k FROM g)
    SELECT brand, sum(n)::BIGINT AS shaves, array_to_string(list(model || ':' || n ORDER BY k) FILTER (k <= 3), ',') AS examples FROM r GROUP BY 1""", posts=True)
def topk_examples(spark, sf):
    """The three most used models of each brand; ranks are limited before anything is gathered."""
    counts = posts(spark, sf).groupBy(F.col("razor_brand").alias("brand"), F.col("razor_model").alias("model")).agg(F.count("*").alias("n"))
    best = counts.withColumn("k", F.row_number().over(Window.partitionBy("brand").orderBy(F.desc("n"), "model"))).where("k <= 3")
    examples = best.groupBy("brand").agg(F.array_sort(F.collect_list(F.struct("k", "model", "n"))).alias("_x"))
    shown = F.array_join(F.transform("_x", lambda x: F.concat_ws(":", x["model"], x["n"])), ",")
    return counts.groupBy("brand").agg(F.sum("n").alias("shaves")).join(examples, "brand").select("brand", "shaves", shown.alias("examples"))


@query("topk_search", """SELECT razor_brand || ' ' || razor_model AS product, count(*) AS shaves FROM posts WHERE contains(lower(razor_brand || ' ' || razor_model), lower('BOLT')) GROUP BY 1 ORDER BY shaves DESC, product LIMIT 100""", posts=True)
def topk_search(spark, sf):
    """The hundred most used products whose name holds a text, in any case."""
    name = F.concat_ws(" ", "razor_brand", "razor_model")
    found = posts(spark, sf).where(F.contains(F.lower(name), F.lower(F.lit("BOLT")))).groupBy(name.alias("product")).agg(F.count("*").alias("shaves"))
    return found.orderBy(F.desc("shaves"), "product").limit(100)


@query("yearly_product_summary", f"""WITH g AS (SELECT month, {RAZOR_NAME} AS product, count(*) AS shaves, count(DISTINCT author) AS users FROM posts WHERE month > '1999-03' AND month <= '2000-03' GROUP BY 1, 2),
    r AS (SELECT *, rank() OVER (PARTITION BY month ORDER BY shaves DESC, users DESC)::INTEGER AS rank FROM g) SELECT * FROM r WHERE product = 'Brand#7 red bolt' OR product LIKE '%cold gear'""", posts=True)
def yearly_product_summary(spark, sf, last="2000-03", products=("%cold gear", "Brand#7 red bolt")):
    """Use and rank of some products, by patterns of their names, in the twelve months up to one."""
    month = F.col("month")
    recent = posts(spark, sf).where((month > periods.months_before(F.lit(last), 12)) & (month <= last)).groupBy("month", F.expr(RAZOR_NAME).alias("product")).agg(F.count("*").alias("shaves"), F.count_distinct("author").alias("users"))
    wanted = [F.col("product").like(p) for p in products]
    return ranked(recent, [F.desc("shaves"), F.desc("users")], ["month"]).where(functools.reduce(operator.or_, wanted))


@query("observations", """WITH f AS (SELECT month, razor_format, count(*) AS n FROM posts GROUP BY 1, 2), t AS (SELECT month, sum(n) AS total FROM f GROUP BY 1), u AS (SELECT month, count(DISTINCT author) AS people FROM posts GROUP BY 1),
    r AS (SELECT f.month, razor_format, n, round_even(100.0 * n / total, 1) AS share, row_number() OVER (PARTITION BY f.month ORDER BY n DESC, razor_format) AS k FROM f JOIN t USING (month))
    SELECT r.month, max(razor_format) FILTER (k = 1) AS top_format, max(share) FILTER (k = 1) AS top_share, array_to_string(list(razor_format ORDER BY k) FILTER (k <= 5), ',') AS top_formats,
      any_value(CASE WHEN total / people >= 15 THEN 'high' WHEN total / people >= 10 THEN 'moderate' ELSE 'low' END) AS engagement FROM r JOIN t USING (month) JOIN u USING (month) GROUP BY 1""", posts=True)
def observations(spark, sf):
    """The leading format of each month with its share, the five first ones, and the level of engagement."""
    view = posts(spark, sf)
    formats = view.groupBy("month", "razor_format").agg(F.count("*").alias("n"))
    lists = formats.groupBy("month").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "razor_format", "n"))).alias("f"))
    per = F.col("total") / F.col("people")
    people = view.groupBy("month").agg(F.count_distinct("author").alias("people"))
    return lists.join(people, "month").select(
        "month",
        F.col("f")[0]["razor_format"].alias("top_format"),
        F.bround(100.0 * F.col("f")[0]["n"] / F.col("total"), 1).alias("top_share"),
        F.array_join(F.slice(F.transform("f", lambda x: x["razor_format"]), 1, 5), ",").alias("top_formats"),
        F.when(per >= 15, "high").when(per >= 10, "moderate").otherwise("low").alias("engagement"),
    )


@query("neighbor_lag_lead", """WITH d AS (SELECT DISTINCT p_name AS name FROM part WHERE p_name IS NOT NULL), w AS (SELECT name, lag(name) OVER (ORDER BY name) AS before, lead(name) OVER (ORDER BY name) AS after FROM d)
    SELECT name, before, after, levenshtein(name, before)::INTEGER AS to_before, levenshtein(name, after)::INTEGER AS to_after FROM w""")
def neighbor_lag_lead(spark, sf):
    """Names in order with the edit distance to their neighbours."""
    names = table(spark, sf, "part").select(F.col("p_name").alias("name")).where("name IS NOT NULL").distinct()
    pairs = similarity.with_neighbours(names, "name")
    return pairs.withColumns({"to_before": F.levenshtein("name", "before"), "to_after": F.levenshtein("name", "after")})


@query("add_rank_field", "SELECT s_name AS supplier, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_name)::INTEGER AS rank FROM supplier")
def add_rank_field(spark, sf):
    return numbered(table(spark, sf, "supplier"), [F.desc("s_acctbal"), F.asc("s_name")], ["s_nationkey"]).select(F.col("s_name").alias("supplier"), "s_acctbal", "rank")
