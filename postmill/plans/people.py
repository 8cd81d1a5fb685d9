"""Queries about people: diversity, concentration, missed days, nested usage and monthly totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.operators import people
from postmill.operators.ranking import numbered, ranked
from postmill.plans.base import query
from postmill.sources.posts import dealt, posts, table

PRODUCTS = {
    "user_razor_diversity": ("unique_razors", "concat(razor_brand, ' ', razor_model)", "razor_brand IS NOT NULL"),
    "user_blade_diversity": ("unique_blades", "concat(blade_brand, ' ', blade_model)", "blade_brand IS NOT NULL"),
    "user_brush_diversity": ("unique_brushes", "concat_ws('|', handle_brand, handle_model, knot_brand)", "knot_brand IS NOT NULL"),
}
for _name, (_count, _product, _where) in PRODUCTS.items():

    @query(_name, f"""WITH g AS (SELECT month, author AS "user", count(DISTINCT {_product}) AS {_count}, count(*) AS shaves FROM posts WHERE {_where} GROUP BY 1, 2)
        SELECT *, round_even(shaves / {_count}, 1) AS avg_shaves_per_item, row_number() OVER (PARTITION BY month ORDER BY {_count} DESC, shaves DESC, "user")::INTEGER AS rank FROM g""", posts=True)
    def _diversity(spark, sf, count=_count, product=_product, where=_where):
        named = posts(spark, sf).where(where).select("month", "author", F.expr(product).alias("product"))
        found = people.diversity(dealt(spark, sf, named, "month", "author"), F.col("product"), ["month"], count)
        return numbered(found, [F.desc(count), F.desc("shaves"), F.asc("user")], ["month"])


@query("user_soap_brand_diversity", """WITH g AS (SELECT month, author AS "user", count(DISTINCT lower(soap_brand)) AS unique_brands, count(*) AS shaves FROM posts WHERE soap_brand IS NOT NULL GROUP BY 1, 2)
    SELECT *, round_even(shaves / unique_brands, 1) AS avg_shaves_per_item, rank() OVER (PARTITION BY month ORDER BY unique_brands DESC, shaves DESC)::INTEGER AS rank FROM g""", posts=True)
def user_soap_brand_diversity(spark, sf):
    found = people.diversity(posts(spark, sf).where("soap_brand IS NOT NULL"), F.lower("soap_brand"), ["month"], "unique_brands")
    return ranked(found, [F.desc("unique_brands"), F.desc("shaves")], ["month"])


CONCENTRATION_SQL = """WITH c AS (SELECT {p}, author AS "user", CASE WHEN countable THEN lower(soap_brand) || '|' || lower(soap_scent) END AS soap, count(*) AS n FROM posts GROUP BY 1, 2, 3),
    g AS (SELECT {p}, "user", count(soap) AS unique_combinations, sum(n)::BIGINT AS shaves, sum((n * n)::DOUBLE) FILTER (soap IS NOT NULL) AS squares FROM c GROUP BY 1, 2)
    SELECT {p}, "user", unique_combinations, shaves, round_even(shaves / unique_combinations, 2) AS avg_shaves_per_combination,
      round_even(squares / (shaves * shaves), 4) AS hhi, round_even(1 / (squares / (shaves * shaves)), 2) AS effective_soaps,
      rank() OVER (PARTITION BY {p} ORDER BY unique_combinations DESC{more})::INTEGER AS rank FROM g WHERE unique_combinations > 0"""


def _concentration(spark, sf, period, order):
    soap = F.concat_ws("|", F.lower("soap_brand"), F.lower("soap_scent"))
    return ranked(people.concentration(posts(spark, sf), soap, F.coalesce("countable", F.lit(True)), [period]), order, [period])


@query("user_soap_brand_scent_diversity", CONCENTRATION_SQL.format(p="month", more=", shaves DESC"), posts=True)
def user_soap_brand_scent_diversity(spark, sf):
    return _concentration(spark, sf, "month", [F.desc("unique_combinations"), F.desc("shaves")])


@query("annual_diversity", CONCENTRATION_SQL.format(p="year", more=""), posts=True)
def annual_diversity(spark, sf):
    return _concentration(spark, sf, "year", [F.desc("unique_combinations")])


@query("soap_sample_users", """WITH g AS (SELECT month, author AS "user", count(*) AS shaves FROM posts WHERE sample_type <> '' GROUP BY 1, 2)
    SELECT *, row_number() OVER (PARTITION BY month ORDER BY shaves DESC, "user")::INTEGER AS rank FROM g""", posts=True)
def soap_sample_users(spark, sf):
    counts = posts(spark, sf).where("sample_type <> ''").groupBy("month", F.col("author").alias("user")).agg(F.count("*").alias("shaves"))
    return numbered(counts, [F.desc("shaves"), F.asc("user")], ["month"])


MISSED_SQL = """WITH p AS (SELECT month, author AS "user", count(*) AS shaves, list(DISTINCT posted_date) AS posted FROM {source} GROUP BY 1, 2),
    m AS (SELECT month, "user", shaves, list_sort(list_filter(generate_series(strptime(month || '-01', '%Y-%m-%d'), last_day(strptime(month || '-01', '%Y-%m-%d'))::TIMESTAMP, INTERVAL 1 DAY),
      lambda d: NOT list_contains(posted, d::DATE))) AS missed FROM p)
    SELECT month, "user", shaves, len(missed)::BIGINT AS missed_days, coalesce(array_to_string(list_transform(missed, lambda d: strftime(d, '%Y-%m-%d')), ','), '') AS missed_dates,
      rank() OVER (PARTITION BY month ORDER BY len(missed), shaves DESC)::INTEGER AS rank FROM m"""


@query("users", MISSED_SQL.format(source="posts"), posts=True)
def users(spark, sf):
    return people.missed_days(posts(spark, sf))


def event_posts(spark, sf):
    return table(spark, sf, "events").select(F.concat(F.lit("u"), "user_id").alias("author"), F.to_date("ts").alias("posted_date"), F.date_format("ts", "yyyy-MM").alias("month"), "event_id")


EVENT_POSTS = "(SELECT 'u' || user_id AS author, ts::DATE AS posted_date, strftime(ts, '%Y-%m') AS month, event_id FROM events)"


@query("event_users", MISSED_SQL.format(source=EVENT_POSTS))
def event_users(spark, sf):
    return people.missed_days(event_posts(spark, sf))


@query("user_posting", f"""WITH d AS (SELECT posted_date, count(*) AS n, array_to_string(list_sort(list(event_id)), ',') AS ids FROM {EVENT_POSTS} WHERE author = 'u8' AND month = '2024-01' GROUP BY 1)
    SELECT strftime(g.d, '%Y-%m-%d') AS day, coalesce(n, 0) AS posts, coalesce(ids, '') AS comment_ids, n IS NULL AS missed
    FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(d) LEFT JOIN d ON d.posted_date = g.d::DATE""")
def user_posting(spark, sf):
    """One person's month day by day."""
    days = spark.range(1).select(F.explode(F.expr("sequence(date'2024-01-01', date'2024-01-31')")).alias("posted_date"))
    posted = event_posts(spark, sf).where("author = 'u8' AND month = '2024-01'").groupBy("posted_date").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return days.join(posted, "posted_date", "left").select(F.date_format("posted_date", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("posts"), F.coalesce("ids", F.lit("")).alias("comment_ids"), F.col("n").isNull().alias("missed"))


def _unpivoted(rows, *more):
    """One row per post and product used in it; more: other columns to keep."""
    kinds = F.array(
        F.struct(F.lit("razor").alias("kind"), F.concat_ws(" ", "razor_brand", "razor_model").alias("product")),
        F.struct(F.lit("blade").alias("kind"), F.concat_ws(" ", "blade_brand", "blade_model").alias("product")),
        F.struct(F.lit("brush").alias("kind"), F.concat_ws(" ", "handle_brand", "handle_model").alias("product")),
        F.struct(F.lit("soap").alias("kind"), F.concat_ws(" - ", "soap_brand", "soap_scent").alias("product")),
    )
    return rows.select(*more, "month", "author", "posted_date", F.explode(kinds).alias("x")).select(*more, "month", "author", "posted_date", "x.*")


UNPIVOT = """x AS (SELECT id, month, author, posted_date, unnest(['razor', 'blade', 'brush', 'soap']) AS kind,
    unnest([concat_ws(' ', razor_brand, razor_model), concat_ws(' ', blade_brand, blade_model), concat_ws(' ', handle_brand, handle_model), concat_ws(' - ', soap_brand, soap_scent)]) AS product FROM posts)"""


@query("user_analysis", f"""WITH {UNPIVOT}, g AS (SELECT month, author AS "user", kind, product, count(*) AS n FROM x GROUP BY 1, 2, 3, 4)
    SELECT month, "user", kind, count(*) AS products, sum(n)::BIGINT AS shaves, array_to_string(list(product || '=' || n ORDER BY n DESC, product), ';') AS usage FROM g GROUP BY 1, 2, 3""", posts=True)
def user_analysis(spark, sf):
    """What each person used in a month, most used first, as one list per kind.

    Posts are dealt out by month and person before they become four rows each, and all that follows needs no other shuffle.
    """
    rows = posts(spark, sf).select("month", "author", "posted_date", "razor_brand", "razor_model", "blade_brand", "blade_model", "handle_brand", "handle_model", "soap_brand", "soap_scent")
    used = _unpivoted(dealt(spark, sf, rows, "month", "author")).groupBy("month", F.col("author").alias("user"), "kind", "product").agg(F.count("*").alias("n"))
    lists = used.groupBy("month", "user", "kind").agg(F.count("*").alias("products"), F.sum("n").alias("shaves"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "product", "n"))).alias("_list"))
    return lists.withColumn("usage", F.array_join(F.transform("_list", lambda p: F.concat_ws("=", p["product"], p["n"])), ";")).drop("_list")


def _starts(made, field):
    """Where in posts that are sorted by a field its values begin, from 0."""
    return F.array_compact(F.transform(made, lambda p, i: F.when((i == 0) | ~p[field].eqNullSafe(F.get(made, i - 1)[field]), i)))


def _part(made, at, n):
    """n posts from `at` on, got one by one, as a slice would copy the whole array for each person."""
    return F.transform(F.sequence(at, at + n - 1), lambda i: F.get(made, i))


def _person_texts(people, made):
    """person=posts|days|ids for each person, by its posts from `at` on, as many as `less` is below 0; `alone` is the text of a single one."""
    name = lambda p: F.coalesce(F.concat(F.lit("u"), p["author"]), F.lit(""))
    own = lambda p: _part(made, p["at"], -p["less"])
    several = lambda p, x: F.concat(name(p), F.lit("="), -p["less"], F.lit("|"), F.array_join(F.array_distinct(x["posted_date"]).cast("array<string>"), ","), F.lit("|"), F.array_join(x["id"], ","))
    return F.array_join(F.transform(people, lambda p: F.when(p["less"] == -1, F.get(made, p["at"])["alone"]).otherwise(several(p, own(p)))), ";")


def _day_texts(starts, made):
    """day=ids for each day, of which a month has 31 at most."""
    ids = lambda a, k: F.slice(made, a + 1, F.coalesce(F.get(starts, k + 1), F.size(made)) - a)["id"]
    return F.array_join(F.transform(starts, lambda a, k: F.concat(F.get(made, a)["posted_date"], F.lit("="), F.array_join(ids(a, k), ","))), ";")


@query("product_usage", f"""WITH {UNPIVOT}, g AS (SELECT month, kind, product, author, count(*) AS n, coalesce(string_agg(DISTINCT posted_date::VARCHAR, ',' ORDER BY posted_date::VARCHAR), '') AS dates, string_agg(id, ',' ORDER BY posted_date NULLS FIRST, id) AS ids FROM x GROUP BY 1, 2, 3, 4),
    c AS (SELECT month, kind, product, posted_date, string_agg(id, ',' ORDER BY id) AS ids FROM x GROUP BY 1, 2, 3, 4),
    d AS (SELECT month, kind, product, count(posted_date) AS days, coalesce(string_agg(posted_date || '=' || ids, ';' ORDER BY posted_date), '') AS comments_by_date FROM c GROUP BY 1, 2, 3)
    SELECT g.month, kind, product, sum(n)::BIGINT AS total_usage, count(*) AS unique_users, max(n) AS most_by_one_user, arg_min(author, [-n, author[2:]::BIGINT]) AS top_user, any_value(days) AS days,
      string_agg(coalesce(author, '') || '=' || n || '|' || dates || '|' || g.ids, ';' ORDER BY n DESC, author[2:]::BIGINT NULLS FIRST) AS users, any_value(comments_by_date) AS comments_by_date
    FROM g JOIN d USING (kind, product) WHERE g.month IS NOT DISTINCT FROM d.month GROUP BY 1, 2, 3""", posts=True)
def product_usage(spark, sf):
    """Per month and product: posts, people, the heaviest user, the days on which it was used, all its people and all its posts by day.

    users has each person once, most posts first, as person=posts|days|ids; comments_by_date has day=ids, days in order. Posts
    without a date are in users only. Rows are dealt out by month and product once and gathered once; a product's month is one
    row of the result, and is put in order and cut into people and days within it.
    """
    key = ["month", "kind", "product"]
    rows = posts(spark, sf).select("id", "month", F.substring("author", 2, 20).cast("long").alias("author"), "posted_date", "razor_brand", "razor_model", "blade_brand", "blade_model", "handle_brand", "handle_model", "soap_brand", "soap_scent")
    alone = F.concat(F.coalesce(F.concat(F.lit("u"), "author"), F.lit("")), F.lit("=1|"), F.coalesce(F.col("posted_date").cast("string"), F.lit("")), F.lit("|"), "id")
    used = dealt(spark, sf, _unpivoted(rows, "id"), *key).select(*key, F.struct("author", "posted_date", "id", alone.alias("alone")).alias("_post"))
    # groups are made by a sort, which product alone decides most of
    used = used.groupBy("product", "month", "kind").agg(F.sort_array(F.collect_list("_post")).alias("_made"))
    used = used.withColumns({"_from": _starts(F.col("_made"), "author"), "_dated": F.sort_array(F.arrays_zip("_made.posted_date", "_made.id"))})
    less = lambda a, k: a - F.coalesce(F.get("_from", k + 1), F.size("_made"))
    people = F.transform("_from", lambda a, k: F.struct(less(a, k).alias("less"), F.get("_made", a)["author"].alias("author"), a.alias("at")))
    days = F.filter(_starts(F.col("_dated"), "posted_date"), lambda a: F.get("_dated", a)["posted_date"].isNotNull())
    used = used.withColumns({"_people": F.sort_array(people), "_days": days})
    top = F.get(F.filter("_people", lambda p: p["author"].isNotNull()), F.lit(0))["author"]
    return used.select(
        *key,
        F.size("_made").cast("long").alias("total_usage"),
        F.size("_people").cast("long").alias("unique_users"),
        (-F.get("_people", F.lit(0))["less"]).cast("long").alias("most_by_one_user"),
        F.concat(F.lit("u"), top).alias("top_user"),
        F.size("_days").cast("long").alias("days"),
        _person_texts(F.col("_people"), F.col("_made")).alias("users"),
        _day_texts(F.col("_days"), F.col("_dated")).alias("comments_by_date"),
    )


@query("month_metadata", """WITH u AS (SELECT month, author, count(*) AS n FROM posts GROUP BY 1, 2), m AS (SELECT month, round_even(median(n), 2) AS median_shaves_per_user FROM u GROUP BY 1)
    SELECT month, count(*) AS total_shaves, count(DISTINCT author) AS unique_shavers, round_even(count(*) / count(DISTINCT author), 2) AS avg_shaves_per_user, any_value(median_shaves_per_user) AS median_shaves_per_user,
      count(DISTINCT lower(soap_brand) || '|' || lower(soap_scent)) FILTER (countable) AS unique_soaps, count(DISTINCT lower(soap_brand)) AS unique_brands,
      count(*) FILTER (sample_type IS NOT NULL) AS total_samples, count(DISTINCT author) FILTER (sample_type IS NOT NULL) AS sample_users, count(DISTINCT lower(soap_brand)) FILTER (sample_type IS NOT NULL) AS sample_brands,
      count(DISTINCT lower(soap_brand) || '|' || lower(soap_scent)) FILTER (sample_type IS NOT NULL) AS unique_sample_soaps,
      count(DISTINCT razor_brand || '|' || razor_model) AS unique_razors, count(DISTINCT blade_brand || '|' || blade_model) AS unique_blades, count(DISTINCT handle_brand || '|' || handle_model) AS unique_brushes
    FROM posts JOIN m USING (month) GROUP BY month""", posts=True)
def month_metadata(spark, sf):
    """All totals of a month in one pass, with the median over people joined on."""
    view, sampled = posts(spark, sf), F.col("sample_type").isNotNull()
    soap = F.concat_ws("|", F.lower("soap_brand"), F.lower("soap_scent"))
    medians = view.groupBy("month", "author").agg(F.count("*").alias("n")).groupBy("month").agg(F.bround(F.median("n"), 2).alias("median_shaves_per_user"))
    totals = view.groupBy("month").agg(
        F.count("*").alias("total_shaves"),
        F.count_distinct("author").alias("unique_shavers"),
        F.bround(F.count("*") / F.count_distinct("author"), 2).alias("avg_shaves_per_user"),
        F.count_distinct(F.when(F.col("countable"), soap)).alias("unique_soaps"),
        F.count_distinct(F.lower("soap_brand")).alias("unique_brands"),
        F.count_if(sampled).alias("total_samples"),
        F.count_distinct(F.when(sampled, F.col("author"))).alias("sample_users"),
        F.count_distinct(F.when(sampled, F.lower("soap_brand"))).alias("sample_brands"),
        F.count_distinct(F.when(sampled, soap)).alias("unique_sample_soaps"),
        F.count_distinct(F.concat("razor_brand", F.lit("|"), "razor_model")).alias("unique_razors"),
        F.count_distinct(F.concat("blade_brand", F.lit("|"), "blade_model")).alias("unique_blades"),
        F.count_distinct(F.concat("handle_brand", F.lit("|"), "handle_model")).alias("unique_brushes"),
    )
    return totals.join(medians, "month")
