"""Whole reports by month and year, months as files, nested tables made anew, and the order of dependent strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators import periods, strategies
from postmill.operators.categories import SPECS, category_table
from postmill.operators.ranking import tie_marks, within_ranks
from postmill.plans.base import query
from postmill.plans.categories import category_sql
from postmill.plans.people import product_usage, user_analysis
from postmill.sources import store
from postmill.sources.posts import posts, table

#: Sections of a report: category and the column that names a row.
SECTIONS = {"razors": "name", "blades": "name", "soap_makers": "brand", "brush_fibers": "fiber"}
MONTH, YEAR, RANKS = "2000-03", 2000, 10


def report(view: DataFrame, period: str, at: str | int, before: str | int, ranks: int) -> DataFrame:
    """The first ranks of each section in a period, with the mark of a tie and the move against an earlier period."""
    parts = []
    for name, key in SECTIONS.items():
        tables = category_table(view.where(F.col(period).isin(at, before)), SPECS[name], period)
        then = tables.where(F.col(period) == before).select(key, F.col("rank").alias("_then"))
        now = tie_marks(tables.where(F.col(period) == at), [period]).join(then, key, "left")
        move = periods.move_text(F.col("_then") - F.col("rank"))
        parts.append(within_ranks(now, ranks).select(F.lit(name).alias("section"), F.col(key).alias("name"), "rank", "rank_text", "shaves", "unique_users", move.alias("move")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _report_sql(period: str, at: str, before: str) -> str:
    def part(name: str, key: str) -> str:
        source = category_sql(SPECS[name], period)
        return f"""SELECT '{name}' AS section, a.{key} AS name, a.rank, a.rank || CASE WHEN count(*) OVER (PARTITION BY a.rank) > 1 THEN '=' ELSE ' ' END AS rank_text, a.shaves, a.unique_users,
            CASE WHEN b.rank IS NULL THEN 'n/a' WHEN b.rank > a.rank THEN '↑' || (b.rank - a.rank) WHEN b.rank < a.rank THEN '↓' || (a.rank - b.rank) ELSE '=' END AS move
            FROM (SELECT * FROM ({source}) WHERE {period} = {at}) a LEFT JOIN (SELECT * FROM ({source}) WHERE {period} = {before}) b ON a.{key} = b.{key} QUALIFY a.rank <= {RANKS}"""

    return " UNION ALL ".join(f"SELECT * FROM ({part(n, k)})" for n, k in SECTIONS.items())


@query("report_monthly", _report_sql("month", f"'{MONTH}'", "'2000-02'"), posts=True)
def report_monthly(spark, sf, month=MONTH, before="2000-02", ranks=RANKS):
    """All sections of a month with their moves against another month."""
    return report(posts(spark, sf), "month", month, before, ranks)


@query("report_annual", _report_sql("year", str(YEAR), str(YEAR - 1)), posts=True)
def report_annual(spark, sf, year=YEAR, ranks=RANKS):
    """All sections of a year with their moves against the year before."""
    return report(posts(spark, sf), "year", year, year - 1, ranks)


@query("scan_month_json", "SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def scan_month_json(spark, sf):
    """Events as JSON files of months, written and read back with a schema; a filter on month reads its folders only."""
    place = store.scratch(spark, "months")
    rows = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM").alias("month"), "event_id", "event_type", "value")
    store.write_month_json(rows, place)
    found = store.read_month_rows(spark, place, "event_id long, event_type string, value double")
    return found.groupBy("month", "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"))


@query("regenerate_nested", """WITH x AS (SELECT month, author, unnest(['razor', 'blade', 'brush', 'soap']) AS kind, unnest([concat_ws(' ', razor_brand, razor_model), concat_ws(' ', blade_brand, blade_model), concat_ws(' ', handle_brand, handle_model), concat_ws(' - ', soap_brand, soap_scent)]) AS product FROM posts)
    SELECT month, kind, 'user_analysis' AS made, count(DISTINCT author) AS rows, count(*)::BIGINT AS shaves FROM x GROUP BY 1, 2 UNION ALL SELECT month, kind, 'product_usage', count(DISTINCT product), count(*)::BIGINT FROM x GROUP BY 1, 2""", posts=True)
def regenerate_nested(spark, sf):
    """Both nested tables of all months made anew, month by month in place of the old ones, and what is then in them."""
    place, parts = store.scratch(spark, "nested"), []
    for name, made, shaves in (("user_analysis", user_analysis(spark, sf), "shaves"), ("product_usage", product_usage(spark, sf), "total_usage")):
        store.write_months(made, f"{place}/{name}")
        written = spark.read.schema(made.schema).parquet(f"{place}/{name}")
        parts.append(written.groupBy("month", "kind").agg(F.count("*").alias("rows"), F.sum(shaves).alias("shaves")).withColumn("made", F.lit(name)))
    return parts[0].unionByName(parts[1])


#: Which strategies need which others to have found something.
NEEDS: dict[str, tuple[str, ...]] = {"known": (), "handle": (), "knot": (), "split": ("handle", "knot"), "full": ("split",), "fallback": ("known", "full")}


@query("strategy_deps", """WITH p AS (SELECT id, use_count AS n FROM posts), ok AS (SELECT id, n % 3 = 0 AS known, n % 2 = 0 AS handle, n % 5 > 0 AS knot, n % 7 > 0 AS split, n % 4 > 0 AS full_, true AS fallback FROM p),
    a AS (SELECT id, known, handle, knot, split AND handle AND knot AS split, full_, fallback FROM ok), b AS (SELECT * REPLACE (full_ AND split AS full_) FROM a), c AS (SELECT * REPLACE (fallback AND known AND full_ AS fallback) FROM b)
    SELECT id, array_to_string(list_filter([CASE WHEN known THEN 'known' END, CASE WHEN handle THEN 'handle' END, CASE WHEN knot THEN 'knot' END, CASE WHEN split THEN 'split' END, CASE WHEN full_ THEN 'full' END, CASE WHEN fallback THEN 'fallback' END], lambda s: s IS NOT NULL), ',') AS ran FROM c""", posts=True)
def strategy_deps(spark, sf):
    """Strategies that find something in a post, in an order in which each comes after those that it needs."""
    n = F.col("use_count")
    found = {"known": n % 3 == 0, "handle": n % 2 == 0, "knot": n % 5 > 0, "split": n % 7 > 0, "full": n % 4 > 0, "fallback": F.lit(True)}
    return posts(spark, sf).select("id", F.array_join(strategies.run_in_order(found, NEEDS), ",").alias("ran"))
