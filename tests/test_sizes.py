"""Whole jobs, and plans that keep their size in bounds on large tables."""

import duckdb
from pyspark.sql import functions as F

from postmill.operators import extraction
from postmill.plans.parts import curated
from postmill.plans.people import _unpivoted
from postmill.plans.registry import ORACLES, QUERIES
from postmill.sources.posts import joined_posts, posts
from postmill.streaming import events as streams
from tests.compare import assert_same

SF = "/root/testdata/sf0.001"


def test_known_splits_are_all_there(spark):
    """Also the entries that must not be split; splits_guard keeps these from other cuts."""
    got = {r["t"].lower() for r in QUERIES["known_split"](spark, SF).collect()}
    entries = {(r["entry"].lower(), r["keep_whole"]) for r in curated(spark, SF).collect()}
    assert {k for _, k in entries} == {True, False}
    assert got == {e for e, _ in entries}


def test_the_view_is_written_without_a_sort(spark):
    """Folders by year would sort whole wide rows in each task of the write."""
    view = posts(spark, SF)
    assert not [f for f in view.inputFiles() if "year=" in f]
    made = joined_posts(spark, SF).select(*view.columns)
    assert view.exceptAll(made).isEmpty() and made.exceptAll(view).isEmpty()


def test_brush_texts_are_scored_once_and_in_many_tasks(spark):
    """One scoring for all posts of a text; no filter on candidates that computes them again; no small texts put in one task."""
    plans = {n: QUERIES[n](spark, SF)._jdf.queryExecution().optimizedPlan().toString() for n in ("brush_score", "learning_report", "strategy_optimizer", "auto_split")}
    for name, plan in plans.items():
        assert "Repartition 4, true" in plan, name
        assert not [line for line in plan.splitlines() if "Filter" in line and "lambda" in line], name
    assert plans["brush_score"].index("Join LeftOuter") < plans["brush_score"].index("array_max") < plans["brush_score"].index("Aggregate")


def test_people_are_counted_after_the_shuffle(spark):
    """No task fills its memory with counts of keys that hardly any two of its rows share."""
    for name in ("user_analysis", "product_usage", "user_razor_diversity", "user_blade_diversity"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        first = min(n for n, line in enumerate(plan.splitlines()) if "REPARTITION_BY_NUM" in line)
        assert not [line for line in plan.splitlines()[first:] if "Aggregate" in line], name


def test_product_usage_has_all_people_and_posts(spark):
    """Not only the first person and a number of days: each post is there under its person and under its day."""
    people, days = set(), set()
    for r in QUERIES["product_usage"](spark, SF).collect():
        users = [u.replace("=", "|", 1).split("|") for u in r.users.split(";")]
        at = [d.split("=") for d in r.comments_by_date.split(";")]
        assert (len(users), users[0][:2], sum(int(u[1]) for u in users), len(at)) == (r.unique_users, [r.top_user, str(r.most_by_one_user)], r.total_usage, r.days)
        assert all(int(n) == len(ids.split(",")) and set(on.split(",")) <= {d for d, _ in at} for _, n, on, ids in users)
        people |= {(r.month, r.kind, r.product, user, i) for user, _, _, ids in users for i in ids.split(",")}
        days |= {(r.kind, r.product, d, i) for d, ids in at for i in ids.split(",")}
    want = _unpivoted(posts(spark, SF), "id").collect()
    assert people == {(r.month, r.kind, r.product, r.author, r.id) for r in want}
    assert days == {(r.kind, r.product, str(r.posted_date), r.id) for r in want}


def test_product_usage_of_odd_posts(spark, tmp_path):
    """Busy products, posts twice over, posts without a date, a person, or a product."""
    con = duckdb.connect()
    for name, sql in {
        "orders": f"SELECT * REPLACE (CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS o_orderdate, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 13 END AS o_custkey) FROM '{SF}/orders.parquet'",
        "lineitem": f"SELECT * REPLACE (l_suppkey % 2 AS l_suppkey) FROM read_parquet(['{SF}/lineitem.parquet', '{SF}/lineitem.parquet'])",
        "part": f"SELECT * REPLACE (CASE WHEN p_partkey % 3 > 0 THEN 'one' END AS p_name, CASE WHEN p_partkey % 2 > 0 THEN 'Busy' END AS p_brand) FROM '{SF}/part.parquet'",
    }.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    assert_same(QUERIES["product_usage"](spark, str(tmp_path)), ORACLES["product_usage"], con)


def test_an_upsert_writes_few_files_in_ranges_of_buckets(spark, tmp_path):
    """Not one file for each bucket and task; a later batch finds its buckets, which stay in one file each."""
    rows = spark.range(10_000).select(F.col("id").alias("event_id"), F.lit("2000-01-01").cast("timestamp").alias("ts"), F.lit(1).alias("value"))
    later = rows.where("event_id IN (15, 9995)").withColumns({"ts": F.lit("2000-01-02").cast("timestamp"), "value": F.lit(2)})
    for frame in (rows, later, later.where("false")):
        frame.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("event_id long, ts timestamp, value int").parquet(str(tmp_path / "in"))
        streams.upsert_into(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), width=10).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("version=0/**/*.parquet"))) <= 4
    assert {r.version: r["count"] for r in table.groupBy("version").count().collect()} == {0: 10_000, 1: 20}
    places = table.where("version = 0").select("bucket", F.input_file_name().alias("file")).distinct()
    assert places.groupBy("bucket").count().where("count > 1").isEmpty()
    got = {r.event_id: r.value for r in streams.newest(table).collect()}
    assert len(got) == 10_000 and all(got[i] == (2 if i in (15, 9995) else 1) for i in got)


def test_fields_are_searched_once(spark):
    """A body is searched once for a marked line and once for a bare one; rows with overrides are sorted by their ids first."""
    plan = QUERIES["extract_override"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("razor[ ]+test") == 1 and plan.count(":=*_") == 1
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert join.index("(id#") < join.index("(month#")
    assert extraction.needed_words(("x", "long x", "one three", "y")) == ["x", "y", "three"]
