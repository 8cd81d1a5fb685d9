"""Streams run over the events as far as they are there; each result has the rows that a batch query gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.plans.base import query
from postmill.sources.store import scratch
from postmill.streaming import events as streams


def _place(spark) -> str:
    """A new folder that all executors share."""
    return scratch(spark, "stream")


def _events(spark, sf):
    return streams.read_stream(spark, sf, "events.parquet")


@query("stream_daily", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events WHERE ts < (SELECT date_trunc('day', max(ts) - INTERVAL 1 DAY) FROM events) GROUP BY 1, 2")
def stream_daily(spark, sf):
    """Finished days only: those that end before the newest event less the watermark's day."""
    place = _place(spark)
    found = streams.run_to_table(streams.daily(_events(spark, sf)), f"{place}/out", f"{place}/checkpoint")
    return found.select("day", "event_type", "events", F.round("total", 4).alias("total"))


@query("stream_sessions", """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS start FROM events), s AS (SELECT user_id, ts, sum(start) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM o),
    g AS (SELECT user_id, k, count(*) AS events, max(ts) + INTERVAL 6 HOUR AS until FROM s GROUP BY 1, 2) SELECT user_id, count(*) AS sessions, sum(events)::BIGINT AS events FROM g WHERE until <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1""")
def stream_sessions(spark, sf):
    place = _place(spark)
    found = streams.run_to_table(streams.sessions(_events(spark, sf)), f"{place}/out", f"{place}/checkpoint")
    return found.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("events").alias("events"))


@query("stream_once", "SELECT event_id, user_id FROM events")
def stream_once(spark, sf):
    place = _place(spark)
    return streams.run_to_table(streams.once(_events(spark, sf)).select("event_id", "user_id"), f"{place}/out", f"{place}/checkpoint")


@query("stream_upsert", "SELECT event_id, user_id, event_type FROM events")
def stream_upsert(spark, sf):
    place = _place(spark)
    streams.upsert_into(_events(spark, sf), f"{place}/table", f"{place}/checkpoint").awaitTermination()
    return streams.newest(spark.read.parquet(f"{place}/table")).select("event_id", "user_id", "event_type")
