"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postmill.sources.posts import POSTS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, posts: bool = False) -> Callable[[Query], Query]:
    """Register a function of (spark, sf_dir); posts: the SQL is a body that reads the posts view."""

    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            # further common table expressions of the body join the list that begins with posts
            body = sql.strip()
            ORACLES[name] = (f"WITH {POSTS_SQL}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {POSTS_SQL} {body}") if posts else body
        return run

    return add
