"""Exact top-k by inner product with a three-phase uniform threshold.

A score is the sum of LISTS partial scores, each over a slice of the components. Candidates and queries meet in blocks:
a query block is copied to every candidate block, and a candidate block to every query block, so that one task never
has more than a block of either. Phase 1: each meeting gathers the local score list of one slice, and its SEEDS best
entries are scored wholly; the k-th best of a query's over all meetings is a safe cutoff. Phase 2: an entry can reach
the cutoff only if one of its lists has cutoff / LISTS, the same threshold for all lists; each meeting collects those.
Phase 3: their lists are added up, no other entry's are, and what is below the cutoff goes. The k best of the rest are
exact; a meeting passes on no more than k entries of a query, so a vector that very many rows share adds no ties.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import cut

K, LISTS, SCALE = 5, 4, 256
#: Entries of a local list whose whole scores go into the cutoff.
SEEDS = 40
#: About so many candidates and queries meet in one task.
CANDIDATES, QUERIES = 8_192, 16_384
#: Of these, so many queries are scored at a time, which bounds a task's memory.
SLICE = 128


def usable(vector: str) -> Column:
    """Neither the vector nor a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(good, F.lit(False))


def scaled(vector: str) -> Column:
    """floor(256 x) of each component, in doubles; what that makes infinite counts as the largest double."""
    top = 1.7976931348623157e308

    def whole(x: Column) -> Column:
        y = x * float(SCALE)
        return F.when(F.abs(y) < 2.0**62, F.floor(y).cast("double")).otherwise(F.greatest(F.lit(-top), F.least(F.lit(top), y)))

    return F.transform(F.col(vector), whole)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _exact(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type that keeps every score exact: doubles, else Python's integers."""
    width = q.shape[1]
    if width and len(q) and len(c) and np.abs(q).max() * np.abs(c).max() * width >= 2.0**53:
        return tuple(np.vectorize(int, otypes=[object])(m) for m in (q, c))
    return q, c


def _slices(width: int) -> list[slice]:
    edges = [width * i // LISTS for i in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _list(q: np.ndarray, c: np.ndarray, part: slice) -> np.ndarray:
    """Partial scores of one slice: a row for each query."""
    return q[:, part] @ c[:, part].T if part.stop > part.start else np.zeros((len(q), len(c)), q.dtype)


def sufficient(lists: list[np.ndarray], cutoff: np.ndarray) -> np.ndarray:
    """Entries with a partial score that reaches the uniform threshold; no other can reach the cutoff."""
    threshold = cutoff[:, None] / LISTS
    threshold = threshold - 1e-9 * np.abs(threshold) - 1e-6  # rounding of the share must not lose an entry
    enough = lists[0] >= threshold
    for part in lists[1:]:
        enough |= part >= threshold
    return enough


OUT = "query_id long, vec_id long, score long, copies long"
LEAST, MOST = -(2**63), 2**63 - 1


def _entries(qi: np.ndarray, ci: np.ndarray, copies: np.ndarray, rows: np.ndarray, cols: np.ndarray, score: np.ndarray) -> pd.DataFrame:
    """Entries but for those of the query's own id; scores beyond a long are its ends."""
    other = qi[rows] != ci[cols]
    rows, cols, score = rows[other], cols[other], score[other]
    whole = np.array([max(LEAST, min(MOST, x)) for x in score], np.int64) if score.dtype == object else score.astype(np.int64)
    return pd.DataFrame({"query_id": qi[rows], "vec_id": ci[cols], "score": whole, "copies": copies[cols]})


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best entries of each query; no others of a block can be among the k best of all."""
    found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
    return found[found.groupby("query_id").cumcount() < k]


def _meeting(queries: pd.DataFrame, candidates: pd.DataFrame, k: int, entries) -> pd.DataFrame:
    """The best of what `entries` yields for SLICE queries at a time."""
    found = [pd.DataFrame({c.split()[0]: [] for c in OUT.split(", ")}).astype("int64")]
    if len(candidates) and len(queries):
        width = max([0, *map(len, queries["q_v"]), *map(len, candidates["v"])])
        asked, held = _exact(_matrix(queries["q_v"], width), _matrix(candidates["v"], width))
        qi, ci, copies = queries["q_id"].to_numpy(), candidates["id"].to_numpy(), candidates["copies"].to_numpy()
        for at in range(0, len(qi), SLICE):
            part = slice(at, at + SLICE)
            rows, cols, score = entries(asked[part], held, part)
            found.append(_best(_entries(qi[part], ci, copies, rows, cols, score), k))
    return pd.concat(found)


def _gather(k: int):
    def run(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        def entries(q, c, _):
            slices = _slices(q.shape[1])
            local = _list(q, c, slices[sum(key) % LISTS])
            most = min(max(SEEDS, k + 1), c.shape[0])
            order = np.argpartition(-local, most - 1, axis=1)[:, :most]
            rows = np.repeat(np.arange(len(q)), most)
            cols = order.ravel()
            return rows, cols, (q[rows] * c[cols]).sum(axis=1)

        return _meeting(queries, candidates, k, entries)

    return run


def _resolve(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        cutoffs = queries["cutoff"].to_numpy(np.float64, na_value=-np.inf)
        cutoffs[cutoffs <= LEAST] = -np.inf
        least = cutoffs - 1e-12 * np.abs(cutoffs) - 1  # as doubles they may be rounded

        def entries(q, c, part):
            lists = [_list(q, c, s) for s in _slices(q.shape[1])]
            rows, cols = np.nonzero(sufficient(lists, cutoffs[part]))
            score = lists[0][rows, cols]
            for other in lists[1:]:
                score = score + other[rows, cols]
            keep = np.flatnonzero(score >= least[part][rows])
            return rows[keep], cols[keep], score[keep]

        return _meeting(queries, candidates, k, entries)

    return run


def _meet(queries: DataFrame, candidates: DataFrame, run, q_blocks: int, c_blocks: int) -> DataFrame:
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # own column names, since both sides come from one table
    q = queries.withColumnsRenamed({"id": "q_id", "v": "q_v"})
    q = q.withColumn("_qb", F.pmod(F.xxhash64("q_id"), F.lit(q_blocks)).cast("int")).withColumn("_cb", every(c_blocks))
    c = candidates.withColumn("cb", F.pmod(F.xxhash64("id", "v"), F.lit(c_blocks)).cast("int")).withColumn("qb", every(q_blocks))
    return q.groupBy("_qb", "_cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(run, OUT)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k best candidates of each query row: query_id, rank, vec_id, score.

    Components count as floor(256 x). Candidates are all rows with another id, each as often as it is repeated; ties go
    to the smaller id, and a query with fewer candidates gets them all. Query rows alike in id and vector are one query;
    those of one id with several vectors get the k best of all of them. Rows whose id or vector is null, or with a null
    or non-finite component, take no part; vectors of unlike length meet as if the shorter ended in zeros. Scores are
    exact, and those beyond the range of a long count as its end.
    """
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull()).where(usable("v")).withColumn("v", scaled("v"))
    rows = cut(rows.groupBy("id", "v").agg(F.count("*").alias("copies"), F.max("asks").alias("asks")))
    candidates, queries = rows.select("id", "v", "copies"), rows.where("asks").select("id", "v")
    count = rows.agg(F.count("*").alias("c"), F.count_if("asks").alias("q")).first()
    blocks = max(1, -(-count["q"] // QUERIES)), max(1, -(-count["c"] // CANDIDATES))
    gathered = _meet(queries, candidates, _gather(k), *blocks)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    cutoffs = gathered.withColumn("_n", F.row_number().over(place)).where(F.col("_n") == k).select(F.col("query_id").alias("id"), F.col("score").alias("cutoff"))
    asked = queries.join(cut(cutoffs), "id", "left")
    resolved = _meet(asked, candidates, _resolve(k), *blocks)
    # each row of a candidate is an entry of its own
    resolved = resolved.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return resolved.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
