"""Ranked lexical search over inverted treaps.

Documents are dealt to shards of a bounded number of postings, and items to blocks, which meet shard by shard; statistics
and weights are those of all documents. In a shard each term has a treap of its postings: in search order by document, in
heap order by impact, so that a treap's root has the greatest impact of a whole stretch of documents. An item's treaps are
traversed together. A stretch of documents carries the root of each treap below it, and no document of it can score
more than the sum of the roots' weighted impacts. The stretch with the greatest sum goes on: the document of its
weightiest root is scored exactly and parts it in two, whose roots are found by descending. Stretches whose sum cannot
enter the k best are pruned. The k best of each shard hold the k best of all.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from postmill.llm.common import cut_table, drop_table

K = 10
#: About so many postings of a shard, and items of a block.
POSTINGS, ITEMS = 2_000_000, 4_096
#: Cells of the map of the items' terms that tasks look terms up in, and terms whose answer a task keeps.
CELLS, HELD = 1 << 18, 500_000
#: Stretches that are parted at a time.
STEP = 64
#: Of a text's bytes, those that are part of a term, with A to Z lower-cased; all others are blanks.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text in order."""
    return (text or "").encode().translate(FOLD).split()


def _lists(rows: list[list], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array([x for r in rows for x in r], kind))


def counted_terms(texts: DataFrame, cells: bytes | None = None) -> DataFrame:
    """Of texts (key, text): key, n (terms with repeats), and the distinct terms with their counts; only those whose cell is set, where cells are given."""
    schema = StructType([StructField("key", texts.schema["key"].dataType), *StructType.fromDDL("n long, terms array<string>, counts array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        for batch in batches:
            sizes, terms, counts = [], [], []
            for value in batch["text"]:
                every = terms_of(value.as_py())
                found = Counter(every)
                if cells is not None:
                    if len(known) > HELD:
                        known.clear()
                    for t in found:
                        if t not in known:
                            cell = zlib.crc32(t) % CELLS
                            known[t] = bool(cells[cell >> 3] >> (cell & 7) & 1)
                    found = {t: c for t, c in found.items() if known[t]}
                sizes.append(len(every))
                terms.append(list(found))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(sizes, pa.int64()), _lists(terms, pa.string()), _lists(counts, pa.int64())], names=["key", "n", "terms", "counts"])

    return texts.mapInArrow(run, schema)


def cells_of(terms: DataFrame) -> bytes:
    """A map of CELLS bits with those of the terms set. It has one size for any number of terms; where it is full, nothing is passed over."""
    out = bytearray(CELLS >> 3)
    for row in terms.select((F.crc32("term") % CELLS).cast("int").alias("cell")).distinct().collect():  # CELLS rows at most
        out[row.cell >> 3] |= 1 << (row.cell & 7)
    return bytes(out)


class Treaps:
    """A treap for each term of a shard: postings in order of term and document, linked into heaps by impact."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int) -> None:
        self.docs = docs
        self.place = term * docs + doc
        order = np.argsort(self.place)
        self.place, self.doc, self.impact = self.place[order], doc[order], impact[order]
        n = len(order)
        term = term[order]
        # equal impacts are told apart by a hash, which keeps the treaps flat
        mixed = (np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << 40) - 1)
        rank = (self.impact << 40) + mixed.astype(np.int64)  # impacts are below a million, and an odd factor keeps places apart
        before, after = _greater(rank, term, -1), _greater(rank, term, 1)
        high = lambda at: np.where(at >= 0, rank[at], -1)
        under_before = high(before) <= high(after)
        under_before = np.where(before < 0, False, np.where(after < 0, True, under_before))
        self.left, self.right, self.root = np.full(n + 1, -1), np.full(n + 1, -1), np.full(terms + 1, -1)
        at = np.arange(n)
        self.right[before[under_before]] = at[under_before]
        under_after = ~under_before & (after >= 0)
        self.left[after[under_after]] = at[under_after]
        top = (before < 0) & (after < 0)
        self.root[term[top]] = at[top]
        # a last posting stands for none
        self.doc, self.impact = np.append(self.doc, -1), np.append(self.impact, 0)

    def within(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Roots of the parts of treaps that lie from low to before high, by descending; -1 where there is none."""
        nodes = nodes.copy()
        flat, lows, highs = nodes.reshape(-1), np.repeat(low, nodes.shape[1]), np.repeat(high, nodes.shape[1])
        open_ = np.flatnonzero(flat >= 0)
        while open_.size:
            d = self.doc[flat[open_]]
            over, under = d >= highs[open_], d < lows[open_]
            open_ = open_[over | under]
            over = over[over | under]
            flat[open_] = np.where(over, self.left[flat[open_]], self.right[flat[open_]])
            open_ = open_[flat[open_] >= 0]
        return nodes

    def impacts(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Impact of each term (columns) in each document (rows), 0 where it has none."""
        want = terms[None, :] * self.docs + docs[:, None]
        at = np.minimum(np.searchsorted(self.place, want), len(self.place) - 1)
        return np.where(self.place[at] == want, self.impact[at], 0)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents, with scores above 0: greatest score first, then least document."""
        found_docs, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low, high, nodes = np.zeros(1, np.int64), np.full(1, self.docs), self.root[terms][None, :]
        bound = (self.impact[nodes] * weights).sum(axis=1)
        while True:
            # what ties with the k-th best can only enter by a smaller document
            if len(found) == k:
                may = (bound > found[-1]) | ((bound == found[-1]) & (low < found_docs[-1]))
            else:
                may = bound > 0
            low, high, nodes, bound = low[may], high[may], nodes[may], bound[may]
            if not len(bound):
                return found_docs, found
            now = np.argpartition(-bound, STEP - 1)[:STEP] if len(bound) > STEP else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[now] = False
            a, b, mine = low[now], high[now], nodes[now]
            heavy = np.argmax(self.impact[mine] * weights, axis=1)
            pivot = self.doc[mine[np.arange(len(now)), heavy]]
            score = (self.impacts(terms, pivot) * weights).sum(axis=1)
            found_docs, found = np.concatenate([found_docs, pivot]), np.concatenate([found, score])
            order = np.lexsort((found_docs, -found))
            order = order[found[order] > 0][:k]
            found_docs, found = found_docs[order], found[order]
            new_low, new_high = np.concatenate([a, pivot + 1]), np.concatenate([pivot, b])
            parts = self.within(np.concatenate([mine, mine]), new_low, new_high)
            low, high, nodes = np.concatenate([low[rest], new_low]), np.concatenate([high[rest], new_high]), np.concatenate([nodes[rest], parts])
            bound = np.concatenate([bound[rest], (self.impact[parts] * weights).sum(axis=1)])


def _greater(rank: np.ndarray, group: np.ndarray, step: int) -> np.ndarray:
    """Of each place the nearest one in a direction with a greater rank in its group, or -1. Places that are passed hand on where they look next."""
    n = len(rank)
    look = np.arange(n) + step
    look[look >= n] = -1
    good = look >= 0
    look[good & (group[look] != group)] = -1
    open_ = np.flatnonzero(look >= 0)
    while (open_ := open_[(look[open_] >= 0) & (rank[look[open_]] <= rank[open_])]).size:
        look[open_] = look[look[open_]]
    return look


def _search(item_type: pa.DataType, key_type: pa.DataType, k: int):
    schema = pa.schema([("item", item_type), ("key", key_type), ("score", pa.int64())])

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        if not held.num_rows or not asked.num_rows:
            return schema.empty_table()
        held = held.combine_chunks().sort_by("key")  # nulls last
        lists = held["terms"].combine_chunks()
        coded = lists.flatten().dictionary_encode()
        size = np.diff(lists.offsets.to_numpy())
        doc = np.repeat(np.arange(held.num_rows), size)
        count, m = held["counts"].combine_chunks().flatten().to_numpy(), held["m"].to_numpy()[doc]
        code = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        treaps = Treaps(coded.indices.to_numpy().astype(np.int64), doc, 1_000_000_000 * count // (1_000 * count + 8 * m), len(code), held.num_rows)
        rows, docs, scores = [], [], []
        for i, terms in enumerate(asked["weighted"].to_pylist()):
            mine = [(code[t["term"]], t["w"]) for t in terms if t["term"] in code]
            if mine:
                found, score = treaps.best(*np.array(sorted(mine), np.int64).T, k)
                rows.append(np.full(len(found), i))
                docs.append(found)
                scores.append(score)
        if not rows:
            return schema.empty_table()
        columns = [asked["item"].take(pa.array(np.concatenate(rows))), held["key"].take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))]
        return pa.table([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def ranked_search(items: DataFrame, docs: DataFrame, k: int = K, item_id: str = "item_id", item_text: str = "text", key: str = "doc_id", text: str = "text", postings: int = POSTINGS) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score.

    Terms are runs of digits, Latin letters and whatever is not ASCII, with A to Z lower-cased. A document scores the sum
    of its weights by impacts over the item's distinct terms; equal scores go by ascending doc_id, a null one last. Null
    and empty texts have no terms; an item without any that occur gets no rows. Each row is a document of its own, also
    where ids repeat; rows of one item_id, null too, are one item with all their terms.
    """
    asked = counted_terms(items.select(F.col(item_id).alias("key"), F.col(item_text).alias("text")))
    asked = cut_table(asked.select(F.col("key").alias("item"), F.explode("terms").alias("term")).distinct())
    cells = cells_of(asked)
    held = cut_table(counted_terms(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), cells).where("n > 0"))
    total = held.agg(F.count("*").alias("docs"), F.sum("n").alias("terms"), F.sum(F.size("terms")).alias("postings")).first()
    held_in = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    ratio = F.lit(2 * total["docs"] + 2).cast("double") / (2 * F.col("df") + 1)
    weighed = asked.join(held_in, "term").withColumn("w", F.floor(1000 * F.log(ratio)))
    block = F.pmod(F.xxhash64("item"), F.lit(-(-asked.select("item").distinct().count() // ITEMS) or 1))
    weighed = cut_table(weighed.groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("weighted")).withColumn("block", block.cast("int")))

    shards = max(1, -(-(total["postings"] or 0) // postings))
    blocks = weighed.agg(F.max("block")).first()[0]
    m = F.expr(f"10 + (90 * n * {total['docs']}L) div {total['terms'] or 1}L")
    shelved = held.withColumn("shard", F.pmod(F.xxhash64("key", "terms", "counts"), F.lit(shards)).cast("int")).withColumn("m", m)
    shelved = shelved.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))))
    every = weighed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    schema = StructType([StructField("item", items.schema[item_id].dataType), StructField("key", docs.schema[key].dataType), StructField("score", LongType())])

    search = _search(to_arrow_type(schema["item"].dataType), to_arrow_type(schema["key"].dataType), k)
    best = shelved.groupBy("shard", "block").cogroup(every.groupBy("shard", "block")).applyInArrow(search, schema)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = cut_table(best)
    for done in (asked, held, weighed):
        drop_table(done)
    ranked = best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_id), "rank", F.col("key").alias(key), "score")
