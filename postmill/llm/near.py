"""MinHash near-duplicate detection: one-permutation hashing with optimal densification, bands, and star edges.

One hash per shingle is dealt to BINS bins by its high bits; the least of each bin is its value, and an empty bin takes
that of the first filled one in an order of its own. Equal shingle sets collapse to one node first, so exact copies make
no pairs. Nodes that agree in all values of a band share a bucket. Each bucket is a star around its least node, and a
node is compared with the one centre with which it shares most buckets. Buckets that still span several components get
new stars around a few drawn members, round after round, as long as many pairs are left and a round halves their number.
What is left after that, the members outside a bucket's largest component, is compared with the members of other
components, so no link between bucket mates is lost. Which of these pairs go on is decided within the join by parity
sketches: each shingle flips one of ODD bits, so two sketches differ in no more bits than their sets differ in shingles,
and a pair whose sketches differ in more bits than a link allows is none for certain. Links are confirmed on the full
shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut, cut_table, drop_table

#: 42 bands of 6: a pair at similarity 0.8 shares no bucket with a chance of 3 in a million, one at 0.3 shares one with 3 in 100.
BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
#: Bits of a parity sketch.
ODD = 1024
WORDS = range(ODD // 64)
#: Centres of an open bucket in a round of stars, pairs a member below which no round is needed, and members in a block of the pairs that are left.
CENTRES, FEW, BLOCK = 8, 64, 1000
#: Words of a shingle, and the least similarity of a link in hundredths.
SHINGLE, PERCENT = 2, 80
#: Words whose hashes a task keeps.
HELD_WORDS = 500_000
K1, K2, K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * K3
    h = (h ^ (h >> np.uint64(29))) * K1
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of a text; fewer words than a shingle make one, no words none."""

    def __init__(self, size: int) -> None:
        self.size, self.known = size, {}

    def __call__(self, text: str) -> np.ndarray:
        import xxhash

        words, known = text.encode().lower().split(), self.known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > HELD_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        n = len(words) - size + 1
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = _mixed(out * K2 + h[k : k + n])
        return np.unique(out)


def _order(attempt: int, bins: int) -> np.ndarray:
    """Which bin each empty bin asks at an attempt."""
    return (_mixed(np.arange(bins, dtype=np.uint64) * K2 + np.uint64(attempt + 1)) % np.uint64(bins)).astype(np.int64)


def densified(hashes: np.ndarray, bins: int, orders: list[np.ndarray]) -> np.ndarray:
    """One value for each bin from sorted distinct hashes, of which there is one at least."""
    at = ((hashes >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    values, filled = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    values[at[first]], filled[at[first]] = hashes[first], True
    empty, attempt = np.flatnonzero(~filled), 0
    while len(empty):
        if attempt == len(orders):
            orders.append(_order(attempt, bins))
        ask = orders[attempt][empty]
        good = filled[ask]
        values[empty[good]] = values[ask[good]]
        empty, attempt = empty[~good], attempt + 1
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = values.reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        key = _mixed(key * K2 + parts[:, k])
    return key.view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as ODD / 64 whole numbers."""
    bits = np.bincount((hashes & np.uint64(ODD - 1)).astype(np.int64), minlength=ODD) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


SIGNED = "id long, n long, sig binary, buckets array<long>, odd array<long>"


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Of each row (id, text): the size of its shingle set, the set's 128-bit digest, its band keys and its parity sketch; all null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingles, orders = Shingler(shingle), []
        for batch in batches:
            sizes, digests, keys, odd = [], [], [], []
            for value in batch["text"]:
                h = shingles(value.as_py() or "")
                sizes.append(len(h))
                digests.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                keys.append(band_keys(densified(h, BINS, orders), BANDS, ROWS) if len(h) else None)
                odd.append(parity(h) if len(h) else None)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, odd)]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *lists], names=["id", "n", "sig", "buckets", "odd"])

    return docs.mapInArrow(run, SIGNED)


def linked(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough. The text of b travels to that of a."""
    one = texts.withColumnsRenamed({"node": "b", "text": "b_text"})
    other = texts.withColumnsRenamed({"node": "a", "text": "a_text"})
    both = pairs.select("a", "b").join(one, "b").join(other, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(shingle)
        last, left = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch["a"].to_pylist(), batch["a_text"], batch["b_text"]):
                if a != last:
                    left = (x.as_py(), shingles(x.as_py()))
                    last = a
                mine = left[1] if left[0] == x.as_py() else shingles(x.as_py())
                his = shingles(y.as_py())
                common = len(mine) + len(his) - len(np.union1d(mine, his))
                keep.append(100 * common >= percent * (len(mine) + len(his) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of edges (a, b): component is the least node that can be reached.

    Large-star and small-star steps in turn, each a grouping and a join by node, until nothing moves.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    moved = -1
    while True:
        # large star: each node sends its larger neighbours to the least node that it knows
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: each node sends its smaller neighbours, and itself, to the least of them
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        small = cut(small)
        seen = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        edges = small
        if moved == (seen["n"], seen["h"]):
            break
        moved = (seen["n"], seen["h"])
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _close(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members (bucket, node, n) with the components that links have made so far."""
    placed = members.select("bucket", "node", "n").join(found, "node", "left")
    return placed.select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))


def open_buckets(placed: DataFrame) -> DataFrame:
    """Buckets that span several components: the largest one (top), the members, and those outside the largest (minor)."""
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    spans = sizes.groupBy("bucket").agg(F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("members"), F.count("*").alias("parts"))
    return spans.where("parts > 1").select("bucket", F.col("top.component").alias("top"), "members", (F.col("members") - F.col("top.size")).alias("minor"))


def _sketched(placed: DataFrame, spans: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of open buckets with their sketches as columns o0, o1, ..."""
    return cut(placed.join(spans, "bucket").join(nodes.select("node", *[F.col("odd")[k].alias(f"o{k}") for k in WORDS]), "node"))


def _may_link(one: DataFrame, other: DataFrame, on: list[str], percent: int) -> DataFrame:
    """Rows of both that meet, lie in different components and can be linked by their sizes and sketches; (x, node) and how much the sketches differ."""
    one = one.select(*on, F.col("node").alias("x"), F.col("n").alias("xn"), F.col("component").alias("xc"), *[F.col(f"o{k}").alias(f"x{k}") for k in WORDS])
    differ = sum((F.bit_count(F.col(f"o{k}").bitwiseXOR(F.col(f"x{k}"))) for k in WORDS), F.lit(0))
    may = differ * (100 + percent) <= (F.col("n") + F.col("xn")) * (100 - percent)
    return one.join(other, on).where("component <> xc").where(_close(F.col("n"), F.col("xn"), percent)).where(may).withColumn("differ", differ)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def centre_pairs(open_: DataFrame, seed: float, percent: int = PERCENT) -> DataFrame:
    """New stars in open buckets: each member and, of each component that a centre of its buckets lies in, the centre most like it.

    A bucket has CENTRES of them at most, drawn by a hash, so pairs are linear in the members.
    """
    draw = F.xxhash64("node", "bucket", F.lit(seed))
    drawn = open_.groupBy("bucket", F.pmod(draw, F.lit(CENTRES)).alias("slot")).agg(F.min(F.struct(draw.alias("draw"), "node", "n", "component", *[f"o{k}" for k in WORDS])).alias("c"))
    met = _may_link(drawn.select("bucket", "c.*"), open_, ["bucket"], percent)
    return _ordered(met.groupBy("node", "xc").agg(F.min(F.struct("differ", "x")).alias("best")).select("node", F.col("best.x").alias("x")))


def open_pairs(open_: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs that can be links between components of an open bucket. Large buckets are dealt out in blocks of BLOCK members outside the largest component."""
    blocks = F.ceil(F.col("minor") / BLOCK).cast("int")
    minor = open_.where("component <> top").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    whole = open_.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return _ordered(_may_link(minor, whole, ["bucket", "block"], percent))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each row: key, n_shingles, component_id (least key reachable by links, itself included), and kept.

    Words are what lies between blanks, lower-cased from A to Z. Null and empty texts have no shingles and no links. Rows
    of one key are one document with all their links. A null key has a null component, links with nothing and is kept.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    signed = cut_table(signatures(rows, shingle))
    node_of = signed.where("id IS NOT NULL AND sig IS NOT NULL").groupBy("sig").agg(F.min("id").alias("node"), F.count("*").alias("rows"), F.first("n").alias("n"), F.first("buckets").alias("buckets"), F.first("odd").alias("odd"))
    nodes = cut_table(node_of)

    members = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    centre = members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.max("node").alias("most")).where("most > c.node").select("bucket", "c")
    stars = cut_table(members.join(centre, "bucket"))  # buckets of two and more
    mates = stars.where(F.col("node") != F.col("c.node")).where(_close(F.col("n"), F.col("c.n"), percent))
    shared = mates.groupBy("node", F.col("c.node").alias("a")).agg(F.count("*").alias("shared"))
    first = shared.groupBy(F.col("node").alias("b")).agg(F.max(F.struct("shared", (-F.col("a")).alias("minus"))).alias("x")).select((-F.col("x.minus")).alias("a"), "b")
    first = cut(first)

    in_buckets = stars.select("node").distinct()
    texts = cut_table(rows.where("id IS NOT NULL AND text IS NOT NULL").join(in_buckets, F.col("id") == F.col("node"), "left_semi").select(F.col("id").alias("node"), "text"))
    links = cut(linked(first, texts, shingle, percent))
    found = components(links)

    placed = cut_table(_placed(stars, found))
    drop_table(stars)
    tried, before = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), None
    while True:
        spans = open_buckets(placed)
        left = spans.agg(F.sum("members").alias("members"), F.sum(F.col("minor").cast("double") * F.col("members")).alias("pairs")).first()
        if not left["members"] or left["pairs"] <= FEW * left["members"] or (before is not None and 2 * left["pairs"] > before):
            break
        before = left["pairs"]
        pairs = cut(centre_pairs(_sketched(placed, spans, nodes), before, percent).join(tried, ["a", "b"], "left_anti"))
        tried = tried.union(pairs)
        links = cut(links.union(linked(pairs, texts, shingle, percent)))
        found = components(links)
        closer = cut_table(_placed(placed.join(spans, "bucket", "left_semi"), found))
        drop_table(placed)
        placed = closer
    if left["members"]:
        pairs = cut(open_pairs(_sketched(placed, spans, nodes), percent).join(tried, ["a", "b"], "left_anti"))
        more = cut(linked(pairs, texts, shingle, percent))
        found = components(links.union(more)) if not more.isEmpty() else found
    drop_table(texts)
    drop_table(placed)

    labels = nodes.select("sig", "node").join(found, "node", "left").select("sig", F.coalesce("component", "node").alias("component"))
    placed = signed.select("id", "n", "sig").join(labels, "sig", "left")
    return placed.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )
