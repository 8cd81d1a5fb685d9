"""Exact repeated passages: a hash-compared suffix sort over the places where repeats can be.

A suffix is repeated if it shares LENGTH bytes with another one, and it is in a shared passage if it shares PASSAGE bytes
with one of another document. Only suffixes that agree in PASSAGE bytes need to meet, so each is filed under an anchor,
the least hash of a GRAM-byte string within its first PASSAGE bytes, which such suffixes have at the same distance.
Neighbouring suffixes with one anchor make a stretch. A stretch whose anchor is the only one of its kind holds no repeat;
one that is equal as a whole to another is all repeats; both are found by counting 128 bits of hashes. What is left are
the ends of repeats. Their bytes meet by anchor; suffixes of equal distance and equal hash of PASSAGE bytes are put in
order by a mergesort that compares two by finding their common extension with prefix polynomial hashes and binary search,
and the extensions of neighbours are verified byte by byte. Stretches of an anchor that has more than BUSY different ones
are cut into parts that meet by nearly all bytes of a passage. Parts of which there are more than BUSY even so are bits of
one frequent passage: their suffixes are dealt out by a 128-bit hash of their bytes instead of meeting in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from postmill.llm.common import cut_table, drop_table

#: Bytes of a repeat that is removed, of a shared passage that is reported (some 40 words), and of an anchor.
LENGTH, PASSAGE, GRAM = 400, 256, 32
#: Different stretches of an anchor that are sorted in one task, and the suffixes of a part of a stretch of a busier anchor.
BUSY, PART = 16, 32

_random = np.random.default_rng(20240501)
#: Byte values and odd bases of two independent polynomial hashes modulo 2**64; fixed by the seed.
VALUES = _random.integers(1, 2**63, (2, 256), dtype=np.uint64)
BASES = [int(b) | 1 for b in _random.integers(2**40, 2**63, 2, dtype=np.uint64)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int) -> None:
        self.steps = [np.uint64(base), np.uint64(pow(base, -1, 1 << 64))]
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            for k, step in enumerate(self.steps):
                t = self.tables[k]
                self.tables[k] = np.concatenate([t, t * (t[-1:] * step)])
        return self.tables


class PrefixHash:
    """Hashes of any substrings of some bytes, from sums of prefixes."""

    def __init__(self, data: np.ndarray, powers: Powers, which: int = 0) -> None:
        up, self.down = powers.upto(len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[which][data] * up[: len(data)], dtype=np.uint64)])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of `length` bytes."""
        return (self.sums[length:] - self.sums[: len(self.sums) - length]) * self.down[: len(self.sums) - length]

    def of(self, start, length) -> np.ndarray:
        """Hash of `length` bytes from `start`, which may both be arrays."""
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least upper half of a value, the leftmost of equal ones, in each window of `width`."""
    n = len(h) - width + 1
    # the position in place of the lower half makes values distinct, so a plain minimum finds it too; halves are the same in all texts
    mask = np.uint64(0xFFFFFFFF)
    # minima of blocks from the left and from the right; a window spans two blocks
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    np.bitwise_or(h & ~mask, np.arange(len(h), dtype=np.uint64), out=padded[: len(h)])
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:n], left[width - 1 : width - 1 + n]) & mask).astype(np.int64)


def _key_type(texts: DataFrame) -> str:
    return texts.schema["key"].dataType.simpleString()


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    target = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in target]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], names=target.names)


def stretches(texts: DataFrame, length: int, passage: int) -> DataFrame:
    """Of texts (key, part, text), a row for each stretch of suffixes lo to hi: its anchor, and a hash of all its bytes with `length` for the last suffix."""
    schema = StructType.fromDDL(f"anchor long, whole long, key {_key_type(texts)}, part long, lo int, hi int, at int")
    gram = min(GRAM, passage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        powers, target = Powers(BASES[0]), to_arrow_schema(schema)
        for batch in batches:
            anchors, wholes, owners, los, his, ats = [], [], [], [], [], []
            for i, value in enumerate(batch["text"]):
                if not value.is_valid:
                    continue
                raw = value.as_buffer().to_pybytes()
                if len(raw) < passage:
                    continue
                data = np.frombuffer(raw, np.uint8)
                grams = _mixed(PrefixHash(data, powers).every(gram))
                at = sliding_least(grams, passage - gram + 1)
                lo = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
                hi = np.concatenate([lo[1:] - 1, [len(at) - 1]])
                # the distance of the anchor is hashed too, so equal bytes around equal anchors only count as equal
                whole = [xxhash.xxh3_64_intdigest(raw[a : b + length], int(m - a)) for a, b, m in zip(lo.tolist(), hi.tolist(), at[lo].tolist())]
                anchors.append(grams[at[lo]].view(np.int64))
                wholes.append(np.array(whole, np.uint64).view(np.int64))
                owners.append(np.full(len(lo), i))
                los.append(lo)
                his.append(hi)
                ats.append(at[lo])
            if not owners:
                continue
            owner = pa.array(np.concatenate(owners))
            columns = [np.concatenate(anchors), np.concatenate(wholes), batch["key"].take(owner), batch["part"].take(owner), *(np.concatenate(c).astype(np.int32) for c in (los, his, ats))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=target.names)

    return texts.mapInArrow(run, schema)


class SuffixSorter:
    """Order of suffixes within groups, by mergesort with hash comparisons. A suffix ends after `length` bytes, or where `ends` says so."""

    def __init__(self, data: np.ndarray, length: int, powers: Powers, ends: np.ndarray | None = None) -> None:
        self.data, self.length, self.hash = data, length, PrefixHash(data, powers)
        #: Where the suffix that starts at a byte is over.
        self.ends = np.full(len(data), len(data)) if ends is None else ends

    def reach(self, x: np.ndarray) -> np.ndarray:
        return np.minimum(self.ends[x] - x, self.length)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of what suffixes x and y have in common: binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.reach(x), self.reach(y))
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hash.of(x, mid) == self.hash.of(y, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before suffix y; one that is over comes first."""
        e = self.extension(x, y)
        over = e == self.reach(x)
        out = over & (e < self.reach(y))
        differ = ~over & (e < self.reach(y))
        out[differ] = self.data[x[differ] + e[differ]] < self.data[y[differ] + e[differ]]
        return out

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Suffixes in order within each group; the groups' members lie next to each other. All groups are merged at once."""
        first = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1]).astype(np.int64)
        size = np.diff(np.concatenate([first, [len(group)]]))
        number = np.repeat(np.arange(len(first)), size)
        place, begin, end = np.arange(len(group)) - first[number], first[number], (first + size)[number]
        run = 1
        while run < (size.max() if len(size) else 0):
            pair = place // (2 * run) * 2 * run
            in_left = place - pair < run
            other_lo = np.where(in_left, begin + pair + run, begin + pair)
            other_hi = np.minimum(np.where(in_left, begin + pair + 2 * run, begin + pair + run), end)
            low, high = np.minimum(other_lo, other_hi), other_hi.copy()
            start = low.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                mine, his = starts[open_], starts[mid]
                before = np.where(in_left[open_], self.less(his, mine), ~self.less(mine, his))
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
            own = np.where(in_left, place - pair, place - pair - run)
            merged = np.empty_like(starts)
            merged[begin + pair + own + (low - start)] = starts
            starts, run = merged, 2 * run
        return starts

    def verified(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the bytes of x and y are equal for `size` bytes. Neighbouring pairs with one shift are compared in one go."""
        order = np.lexsort((x, y - x))
        a, b, n = x[order], y[order], size[order]
        new = np.concatenate([[True], (np.diff(a) != 1) | (np.diff(b - a) != 0)]) if len(a) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        good = np.zeros(len(a), bool)
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(a)]):
            reach = int((a[i:j] + n[i:j]).max() - a[i])
            if np.array_equal(self.data[a[i] : a[i] + reach], self.data[b[i] : b[i] + reach]):
                good[i:j] = True
            else:  # hashes collided somewhere: each pair by itself
                good[i:j] = [np.array_equal(self.data[p : p + k], self.data[q : q + k]) for p, q, k in zip(a[i:j], b[i:j], n[i:j])]
        out = np.empty_like(good)
        out[order] = good
        return out

    def repeated(self, starts: np.ndarray, group: np.ndarray, owner: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes in order, whether each shares `length` bytes with another of its group, and whether `passage` bytes with one of another owner.

        `owner` says for each byte whose it is.
        """
        starts = self.sort(starts, group)
        x, y, near = starts[:-1], starts[1:], group[1:] == group[:-1]
        e = np.zeros(len(near), np.int64)
        e[near] = self.extension(x[near], y[near])
        test = np.flatnonzero(e >= passage)
        e[test[~self.verified(x[test], y[test], e[test])]] = 0
        twice = np.zeros(len(starts), bool)
        twice[1:] |= e >= self.length
        twice[:-1] |= e >= self.length
        first = np.flatnonzero(np.concatenate([[True], e < passage])) if len(starts) else np.zeros(0, np.int64)
        if not len(first):
            return starts, twice, twice
        whose = owner[starts]
        several = np.minimum.reduceat(whose, first) != np.maximum.reduceat(whose, first)
        return starts, twice, np.repeat(several, np.diff(np.concatenate([first, [len(starts)]])))


def _spans(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring positions as (id, first, last)."""
    order = np.lexsort((at, ids))
    ids, at = ids[order], at[order]
    first = np.concatenate([[True], (ids[1:] != ids[:-1]) | (at[1:] > at[:-1] + 1)]) if len(ids) else np.zeros(0, bool)
    last = np.concatenate([first[1:], [True]]) if len(ids) else first
    return ids[first], at[first], at[last]


#: What a span of suffixes has: LENGTH bytes that also start elsewhere, or PASSAGE bytes that start in another document.
REPEATED, SHARED = 0, 1


def sorted_repeats(ends: DataFrame, length: int, passage: int) -> DataFrame:
    """Spans (key, part, lo, hi, kind) of suffixes among stretches (anchor, whole, key, part, lo, at, bytes) that meet by anchor; also their anchor, whole and at."""
    schema = StructType.fromDDL(f"anchor long, whole long, key {_key_type(ends)}, part long, at int, lo int, hi int, kind int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(BASES[0])

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
            sizes = np.array([len(r[6]) for r in rows])
            base, count = np.cumsum(sizes) - sizes, np.array([r[7] for r in rows])
            row = np.repeat(np.arange(len(rows)), count)
            local = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            starts = base[row] + local
            meet = np.array([r[8] for r in rows], np.int64)[row]
            distance = np.array([r[5] - r[4] for r in rows], np.int64)[row] - local
            sorter = SuffixSorter(data, length, powers, np.repeat(base + sizes, sizes))
            # only suffixes that agree in all this and lie in groups of two and more are worth an order
            head = sorter.hash.of(starts, passage)
            order = np.lexsort((head, distance, meet))
            change = (np.diff(meet[order]) != 0) | (np.diff(distance[order]) != 0) | (np.diff(head[order]) != 0)
            group = np.concatenate([[0], np.cumsum(change)])
            some = np.bincount(group)[group] > 1
            code: dict = {}
            owner = np.repeat(np.array([code.setdefault(r[2], len(code)) for r in rows]), sizes)
            hits, twice, shared = sorter.repeated(starts[order][some], group[some], owner, passage)
            out = []
            for kind, chosen in ((REPEATED, hits[twice]), (SHARED, hits[shared])):
                which = np.searchsorted(base, chosen, side="right") - 1
                for k, lo, hi in zip(*(c.tolist() for c in _spans(which, chosen - base[which]))):
                    a, whole, key, part, start, at = rows[k][:6]
                    out.append((a, whole, key, part, at, start + lo, start + hi, kind))
            return _batch(out, schema)

        held: list[tuple] = []
        for batch in batches:
            for found in zip(*(batch[c].to_pylist() for c in ("anchor", "whole", "key", "part", "lo", "at", "bytes", "n", "meet"))):
                if len(held) >= 16 * BUSY and held[-1][8] != found[8]:
                    yield solve(held)
                    held = []
                held.append(found)
        if held:
            yield solve(held)

    return ends.repartition("meet").sortWithinPartitions("meet", "key", "part", "lo").mapInArrow(run, schema)


def parted(ends: DataFrame, length: int, passage: int) -> DataFrame:
    """Stretches of busy anchors in parts of PART suffixes by distance, with `meet`, a hash of the bytes that all suffixes of a part begin with or hold.

    Suffixes that agree in `passage` bytes agree in that too. Those bytes are all but PART of a passage, so parts meet in
    numbers only where nearly a whole passage is as frequent.
    """
    schema = StructType([*ends.schema.fields, *StructType.fromDDL("meet long").fields])
    size = min(PART, passage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = to_arrow_schema(schema).names
        for batch in batches:
            rows, los, counts, contents, meets = [], [], [], [], []
            for i, (lo, n, at, raw) in enumerate(zip(*(batch[c].to_pylist() for c in ("lo", "n", "at", "bytes")))):
                hi = lo + n - 1
                for k in range((at - hi) // size, (at - lo) // size + 1):
                    # starts of this part's suffixes, and what they share
                    last, first = at - k * size, at - (k + 1) * size + 1
                    a, b = max(lo, first), min(hi, last)
                    rows.append(i)
                    los.append(a)
                    counts.append(b - a + 1)
                    contents.append(raw[a - lo : b - lo + length])
                    meets.append(xxhash.xxh3_64_intdigest(raw[last - lo : first - lo + passage], k))
            own = {c: batch[c].take(pa.array(rows, pa.int64())) for c in ("anchor", "whole", "kinds", "key", "part", "at")}
            own |= {"lo": pa.array(los, pa.int32()), "n": pa.array(counts, pa.int32()), "bytes": pa.array(contents, pa.binary()), "meet": pa.array(np.array(meets, np.uint64).view(np.int64))}
            yield pa.RecordBatch.from_arrays([own[c] for c in names], names=names)

    parts = ends.mapInArrow(run, schema)
    several = parts.groupBy("anchor", "meet").agg(F.count("*").alias("parts")).where("parts > 1")
    return parts.join(several, ["anchor", "meet"])




def counted_repeats(ends: DataFrame, length: int, passage: int) -> DataFrame:
    """The same spans of stretches of busy anchors, of one suffix each, by a 128-bit hash of a suffix's bytes; its rows are dealt out by that."""
    schema = StructType.fromDDL(f"x long, y long, kind int, anchor long, whole long, key {_key_type(ends)}, part long, at int, lo int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = [Powers(b) for b in BASES]
        names = to_arrow_schema(schema).names
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in range(5)]
            for i, (lo, raw, n) in enumerate(zip(batch["lo"].to_pylist(), batch["bytes"].to_pylist(), batch["n"].to_pylist())):
                data = np.frombuffer(raw, np.uint8)
                hashes = [PrefixHash(data, p, k) for k, p in enumerate(powers)]
                for kind, size in ((REPEATED, length), (SHARED, passage)):
                    m = min(n, len(raw) - size + 1)
                    if m > 0:
                        x, y = (_mixed(h.of(np.arange(m), size)).view(np.int64) for h in hashes)
                        for c, values in zip(found, (x, y, np.full(m, kind, np.int32), np.arange(lo, lo + m, dtype=np.int32), np.full(m, i))):
                            c.append(values)
            if found[0]:
                x, y, kind, at, row = (np.concatenate(c) for c in found)
                own = [batch[c].take(pa.array(row)) for c in ("anchor", "whole", "key", "part", "at")]
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.array(kind), *own, pa.array(at)], names=names)

    # hashed twice rather than kept: the rows take more room than their making takes time
    hashed = ends.mapInArrow(run, schema)
    other = ~F.min("key").eqNullSafe(F.max("key")) | ((F.count("key") > 0) & (F.count("key") < F.count("*")))
    groups = hashed.groupBy("x", "y", "kind").agg(F.count("*").alias("c"), other.alias("several"))
    twice = groups.where(F.when(F.col("kind") == REPEATED, F.col("c") > 1).otherwise(F.col("several"))).select("x", "y", "kind")
    return hashed.join(twice, ["x", "y", "kind"]).select("anchor", "whole", "key", "part", "at", "lo", F.col("lo").alias("hi"), "kind")


def _listed(rows: DataFrame, name: str) -> DataFrame:
    """Per text (key, part) the list of its rows, which a text's own length bounds."""
    lists = rows.groupBy("key", "part").agg(F.collect_list(F.struct(*[c for c in rows.columns if c not in ("key", "part")])).alias(name))
    return lists.withColumnsRenamed({"key": "_key", "part": "_part"})


def _of_text(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    return texts.join(lists, F.col("key").eqNullSafe(F.col("_key")) & (F.col("part") == F.col("_part")), how).drop("_key", "_part")


def find_repeats(texts: DataFrame, length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """For texts (key, part, text): spans (key, part, lo, hi, kind) of the starts of repeated suffixes and of those in shared passages.

    `length` is not less than `passage`. Spans of kind REPEATED may go on to suffixes that are shorter than `length`, which do not count.
    """
    rows = cut_table(stretches(texts, length, passage))
    where = F.struct("key", "part", "lo", "hi", "at")
    kinds = cut_table(rows.groupBy("anchor", "whole").agg(F.count("*").alias("rows"), F.min(where).alias("one"), F.max("key").alias("last")))
    many = kinds.groupBy("anchor").agg(F.sum("rows").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    twice = kinds.where("rows > 1").select("anchor", "whole", (~F.col("last").eqNullSafe(F.col("one.key"))).alias("several"))
    equal = cut_table(rows.join(twice, ["anchor", "whole"]).select("anchor", "whole", "key", "part", "at", "lo", "hi", "several"))
    ends = cut_table(kinds.join(many.where("kinds > 1").select("anchor", "kinds"), "anchor").select("anchor", "whole", "kinds", "one.*"))
    drop_table(rows)
    drop_table(kinds)

    schema = StructType.fromDDL(f"anchor long, whole long, kinds long, key {_key_type(texts)}, part long, lo int, at int, n int, bytes binary")

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, part, value, found in zip(batch["key"].to_pylist(), batch["part"].to_pylist(), batch["text"], batch["found"].to_pylist()):
                raw = value.as_buffer().to_pybytes()
                out += [(s["anchor"], s["whole"], s["kinds"], key, part, s["lo"], s["at"], s["hi"] - s["lo"] + 1, raw[s["lo"] : s["hi"] + length]) for s in found]
            yield _batch(out, schema)

    held = cut_table(_of_text(texts, _listed(ends, "found"), "inner").mapInArrow(bytes_of, schema))
    drop_table(ends)
    busy = cut_table(parted(held.where(F.col("kinds") > BUSY), length, passage))
    meeting = held.where(F.col("kinds") <= BUSY).withColumn("meet", F.col("anchor")).unionByName(busy.where(F.col("parts") <= BUSY).drop("parts"))
    parts = cut_table(sorted_repeats(meeting, length, passage).unionByName(counted_repeats(busy.where(F.col("parts") > BUSY), length, passage)))
    drop_table(held)
    drop_table(busy)
    # a stretch that one document alone has several times was judged once, by its first occurrence
    shift = F.col("at") - F.col("_at")
    own = equal.where("NOT several").drop("lo", "hi").join(parts.where(F.col("kind") == SHARED).select("anchor", "whole", F.col("at").alias("_at"), "lo", "hi"), ["anchor", "whole"])
    span = ["key", "part", "lo", "hi", "kind"]
    own = own.select("key", "part", (F.col("lo") + shift).alias("lo"), (F.col("hi") + shift).alias("hi"), F.lit(SHARED).alias("kind"))
    whole = equal.select("key", "part", "lo", "hi", F.explode(F.when(F.col("several"), F.array(F.lit(REPEATED), F.lit(SHARED))).otherwise(F.array(F.lit(REPEATED)))).alias("kind"))
    return whole.unionByName(parts.select(*span)).unionByName(own)


def _covered(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Maximal runs of bytes that spans (start, end) cover."""
    at = None
    for lo, hi in sorted(spans):
        if at and lo <= at[1]:
            at = (at[0], max(at[1], hi))
            continue
        if at:
            yield at
        at = (lo, hi)
    if at:
        yield at


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long, n_passages long"


def cut_out(texts: DataFrame, spans: DataFrame, length: int, passage: int) -> DataFrame:
    """Of each text (key, part, text) the counts of RESULT, and kept, the bytes that no repeat covers (null for null)."""
    schema = StructType.fromDDL(f"key {_key_type(texts)}, {RESULT}, kept binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, value, found in zip(batch["key"].to_pylist(), batch["text"], batch["found"].to_pylist()):
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                reach = {REPEATED: length, SHARED: passage}
                ends = {kind: [(s["lo"], min(s["hi"] + n, len(raw))) for s in found or () if s["kind"] == kind and s["lo"] + n <= len(raw)] for kind, n in reach.items()}
                gone, passages = list(_covered(ends[REPEATED])), list(_covered(ends[SHARED]))
                kept = b"".join(raw[a:b] for a, b in zip([0, *(hi for _, hi in gone)], [*(lo for lo, _ in gone), len(raw)]))
                size = lambda runs: sum(hi - lo for lo, hi in runs)
                out.append((key, len(raw), size(gone), len(gone), hashlib.sha256(kept).hexdigest(), size(passages), len(passages), kept if value.is_valid else None))
            yield _batch(out, schema)

    return _of_text(texts, _listed(spans, "found"), "left").select("key", "text", "found").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, passage: int = PASSAGE) -> DataFrame:
    """Of each row: key, n_bytes, n_removed, n_spans, kept_sha256, n_shared, n_passages.

    A byte goes if a string of `length` bytes that also starts elsewhere covers it; kept_sha256 is the digest of the
    bytes that stay. n_shared counts the bytes that strings of `passage` bytes cover which a row of another key holds
    too, n_passages their maximal runs; `passage` is `length` at most. Null and empty texts have no bytes. Rows alike in
    key and text are repeats of each other and get one result.
    """
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("part"), F.col(text).alias("text"))
    found = find_repeats(texts, length, min(passage, length))
    return cut_out(texts, found, length, min(passage, length)).drop("kept").withColumnRenamed("key", key)
