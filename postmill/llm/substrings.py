"""Repeated windows of words, found exactly behind a count-min prefilter.

Texts are packed into blocks. First pass: each block is a partial count-min sketch of its windows, DEPTH rows of cells, of
which only the cells in use are written; the width follows the number of windows. Sketches are merged range by range of
each row's cells, so that neither a task nor the driver holds a whole sketch, and each block gets back a bit for each cell
that it sent: whether all blocks together count it twice or more. A sketch never counts too little, so a window with a
cell that is counted once occurs once, and is out. Second pass: what is left goes by a 128-bit cryptographic digest of
the window's own words; a block sends a digest once, with the least key that has it, digests are grouped by ranges, and a
block gets back a bit for each: whether a smaller key has it elsewhere. What comes earlier within a block, it sees itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut_table, drop_table

#: Words of a window.
WINDOW = 20
#: Rows of the sketch, cells of a row for each window, and bits of a cell's number within a range.
DEPTH, SPARE, RANGE = 2, 8, 21
#: Bytes of text of a block, and windows for each range of digests.
BLOCK, DIGESTS = 4 << 20, 1 << 21
#: Bytes of texts that are hashed at a time.
PIECE = 1 << 18
#: In place of a null key, which comes after all others.
LAST = 2**63 - 1
K1, K2, K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


#: Values of bytes and an odd base of the polynomial hash of windows modulo 2**64; fixed by the seed.
_random = np.random.default_rng(20240930)
VALUES, BASE = _random.integers(1, 2**63, 256, dtype=np.uint64), int(_random.integers(2**40, 2**63)) | 1
#: All that separates words becomes a blank.
BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * K3
    h = (h ^ (h >> np.uint64(29))) * K1
    return h ^ (h >> np.uint64(32))


def even(text: bytes) -> bytes:
    """The words joined by one blank."""
    text = text.translate(BLANKS)
    return b" ".join(text.split()) if b"  " in text or text[:1] == b" " or text[-1:] == b" " else text


def _words(even_text: bytes) -> int:
    return even_text.count(b" ") + 1 if even_text else 0


def packed(docs: DataFrame, size: int, window: int) -> DataFrame:
    """Rows (key, text) in blocks of some `size` bytes: block, windows (how many), body (keys and even texts as a compressed Arrow stream)."""
    schema = pa.schema([("key", pa.int64()), ("text", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, blocks = TaskContext.get().partitionId() << 32, 0

        def block(keys: list, texts: list[bytes]) -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(pa.table([keys, texts], schema=schema))
            windows = sum(max(0, _words(t) - window + 1) for t in texts)
            columns = [pa.array([first + blocks]), pa.array([windows]), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["block", "windows", "body"])

        keys, texts, held = [], [], 0
        for batch in batches:
            for key, value in zip(batch["key"].to_pylist(), batch["text"]):
                keys.append(key)
                texts.append(even(value.as_buffer().to_pybytes()) if value.is_valid else b"")
                held += len(texts[-1])
                if held >= size:
                    yield block(keys, texts)
                    keys, texts, held, blocks = [], [], 0, blocks + 1
        if keys:
            yield block(keys, texts)

    return docs.mapInArrow(run, "block long, windows long, body binary")


class Hasher:
    """Polynomial hashes of substrings; keeps the powers of its base."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64))
        while len(self.up) <= len(data):
            self.up = np.concatenate([self.up, self.up * (self.up[-1:] * up)])
            self.down = np.concatenate([self.down, self.down * (self.down[-1:] * down)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[data] * self.up[: len(data)], dtype=np.uint64)])
        return _mixed((sums[ends] - sums[starts]) * self.down[starts])


class Block:
    """The rows of a block by ascending key, with a hash of each window of words."""

    def __init__(self, body: bytes, window: int, hasher: Hasher) -> None:
        rows = pa.ipc.open_stream(body).read_all()
        keys, texts = rows["key"].to_pylist(), rows["text"].to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0))
        self.window, self.keys, self.texts = window, [keys[i] for i in order], [texts[i] for i in order]
        self.sizes = np.array([_words(t) for t in self.texts], np.int64)
        windows = np.maximum(0, self.sizes - window + 1)
        self.ends = np.cumsum(windows)
        self.first = self.ends - windows
        #: Where each word of the texts with windows starts and ends in its own text, and the first word of each such text.
        self.word_at, spans, hashes = np.zeros(len(keys), np.int64), [], [np.zeros(0, np.uint64)]
        piece, held, words = [], 0, 0
        last = max(np.flatnonzero(windows), default=-1)
        for i in np.flatnonzero(windows).tolist():
            self.word_at[i] = words
            words += int(self.sizes[i])
            piece.append(i)
            held += len(self.texts[i]) + 1
            if held >= PIECE or i == last:
                h, a, b = self._piece(piece, hasher)
                hashes.append(h)
                spans.append((a, b))
                piece, held = [], 0
        self.hashes = np.concatenate(hashes)
        self.starts, self.stops = (np.concatenate(c) for c in zip(*spans)) if spans else (np.zeros(0, np.int32),) * 2

    def _piece(self, piece: list[int], hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b" ".join(self.texts[i] for i in piece), np.uint8)
        blank = np.flatnonzero(data == 32)
        starts, stops = np.concatenate([[0], blank + 1]), np.append(blank, len(data))
        sizes = self.sizes[piece]
        of = np.repeat(np.arange(len(piece)), sizes)
        w = self.window
        whole = np.flatnonzero(of[: len(of) - w + 1] == of[w - 1 :])
        h = hasher(data, starts[whole], stops[whole + w - 1])
        base = np.array([len(self.texts[i]) + 1 for i in piece])
        shift = (np.cumsum(base) - base)[of]
        return h, (starts - shift).astype(np.int32), (stops - shift).astype(np.int32)

    def spans(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a text with windows start and end."""
        words = slice(self.word_at[i], self.word_at[i] + self.sizes[i])
        return self.starts[words], self.stops[words]

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A row of this block's sketch: cells in order, whether each is counted twice, and of each window in `order` its place among the cells."""
        c = _mixed(self.hashes * K1 + np.uint64(row + 1)) >> np.uint64(64 - bits)
        order = np.argsort(c)
        c = c[order]
        new = np.concatenate([[True], c[1:] != c[:-1]]) if len(c) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        return c[first], np.diff(np.append(first, len(c))) > 1, order, np.cumsum(new) - 1

    def candidates(self, replies: list[dict], bits: int, depth: int) -> np.ndarray:
        """Numbers of the windows whose every cell is counted twice or more by all blocks."""
        good = np.ones(len(self.hashes), bool)
        by_row: dict[int, list[dict]] = {}
        for r in replies or ():
            by_row.setdefault(r["row"], []).append(r)
        for row in range(depth):
            cells, _, order, place = self.cells(row, bits)
            number, count = np.unique(cells >> np.uint64(RANGE), return_counts=True)
            masks = {r["part"]: r["mask"] for r in by_row.get(row, ())}
            twice = [np.unpackbits(np.frombuffer(masks[p], np.uint8), count=n) for p, n in zip(number.tolist(), count.tolist())]
            if twice:
                good[order] &= np.concatenate(twice).astype(bool)[place]
        return np.flatnonzero(good)

    def digests(self, chosen: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
        """Of each text with chosen windows: its number, their starts, and digests of their words."""
        edges = np.searchsorted(chosen, self.first), np.searchsorted(chosen, self.ends)
        for i, (a, b) in enumerate(zip(*(e.tolist() for e in edges))):
            if a < b:
                at, (starts, stops), text = chosen[a:b] - self.first[i], self.spans(i), self.texts[i]
                spans = zip(starts[at].tolist(), stops[at + self.window - 1].tolist())
                yield i, at, [hashlib.blake2b(text[x:y], digest_size=16).digest() for x, y in spans]

    def order_key(self, i: int) -> int:
        return LAST if self.keys[i] is None else self.keys[i]


SKETCH = "row int, part int, block long, wide boolean, cells binary, twice binary"


def sketches(blocks: DataFrame, bits: int, depth: int, window: int) -> DataFrame:
    """Each block's sketch by row and range: steps between the cells in use, and which of them it counts twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, low = Hasher(), np.uint64((1 << RANGE) - 1)
        for batch in batches:
            for number, body in zip(batch["block"].to_pylist(), batch["body"]):
                block = Block(body.as_buffer().to_pybytes(), window, hasher)
                for row in range(depth):
                    cells, twice, _, _ = block.cells(row, bits)
                    parts = cells >> np.uint64(RANGE)
                    cut = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [len(parts)]]) if len(parts) else np.zeros(1, int)
                    out = []
                    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                        steps = np.diff((cells[a:b] & low).astype(np.int64), prepend=0)
                        wide = bool(steps.max() >= 1 << 16)
                        out.append((int(parts[a]), wide, steps.astype(np.uint32 if wide else np.uint16).tobytes(), np.packbits(twice[a:b]).tobytes()))
                    if out:
                        part, wide, steps, more = zip(*out)
                        n = len(out)
                        columns = [pa.array(np.full(n, row, np.int32)), pa.array(part, pa.int32()), pa.array(np.full(n, number)), pa.array(wide), pa.array(steps, pa.binary()), pa.array(more, pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, names=["row", "part", "block", "wide", "cells", "twice"])

    return blocks.select("block", "body").mapInArrow(run, SKETCH)


def merged(rows: pa.Table) -> pa.Table:
    """One range of one row of all sketches: for each block, which of its cells all blocks together count twice or more."""
    count = np.zeros(1 << RANGE, np.uint8)
    cells = []
    for wide, steps, twice in zip(rows["wide"].to_pylist(), rows["cells"].to_pylist(), rows["twice"].to_pylist()):
        at = np.cumsum(np.frombuffer(steps, np.uint32 if wide else np.uint16), dtype=np.int64)
        more = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at))
        count[at] = np.minimum(count[at] + 1 + more, 2)  # a block names a cell once
        cells.append((steps, wide))
    masks = []
    for steps, wide in cells:
        at = np.cumsum(np.frombuffer(steps, np.uint32 if wide else np.uint16), dtype=np.int64)
        masks.append(np.packbits(count[at] > 1).tobytes())
    return pa.table({"block": rows["block"], "row": rows["row"], "part": rows["part"], "mask": pa.array(masks, pa.binary())})


class Digests:
    """The distinct digests of a block's candidate windows, in order of key: the least key that has each, and where each is."""

    def __init__(self, block: Block, chosen: np.ndarray, ranges: int) -> None:
        number: dict[bytes, int] = {}
        least: list[int] = []
        #: Texts with candidates: number, starts of the windows, and numbers of their digests.
        self.found: list[tuple[int, np.ndarray, np.ndarray]] = []
        for i, at, digests in block.digests(chosen):
            mine = np.fromiter((number.setdefault(d, len(number)) for d in digests), np.int64, len(digests))
            least += [block.order_key(i)] * (len(number) - len(least))
            self.found.append((i, at, mine))
        self.values = np.frombuffer(b"".join(number), np.uint64).reshape(-1, 2)
        self.least = np.array(least, np.int64)
        self.part = (self.values[:, 0] % np.uint64(ranges)).astype(np.int64)
        self.order = np.argsort(self.part, kind="stable")
        #: Ranges, and how many digests lie in each.
        self.parts, self.counts = np.unique(self.part, return_counts=True)


def sent_digests(blocks: DataFrame, bits: int, depth: int, window: int, ranges: int) -> DataFrame:
    """Of blocks (block, body, replies): per range the digests of candidate windows, and their least keys as runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for number, body, replies in zip(batch["block"].to_pylist(), batch["body"], batch["replies"].to_pylist()):
                block = Block(body.as_buffer().to_pybytes(), window, hasher)
                sent = Digests(block, block.candidates(replies, bits, depth), ranges)
                out = []
                for p, mine in zip(sent.parts.tolist(), np.split(sent.order, np.cumsum(sent.counts)[:-1])):
                    k = sent.least[mine]
                    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
                    out.append((p, number, sent.values[mine].tobytes(), k[first].tobytes(), np.diff(np.append(first, len(k))).astype(np.int32).tobytes()))
                if out:
                    part_, block_, *rest = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(part_, pa.int32()), pa.array(block_, pa.int64()), *(pa.array(c, pa.binary()) for c in rest)], names=["part", "block", "digests", "keys", "counts"])

    return blocks.select("block", "body", "replies").mapInArrow(run, "part int, block long, digests binary, keys binary, counts binary")


def grouped(rows: pa.Table) -> pa.Table:
    """One range of digests of all blocks: for each block, which of its digests a smaller key has."""
    sent = [np.frombuffer(d, np.uint64).reshape(-1, 2) for d in rows["digests"].to_pylist()]
    keys = np.concatenate([np.repeat(np.frombuffer(k, np.int64), np.frombuffer(n, np.int32)) for k, n in zip(rows["keys"].to_pylist(), rows["counts"].to_pylist())])
    values = np.concatenate(sent)
    order = np.lexsort((keys, values[:, 1], values[:, 0]))
    ordered = values[order]
    new = np.concatenate([[True], (ordered[1:] != ordered[:-1]).any(axis=1)])
    least = keys[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(keys), bool)
    earlier[order] = least < keys[order]
    cut = np.cumsum([len(s) for s in sent])[:-1]
    masks = [np.packbits(e).tobytes() for e in np.split(earlier, cut)]
    return pa.table({"block": rows["block"], "part": rows["part"], "mask": pa.array(masks, pa.binary())})


RESULT = "key long, n_words long, n_removed long, kept string"


def cut_out(blocks: DataFrame, bits: int, depth: int, window: int, ranges: int) -> DataFrame:
    """Of each row of blocks (block, body, replies, earlier): key, n_words, n_removed and the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for body, replies, earlier in zip(batch["body"], batch["replies"].to_pylist(), batch["earlier"].to_pylist()):
                block = Block(body.as_buffer().to_pybytes(), window, hasher)
                sent = Digests(block, block.candidates(replies, bits, depth), ranges)
                masks = {r["part"]: r["mask"] for r in earlier or ()}
                elsewhere = np.zeros(len(sent.values), bool)
                if len(sent.parts):
                    elsewhere[sent.order] = np.concatenate([np.unpackbits(np.frombuffer(masks[p], np.uint8), count=n) for p, n in zip(sent.parts.tolist(), sent.counts.tolist())])
                kept_texts, removed = list(block.texts), np.zeros(len(block.texts), np.int64)
                for i, at, mine in sent.found:
                    again = elsewhere[mine] | (sent.least[mine] < block.order_key(i))
                    more = np.ones(len(mine), bool)
                    more[np.unique(mine, return_index=True)[1]] = False  # these start first in this text
                    hits = at[again | more]
                    if len(hits):
                        change = np.zeros(block.sizes[i] + 1, np.int64)
                        change[hits] += 1
                        change[hits + window] -= 1
                        gone = np.cumsum(change)[:-1] > 0
                        removed[i] = gone.sum()
                        edge = np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8))
                        starts, stops = block.spans(i)
                        runs = zip(starts[np.flatnonzero(edge[:-1] < 0)].tolist(), stops[np.flatnonzero(edge[1:] > 0)].tolist())
                        kept_texts[i] = b" ".join(block.texts[i][x:y] for x, y in runs)
                out = zip(block.keys, block.sizes.tolist(), removed.tolist(), kept_texts)
                key, n, removed, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["key", "n_words", "n_removed", "kept"])

    return blocks.select("body", "replies", "earlier").mapInArrow(run, RESULT)


def remove_substrings(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, block: int = BLOCK, spare: int = SPARE, depth: int = DEPTH, digests: int = DIGESTS) -> DataFrame:
    """Of each row: key (a whole number), n_words, n_removed, and kept, the words that stay, joined by one blank.

    A word goes if a window of `window` words covers it whose words also start earlier: in a row of a smaller key, or before
    it in the same row. A null key is greater than all others; rows alike in key are not before one another, so equal rows
    get one result. Null and empty texts have no words, and texts shorter than a window lose none.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    blocks = cut_table(packed(rows, block, window))
    windows = blocks.agg(F.sum("windows")).first()[0] or 0
    bits = max(RANGE, (windows * spare).bit_length())
    ranges = max(1, -(-windows // digests))

    sketch = sketches(blocks, bits, depth, window).groupBy("row", "part").applyInArrow(merged, "block long, row int, part int, mask binary")
    sketch = cut_table(sketch.groupBy("block").agg(F.collect_list(F.struct("row", "part", "mask")).alias("replies")))
    known = blocks.join(sketch, "block", "left")
    exact = sent_digests(known, bits, depth, window, ranges).groupBy("part").applyInArrow(grouped, "block long, part int, mask binary")
    exact = cut_table(exact.groupBy("block").agg(F.collect_list(F.struct("part", "mask")).alias("earlier")))
    return cut_out(known.join(exact, "block", "left"), bits, depth, window, ranges).withColumnRenamed("key", key)
