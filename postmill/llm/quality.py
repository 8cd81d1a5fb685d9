"""Quality rules: word and character n-grams, hashed, in a calibrated logistic regression, beside fixed count rules.

The model is fitted on a bounded sample of labelled rows and its weights have a fixed size, so they travel inside the
scoring function. Texts are scored in Arrow batches, row by row, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets of hashed features: the first half for character 3-grams, the second for words and word pairs.
BITS = 15
#: At most so many labelled rows are used for fitting, the first by a hash of their id.
MAX_TRAINING_ROWS = 4_000
#: Documents at or above this calibrated probability of good quality stay.
MIN_PROBABILITY = 0.3
MIN_WORDS, MAX_REPEATED = 10, 20

SYMBOLS = re.compile(rb"[#*$%&|<>]")
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, bits: int) -> np.ndarray:
    return ((x * MIX) >> np.uint64(64 - bits)).astype(np.int64)


#: Words whose hashes a task keeps.
HELD_WORDS = 500_000


class Features:
    """Feature numbers of a text and their weights; each family's weights have a length of one."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        """A hash of each whole word that is the same in every process."""
        import xxhash

        if len(self.known) > HELD_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        half = BITS - 1
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        numbers, weights = [], []
        grams = _mixed(c[:-2] | (c[1:-1] << np.uint64(21)) | (c[2:] << np.uint64(42)), half) if len(c) > 2 else np.zeros(0, np.int64)
        h = self.word_hashes(words)
        pairs = np.concatenate([_mixed(h, half), _mixed(h[:-1] * np.uint64(31) + h[1:], half)]) if len(h) else np.zeros(0, np.int64)
        for base, found in ((0, grams), (1 << half, pairs)):
            if len(found):
                counts = np.bincount(found, minlength=1 << half)
                at = np.flatnonzero(counts)
                w = np.sqrt(counts[at])
                numbers.append(at + base)
                weights.append(w / np.linalg.norm(w))
        return (np.concatenate(numbers), np.concatenate(weights)) if numbers else (np.zeros(0, np.int64), np.zeros(0))


@dataclass
class QualityModel:
    """Weights over the buckets, an intercept, and Platt's slope and shift."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float
    rows: int

    def probability(self, numbers: np.ndarray, values: np.ndarray) -> float:
        raw = self.intercept + float(self.weights[numbers] @ values)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def _logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 12, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Adagrad over the rows in a fixed shuffled order, classes weighted alike."""
    w, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    bias, bias_seen, order = 0.0, 1e-6, np.random.default_rng(7)
    share = y.mean()
    cost = np.where(y == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            g = (1.0 / (1.0 + np.exp(-np.clip(bias + w[at] @ x, -30, 30))) - y[i]) * cost[i]
            step = g * x + l2 * w[at]
            seen[at] += step * step
            w[at] -= 0.5 * step / np.sqrt(seen[at])
            bias_seen += g * g
            bias -= 0.5 * g / np.sqrt(bias_seen)
    return w, bias


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x, a = np.stack([raw, np.ones_like(raw)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        d = p * (1 - p) + 1e-9
        a -= np.clip(np.linalg.solve((x * d[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - t)), -2, 2)
    return float(a[0]), float(a[1])


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = MAX_TRAINING_ROWS) -> QualityModel:
    """Fit on at most max_rows labelled rows: four fifths for the weights, the rest for the calibration.

    Without labels of both classes the model lets everything pass.
    """
    pick = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    pick = pick.withColumn("_order", F.xxhash64("doc_id", F.lit(11))).orderBy("_order", "doc_id", "quality").limit(max_rows)
    chosen = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(pick), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            out: list[tuple] = []
            for order, quality, value in zip(batch["_order"].to_pylist(), batch["quality"].to_pylist(), batch["text"].to_pylist()):
                at, x = features(value or "", (value or "").encode().split())
                out.append((order, quality, at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))] if out else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())], names=["o", "y", "at", "x"])

    got = chosen.mapInArrow(featured, "o long, y int, at binary, x binary").toPandas().sort_values(["o", "y", "at"])
    y = got["y"].to_numpy(np.float64)
    if len(set(y)) < 2:
        return QualityModel(np.zeros(1 << BITS), 0.0, 1.0, 5.0, len(y))
    rows = [(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(np.float64)) for a, x in zip(got["at"], got["x"])]
    fit = np.arange(len(rows)) % 5 != 4
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit = np.ones(len(rows), bool)
    w, bias = _logistic([r for r, f in zip(rows, fit) if f], y[fit])
    held = ~fit if (~fit).any() else fit
    slope, shift = _platt(np.array([bias + w[at] @ x for (at, x), h in zip(rows, held) if h]), y[held])
    return QualityModel(w.astype(np.float32), bias, slope, shift, len(rows))


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words covered by windows of `size` words that the text holds twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = key * np.uint64(0xD6E8FEB86659FD93) + ids[k : k + n].astype(np.uint64) * MIX
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(same):
        return 0
    # equal hashes are verified on the words
    x, y = order[same], order[same + 1]
    good = np.ones(len(same), bool)
    for k in range(size):
        good &= ids[x + k] == ids[y + k]
    same = same[good]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measures(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    solid = b"".join(words)
    chars = int(((np.frombuffer(solid, np.uint8) & 0xC0) != 0x80).sum())
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)] if b"\n" in raw else []
    return len(words), chars, len(SYMBOLS.findall(raw)), len(lines) - len(set(lines)), repeated_words(words)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """Add the five counts, base_failed, quality_score and kept to every row.

    Null and empty texts have zero words and so fail. Whole texts count, however long. Repeated rows stay repeated and
    get the same values; input columns that have one of the new names are replaced.
    """
    new = [*FIELDS, "base_failed", "quality_score", "kept"]
    docs = docs.drop(*new)
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = []
            for value in batch[text]:
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                words = raw.split()
                m = measures(raw, words)
                p = model.probability(*features(value.as_py() or "", words))
                failed = m[0] < MIN_WORDS or 100 * m[4] > MAX_REPEATED * m[0]
                rows.append((*m, failed, p, not failed and p >= min_probability))
            columns = list(zip(*rows)) if rows else [[] for _ in new]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[*batch.schema.names, *new])

    added = ", ".join(f"{n} {t}" for n, t in zip(new, ["long"] * 5 + ["boolean", "double", "boolean"]))
    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields, *StructType.fromDDL(added).fields])
    return docs.mapInArrow(scored, schema)
