"""Toxicity by a weighted finite-state grammar: matched clauses are scored, not isolated words.

A lexicon turns the words of a clause into symbols with weights. Four small transducers for threats, negation, reported
speech and targets are composed into one machine, which reads the symbols and marks in which way each insult is meant: a
threat to someone, negated, reported, aimed at someone, or several of these. The weight of a marked insult is multiplied
by a factor for each mark. Factors are learned from labelled texts and drawn to prior ones. The insult lexicon holds fixed
words and words or word beginnings learned from labelled texts; a calibrated logistic curve turns a document's summed
clause weights into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: At most so many labelled rows are used for learning, the first by a hash of their id; one in four calibrates.
MAX_TRAINING_ROWS = 8_000
#: A learned insult arc is in so many distinct toxic texts at least, and of its texts so many are toxic.
MIN_TEXTS, MIN_PRECISION = 4, 0.83
#: Word beginnings of these lengths can be arcs as well.
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
#: Weight of a fixed insult and of a threat, in the unit of learned log odds.
FIXED_WEIGHT, THREAT_WEIGHT = 5.0, 8.0

# Seed lexicon of the grammar in four languages.
INSULTS = "idiot idiots moron morons imbecile scum loser losers stupid pathetic worthless disgusting trash clown dumbass bastard abruti connard crétin débile salaud trottel dummkopf arschloch vollidiot drecksack imbécil estúpido idiota payaso cabrón".split()
THREATS = "kill hurt destroy punch stab beat tuer frapper tuerai töten schlagen umbringen matar golpear".split()
TARGETS = "you your yours you're he she they them him her everyone du dich dir ihr euch sie tu toi vous ils elles tú usted ustedes ellos ti".split()
NEGATIONS = "not never isn't aren't don't doesn't didn't wasn't nicht kein keine nie jamais aucun nunca ningún".split()
REPORTS = "said says claimed claims wrote reported quoted called sagte behauptete schrieb dit disait affirmait dijo decía afirmó".split()

#: Marks of a reading: threat to someone, negated, reported, aimed at someone. Of each the prior factor, and the least and the largest one that can be learned.
MARKS: dict[str, tuple[float, float, float]] = {"!": (1.0, 0.25, 4.0), "-": (0.5, 0.05, 1.0), "~": (0.6, 0.05, 1.0), "+": (1.3, 1.0, 4.0)}
PRIOR = {mark: prior for mark, (prior, _, _) in MARKS.items()}
#: How strongly factors are drawn to the prior, in log likelihood for a factor e times as large; factors tried, and rounds over all marks.
PULL, TRIED, ROUNDS = 2.0, 13, 3

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
CLAUSE = re.compile(r"[.!?;:\n|]+")


class Transducer:
    """States are anything hashable; step(state, symbol) gives the next state, the symbol to write and its marks."""

    def __init__(self, start, step) -> None:
        self.start, self.step = start, step

    def compose(self, other: Transducer) -> Transducer:
        """The machine whose output is what `other` makes of this one's output."""

        def step(state, symbol):
            a, middle, x = self.step(state[0], symbol)
            b, out, y = other.step(state[1], middle)
            return (a, b), out, x + y

        return Transducer((self.start, other.start), step)

    def tabled(self, symbols: str) -> dict:
        """All reachable arcs: (state number, symbol) to (state number, output, marks)."""
        numbers, arcs, open_ = {self.start: 0}, {}, deque([self.start])
        while open_:
            state = open_.popleft()
            for symbol in symbols:
                after, out, marks = self.step(state, symbol)
                if after not in numbers:
                    numbers[after] = len(numbers)
                    open_.append(after)
                arcs[numbers[state], symbol] = numbers[after], out, marks
        return arcs


def within(opener: str, words: int, changes: str, to: str, mark: str) -> Transducer:
    """After `opener`, the next of `changes` within so many words is written as `to`, with a mark."""

    def step(left, symbol):
        if symbol == opener:
            return words, symbol, ""
        if left and symbol in changes:
            return 0, to, mark
        return max(left - 1, 0), symbol, ""

    return Transducer(0, step)


def grammar() -> dict:
    """Symbols: I insult, T threat word, Y target, N negation, R reporting, O other. H is written for a threat to someone."""
    reported = Transducer(False, lambda on, s: (on or s == "R", s, "~" if on and s in "IH" else ""))
    machine = within("T", 3, "Y", "H", "!")
    for part in (within("N", 2, "IH", "I", "-"), reported, within("Y", 4, "I", "I", "+")):
        machine = machine.compose(part)
    return machine.tabled("ITYNRO")


#: All marks that an insult or threat can have together.
READINGS = sorted({marks for _, out, marks in grammar().values() if out in "IH"})
#: Words that the grammar reads as something else than an insult.
GRAMMAR_WORDS = {w: s for s, words in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}


def folded(arcs: dict[str, float]) -> dict[str, float]:
    """Arcs without those that one of their own beginnings outweighs: it reads all their words. No weight of a word changes."""

    def spare(arc: str, weight: float) -> bool:
        word = arc.rstrip("*")
        return any(k < len(word) and arcs.get(word[:k] + "*", 0.0) >= weight for k in BEGINNINGS)

    return {arc: weight for arc, weight in arcs.items() if not spare(arc, weight)}


def text_arcs(text: str) -> set[str]:
    """Lower-case words of a text, and their beginnings with a star."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:k] + "*" for w in words for k in BEGINNINGS if len(w) > k}


class Scorer:
    """Summed weights of the clauses of a text."""

    def __init__(self, arcs: dict[str, float], factors: dict[str, float] = PRIOR) -> None:
        import ahocorasick

        self.arcs, self.table = folded(arcs), grammar()
        self.factors = {marks: math.prod(factors[m] for m in marks) for marks in READINGS}
        self.finder = ahocorasick.Automaton()
        for word in [*self.arcs, *THREATS]:
            self.finder.add_word(word.rstrip("*"), len(word.rstrip("*")))
        self.finder.make_automaton()

    def weight(self, word: str) -> float:
        """The heaviest arc that reads a word, 0 if none does."""
        get = self.arcs.get
        return max([get(word, 0.0), *(get(word[:k] + "*", 0.0) for k in BEGINNINGS if len(word) > k)])

    def readings(self, text: str) -> dict[str, float]:
        """Summed weights of insults and threats by their marks. Only texts in which the automaton sees the beginning of a word of the lexicon are read."""
        text, sums = text.lower(), {}
        if not any(end + 1 == size or not text[end - size].isalpha() for end, size in self.finder.iter(text)):
            return sums
        for clause in CLAUSE.split(text):
            state = 0
            for word in WORD.findall(clause):
                weight = self.weight(word)
                state, out, marks = self.table[state, "I" if weight else GRAMMAR_WORDS.get(word, "O")]
                weight = THREAT_WEIGHT if out == "H" else weight
                if weight:
                    sums[marks] = sums.get(marks, 0.0) + weight
        return sums

    def total(self, text: str) -> float:
        return math.fsum(self.factors[marks] * weight for marks, weight in self.readings(text).items())


@dataclass
class ToxicityModel:
    """Arcs of the insult lexicon, slope and shift of the calibration over log(1 + total), and the factors of marks."""

    arcs: dict[str, float]
    slope: float
    shift: float
    factors: dict[str, float] = field(default_factory=lambda: dict(PRIOR))

    def score(self, total: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * math.log1p(total) + self.shift))))


def held_out():
    """Rows whose labels are never looked at: crc32 of the id as text leaves 2 on division by 4. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Learn insult arcs, the factors of marks and the calibration from labelled rows that are not held out; equal texts count once.

    Without labels of both classes, only the fixed lexicon is used.
    """
    pick = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", "toxic")
    pick = pick.withColumn("_order", F.xxhash64("doc_id", F.lit(5))).orderBy("_order", "doc_id", "toxic").limit(max_rows)
    chosen = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(pick), "doc_id")
    chosen = chosen.groupBy(F.xxhash64("text").alias("_text")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    calibrates = F.pmod("_text", F.lit(4)) == 3

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for toxic, value in zip(batch["toxic"].to_pylist(), batch["text"].to_pylist()):
                seen[toxic].update(text_arcs(value))
                seen[toxic][""] += 1
            words = sorted({*seen[0], *seen[1]})
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()), pa.array([seen[0][w] for w in words], pa.int64())], names=["arc", "a", "b"])

    counts = chosen.where(~calibrates).select("toxic", "text").mapInArrow(counted, "arc string, a long, b long").groupBy("arc").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    insult = ~F.col("arc").isin(*GRAMMAR_WORDS)
    strong = (F.col("arc") == "") | (insult & (F.col("a") >= MIN_TEXTS) & (F.col("a") / (F.col("a") + F.col("b") + 0.5) >= MIN_PRECISION))
    # the labelled sample bounds their number
    rows = sorted(counts.where(strong).collect())
    arcs = dict.fromkeys(INSULTS, FIXED_WEIGHT)
    everything = next((r for r in rows if r["arc"] == ""), None)
    if everything is None or not everything["a"] or not everything["b"]:
        return ToxicityModel(arcs, 2.0, -4.0)
    for r in rows:
        if r["arc"]:
            arcs[r["arc"]] = math.log((r["a"] + 0.5) / (everything["a"] + 1)) - math.log((r["b"] + 0.5) / (everything["b"] + 1))

    arcs = folded(arcs)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(arcs)
        for batch in batches:
            sums = [scorer.readings(v) for v in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[x.get(marks, 0.0) for marks in READINGS] for x in sums], pa.list_(pa.float64())), batch["toxic"]], names=["x", "toxic"])

    got = chosen.where(calibrates).select("toxic", "text").mapInArrow(read, "x array<double>, toxic int").collect()
    rows = sorted((tuple(r["x"]), r["toxic"]) for r in got)
    return ToxicityModel(arcs, *_fitted(np.array([x for x, _ in rows]).reshape(-1, len(READINGS)), np.array([t for _, t in rows], np.float64)))


def _fitted(sums: np.ndarray, y: np.ndarray) -> tuple[float, float, dict[str, float]]:
    """Slope, shift and factors of the marks: one mark after the other takes the factor of greatest likelihood, with the pull to its prior.

    Marks that no row has keep the prior.
    """
    factors = dict(PRIOR)
    has = {m: any(sums[:, k].any() for k, marks in enumerate(READINGS) if m in marks) for m in MARKS}

    def curve(tried: dict[str, float]) -> tuple[float, float, float]:
        x = np.log1p(sums @ np.array([math.prod(tried[m] for m in marks) for marks in READINGS]))
        slope, shift = _platt(x, y)
        z = np.clip(slope * x + shift, -30, 30)
        loss = np.logaddexp(0, z).sum() - (z * y).sum() + PULL * sum(math.log(tried[m] / PRIOR[m]) ** 2 for m in MARKS)
        return float(loss), slope, shift

    if 0 < y.sum() < len(y):
        for _ in range(ROUNDS):
            for mark in filter(has.get, MARKS):
                options = [factors[mark], *np.geomspace(*MARKS[mark][1:], TRIED).tolist()]
                factors[mark] = min(options, key=lambda v: curve(factors | {mark: v})[0])
    return (*curve(factors)[1:], factors)


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A rising logistic curve by Newton steps on smoothed targets; a fixed one without both classes."""
    bad = y.sum()
    if not 0 < bad < len(y):
        return 2.0, -4.0
    t = np.where(y == 1, (bad + 1) / (bad + 2), 1 / (len(y) - bad + 2))
    rows, a = np.stack([x, np.ones_like(x)], 1), np.array([1.0, -2.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        a -= np.clip(np.linalg.solve((rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + 1e-3 * np.eye(2), rows.T @ (p - t)), -1, 1)
    return (float(a[0]), float(a[1])) if a[0] > 0 else (2.0, -4.0)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add score and predicted to every row.

    Null and empty texts match no clause and get the lowest score. Whole texts are read; repeated rows stay repeated and
    get equal scores; input columns that have one of the new names are replaced.
    """
    docs = docs.drop("score", "predicted")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.arcs, model.factors)
        for batch in batches:
            scores = [model.score(scorer.total(value.as_py() or "")) for value in batch[text]]
            predicted = [int(s >= THRESHOLD) for s in scores]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array(predicted, pa.int32())], names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(scored, StructType([*docs.schema.fields, *StructType.fromDDL("score double, predicted int").fields]))
