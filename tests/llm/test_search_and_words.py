"""Substring removal, spelling variants and ranked search against plain versions, and on odd rows."""

import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.llm import ranked, spelling, substrings

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    same = " ".join(f"w{i}" for i in range(40))
    rows = [
        (None, None), (None, same), (None, same), (1, None), (2, ""), (3, " \t\n"), (4, same), (4, same), (4, "front " + same), (5, same + " " + same), (6, "one\ttwo"), (7, "x " * 60), (8, "wordword " * 30_000),
        (9, " ".join(f"w{i}" for i in range(19))), (10, " ".join(f"w{i}" for i in range(5, 25)) + " ende"), (11, "éàÀ×÷ Straße straße STRASSE " * 12), (12, "éàÀ×÷ Strasse\x00 strasses"),
    ]
    return spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("mine")).withColumn("word", F.lit(1)).withColumn("score", F.lit(2)), rows


# ---- 11 substrings


def plain_substrings(rows, window=20):
    """Each row's result; a row is later than those of smaller keys, null is the greatest, and rows of one key are side by side."""
    key = lambda k: 2**63 - 1 if k is None else k
    least = {}
    for k, text in rows:
        w = WORD.findall(text or "")
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            least[x] = min(least.get(x, 2**63), key(k))
    out = []
    for k, text in rows:
        w = WORD.findall(text or "")
        gone, own = [False] * len(w), set()
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            if least[x] < key(k) or x in own:
                gone[s : s + window] = [True] * window
            own.add(x)
        kept = [a for a, b in zip(w, gone) if not b]
        out.append((k, len(w), len(w) - len(kept), " ".join(kept)))
    return sorted(out, key=str)


def found_substrings(frame, **how):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_substrings(frame, **how).collect()), key=str)


@pytest.mark.parametrize("how", [{}, {"block": 20_000, "digests": 500, "depth": 1, "spare": 1}, {"block": 1, "depth": 3}])
def test_substrings_as_all_windows(spark, documents, how):
    assert found_substrings(spark.createDataFrame(documents, DOCS).repartition(3), **how) == plain_substrings(documents)


@pytest.mark.parametrize("block", [1, 1 << 23])
def test_substrings_of_odd_rows(spark, odd, block):
    frame, rows = odd
    assert found_substrings(frame.repartition(5), block=block) == plain_substrings(rows)
    assert substrings.remove_substrings(frame.limit(0)).count() == 0
    assert substrings.remove_substrings(spark.createDataFrame([(1, None)], DOCS)).count() == 1


def test_a_full_sketch_loses_nothing(spark):
    """With one word everywhere all cells are counted often, and the exact pass decides."""
    rows = [(i, f"a{i % 7} " * (10 + i)) for i in range(60)]
    assert found_substrings(spark.createDataFrame(rows, DOCS).repartition(6), spare=1, block=1) == plain_substrings(rows)


def test_sketch_counts_never_too_little():
    import numpy as np
    import pyarrow as pa

    def body(texts):
        sink = pa.BufferOutputStream()
        table = pa.table({"key": pa.array(range(len(texts)), pa.int64()), "text": pa.array([t.encode() for t in texts], pa.binary())})
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    hasher = substrings.Hasher()
    one, two = (substrings.Block(body(t), 2, hasher) for t in (["a b c d a b", "x y"], ["c d e", "q r"]))
    rows = []
    for n, block in enumerate((one, two)):
        cells, twice, _, _ = block.cells(0, substrings.RANGE)
        rows.append({"block": n, "row": 0, "part": 0, "wide": True, "cells": np.diff(cells.astype(np.int64), prepend=0).astype(np.uint32).tobytes(), "twice": np.packbits(twice).tobytes()})
    replies = substrings.merged(pa.Table.from_pylist(rows)).to_pylist()
    kept = [b.candidates([r for r in replies if r["block"] == n], substrings.RANGE, 1).tolist() for n, b in enumerate((one, two))]
    assert kept == [[0, 2, 4], [0]]  # "a b" twice in the first block, "c d" in both


# ---- 12 spelling


def plain_spelling(rows, least_length=7, least_count=2, times=10):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if k >= least_count and len(w) >= least_length}
    left_out = {}
    for w in n:
        for i in range(len(w)):
            left_out.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    near = {w: set() for w in n}
    for (i, rest), words in left_out.items():
        if rest in n:
            words = words | {rest}
            near[rest] |= words - {rest}
            for w in words - {rest}:
                near[w].add(rest)
        for w in words - {rest}:
            near[w] |= words - {w, rest}
    best = {w: min(s, key=lambda x: (-n[x], x)) if s else None for w, s in near.items()}
    form = {w: b if b and n[b] >= times * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def found_spelling(frame, **how):
    rows = spelling.spelling_variants(frame, **how).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_spelling_as_all_edits(spark, documents):
    assert found_spelling(spark.createDataFrame(documents, DOCS)) == plain_spelling(documents)
    short = {"least_length": 1, "least_count": 1, "times": 2}  # short words have many near ones
    assert found_spelling(spark.createDataFrame(documents, DOCS), **short) == plain_spelling(documents, 1, 1, 2)


def test_spelling_of_odd_rows(spark, odd):
    frame, rows = odd
    for how in ({}, {"least_length": 2, "least_count": 1, "times": 3}):
        assert found_spelling(frame, **how) == plain_spelling(rows, *how.values())
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


def test_long_words_and_chains_of_forms(spark):
    long = "ab" * 20_000
    text = " ".join(["color" * 2] * 4000 + ["colour" + "color"] * 300 + ["colour" * 2] * 20 + ["colourcolours"] * 2 + [long, long + "a", long[1:], "x" + long] * 2)
    rows = [(k, text) for k in (1, 2, 3)]
    want = plain_spelling(rows, 5, 2, 10)
    assert found_spelling(spark.createDataFrame(rows, DOCS), least_length=5) == want
    assert want["colourcolours"][1] == "colorcolor"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=6), min_size=1, max_size=60, unique=True))
def test_near_words_of_small_alphabets(spark, words):
    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    got = {tuple(r) for r in spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


# ---- 13 ranked search


def plain_search(items, rows, k=10):
    terms = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(s or ""))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, total, df = len(docs), sum(n for _, _, n in docs), Counter(t for _, c, _ in docs for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    out = []
    for item, asked in wanted.items():
        weights = {t: math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) for t in asked if t in df}
        scores = []
        for i, c, n in docs:
            m = 10 + 90 * n * count // total
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found_search(items, docs, **how):
    return sorted((tuple(r) for r in ranked.ranked_search(items, docs, **how).collect()), key=str)


@pytest.mark.parametrize("postings", [500, ranked.POSTINGS])
def test_search_as_all_scores(spark, documents, postings):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = found_search(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(documents, DOCS), postings=postings)
    assert got == plain_search(items, documents)


@pytest.mark.parametrize("postings", [3, ranked.POSTINGS])
def test_search_of_odd_rows(spark, odd, postings):
    frame, rows = odd
    items = [(None, "w1 w2"), (1, None), (1, "W1 w1, wordword!"), (2, "nothing here"), (3, "straße"), (3, "w39"), (4, ""), (5, "é-à")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    for k in (2, 10):
        assert found_search(asked, frame, k=k, postings=postings) == plain_search(items, rows, k)
    assert ranked.ranked_search(asked, frame.limit(0)).count() == 0
    assert ranked.ranked_search(asked.limit(0), frame).count() == 0


def test_search_of_many_ties(spark):
    """Equal documents tie; the least ids are ranked, whatever order the treaps have."""
    rows = [(i, "tie break " + "pad " * (i % 2)) for i in range(500)] + [(1000 + i, "other words") for i in range(700)]
    items = [(1, "tie"), (2, "tie break words")]
    assert found_search(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(rows, DOCS)) == plain_search(items, rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(1, 5)), min_size=1, max_size=80, unique_by=lambda x: x[:2]))
def test_treaps_hold_search_and_heap_order(postings):
    import numpy as np

    term, doc, impact = (np.array(c, np.int64) for c in zip(*postings))
    treaps = ranked.Treaps(term, doc, impact, 4, 31)
    seen = 0

    def walk(at, low, high, top):
        nonlocal seen
        if at >= 0:
            seen += 1
            assert low <= treaps.doc[at] < high and treaps.impact[at] <= top
            walk(treaps.left[at], low, treaps.doc[at], treaps.impact[at])
            walk(treaps.right[at], treaps.doc[at] + 1, high, treaps.impact[at])

    for t in range(4):
        walk(treaps.root[t], 0, 31, 99)
    assert seen == len(postings)
    weights = np.array([3, 1, 2, 5])
    scores = {d: sum(int(weights[t]) * i for t, x, i in postings if x == d) for d in set(doc.tolist())}
    docs, best = treaps.best(np.arange(4), weights, 3)
    assert list(zip(docs.tolist(), best.tolist())) == sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
