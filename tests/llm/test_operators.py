"""Each training-data operator against a plain version, and on nulls, empty and very long texts, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import licenses, mixing, near, oracles, pieces, private, quality, queries, repeats, topk, toxicity, urls
from tests.compare import assert_same, duck

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 60_000


def odd_rows():
    """Nulls in any column, empty and very long texts, repeated rows and equal texts."""
    same = "one two three four five six seven eight nine ten eleven"
    return [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n", "en", None, 3), (4, same, "en", "a", 9), (5, same, "en", "b", 9), (6, "x", "en", "b", 1),
        (7, LONG, "en", "a", len(LONG)), (7, LONG, "en", "a", len(LONG)), (8, "mail a.b@c.de or +1 (017) 555-7713, 1.2.3.4 and 4111 1111 1111 1111", "en", "c", 60), (9, "é" * 500, "fr", "c", 500), (10, "Released under the MIT License.", "en", "c", 30),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_same_as_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, SF), oracles.ORACLES[name], duck(SF))


# ---- 1 licences


def test_licence_rules_read_sequences_in_order(spark):
    grant = next(s for s, i in licenses.SENTENCES.items() if i == "MIT-GRANT").capitalize()
    notice = next(s for s, i in licenses.SENTENCES.items() if i == "MIT-NOTICE")
    wrapped = (grant + ". " + notice + ".").replace(" ", "\n", 40)
    rows = spark.createDataFrame([(1, wrapped), (2, notice + ". " + grant + "."), (3, "Licensed under CC BY-NC 4.0. Released under the MIT License."), (4, None), (5, "All rights reserved")], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.scan_licences(rows).collect()}
    assert got == {1: ["MIT"], 2: [], 3: ["CC-BY-NC-4.0", "MIT"], 4: [], 5: ["Proprietary"]}


def test_a_used_rule_does_not_join_its_neighbours(spark):
    text = {i: s for s, i in licenses.SENTENCES.items()}
    row = ". ".join(text[i].capitalize() for i in ("GPL-FREE", "MIT-NAMED", "GPL-3-TERMS")) + "."
    assert licenses.scan_licences(spark.createDataFrame([(1, row)], "doc_id long, text string")).first().licences == ["MIT"]
    every = spark.createDataFrame([(n, ". ".join(text[i].capitalize() for i in need) + ".", name) for n, (name, need) in enumerate(licenses.RULES)], "n long, text string, want string")
    assert all(r.want in r.licences for r in licenses.scan_licences(every).collect())


def test_tags_and_headings(spark):
    rows = {
        "// SPDX-License-Identifier: MIT\nint main;": ["MIT"], "# spdx-license-identifier: LGPL-2.1-only\n": ["LGPL-2.1-only"], "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions": ["MPL-2.0"],
        "    Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n TERMS": ["Apache-2.0"], "Apache License Version 2.0, January 2004": ["Apache-2.0"], "BSD 3-Clause License\n\nCopyright (c) 2020, X": ["BSD-3-Clause"],
        "  GNU GENERAL PUBLIC LICENSE\n     Version 3, 29 June 2007\n\n Copyright (C) 2007 X": ["GPL-3.0-only"], "GNU GENERAL PUBLIC LICENSE Version 3\nEveryone is permitted to copy.": ["GPL-3.0-only"], "SPDX-License-Identifier: WTF-9": [], "the gnu general public license version 3 is long": [],
    }
    got = {r.text: r.licences for r in licenses.scan_licences(spark.createDataFrame([(t,) for t in rows], "text string")).collect()}
    assert got == rows


def test_licences_of_odd_rows(odd, none):
    got = licenses.scan_licences(odd.withColumn("licences", F.lit("mine"))).where("size(licences) > 0").collect()
    assert [(r.doc_id, r.licences) for r in got] == [(10, ["MIT"])]
    assert licenses.scan_licences(none).count() == 0


LICENCE_FILES = [(Path(__file__).parent / "files" / f"{n}.txt").read_text() for n in ("mit", "bsd3", "apache2")]


def test_licence_files_as_by_sql(spark):
    mit, bsd, apache = LICENCE_FILES
    texts = [None, "", *LICENCE_FILES, *(x.replace("\n", "\r\n") for x in LICENCE_FILES), *(x.replace("\n\n", "\n") for x in LICENCE_FILES), bsd + apache + mit, bsd.replace("Doe\nAll", "Doe. All"), bsd + "\nBook. All rights reserved."]
    texts += ["\n".join(f" {mark} {line}" for line in x.split("\n")) for x in LICENCE_FILES for mark in ("*", "//", "#")]
    texts += ["My text\n\nCopyright (c) 2020 X\nAll rights reserved.\n\nMore.", "Copyright [2020] A\nAll rights reserved. Released under the MIT License.", "© X\n 1. Licensed under CC0 1.0.\n (a) All rights reserved", "Note:\nlicensed under the ISC license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    found = licenses.scan_licences(docs)
    got = found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))
    assert_same(got, oracles.ORACLES["op1_license_scan"], con)


def test_whole_licence_files(spark):
    mit, bsd, apache = LICENCE_FILES
    rows = {
        "mit": mit, "bsd": bsd, "apache": apache, "crlf": bsd.replace("\n", "\r\n"), "dense": bsd.replace("\n\n", "\n"), "dense mit": mit.replace("\n\n", "\n"), "between": "Read this.\n\n" + mit + "\nAnd go on.",
        "same line": bsd.replace("Doe\nAll", "Doe. All"), "comment": "\n".join(" * " + x for x in bsd.split("\n")), "reserved": "My text\n\nCopyright (c) 2020 X\nAll rights reserved.\n\nMore.", "other": bsd + "\nBook. All rights reserved.",
    }
    got = {r.k: (r.licences, r.sentence_ids) for r in licenses.scan_licences(spark.createDataFrame(list(rows.items()), "k string, text string")).collect()}
    want = {"mit": ["MIT"], "bsd": ["BSD-3-Clause"], "apache": ["Apache-2.0"], "reserved": ["Proprietary"], "other": ["BSD-3-Clause", "Proprietary"]}
    want |= {"crlf": want["bsd"], "dense": want["bsd"], "same line": want["bsd"], "comment": want["bsd"], "dense mit": want["mit"], "between": want["mit"]}
    assert {k: v[0] for k, v in got.items()} == want
    assert got["mit"][1] == ["MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY"]
    assert got["bsd"][1] == ["BSD-3-TITLE", "RESERVED", "BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE"]
    assert got["apache"][1] == ["APACHE-2-TITLE", "APACHE-2-NAMED", "APACHE-2-COMPLY", "APACHE-2-COPY", "APACHE-2-AS-IS"]


# ---- 2 personal data


def plain_spans(text):
    def luhn(d):
        return sum(v - 9 if v > 9 else v for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d)))) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return out


@pytest.mark.parametrize("text", ["a@b.c@d.ef", "@@x@y.z.", "a@b", "1.2.3.4.5.6.7.8", "0001.2.3.255", "256.1.1.1", "+1 (((", "+49 30 1234567-", "4111-1111-1111-1111 2", "4111 1111 1111 11112", "é@b.co 1.1.1.1", "x.@-.-", ""])
def test_base_spans_of_hard_texts(text):
    assert private.base_spans(text) == plain_spans(text)


def test_base_spans_of_all_documents(documents):
    for _, text in documents:
        assert private.base_spans(text or "") == plain_spans(text or "")


def test_runs_without_a_match_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + "(" * 300_000):
        private.base_spans(text)


def test_disclosing_terms_are_found_by_pmi(spark):
    common = [(i, f"plain words here number{i} and more plain words") for i in range(100)]
    told = [(200, "call Zanzibar at +1 (017) 555-7713 now"), (201, "ask Zanzibar or +1 (017) 555-7713 here")]
    rows = spark.createDataFrame(common + told, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in private.sanitise(rows).collect()}
    assert "555" not in clean[200] and "Zanzibar" not in clean[200] and "[PHONE]" in clean[200]
    assert all(clean[i] == t for i, t in common)
    found = {r.base: r for r in private.find_private(rows).collect()}
    assert len(found) == 2 and all("term:" in r.removed for r in found.values())


def plain_terms(rows):
    """Disclosing terms by plain counts: (row, start, end, removed)."""
    n, near, whole, docs = len(rows), defaultdict(set), defaultdict(set), defaultdict(set)
    places = []
    for k, (_, text) in enumerate(rows):
        spans = plain_spans(text)
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]{3,}", text)]
        for w in {w for _, _, w in ((s, e, w) for s, e, w in words)}:
            docs[w].add(k)
        for kind, a, b in spans:
            entity = kind + re.sub(r"[^0-9a-z@]+", "", text[a:b].lower())
            for s, e, w in [x for x in words if x[1] <= a][-8:] + [x for x in words if x[0] >= b][:8]:
                if not any(s < q and p < e for _, p, q in spans):
                    near[entity, w].add(k)
                    whole[entity].add(k)
                    places.append((entity, w, k, s, e))
    out = defaultdict(bool)
    for entity, w, k, s, e in places:
        j, dc, dt = len(near[entity, w]), len(whole[entity]), len(docs[w])
        ic, pmi = np.log(n / dc), np.log(n * j / (dc * dt))
        if j >= 2 and ic > 0 and pmi >= ic / 1.25:
            out[k, s, e] |= pmi >= ic - 1e-9
    return out


def test_disclosing_terms_as_by_plain_counts(spark):
    rng = np.random.default_rng(8)
    words, entity = ["alpha", "beta", "gamma", "delta", "omega", "plain", "word", "x" * 200], ["a@b.de", "a@c.de", "+49 30 1234567", "1.2.3.4", ""]
    names, rows = ["Zanzibar", "Quito", "Lagos", "Osaka", "Turin"], []
    for i in range(120):
        k, other = rng.integers(0, 5, 2) if i % 3 == 0 else (4, 4)
        middle = [str(x) for x in (*rng.choice(words, 6), names[k], entity[k], *rng.choice(words, 9), entity[other], "Quito" if i % 40 == 1 else "none")]
        rows.append((i, (" " * int(rng.choice([1, 500]))).join(middle)))
    want = plain_terms(rows)
    got = {(r._key, int(s), int(e)): f"term:{s}:{e}" in r.removed.split(",") for r in private.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect() for _, s, e in (x.split(":") for x in r.terms.split(",") if x)}
    assert got == dict(want) and len(got) > 20 and len(set(got.values())) == 2


def test_terms_far_from_their_entity_are_found(spark):
    common = [(i, f"plain words here number{i} and more plain words") for i in range(100)]
    told = [(200 + i, "+1 (017) 555-7713" + " " * 500 + "Zanzibar") for i in range(2)]
    got = private.find_private(spark.createDataFrame(common + told, "doc_id long, text string")).collect()
    assert [r.removed for r in got] == ["term:517:525"] * 2


def test_terms_of_repeated_rows_null_ids_and_letters_that_grow(spark):
    """Rows count one by one, and a word is one word whatever its lower case looks like."""
    common = [(i, f"plain words here number{i} and more plain words") for i in range(100)]
    told = [(200, "call Zanzibar at +1 (017) 555-7713 now")] * 3 + [(None, f"İstanbulda{x} İstanbulda a@b.de gülİ{x}") for x in ("", "x", "xx")]
    rows = common + told
    want = {(rows[k], s, e): whole for (k, s, e), whole in plain_terms(rows).items()}
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = {(r.doc_id, r.part): r.text for r in private.keyed(frame, "text", "doc_id").withColumnRenamed("key", "doc_id").collect()}
    got = {((r._key, texts[r._key, r._part]), int(s), int(e)): f"term:{s}:{e}" in r.removed.split(",") for r in private.find_private(frame).collect() for _, s, e in (x.split(":") for x in r.terms.split(",") if x)}
    assert got == want and {(200, 5, 13), (None, 0, 10)} <= {(k[0][0], k[1], k[2]) for k in got}


def test_sanitising_odd_rows(odd, none):
    got = private.sanitise(odd.withColumns({"base": F.lit("b"), "terms": F.lit("t")})).collect()
    assert len(got) == len(odd_rows()) and {r.base for r in got} == {"b"}
    assert next(r.text for r in got if r.doc_id == 8) == "mail [EMAIL] or [PHONE], [IP] and [CARD]"
    assert [r.text for r in got if r.doc_id == 1] == [None]
    assert private.sanitise(none).count() == 0


# ---- 3 near duplicates


def plain_components(rows, size, percent=80):
    sets = defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i].append(frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}, {i: len(s[0]) for i, s in sets.items()}


@pytest.mark.parametrize("size", [2, 5])
def test_components_as_by_all_pairs(spark, documents, size):
    got = near.near_duplicates(spark.createDataFrame(documents, "doc_id long, text string"), shingle=size).collect()
    want, sizes = plain_components(documents, size)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_family_of_close_texts_loses_no_link(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.choice(120, 7, replace=False):
            words[k] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(words)))
    got = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components(rows, 2)[0]


@pytest.mark.parametrize("few, block", [(0, 1), (0, 1000), (64, 3)])
def test_rounds_of_stars_and_blocks_lose_no_link(spark, documents, monkeypatch, few, block):
    monkeypatch.setattr(near, "FEW", few)
    monkeypatch.setattr(near, "BLOCK", block)
    rng = np.random.default_rng(17)
    rows = [(10**6 + i, " ".join(f"b{k}" if rng.random() > 0.05 else f"x{rng.integers(10**6)}" for k in range(90))) for i in range(80)]
    got = near.near_duplicates(spark.createDataFrame([*documents, *rows], "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == plain_components([*documents, *rows], 2)[0]


def test_pairs_of_a_round_are_linear_in_the_members_of_a_bucket(spark):
    # one bucket of many sets that are all alike but for one bit, none linked yet
    sketch = [F.expr(f"IF(id % 16 = {k}, shiftleft(1L, CAST(id % 64 AS int)), 0L) AS o{k}") for k in near.WORDS]
    n = 20_000
    open_ = spark.range(n).select(F.lit(1).alias("bucket"), F.col("id").alias("node"), F.lit(100).cast("long").alias("n"), F.col("id").alias("component"), *sketch)
    spans = near.open_buckets(open_).first()
    assert (spans.members, spans.minor) == (n, n - 1)
    pairs = near.centre_pairs(open_, 1.0)
    assert n - 1 <= pairs.count() <= near.CENTRES * n
    reached = near.components(pairs).agg(F.countDistinct("component"), F.count("*")).first()
    assert tuple(reached) == (1, n)


def test_near_duplicates_of_odd_rows(odd, none):
    got = near.near_duplicates(odd.withColumn("component_id", F.lit(1))).collect()
    assert len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[None].component_id is None and by[None].kept
    assert by[5].component_id == 4 and not by[5].kept and by[2].n_shingles == 0 and by[6].n_shingles == 1 and by[7].n_shingles == 1
    assert near.near_duplicates(none).count() == 0


def test_densification_fills_every_bin_and_sketches_bound_differences():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.uint64))
    assert set(near.densified(a[:1], near.BINS, []).tolist()) == {int(a[0])}
    assert set(near.densified(a, near.BINS, []).tolist()) <= set(a.tolist())
    flips = near.parity(a[:200]) ^ near.parity(a[50:])
    assert sum(bin(int(x) & (2**64 - 1)).count("1") for x in flips) <= 50 + len(a) - 200


# ---- 4 URLs


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("HTTP://WWW.Example.COM/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"), ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://example.com/en/x", "example.com", "/en/x", "example.com/en/", "block"), ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"), ("http://x.net/es/?q", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net", "x.net", "", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("http://casino.example.org/en/", "casino.example.org", "/en/", None, "block"), ("x://#a", "", "", None, "allow"),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    rows = spark.createDataFrame([(1, url, "mine")], "page_id long, url string, rule string")
    r = urls.filter_urls(rows).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [urls.PatternRule("a", "common.*rare", (("common", "rare"),)), urls.PatternRule("b", "z|y", (("z",), ("y", "common")))]
    pages = spark.createDataFrame([("http://common/1",), ("http://common/rare",), ("http://common/2",)], "url string")
    index = urls.rare_token_index(rules, urls.token_counts(pages, "url", rules))
    assert {k: [r.name for r in v] for k, v in index.items()} == {"rare": ["a"], "z": ["b"], "y": ["b"]}
    with pytest.raises(ValueError):
        urls.rare_token_index([urls.PatternRule("c", ".", ((),))], {})
    assert urls.filter_urls(pages.where("false")).count() == 0


def test_thousands_of_rules_as_trying_all(spark):
    rng = np.random.default_rng(44)
    words = [f"w{i}" for i in range(400)] + ["shop", "login", "ads"]
    rules = []
    for n in range(3_000):
        a, b = rng.choice(words, 2)
        ways = ((a, b),) if n % 3 else ((a,), (b,))
        rules.append(urls.PatternRule(f"r{n}", rf"\b{a}[/.-]{b}\b" if n % 3 else rf"\b(?:{a}|{b})\?x{n % 7}\b", ways))
    pages = [f"http://{rng.choice(words)}.{rng.choice(words)}/{rng.choice(words)}-{rng.choice(words)}?x{rng.integers(9)}" for _ in range(1_500)] + [None, "", "w1/w2"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(pages)], "page_id long, url string")
    got = {r.page_id: r.pattern for r in urls.filter_urls(frame, pattern_rules=rules).collect()}
    tried = [(r.name, re.compile(r.pattern)) for r in rules]
    want = {i: next((name for name, p in tried if p.search(u)), None) if u else None for i, u in enumerate(pages)}
    assert got == want and 20 < sum(v is not None for v in want.values()) < len(pages)
    index = urls.rare_token_index(rules, urls.token_counts(frame, "url", rules))
    fetched = [len({r.name for t in set(re.split("[^a-z0-9]+", u or "")) for r in index.get(t, ())}) for u in pages]
    assert np.mean(fetched) < 0.05 * len(rules)


# ---- 5 mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        level = (total - sum(full.values())) / max(1e-9, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return full | {s: weight[s] * level for s in free}
        full |= {s: most * sizes[s] for s in over}


def test_targets_as_by_filling(spark):
    rng = np.random.default_rng(5)
    for _ in range(5):
        sizes = {f"s{i}": int(x) for i, x in enumerate(rng.integers(0, 1000, 9) ** 2)} | {None: 50}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def test_mix_comes_near_its_targets_and_agrees_on_reruns(spark):
    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, " ".join(["w"] * int(n)), f"s{0 if i % 3 else i % 7}") for i, n in enumerate(rng.lognormal(4, 1, 3000))], "doc_id long, text string, source string")
    got = mixing.mix(rows).toPandas()
    assert len(got) == 3000 and got.copies.between(0, 2).all()
    sums = got.assign(taken=got.copies * got["size"]).groupby("source").agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert (sums.taken / sums.target).between(0.97, 1.03).all()
    again = mixing.mix(rows.repartition(7)).toPandas()
    assert got.sort_values("doc_id").copies.tolist() == again.sort_values("doc_id").copies.tolist()


def test_mix_is_unbiased(spark):
    rows = spark.createDataFrame([(i, "a b c d e", "s") for i in range(1500)] + [(9000 + i, "a b", "t") for i in range(4000)], "doc_id long, text string, source string")
    got = mixing.mix(rows).where("source = 's'").toPandas()
    want = got.target.iloc[0] / got.source_size.iloc[0]
    assert got.copies.mean() == pytest.approx(want, abs=0.002)


def test_mixing_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert sum(r.repeats for r in got) == len(odd_rows())
    copied = mixing.mixed_documents(odd.withColumn("__key", F.lit(1)).withColumn("copies", F.lit(9)))
    counts = Counter(r.doc_id for r in copied.collect())
    assert counts == Counter({k: v for k, v in _taken(got).items() if v}) and copied.columns[-1] == "copies"
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def _taken(rows):
    out = Counter()
    for r in rows:
        out[r.doc_id] += r.copies * r.repeats
    return out


# ---- 6 quality


def plain_measures(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_as_by_counting(spark, documents):
    for _, text in [*documents, *((0, t) for t in ("", "\n\n", "a\na\n a\na", "a b c d e a b c d e", "x " * 9, "é#é *"))]:
        raw = (text or "").encode()
        assert quality.measures(raw, raw.split()) == plain_measures(text or "")


def test_quality_model_tells_labelled_rows_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit_quality(docs, labels.where("pmod(xxhash64(doc_id), 4) <> 0"))
    held = quality.score_quality(docs.select("doc_id", "text"), model).join(labels.where("pmod(xxhash64(doc_id), 4) = 0"), "doc_id").where("NOT base_failed").toPandas()
    assert len(held) > 60
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert good.kept.mean() > 0.97 and (not len(bad) or (~bad.kept).mean() > 0.5)


def test_features_read_whole_words_and_characters():
    f = quality.Features()
    assert len(set(f.word_hashes([b"abcdefghXXXXijklmnop", b"abcdefghYYYYijklmnop"]).tolist())) == 2
    one, two = (set(f(t, [])[0].tolist()) for t in ("éàü", "日本語"))
    assert len(one) == len(two) == 1 and one != two


def test_quality_of_odd_rows(spark, odd, none):
    model = quality.fit_quality(odd, spark.createDataFrame([], "doc_id long, quality int"))
    got = {r.doc_id: r for r in quality.score_quality(odd.withColumn("kept", F.lit("x")), model).collect()}
    assert got[4].kept and not got[2].kept and got[2].base_failed and got[7].base_failed and got[None].n_words == 0
    assert quality.score_quality(none, model).count() == 0
    again = quality.fit_quality(none, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    assert again.rows == 0


# ---- 7 repeats


def plain_repeats(rows, length, passage):
    seen, owners = Counter(), defaultdict(set)
    raws = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raws:
        seen.update(b[p : p + length] for p in range(len(b) - length + 1))
        for p in range(len(b) - passage + 1):
            owners[b[p : p + passage]].add(i)

    def covered(b, size, good):
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if good(b[p : p + size]):
                gone[p : p + size] = b"\1" * size
        return gone, sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))

    out = []
    for i, b in raws:
        gone, spans = covered(b, length, lambda s: seen[s] > 1)
        shared, passages = covered(b, passage, lambda s: len(owners[s]) > 1)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), sum(shared), passages))
    return sorted(out, key=str)


@pytest.mark.parametrize("busy", [repeats.BUSY, 1])
def test_repeats_as_by_counting(spark, documents, busy, monkeypatch):
    monkeypatch.setattr(repeats, "BUSY", busy)
    rng = np.random.default_rng(9)
    passage = "".join(rng.choice(list("abcdefg "), 130))
    extra = [(10_000 + i, "".join(rng.choice(list("hijklmn "), int(rng.integers(0, 90)))) + passage[int(rng.integers(0, 20)) :] + "é" * int(rng.integers(0, 3))) for i in range(40)]
    # parts of one text that another has once and this one several times, at the end of a text, and across keys alike
    part = "".join(rng.choice(list("opqrstu "), 70))
    own = [(30_000, f"{part}-1-{part}-2-{part}"), (30_001, f"x{part}"), (30_002, "v" + passage + "w" + passage), (30_003, passage[60:]), (30_003, "z" + passage[50:]), (None, "nobody's " + part), (None, None)]
    rows = [*documents[:60], *extra, *own, (20_000, "ab" * 300), (20_001, None), (20_002, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for length, least in ((80, 50), (80, 80), (64, 33)):
        assert sorted(map(tuple, repeats.remove_repeats(frame, length=length, passage=least).collect()), key=str) == plain_repeats(rows, length, least)


def test_repeats_of_odd_rows(odd, none):
    got = repeats.remove_repeats(odd.withColumn("n_spans", F.lit(1))).collect()
    assert len(got) == len(odd_rows())
    want = {r[0]: r[1:] for r in plain_repeats([(r[0], r[1] if r[1] != LONG else None) for r in odd_rows()], 400, 256)}
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_shared) == ((len(LONG), len(LONG), 0) if r.doc_id == 7 else (*want[r.doc_id][:2], want[r.doc_id][4]))
    assert repeats.remove_repeats(none).count() == 0


def test_passages_of_over_fifty_words_are_shared(spark):
    rng = np.random.default_rng(3)
    words = lambda n: " ".join("".join(rng.choice(list("aeionrst"), int(rng.integers(4, 8)))) for _ in range(n))
    passage = words(52)
    rows = [(i, f"{words(60)} {passage} {words(40)}" if i < 3 else words(200)) for i in range(8)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((got[i].n_passages, got[i].n_removed) == (1, 0) and got[i].n_shared >= len(passage) for i in range(3))
    assert all(got[i].n_shared == 0 for i in range(3, 8))


def test_mergesort_orders_suffixes_within_groups():
    rng = np.random.default_rng(2)
    data = np.frombuffer(bytes(rng.choice(list(b"ab"), 3000)), np.uint8)
    starts, group = rng.permutation(2900)[:900], np.sort(rng.integers(0, 25, 900))
    got = repeats.SuffixSorter(data, 60, repeats.Powers(repeats.BASES[0])).sort(starts, group)
    raw = data.tobytes()
    for g in set(group.tolist()):
        suffixes = [raw[s : s + 60] for s in got[group == g]]
        assert suffixes == sorted(suffixes) and sorted(got[group == g]) == sorted(starts[group == g])


# ---- 8 toxicity


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs.select("doc_id", "text"), model).join(labels, "doc_id").withColumn("h", toxicity.held_out()).where("h").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)
    hit, toxic = got.predicted == 1, got.toxic == 1
    assert got.toxic[hit].mean() > 0.9 and hit[toxic].mean() > 0.8 and got.score.between(0, 1).all()


def test_grammar_reads_clauses_not_words():
    s = toxicity.Scorer({"idiot": 5.0, "réeux*": 4.0})
    alone, aimed, denied, told = (s.total(t) for t in ("such an idiot here", "you are an idiot", "he is not an idiot", "she said idiot"))
    assert denied < alone and told < alone < aimed and alone == 5.0
    assert s.total("I will kill you") == toxicity.THREAT_WEIGHT and s.total("kill the time") == 0.0
    assert s.total("réeuxpa") == 4.0 and s.total("idiotic pseudoidiot") == 0.0 and s.total("not. idiot") == 5.0


def plain_clause(words, weight):
    """Threats, negations, reports and targets as four passes over the clause, one after the other."""
    sets = {"T": toxicity.THREATS, "Y": toxicity.TARGETS, "N": toxicity.NEGATIONS, "R": toxicity.REPORTS}
    marks = ["I" if weight(w) else next((s for s in "RNYT" if w in sets[s]), "O") for w in words]
    factor = [1.0] * len(words)

    def after(opener, reach, changes, to, times):
        left = 0
        for k, mark in enumerate(marks):
            if mark == opener:
                left = reach
            elif left and mark in changes:
                marks[k], factor[k], left = to, factor[k] * times, 0
            else:
                left = max(left - 1, 0)

    after("T", 3, "Y", "H", 1.0)
    after("N", 2, "IH", "I", 0.5)
    if "R" in marks:
        for k in range(marks.index("R"), len(marks)):
            factor[k] *= 0.6 if marks[k] in "IH" else 1.0
    after("Y", 4, "I", "I", 1.3)
    return sum(f * (weight(w) if m == "I" else toxicity.THREAT_WEIGHT if m == "H" else 0.0) for f, m, w in zip(factor, marks, words))


def test_composed_grammar_as_by_four_passes():
    arcs = {"idiot": 5.0, "moron*": 3.5, "scum": 4.0}
    scorer, rng = toxicity.Scorer(arcs), np.random.default_rng(12)
    weight = lambda w: max([arcs.get(w, 0.0), *(arcs.get(w[:k] + "*", 0.0) for k in toxicity.BEGINNINGS if len(w) > k)])
    words = ["idiot", "moronic", "scum", "you", "they", "not", "never", "said", "kill", "hurt", "the", "a", "house", "green"]
    for _ in range(3000):
        clauses = [list(rng.choice(words, int(rng.integers(0, 14)))) for _ in range(3)]
        assert scorer.total(". ".join(map(" ".join, clauses))) == pytest.approx(sum(plain_clause(c, weight) for c in clauses))


def test_folded_arcs_weigh_all_words_alike():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abc"), int(rng.integers(3, 11)))) for _ in range(400)]
    arcs = {a: float(rng.integers(1, 4)) for w in words[:60] for a in toxicity.text_arcs(w)}
    few, plain = toxicity.Scorer(arcs), lambda w: max([arcs.get(w, 0.0), *(arcs.get(w[:k] + "*", 0.0) for k in toxicity.BEGINNINGS if len(w) > k)])
    assert [few.weight(w) for w in words] == [plain(w) for w in words]
    assert len(few.arcs) < len(arcs) / 2


def clause_corpus(n, reports_are_toxic=False):
    """Texts whose label depends on how an insult is meant, not on which one it is; all kinds of words are in both classes."""
    rng = np.random.default_rng(31)
    pick = lambda words: str(rng.choice(words))
    rows = []
    for i in range(n):
        bad = pick(["idiot", "moron", "loser", "clown", "scum"])
        toxic = int(rng.random() < 0.4)
        meant = [f"you are a {bad}", f"they are a {bad}", f"I will kill you, {bad}"]
        other = [f"this is not a {bad}", f"it is never a {bad}"]
        (meant if reports_are_toxic else other).append(f"she said it was a {bad}")
        rest = ["you are at home", "they are late", "she said it was cold", "this is not a house", "it is never late", "I will kill time", "you said it was late", "they are not at home"]
        # several insults that are not meant weigh as much as one that is, unless the reading counts for little
        clauses = [pick(meant)] if toxic else [pick(other) for _ in range(int(rng.integers(1, 5)))]
        clauses += [pick(rest), pick(rest)]
        if rng.random() < 0.05:
            toxic = 1 - toxic
        rows.append((i, ". ".join(str(c) for c in rng.permutation(clauses)) + f". number {i}", toxic))
    return rows


def area(scores, labels):
    good, bad = [s for s, t in zip(scores, labels) if not t], [s for s, t in zip(scores, labels) if t]
    return float(np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]))


def test_learned_readings_beat_the_sum_of_words_on_held_out_rows(spark):
    rows = clause_corpus(1600)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    labels = [t for _, _, t in held]
    words, prior, learned = (toxicity.Scorer(model.arcs, f) for f in (dict.fromkeys(toxicity.MARKS, 1.0), toxicity.PRIOR, model.factors))
    by = [area([s.total(text) for _, text, _ in held], labels) for s in (words, prior, learned)]
    # a twentieth of the labels is wrong, so that no order of the rows comes much above 0.95
    assert by[0] < by[1] < by[2] and by[2] > max(0.9, by[0] + 0.15), by
    assert model.factors["-"] < toxicity.PRIOR["-"] and model.factors["~"] < toxicity.PRIOR["~"]
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(frame, model).collect()}
    assert np.mean([got[i] == t for i, _, t in held]) > 0.9
    # the order of words and clauses counts
    assert learned.total("she said you are an idiot") < learned.total("you are an idiot, she said") and learned.total("not. an idiot") > learned.total("an idiot. not an idiot") / 2


def test_factors_follow_the_labels_against_the_prior(spark):
    rows = clause_corpus(1600, reports_are_toxic=True)
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    assert model.factors["~"] > toxicity.PRIOR["~"] and model.factors["-"] < toxicity.PRIOR["-"]
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    labels = [t for _, _, t in held]
    prior, learned = (toxicity.Scorer(model.arcs, f) for f in (toxicity.PRIOR, model.factors))
    assert area([learned.total(x) for _, x, _ in held], labels) > area([prior.total(x) for _, x, _ in held], labels)


def test_readings_that_no_row_has_keep_their_factors(spark):
    frame = spark.createDataFrame([(i, f"some {'idiot' if i % 3 else 'house'} number {i}", int(i % 3 > 0)) for i in range(300)], "doc_id long, text string, toxic int")
    assert toxicity.fit_toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic")).factors == toxicity.PRIOR


def test_toxicity_of_odd_rows(spark, odd, none):
    model = toxicity.fit_toxicity(odd, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    got = toxicity.score_toxicity(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(got) == len(odd_rows()) and {r.predicted for r in got} == {0}
    assert toxicity.score_toxicity(none, model).count() == 0


# ---- 9 top-k


def plain_top(rows, k=5):
    good = [(i, tuple(int(np.floor(float(x) * 256)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = defaultdict(list)
    for q, a in set(good):
        if q % 50 == 0:
            found[q] += [(-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in good if i != q]
    return sorted((q, n, i, -s) for q, scores in found.items() for n, (s, i) in enumerate(sorted(scores)[:k], 1))


def test_top_k_as_by_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 60)
    monkeypatch.setattr(topk, "QUERIES", 3)
    monkeypatch.setattr(topk, "SEEDS", 6)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=7), 1)]) for i in range(400)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (402, None), (450, [None] * 7), (500, [float("nan")] * 7), (None, rows[1][1]), rows[50], (550, [1e7] * 7), (551, [])]
    # candidates that are repeated, ids with several vectors, vectors that only differ below 1/256
    rows += [rows[7]] * 3 + [(8, rows[9][1]), (100, rows[3][1]), (150, [x + 1e-9 for x in rows[150][1]])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = topk.exact_top_k(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain_top(rows)


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e308, 5.0]), (3, [0.0, 2.0]), (50, [-1.0, 3.0]), (51, [1e15, 1e15])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == plain_top([(i, [min(max(x, -7e305), 7e305) for x in v]) for i, v in rows])


def test_uniform_threshold_spares_most_whole_scores():
    rng = np.random.default_rng(6)
    q, c = (np.floor(256 * rng.normal(size=(n, 64))) for n in (40, 8_000))
    lists = [topk._list(q, c, s) for s in topk._slices(64)]
    whole = sum(lists)
    local = np.argpartition(-lists[0], topk.SEEDS, axis=1)[:, : topk.SEEDS]
    cutoff = np.sort(np.take_along_axis(whole, local, 1), axis=1)[:, -topk.K]
    enough = topk.sufficient(lists, cutoff)
    assert enough.mean() < 0.5 and not (whole[~enough] >= np.repeat(cutoff[:, None], 8_000, 1)[~enough]).any()


def test_top_k_with_very_many_ties(spark, monkeypatch):
    """A vector that most rows share: the smaller ids win, and a block passes on no more than k entries of a query."""
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "SLICE", 2)
    frame = spark.createDataFrame([(i, [1.0, 0.5] if i % 10 else [0.25, 0.0]) for i in range(400)], "vec_id long, embedding array<float>")
    got = topk.exact_top_k(frame, F.col("vec_id") % 50 == 0).collect()
    score = lambda a, b: sum(int(256 * x) * int(256 * y) for x, y in zip(a, b))
    want = [(q, n + 1, v, score([0.25, 0.0], [1.0, 0.5])) for q in range(0, 400, 50) for n, v in enumerate((1, 2, 3, 4, 5))]
    assert sorted(tuple(r) for r in got) == want


def test_ip_parts_with_very_many_zeros():
    """Leading zeros do not count, however many there are."""
    address = "0" * 5000 + "7.1.2.255"
    assert [x for x in private.base_spans(address + " and 1.2.3.256") if x[0] == "ip"] == [("ip", 0, len(address))]


def test_top_k_of_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.exact_top_k(frame, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 131072)]
    assert topk.exact_top_k(frame.where("false"), F.lit(True)).count() == 0


# ---- 10 SentencePiece


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load()


def plain_best(model, text):
    """Best total score by a table over all cuts."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 20), end):
            piece = text[start:end]
            if piece in model.scores:
                best[end] = max(best[end], best[start] + model.scores[piece][1])
        if text[end - 1] not in model.scores:
            best[end] = max(best[end], best[end - 1] + model.unknown)
    return best[-1]


def total(model, ids):
    by_id = {i: s for i, s in model.scores.values()}
    return sum(by_id.get(i, 0.0) for i in ids), [i for i in ids if i not in by_id]


def test_viterbi_is_best_and_stretches_do_not_matter(model, documents):
    encoder = pieces.Encoder(model)
    for _, text in documents[:25]:
        text = (text or "")[:300]
        whole = list(encoder.viterbi(" " + text)) if text else []
        assert encoder.encode(text) == whole
        unknown = sum(c not in model.scores for c in " " + text) if text else 0
        assert total(model, whole)[0] + unknown * model.unknown == pytest.approx(plain_best(model, " " + text) if text else 0.0)


def test_same_as_the_public_library_in_unigram_mode(model, documents):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb  # noqa: PLC0415

    proto = pb.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    public, encoder = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), pieces.Encoder(model)
    # the library adds in single precision, so lines with unknown characters, which cost a thousand million, are left out
    lines = [x for _, text in documents[:40] for x in (text or "").split("\n") if x and set(x) <= encoder.single]
    assert len(lines) > 30
    pairs = [(total(model, encoder.encode(line))[0], total(model, public.encode(line))[0]) for line in lines]
    # never worse, and mostly the same; single precision costs the library some ties
    assert all(a >= b for a, b in pairs) and np.mean([a == b for a, b in pairs]) > 0.5


@pytest.mark.parametrize("text", ["", " ", "a", "  two  blanks ", "tab\tand\nline\r\n", "▁mark", "naïve 漢字 🎉", "\x00", "x" * 5000])
def test_round_trips(model, text):
    encoder = pieces.Encoder(model)
    assert encoder.decode(encoder.encode(text)) == text


def test_coding_odd_rows(odd, none, model):
    coded = pieces.encode_texts(odd.withColumn("n_tokens", F.lit("x")), model)
    rows = coded.collect()
    assert len(rows) == len(odd_rows()) and all(r.round_trip for r in rows)
    back = {(r.doc_id, r.decoded) for r in pieces.decode_ids(coded, model).collect()}
    assert back == {(r[0], r[1] or "") for r in odd_rows()}
    assert pieces.encode_texts(none, model).count() == 0
