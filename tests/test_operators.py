"""Operators on literal rows."""

import datetime as dt
import difflib
import functools
import html
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.functions import dates, text
from postmill.operators import catalog, enrichment, extraction, people, periods, ranking, resolution, similarity, strategies
from postmill.operators.categories import SPECS, CategorySpec, category_table
from postmill.plans import tables
from postmill.sources import store


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_category_counts_people_once_and_ties_share_ranks(spark):
    rows = spark.createDataFrame(
        [("2025-01", "1", "a", "Tech"), ("2025-01", "2", "b", "Tech"), ("2025-01", "3", "a", "Grande"), ("2025-01", "4", "b", "Slant"), ("2025-01", "5", None, "Slant"), ("2025-01", "6", "c", None), ("2025-02", "7", "c", "Tech")],
        "month string, id string, author string, name string",
    )
    got = {(r.month, r.name): (r.shaves, r.unique_users, r.rank) for r in category_table(rows, CategorySpec("t", {"name": "name"})).collect()}
    assert got == {("2025-01", "Tech"): (2, 2, 1), ("2025-01", "Grande"): (1, 1, 2), ("2025-01", "Slant"): (1, 1, 2), ("2025-02", "Tech"): (1, 1, 1)}


def test_case_insensitive_group_shows_the_first_spelling(spark):
    rows = spark.createDataFrame([("m", "2", "a", "ACME", "x"), ("m", "1", "b", "Acme", "X")], "month string, id string, author string, soap_brand string, soap_scent string")
    row = category_table(rows, SPECS["soaps"]).first()
    assert (row.name, row.shaves) == ("Acme - X", 2)


def test_category_of_no_rows(spark):
    rows = spark.createDataFrame([], "month string, id string, author string, name string")
    assert category_table(rows, CategorySpec("t", {"name": "name"})).count() == 0


def test_limits_with_ties(spark):
    rows = ranking.ranked(spark.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 5), ("e", 1)], "n string, v int"), [F.desc("v")])
    assert {r.n for r in ranking.rows_with_ties(rows, 2).collect()} == {"a", "b", "c", "d"}
    assert {r.n for r in ranking.rows_with_capped_tie(rows, 2).collect()} == {"a"}
    assert {r.n: r.rank_text for r in ranking.tie_marks(rows).collect()} == {"a": "1 ", "b": "2=", "c": "2=", "d": "2=", "e": "5 "}


def test_moves(spark):
    rows = spark.createDataFrame([("2025-01", "a", 2), ("2025-01", "b", 1), ("2025-02", "a", 1), ("2025-02", "b", 2), ("2025-02", "c", 3)], "month string, name string, rank int")
    got = {r.name: r.move_1 for r in periods.rank_moves(rows, ["name"], (1,)).where("month = '2025-02'").collect()}
    assert got == {"a": "↑1", "b": "↓1", "c": "n/a"}


def test_missed_days_of_a_leap_february(spark):
    rows = spark.createDataFrame([("2024-02", "a", dt.date(2024, 2, d)) for d in range(1, 28)] + [("2024-02", "a", dt.date(2024, 2, 1))], "month string, author string, posted_date date")
    row = people.missed_days(rows).first()
    assert (row.shaves, row.missed_days, row.missed_dates) == (28, 2, "2024-02-28,2024-02-29")


def test_concentration_counts_all_posts_in_shares(spark):
    rows = spark.createDataFrame([("m", "a", "x", True), ("m", "a", "x", True), ("m", "a", "y", True), ("m", "a", "z", False), ("m", "b", "z", False)], "month string, author string, soap string, countable boolean")
    got = people.concentration(rows, F.col("soap"), F.col("countable"), ["month"]).collect()
    assert [(r.user, r.unique_combinations, r.shaves, r.hhi, r.effective_soaps) for r in got] == [("a", 2, 4, 0.3125, 3.2)]


@pytest.mark.parametrize(
    "title, day",
    [("Day of May 3, 2025", "2025-05-03"), ("Day of 5/3/2025", "2025-05-03"), ("on 3 May 2025", "2025-05-03"), ("3. May", "2024-05-03"), ("Feb 30, 2025", None), ("April 2020", None), ("Jun 3", "2024-06-03")],
)
def test_title_dates(spark, title, day):
    assert one(spark, F.date_format(dates.title_date(F.lit(title), F.lit(2024)), "yyyy-MM-dd")) == day


@pytest.mark.parametrize(
    "body, field, value",
    [("* **Razor:** Old Type", "razor", "Old Type"), ("x\nRazor - Slim", "razor", "Slim"), ("__Blade:__ Sharp", "blade", "Sharp"), ("✓Brush: Big", "brush", "Big"), ("##Soap## - Mint", "soap", "Mint"), ("Soap = Lime", "soap", "Lime"),
     ("* **Razor:** A **b** c", "razor", "A **b** c"), ("**Razor:** Old", "razor", "Old"), ("* Razor: Old", "razor", "Old"), ("* **Razor**: Old", "razor", "Old"), ("✂ *Razor:* Old", "razor", "Old"), ("✂**Razor**: Old", "razor", "Old"), ("* **razor ** Old", "razor", "Old"), ("- **Razor**Old", "razor", "Old"),
     ("* **Razor - Old Type** thanks", "razor", "Old Type"), ("**Razor //** Old", "razor", "Old"), ("- __Razor:__ Old", "razor", "Old"), ("✓ Razor - Old", "razor", "Old"), ("* ##Razor## - Old", "razor", "Old"), ("* Razor = Old", "razor", "Old"), ("* Razor Old", "razor", "Old"), ("a straight razor: Old", "razor", None),
     ("Straight Razor: Old", "razor", "Old"), ("Soap & Splash: Mint", "soap", "Mint"), ("Lather & A/S - Mint", "soap", "Mint"), ("Shaving  Brush: Big", "brush", "Big"), ("Razors: Old", "razor", None),
     ("Lather Games day\nLather: Rose", "soap", "Rose"), ("Razor Test it", "razor", None), ("Razor Slim\nRazor: Fat", "razor", "Fat"), ("", "razor", None), (None, "soap", None), ("**Razor** **", "razor", None)],
)
def test_extraction(spark, body, field, value):
    assert one(spark, extraction.field_value(F.lit(body).cast("string"), field)) == value


def test_fields_of_one_line(spark):
    rows = spark.createDataFrame([(1, "* **Razor:** Old Type.* **Blade:** Sharp (3) * Brush: Big\nLather games\n- Soap: Mint - Lime"), (2, None)], "id long, body string")
    got = {r.id: tuple(r)[2:] for r in extraction.extract(rows).collect()}
    assert got == {1: ("Old Type", "Sharp (3)", "Big", "Mint - Lime"), 2: (None,) * 4}


@pytest.mark.parametrize(
    "raw, want",
    [("Edge (12th)", "Edge"), ("Edge {5-ish}", "Edge"), ("Edge (3 uses)", "Edge"), ("Edge (made in India) (first shave!)", "Edge"), ("Edge #4", "Edge"), ("Edge x3", "Edge"), ("Edge (new blade)", "Edge (new blade)"), ("Edge (3)", "Edge"), ("Edge [2x]", "Edge"), ("Edge (x12)", "Edge"), ("Edge (2nd use)", "Edge"), ("Edge (new)", "Edge"), ("Edge (1960)", "Edge (1960)"), ("*Edge* (107 uses)", "Edge"), ("Edge (3", "Edge")],
)
def test_usage_counts(spark, raw, want):
    assert one(spark, text.strip_usage(F.lit(raw))) == want


def test_normalisation_order(spark):
    raw = "*[Old @maker Edge](http://x.y)* $TAG (3)."
    assert one(spark, text.for_matching(F.lit(raw), "blade", ["TAG"])) in ("Old maker Edge", "Old @maker Edge")
    assert one(spark, text.for_matching(F.lit("Mint shaving soap sample"), "soap")) == "Mint"
    assert one(spark, text.for_matching(F.lit("  "), "soap")) is None


def test_clean_body_as_the_plain_version(spark):
    samples = ["ﬁne​ &amp; “so” – ok", "a  b\t c\n\n x ", "\\*bold\\*", "", None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in samples], "t string").select(text.clean_body("t")).collect()]

    def plain(s):
        s = html.unescape(unicodedata.normalize("NFKC", s.replace("​", ""))).replace("“", '"').replace("”", '"').replace("–", "-").replace("\\*", "*")
        return "\n".join(" ".join(x.split()) for x in s.splitlines())

    assert got == [None if s is None else plain(s) for s in samples]


def test_longest_pattern_of_the_first_section_wins(spark):
    patterns = [resolution.Pattern("ring", {"b": "1"}, 1), resolution.Pattern("large ring", {"b": "2"}, 1), resolution.Pattern("very large ring", {"b": "3"}, 2)]
    assert one(spark, resolution.first_pattern(F.lit("a very LARGE ring"), patterns, ["b"]))["b"] == "2"


def test_exact_comes_before_patterns_and_texts_resolve_once(spark):
    rows = spark.createDataFrame([("Old Ring",), ("old ring",), ("new ring",), ("none",), (None,)], "t string")
    lookup = spark.createDataFrame([("old ring", "V")], "key string, b string")
    got = {r.t: (r.match and r.match["b"], r.match_type) for r in resolution.resolved(rows, "t", lookup, [resolution.Pattern("ring", {"b": "P"})], ["b"]).collect()}
    assert got == {"Old Ring": ("V", "exact"), "old ring": ("V", "exact"), "new ring": ("P", "regex"), "none": (None, None), None: (None, None)}


@pytest.mark.parametrize("raw, fiber, size", [("badger/boar 26x52", "Mixed Badger/Boar", 26.0), ("horse + badger", "Mixed Badger/Horse", None), ("syn / badger 26mm", "Mixed Badger/Synthetic", 26.0), ("T3 fan", "Synthetic", None), ("silvertip 24mm", "Badger", 24.0), ("Boar 28", "Boar", 28.0), ("G5C synthetic", "Synthetic", None), ("plain 99", None, None)])
def test_fibre_and_size(spark, raw, fiber, size):
    assert (one(spark, resolution.fiber(F.lit(raw))), one(spark, resolution.knot_size(F.lit(raw)))) == (fiber, size)


@pytest.mark.parametrize("razor, blade, fmt, severity", [("DE", "AC", "AC", "error"), ("Shavette", "DE", "Shavette (Half DE)", "ok"), ("Shavette", "", "Shavette (Unspecified)", "ok"), ("Half DE", "Half DE", "Half DE", "error"), ("", "", "DE", "ok"), ("Straight", "DE", "DE", "warning"), ("AC", "", "AC", "warning")])
def test_formats(spark, razor, blade, fmt, severity):
    assert one(spark, enrichment.razor_format(F.lit(razor), F.lit(blade))) == fmt
    assert one(spark, enrichment.compatibility(F.lit(razor), F.lit(blade))) == severity


@pytest.mark.parametrize("rest, n", [("(3)", 3), ("[x7]", 7), ("12x", 12), ("2nd", 2), ("#5", 5), ("new", 1), ("(1000)", None), ("", None)])
def test_use_counts(spark, rest, n):
    assert one(spark, enrichment.use_count(F.lit(rest))) == n


def test_ratios_as_the_plain_versions(spark):
    pairs = [("brush one", "one brush"), ("abc", ""), ("", ""), ("kitten", "sitting")]
    got = spark.createDataFrame(pairs, "a string, b string").select(similarity.sequence_ratio("a", "b"), similarity.indel_ratio("a", "b")).collect()
    for (a, b), (x, y) in zip(pairs, got):
        assert x == pytest.approx(difflib.SequenceMatcher(None, a, b).ratio())
    assert [r[1] for r in got][1:3] == [0.0, 100.0]
    assert one(spark, similarity.token_sorted(F.lit("Red big Brush"))) == "big brush red"


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


SOAPS = [("Barrister and Mann", "Seville"), ("Barrister & Mann", "Seville"), ("barrister and man", "Sevile"), ("Stirling", "Seville"), ("Sterling", "Bay Rum"), ("Stirling", "bay rum"), ("Stirling", "bay rhum"), ("aé😀", "x"), ("aé😀b", "x"), ("", "x"), (None, "x"), ("Stirling", None)]


@pytest.mark.parametrize("least", [0.5, 0.8, 0.9])
def test_like_products_as_all_pairs(spark, least):
    rows = sorted({(m.lower(), n.lower()) for m, n in SOAPS if m and n})
    want = {(m, n, o, p): (ratio(m, o) + ratio(n, p)) / 2 for m, n in rows for o, p in rows if m != o and ratio(m, o) >= 0.8 * least and (ratio(m, o) + ratio(n, p)) / 2 >= least}
    got = {tuple(r)[:4]: r.similarity for r in similarity.like_products(spark.createDataFrame(SOAPS, "m string, n string"), "m", "n", least).collect()}
    assert got == pytest.approx(want) and want


def test_soap_duplicates_full_as_all_pairs(spark):
    from postmill.plans.registry import QUERIES

    parts = [(r.p_brand.lower(), r.p_name.lower()) for r in spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()]
    rows = sorted(set(parts))
    likes = {(m, o): ratio(m, o) for m in {m for m, _ in rows} for o in {m for m, _ in rows} if m != o}
    want = {(m, n, o, p, parts.count((m, n)) + parts.count((o, p))) for m, n in rows for o, p in rows if m != o and likes[m, o] >= 0.64 and (likes[m, o] + ratio(n, p)) / 2 >= 0.8}
    assert {(r.maker, r.name, r.other_maker, r.other_name, r.rows) for r in QUERIES["soap_duplicates_full"](spark, "/root/testdata/sf0.001").collect()} == want


@functools.cache
def common(a, b):
    """Length of the longest common subsequence."""
    if not a or not b:
        return 0
    return common(a[1:], b[1:]) + 1 if a[0] == b[0] else max(common(a[1:], b), common(a, b[1:]))


def align_score(p, c):
    ratio = lambda a, b: 200 * common(a, b) / (len(a) + len(b))
    words = lambda t: " ".join(sorted(t.lower().split()))
    return 0.6 * ratio(p[0].lower(), c[0].lower()) + 0.4 * ratio(words(p[1]), words(c[1]))


def test_alignment_as_all_pairs(spark):
    parts = [("Brand#12", "cold ring"), ("Brand#9", "old bolt"), ("Other", "cold ring")]
    catalog = [("Brand#13", "ring cold"), ("BRAND#12", "bolt"), ("Brand#1", "zinc"), ("Othello", "xyz"), ("zzz", "cold ring")]
    want = {(*p, *c): round(s, 4) for p in parts for c in catalog if (s := align_score(p, c)) >= 60}
    got = similarity.aligned(spark.createDataFrame(parts, "p_brand string, p_name string"), spark.createDataFrame(catalog, "c_brand string, c_name string"), 60.0)
    assert {tuple(r)[:4]: r.score for r in got.collect()} == pytest.approx(want)
    assert ("Brand#12", "cold ring", "Brand#13", "ring cold") in want and len(want) < len(parts) * len(catalog)


def test_fuzzy_align_as_all_pairs(spark):
    from postmill.plans.registry import QUERIES

    parts = {(r.p_brand, r.p_name) for r in spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()}
    catalog = [c for c in parts if len(c[1]) % 3 == 0]
    want = set()
    for p in parts:
        best = sorted((-round(s, 4), *c) for c in catalog if (s := align_score(p, c)) >= 60)[:3]
        want |= {(*p, b, n, -s, k) for k, (s, b, n) in enumerate(best, 1)}
    got = {(r.p_brand, r.p_name, r.c_brand, r.c_name, r.score, r["rank"]) for r in QUERIES["fuzzy_align"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_clusters_follow_chains(spark):
    pairs = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in similarity.clusters(pairs, "a", "b").collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}


def test_clusters_follow_long_chains(spark):
    names = [f"n{i * 37 % 50:02}" for i in range(50)]
    pairs = spark.createDataFrame(list(zip(names, names[1:])), "a string, b string")
    assert {tuple(r) for r in similarity.clusters(pairs, "a", "b").collect()} == {(n, "n00") for n in names}


def test_like_keys_need_like_makers_and_like_names(spark):
    rows = [("Barrister and Mann", "Seville Nights"), ("barrister and man ", "Seville Night"), ("Barrister and Mann", "Leviathan"), ("A very long name of a maker", "x"), ("A very long name of a maker", "y"), ("Stirling", "Seville Nights")]
    keys = sorted({(m.lower().strip(), n.lower().strip()) for m, n in rows})
    want = {("|".join(x), "|".join(y)) for x in keys for y in keys if x != y and ratio(x[0], y[0]) > 0.9 and ratio(x[1], y[1]) > 0.9}
    assert {tuple(r) for r in similarity.like_keys(spark.createDataFrame(rows, "m string, n string"), "m", "n", 0.9).collect()} == want and len(want) == 2


def test_soap_clusters_as_all_pairs(spark):
    from postmill.plans.registry import QUERIES

    keys = sorted({(r.p_brand.lower().strip(), r.p_name.lower().strip()) for r in spark.read.parquet("/root/testdata/sf0.001/part.parquet").collect()})
    links = {x: [y for y in keys if y != x and (ratio(x[0], y[0]) > 0.9 and ratio(x[1], y[1]) > 0.9 or ratio(y[0], x[0]) > 0.9 and ratio(y[1], x[1]) > 0.9)] for x in keys}
    want = {}
    for x in keys:
        todo = [x] if links[x] and x not in want else []
        while todo:
            y = todo.pop()
            if y not in want:
                want[y] = x
                todo += links[y]
    assert {(r.node, r.cluster) for r in QUERIES["soap_clusters"](spark, "/root/testdata/sf0.001").collect()} == {("|".join(k), min("|".join(x) for x in want if want[x] == v)) for k, v in want.items()}


@pytest.mark.parametrize("raw, want", [
    ("Mill soap gel croap tube", "Mill soap"), ("Mill foam hard stick puck - soap", "Mill"), ("Mill (smush from a friend)", "Mill"), ("Mill (7oz)", "Mill"), ("Mill (Est. 1750 in Bath)", "Mill"), ("Mill (luxury base)", "Mill"),
    ("Soap Barn - Moss (TUSK) - Shave Soap?", "Soap Barn - Moss"), ("Mill (the very large 9oz jar) - omnibus - samp", "Mill"), ("Mill crema  da barba", "Mill"), ("Mill shaving  puck! - hard", "Mill"), ("- Mill shave foam -", "Mill"),
    ("Mill (tester) Moss", "Mill Moss"), ("Mill crema da barba Moss", "Mill Moss"), ("Mill (blue) gel", "Mill (blue)"), ("Creamery", "Creamery"), ("Mill sample!", "Mill sample!"), ("Mill - - soap - cream - -", "Mill"), ("cream", "cream"), ("Mill (30 ozone)", "Mill (30 ozone)"), (" ", ""), (None, None),
])
def test_soap_rules_until_nothing_changes(spark, raw, want):
    once = text.strip_soap_rules(F.lit(raw).cast("string"))
    assert one(spark, once) == want and one(spark, text.strip_soap_rules(once)) == want
    if want:
        assert one(spark, text.for_matching(F.lit(raw), "soap")) == want.rstrip("!")


def test_competition_tags_of_whole_texts(spark):
    from postmill.plans.registry import QUERIES

    tags = re.compile(r"[`*]*[$#](GAME|TEST)\b[`*]*", re.IGNORECASE | re.ASCII)
    want = [(r.conv_id, r.turn, r.text and re.sub("[ \t\r\n\f]+", " ", tags.sub("", "$GAME `#KEEP` *$Test* " + r.text)).strip(" ")) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    got = [tuple(r) for r in QUERIES["strip_competition_tags_full"](spark, "/root/testdata/sf0.001").select("conv_id", "turn", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_upsert_keeps_the_old_row_on_equal_stamps(spark):
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], "id int, ts int, v string")
    new = spark.createDataFrame([(1, 5, "new"), (2, 6, "new"), (3, 1, "new")], "id int, ts int, v string")
    assert {(r.id, r.v) for r in store.upsert(old, new, "id", "ts").collect()} == {(1, "old"), (2, "new"), (3, "new")}


def test_months_round_trip_and_missing(spark, tmp_path):
    (tmp_path / "2025-01.json").write_text('{"meta": {"month": "2025-01"}, "data": [{"id": "1", "author": "a", "body": "Razor: X"}, {"id": "2", "author": "b"}]}')
    (tmp_path / "2025-03.json").write_text('{"meta": {}, "data": [{"id": "3", "author": "a"}]}')
    rows = store.read_month_json(spark, str(tmp_path / "*.json"))
    assert {(r.month, r.id) for r in rows.collect()} == {("2025-01", "1"), ("2025-01", "2"), ("2025-03", "3")}
    assert [r.month for r in store.missing_months(rows).collect()] == ["2025-02"]
    store.write_months(rows, str(tmp_path / "t"))
    store.write_months(rows.where("id = '1'"), str(tmp_path / "t"))
    assert store.read_months(spark, str(tmp_path / "t"), "2025-01", "2025-03").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.read_month_json(spark, str(tmp_path / "none.json"))


def test_table_language():
    r = tables.parse("{{tables.user-soap|ranks:10|columns:rank, user, hhi desc, effective_soaps=soaps|shaves:20|deltas:true}}")
    assert (r.name, r.ranks, r.deltas, r.order, r.threshold) == ("user_soap", 10, True, [("hhi", True)], ("shaves", 20.0))
    assert r.columns[-1] == ("effective_soaps", "soaps")
    for bad in ("{{tables.x|nothing:1}}", "{{tables.x|shaves:1|uses:2}}", "tables.x"):
        with pytest.raises(ValueError):
            tables.parse(bad)


def test_template(spark):
    out = tables.fill("Hi {{name}}\n{{tables.brush-fibers|ranks:3|columns:rank, fiber, shaves}}", {"name": "there"}, spark, "/root/testdata/sf0.001", "2000-03")
    assert out.startswith("Hi there\n| Rank | Fiber | Shaves |")
    with pytest.raises(ValueError):
        tables.fill("{{nothing}}", {}, spark, "/root/testdata/sf0.001", "2000-03")


def test_strategies_come_after_those_that_they_need(spark):
    assert strategies.order({"a": ("c",), "b": (), "c": ("b",)}) == ["b", "c", "a"]
    with pytest.raises(ValueError):
        strategies.order({"a": ("b",), "b": ("a",)})
    with pytest.raises(ValueError):
        strategies.order({"a": ("x",)})
    needs = {"full": ("split",), "split": ("handle",), "handle": ()}
    ran = lambda **hits: one(spark, F.array_join(strategies.run_in_order({s: F.lit(h).cast("boolean") for s, h in hits.items()}, needs), ","))
    assert ran(full=True, split=True, handle=True) == "handle,split,full"
    assert ran(full=True, split=None, handle=True) == "handle" and ran(full=True, split=True, handle=False) == ""


@pytest.mark.parametrize(
    "pattern, runs",
    [("red.*bolt", ["red", "bolt"]), ("colou?rs", ["colo", "rs"]), (r"^brand#1[ ]x\.y", ["brand#1", "x.y"]), ("a|b", []), ("(red|blue) bolt", [" bolt"]), (r"\bring\d{2}mm", ["ring", "mm"]), ("ab{0,2}c", ["a", "c"]), ("ab+c", ["ab", "c"]), ("[^]x]abc", ["abc"]), ("", [])],
)
def test_literal_runs_of_patterns(pattern, runs):
    assert catalog.literal_runs(pattern) == runs


def test_catalog_gives_what_trying_all_patterns_gives(spark):
    rng = np.random.default_rng(5)
    words = ["red", "bolt", "ring", "gear", "Old", "x", "a1"]
    patterns = [resolution.Pattern(p, {"brand": f"b{n}"}, int(rng.integers(0, 3))) for n, p in enumerate(["red.*bolt", "bolt", "r(i|e)ng", "^x", "ge?ar", "old|gear", "[ab]1", "ring$", "zzz", "OLD red", "bolt.?"])]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 5)))) for _ in range(120)] + ["", None]
    got = {r.t: r.match.pattern for r in catalog.matched(spark.createDataFrame([(t,) for t in texts], "t string"), catalog.catalog_frame(spark, patterns), "t", ("brand",)).collect()}
    first = lambda t: min(((p.section, -len(p.pattern), n, p.pattern) for n, p in enumerate(patterns) if re.search(p.pattern, t, re.I)), default=None)
    assert got == {t: first(t)[3] for t in texts if t is not None and first(t)}


def test_catalog_out_of_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("Maker:\n  section: 2\n  Mode\u0301l:\n    format: DE\n    patterns: [one, 'two.*']\n  Other:\n    patterns:\n      - three\n")
    got = [(p.pattern, dict(p.attributes), p.section) for p in catalog.read_catalog(spark, str(tmp_path))]
    assert got == [("one", {"brand": "Maker", "model": "Mod\u00e9l", "format": "DE"}, 2), ("two.*", {"brand": "Maker", "model": "Mod\u00e9l", "format": "DE"}, 2), ("three", {"brand": "Maker", "model": "Other"}, 2)]
    (tmp_path / "c.yaml").write_text("A:\n  patterns: [x]\nA:\n  patterns: [y]\n")
    with pytest.raises(ValueError):
        catalog.read_catalog(spark, str(tmp_path))
