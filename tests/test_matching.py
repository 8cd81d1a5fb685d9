"""Blades, brushes, fields of candidates, filed entries, neighbours, broken months and buckets, against plain versions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from postmill.operators import blades, brushes, catalog, similarity, validation
from postmill.operators.ranking import numbered_all
from postmill.operators.resolution import Pattern
from postmill.sources import store
from postmill.streaming import events as streams
from tests.test_operators import align_score, one


@pytest.mark.parametrize("razor, first, last", [
    ("DE", ["DE", "HALF DE", "AC"], "CARTRIDGE"), ("Half DE (multi-blade)", ["HALF DE", "DE", "AC"], "CARTRIDGE"), ("GEM", ["GEM", "DE", "HALF DE"], "CARTRIDGE"), (None, ["DE"], "CARTRIDGE"), ("Other thing", ["OTHER THING", "DE"], "CARTRIDGE"),
    ("Shavette (AC)", ["AC", "GEM", "INJECTOR", "HAIR SHAPER"], "DE"), ("shavette (Hair Shaper)", ["HAIR SHAPER", "INJECTOR", "GEM", "AC"], "DE"), ("Shavette (Half DE)", ["HALF DE", "DE", "INJECTOR"], "A77"), ("Shavette (Disposable)", ["CARTRIDGE", "INJECTOR"], "DE"),
])
def test_steps_of_a_razor(spark, razor, first, last):
    got = one(spark, blades.steps(F.lit(razor).cast("string")))
    assert got[: len(first)] == first and got[-1] == last and len(got) == len(set(got))


def test_steps_of_razors_without_an_order(spark):
    assert one(spark, blades.steps(F.lit("Straight"))) is None and one(spark, blades.steps(F.lit("shavette (straight)"))) is None
    assert one(spark, blades.steps(F.lit("Shavette"))) == [] and one(spark, blades.steps(F.lit("other"))) == []


def plain_search(text, steps, verified, patterns):
    """Format after format: verified names, then patterns by length; then formats that are on no step."""
    if text is None or steps is None:
        return None
    order = sorted(range(len(patterns)), key=lambda n: (-len(patterns[n][0]), n))
    fits = [n for n in order if patterns[n][0] in text.lower()]
    if not steps:
        return ("regex", patterns[fits[0]][1]) if fits else None
    for formats in [*([f] for f in steps), None]:
        inside = lambda f: f in formats if formats else f not in steps
        if any(k == text.lower() and inside(f) for k, f in verified):
            return ("exact", text.lower())
        for n in fits:
            if inside(patterns[n][2]):
                return ("regex", patterns[n][1])
    return None


def test_blades_as_a_plain_search(spark):
    rng = random.Random(7)
    words = ["iron", "silver", "ridge", "swift", "blue"]
    formats = [*blades.COMMON, "RARE"]
    patterns = [(" ".join(rng.sample(words, rng.choice([1, 2]))), f"m{n}", rng.choice(formats)) for n in range(60)]
    texts = [" ".join(c).title() for r in (1, 2, 3) for c in itertools.permutations(words, r)] + [None]
    verified = sorted({(t.lower(), rng.choice(formats)) for t in texts if t and rng.random() < 0.3})
    razors = ["DE", "GEM", "Shavette (AC)", "Shavette", "Straight", "Half DE", "Other", None]
    rows = spark.createDataFrame([(t, r) for t in texts for r in razors], "t string, r string")
    index = catalog.catalog_frame(spark, [Pattern(p, {"model": m, "format": f}) for p, m, f in patterns])
    names = spark.createDataFrame([(k, f, k) for k, f in verified], "key string, format string, model string")
    got = blades.best_blades(rows, "t", "r", names, catalog.candidates(rows, index, "t", ("model", "format")), ["model"]).collect()
    steps = {r: one(spark, blades.steps(F.lit(r).cast("string"))) for r in razors}
    assert len(got) == len(texts) * len(razors)
    for row in got:
        want = plain_search(row.t, steps[row.r], verified, patterns)
        assert (row.match_type and (row.match_type, row.match.model)) == want, row


def plain_cuts(text):
    def lean(part):
        import re

        return sum(n for p, n in brushes.LEANS if re.search(p, part.lower()))

    out, low = [], text.lower()
    for d, confidence in brushes.DELIMITERS:
        for i in range(len(text)):
            if low[i : i + len(d)] != d or d == "/" and (" " + low)[max(0, i - 1) : i + 1] in brushes.NO_SLASH:
                continue
            a, b = text[:i].strip(" "), text[i + len(d) :].strip(" ")
            b = b.replace(")", "").strip(" ") if d == " (" else b
            if a and b:
                lead = lean(a) - lean(b)
                keep = lead > 0 or lead == 0 and d != " in "
                out.append((i + 1, d, confidence, *((a, b) if keep else (b, a)), abs(lead)))
    return sorted(out)


@pytest.mark.parametrize("text", [
    "Maker A w/ Maker B badger - 26mm", "Badger knot in Maker A w/ resin", "One / Two / Three", "Maker (B badger 24mm) with stand", "u/someone handle w/knot B", "r/brushes", "in in in", "A in B", " w/ ", "", "/a/b", "é / ü (ö)", "a w/b/c r/d",
])
def test_cuts_as_plain_ones(spark, text):
    assert sorted(tuple(c) for c in one(spark, brushes.cuts(F.lit(text)))) == plain_cuts(text)


def test_roles_and_nothing(spark):
    cut = one(spark, brushes.cuts(F.lit("26mm badger knot w/ Custom resin handle")))[0]
    assert (cut.handle, cut.knot, cut.lead) == ("Custom resin handle", "26mm badger knot", 36)
    assert not one(spark, brushes.cuts(F.lit(None).cast("string")))


HANDLES, KNOTS = brushes.Makers(r"\b(oak|elm)\b", r"\b(ash)\b"), brushes.Makers(r"\b(wolf|elm)\b")


@pytest.mark.parametrize("text, want", [
    ("Oak w/ Wolf badger", ("automated_split", 200.0, "oak", "wolf")), ("Oak Wolf", ("full_input", 170.0, "oak", "wolf")), ("Old Oak big classic", ("known_brush", 155.0, "oak", None)),
    ("Ash resin", ("handle_matching", 65.0, "ash", None)), ("badger 24mm", ("knot_matching", 45.0, None, None)), ("nothing", None), (None, None), ("Elm - Elm", ("handle_matching", 50.0, "elm", None)),
])
def test_best_strategy(spark, text, want):
    got = one(spark, brushes.best_of(F.lit(text).cast("string"), r"old oak .*classic$", HANDLES, KNOTS))
    assert (got and (brushes.STRATEGIES[got.strategy], got.score, got.handle, got.knot)) == want


def test_settings_are_scored_like_single_ones(spark):
    low = {**brushes.WEIGHTS, "known_brush": {"base": 1.0}, "full_input": {**brushes.WEIGHTS["full_input"], "base": 500.0}}
    texts = spark.createDataFrame([("Oak w/ Wolf badger",), ("Old Oak big classic",), ("x",)], "t string")
    args = (F.col("t"), r"classic$", HANDLES, KNOTS)
    both = texts.select(brushes.best_by_setting(brushes.candidates(*args), [brushes.WEIGHTS, low]).alias("b"), brushes.best_of(*args).alias("one"), brushes.best_of(*args, low).alias("two")).collect()
    assert all(list(r.b) == [r.one, r.two] for r in both)
    assert [r.two and brushes.STRATEGIES[r.two.strategy] for r in both] == ["full_input", "full_input", None]


def test_no_shuffle_in_scoring(spark):
    frame = spark.range(10).select(brushes.best_of(F.concat(F.lit("oak w/ wolf "), "id"), "x", HANDLES, KNOTS))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_fields_are_resolved_one_by_one(spark):
    patterns = [Pattern("big oak", {"brand": "Oak"}, 2), Pattern("oak", {"brand": "Elm", "model": "M1"}, 1), Pattern("big", {"brand": "Oak", "model": "M2"}, 1), Pattern("zzz", {"brand": "Z"})]
    rows = spark.createDataFrame([("A Big Oak",), ("oak",), ("none",), (None,)], "t string")
    found = catalog.candidates(rows, catalog.catalog_frame(spark, patterns), "t", ("brand", "model"))
    got = {r.t: (r.candidates, r.brand, r.model, r.brand_conflict, r.model_conflict, r.brand_others, r.model_others) for r in catalog.resolved_fields(found, "t", ("brand", "model")).collect()}
    assert got == {"A Big Oak": (3, "Oak", "M1", True, True, ["Elm"], ["M2"]), "oak": (1, "Elm", "M1", False, False, [], [])}


def test_issues_of_filed_entries(spark):
    filed = [("a", "One", "B", "M"), ("a", "one ", "B", "M"), ("b", "ONE", "C", None), ("a", "two", "b", "m"), ("a", "gone", "X", None), ("a", None, "X", "Y")]
    found = [("one", "B", "M"), ("two", "B", "M")]
    got = validation.filed_issues(spark.createDataFrame(filed, "section string, text string, brand string, model string"), spark.createDataFrame(found, "text string, brand string, model string"), ["brand", "model"])
    assert {tuple(r) for r in got.collect()} == {
        ("a", "One", "duplicate_string", "2"), ("a", "one ", "duplicate_string", "2"), *(("b" if t == "ONE" else "a", t, "cross_section_conflict", "a,b") for t in ("One", "one ", "ONE")),
        ("b", "ONE", "structural_change", "model"), ("b", "ONE", "data_mismatch", "brand"), ("a", "gone", "no_match", ""), ("a", None, "no_match", ""),
    }


@pytest.mark.parametrize("count", [0, 1, 50])
def test_numbers_across_ranges(spark, count):
    rows = [(n * 7 % 10, n) for n in range(count)]
    got = {(r.a, r.b): r.place for r in numbered_all(spark.createDataFrame(rows, "a int, b int").repartition(3), [F.desc("a"), F.asc("b")], "place").collect()}
    assert got == {x: i for i, x in enumerate(sorted(rows, key=lambda x: (-x[0], x[1])), 1)}


def test_the_view_follows_its_input(spark, tmp_path):
    from postmill.sources.posts import posts

    for name in ("lineitem", "orders", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(10**9).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = posts(spark, str(tmp_path)).count()
    assert posts(spark, str(tmp_path)).inputFiles() == posts(spark, str(tmp_path)).inputFiles()
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(7).write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert posts(spark, str(tmp_path)).count() == before + 7


@pytest.mark.parametrize("count", [0, 1, 2, 37])
def test_neighbours_across_ranges(spark, count):
    values = [f"v{n * 17 % 100:02}" for n in range(count)]
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    want = sorted(values)
    got = {r.v: (r.before, r.after) for r in similarity.with_neighbours(frame, "v").collect()}
    assert got == {v: (want[i - 1] if i else None, want[i + 1] if i + 1 < count else None) for i, v in enumerate(want)}


def test_neighbours_in_two_passes(spark):
    names = ["aaaa1", "aaaa2", "aaab", "aaac", "mmmm", "zzzz1", "zzzz2", None]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    apart = spark.createDataFrame([("zzzz2", "zzzz1"), ("aaaa2", "aaaa1")], "a string, b string")
    got = {r.name: (r.before, r.after, round(r.similarity, 2)) for r in similarity.sorted_neighbours(frame, "name", apart, 0.6).collect()}
    # aaaa1 is known to differ from its only near neighbour, so it goes, and aaaa2 has none before it then
    assert got == {"aaaa2": (None, "aaab", 0.6), "aaab": ("aaaa2", "aaac", 0.75), "aaac": ("aaab", None, 0.75)}


def test_alignment_by_aliases_without_a_product(spark):
    rng = random.Random(3)
    make = lambda: "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.choice([2, 3, 4])))
    parts = sorted({(make(), f"{make()} {make()}") for _ in range(60)} | {("Mill", "Moss"), ("Old Barn", "Pine")})
    entries = sorted({(make(), f"{make()} {make()}") for _ in range(60)} | {("Mill Soaps", "Moss"), ("Nova", "Pine")})
    aliases = {"Nova": ["Old Barn", "Other"]}
    forms = lambda b: [b, *([b[:-6]] if b.endswith(" Soaps") else []), *aliases.get(b, [])]
    want = {(*p, *c): round(s, 4) for p in parts for c in entries if (s := max(align_score(p, (b, c[1])) for b in forms(c[0]))) >= 75}
    one_, other = spark.createDataFrame(parts, "p_brand string, p_name string"), spark.createDataFrame(entries, "c_brand string, c_name string")
    frame = similarity.aligned(one_, other, 75.0, aliases)
    assert {tuple(r)[:4]: r.score for r in frame.collect()} == pytest.approx(want)
    assert want[("Mill", "Moss", "Mill Soaps", "Moss")] == want[("Old Barn", "Pine", "Nova", "Pine")] == 100
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    met = similarity.like_bags(one_, "p_brand", other, "c_brand", 0.75).count()
    assert met < 0.2 * len({p[0] for p in parts}) * len({c[0] for c in entries})
    with pytest.raises(ValueError, match="any two"):
        similarity.aligned(one_, other, 40.0)


def test_a_year_with_missing_and_broken_months(spark, tmp_path):
    place = str(tmp_path / "year")
    rows = [("2001-01", "a", 1), ("2001-01", "b", 2), ("2001-03", "c", 3), ("2001-03", None, 4), ("2000-12", "d", 5)]
    store.write_month_json(spark.createDataFrame(rows, "month string, id string, n int"), place)
    (tmp_path / "year" / "month=2001-03" / "torn.json").write_text('{"id": "e", "n": 6}\n{"id": "f", "n"\n')
    whole, report = store.read_year(spark, place, 2001, "id string, n int")
    assert sorted(tuple(r) for r in whole.select("month", "id", "n").collect()) == [("2001-01", "a", 1), ("2001-01", "b", 2)]
    got = {r.month: (r.status, r["rows"], r.broken_files) for r in report.collect()}
    assert got.pop("2001-01") == ("included", 2, []) and got.pop("2001-03") == ("corrupt", 3, ["torn.json"])
    assert len(got) == 10 and all(v == ("missing", 0, []) for v in got.values())


def test_upserts_rewrite_only_their_buckets(spark, tmp_path):
    schema = "event_id long, ts timestamp, value int"
    first = spark.range(10_000).select(F.col("id").alias("event_id"), F.lit("2000-01-01").cast("timestamp").alias("ts"), F.lit(1).alias("value"))
    later = first.where("event_id BETWEEN 500 AND 599").withColumns({"ts": F.lit("2000-01-02").cast("timestamp"), "value": F.lit(2)})
    stale = first.where("event_id = 700").withColumns({"ts": F.lit("1999-01-01").cast("timestamp"), "value": F.lit(3)})
    for n, frame in enumerate((first, later.union(stale))):
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.upsert_into(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), width=100).awaitTermination()
    table = spark.read.parquet(str(tmp_path / "out"))
    assert {r.version: r["count"] for r in table.groupBy("version").count().collect()} == {0: 10_000, 1: 200}
    got = {r.event_id: r.value for r in streams.newest(table).collect()}
    assert len(got) == 10_000 and all(got[i] == (2 if 500 <= i < 600 else 1) for i in got)


def test_a_report_from_a_template(spark):
    from postmill.plans import tables
    from postmill.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    month = QUERIES["month_metadata"](spark, sf).agg(F.max("month")).first()[0]
    row = QUERIES["month_metadata"](spark, sf).where(F.col("month") == month).first().asDict()
    text = tables.report_text("# {{month_year}}\n{{total_shaves}} shaves\n{{tables.razors|ranks:3}}\nBye" if "total_shaves" in row else "# {{month_year}}\n{{tables.razors|ranks:3}}\nBye", spark, sf, month)
    assert text.startswith("# ") and text.endswith("Bye") and "{{" not in text and "| Rank |" in text
    with pytest.raises(ValueError, match="unknown placeholders"):
        tables.report_text("{{no_such_figure}}", spark, sf, month)
    with pytest.raises(ValueError, match="no posts"):
        tables.report_text("x", spark, sf, "1900-01")


def test_rendered_cells(spark):
    from postmill.plans import tables

    rows = spark.createDataFrame([("m", 1, "ann", 1234567, None), ("m", 2, None, 5, 2.5)], "month string, rank int, user string, n long, x double")
    got = tables.rendered(rows, {"rank": "Rank", "user": "Who", "n": "N", "x": "X"}, [F.asc("rank")]).orderBy("place").collect()
    assert [r.line for r in got] == ["| Rank | Who | N | X |", "| --- | --- | --- | --- |", "| 1 | u/ann | 1,234,567 |  |", "| 2 |  | 5 | 2.5 |"]
