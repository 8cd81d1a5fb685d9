"""Queries on blades under the context of their razor, on brush texts, and on candidates that differ."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.operators import blades, brushes, catalog, resolution
from postmill.plans.base import query
from postmill.plans.texts import BLADE, BRUSH_TEXT, CATALOG_SQL, ENTRIES, NAMES, PRODUCT, SIZE_SQL, _fiber_sql, made_catalog
from postmill.sources.posts import posts, table

# ---- blades in the context of a razor -----------------------------------------------------------------------------

RAZOR_CONTEXT = "CASE razor_format WHEN 'PROMO' THEN CASE WHEN use_count % 2 = 0 THEN 'Shavette (AC)' ELSE 'Shavette (Injector)' END WHEN 'SMALL' THEN 'Half DE' WHEN 'LARGE' THEN 'GEM' WHEN 'ECONOMY' THEN 'Shavette' WHEN 'MEDIUM' THEN 'Straight' ELSE 'DE' END"
BLADE_TEXT = f"{BLADE} || CASE use_count % 3 WHEN 0 THEN ' half' WHEN 1 THEN ' xl' ELSE '' END"
#: Suppliers whose blades the made catalog has; each has twelve entries over four of the formats.
MADE = 250


def made_blades() -> list[resolution.Pattern]:
    out = []
    for n in range(ENTRIES):
        s, k = 1 + n % MADE, n // MADE
        pattern = f"^maker {s % 12}[ ].*blade {s}( |$)" if k % 3 == 0 else f"blade {s}[ ]+half" if k % 3 == 1 else f"blade {s}( |$)"
        out.append(resolution.Pattern(pattern, {"brand": f"Works {s % 12}", "model": f"Blade {n}", "format": blades.COMMON[(k * k + s) % 9]}, 0))
    return out


_formats = "['" + "', '".join(blades.COMMON) + "']"
_blade_steps = {
    "Shavette (AC)": "AC GEM INJECTOR HAIR_SHAPER FHS A77 HALF_DE DE", "Shavette (Injector)": "INJECTOR GEM AC HAIR_SHAPER FHS A77 HALF_DE DE", "Half DE": "HALF_DE DE AC GEM INJECTOR FHS HAIR_SHAPER A77 CARTRIDGE",
    "GEM": "GEM DE HALF_DE AC INJECTOR FHS HAIR_SHAPER A77 CARTRIDGE", "DE": "DE HALF_DE AC GEM INJECTOR FHS HAIR_SHAPER A77 CARTRIDGE", "Shavette": "",
}
_steps_sql = ", ".join(f"('{k}', {[f.replace('_', ' ') for f in v.split()]}::VARCHAR[])" for k, v in _blade_steps.items())


@query("blade_ctx", f"""WITH b AS (SELECT {RAZOR_CONTEXT} AS razor, {BLADE_TEXT} AS t, count(*) AS posts FROM posts GROUP BY 1, 2),
    c AS (SELECT n, 1 + n % {MADE} AS s, n // {MADE} AS k FROM range({ENTRIES}) r(n)),
    e AS (SELECT n, 'Works ' || (s % 12) AS brand, 'Blade ' || n AS model, ({_formats})[(k * k + s) % 9 + 1] AS format, 'blade ' || s AS must,
        CASE k % 3 WHEN 0 THEN '^maker ' || (s % 12) || '[ ].*blade ' || s || '( |$)' WHEN 1 THEN 'blade ' || s || '[ ]+half' ELSE 'blade ' || s || '( |$)' END AS pattern FROM c),
    v AS (SELECT DISTINCT lower({BLADE}) AS t, ({_formats})[CAST(split_part(blade_model, ' ', 2) AS INTEGER) * 2 % 9 + 1] AS format, blade_model AS model FROM posts WHERE CAST(split_part(blade_model, ' ', 2) AS INTEGER) % 5 = 0),
    f AS (SELECT x.t, 1 AS kind, -length(pattern) AS less, n, brand, model, format, pattern FROM (SELECT DISTINCT lower(t) AS t FROM b) x JOIN e ON CASE WHEN contains(x.t, must) THEN regexp_matches(x.t, pattern) ELSE false END
        UNION ALL SELECT t, 0, 0, 0, 'Verified', model, format, NULL FROM v),
    s(razor, steps) AS (VALUES {_steps_sql}),
    m AS (SELECT b.razor, b.t, arg_min({{step: CASE WHEN len(steps) = 0 THEN 0 ELSE coalesce(nullif(list_position(steps, format), 0), len(steps) + 1) END, kind: kind, brand: brand, model: model, format: format, pattern: pattern}},
        [CASE WHEN len(steps) = 0 THEN 0 ELSE coalesce(nullif(list_position(steps, format), 0), len(steps) + 1) END, kind, less, n]) AS m FROM b JOIN s USING (razor) JOIN f ON f.t = lower(b.t) WHERE len(steps) > 0 OR kind = 1 GROUP BY 1, 2)
    SELECT b.razor, b.t AS text, posts, m.step::INTEGER AS step, CASE m.kind WHEN 0 THEN 'exact' WHEN 1 THEN 'regex' END AS match_type, m.brand AS brand, m.model AS model, m.format AS format, m.pattern AS pattern FROM b LEFT JOIN m ON b.razor = m.razor AND b.t = m.t""", posts=True)
def blade_ctx(spark, sf):
    """Each blade text with the razor it was used in: searched format by format, verified names before a catalog of thousands of patterns."""
    view = posts(spark, sf)
    rows = view.groupBy(F.expr(RAZOR_CONTEXT).alias("razor"), F.expr(BLADE_TEXT).alias("text")).agg(F.count("*").alias("posts"))
    number = F.split_part("blade_model", F.lit(" "), F.lit(2)).cast("int")
    formats = F.array(*[F.lit(f) for f in blades.COMMON])
    verified = view.where(number % 5 == 0).select(F.lower(F.expr(BLADE)).alias("key"), F.get(formats, number * 2 % 9).alias("format"), F.lit("Verified").alias("brand"), F.col("blade_model").alias("model")).distinct()
    found = catalog.candidates(rows, catalog.catalog_frame(spark, made_blades()), "text", (*NAMES, "format"))
    best = blades.best_blades(rows, "text", "razor", verified, found, NAMES)
    return best.select("razor", "text", "posts", "step", "match_type", "match.*")


ROUTE_CONTEXT = "CASE razor_format WHEN 'LARGE' THEN 'Cartridge/Disposable' WHEN 'PROMO' THEN 'straight' WHEN 'SMALL' THEN 'Shavette (Disposable)' WHEN 'MEDIUM' THEN 'Shavette (Straight)' WHEN 'ECONOMY' THEN '' ELSE blade_format END"


@query("cartridge_auto", f"""WITH r AS (SELECT {ROUTE_CONTEXT} AS razor, CASE WHEN razor_format IN ('LARGE', 'SMALL') THEN 'auto_cartridge' WHEN razor_format IN ('PROMO', 'MEDIUM') THEN 'irrelevant_razor_format' ELSE 'match' END AS route, blade_brand || ' ' || blade_model AS blade, author FROM posts)
    SELECT razor, route, count(*) AS posts, count(DISTINCT author) AS people, count(DISTINCT CASE route WHEN 'match' THEN blade WHEN 'auto_cartridge' THEN 'Cartridge' END) AS blades FROM r GROUP BY 1, 2""", posts=True)
def cartridge_auto(spark, sf):
    """Posts by what becomes of their blade: those of razors that bring their own have one blade, those of bladeless ones none."""
    rows = posts(spark, sf).select(F.expr(ROUTE_CONTEXT).alias("razor"), "author", F.expr(BLADE).alias("text"))
    routed = rows.withColumn("route", blades.route(F.col("razor")))
    blade = F.when(F.col("route") == "match", F.col("text")).when(F.col("route") == "auto_cartridge", F.lit("Cartridge"))
    return routed.groupBy("razor", "route").agg(F.count("*").alias("posts"), F.count_distinct("author").alias("people"), F.count_distinct(blade).alias("blades"))


# ---- cuts and scores of brushes -----------------------------------------------------------------------------------

#: Brush texts with a second place to cut, a bracket, and slashes that are none.
BRUSH = f"{BRUSH_TEXT} || CASE use_count % 5 WHEN 0 THEN ' (resin handle)' WHEN 1 THEN ' in turned stock' WHEN 2 THEN ' r/brushes' ELSE '' END"


def _lean_sql(part: str) -> str:
    return "(" + " + ".join(f"CASE WHEN regexp_matches(lower({part}), '{p}') THEN {n} ELSE 0 END" for p, n in brushes.LEANS) + ")"


_no_slash = ", ".join(f"'{x}'" for x in brushes.NO_SLASH)
CUTS_SQL = f"""d(delimiter, confidence) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in brushes.DELIMITERS)}),
    i AS (SELECT t, delimiter, confidence, unnest(generate_series(1, length(t))) AS i FROM t, d WHERE contains(lower(t), delimiter)),
    p AS (SELECT t, delimiter, confidence, i, trim(substring(t, 1, (i - 1)::INTEGER)) AS l, trim(CASE WHEN delimiter = ' (' THEN replace(substring(t, i + length(delimiter)), ')', '') ELSE substring(t, i + length(delimiter)) END) AS r
        FROM i WHERE substring(lower(t), i, length(delimiter)) = delimiter AND (delimiter <> '/' OR substring(' ' || lower(t), i - 1, 2) NOT IN ({_no_slash}))),
    q AS (SELECT *, {_lean_sql('l')} AS a, {_lean_sql('r')} AS b FROM p WHERE l <> '' AND r <> ''),
    cuts AS (SELECT t, i::INTEGER AS position, delimiter, confidence, CASE WHEN a > b OR (a = b AND delimiter <> ' in ') THEN l ELSE r END AS handle, CASE WHEN a > b OR (a = b AND delimiter <> ' in ') THEN r ELSE l END AS knot, abs(a - b)::INTEGER AS lead FROM q)"""


@query("auto_split", f"WITH t AS (SELECT DISTINCT {BRUSH} AS t FROM posts), {CUTS_SQL} SELECT t AS text, position, delimiter, confidence, handle, knot, lead FROM cuts", posts=True)
def auto_split(spark, sf):
    """Every cut of each brush text, with the roles of its parts."""
    texts = brushes.spread(posts(spark, sf).select(F.expr(BRUSH).alias("text")).distinct())
    return texts.select("text", F.explode_outer(brushes.cuts(F.col("text"))).alias("c")).where("c.position IS NOT NULL").select("text", "c.*")


HANDLE_PATTERNS, KNOT_PATTERNS, KNOWN = (r"\b(brand#[1-9])\b", r"\b(brand#1[0-9])\b"), (r"\b(knot [0-3])\b", r"\b(knot [4-6])\b"), r"^brand#[1-5]\b.*\bknot [0-2]\b"
HANDLES, KNOTS = brushes.Makers(*HANDLE_PATTERNS), brushes.Makers(*KNOT_PATTERNS)


def _maker_sql(part: str, patterns) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(lower({part}), '{p}', 1), '')" for p in patterns) + ")"


def _points_sql(part: str, patterns) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower({part}), '{p}') THEN {3 - k}" for k, p in enumerate(patterns)) + " ELSE 0 END"


def _pair_sql(strategy: str) -> str:
    w = brushes.WEIGHTS[strategy]
    return f"CASE WHEN h IS NULL AND k IS NULL THEN {w['neither_brand']} WHEN k IS NULL THEN {w['handle_brand_without_knot_brand']} WHEN h IS NULL THEN {w['knot_brand_without_handle_brand']} WHEN h = k THEN {w['same_brand']} ELSE 0 END"


def _alone_sql(strategy: str, points: str) -> str:
    w = brushes.WEIGHTS[strategy]
    tests = {"fiber_match": "fiber IS NOT NULL", "size_match": "size IS NOT NULL", "handle_indicators": f"regexp_matches(lower(t), '{brushes.HANDLE_WORDS}')", "knot_indicators": f"regexp_matches(lower(t), '{brushes.KNOT_WORDS}')"}
    parts = [f"CASE WHEN {test} THEN {w[n]} ELSE 0 END" for n, test in tests.items() if n in w]
    brand = "k IS NOT NULL" if strategy == "knot_matching" else "h IS NOT NULL"
    return " + ".join([*parts, f"{w['priority_score']} * {points}", f"CASE WHEN {brand} THEN {w['brand_match']} ELSE 0 END"])


_two = "CASE WHEN h <> k THEN 1 ELSE 0 END"
#: Each text's candidates with the score by the weights but for the base of cuts and the weight of two makers in a full text.
SCORED_SQL = f"""{CUTS_SQL},
    x AS (SELECT t, {_maker_sql('t', HANDLE_PATTERNS)} AS h, {_maker_sql('t', KNOT_PATTERNS)} AS k, {_fiber_sql('t')} AS fiber, {SIZE_SQL} AS size FROM t),
    y AS (SELECT t, row_number() OVER (PARTITION BY t ORDER BY position, delimiter) AS ord, confidence, {_maker_sql('handle', HANDLE_PATTERNS)} AS h, {_maker_sql('knot', KNOT_PATTERNS)} AS k, {_fiber_sql('knot')} AS fiber FROM cuts),
    z AS (SELECT t, 'known_brush' AS strategy, 0 AS ord, h, k, {brushes.WEIGHTS['known_brush']['base']} AS score, 0 AS two FROM x WHERE regexp_matches(lower(t), '{KNOWN}')
      UNION ALL SELECT t, 'automated_split', ord, h, k, {_pair_sql('automated_split')} + CASE WHEN confidence = 'high' THEN 20 ELSE 0 END + 125 * {_two}, 0 FROM y WHERE h IS NOT NULL OR k IS NOT NULL OR fiber IS NOT NULL
      UNION ALL SELECT t, 'full_input', 1000, h, k, 50 + {_pair_sql('full_input')}, {_two} FROM x WHERE h IS NOT NULL OR k IS NOT NULL
      UNION ALL SELECT t, 'handle_matching', 1001, h, NULL, 30 + {_alone_sql('handle_matching', _points_sql('t', HANDLE_PATTERNS))}, 0 FROM x WHERE h IS NOT NULL
      UNION ALL SELECT t, 'knot_matching', 1002, NULL, k, 30 + {_alone_sql('knot_matching', _points_sql('t', KNOT_PATTERNS))}, 0 FROM x WHERE k IS NOT NULL OR fiber IS NOT NULL)"""


@query("brush_score", f"""WITH b AS (SELECT id, {BRUSH} AS t FROM posts), t AS (SELECT DISTINCT t FROM b), {SCORED_SQL},
    s AS (SELECT t, strategy, h, k, (score + CASE strategy WHEN 'automated_split' THEN 55 WHEN 'full_input' THEN 120 * two ELSE 0 END)::DOUBLE AS score, ord FROM z),
    w AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY score DESC, ord) AS n FROM s) SELECT id, strategy, score, h AS handle, k AS knot FROM b LEFT JOIN (SELECT * FROM w WHERE n = 1) USING (t)""", posts=True)
def brush_score(spark, sf):
    """Each post's best strategy for its brush, from features of the text; each distinct text is scored once."""
    found = brushes.best_of_texts(posts(spark, sf).select("id", F.expr(BRUSH).alias("t")), "t", KNOWN, HANDLES, KNOTS)
    return found.select("id", brushes.strategy_name(F.col("b.strategy")).alias("strategy"), "b.score", "b.handle", "b.knot")


#: Settings that are compared: the base of cuts, and the weight of two makers in a full text.
SPLIT_BASES, FULL_WEIGHTS = (-80.0, 15.0, 55.0, 95.0), (60.0, 120.0, 220.0)
SETTINGS = [(a, b) for a in SPLIT_BASES for b in FULL_WEIGHTS]


@query("strategy_optimizer", f"""WITH b AS (SELECT {BRUSH} AS t, {_maker_sql("coalesce(handle_brand, '')", HANDLE_PATTERNS)} AS true_h, {_maker_sql('knot_brand', KNOT_PATTERNS)} AS true_k FROM posts), t AS (SELECT DISTINCT t FROM b), {SCORED_SQL},
    g(setting, split_base, full_weight) AS (VALUES {', '.join(f'({n}, {a}, {b})' for n, (a, b) in enumerate(SETTINGS, 1))}),
    s AS (SELECT setting, t, h, k, row_number() OVER (PARTITION BY setting, t ORDER BY score + CASE strategy WHEN 'automated_split' THEN split_base WHEN 'full_input' THEN full_weight * two ELSE 0 END DESC, ord) AS n FROM z, g),
    r AS (SELECT g.setting, split_base, full_weight, s.t IS NOT NULL AND h IS NOT DISTINCT FROM true_h AND k IS NOT DISTINCT FROM true_k AS good FROM b CROSS JOIN g LEFT JOIN s ON s.t = b.t AND s.setting = g.setting AND n = 1)
    SELECT setting::INTEGER AS setting, any_value(split_base)::DOUBLE AS split_base, any_value(full_weight)::DOUBLE AS full_weight, count(*) AS cases, count(*) FILTER (good) AS correct, round_even(count(*) FILTER (good) / count(*), 4) AS accuracy FROM r GROUP BY 1""", posts=True)
def strategy_optimizer(spark, sf):
    """How often each setting of weights finds the true makers: features once for each text, scored against all settings in one pass."""
    rows = posts(spark, sf).select(F.expr(BRUSH).alias("t"), HANDLES.name(F.coalesce("handle_brand", F.lit(""))).alias("true_h"), KNOTS.name(F.col("knot_brand")).alias("true_k"))
    cases = brushes.spread(rows.groupBy("t", "true_h", "true_k").agg(F.count("*").alias("n")))
    changed = lambda a, b: {**brushes.WEIGHTS, "automated_split": {**brushes.WEIGHTS["automated_split"], "base": a}, "full_input": {**brushes.WEIGHTS["full_input"], "multiple_brands": b}}
    found = brushes.best_by_setting(brushes.candidates(F.col("t"), KNOWN, HANDLES, KNOTS), [changed(*s) for s in SETTINGS])
    good = F.col("b").isNotNull() & F.col("b.handle").eqNullSafe(F.col("true_h")) & F.col("b.knot").eqNullSafe(F.col("true_k"))
    runs = cases.select("n", "true_h", "true_k", F.posexplode_outer(found).alias("s", "b")).groupBy("s").agg(F.sum("n").alias("cases"), F.sum(F.when(good, F.col("n")).otherwise(0)).alias("correct"))
    value = lambda k: F.get(F.array(*[F.lit(s[k]) for s in SETTINGS]), F.col("s"))
    return runs.select((F.col("s") + 1).alias("setting"), value(0).alias("split_base"), value(1).alias("full_weight"), "cases", "correct", F.bround(F.col("correct") / F.col("cases"), 4).alias("accuracy"))


# ---- candidates that differ ---------------------------------------------------------------------------------------


@query("conflict_detect", f"""WITH {CATALOG_SQL}, t AS (SELECT DISTINCT {PRODUCT} AS t FROM part), f AS (SELECT t.t, section, -length(pattern) AS less, n, brand, model FROM t JOIN c ON CASE WHEN contains(t.t, must) THEN regexp_matches(t.t, pattern) ELSE false END),
    w AS (SELECT t, count(*)::INTEGER AS candidates, {', '.join(f'first({x} ORDER BY less, section, n) AS {x}, list_sort(list(DISTINCT {x})) AS all_{x}' for x in ('brand', 'model'))} FROM f GROUP BY t)
    SELECT t AS text, candidates, {', '.join(f"{x}, len(all_{x}) > 1 AS {x}_conflict, array_to_string(list_filter(all_{x}, lambda y: y <> {x}), ',') AS {x}_others" for x in ('brand', 'model'))} FROM w""")
def conflict_detect(spark, sf):
    """Products that several patterns fit: what they differ in, the value that holds, and the others."""
    rows = table(spark, sf, "part").select(F.expr(PRODUCT).alias("text"))
    found = catalog.candidates(rows, catalog.catalog_frame(spark, made_catalog()), "text", NAMES)
    out = catalog.resolved_fields(found, "text", NAMES)
    return out.select("text", "candidates", *[c for n in NAMES for c in (F.col(n), F.col(f"{n}_conflict"), F.array_join(f"{n}_others", ",").alias(f"{n}_others"))])
