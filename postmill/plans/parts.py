"""Queries on brush parts, sections of verified names, inline fields, gaps and further steps of text normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.functions import text
from postmill.operators import brushes, catalog, extraction, periods, resolution
from postmill.operators.ranking import ranked
from postmill.plans.base import query
from postmill.plans.brushes import CUTS_SQL
from postmill.plans.texts import BLADE, BODIES_SQL, BRUSH_TEXT, COUNTED, ENTRIES, NAMES, RAZOR, _trimmed, bodies, catalog_best_sql
from postmill.sources import store
from postmill.sources.posts import posts, table

REMARKED = f"CASE use_count % 3 WHEN 0 THEN {RAZOR} || ' (long Handle)' WHEN 1 THEN {RAZOR} || ' (blue) (bamboo handle v2)' ELSE {RAZOR} END"
SOAPY = "CASE use_count % 3 WHEN 0 THEN soap_brand || ' (shaving soap) ' || soap_scent WHEN 1 THEN soap_brand || ' - ' || soap_scent || ' - Soap' ELSE soap_brand || ' [Cream]' END"
ALIASED = "CASE WHEN use_count % 2 = 0 THEN soap_brand || ' Soaps' ELSE soap_brand END"


def _removed(e: str, patterns) -> str:
    for p in patterns:
        e = f"regexp_replace({e}, '{p}', '', 'g')"
    return e


@query("strip_handle_ind", f"SELECT id, {_trimmed(_removed(REMARKED, (text.HANDLE_REMARK,)))} AS text FROM posts", posts=True)
def strip_handle_ind(spark, sf):
    return posts(spark, sf).select("id", text.strip_handle_remark(F.expr(REMARKED)).alias("text"))


@query("strip_soap_patterns", f"SELECT id, {_trimmed(_removed(SOAPY, text.PRODUCT_WORDS))} AS text FROM posts", posts=True)
def strip_soap_patterns(spark, sf):
    return posts(spark, sf).select("id", text.strip_product_words(F.expr(SOAPY)).alias("text"))


@query("strip_trailing_soap", f"SELECT id, {_removed(ALIASED, (text.LAST_SOAP,))} AS text FROM posts", posts=True)
def strip_trailing_soap(spark, sf):
    return posts(spark, sf).select("id", text.strip_last_soap(F.expr(ALIASED)).alias("text"))


@query("remainder_norm", f"SELECT id, trim(regexp_replace(lower({COUNTED}), '[^a-z0-9]+', ' ', 'g')) AS whole, trim(regexp_replace(regexp_replace(lower({COUNTED}), '{text.BRACKETED}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS outside FROM posts", posts=True)
def remainder_norm(spark, sf):
    """Both forms of a remainder: with what stands in brackets, and without."""
    rest = F.expr(COUNTED)
    return posts(spark, sf).select("id", text.plain_remainder(rest).alias("whole"), text.plain_remainder(rest, brackets=False).alias("outside"))


ACRONYMS_SQL = ", ".join(f"'{a}'" for a in text.ACRONYMS)


@query("title_acronyms", f"WITH n AS (SELECT DISTINCT event_type || '_id_hhi' AS name FROM events) SELECT name, array_to_string(list_transform(string_split(name, '_'), lambda w: CASE WHEN w IN ({ACRONYMS_SQL}) THEN upper(w) ELSE upper(w[1:1]) || lower(w[2:]) END), ' ') AS title FROM n")
def title_acronyms(spark, sf):
    names = table(spark, sf, "events").select(F.concat("event_type", F.lit("_id_hhi")).alias("name")).distinct()
    return names.select("name", text.titled(F.col("name")).alias("title"))


# ---- fields -----------------------------------------------------------------------------------------------------

INLINE = f"'Razor: ' || {RAZOR} || ' Blade: ' || {BLADE} || ' **Soap** = ' || soap_brand"


def _inline_sql(field: str) -> str:
    return f"nullif(trim(regexp_replace(regexp_extract({INLINE}, '{extraction.INLINE.replace('{a}', field)}', 1), '{extraction.NEXT_FIELD}', '')), '')"


@query("field_stop", f"SELECT id, {', '.join(f'{_inline_sql(f)} AS {f}' for f in ('razor', 'blade', 'brush', 'soap'))} FROM posts", posts=True)
def field_stop(spark, sf):
    """Fields that share one line: a value ends where the next field begins."""
    return posts(spark, sf).select("id", *[extraction.inline_value(F.expr(INLINE), f).alias(f) for f in ("razor", "blade", "brush", "soap")])


@query("false_positive_guard", f"WITH {BODIES_SQL} SELECT id, " + ", ".join(f"len(list_filter(string_split(coalesce(body, ''), chr(10)), lambda l: regexp_matches(l, '{p}')))::BIGINT AS {f}_lines" for f, p in extraction.NOT_A_FIELD.items()) + " FROM b", posts=True)
def false_positive_guard(spark, sf):
    """Lines that begin like a field but are none."""
    return bodies(spark, sf).select("id", *[extraction.guarded_lines(F.col("body"), f).alias(f"{f}_lines") for f in extraction.NOT_A_FIELD])


# ---- brush parts ------------------------------------------------------------------------------------------------

TEXTS_SQL = f"t AS (SELECT DISTINCT {BRUSH_TEXT} AS t FROM posts)"


def brush_texts(spark, sf):
    return posts(spark, sf).select(F.expr(BRUSH_TEXT).alias("t")).distinct()


def made_handles() -> list[resolution.Pattern]:
    """Handles by maker and the knot that they hold, in two sections."""
    return [resolution.Pattern(f"^brand#{1 + n % 60}[ ].*knot {n // 60}( |$)", {"brand": f"Turner {1 + n % 60}", "model": f"Handle {n}"}, 1 + n % 2) for n in range(ENTRIES)]


HANDLES_SQL = f"c AS (SELECT n, 1 + n % 2 AS section, 'Turner ' || (1 + n % 60) AS brand, 'Handle ' || n AS model, 'brand#' || (1 + n % 60) || ' ' AS must, '^brand#' || (1 + n % 60) || '[ ].*knot ' || (n // 60) || '( |$)' AS pattern FROM range({ENTRIES}) r(n))"


@query("handle_match", f"WITH {TEXTS_SQL}, {HANDLES_SQL}, d AS {catalog_best_sql('t')} SELECT t.t, d.m.brand AS brand, d.m.model AS model, d.m.pattern AS pattern FROM t LEFT JOIN d ON t.t = d.t", posts=True)
def handle_match(spark, sf):
    """Handle makers by section, then by length of the pattern, out of a catalog."""
    texts = brush_texts(spark, sf)
    found = catalog.matched(texts, catalog.catalog_frame(spark, made_handles()), "t", NAMES)
    return texts.join(found, "t", "left").select("t", "match.brand", "match.model", "match.pattern")


def _named_sql(names: str, texts: str, fields: str) -> str:
    """Of each text t the entry of a table with name and fields whose name it holds as a whole: the longest, then the least."""
    return f"(SELECT t, arg_min({{{', '.join(f'{f}: {f}' for f in fields.split(', '))}}}, [(-length(name))::VARCHAR, {fields}]) AS m FROM (SELECT DISTINCT t FROM {texts}) x JOIN {names} ON contains(lower(t), name) AND regexp_matches(lower(t), '(^|[^a-z0-9])' || name || '([^a-z0-9]|$)') GROUP BY t)"


KNOWN_SQL = "kb AS (SELECT lower(knot_brand || ' ' || fiber) AS name, knot_brand AS brand, fiber AS model, min(coalesce(handle_brand, 'Own')) AS handle FROM posts WHERE use_count % 4 = 1 AND knot_brand <> 'Knot 5' GROUP BY 1, 2, 3)"


@query("known_brush", f"WITH {TEXTS_SQL}, {KNOWN_SQL}, d AS {_named_sql('kb', 't', 'brand, model, handle')} SELECT t.t, m.brand AS brand, m.model AS model, m.handle AS handle FROM t LEFT JOIN d USING (t)", posts=True)
def known_brush(spark, sf):
    """Known brushes, whose entry also names the handle, out of a catalog that other posts make."""
    made = posts(spark, sf).where("use_count % 4 = 1 AND knot_brand <> 'Knot 5'").groupBy(F.concat_ws(" ", F.lower("knot_brand"), F.lower("fiber")).alias("name"), F.col("knot_brand").alias("brand"), F.col("fiber").alias("model")).agg(F.min(F.coalesce("handle_brand", F.lit("Own"))).alias("handle"))
    names, texts = ("brand", "model", "handle"), brush_texts(spark, sf)
    found = catalog.matched(texts, catalog.name_catalog(made, "name", names), "t", names)
    return texts.join(found, "t", "left").select("t", *[f"match.{n}" for n in names])


#: Curated splits: texts of one use count, in capitals, of which those of one fibre must not be split.
CURATED_SQL = f"cu AS (SELECT DISTINCT upper({BRUSH_TEXT}) AS entry, fiber = 'Boar' AS keep_whole FROM posts WHERE use_count = 12)"


def curated(spark, sf):
    return posts(spark, sf).where("use_count = 12").select(F.upper(F.expr(BRUSH_TEXT)).alias("entry"), (F.col("fiber") == "Boar").alias("keep_whole")).distinct()


@query("known_split", f"WITH {TEXTS_SQL}, {CURATED_SQL} SELECT t, trim(split_part(entry, ' W/ ', 1)) AS handle, trim(split_part(entry, ' W/ ', 2)) AS knot FROM t JOIN cu ON lower(t) = lower(entry)", posts=True)
def known_split(spark, sf):
    """Texts that a curated split has, in any case; which of them must not be split is for `splits_guard`."""
    half = lambda n: F.trim(F.split_part(F.col("entry"), F.lit(" W/ "), F.lit(n)))
    return brush_texts(spark, sf).join(curated(spark, sf), F.lower("t") == F.lower("entry")).select("t", half(1).alias("handle"), half(2).alias("knot"))


@query("splits_guard", f"WITH {TEXTS_SQL}, {CURATED_SQL}, {CUTS_SQL} SELECT t, count(*) AS cuts FROM cuts WHERE lower(t) NOT IN (SELECT lower(entry) FROM cu WHERE keep_whole) GROUP BY 1", posts=True)
def splits_guard(spark, sf):
    """How many ways there are to cut a text, of those that may be cut."""
    whole = curated(spark, sf).where("keep_whole").select(F.lower("entry").alias("_e"))
    texts = brushes.spread(brush_texts(spark, sf).join(whole, F.lower("t") == F.col("_e"), "left_anti"))
    return texts.select("t", F.size(brushes.cuts(F.col("t"))).cast("long").alias("cuts")).where("cuts > 0")


MAKERS_SQL = "hm AS (SELECT DISTINCT lower(p_brand) AS name, p_brand AS brand FROM part WHERE p_size % 5 <> 0 AND p_brand <> 'Brand#7'), km AS (SELECT DISTINCT lower(knot_brand) AS name, knot_brand AS brand FROM posts WHERE knot_brand <> 'Knot 4')"


def _makers(spark, sf):
    """Handle makers of the products, and knot makers of the posts, each with one that is not known."""
    handles = table(spark, sf, "part").where("p_size % 5 <> 0 AND p_brand <> 'Brand#7'").select(F.lower("p_brand").alias("name"), F.col("p_brand").alias("brand")).distinct()
    knots = posts(spark, sf).where("knot_brand <> 'Knot 4'").select(F.lower("knot_brand").alias("name"), F.col("knot_brand").alias("brand")).distinct()
    return [catalog.name_catalog(m, "name", ["brand"]) for m in (handles, knots)]


@query("full_input", f"WITH {TEXTS_SQL}, {MAKERS_SQL}, h AS {_named_sql('hm', 't', 'brand')}, k AS {_named_sql('km', 't', 'brand')}, m AS (SELECT t.t, h.m.brand AS handle, k.m.brand AS knot FROM t LEFT JOIN h ON h.t = t.t LEFT JOIN k ON k.t = t.t) SELECT *, CASE WHEN handle IS NOT NULL AND knot IS NOT NULL THEN 'both' WHEN handle IS NOT NULL THEN 'handle' WHEN knot IS NOT NULL THEN 'knot' END AS parts FROM m", posts=True)
def full_input(spark, sf):
    """Handle and knot both looked for in the whole text, among the makers of the tables."""
    found = brush_texts(spark, sf)
    for side, makers in zip(("handle", "knot"), _makers(spark, sf)):
        mine = catalog.matched(brush_texts(spark, sf), makers, "t", ["brand"]).select("t", F.col("match.brand").alias(side))
        found = found.join(mine, "t", "left")
    h, k = F.col("handle").isNotNull(), F.col("knot").isNotNull()
    return found.withColumn("parts", F.when(h & k, "both").when(h, "handle").when(k, "knot"))


@query("other_brush", f"WITH {TEXTS_SQL}, {MAKERS_SQL}, h AS {_named_sql('hm', 't', 'brand')} SELECT t.t, h.m.brand AS brand, CASE WHEN h.m IS NOT NULL THEN try_cast(nullif(regexp_extract(t.t, '(?i)\\bknot ([0-9]+)', 1), '') AS INTEGER) END AS model FROM t LEFT JOIN h ON h.t = t.t", posts=True)
def other_brush(spark, sf):
    """Makers with a fixed way of naming: the maker by the catalog, and the model number straight out of the text."""
    texts = brush_texts(spark, sf)
    makers = catalog.matched(texts, _makers(spark, sf)[0], "t", ["brand"])
    model = F.nullif(F.regexp_extract("t", r"(?i)\bknot ([0-9]+)", 1), F.lit("")).try_cast("int")
    return texts.join(makers, "t", "left").select("t", "match.brand", F.when(F.col("match").isNotNull(), model).alias("model"))


# ---- blades and verified names ----------------------------------------------------------------------------------


@query("blade_default", "WITH r AS (SELECT author, blade_format, blade_model, row_number() OVER (PARTITION BY author ORDER BY blade_format <> 'DE', length(blade_model) DESC, blade_format, blade_model) AS k FROM posts) SELECT author, blade_format, blade_model FROM r WHERE k = 1", posts=True)
def blade_default(spark, sf):
    """Without a razor to go by: the common format first, then the longer name."""
    order = F.struct((F.col("blade_format") != "DE").alias("rare"), (-F.length("blade_model")).alias("less"), "blade_format", "blade_model")
    return posts(spark, sf).groupBy("author").agg(F.min(order).alias("b")).select("author", "b.blade_format", "b.blade_model")


SECTION = "CASE WHEN p_size > 40 THEN 1 WHEN p_size < 8 THEN 2 WHEN p_size BETWEEN 20 AND 25 THEN 3 END"


@query("correct_checker", f"WITH s AS (SELECT lower(p_name) AS name, min({SECTION}) AS section FROM part GROUP BY 1) SELECT p_partkey, CASE section WHEN 1 THEN 'brush' WHEN 2 THEN 'handle' WHEN 3 THEN 'knot' END AS section FROM part LEFT JOIN s ON lower(p_name) = s.name")
def correct_checker(spark, sf):
    """In which section a name is verified: brush before handle before knot. The sections meet in one grouping."""
    parts = table(spark, sf, "part").select("p_partkey", F.lower("p_name").alias("name"), F.expr(SECTION).alias("n"))
    first = parts.groupBy("name").agg(F.min("n").alias("first"))
    title = F.when(F.col("first") == 1, "brush").when(F.col("first") == 2, "handle").when(F.col("first") == 3, "knot")
    return parts.join(first, "name", "left").select("p_partkey", title.alias("section"))


# ---- periods ----------------------------------------------------------------------------------------------------


def _gaps_sql(source: str, keys: str, unit: str, form: str) -> str:
    return f"""WITH s AS (SELECT DISTINCT {keys}, date_trunc('{unit}', o_orderdate)::DATE AS d FROM {source}), b AS (SELECT {keys}, min(d) AS first, max(d) AS last FROM s GROUP BY ALL),
    e AS (SELECT {keys}, unnest(generate_series(first, last, INTERVAL 1 {unit}))::DATE AS d FROM b) SELECT {keys}, strftime(d, '{form}') AS {unit} FROM e ANTI JOIN s USING ({keys}, d)"""


@query("missing_months", _gaps_sql("orders", "o_custkey", "month", "%Y-%m"))
def missing_months(spark, sf):
    """Months without an order between the first and the last one of each customer."""
    return store.missing_by(table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderdate"), "month").select("o_custkey", F.date_format("missing", "yyyy-MM").alias("month"))


@query("except_dates", _gaps_sql("orders", "o_orderstatus, o_orderpriority", "day", "%Y-%m-%d"))
def except_dates(spark, sf):
    """All days less those with an order, by status and priority."""
    keys = ["o_orderstatus", "o_orderpriority"]
    return store.missing_by(table(spark, sf, "orders"), keys, F.col("o_orderdate"), "day").select(*keys, F.date_format("missing", "yyyy-MM-dd").alias("day"))


@query("audit_missing", _gaps_sql("orders JOIN customer ON o_custkey = c_custkey", "c_nationkey", "day", "%Y-%m-%d"))
def audit_missing(spark, sf):
    """Days on which nobody of a nation ordered."""
    both = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return store.missing_by(both, ["c_nationkey"], F.col("o_orderdate"), "day").select("c_nationkey", F.date_format("missing", "yyyy-MM-dd").alias("day"))


@query("delta_multi_year", """WITH g AS (SELECT year, razor_brand AS brand, count(*) AS shaves FROM posts GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY year ORDER BY shaves DESC)::INTEGER AS rank FROM g)
    SELECT a.year, a.brand, a.rank, """ + ", ".join(f"CASE WHEN b{k}.rank IS NULL THEN 'n/a' WHEN b{k}.rank > a.rank THEN '↑' || (b{k}.rank - a.rank) WHEN b{k}.rank < a.rank THEN '↓' || (a.rank - b{k}.rank) ELSE '=' END AS move_{k}" for k in (1, 2, 3)) + " FROM r a " + " ".join(f"LEFT JOIN r b{k} ON a.brand = b{k}.brand AND b{k}.year = a.year - {k}" for k in (1, 2, 3)), posts=True)
def delta_multi_year(spark, sf):
    """Moves against several years at once, joined by name."""
    tables = ranked(posts(spark, sf).groupBy("year", F.col("razor_brand").alias("brand")).agg(F.count("*").alias("shaves")), [F.desc("shaves")], ["year"])
    out = periods.earlier_ranks(tables, ["brand"], {f"_then_{k}": F.col("year") + k for k in (1, 2, 3)}, "year")
    return out.select("year", "brand", "rank", *[periods.move_text(F.col(f"_then_{k}") - F.col("rank")).alias(f"move_{k}") for k in (1, 2, 3)])
