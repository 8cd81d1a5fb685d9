"""Queries on text: normalisation, extraction, resolution and enrichment."""

from __future__ import annotations

from importlib.util import find_spec

from pyspark.sql import functions as F

from postmill.functions import dates, text
from postmill.operators import catalog, enrichment, extraction, resolution
from postmill.operators.ranking import numbered_all
from postmill.plans.base import query
from postmill.sources import store
from postmill.sources.posts import posts, table

#: A post's body in several markings, as an expression that both engines read.
RAZOR, BLADE, SOAP = "razor_brand || ' ' || razor_model", "blade_brand || ' ' || blade_model", "soap_brand || ' - ' || soap_scent"
BODY = f"""CASE use_count % 6 WHEN 0 THEN '* **Razor:** ' || {RAZOR} || chr(10) || '* **Blade:** ' || {BLADE} || ' (' || CAST(use_count AS VARCHAR(10)) || ')' || chr(10) || '* **Lather:** ' || {SOAP} || ' soap'
  WHEN 1 THEN 'Nice day!' || chr(10) || 'Razor: ' || {RAZOR} || ' [x' || CAST(use_count AS VARCHAR(10)) || ']' || chr(10) || 'Soap - ' || {SOAP}
  WHEN 2 THEN '**Razor** ' || {RAZOR} || chr(10) || 'blade = ' || {BLADE} || ' (' || CAST(use_count AS VARCHAR(10)) || ' uses)' || chr(10) || '__Soap:__ ' || {SOAP} || ' sample'
  WHEN 3 THEN 'Razor ' || razor_model || chr(10) || '✓Brush: ' || knot_brand || ' ' || fiber || ' ' || CAST(knot_size_mm AS VARCHAR(10)) || 'mm' || chr(10) || 'Lather games today'
  WHEN 4 THEN 'razor test of the day' || chr(10) || '##Brush## - ' || coalesce(handle_brand, 'Own') || ' w/ ' || knot_brand || ' ' || fiber
  ELSE 'No shave today, [see here](https://example.com/' || id || ') @friend' END"""
BODIES_SQL = f"b AS (SELECT id, month, author, use_count, {BODY} AS body FROM posts)"


def bodies(spark, sf):
    return posts(spark, sf).select("id", "month", "author", "use_count", F.expr(BODY).alias("body"))


def _on(template: str, column: str) -> str:
    return template.replace("{c}", column)


def _trimmed(e: str) -> str:
    return f"trim(regexp_replace({e}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"


LINKS = _trimmed(r"regexp_replace(regexp_replace(regexp_replace({c}, '\[([^\]]+)\]\([^)]*\)', '\1', 'g'), 'https?://[^ )\]]+', '', 'g'), '(?i)\(link\)', '', 'g')")
HANDLES = r"regexp_replace({c}, '(^|[ (])@([A-Za-z0-9_]+)', '\1\2', 'g')"
ASTERISKS = r"trim(regexp_replace(replace({c}, '*', ''), '^[ \-:;,.]+', ''))"


@query("strip_md_links", f"WITH {BODIES_SQL} SELECT id, {_on(LINKS, 'body')} AS text FROM b", posts=True)
def strip_md_links(spark, sf):
    return bodies(spark, sf).select("id", text.strip_links(F.col("body")).alias("text"))


@query("strip_handles", f"WITH {BODIES_SQL} SELECT id, {_on(HANDLES, 'body')} AS text FROM b", posts=True)
def strip_handles(spark, sf):
    return bodies(spark, sf).select("id", text.strip_handles(F.col("body")).alias("text"))


@query("strip_asterisks", f"WITH {BODIES_SQL} SELECT id, {_on(ASTERISKS, 'body')} AS text FROM b", posts=True)
def strip_asterisks(spark, sf):
    return bodies(spark, sf).select("id", text.strip_asterisks(F.col("body")).alias("text"))


@query("strip_competition_tags", """SELECT conv_id, turn, trim(regexp_replace(regexp_replace('$GAME ' || role || ' `#KEEP` *$Test*', '(?i)[`*]*[$#](GAME|TEST)\\b[`*]*', '', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g')) AS text FROM conversations""")
def strip_competition_tags(spark, sf):
    tagged = F.concat(F.lit("$GAME "), "role", F.lit(" `#KEEP` *$Test*"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.strip_tags(tagged, ["GAME", "TEST", "KEEP"], ["keep"]).alias("text"))


@query("strip_competition_tags_full")
def strip_competition_tags_full(spark, sf):
    """The same over the whole texts, with the tags in front; tests have a plain version."""
    tagged = F.concat(F.lit("$GAME `#KEEP` *$Test* "), "text")
    return table(spark, sf, "conversations").select("conv_id", "turn", text.strip_tags(tagged, ["GAME", "TEST", "KEEP"], ["keep"]).alias("text"))


USAGE_SQL = "replace({c}, '*', '')"
for _p in text.PLAIN_USAGE:
    USAGE_SQL = f"regexp_replace({USAGE_SQL}, '{_p}', '', 'g')"
USAGE_SQL = _trimmed(USAGE_SQL)
COUNTED = "CASE use_count % 4 WHEN 0 THEN blade_model || ' (' || use_count || ')' WHEN 1 THEN blade_model || ' [x' || use_count || '] new' WHEN 2 THEN '*' || blade_model || '* {' || use_count || ' uses}' ELSE blade_model || ' #' || use_count END"


@query("strip_usage_counts", f"SELECT id, {_on(USAGE_SQL, '(' + COUNTED + ')')} AS text FROM posts", posts=True)
def strip_usage_counts(spark, sf):
    return posts(spark, sf).select("id", text.strip_usage(F.expr(COUNTED), text.PLAIN_USAGE).alias("text"))


@query("strip_usage_counts_full")
def strip_usage_counts_full(spark, sf):
    """With look-ahead, so years in brackets stay; other engines cannot express that, so tests cover it."""
    return posts(spark, sf).select("id", text.strip_usage(F.expr(COUNTED)).alias("text"))


def _soap_sql(e: str) -> str:
    for pattern, to in text.SOAP_STEPS:
        e = f"regexp_replace({e}, '{pattern}', '{to}', 'g')"
    return _trimmed(e)


#: Soaps with remarks, several product words one behind the other, and dashes.
SOAP_RAW = "CASE use_count % 7 WHEN 0 THEN soap_brand || ' Soap - ' || soap_scent || ' (sample, thanks) shaving cream!' WHEN 1 THEN soap_brand || ' - ' || soap_scent || ' cream stick - soap -' WHEN 2 THEN soap_brand || ' (tallow base) ' || soap_scent || ' - tester' WHEN 3 THEN soap_brand || ' ' || soap_scent || ' (my ' || use_count || 'oz tub) puck. hard tube' WHEN 4 THEN '- ' || soap_scent || ' (est. 1890) crema da barba' WHEN 5 THEN soap_brand || ' Shaving Soap' ELSE soap_brand || ' Soaps' END"


@query("norm_soap_suffix", f"SELECT id, {_soap_sql(SOAP_RAW)} AS text FROM posts", posts=True)
def norm_soap_suffix(spark, sf):
    return posts(spark, sf).select("id", text.strip_soap_rules(F.expr(SOAP_RAW)).alias("text"))


@query("norm_soap_suffix_full", f"SELECT doc_id, {_soap_sql('text')} AS text FROM documents")
def norm_soap_suffix_full(spark, sf):
    """The same over the whole texts of another table."""
    return table(spark, sf, "documents").select("doc_id", text.strip_soap_rules(F.col("text")).alias("text"))


@query("strip_trailing_punct", "SELECT doc_id, regexp_replace(text, '[.!,;: \\t\\r\\n]+$', '') AS text FROM documents")
def strip_trailing_punct(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_end(F.col("text")).alias("text"))


@query("paren_whitespace", "SELECT p_partkey, regexp_replace(regexp_replace('( ' || p_name || '  ) (' || p_type || ' )', '\\([ ]+', '(', 'g'), '[ ]+\\)', ')', 'g') AS text FROM part")
def paren_whitespace(spark, sf):
    wide = F.concat(F.lit("( "), "p_name", F.lit("  ) ("), "p_type", F.lit(" )"))
    return table(spark, sf, "part").select("p_partkey", text.bracket_spaces(wide).alias("text"))


@query("align_norm", f"SELECT doc_id, {_trimmed(f'''regexp_replace(translate(lower(text), '{text.ACCENTED}', '{text.PLAIN}'), '&', ' and ', 'g')''')} AS text FROM documents")
def align_norm(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.for_alignment(F.col("text")).alias("text"))


@query("norm_body")
def norm_body(spark, sf):
    """Unicode forms have no SQL twin; tests compare with a plain version."""
    return table(spark, sf, "pages").select("page_id", text.clean_body("html").alias("text"))


@query("normalize_for_matching", f"""WITH {BODIES_SQL}, s AS (SELECT id, {_on(LINKS, _on(ASTERISKS, _on(HANDLES, 'body')))} AS t FROM b), u AS (SELECT id, {_on(USAGE_SQL, 't')} AS t FROM s)
    SELECT id, nullif({_trimmed(r"regexp_replace(regexp_replace(regexp_replace(t, '\([ ]+', '(', 'g'), '[ ]+\)', ')', 'g'), '[.!,;: \t\r\n]+$', '')")}, '') AS text FROM u""", posts=True)
def normalize_for_matching(spark, sf):
    return bodies(spark, sf).select("id", text.for_matching(F.col("body"), "blade", usage=text.PLAIN_USAGE).alias("text"))


LINES_SQL = f"regexp_replace(coalesce(body, ''), '{extraction.FURTHER}', chr(10) || '\\1', 'g')"


def _field_sql(field: str) -> str:
    unlike, names = extraction.unlike_field(field), extraction.ALIASES[field]
    body = f"regexp_replace({LINES_SQL}, '{unlike}', '', 'g')" if unlike else LINES_SQL
    part = lambda pattern, group: f"nullif(trim(regexp_extract({body}, '{pattern}', {group})), '')"
    marked = extraction.marked_line(names)
    return f"coalesce({part(marked, 2)}, {part(marked, 1)}, {part(extraction.bare_line(names), 1)})"


FIELDS_SQL = ", ".join(f"{_field_sql(f)} AS {f}" for f in extraction.ALIASES)


@query("extract_fields", f"WITH {BODIES_SQL} SELECT id, {FIELDS_SQL} FROM b", posts=True)
def extract_fields(spark, sf):
    return extraction.extract(bodies(spark, sf)).select("id", *extraction.ALIASES)


@query("keep_or_skip", f"WITH {BODIES_SQL}, x AS (SELECT month, {FIELDS_SQL} FROM b) SELECT month, count(*) AS posts, count(coalesce(razor, blade, brush, soap)) AS kept, count(*) - count(coalesce(razor, blade, brush, soap)) AS skipped, count(razor) AS razors, count(blade) AS blades, count(brush) AS brushes, count(soap) AS soaps FROM x GROUP BY 1", posts=True)
def keep_or_skip(spark, sf):
    found = extraction.extract(bodies(spark, sf))
    kept = F.count(F.coalesce(*extraction.ALIASES))
    return found.groupBy("month").agg(F.count("*").alias("posts"), kept.alias("kept"), (F.count("*") - kept).alias("skipped"), *[F.count(f).alias(f + ("es" if f == "brush" else "s")) for f in extraction.ALIASES])


RULES = {"no_shave": "(?i)no shave", "test": "(?i)razor test", "short": "^.{0,20}$"}


@query("extract_filter", f"WITH {BODIES_SQL} SELECT id, concat_ws(',', CASE WHEN regexp_matches(body, '(?i)no shave') THEN 'no_shave' END, CASE WHEN regexp_matches(body, '(?i)razor test') THEN 'test' END, CASE WHEN regexp_matches(body, '^.{{0,20}}$') THEN 'short' END) AS reasons FROM b", posts=True)
def extract_filter(spark, sf):
    return bodies(spark, sf).select("id", F.array_join(extraction.exclusion_reasons(F.col("body"), RULES), ",").alias("reasons"))


@query("extract_override", f"WITH {BODIES_SQL}, o AS (SELECT month, id, 'corrected ' || author AS value FROM posts WHERE use_count = 7) SELECT b.id, coalesce(o.value, {_field_sql('razor')}) AS razor, o.value IS NOT NULL AS overridden FROM b LEFT JOIN o USING (month, id)", posts=True)
def extract_override(spark, sf):
    changes = posts(spark, sf).where("use_count = 7").select("month", "id", F.lit("razor").alias("field"), F.concat(F.lit("corrected "), "author").alias("value"))
    return extraction.with_overrides(extraction.extract(bodies(spark, sf)).select("month", "id", "razor"), changes, "razor").select("id", "razor", "overridden")


_MARK = rf"(?i)^({extraction.SIGNS}){extraction._label(extraction.ALIASES['razor'])}([ *_#]*(?:{extraction.SEPARATOR})?[ *_#]*)"


@query("pattern_usage", f"WITH {BODIES_SQL}, l AS (SELECT unnest(string_split(body, chr(10))) AS line FROM b) SELECT regexp_extract(line, '{_MARK}', 1) || 'label' || regexp_extract(line, '{_MARK}', 2) AS marking, count(*) AS lines FROM l WHERE regexp_matches(line, '(?i)^{extraction.SIGNS}{extraction._label(extraction.ALIASES['razor'])}(?:[ *_#:=-]|//)') GROUP BY 1", posts=True)
def pattern_usage(spark, sf):
    """Lines of each marking of the razor."""
    lines = bodies(spark, sf).select(F.explode(F.split("body", "\n")).alias("line"))
    marks = lines.select(extraction.marking(F.col("line"), "razor").alias("marking")).where("marking IS NOT NULL")
    return marks.groupBy("marking").agg(F.count("*").alias("lines"))


@query("skipped_patterns", """WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM documents), c AS (SELECT line, CASE WHEN line = '' THEN 'blank' WHEN regexp_matches(line, '^[*#>-]') THEN 'marked' WHEN contains(line, ':') THEN 'colon' WHEN regexp_matches(line, '[0-9]') THEN 'number' ELSE 'prose' END AS kind FROM l)
    SELECT kind, count(*) AS lines, min(line) AS example FROM c GROUP BY 1""")
def skipped_patterns(spark, sf):
    line = F.col("line")
    kind = F.when(line == "", "blank").when(line.rlike("^[*#>-]"), "marked").when(line.contains(":"), "colon").when(line.rlike("[0-9]"), "number").otherwise("prose")
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line")).select(F.trim("line").alias("line"))
    return lines.groupBy(kind.alias("kind")).agg(F.count("*").alias("lines"), F.min("line").alias("example"))


@query("garbage_leading", "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) SELECT regexp_extract(line, '^[^A-Za-z0-9]+') AS lead_text, count(*) AS lines FROM l WHERE regexp_matches(line, '^[^A-Za-z0-9]') GROUP BY 1 ORDER BY lines DESC, lead_text LIMIT 20")
def garbage_leading(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike("^[^A-Za-z0-9]"))
    return lines.groupBy(F.regexp_extract("line", "^[^A-Za-z0-9]+", 0).alias("lead_text")).agg(F.count("*").alias("lines")).orderBy(F.desc("lines"), "lead_text").limit(20)


@query("common_prefixes", "WITH p AS (SELECT p_name, unnest(range(3, length(p_name) + 1)) AS n FROM part) SELECT substring(p_name, 1, n) AS prefix, count(*) AS names FROM p GROUP BY 1 HAVING count(*) > 20")
def common_prefixes(spark, sf):
    ends = table(spark, sf, "part").select("p_name", F.explode(F.sequence(F.lit(3), F.length("p_name"))).alias("n"))
    return ends.groupBy(F.substring("p_name", F.lit(1), F.col("n")).alias("prefix")).agg(F.count("*").alias("names")).where("names > 20")


TITLES = "CASE event_id % 5 WHEN 0 THEN 'Thread for Mar ' || CAST(event_id % 33 AS VARCHAR(10)) || ', 2023' WHEN 1 THEN 'Day of ' || CAST(event_id % 14 AS VARCHAR(10)) || '/' || CAST(event_id % 30 AS VARCHAR(10)) || '/2022' WHEN 2 THEN 'On ' || CAST(event_id % 31 AS VARCHAR(10)) || ' October 2021' WHEN 3 THEN CAST(event_id % 32 AS VARCHAR(10)) || '. June' ELSE 'No day here' END"


def _try(y: str, m: str, d: str) -> str:
    return f"try_cast({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"


def _title_sql() -> str:
    name = dates.NAME
    e = lambda p, g: f"nullif(regexp_extract(t, '{p}', {g}), '')"
    no = lambda x: f"nullif(list_position({dates.MONTHS}, {x}), 0)::VARCHAR"
    a, b = rf"\b{name}\s+(\d{{1,2}})\b(?:[,\s]+(\d{{4}}))?", r"\b(\d{1,2})/(\d{1,2})(?:/(\d{4}))?"
    c, d = rf"(\d{{1,2}})\s+{name}\.?,?\s+(\d{{4}})", rf"\b(\d{{1,2}})\.\s+{name}\b"
    y = "'2024'"
    return f"coalesce({_try(f'coalesce({e(a, 3)}, {y})', no(e(a, 1)), e(a, 2))}, {_try(f'coalesce({e(b, 3)}, {y})', e(b, 1), e(b, 2))}, {_try(e(c, 3), no(e(c, 2)), e(c, 1))}, {_try(y, no(e(d, 2)), e(d, 1))})"


@query("parse_title_date", f"SELECT event_id, strftime({_title_sql()}, '%Y-%m-%d') AS day FROM (SELECT event_id, lower({TITLES}) AS t FROM events)")
def parse_title_date(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format(dates.title_date(F.expr(TITLES), F.lit(2024)), "yyyy-MM-dd").alias("day"))


@query("month_span", "SELECT strftime(d, '%Y-%m') AS month FROM generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders), (SELECT date_trunc('month', max(o_orderdate)) FROM orders), INTERVAL 1 MONTH) g(d)")
def month_span(spark, sf):
    ends = table(spark, sf, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("a"), F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("b"))
    return ends.select(F.explode(dates.month_list(F.col("a"), F.col("b"))).alias("month"))


@query("delta_months", "WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate) AS d FROM orders) SELECT strftime(d, '%Y-%m') AS month, k::INTEGER AS back, strftime(d - to_months(k), '%Y-%m') AS other FROM m, (VALUES (1), (12), (60)) v(k)")
def delta_months(spark, sf):
    from postmill.operators.periods import months_before

    months = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).distinct()
    backs = F.explode(F.array(*[F.struct(F.lit(k).alias("back"), months_before(F.col("month"), k).alias("other")) for k in (1, 12, 60)]))
    return months.select("month", backs.alias("x")).select("month", "x.*")


# ---- resolution -------------------------------------------------------------------------------------------------

CATALOG = tuple(resolution.Pattern(p, {"brand": b, "model": m}, s) for p, b, m, s in (
    ("(red|blue).*bolt", "Colour Works", "Bolt", 1), ("bolt", "Plain Works", "Bolt", 2), ("cold (gear|gizmo)", "Frost", "Gear", 1), ("gizmo", "Plain Works", "Gizmo", 2), ("large.*ring", "Titan", "Ring", 1), ("ring", "Plain Works", "Ring", 2), ("widget", "Plain Works", "Widget", 2),
))
NAMES = ("brand", "model")


def first_pattern_sql(text_: str, patterns, value: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text_}, '(?i){p.pattern}') THEN '{p.pattern if value == 'pattern' else p.attributes.get(value)}'" for p in resolution.by_priority(patterns)) + " END"


def verified(spark, sf):
    """Verified names: every fourth distinct part name stands for itself."""
    names = table(spark, sf, "part").select(F.lower("p_name").alias("key")).distinct()
    return names.where("length(key) % 4 = 0").select("key", F.lit("Verified").alias("brand"), F.initcap("key").alias("model"))


VERIFIED_SQL = "v AS (SELECT DISTINCT lower(p_name) AS key FROM part WHERE length(p_name) % 4 = 0)"


@query("exact_lookup", f"WITH {VERIFIED_SQL} SELECT p_partkey, v.key IS NOT NULL AS verified FROM part LEFT JOIN v ON lower(p_name) = v.key")
def exact_lookup(spark, sf):
    found = resolution.resolved(table(spark, sf, "part"), "p_name", verified(spark, sf), (), NAMES)
    return found.select("p_partkey", F.col("match").isNotNull().alias("verified"))


#: Made catalogs by rule: as many entries as a real one, from names that the texts hold and others.
ENTRIES, MAKES = 3_000, 30
SIZES, THINGS = "small red blue cold hot large new old".split(), "anvil bolt gear gizmo plate ring rod widget".split()
PRODUCT = "lower(p_brand || ' ' || p_name)"


def made_catalog() -> list[resolution.Pattern]:
    """Products: most by make, kind and thing, some without the kind, some without the make."""
    out = []
    for n in range(ENTRIES):
        make, size, thing = f"brand#{1 + n % MAKES}", SIZES[n // MAKES % 8], THINGS[n // (8 * MAKES) % 8]
        pattern = f"^{make}[ ].*{size}.*{thing}$" if n < 1920 else f"^{make}[ ].*{THINGS[n // MAKES % 8]}" if n < 2400 else f"{size}[ ]+{thing}"
        out.append(resolution.Pattern(pattern, {"brand": f"Maker {1 + n % MAKES}", "model": f"Model {n}"}, n % 3))
    return out


def _at(words: list[str], n: str) -> str:
    return f"(['{"', '".join(words)}'])[({n}) % 8 + 1]"


CATALOG_SQL = f"""c AS (SELECT n, n % 3 AS section, 'Maker ' || (1 + n % {MAKES}) AS brand, 'Model ' || n AS model,
    CASE WHEN n < 2400 THEN 'brand#' || (1 + n % {MAKES}) || ' ' ELSE {_at(SIZES, f'n // {MAKES}')} END AS must,
    CASE WHEN n < 1920 THEN '^brand#' || (1 + n % {MAKES}) || '[ ].*' || {_at(SIZES, f'n // {MAKES}')} || '.*' || {_at(THINGS, f'n // {8 * MAKES}')} || '$'
      WHEN n < 2400 THEN '^brand#' || (1 + n % {MAKES}) || '[ ].*' || {_at(THINGS, f'n // {MAKES}')} ELSE {_at(SIZES, f'n // {MAKES}')} || '[ ]+' || {_at(THINGS, f'n // {8 * MAKES}')} END AS pattern FROM range({ENTRIES}) r(n))"""


def catalog_best_sql(texts: str) -> str:
    """Of each text t of a table the first entry of c that fits."""
    return f"(SELECT t, arg_min({{brand: c.brand, model: c.model, pattern: c.pattern}}, [section, -length(pattern), n]) AS m FROM (SELECT DISTINCT t FROM {texts}) x JOIN c ON CASE WHEN contains(lower(t), must) THEN regexp_matches(lower(t), pattern) ELSE false END GROUP BY t)"


@query("regex_theta", f"WITH {CATALOG_SQL}, t AS (SELECT p_partkey, {PRODUCT} AS t FROM part), b AS {catalog_best_sql('t')} SELECT p_partkey, m.brand AS brand, m.model AS model, m.pattern AS pattern FROM t LEFT JOIN b USING (t)")
def regex_theta(spark, sf):
    """Products by a catalog of thousands of patterns, fetched through their rarest grams."""
    rows = table(spark, sf, "part").select("p_partkey", F.expr(PRODUCT).alias("t"))
    found = catalog.matched(rows, catalog.catalog_frame(spark, made_catalog()), "t", NAMES)
    return rows.join(found, "t", "left").select("p_partkey", "match.brand", "match.model", "match.pattern")


if find_spec("yaml"):

    @query("scan_yaml_catalog", "SELECT DISTINCT p_brand AS brand, p_name AS model, p_type AS format, (length(p_name) % 3)::INTEGER AS section, '^' || replace(lower(p_brand || ' ' || p_name), ' ', '[ ]+') AS pattern FROM part")
    def scan_yaml_catalog(spark, sf):
        """Products of a table written as a YAML catalog and read back."""
        place = store.scratch(spark, "catalog")
        parts = table(spark, sf, "part").select("p_brand", "p_name", "p_type").distinct()
        entry = F.format_string("'%s, %s, %s':\n  '%s':\n    brand: '%s'\n    format: '%s'\n    section: %d\n    patterns: ['^%s']\n", "p_brand", "p_name", "p_type", "p_name", "p_brand", "p_type", F.length("p_name") % 3, F.regexp_replace(F.lower(F.concat_ws(" ", "p_brand", "p_name")), " ", "[ ]+"))
        parts.select(entry.alias("value")).coalesce(1).write.text(place)
        found = catalog.catalog_frame(spark, catalog.read_catalog(spark, place))
        return found.select(*[F.col("attributes")[n].alias(n) for n in ("brand", "model", "format")], "section", "pattern")


@query("resolve_entities", f"WITH {VERIFIED_SQL}, r AS (SELECT p_partkey, v.key, p_name, {first_pattern_sql('p_name', CATALOG, 'brand')} AS b, {first_pattern_sql('p_name', CATALOG, 'model')} AS m FROM part LEFT JOIN v ON lower(p_name) = v.key) SELECT p_partkey, CASE WHEN key IS NOT NULL THEN 'Verified' ELSE b END AS brand, CASE WHEN key IS NOT NULL THEN 'exact' WHEN b IS NOT NULL THEN 'regex' END AS match_type FROM r")
def resolve_entities(spark, sf):
    return resolution.resolved(table(spark, sf, "part"), "p_name", verified(spark, sf), CATALOG, NAMES).select("p_partkey", "match.brand", "match_type")


@query("blade_pattern_score", """WITH d AS (SELECT DISTINCT p_type, p_name FROM part) SELECT p_type, p_name, p_type <> 'STANDARD' AS special, length(p_name) AS length, length(p_name) - length(replace(p_name, 'e', '')) AS metas, row_number() OVER (ORDER BY p_type = 'STANDARD', length(p_name) DESC, length(p_name) - length(replace(p_name, 'e', '')) DESC, p_name, p_type)::INTEGER AS priority FROM d""")
def blade_pattern_score(spark, sf):
    """Order of a pattern dimension: special formats first, then length, then metacharacters."""
    dim = table(spark, sf, "part").select("p_type", "p_name").distinct().select("p_type", "p_name", (F.col("p_type") != "STANDARD").alias("special"), F.length("p_name").cast("long").alias("length"), (F.length("p_name") - F.length(F.replace("p_name", F.lit("e"), F.lit("")))).cast("long").alias("metas"))
    return numbered_all(dim, [F.desc("special"), F.desc("length"), F.desc("metas"), F.asc("p_name"), F.asc("p_type")], "priority")


BRANDS = tuple(resolution.Pattern(p, {"brand": b}) for p, b in (("^brand#1( |$)", "First"), ("^brand#2( |$)", "Second"), ("^hot", "Heat")))
SOAP_TEXT = "CASE WHEN p_size % 3 = 0 THEN p_brand || ' - ' || p_name ELSE p_brand || ' ' || p_name END"


@query("soap_cascade", f"WITH {VERIFIED_SQL}, {CATALOG_SQL}, s AS (SELECT p_partkey, lower({SOAP_TEXT}) AS t FROM part), d AS {catalog_best_sql('s')}, r AS (SELECT p_partkey, s.t, v.key, d.m.brand AS sb, d.m.model AS ss, {first_pattern_sql('s.t', BRANDS, 'brand')} AS bb FROM s LEFT JOIN v ON s.t = v.key LEFT JOIN d ON s.t = d.t)" + """
    SELECT p_partkey, CASE WHEN key IS NOT NULL THEN 'exact' WHEN sb IS NOT NULL THEN 'scent' WHEN bb IS NOT NULL THEN 'brand' WHEN contains(t, ' - ') THEN 'split' END AS match_type,
      CASE WHEN key IS NOT NULL THEN 'Verified' WHEN sb IS NOT NULL THEN sb WHEN bb IS NOT NULL THEN bb WHEN contains(t, ' - ') THEN split_part(t, ' - ', 1) END AS brand,
      CASE WHEN key IS NOT NULL THEN key WHEN sb IS NOT NULL THEN ss WHEN bb IS NOT NULL THEN trim(regexp_replace(t, CASE bb WHEN 'First' THEN '^brand#1( |$)' WHEN 'Second' THEN '^brand#2( |$)' ELSE '^hot' END, '')) WHEN contains(t, ' - ') THEN split_part(t, ' - ', 2) END AS scent FROM r""")
def soap_cascade(spark, sf):
    """Verified name, else scent pattern of the catalog, else brand pattern with the rest as scent, else a split at the dash."""
    rows = table(spark, sf, "part").select("p_partkey", F.lower(F.expr(SOAP_TEXT)).alias("t"))
    keys = verified(spark, sf).select("key")
    scents = catalog.matched(rows, catalog.catalog_frame(spark, made_catalog()), "t", NAMES).withColumnRenamed("match", "s")
    brand = resolution.first_pattern(F.col("t"), BRANDS, ("brand",))
    found = rows.join(keys, F.col("t") == F.col("key"), "left").join(scents, "t", "left").withColumns({"b": brand, "dash": F.contains(F.col("t"), F.lit(" - "))})
    part = lambda n: F.split_part(F.col("t"), F.lit(" - "), F.lit(n))
    pick = lambda a, b, c, d: F.when(F.col("key").isNotNull(), a).when(F.col("s").isNotNull(), b).when(F.col("b").isNotNull(), c).when(F.col("dash"), d)
    rest = F.trim(F.regexp_replace(F.col("t"), F.col("b.pattern"), F.lit("")))
    return found.select("p_partkey", pick(F.lit("exact"), F.lit("scent"), F.lit("brand"), F.lit("split")).alias("match_type"), pick(F.lit("Verified"), F.col("s.brand"), F.col("b.brand"), part(1)).alias("brand"), pick(F.col("key"), F.col("s.model"), rest, part(2)).alias("scent"))


BRUSH_TEXT = "coalesce(handle_brand, 'Own') || CASE use_count % 4 WHEN 0 THEN ' w/ ' WHEN 1 THEN ' + ' WHEN 2 THEN ' with ' ELSE ' / ' END || knot_brand || ' ' || lower(fiber) || CASE WHEN use_count % 3 = 0 THEN ' ' || CAST(knot_size_mm AS VARCHAR(10)) || 'mm' WHEN use_count % 3 = 1 THEN ' 26x52' ELSE ' 24' END"


def _fiber_sql(t: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, '(?i){p}') THEN '{n}'" for n, p in resolution.FIBERS) + " END"


@query("fiber_detect", f"WITH t AS (SELECT DISTINCT {BRUSH_TEXT} AS t FROM posts) SELECT t, {_fiber_sql('t')} AS fiber FROM t", posts=True)
def fiber_detect(spark, sf):
    return posts(spark, sf).select(F.expr(BRUSH_TEXT).alias("t")).distinct().select("t", resolution.fiber(F.col("t")).alias("fiber"))


SIZE_SQL = r"""coalesce(try_cast(nullif(regexp_extract(t, '(?i)([0-9]{2}(?:\.[0-9]+)?)[ ]*(?:mm)?[ ]*[x×][ ]*[0-9]{2}', 1), '') AS DOUBLE), try_cast(nullif(regexp_extract(t, '(?i)([0-9]{2}(?:\.[0-9]+)?)[ ]*mm', 1), '') AS DOUBLE),
    CASE WHEN try_cast(nullif(regexp_extract(t, '(?:^|[^0-9.])([0-9]{2}(?:\.[0-9]+)?)(?:[^0-9.x]|$)', 1), '') AS DOUBLE) BETWEEN 20 AND 35 THEN try_cast(regexp_extract(t, '(?:^|[^0-9.])([0-9]{2}(?:\.[0-9]+)?)(?:[^0-9.x]|$)', 1) AS DOUBLE) END)"""


@query("knot_size", f"WITH t AS (SELECT DISTINCT {BRUSH_TEXT} AS t FROM posts) SELECT t, {SIZE_SQL} AS knot_size_mm FROM t", posts=True)
def knot_size(spark, sf):
    return posts(spark, sf).select(F.expr(BRUSH_TEXT).alias("t")).distinct().select("t", resolution.knot_size(F.col("t")).alias("knot_size_mm"))


def made_knots() -> list[resolution.Pattern]:
    """Knots by maker's number, fibre and size; a third of them in the section of known ones."""
    fibers = ("badger", "boar", "synthetic")
    return [resolution.Pattern(f"knot {n % 100} {fibers[n // 100 % 3]} {20 + n // 300}", {"brand": f"Knot Maker {n % 100}", "model": f"Knot {n}"}, 1 + (n % 3 > 0)) for n in range(ENTRIES)]


KNOTS_SQL = f"c AS (SELECT n, 1 + (n % 3 > 0)::INTEGER AS section, 'Knot Maker ' || (n % 100) AS brand, 'Knot ' || n AS model, 'knot ' || (n % 100) || ' ' AS must, 'knot ' || (n % 100) || ' ' || (['badger', 'boar', 'synthetic'])[n // 100 % 3 + 1] || ' ' || (20 + n // 300) AS pattern FROM range({ENTRIES}) r(n))"


@query("knot_match", f"WITH {KNOTS_SQL}, t AS (SELECT DISTINCT {BRUSH_TEXT} AS t FROM posts), d AS {catalog_best_sql('t')}, x AS (SELECT t.t, d.m.brand AS known, {_fiber_sql('t.t')} AS f, {SIZE_SQL.replace('extract(t,', 'extract(t.t,')} AS s FROM t LEFT JOIN d ON t.t = d.t) SELECT t, coalesce(known, f, CASE WHEN s IS NOT NULL THEN 'Unknown' END) AS knot, CASE WHEN known IS NOT NULL THEN 'known' WHEN f IS NOT NULL THEN 'fiber' WHEN s IS NOT NULL THEN 'size' END AS strategy FROM x", posts=True)
def knot_match(spark, sf):
    """Knot of the catalog, fibre, size: the first that says something."""
    texts, t = posts(spark, sf).select(F.expr(BRUSH_TEXT).alias("t")).distinct(), F.col("t")
    known = catalog.matched(texts, catalog.catalog_frame(spark, made_knots()), "t", NAMES)
    steps = (("known", F.col("match.brand")), ("fiber", resolution.fiber(t)), ("size", F.when(resolution.knot_size(t).isNotNull(), "Unknown")))
    return texts.join(known, "t", "left").select("t", F.coalesce(*[c for _, c in steps]).alias("knot"), F.coalesce(*[F.when(c.isNotNull(), n) for n, c in steps]).alias("strategy"))


@query("component_score", "SELECT id, (CASE WHEN handle_brand <> '' THEN 5 ELSE 0 END + CASE WHEN handle_model <> '' THEN 5 ELSE 0 END + CASE WHEN fiber <> '' THEN 5 ELSE 0 END + CASE WHEN knot_size_mm IS NOT NULL THEN 2 ELSE 0 END + CASE use_count % 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END)::INTEGER AS score FROM posts", posts=True)
def component_score(spark, sf):
    return posts(spark, sf).select("id", resolution.component_score(F.col("handle_brand"), F.col("handle_model"), F.col("fiber"), F.col("knot_size_mm"), F.col("use_count") % 3).alias("score"))


@query("filtered_semi", "WITH f AS (SELECT DISTINCT lower(p_name) AS name FROM part WHERE p_size > 48) SELECT p_partkey, CASE WHEN lower(p_name) IN (SELECT name FROM f) THEN 'filtered' END AS match_type FROM part")
def filtered_semi(spark, sf):
    parts = table(spark, sf, "part")
    names = parts.where("p_size > 48").select(F.lower("p_name").alias("_n")).distinct()
    return parts.join(names, F.lower("p_name") == F.col("_n"), "left").select("p_partkey", F.when(F.col("_n").isNotNull(), "filtered").alias("match_type"))


@query("positional_compare", "SELECT a.id, a.razor_brand IS NOT DISTINCT FROM b.handle_brand AS brand_same, a.fiber IS NOT DISTINCT FROM b.plate AS fiber_same FROM posts a JOIN posts b USING (id)", posts=True)
def positional_compare(spark, sf):
    """Two systems' results by id, compared with nulls as equal."""
    view = posts(spark, sf)
    a, b = view.select("id", "razor_brand", "fiber"), view.select("id", F.col("handle_brand").alias("_b"), F.col("plate").alias("_f"))
    return a.join(b, "id").select("id", F.col("razor_brand").eqNullSafe(F.col("_b")).alias("brand_same"), F.col("fiber").eqNullSafe(F.col("_f")).alias("fiber_same"))


# ---- enrichment -------------------------------------------------------------------------------------------------

REMAINDER_SQL = "trim(CASE WHEN instr(lower(o), lower(n)) > 0 AND length(n) > 0 THEN substring(o, 1, instr(lower(o), lower(n)) - 1) || substring(o, instr(lower(o), lower(n)) + length(n)) ELSE o END)"


def _count_sql(r: str) -> str:
    patterns = (r"[(\[{][ ]*x?([0-9]+)x?[ ]*(?:uses?)?[ ]*[)\]}]?", r"\b([0-9]+)[ ]*x\b", r"\bx[ ]*([0-9]+)\b", r"\b([0-9]+)(?:st|nd|rd|th)\b", r"#([0-9]+)")
    number = "coalesce(" + ", ".join(f"try_cast(nullif(regexp_extract(lower({r}), '{p}', 1), '') AS INTEGER)" for p in patterns) + ")"
    return f"CASE WHEN regexp_matches(lower({r}), '\\b(new|fresh)\\b') THEN 1 WHEN {number} <= 899 THEN {number} END::INTEGER"


@query("enrich_use_count", f"WITH t AS (SELECT id, {COUNTED} AS o, blade_model AS n FROM posts), r AS (SELECT id, {REMAINDER_SQL} AS rest FROM t) SELECT id, rest AS remainder, {_count_sql('rest')} AS use_count FROM r", posts=True)
def enrich_use_count(spark, sf):
    rows = posts(spark, sf).select("id", enrichment.remainder(F.expr(COUNTED), F.col("blade_model")).alias("remainder"))
    return rows.withColumn("use_count", enrichment.use_count(F.col("remainder")))


SAMPLE_TEXT = "CASE use_count % 4 WHEN 0 THEN soap_scent || ' (sample)' WHEN 1 THEN soap_scent || ' (sample ' || CAST(use_count AS VARCHAR(10)) || ' of 60)' WHEN 2 THEN soap_scent || ' tester 2/5' ELSE soap_scent END"


@query("enrich_sample", rf"""WITH t AS (SELECT id, lower({SAMPLE_TEXT}) AS t FROM posts), k AS (SELECT id, t, CASE WHEN regexp_matches(t, '\b(sample|samp|smush)\b') THEN 'sample' WHEN regexp_matches(t, '\btester\b') THEN 'tester' END AS sample_type FROM t)
    SELECT id, sample_type, CASE WHEN sample_type IS NOT NULL THEN try_cast(nullif(regexp_extract(t, '([0-9]+)[ ]*(?:of|/)[ ]*([0-9]+)', 1), '') AS INTEGER) END AS number, CASE WHEN sample_type IS NOT NULL THEN try_cast(nullif(regexp_extract(t, '([0-9]+)[ ]*(?:of|/)[ ]*([0-9]+)', 2), '') AS INTEGER) END AS total FROM k""", posts=True)
def enrich_sample(spark, sf):
    return posts(spark, sf).select("id", enrichment.sample(F.expr(SAMPLE_TEXT)).alias("s")).select("id", F.col("s.type").alias("sample_type"), "s.number", "s.total")


MAPPED = "CASE razor_format WHEN 'PROMO' THEN 'Shavette' WHEN 'SMALL' THEN 'Cartridge/Disposable' WHEN 'LARGE' THEN 'Half DE (single)' WHEN 'ECONOMY' THEN 'Straight' WHEN 'MEDIUM' THEN '' ELSE 'DE' END"
OTHER = "CASE WHEN use_count % 5 = 0 THEN '' ELSE blade_format END"


@query("enrich_format", f"""WITH t AS (SELECT id, nullif({MAPPED}, '') AS r, nullif({OTHER}, '') AS b FROM posts) SELECT id, CASE WHEN r = 'Cartridge/Disposable' THEN r WHEN starts_with(lower(r), 'shavette (') OR starts_with(r, 'Half DE') THEN r
    WHEN lower(r) = 'shavette' THEN 'Shavette (' || CASE WHEN b = 'DE' THEN 'Half DE' ELSE coalesce(b, 'Unspecified') END || ')' ELSE coalesce(b, r, 'DE') END AS format FROM t""", posts=True)
def enrich_format(spark, sf):
    return posts(spark, sf).select("id", enrichment.razor_format(F.expr(MAPPED), F.expr(OTHER)).alias("format"))


@query("format_compat", f"""WITH t AS (SELECT month, nullif({MAPPED}, '') AS r, nullif({OTHER}, '') AS b FROM posts), c AS (SELECT month, CASE WHEN r IS NULL OR starts_with(lower(r), 'shavette') THEN 'ok' WHEN r IN ('Cartridge/Disposable', 'Straight') THEN CASE WHEN b IS NULL THEN 'ok' ELSE 'warning' END WHEN b IS NULL THEN 'warning'
    WHEN r IN ('DE', 'Half DE', 'AC', 'GEM', 'Injector', 'Hair Shaper') AND NOT CASE r WHEN 'DE' THEN b IN ('DE', 'Half DE') WHEN 'Half DE' THEN b = 'DE' ELSE r = b END THEN 'error' ELSE 'ok' END AS severity FROM t) SELECT month, severity, count(*) AS posts FROM c GROUP BY 1, 2""", posts=True)
def format_compat(spark, sf):
    severity = enrichment.compatibility(F.expr(MAPPED), F.expr(OTHER))
    return posts(spark, sf).groupBy("month", severity.alias("severity")).agg(F.count("*").alias("posts"))


@query("blade_razor_conflicts", f"""WITH t AS (SELECT id, nullif({MAPPED}, '') AS r, nullif({OTHER}, '') AS b FROM posts), x AS (SELECT * FROM t WHERE r IN ('DE', 'Half DE', 'AC', 'GEM', 'Injector', 'Hair Shaper') AND b IS NOT NULL AND NOT CASE r WHEN 'DE' THEN b IN ('DE', 'Half DE') WHEN 'Half DE' THEN b = 'DE' ELSE r = b END)
    SELECT r AS razor, b AS blade, count(*) AS posts, array_to_string(list_sort(list(id))[1:3], ',') AS examples FROM x GROUP BY 1, 2""", posts=True)
def blade_razor_conflicts(spark, sf):
    """Pairs of formats that do not fit, with three examples; only the three least ids of a group are kept on the way."""
    from postmill.operators.ranking import numbered

    rows = posts(spark, sf).select("id", F.expr(MAPPED).alias("razor"), F.nullif(F.expr(OTHER), F.lit("")).alias("blade")).where(F.col("blade").isNotNull())
    bad = rows.where(enrichment.compatibility(F.col("razor"), F.col("blade")) == "error")
    counts = bad.groupBy("razor", "blade").agg(F.count("*").alias("posts"))
    few = numbered(bad, [F.asc("id")], ["razor", "blade"], "_n").where("_n <= 3").groupBy("razor", "blade").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return counts.join(few, ["razor", "blade"])


STRAIGHT_TEXT = "razor_brand || ' ' || width || ' ' || grind || ', ' || lower(point) || CASE WHEN use_count % 2 = 0 THEN ' stainless' ELSE '' END"


def _forms_sql(forms) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(t), {quoted(p)}) THEN {quoted(n)}" for p, n in forms) + " END"


@query("enrich_straight", rf"WITH t AS (SELECT DISTINCT {STRAIGHT_TEXT} AS t FROM posts) SELECT t, nullif(regexp_extract(t, '\b([0-9]{{1,2}}/(?:8|16))\b', 1), '') AS width, {_forms_sql(enrichment.GRIND_FORMS)} AS grind, {_forms_sql(enrichment.POINT_FORMS)} AS point, CASE WHEN contains(lower(t), 'stainless') THEN 'Stainless' ELSE 'Carbon' END AS steel FROM t", posts=True)
def enrich_straight(spark, sf):
    return posts(spark, sf).select(F.expr(STRAIGHT_TEXT).alias("t")).distinct().select("t", enrichment.straight_razor(F.col("t")).alias("s")).select("t", "s.*")


PLATE_TEXT = "razor_model || ' ' || plate_level || '-plate ' || plate || ' 0' || gap || ' ' || tip || ' tip'"


@query("enrich_plates", rf"""WITH t AS (SELECT DISTINCT {PLATE_TEXT} AS t FROM posts) SELECT t, nullif(regexp_extract(lower(t), '(?:^|[^0-9])0?(\.68|\.76|\.84|1\.05)(?:[^0-9]|$)', 1), '') AS gap, upper(nullif(regexp_extract(lower(t), '\b(aa|[a-g])[ -]?plate', 1), '')) AS level,
    CASE WHEN regexp_matches(lower(t), '\b(oc|open[ -]?comb)\b') THEN 'OC' WHEN contains(lower(t), 'lite') THEN 'Lite' ELSE 'Standard' END AS kind, CASE regexp_extract(lower(t), '\b(red|blue|black)[ -]?tip', 1) WHEN 'red' THEN 'Red' WHEN 'blue' THEN 'Blue' WHEN 'black' THEN 'Black' END AS tip FROM t""", posts=True)
def enrich_plates(spark, sf):
    return posts(spark, sf).select(F.expr(PLATE_TEXT).alias("t")).distinct().select("t", enrichment.plates(F.col("t")).alias("s")).select("t", "s.*")


#: What a maker's knots usually are: the fibre and size of most of its posts, the lesser of equally frequent ones.
DEFAULTS_SQL = """f AS (SELECT handle_brand, fiber, knot_size_mm, row_number() OVER (PARTITION BY handle_brand ORDER BY count(*) DESC, fiber, knot_size_mm) AS n FROM posts WHERE handle_brand IS NOT NULL AND use_count > 10 GROUP BY 1, 2, 3), m AS (SELECT handle_brand, fiber AS maker_fiber, knot_size_mm AS maker_size FROM f WHERE n = 1)"""
BARE_BRUSH = f"CASE WHEN use_count % 6 = 0 THEN coalesce(handle_brand, 'Own') || ' with ' || knot_brand ELSE {BRUSH_TEXT} END"


@query("enrich_brush", f"""WITH {DEFAULTS_SQL}, x AS (SELECT id, {_fiber_sql('t')} AS user_fiber, {SIZE_SQL} AS user_size, CASE WHEN use_count % 4 <> 2 THEN fiber END AS fiber, CASE WHEN use_count % 4 <> 2 THEN knot_size_mm END AS knot_size_mm, t, knot_brand, handle_brand, coalesce(handle_brand, 'Own') AS h FROM (SELECT *, {BARE_BRUSH} AS t FROM posts))
    SELECT id, coalesce(user_fiber, fiber, maker_fiber) AS fiber, CASE WHEN user_fiber IS NOT NULL THEN 'user_comment' WHEN fiber IS NOT NULL THEN 'catalog_data' WHEN maker_fiber IS NOT NULL THEN 'handle_maker' END AS fiber_source, coalesce(user_size, knot_size_mm, maker_size) AS knot_size_mm,
      concat_ws(',', CASE WHEN lower(user_fiber) <> lower(fiber) THEN 'fiber' END, CASE WHEN abs(user_size - knot_size_mm) > 0.1 THEN 'knot_size' END) AS mismatches,
      CASE WHEN instr(lower(t), lower(h)) > 0 AND instr(lower(t), lower(knot_brand)) > 0 THEN CASE WHEN instr(lower(t), lower(h)) <= instr(lower(t), lower(knot_brand)) THEN 'handle_primary' ELSE 'knot_primary' END END AS user_intent FROM x LEFT JOIN m USING (handle_brand)""", posts=True)
def enrich_brush(spark, sf):
    """Fibre and size of the text, else of the catalog, else what the handle's maker usually has; where the first two differ, and which part is named first."""
    view = posts(spark, sf)
    counted = view.where("handle_brand IS NOT NULL AND use_count > 10").groupBy("handle_brand", "fiber", "knot_size_mm").agg(F.count("*").alias("n"))
    makers = counted.groupBy("handle_brand").agg(F.min(F.struct((-F.col("n")).alias("less"), "fiber", "knot_size_mm")).alias("usual"))
    known = F.col("use_count") % 4 != 2
    rows = view.withColumns({"t": F.expr(BARE_BRUSH), "fiber": F.when(known, F.col("fiber")), "knot_size_mm": F.when(known, F.col("knot_size_mm"))})
    rows = rows.withColumns({"uf": resolution.fiber(F.col("t")), "us": resolution.knot_size(F.col("t"))}).join(makers, "handle_brand", "left")
    reasons = enrichment.mismatch_reasons({"fiber": (F.col("uf"), F.col("fiber")), "knot_size": (F.col("us"), F.col("knot_size_mm"))})
    source = F.when(F.col("uf").isNotNull(), "user_comment").when(F.col("fiber").isNotNull(), "catalog_data").when(F.col("usual").isNotNull(), "handle_maker")
    size = F.coalesce("us", F.col("knot_size_mm").cast("double"), F.col("usual.knot_size_mm").cast("double"))
    return rows.select("id", F.coalesce("uf", "fiber", "usual.fiber").alias("fiber"), source.alias("fiber_source"), size.alias("knot_size_mm"), F.array_join(reasons, ",").alias("mismatches"), enrichment.intent(F.col("t"), F.coalesce("handle_brand", F.lit("Own")), F.col("knot_brand")).alias("user_intent"))


@query("enrich_merge", "SELECT id, coalesce(nullif(sample_type, ''), nullif(handle_brand, '')) AS value, nullif(concat_ws(' + ', CASE WHEN sample_type IS NOT NULL THEN 'user_comment' END, CASE WHEN handle_brand IS NOT NULL THEN 'catalog_data' END), '') AS source FROM posts", posts=True)
def enrich_merge(spark, sf):
    return posts(spark, sf).select("id", enrichment.preferred(F.col("sample_type"), F.col("handle_brand")).alias("p")).select("id", "p.*")


@query("enrich_override", "WITH o AS (SELECT month, id, CASE WHEN use_count = 8 THEN 'typed' END AS value, use_count = 9 AS use_catalog FROM posts WHERE use_count IN (8, 9)) SELECT p.id, CASE WHEN o.use_catalog THEN knot_brand ELSE coalesce(o.value, p.fiber) END AS fiber FROM posts p LEFT JOIN o USING (month, id)", posts=True)
def enrich_override(spark, sf):
    rows = posts(spark, sf).select("id", "month", "fiber", "knot_brand", "use_count")
    changes = rows.where("use_count IN (8, 9)").select("month", "id", F.lit("fiber").alias("key"), F.when(F.col("use_count") == 8, "typed").alias("value"), (F.col("use_count") == 9).alias("use_catalog"))
    return enrichment.with_enrichment_overrides(rows, changes, "fiber", "knot_brand").select("id", "fiber")
