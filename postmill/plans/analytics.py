"""Queries on data quality, similarity, set operations, sources and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from postmill.functions import text
from postmill.operators import brushes, catalog, periods, resolution, similarity, validation
from postmill.operators.ranking import numbered
from postmill.plans.base import query
from postmill.plans.brushes import BRUSH, HANDLES, KNOTS, KNOWN, SCORED_SQL
from postmill.plans.texts import BRUSH_TEXT, CATALOG, CATALOG_SQL, NAMES, PRODUCT, VERIFIED_SQL, _fiber_sql, catalog_best_sql, first_pattern_sql, made_catalog, verified
from postmill.sources import store
from postmill.sources.posts import posts, table

MATCHED_SQL = f"{VERIFIED_SQL}, mt AS (SELECT p_partkey, p_name, p_brand, CASE WHEN v.key IS NOT NULL THEN 'exact' WHEN {first_pattern_sql('p_name', CATALOG, 'brand')} IS NOT NULL THEN 'regex' END AS match_type, CASE WHEN v.key IS NOT NULL THEN 'Verified' ELSE {first_pattern_sql('p_name', CATALOG, 'brand')} END AS brand, CASE WHEN v.key IS NULL THEN {first_pattern_sql('p_name', CATALOG, 'model')} END AS model, CASE WHEN v.key IS NULL THEN {first_pattern_sql('p_name', CATALOG, 'pattern')} END AS pattern FROM part LEFT JOIN v ON lower(p_name) = v.key)"


def matched(spark, sf):
    found = resolution.resolved(table(spark, sf, "part"), "p_name", verified(spark, sf), CATALOG, NAMES)
    model = F.when(F.col("match_type") == "regex", F.col("match.model"))
    return found.select("p_partkey", "p_name", "p_brand", "match_type", "match.brand", model.alias("model"), "match.pattern")


KINDS = ("razor", "blade", "brush", "soap")


@query("match_stats", """WITH x AS (SELECT month, unnest(['razor', 'blade', 'brush', 'soap']) AS field, unnest([razor_brand, CASE WHEN use_count > 3 THEN blade_brand END, handle_brand, sample_type]) AS brand FROM posts)
    SELECT month, field, count(*) AS present, count(brand) AS matched, round_even(100.0 * count(brand) / count(*), 2) AS success FROM x GROUP BY 1, 2""", posts=True)
def match_stats(spark, sf):
    fields = (("razor", F.col("razor_brand")), ("blade", F.when(F.col("use_count") > 3, F.col("blade_brand"))), ("brush", F.col("handle_brand")), ("soap", F.col("sample_type")))
    rows = posts(spark, sf).select("month", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.alias("brand")) for n, c in fields])).alias("x")).select("month", "x.*")
    return rows.groupBy("month", "field").agg(F.count("*").alias("present"), F.count("brand").alias("matched"), F.bround(100.0 * F.count("brand") / F.count("*"), 2).alias("success"))


@query("month_summary", "SELECT month, count(*) AS records, count(razor_brand) AS razors, count(handle_brand) AS brushes, count(sample_type) AS samples, count(*) - count(handle_brand) AS unmatched_brushes FROM posts GROUP BY 1", posts=True)
def month_summary(spark, sf):
    return posts(spark, sf).groupBy("month").agg(F.count("*").alias("records"), F.count("razor_brand").alias("razors"), F.count("handle_brand").alias("brushes"), F.count("sample_type").alias("samples"), (F.count("*") - F.count("handle_brand")).alias("unmatched_brushes"))


@query("unmatched", f"WITH {MATCHED_SQL} SELECT lower(p_name) AS text, count(*) AS parts, array_to_string(list_sort(list(p_partkey))[1:5], ',') AS examples FROM mt WHERE brand IS NULL GROUP BY 1")
def unmatched(spark, sf):
    rows = matched(spark, sf).where("brand IS NULL").select(F.lower("p_name").alias("text"), "p_partkey")
    few = numbered(rows, [F.asc("p_partkey")], ["text"], "_n").where("_n <= 5").groupBy("text").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda x: x.cast("string")), ",").alias("examples"))
    return rows.groupBy("text").agg(F.count("*").alias("parts")).join(few, "text")


#: Entries that several texts may fit: names of some parts, and what is left of others without the first word.
KNOWN_SQL = "k AS (SELECT DISTINCT lower(p_name) AS name FROM part WHERE p_size % 7 = 0 UNION SELECT DISTINCT lower(split_part(p_name, ' ', 2)) FROM part WHERE p_size > 48 AND split_part(p_name, ' ', 2) <> ''), kh AS (SELECT t, count(*) AS hits FROM (SELECT DISTINCT lower(p_name) AS t FROM part) x JOIN k ON regexp_matches(t, '(^|[^a-z0-9])' || name || '([^a-z0-9]|$)') GROUP BY t)"
MISMATCH_SQL = f"{MATCHED_SQL}, {KNOWN_SQL}, mm AS (SELECT mt.*, levenshtein(lower(p_name), lower(model)) AS distance, coalesce(hits, 0) AS hits FROM mt LEFT JOIN kh ON t = lower(p_name))"


def _mismatch(spark, sf):
    """Matches with the distance between text and model, and how many entries of a catalog made from the table fit."""
    parts = table(spark, sf, "part")
    rest = F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))
    known = parts.where("p_size % 7 = 0").select(F.lower("p_name").alias("name")).union(parts.where("p_size > 48").select(F.lower(rest))).distinct()
    fits = catalog.candidates(parts.select(F.lower("p_name").alias("t")), catalog.name_catalog(known, "name", ["name"]), "t", ["name"])
    hits = fits.groupBy("t").agg(F.count("*").alias("hits"))
    rows = matched(spark, sf).join(hits, F.lower("p_name") == F.col("t"), "left")
    return rows.withColumns({"distance": F.levenshtein(F.lower("p_name"), F.lower("model")), "hits": F.coalesce("hits", F.lit(0))})


@query("mismatch", f"WITH {MISMATCH_SQL} SELECT p_partkey, concat_ws(',', CASE WHEN match_type = 'exact' THEN 'confirmed' END, CASE WHEN distance > 5 THEN 'levenshtein' END, CASE WHEN distance <= 5 THEN 'good' END, CASE WHEN hits > 1 THEN 'multi_pattern' END, CASE WHEN match_type IS NULL THEN 'low_confidence' END) AS buckets FROM mm")
def mismatch(spark, sf):
    """A row can be in several buckets."""
    buckets = (("confirmed", F.col("match_type") == "exact"), ("levenshtein", F.col("distance") > 5), ("good", F.col("distance") <= 5), ("multi_pattern", F.col("hits") > 1), ("low_confidence", F.col("match_type").isNull()))
    return _mismatch(spark, sf).select("p_partkey", F.concat_ws(",", *[F.when(c, n) for n, c in buckets]).alias("buckets"))


@query("mismatch_group", f"WITH {MISMATCH_SQL} SELECT lower(p_name) AS text, brand, model, count(*) AS parts, min(p_partkey) AS example FROM mm WHERE hits > 1 GROUP BY 1, 2, 3")
def mismatch_group(spark, sf):
    return _mismatch(spark, sf).where("hits > 1").groupBy(F.lower("p_name").alias("text"), "brand", "model").agg(F.count("*").alias("parts"), F.min("p_partkey").alias("example"))


@query("pattern_effectiveness", f"WITH {MATCHED_SQL} SELECT pattern, count(*) AS parts, count(DISTINCT lower(p_name)) AS texts, round_even(0.6 * avg(CASE WHEN lower(p_name) = pattern THEN 1 ELSE 0 END) + 0.4 * avg(length(pattern) / length(p_name)), 4) AS effectiveness FROM mt WHERE pattern IS NOT NULL GROUP BY 1")
def pattern_effectiveness(spark, sf):
    rows = matched(spark, sf).where("pattern IS NOT NULL")
    exact, share = F.avg(F.when(F.lower("p_name") == F.col("pattern"), 1).otherwise(0)), F.avg(F.length("pattern") / F.length("p_name"))
    return rows.groupBy("pattern").agg(F.count("*").alias("parts"), F.count_distinct(F.lower("p_name")).alias("texts"), F.bround(0.6 * exact + 0.4 * share, 4).alias("effectiveness"))


@query("confidence", f"WITH {MATCHED_SQL}, s AS (SELECT p_partkey, CASE match_type WHEN 'exact' THEN 60 WHEN 'regex' THEN 40 ELSE 0 END + CASE WHEN brand IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN model IS NOT NULL THEN 20 ELSE 0 END AS score, brand, model FROM mt) SELECT p_partkey, score::INTEGER AS score, CASE WHEN score >= 80 THEN 'high' WHEN score >= 50 THEN 'medium' ELSE 'low' END AS level, concat_ws(',', CASE WHEN brand IS NULL THEN 'no_brand' END, CASE WHEN model IS NULL THEN 'no_model' END) AS issues FROM s")
def confidence(spark, sf):
    rows = matched(spark, sf)
    score = F.when(F.col("match_type") == "exact", 60).when(F.col("match_type") == "regex", 40).otherwise(0) + F.when(F.col("brand").isNotNull(), 20).otherwise(0) + F.when(F.col("model").isNotNull(), 20).otherwise(0)
    rows = rows.withColumn("score", score)
    return rows.select("p_partkey", "score", F.when(F.col("score") >= 80, "high").when(F.col("score") >= 50, "medium").otherwise("low").alias("level"), F.concat_ws(",", F.when(F.col("brand").isNull(), "no_brand"), F.when(F.col("model").isNull(), "no_model")).alias("issues"))


@query("field_analyzers", "SELECT razor_format AS value, count(*) AS posts, count(DISTINCT author) AS people, count(DISTINCT razor_model) AS models FROM posts GROUP BY 1 ORDER BY posts DESC, value LIMIT 10", posts=True)
def field_analyzers(spark, sf):
    return posts(spark, sf).groupBy(F.col("razor_format").alias("value")).agg(F.count("*").alias("posts"), F.count_distinct("author").alias("people"), F.count_distinct("razor_model").alias("models")).orderBy(F.desc("posts"), "value").limit(10)


@query("personna_analysis", "SELECT razor_format, blade_format, count(*) AS posts FROM posts WHERE blade_brand = 'Maker 7' GROUP BY 1, 2", posts=True)
def personna_analysis(spark, sf):
    """Cross table of one maker's blades."""
    return posts(spark, sf).where("blade_brand = 'Maker 7'").groupBy("razor_format", "blade_format").agg(F.count("*").alias("posts"))


@query("catalog_quality", "WITH c AS (SELECT p_brand, (p_name IS NOT NULL)::INTEGER + (p_type <> 'SMALL')::INTEGER + (p_size > 20)::INTEGER + (p_retailprice > 1000)::INTEGER AS fields FROM part) SELECT p_brand AS brand, CASE WHEN fields = 4 THEN 'complete' WHEN fields >= 2 THEN 'partial' ELSE 'poor' END AS tier, count(*) AS parts FROM c GROUP BY 1, 2")
def catalog_quality(spark, sf):
    has = lambda c: c.cast("int")
    fields = has(F.col("p_name").isNotNull()) + has(F.col("p_type") != "SMALL") + has(F.col("p_size") > 20) + has(F.col("p_retailprice") > 1000)
    return table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand"), F.when(fields == 4, "complete").when(fields >= 2, "partial").otherwise("poor").alias("tier")).agg(F.count("*").alias("parts"))


SPECIFIED = "CASE p_size % 4 WHEN 0 THEN '^' || lower(p_name) WHEN 1 THEN replace(lower(p_name), ' ', '.*') WHEN 2 THEN '(' || replace(lower(p_name), ' ', '|') || ')' ELSE lower(p_brand || ' ' || p_name) END"


@query("pattern_specificity", f"WITH p AS (SELECT {SPECIFIED} AS pattern, count(*) AS entries FROM part GROUP BY 1) SELECT pattern, entries, (length(pattern) + CASE WHEN contains(pattern, '^') THEN 10 ELSE 0 END - CASE WHEN contains(pattern, '.*') THEN 5 ELSE 0 END + CASE WHEN contains(pattern, '(') THEN 3 ELSE 0 END)::INTEGER AS specificity FROM p")
def pattern_specificity(spark, sf):
    """How special the patterns of a table of entries are."""
    rows = table(spark, sf, "part").groupBy(F.expr(SPECIFIED).alias("pattern")).agg(F.count("*").alias("entries"))
    add = lambda mark, n: F.when(F.contains("pattern", F.lit(mark)), n).otherwise(0)
    return rows.select("pattern", "entries", (F.length("pattern") + add("^", 10) + add(".*", -5) + add("(", 3)).alias("specificity"))


@query("validation_counts", f"WITH t AS (SELECT DISTINCT {BRUSH_TEXT} AS t FROM posts), d AS (SELECT DISTINCT t FROM (SELECT {BRUSH_TEXT} AS t, use_count FROM posts) WHERE use_count > 40) SELECT count(*) AS texts, count(d.t) AS processed, count(*) - count(d.t) AS open, round_even(100.0 * count(d.t) / count(*), 2) AS rate FROM t LEFT JOIN d USING (t)", posts=True)
def validation_counts(spark, sf):
    rows = posts(spark, sf).select(F.expr(BRUSH_TEXT).alias("t"), "use_count")
    done = rows.groupBy("t").agg(F.max(F.col("use_count") > 40).alias("d"))
    return done.agg(F.count("*").alias("texts"), F.count_if("d").alias("processed"), F.count_if(~F.col("d")).alias("open"), F.bround(100.0 * F.count_if("d") / F.count("*"), 2).alias("rate"))


@query("split_stats", "SELECT source, count(*) AS total, count(*) FILTER (quality = 1) AS validated, count(*) FILTER (toxic = 1) AS corrected, round_even(100.0 * count(*) FILTER (quality = 1) / count(*), 2) AS validated_pct FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def split_stats(spark, sf):
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return rows.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("quality") == 1).alias("validated"), F.count_if(F.col("toxic") == 1).alias("corrected"), F.bround(100.0 * F.count_if(F.col("quality") == 1) / F.count("*"), 2).alias("validated_pct"))


@query("system_agreement", "SELECT handle_brand IS NOT DISTINCT FROM soap_brand AS agree, count(*) AS posts, count(DISTINCT razor_brand) AS brands, round_even(100.0 * count(*) / sum(count(*)) OVER (), 2) AS share FROM posts GROUP BY 1", posts=True)
def system_agreement(spark, sf):
    from pyspark.sql import Window

    rows = posts(spark, sf).groupBy(F.col("handle_brand").eqNullSafe(F.col("soap_brand")).alias("agree")).agg(F.count("*").alias("posts"), F.count_distinct("razor_brand").alias("brands"))
    return rows.withColumn("share", F.bround(100.0 * F.col("posts") / F.sum("posts").over(Window.partitionBy()), 2))


@query("learning_report", f"""WITH b AS (SELECT {BRUSH} AS t, count(*) AS posts FROM posts GROUP BY 1), t AS (SELECT t FROM b), {SCORED_SQL},
    s AS (SELECT t, strategy, ord, (score + CASE strategy WHEN 'automated_split' THEN 55 WHEN 'full_input' THEN 120 * two ELSE 0 END)::DOUBLE AS score FROM z),
    r AS (SELECT s.*, posts, row_number() OVER (PARTITION BY t ORDER BY score DESC, ord) = 1 AS won FROM s JOIN b USING (t))
    SELECT strategy, count(*) AS candidates, sum(posts)::BIGINT AS seen, coalesce(sum(posts) FILTER (won), 0)::BIGINT AS wins, min(score) AS least, max(score) AS most, round_even(sum(score * posts) / sum(posts), 4) AS mean FROM r GROUP BY 1""", posts=True)
def learning_report(spark, sf):
    """How often each strategy has a candidate and the best one, and the scores of its candidates.

    explode_outer with a condition behind it, as a plain explode is preceded by a filter that computes all candidates again.
    """
    texts = brushes.spread(posts(spark, sf).groupBy(F.expr(BRUSH).alias("t")).agg(F.count("*").alias("posts")))
    scored = texts.select("posts", brushes.scored(brushes.candidates(F.col("t"), KNOWN, HANDLES, KNOTS), brushes.weight_rows(brushes.WEIGHTS)).alias("all"))
    rows = scored.select("posts", F.array_max("all").alias("best"), F.explode_outer("all").alias("c")).where("c.strategy IS NOT NULL")
    won = F.when((F.col("c.score") == F.col("best.score")) & (F.col("c.first") == F.col("best.first")), F.col("posts")).otherwise(0)
    score = F.col("c.score")
    counts = rows.groupBy(brushes.strategy_name(F.col("c.strategy")).alias("strategy")).agg(F.count("*").alias("candidates"), F.sum("posts").alias("seen"), F.sum(won).alias("wins"), F.min(score).alias("least"), F.max(score).alias("most"), (F.sum(score * F.col("posts")) / F.sum("posts")).alias("mean"))
    return counts.withColumn("mean", F.bround("mean", 4))


#: Filed entries: what resolved once, with values changed, fields taken away, texts that are gone, and capitals, by size.
FILED_SQL = f"""{CATALOG_SQL}, t AS (SELECT DISTINCT {PRODUCT} AS t, p_size FROM part), b AS {catalog_best_sql('t')},
    now AS (SELECT t, m.brand AS brand, m.model AS model FROM b),
    filed AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'whole' ELSE 'parts' END AS section, CASE WHEN p_size % 13 = 0 THEN 'gone ' || t WHEN p_size % 3 = 0 THEN upper(t) ELSE t END AS text, CASE WHEN p_size % 9 = 0 THEN 'Other' ELSE brand END AS brand, CASE WHEN p_size % 11 = 0 THEN NULL ELSE model END AS model FROM t LEFT JOIN now USING (t) WHERE p_size > 35)"""


@query("catalog_validate", f"""WITH {FILED_SQL}, k AS (SELECT lower(text) AS key, section, count(*) AS times FROM filed GROUP BY 1, 2), s AS (SELECT key, list_sort(list(section)) AS sections FROM k GROUP BY 1),
    g AS (SELECT DISTINCT lower(text) AS t FROM filed), gb AS {catalog_best_sql('g')},
    r AS (SELECT f.*, times, sections, gb.m.brand AS nb, gb.m.model AS nm, gb.t IS NULL AS gone FROM filed f JOIN k ON k.key = lower(f.text) AND k.section = f.section JOIN s ON s.key = lower(f.text) LEFT JOIN gb ON gb.t = lower(f.text)),
    d AS (SELECT *, concat_ws(',', CASE WHEN (brand IS NULL) <> (nb IS NULL) THEN 'brand' END, CASE WHEN (model IS NULL) <> (nm IS NULL) THEN 'model' END) AS changed, concat_ws(',', CASE WHEN lower(brand) <> lower(nb) THEN 'brand' END, CASE WHEN lower(model) <> lower(nm) THEN 'model' END) AS differ FROM r)
    SELECT section, text, 'no_match' AS issue, '' AS detail FROM d WHERE gone UNION ALL SELECT section, text, 'structural_change', changed FROM d WHERE NOT gone AND changed <> '' UNION ALL SELECT section, text, 'data_mismatch', differ FROM d WHERE NOT gone AND differ <> ''
    UNION ALL SELECT section, text, 'duplicate_string', times::VARCHAR FROM d WHERE times > 1 UNION ALL SELECT section, text, 'cross_section_conflict', array_to_string(sections, ',') FROM d WHERE len(sections) > 1""")
def catalog_validate(spark, sf):
    """Filed entries against what their texts resolve to now, by a catalog of thousands of patterns."""
    size, t = F.col("p_size"), F.col("t")
    index = catalog.catalog_frame(spark, made_catalog())
    texts = table(spark, sf, "part").select(F.expr(PRODUCT).alias("t"), "p_size").distinct().where(size > 35)
    once = texts.join(catalog.matched(texts, index, "t", NAMES), "t", "left")
    filed = once.select(
        F.when(size % 2 == 0, "whole").otherwise("parts").alias("section"), F.when(size % 13 == 0, F.concat(F.lit("gone "), t)).when(size % 3 == 0, F.upper(t)).otherwise(t).alias("text"),
        F.when(size % 9 == 0, "Other").otherwise(F.col("match.brand")).alias("brand"), F.when(size % 11 != 0, F.col("match.model")).alias("model"),
    ).distinct()
    found = catalog.matched(filed.select(F.lower("text").alias("text")), index, "text", NAMES).select("text", "match.brand", "match.model")
    return validation.filed_issues(filed, found, ["brand", "model"])


@query("duplicate_strings", "SELECT lower(p_name) AS text, count(DISTINCT p_brand) AS sections, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS names FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def duplicate_strings(spark, sf):
    rows = table(spark, sf, "part").select(F.lower("p_name").alias("text"), "p_brand").distinct()
    return rows.groupBy("text").agg(F.count("*").alias("sections"), F.array_join(F.array_sort(F.collect_list("p_brand")), ",").alias("names")).where("sections > 1")


@query("soap_patterns", "WITH d AS (SELECT lower(soap_brand) || ' - ' || lower(soap_scent) AS soap, id FROM posts), r AS (SELECT *, row_number() OVER (PARTITION BY soap ORDER BY id) AS k FROM d) SELECT soap, count(*) AS posts, array_to_string(list(id ORDER BY k) FILTER (k <= 3), ',') AS examples FROM r GROUP BY 1", posts=True)
def soap_patterns(spark, sf):
    rows = posts(spark, sf).select(F.concat_ws(" - ", F.lower("soap_brand"), F.lower("soap_scent")).alias("soap"), "id")
    few = numbered(rows, [F.asc("id")], ["soap"], "_n").where("_n <= 3").groupBy("soap").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return rows.groupBy("soap").agg(F.count("*").alias("posts")).join(few, "soap")


ROUTE = "CASE use_count % 4 WHEN 0 THEN 'regex' WHEN 1 THEN 'brand' WHEN 2 THEN 'dash_split' ELSE 'exact' END"


@query("soap_group_matched", f"WITH g AS (SELECT lower(soap_brand) AS brand, {ROUTE} AS match_type, count(*) AS n FROM posts GROUP BY 1, 2) SELECT brand, sum(n)::BIGINT AS posts, arg_min(match_type, list_position(['regex', 'brand', 'dash_split', 'exact'], match_type)) AS primary_type, array_to_string(list(match_type || ':' || n ORDER BY n DESC, match_type)[1:3], ',') AS top FROM g GROUP BY 1", posts=True)
def soap_group_matched(spark, sf):
    """Per brand: posts, the first of the match types in a fixed precedence, and the three most frequent ones."""
    counts = posts(spark, sf).groupBy(F.lower("soap_brand").alias("brand"), F.expr(ROUTE).alias("match_type")).agg(F.count("*").alias("n"))
    order = F.array_position(F.array(*[F.lit(x) for x in ("regex", "brand", "dash_split", "exact")]), F.col("match_type"))
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("less"), "match_type", "n"))), 1, 3)
    return counts.groupBy("brand").agg(F.sum("n").alias("posts"), F.min_by("match_type", order).alias("primary_type"), F.array_join(F.transform(top, lambda x: F.concat_ws(":", x["match_type"], x["n"])), ",").alias("top"))


@query("soap_duplicates", "WITH d AS (SELECT DISTINCT p_brand AS brand, p_name AS name FROM part) SELECT a.brand, a.name, b.name AS other, round_even(1.0 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)), 4) AS similarity FROM d a JOIN d b ON a.brand = b.brand AND a.name < b.name WHERE round_even(1.0 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)), 4) >= 0.8")
def soap_duplicates(spark, sf):
    """Like names within a brand; the brand is the block."""
    names = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name")).distinct()
    pairs = similarity.blocked_pairs(names, "name", F.col("brand"))
    pairs = pairs.withColumn("similarity", F.bround(similarity.edit_ratio(F.col("a_name"), F.col("b_name")), 4)).where("similarity >= 0.8")
    return pairs.select(F.col("a_brand").alias("brand"), F.col("a_name").alias("name"), F.col("b_name").alias("other"), "similarity")


@query("soap_duplicates_full")
def soap_duplicates_full(spark, sf):
    """Like products of different makers with like names, by maker and name, and the rows of both; tests have a plain version."""
    parts = table(spark, sf, "part")
    rows = parts.groupBy(F.lower("p_brand").alias("maker"), F.lower("p_name").alias("name")).agg(F.count("*").alias("rows"))
    pairs = similarity.like_products(parts, "p_brand", "p_name", 0.8)
    counted = pairs.join(rows, ["maker", "name"]).join(rows.toDF("other_maker", "other_name", "other_rows"), ["other_maker", "other_name"])
    return counted.select("maker", "name", "other_maker", "other_name", F.round("similarity", 3).alias("similarity"), (F.col("rows") + F.col("other_rows")).alias("rows"))


_near = lambda side: f"CASE WHEN {side} IS NULL OR EXISTS (SELECT 1 FROM x WHERE (x.a = name AND x.b = {side}) OR (x.b = name AND x.a = {side})) THEN 0.0 ELSE 1.0 - levenshtein(name, {side})::DOUBLE / greatest(length(name), length({side})) END"
_pass = lambda rows, more="": f"SELECT *, greatest({_near('before')}, {_near('after')}) AS likeness FROM (SELECT name{more}, lag(name) OVER (ORDER BY name) AS before, lead(name) OVER (ORDER BY name) AS after FROM {rows})"
SOAP_NAME = "lower(p_brand || ' - ' || p_name)"


@query("soap_neighbors", f"""WITH x AS (SELECT DISTINCT lower(p.p_brand || ' - ' || p.p_name) AS a, lower(q.p_brand || ' - ' || q.p_name) AS b FROM part p JOIN part q ON p.p_brand = q.p_brand AND p.p_name < q.p_name WHERE p.p_size = 50 AND q.p_size > 48),
    d AS (SELECT DISTINCT {SOAP_NAME} AS name FROM part), one AS ({_pass('d')}), k AS (SELECT name, likeness AS first_pass FROM one WHERE likeness >= 0.75), two AS ({_pass('k', ', first_pass')})
    SELECT name, round_even(first_pass, 6) AS first_pass, before, after, round_even(likeness, 6) AS similarity FROM two""")
def soap_neighbors(spark, sf):
    """Products in one order with the likeness to their neighbours, known different pairs aside, and again among those that are like one."""
    parts = table(spark, sf, "part")
    name = F.expr(SOAP_NAME)
    of = lambda c, as_: parts.where(c).select("p_brand", F.col("p_name").alias(f"n{as_}"), name.alias(as_)).distinct()
    apart = of("p_size = 50", "a").join(of("p_size > 48", "b"), "p_brand").where("na < nb").select("a", "b")
    found = similarity.sorted_neighbours(parts.select(name.alias("name")), "name", apart, 0.75)
    return found.withColumns({c: F.bround(c, 6) for c in ("first_pass", "similarity")})


@query("soap_clusters")
def soap_clusters(spark, sf):
    """Products linked by brands and names that are each alike by more than 0.9, as clusters under their least key; tests have a plain version."""
    return similarity.clusters(similarity.like_keys(table(spark, sf, "part"), "p_brand", "p_name", 0.9), "a", "b")


@query("fuzzy_align")
def fuzzy_align(spark, sf):
    """Each part's best catalog names by 0.6 brand and 0.4 sorted words, of all catalog entries; tests have a plain version."""
    parts = table(spark, sf, "part").select("p_brand", "p_name").distinct()
    known = parts.where("length(p_name) % 3 = 0").select(F.col("p_brand").alias("c_brand"), F.col("p_name").alias("c_name"))
    return numbered(similarity.aligned(parts, known, 60.0), [F.desc("score"), F.asc("c_brand"), F.asc("c_name")], ["p_brand", "p_name"]).where("rank <= 3")


@query("non_match_filter", "SELECT DISTINCT p_brand, p_name FROM part WHERE (p_brand, p_name) NOT IN (SELECT p_brand, p_name FROM part WHERE p_size = 50)")
def non_match_filter(spark, sf):
    parts = table(spark, sf, "part")
    return parts.select("p_brand", "p_name").distinct().join(parts.where("p_size = 50").select("p_brand", "p_name"), ["p_brand", "p_name"], "left_anti")


@query("slug_lookup", "WITH s AS (SELECT DISTINCT lower(p_brand) AS b, lower(p_name) AS n, replace(lower(p_brand), '#', '-') || '-' || replace(lower(p_name), ' ', '-') AS slug FROM part WHERE p_size < 25) SELECT DISTINCT p.p_brand, p.p_name, slug FROM part p LEFT JOIN s ON lower(p.p_brand) = b AND lower(p.p_name) = n")
def slug_lookup(spark, sf):
    parts = table(spark, sf, "part")
    slug = F.concat_ws("-", F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-")), F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")))
    slugs = parts.where("p_size < 25").select(F.lower("p_brand").alias("b"), F.lower("p_name").alias("n"), slug.alias("slug")).distinct()
    return parts.select("p_brand", "p_name").distinct().join(slugs, (F.lower("p_brand") == F.col("b")) & (F.lower("p_name") == F.col("n")), "left").select("p_brand", "p_name", "slug")


# ---- set operations ---------------------------------------------------------------------------------------------


@query("union_months", "SELECT month, part, count(*) AS posts FROM (SELECT month, 'odd' AS part FROM posts WHERE year % 2 = 1 UNION ALL BY NAME SELECT 'even' AS part, month FROM posts WHERE year % 2 = 0) GROUP BY 1, 2", posts=True)
def union_months(spark, sf):
    """Months of two parts, by name of their columns."""
    view = posts(spark, sf)
    odd, even = view.where("year % 2 = 1").select("month", F.lit("odd").alias("part")), view.where("year % 2 = 0").select(F.lit("even").alias("part"), "month")
    return odd.unionByName(even).groupBy("month", "part").agg(F.count("*").alias("posts"))


@query("intersect_names", "SELECT month, razor_model AS name FROM posts INTERSECT SELECT strftime(strptime(month || '-01', '%Y-%m-%d') + INTERVAL 1 MONTH, '%Y-%m'), razor_model FROM posts", posts=True)
def intersect_names(spark, sf):
    """Names of each month that the month before has as well."""
    view = posts(spark, sf)
    of = lambda month: view.select(month.alias("month"), F.col("razor_model").alias("name")).distinct()
    return of(F.col("month")).intersect(of(periods.months_before(F.col("month"), -1)))


@query("dedupe_ids", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_ids(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query("symmetric_yaml_diff", "WITH a AS (SELECT p_brand, p_name FROM part WHERE p_size < 30), b AS (SELECT p_brand, p_name FROM part WHERE p_size > 20) SELECT 'a' AS only_in, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'b', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def symmetric_yaml_diff(spark, sf):
    parts = table(spark, sf, "part")
    a, b = parts.where("p_size < 30").select("p_brand", "p_name"), parts.where("p_size > 20").select("p_brand", "p_name")
    return a.exceptAll(b).select(F.lit("a").alias("only_in"), "*").unionByName(b.exceptAll(a).select(F.lit("b").alias("only_in"), "*"))


# ---- sources ----------------------------------------------------------------------------------------------------


@query("merge_upsert", "WITH e AS (SELECT event_id, user_id, ts, value FROM events WHERE event_id % 3 <> 0), n AS (SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 1 HOUR ELSE ts END AS ts, value + 1 AS value FROM events WHERE event_id % 3 <> 1), u AS (SELECT *, 0 AS new FROM e UNION ALL SELECT *, 1 FROM n), r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, new) AS k FROM u) SELECT event_id, user_id, round(value, 6) AS value, new = 1 AS changed FROM r WHERE k = 1")
def merge_upsert(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    old = events.where("event_id % 3 <> 0").withColumn("changed", F.lit(False))
    later = F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("interval 1 hour")).otherwise(F.col("ts"))
    new = events.where("event_id % 3 <> 1").withColumns({"ts": later, "value": F.col("value") + 1, "changed": F.lit(True)})
    return store.upsert(old, new, "event_id", "ts").select("event_id", "user_id", F.round("value", 6).alias("value"), "changed")


@query("skip_unchanged", "SELECT c_custkey, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 HAVING (c_custkey, count(*)) NOT IN (SELECT o_custkey, count(*) FROM orders WHERE o_orderdate < '2001-01-01' GROUP BY 1)")
def skip_unchanged(spark, sf):
    orders = table(spark, sf, "orders")
    count = lambda d: d.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    return store.unseen(count(orders), count(orders.where("o_orderdate < '2001-01-01'")), ["c_custkey", "orders"])


@query("thread_overrides", "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 0 UNION SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def thread_overrides(spark, sf):
    orders = table(spark, sf, "orders")
    pick = lambda c: orders.where(c).select("o_orderkey")
    return store.with_thread_overrides(pick("o_orderstatus = 'F'"), pick("o_orderkey % 7 = 0"), pick("o_orderpriority = '1-URGENT'"), "o_orderkey")


@query("scan_year", """WITH m AS (SELECT '2000-' || lpad(i::VARCHAR, 2, '0') AS month, i FROM range(1, 13) r(i)), p AS (SELECT month, count(*) AS posts, count(DISTINCT author) AS people FROM posts WHERE year = 2000 GROUP BY 1)
    SELECT month, CASE WHEN posts IS NULL OR i % 5 = 0 THEN 'missing' WHEN i % 4 = 1 THEN 'corrupt' ELSE 'included' END AS status, CASE WHEN posts IS NULL OR i % 5 = 0 THEN 0 ELSE posts END AS rows, CASE WHEN posts IS NOT NULL AND i % 5 <> 0 AND i % 4 <> 1 THEN people END AS people FROM m LEFT JOIN p USING (month)""", posts=True)
def scan_year(spark, sf):
    """A year of month files, of which some are missing and some are broken: what became of each month, and the people of the whole ones."""
    place = store.scratch(spark, "year")
    number = F.split_part("month", F.lit("-"), F.lit(2)).cast("int")
    rows = posts(spark, sf).where("year = 2000").where(number % 5 != 0).select("month", "id", "author", "use_count")
    store.write_month_json(rows, place)
    broken = rows.where(number % 4 == 1).select("month", F.substring(F.to_json(F.struct("id", "author")), 1, 9).alias("value"))
    broken.write.mode("append").partitionBy("month").text(place)
    whole, report = store.read_year(spark, place, 2000, "id string, author string, use_count int")
    people = whole.groupBy("month").agg(F.count_distinct("author").alias("people"))
    return report.join(people, "month", "left").select("month", "status", "rows", "people")


# ---- script-level reports ---------------------------------------------------------------------------------------


@query("soap_formats", "WITH t AS (SELECT lower(split_part(p_name, ' ', 2)) AS token, p_partkey FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY p_partkey) AS k FROM t) SELECT token, count(*) AS parts, array_to_string(list(p_partkey ORDER BY k) FILTER (k <= 3), ',') AS examples FROM r GROUP BY 1")
def soap_formats(spark, sf):
    rows = table(spark, sf, "part").select(F.lower(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("token"), "p_partkey")
    few = numbered(rows, [F.asc("p_partkey")], ["token"], "_n").where("_n <= 3").groupBy("token").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p_partkey")), lambda x: x.cast("string")), ",").alias("examples"))
    return rows.groupBy("token").agg(F.count("*").alias("parts")).join(few, "token")


@query("unhandled_patterns", r"WITH w AS (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]*[0-9#$%@+][^\x20\x09-\x0D]*')) AS w FROM documents) SELECT CASE WHEN contains(w, '@') THEN 'address' WHEN regexp_matches(w, '^[0-9]+[.,]?$') THEN 'number' WHEN regexp_matches(w, '^[0-9.]+$') THEN 'dotted' WHEN contains(w, '#') THEN 'hash' WHEN contains(w, '$') THEN 'dollar' ELSE 'other' END AS kind, count(*) AS words, count(DISTINCT w) AS texts FROM w GROUP BY 1")
def unhandled_patterns(spark, sf):
    w = F.col("w")
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]*[0-9#$%@+][^\x20\x09-\x0D]*)"), F.lit(1))).alias("w"))
    kind = F.when(w.contains("@"), "address").when(w.rlike("^[0-9]+[.,]?$"), "number").when(w.rlike("^[0-9.]+$"), "dotted").when(w.contains("#"), "hash").when(w.contains("$"), "dollar").otherwise("other")
    return words.groupBy(kind.alias("kind")).agg(F.count("*").alias("words"), F.count_distinct("w").alias("texts"))


@query("count_approach_diff", "SELECT (l_quantity::INTEGER % 10) IS NOT DISTINCT FROM (l_linenumber % 10) AS same, count(*) AS line_count FROM lineitem GROUP BY 1")
def count_approach_diff(spark, sf):
    """Two ways to count compared row by row."""
    a, b = F.col("l_quantity").cast("int") % 10, F.col("l_linenumber") % 10
    return table(spark, sf, "lineitem").groupBy(a.eqNullSafe(b).alias("same")).agg(F.count("*").alias("line_count"))


@query("reconcile_missed_days", """WITH a AS (SELECT year, author, 365 - count(DISTINCT posted_date) AS missed FROM posts GROUP BY 1, 2), b AS (SELECT year, author, 365 - len(list_distinct(list(posted_date))) AS missed FROM posts WHERE use_count > 1 GROUP BY 1, 2)
    SELECT coalesce(a.year, b.year) AS year, coalesce(a.author, b.author) AS author, a.missed AS stored, b.missed AS recomputed FROM a FULL JOIN b ON a.year = b.year AND a.author = b.author WHERE a.missed IS DISTINCT FROM b.missed""", posts=True)
def reconcile_missed_days(spark, sf):
    """Stored against recomputed yearly missed days, by full outer join; only differences."""
    count = lambda d, n: d.groupBy("year", "author").agg((F.lit(365) - F.count_distinct("posted_date")).alias(n))
    view = posts(spark, sf)
    both = count(view, "stored").join(count(view.where("use_count > 1"), "recomputed"), ["year", "author"], "full")
    return both.where(~F.col("stored").eqNullSafe(F.col("recomputed")))


@query("reconcile_sample_brands", "SELECT month, count(DISTINCT lower(soap_brand)) AS brands, count(DISTINCT soap_brand) AS spellings, count(DISTINCT lower(soap_brand)) <> count(DISTINCT soap_brand) AS differs FROM posts WHERE sample_type IS NOT NULL GROUP BY 1", posts=True)
def reconcile_sample_brands(spark, sf):
    a, b = F.count_distinct(F.lower("soap_brand")), F.count_distinct("soap_brand")
    return posts(spark, sf).where("sample_type IS NOT NULL").groupBy("month").agg(a.alias("brands"), b.alias("spellings"), (a != b).alias("differs"))


@query("intent_compare", f"WITH t AS (SELECT id, {_fiber_sql('t')} AS a, fiber AS b FROM (SELECT *, {BRUSH_TEXT} AS t FROM posts)) SELECT a AS first_phase, b AS second_phase, count(*) AS posts, bool_and(a IS NOT DISTINCT FROM b) AS agree FROM t GROUP BY 1, 2", posts=True)
def intent_compare(spark, sf):
    rows = posts(spark, sf).select(resolution.fiber(F.expr(BRUSH_TEXT)).alias("first_phase"), F.col("fiber").alias("second_phase"))
    return rows.groupBy("first_phase", "second_phase").agg(F.count("*").alias("posts"), F.bool_and(F.col("first_phase").eqNullSafe(F.col("second_phase"))).alias("agree"))


@query("thread_candidates", "WITH s AS (SELECT ts::DATE AS day, event_id, CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 ELSE 0 END + CASE WHEN value > 20 THEN 1 ELSE 0 END AS score FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, event_id) AS k FROM s) SELECT strftime(day, '%Y-%m-%d') AS day, event_id, score::INTEGER AS score FROM r WHERE k = 1 AND day::DATE NOT IN (SELECT ts::DATE FROM events WHERE event_id % 400 = 0)")
def thread_candidates(spark, sf):
    """The best-scored candidate of each day that has none yet."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    score = F.when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 2).otherwise(0) + F.when(F.col("value") > 20, 1).otherwise(0)
    best = numbered(events.select("day", "event_id", score.alias("score")), [F.desc("score"), F.asc("event_id")], ["day"], "_n").where("_n = 1").drop("_n")
    have = events.where("event_id % 400 = 0").select("day").distinct()
    return best.join(have, "day", "left_anti").select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_id", "score")
