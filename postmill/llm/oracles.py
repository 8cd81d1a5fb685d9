"""DuckDB SQL with the results of those queries of this subpackage that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from postmill.llm import licenses, urls


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op1() -> str:
    pairs = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in licenses.SENTENCES.items())
    shortest = min(map(len, licenses.SENTENCES))
    # DuckDB's patterns neither look ahead nor hold what they have read: owners are read to the line's end, and phrases that open a paragraph get a mark before it
    owner = licenses.OWNER.replace("*+", "*").replace("(?=[0-9<\\[{])", "[0-9<\\[{]")
    paragraphs, opening = licenses.PARAGRAPHS.replace("*+", "*").rsplit("|\\n(?=", 1)
    opened = f"regexp_replace(regexp_replace(coalesce(text, ''), {quoted(owner)}, E'\\n\\n\\\\1\\n\\n', 'g'), {quoted('(?i)' + chr(92) + 'n(' + opening)}, E'\\x01\\\\1', 'g')"

    def ids(text: str, cut: str) -> str:
        return f"""SELECT doc_id, list(id ORDER BY pos) AS ids FROM (
            SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS part
            FROM (SELECT doc_id, regexp_split_to_array({text}, {quoted(cut)}) AS parts FROM documents)) s
            JOIN (VALUES {pairs}) k(sentence, id)
            ON length(part) >= {shortest} AND trim(regexp_replace(translate(part, '{urls.UPPER}', '{urls.LOWER}'), '[^a-z0-9]+', ' ', 'g')) = sentence
            GROUP BY doc_id"""

    def fold(name: str, source: str, rules: Sequence[tuple[str, tuple[str, ...]]] = licenses.RULES) -> str:
        steps = [f"{name}0 AS (SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '') AS rest, []::VARCHAR[] AS found FROM {source})"]
        for n, (licence, need) in enumerate(rules, 1):
            pattern = quoted("".join(f"<{n}>" for n in need))
            steps.append(
                f"{name}{n} AS (SELECT doc_id, ids, replace(rest, {pattern}, '<>') AS rest, "
                f"CASE WHEN contains(rest, {pattern}) THEN list_append(found, {quoted(licence)}) ELSE found END AS found FROM {name}{n - 1})"
            )
        return ", ".join([*steps, f"{name} AS (SELECT doc_id, ids, found FROM {name}{len(rules)})"])

    whole = "coalesce(text, '')"
    return f"""WITH a AS ({ids(whole, licenses.WRAPPED)}), b AS ({ids(whole, licenses.LINED)}), c AS ({ids(opened, paragraphs + '|' + chr(92) + 'x01')}),
        {fold('fa', 'a')}, {fold('fb', 'b')}, {fold('fc', 'c', (*licenses.FILE_RULES, *licenses.RULES))},
        m AS (SELECT d.doc_id, coalesce(x.ids, []) AS xi, coalesce(y.ids, []) AS yi, coalesce(z.ids, []) AS zi, coalesce(z.found, []) AS zf,
            list_concat(coalesce(x.found, []), coalesce(y.found, []), coalesce(z.found, [])) AS found
          FROM documents d LEFT JOIN fa x USING (doc_id) LEFT JOIN fb y USING (doc_id) LEFT JOIN fc z USING (doc_id)),
        n AS (SELECT doc_id, CASE WHEN len(zi) > greatest(len(xi), len(yi)) THEN zi WHEN len(yi) >= len(xi) THEN yi ELSE xi END AS ids,
            CASE WHEN list_contains(zi, 'RESERVED') AND NOT list_contains(zf, 'Proprietary') THEN list_filter(found, lambda x: x <> 'Proprietary') ELSE found END AS found FROM m)
        SELECT doc_id, len(ids)::BIGINT AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
          coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licences FROM n"""


def _op4() -> str:
    rule, verdict, pattern = "NULL", "NULL", "NULL"
    for r in sorted(urls.HOST_RULES, key=lambda r: (len(r.text), r.text)):
        fits = f"(host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) AND starts_with(path, {quoted(r.path)})"
        rule, verdict = f"CASE WHEN {fits} THEN {quoted(r.text)} ELSE {rule} END", f"CASE WHEN {fits} THEN {quoted(r.verdict)} ELSE {verdict} END"
    for p in reversed(urls.PATTERN_RULES):
        pattern = f"CASE WHEN regexp_matches(low, {quoted(p.pattern)}) THEN {quoted(p.name)} ELSE {pattern} END"
    lower = f"'{urls.UPPER}', '{urls.LOWER}'"
    return f"""WITH u AS (SELECT page_id, translate(url, {lower}) AS low,
            coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {lower}), '') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        m AS (SELECT page_id, host, path, ({rule})::VARCHAR AS rule, ({verdict})::VARCHAR AS decided, ({pattern})::VARCHAR AS pattern FROM u)
        SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, pattern FROM m"""


def _op9() -> str:
    return """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
            FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def _op11() -> str:
    blank = r"[\x20\x09-\x0D]"
    return rf"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{blank}+'), lambda x: x <> '') AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM d),
        v AS (SELECT doc_id, word, pos, CASE WHEN pos + 19 <= len(w) THEN array_to_string(w[pos:pos + 19], ' ') END AS twenty FROM p),
        f AS (SELECT doc_id, word, pos, twenty IS NOT NULL AND row_number() OVER (PARTITION BY twenty ORDER BY doc_id, pos) > 1 AS again FROM v),
        g AS (SELECT doc_id, word, pos, max(again::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 1 AS gone FROM f),
        k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)"""


def _op13() -> str:
    def terms(source: str, key: str) -> str:
        return rf"SELECT {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM {source}"

    return f"""WITH t AS (SELECT doc_id, term, count(*) AS tf FROM ({terms('documents', 'doc_id')}) GROUP BY doc_id, term),
        n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
        a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
        i AS (SELECT DISTINCT item_id, term FROM ({terms('benchmark', 'item_id')})),
        f AS (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM i) GROUP BY term),
        w AS (SELECT item_id, term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM i JOIN f USING (term), a),
        s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
            FROM w JOIN t USING (term) JOIN n USING (doc_id), a GROUP BY item_id, doc_id),
        r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


ORACLES = {"op9_exact_top_k": _op9(), "op1_license_scan": _op1(), "op4_url_filter": _op4(), "op11_substring_dedup": _op11(), "op13_ranked_search": _op13()}
