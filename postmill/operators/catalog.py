"""Catalogs of patterns: read from YAML, and resolved through an index of literal three-letter grams.

A pattern is filed under the rarest gram of what any text it fits must hold. Texts fetch candidates by an equi-join on
their own grams, and only candidates run as regular expressions; so a catalog of thousands of entries is neither one deep
expression nor a product of all texts with all patterns.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.resolution import Pattern

SCHEMA = "ord int, section int, pattern string, grams array<string>, attributes map<string, string>"


def literal_runs(pattern: str) -> list[str]:
    """Runs of characters that every text which fits the pattern holds, in lower case. Groups count as anything; alternatives at the top give none."""
    runs, run, depth, at = [], "", 0, 0

    def broken() -> str:
        runs.append(run)
        return ""

    while at < len(pattern):
        c, width = pattern[at], 1
        if c == "\\":
            width, letter = 2, pattern[at + 1 : at + 2]
            run = run + letter.lower() if not depth and not letter.isalnum() else broken()
        elif c == "[":
            end = pattern.find("]", at + 2 + (pattern[at + 1 : at + 2] == "^"))
            while end > 0 and pattern[end - 1] == "\\" and pattern[end - 2] != "\\":
                end = pattern.find("]", end + 1)
            width, run = (end if end > 0 else len(pattern)) + 1 - at, broken()
        elif c in "()":
            depth, run = depth + (1 if c == "(" else -1), broken()
        elif depth:
            pass
        elif c == "|":
            return []
        elif c in "?*{":
            run = run[:-1]  # what stands before may be absent
            run, width = broken(), (pattern.find("}", at) + 1 - at if c == "{" and "}" in pattern[at:] else 1)
        elif c in "+.^$":
            run = broken()
        else:
            run += c.lower()
        at += width
    return [r for r in (*runs, run) if r]


def _grams(pattern: str) -> list[str]:
    return sorted({r[i : i + 3] for r in literal_runs(pattern) for i in range(len(r) - 2)})


def catalog_frame(spark: SparkSession, patterns: Sequence[Pattern]) -> DataFrame:
    """One row per pattern, in catalog order."""
    rows = [(n, p.section, p.pattern, _grams(p.pattern), {k: str(v) for k, v in p.attributes.items()}) for n, p in enumerate(patterns)]
    return spark.createDataFrame(rows, SCHEMA)


#: Bytes of YAML that a driver parses.
LARGEST = 64 << 20


def read_catalog(spark: SparkSession, path: str, levels: Sequence[str] = ("brand", "model")) -> list[Pattern]:
    """Patterns of YAML files: nested names, one level each, down to mappings with a list `patterns`; other plain values are attributes.

    Texts are brought to composed Unicode form. A name that comes twice in one mapping is an error. Files are read through
    Spark, so they can lie wherever tables do; a catalog is parsed on the driver, and one above LARGEST is an error.
    """
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def unique(loader: yaml.SafeLoader, node: yaml.MappingNode) -> dict:
        names = [loader.construct_object(k, deep=True) for k, _ in node.value]
        if twice := {n for n in names if names.count(n) > 1}:
            raise ValueError(f"names that come twice: {sorted(map(str, twice))}")
        return {n: loader.construct_object(v, deep=True) for n, (_, v) in zip(names, node.value)}

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, unique)

    def entries(node: Mapping, names: tuple[str, ...], given: Mapping[str, str]) -> Iterator[Pattern]:
        own = {str(k): str(v) for k, v in node.items() if not isinstance(v, (Mapping, list))}
        known = {**given, **own}
        section = int(known.pop("section", 0))
        for pattern in node.get("patterns") or ():
            yield Pattern(str(pattern), {**dict(zip(levels, names)), **known}, section)
        for name, below in node.items():
            if isinstance(below, Mapping):
                yield from entries(below, (*names, str(name)), {**known, **({"section": str(section)} if section else {})})

    texts = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("f"), "value")
    if (texts.agg(F.sum(F.octet_length("value"))).first()[0] or 0) > LARGEST:
        raise ValueError(f"more than {LARGEST} bytes of catalog")
    files = texts.orderBy("f").collect()
    return [p for r in files for p in entries(yaml.load(unicodedata.normalize("NFC", r["value"]), Loader) or {}, (), {})]


def name_catalog(names: DataFrame, name: str, attributes: Sequence[str], section: Column | None = None) -> DataFrame:
    """A catalog out of rows: each name, as a whole and in any case, is a pattern; attributes and section come from its row.

    Rows may be as many as there are names. Equal lengths of one section go by attributes, then by pattern.
    """
    low = F.lower(name)
    quoted = F.regexp_replace(low, r"([^a-z0-9 ])", r"\\$1")
    pattern = F.concat(F.lit("(^|[^a-z0-9])"), quoted, F.lit("([^a-z0-9]|$)"))
    values = F.create_map(*[x for a in attributes for x in (F.lit(a), F.col(a).cast("string"))])
    filled = names.where(F.length(name) > 0)
    return filled.select(F.lit(0).alias("ord"), (F.lit(0) if section is None else section).cast("int").alias("section"), pattern.alias("pattern"), F.filter(text_grams(low), lambda g: g != "").alias("grams"), values.alias("attributes"))


def text_grams(text: Column) -> Column:
    """Distinct three-letter grams of a text in lower case, and the empty one, under which patterns without grams are filed."""
    low = F.lower(text)
    every = F.when(F.length(text) > 2, F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(low, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.array_append(every, F.lit("")))


#: Patterns of a catalog that is sent to all texts; the grams of texts go to a larger one.
SMALL = 20_000


def candidates(texts: DataFrame, catalog: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """All patterns that fit a distinct text: (text, section, less, ord, pattern, names), the best ones least in section, less and ord.

    Case does not matter.
    """
    distinct = texts.select(F.col(text).alias("_t")).where("_t IS NOT NULL").distinct()
    spread = distinct.select("_t", F.explode(text_grams(F.col("_t"))).alias("_gram"))
    counts = spread.groupBy("_gram").agg(F.count("*").alias("_n"))
    filed = catalog.select("pattern", F.explode(F.when(F.size("grams") > 0, F.col("grams")).otherwise(F.array(F.lit("")))).alias("_gram")).distinct()
    filed = filed.join(counts, "_gram", "left").groupBy("pattern").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram"))["_gram"].alias("_gram"))
    indexed = catalog.join(filed, "pattern").select("_gram", "section", (-F.length("pattern")).alias("less"), "ord", "pattern", *[F.col("attributes")[n].alias(n) for n in names])
    if catalog.limit(SMALL + 1).count() <= SMALL:
        indexed = F.broadcast(indexed)
    # by pattern, so that each is compiled once in a row of texts
    met = spread.join(indexed, "_gram").sortWithinPartitions("pattern")
    fits = met.where(F.regexp_instr("_t", F.concat(F.lit("(?i)"), "pattern")) > 0)
    return fits.select(F.col("_t").alias(text), "section", "less", "ord", "pattern", *names)


def matched(texts: DataFrame, catalog: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """(text, match) of the distinct texts that any pattern fits: match has the names and the pattern of the first one.

    The lower section comes first, then the longer pattern, then catalog order; case does not matter.
    """
    best = candidates(texts, catalog, text, names).groupBy(text).agg(F.min(F.struct("section", "less", "ord", *names, "pattern")).alias("_b"))
    return best.select(text, F.struct(*[F.col(f"_b.{n}").alias(n) for n in (*names, "pattern")]).alias("match"))


def resolved_fields(found: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    """Of several candidates of a text: how many there are, and for each field its value, whether they differ in it, and the other values.

    The value is that of the longest pattern, then of the lower section, then of the first in the catalog; the other ones
    are kept in order. Candidates without the field have no say. A group holds no more than the patterns of a catalog.
    """
    rows = found.groupBy(text).agg(F.array_sort(F.collect_list(F.struct("less", "section", "ord", *fields))).alias("_c"))
    values = {f: F.array_distinct(F.array_compact(F.col(f"_c.{f}"))) for f in fields}
    rows = rows.select(text, F.size("_c").alias("candidates"), *[v.alias(f) for f, v in values.items()])
    return rows.select(
        text, "candidates", *[F.get(f, F.lit(0)).alias(f) for f in fields], *[(F.size(f) > 1).alias(f"{f}_conflict") for f in fields],
        *[F.array_sort(F.slice(f, 2, F.greatest(F.size(f) - 1, F.lit(0)))).alias(f"{f}_others") for f in fields],
    )
