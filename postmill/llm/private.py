"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms around what they find.

Each address, number or the like that a pattern finds is a protected entity. Corpus counts say how much a term near it
gives it away: with j documents in which both meet, d(c) and d(t) documents with the entity and with the term, and N in
all, the disclosure is PMI = log(N j / (d(c) d(t))), against the entity's information content IC = log(N / d(c)). A term
at IC or above discloses the entity wholly and is removed; from IC / ALPHA on it is generalised to the shape of a word.
A term that meets an entity in one document only is no evidence and stays.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from postmill.llm.common import cut

# The order of kinds and the patterns of the query's contract; card and phone are checked afterwards.
KINDS = ("email", "ip", "card", "phone", "term")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
REPLACEMENTS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
#: Words on either side of an entity that can disclose it, and the documents in which both must meet.
NEAR, MIN_MEETINGS = 8, 2
#: Disclosure from IC / ALPHA on is generalised.
ALPHA = 1.25
WORD = re.compile(r"[^\W_]{3,}")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @; the time is linear in the text."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed kinds, by kind and then start."""
    found = [("email", *m) for m in emails(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def entity_key(kind: str, value: str) -> int:
    """Entities are alike if they differ in case, blanks and punctuation only."""
    return _hash(kind + ":" + re.sub(r"[^0-9a-z@]+", "", value.lower()))


def near_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(entity, term, start, end) for the NEAR words on either side of each span, however far they are, but not those in a span."""
    words = [m.span() for m in WORD.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    covered = sorted((s, e) for _, s, e in spans)
    opens, reach = [s for s, _ in covered], list(accumulate((e for _, e in covered), max))

    def inside(s: int, e: int) -> bool:
        """Whether a word overlaps a span: of those that start before its end, the farthest reaches beyond its start."""
        k = bisect_left(opens, e)
        return k > 0 and reach[k - 1] > s

    for kind, start, end in spans:
        entity, before, after = entity_key(kind, text[start:end]), bisect_right(ends, start), bisect_left(starts, end)
        for s, e in words[max(0, before - NEAR) : before] + words[after : after + NEAR]:
            if not inside(s, e):
                yield entity, _hash(text[s:e].lower()), s, e


#: Terms counted per task before the counts go on, which bounds a task's memory.
HELD_TERMS = 300_000
#: Parts into which the rows of one entity and term are dealt, as one address may be in a third of all texts.
SALTS = 16


def _seen(key: str) -> StructType:
    return StructType.fromDDL(f"key {key}, part long, pos int, n int, spans string, entity long, term long, s int, e int")


def _first_pass(schema: StructType):
    """Per text (key, part, text) a row with its fixed spans; per entity and near term a row; per term a row with its document count."""
    target = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(target), target)], names=target.names)

    def counted(counts: Counter) -> pa.RecordBatch:
        return batch_of([(None, None, 2, n, None, None, _hash(w), None, None) for w, n in counts.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            rows = []
            for key, part, value in zip(batch["key"].to_pylist(), batch["part"].to_pylist(), batch["text"]):
                content = value.as_py() or ""
                spans = base_spans(content)
                if spans:
                    rows.append((key, part, 0, None, ",".join(f"{k}:{s}:{e}" for k, s, e in spans), None, None, None, None))
                    met: set[tuple[int, ...]] = set()
                    for entity, term, s, e in near_terms(content, spans):
                        # of a row, the first span of an entity counts it, and the first of a pair the pair
                        first = 2 * ((entity,) not in met) + ((entity, term) not in met)
                        met |= {(entity,), (entity, term)}
                        rows.append((key, part, 1, first, None, entity, term, s, e))
                counts.update({w.lower() for w in set(WORD.findall(content))})
                if len(counts) > HELD_TERMS:
                    yield batch_of(rows)
                    yield counted(counts)
                    counts.clear()
                    rows = []
            yield batch_of(rows)
        yield counted(counts)

    return run


def keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """What stands for a row: its key and a hash of its text."""
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("part"), F.col(text).alias("text"))


def find_private(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per distinct row with any personal data: _key, _part (a hash of the text), base and terms, both as kind:start:end lists.

    terms has the disclosing terms, those of `removed` among them wholly. A term meets an entity if it is one of the NEAR
    words on either side of it; d(t) and d(c) count all documents with the term or the entity anywhere. Whole texts are
    read; null ones are empty. Documents are counted by their rows. Equal rows share one result.
    """
    schema = _seen(docs.schema[key].dataType.simpleString())
    seen = cut(keyed(docs, text, key).mapInArrow(_first_pass(schema), schema))
    documents = docs.count()
    base = seen.where("pos = 0").groupBy("key", "part").agg(F.first("spans").alias("base"))
    pairs = seen.where("pos = 1").select("key", "part", "n", "entity", "term", "s", "e")
    met = pairs.groupBy("entity", "term").agg(F.sum(F.col("n") % 2).alias("j")).where(F.col("j") >= MIN_MEETINGS)
    entities = pairs.groupBy("entity").agg(F.sum(F.expr("n div 2")).alias("dc"))
    terms = seen.where("pos = 2").groupBy("term").agg(F.sum("n").alias("dt"))
    n = F.lit(float(documents))
    content = F.log(n / F.col("dc"))
    pmi = F.log(n * F.col("j") / (F.col("dc") * F.col("dt")))
    judged = met.join(entities, "entity").join(terms, "term").where((content > 0) & (pmi >= content / ALPHA))
    judged = judged.select("entity", "term", (pmi >= content - 1e-9).alias("whole"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    told = pairs.withColumn("salt", F.pmod(F.hash("key", "part"), F.lit(SALTS))).join(judged, ["entity", "term", "salt"])
    spans = told.groupBy("key", "part", "s", "e").agg(F.max("whole").alias("whole")).groupBy("key", "part").agg(F.array_sort(F.collect_list(F.struct("s", "e", "whole"))).alias("terms"))
    listed = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["s"], x["e"])), ",")
    whole = F.array_join(F.transform(F.filter("terms", lambda x: x["whole"]), lambda x: F.concat_ws(":", F.lit("term"), x["s"], x["e"])), ",")
    base, spans = base.withColumnsRenamed({"key": "_key", "part": "_part"}), spans.withColumn("_listed", listed).withColumn("_whole", whole)
    joined = base.join(spans, F.col("_key").eqNullSafe(F.col("key")) & (F.col("_part") == F.col("part")), "left")
    return joined.select("_key", "_part", "base", F.coalesce("_listed", F.lit("")).alias("terms"), F.coalesce("_whole", F.lit("")).alias("removed"))


def sanitised(text: str, base: str, terms: str, removed: str) -> str:
    """The text with entities as placeholders, generalised terms as the shape of a word, and removed terms left out."""
    gone = set(removed.split(","))
    spans = [(int(s), -int(e), k, f"{k}:{s}:{e}") for k, s, e in (x.split(":") for x in f"{base},{terms}".split(",") if x)]
    out, at = [], 0
    for start, minus_end, kind, span in sorted(spans):
        if start < at:
            at = max(at, -minus_end)  # overlapping finds become one placeholder
            continue
        word = text[start:-minus_end]
        shape = "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"
        out += [text[at:start], REPLACEMENTS.get(kind) or ("" if span in gone else shape)]
        at = -minus_end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with their texts sanitised; rows and columns stay as they are, and null texts stay null."""
    # names that no input column is likely to have
    own = {c: f"__private_{c.strip('_')}" for c in ("_key", "_part", "base", "terms", "removed")}
    found = find_private(docs, text, key).withColumnsRenamed(own)
    same = F.col(key).eqNullSafe(F.col(own["_key"])) & (F.xxhash64(text) == F.col(own["_part"]))
    joined = docs.join(found, same, "left")
    schema = StructType(docs.schema.fields)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch[c].to_pylist() for c in (text, own["base"], own["terms"], own["removed"])]
            texts = [t if t is None or b is None else sanitised(t, b, w, r) for t, b, w, r in zip(*lists)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch[c].type) if c == text else batch[c] for c in schema.names], names=schema.names)

    return joined.select(*schema.names, own["base"], own["terms"], own["removed"]).mapInArrow(clean, schema)
