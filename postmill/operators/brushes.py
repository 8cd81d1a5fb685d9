"""Brushes from their texts: every cut at a delimiter with its roles, strategies with what speaks for them, and scores.

All of a text's candidates and their features are arrays within its row, and weights are literals, so that one setting of
weights or many are scored in one pass. Posts repeat their texts, so each distinct text is scored once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators.resolution import fiber, knot_size

# Delimiters with how sure they are, and what makes a part look like a handle (above 0) or a knot (below).
DELIMITERS = ((" w/", "high"), (" with ", "high"), (" in ", "high"), (" - ", "medium"), (" + ", "medium"), ("/", "medium"), (" (", "medium"))
LEANS = ((r"handle", 10), (r"stock|custom|artisan|turned|wood|resin", 2), (r"badger|boar|synthetic|syn|nylon", -8), (r"knot", -10), (r"[0-9]+[ ]*mm", -6), (r"[vb][0-9]", -6))
#: Words before a slash that make it no delimiter: with, and names of people and places on the board.
NO_SLASH = (" w", " r", " u")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What `use` makes of a value that is computed once, however often it comes up."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def leaning(part: Column) -> Column:
    """How much a part looks like a handle rather than a knot."""
    return bound(F.lower(part), lambda low: sum((F.when(low.rlike(p), n).otherwise(0) for p, n in LEANS), F.lit(0)))


def cuts(text: Column) -> Column:
    """All ways to cut a text in two, at each place of each delimiter: array of (position, delimiter, confidence, handle, knot, lead).

    A part in brackets is cut from what stands before it. The part that leans more to a handle is the handle; where both
    lean alike it is the first one, but the second one after "in", which names the handle that a knot is in. `lead` is
    the difference. A null text has no cuts.
    """
    return bound(F.struct(text.alias("text"), F.lower(text).alias("low"), F.length(text).alias("size")), _cuts)


def _cuts(t: Column) -> Column:
    text, low, size = t["text"], t["low"], t["size"]

    def at(d: str, confidence: str, i: Column) -> Column:
        left, right = F.trim(F.substring(text, F.lit(1), i - 1)), F.trim(F.substring(text, i + len(d), size))
        right = F.trim(F.replace(right, F.lit(")"), F.lit(""))) if d == " (" else right
        place = (i.alias("position"), F.lit(d).alias("delimiter"), F.lit(confidence).alias("confidence"))

        def roles(p: Column) -> Column:
            first = p["lead"] >= 0 if d != " in " else p["lead"] > 0
            return F.struct(*place, F.when(first, p["l"]).otherwise(p["r"]).alias("handle"), F.when(first, p["r"]).otherwise(p["l"]).alias("knot"), F.abs(p["lead"]).alias("lead"))

        weighed = lambda p: F.struct(p["l"].alias("l"), p["r"].alias("r"), (leaning(p["l"]) - leaning(p["r"])).alias("lead"))
        return bound(bound(F.struct(left.alias("l"), right.alias("r")), weighed), roles)

    def before(i: Column) -> Column:
        """The two characters before a place, the text's beginning being a blank."""
        return F.when(i == 2, F.concat(F.lit(" "), F.substring(low, F.lit(1), F.lit(1)))).otherwise(F.substring(low, i - 2, F.lit(2)))

    def places(d: str, confidence: str) -> Column:
        hit = lambda i: (F.substring(low, i, F.lit(len(d))) == d) & (~before(i).isin(*NO_SLASH) if d == "/" else F.lit(True))
        every = F.when(F.contains(low, F.lit(d)), F.filter(F.sequence(F.lit(1), size), hit)).otherwise(F.array().cast("array<int>"))
        return F.transform(every, lambda i: at(d, confidence, i))

    return F.filter(F.concat(*[places(*d) for d in DELIMITERS]), lambda c: (c["handle"] != "") & (c["knot"] != ""))


# Base scores of the strategies, and weights of what speaks for or against each.
WEIGHTS: Mapping[str, Mapping[str, float]] = {
    "known_brush": {"base": 155.0},
    "automated_split": {"base": 55.0, "multiple_brands": 125.0, "handle_brand_without_knot_brand": -15.0, "knot_brand_without_handle_brand": -15.0, "same_brand": -20.0, "neither_brand": -20.0, "high_confidence": 20.0},
    "full_input": {"base": 50.0, "multiple_brands": 120.0, "handle_brand_without_knot_brand": -15.0, "knot_brand_without_handle_brand": -15.0, "same_brand": -20.0, "neither_brand": -20.0},
    "handle_matching": {"base": 30.0, "fiber_match": -5.0, "size_match": -5.0, "handle_indicators": 20.0, "priority_score": 5.0, "brand_match": 5.0},
    "knot_matching": {"base": 30.0, "fiber_match": 5.0, "size_match": 5.0, "handle_indicators": -15.0, "knot_indicators": 5.0, "priority_score": 5.0, "brand_match": 5.0},
}
#: Words of handles and knots on their own.
HANDLE_WORDS, KNOT_WORDS = r"handle|wood|resin|metal|turned|stock|custom", r"knot|badger|boar|synthetic|[0-9]+[ ]*mm"


STRATEGIES = list(WEIGHTS)


def weight_rows(weights: Mapping[str, Mapping[str, float]]) -> Column:
    """One setting of weights: for each strategy those of its features, in the order of WEIGHTS."""
    return F.array(*[F.array(*[F.lit(float(weights[s][f])) for f in WEIGHTS[s]]) for s in STRATEGIES])


class Makers:
    """Makers of handles or knots, known by a pattern whose first group is the name; an earlier pattern has the better priority."""

    def __init__(self, *patterns: str) -> None:
        self.patterns = patterns

    def name(self, part: Column) -> Column:
        """The maker's name in lower case, null where none is named."""
        low = F.lower(part)
        return F.coalesce(*[F.nullif(F.regexp_extract(low, p, 1), F.lit("")) for p in self.patterns])

    def points(self, part: Column) -> Column:
        """3 for the first priority, 2 for the second, and so on; none without a maker."""
        low = F.lower(part)
        out = F.lit(0)
        for k, p in reversed(list(enumerate(self.patterns))):
            out = F.when(low.rlike(p), max(0, 3 - k)).otherwise(out)
        return out


def candidates(text: Column, known: str, handles: Makers, knots: Makers) -> Column:
    """What each strategy makes of a text: array of (strategy, ord, handle, knot, features), without those that find nothing.

    `known` is a pattern of whole brushes. A strategy is its place among STRATEGIES, its features are in the order of
    WEIGHTS. Each cut is a candidate of its own.
    """
    one = lambda c: F.when(c, 1.0).otherwise(0.0)

    def candidate(strategy: str, order: Column, found: Column, handle: Column, knot: Column, features: Mapping[str, Column]) -> Column:
        vector = F.array(*[F.lit(1.0) if f == "base" else features[f].cast("double") for f in WEIGHTS[strategy]])
        fields = F.struct(F.lit(STRATEGIES.index(strategy)).alias("strategy"), order.cast("int").alias("ord"), handle.alias("handle"), knot.alias("knot"), vector.alias("features"))
        return F.when(found, fields)

    def pair(h: Column, k: Column) -> dict[str, Column]:
        has_h, has_k = h.isNotNull(), k.isNotNull()
        both = has_h & has_k
        return {
            "multiple_brands": one(both & (h != k)), "same_brand": one(both & (h == k)), "neither_brand": one(~has_h & ~has_k),
            "handle_brand_without_knot_brand": one(has_h & ~has_k), "knot_brand_without_handle_brand": one(has_k & ~has_h),
        }

    nothing = F.lit(None).cast("string")

    def whole(t: Column) -> Column:
        h, k = t["h"], t["k"]
        alone = {"fiber_match": one(t["fiber"].isNotNull()), "size_match": one(t["sized"]), "handle_indicators": one(t["low"].rlike(HANDLE_WORDS)), "knot_indicators": one(t["low"].rlike(KNOT_WORDS))}
        return F.array(
            candidate("known_brush", F.lit(0), t["low"].rlike(known), h, k, {}),
            candidate("full_input", F.lit(1000), h.isNotNull() | k.isNotNull(), h, k, pair(h, k)),
            candidate("handle_matching", F.lit(1001), h.isNotNull(), h, nothing, {**alone, "priority_score": handles.points(t["low"]), "brand_match": F.lit(1.0)}),
            candidate("knot_matching", F.lit(1002), k.isNotNull() | t["fiber"].isNotNull(), nothing, k, {**alone, "priority_score": knots.points(t["low"]), "brand_match": one(k.isNotNull())}),
        )

    def part(c: Column) -> Column:
        return F.struct(handles.name(c["handle"]).alias("h"), knots.name(c["knot"]).alias("k"), fiber(c["knot"]).isNotNull().alias("fiber"), (c["confidence"] == "high").alias("sure"))

    def split(c: Column, n: Column) -> Column:
        def scored(p: Column) -> Column:
            return candidate("automated_split", n + 1, p["h"].isNotNull() | p["k"].isNotNull() | p["fiber"], p["h"], p["k"], {**pair(p["h"], p["k"]), "high_confidence": one(p["sure"])})

        return bound(part(c), scored)

    facts = F.struct(F.lower(text).alias("low"), handles.name(text).alias("h"), knots.name(text).alias("k"), fiber(text).alias("fiber"), knot_size(text).isNotNull().alias("sized"))
    return F.array_compact(F.concat(bound(facts, whole), F.transform(F.array_sort(cuts(text)), split)))


def scored(found: Column, weights: Column) -> Column:
    """Candidates with their scores, the sum of the strategy's features times their weights: array of (score, first, strategy, handle, knot)."""

    def one(c: Column) -> Column:
        score = F.aggregate(F.zip_with(c["features"], F.get(weights, c["strategy"]), lambda x, w: x * w), F.lit(0.0), lambda total, x: total + x)
        return F.struct(score.alias("score"), (-c["ord"]).alias("first"), c["strategy"].alias("strategy"), c["handle"].alias("handle"), c["knot"].alias("knot"))

    return F.transform(found, one)


def best(found: Column, weights: Column) -> Column:
    """The candidate of the greatest score, the first of equal ones; null for none."""
    return F.array_max(scored(found, weights))


def best_of(text: Column, known: str, handles: Makers, knots: Makers, weights: Mapping[str, Mapping[str, float]] = WEIGHTS) -> Column:
    """The best candidate of a text under one setting of weights; the text is computed once."""
    return bound(text, lambda t: best(candidates(t, known, handles, knots), weight_rows(weights)))


def best_by_setting(found: Column, settings: Sequence[Mapping[str, Mapping[str, float]]]) -> Column:
    """The best candidate under each of several settings of weights, in their order; candidates are computed once."""
    return bound(found, lambda all_: F.transform(F.array(*[weight_rows(s) for s in settings]), lambda weights: best(all_, weights)))


def spread(texts: DataFrame) -> DataFrame:
    """Distinct texts dealt out evenly before they are scored, as scoring costs far more than a text's few bytes tell.

    The number of partitions is named, or texts of a few MB in all would be put together in few tasks. They are dealt out by
    no column, as Spark leaves out a second shuffle by the same one.
    """
    return texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def best_of_texts(rows: DataFrame, text: str, known: str, handles: Makers, knots: Makers) -> DataFrame:
    """Rows with `b`, the best candidate of their text: each distinct text is scored once and joined back."""
    once = spread(rows.select(text).where(F.col(text).isNotNull()).distinct())
    return rows.join(once.select(text, best_of(F.col(text), known, handles, knots).alias("b")), text, "left")


def strategy_name(place: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in STRATEGIES]), place)
