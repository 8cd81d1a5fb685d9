"""Fields out of post bodies: for each field the first line that marks it, else the first one that begins with its name."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a field can be called. Soap comes with what follows the shave, or with "shaving" in front.
AFTER_SHAVE = ("post", "aftershave", "a/s", "as", "splash")
ALIASES: dict[str, tuple[str, ...]] = {
    "razor": ("straight razor", "razor"),
    "blade": ("blade",),
    "brush": ("shaving brush", "brush"),
    "soap": (*(f"{base} & {post}" for base in ("soap", "lather") for post in AFTER_SHAVE), "shaving soap", "shaving lather", "soap", "lather"),
}

# A marked line has three parts: a label, with signs around it; a separator, within the signs or behind them; a value.
#: Signs in front of a label: bullets, check marks, pictures, hashes, asterisks, underscores.
SIGNS = r"[^\p{L}0-9\n]*"
#: What stands between label and value.
SEPARATOR = "(?:[:=-]|//)"
#: Any text of one line that is more than signs.
VALUE = r"[^\n]*[^*_\s][^\n]*"
#: The same up to the next asterisk, for a bold stretch that holds label and value.
BOLD_VALUE = r"[^*\n]*[^*_\s][^*\n]*"
#: A field within a line, and where the next one of the line begins.
INLINE = r"(?i)\b{a}[*_ ]*[:=][ ]*(.+)$"
NEXT_FIELD = r"(?i)[ ]+[*_]*(razor|blade|brush|soap|lather)[*_]*[ ]*[:=].*$"
NOT_A_FIELD = {"soap": r"(?i)^lather[ ]+games", "razor": r"(?i)^razor[ ]+test"}


def _label(names: Sequence[str]) -> str:
    """Any of the names, the longest first."""
    return "(?:" + "|".join(n.replace(" ", "[ ]+") for n in sorted(names, key=lambda n: (-len(n), n))) + ")"


def marked_line(names: Sequence[str]) -> str:
    """First line with a label and a mark: the value is group 1 if it is in bold with its label, else group 2.

    Tried in this order: label, separator and value in one bold stretch; a label with a separator, whatever signs stand
    around them; a label in bold alone.
    """
    label = _label(names)
    bold = rf"[*][*][ ]*{label}[ ]*{SEPARATOR}[ ]*({BOLD_VALUE})"
    rest = rf"(?:{label}[ *_#]*{SEPARATOR}[ *_]*|[*][*][ ]*{label}[ ]*[*][*])({VALUE})"
    return rf"(?i)(?:^|\n)(?:{SIGNS}{bold}|{SIGNS}{rest})"


def bare_line(names: Sequence[str]) -> str:
    """First line with a label and a value that has no separator; it counts only where no line is marked."""
    return rf"(?i)(?:^|\n){SIGNS}{_label(names)}[ ]+([^:=\n-]*[^:=*_\s-][^:=\n-]*)(?:\n|$)"


def unlike_field(field: str) -> str | None:
    """Whole lines that begin like a field but are none, with the line end in front of them."""
    return NOT_A_FIELD[field].replace("^", r"(?:^|\n)") + r"[^\n]*" if field in NOT_A_FIELD else None


#: Where a line goes on with another field behind a bullet.
FURTHER = rf"(?i)[ .]+([*-][ ]+[*_]*{_label([n for names in ALIASES.values() for n in names])}[*_]*[ ]*[:=])"


def one_field_a_line(body: Column) -> Column:
    """Fields that follow another one in its line, behind a bullet, get a line of their own; a null body is empty."""
    return F.regexp_replace(F.coalesce(body, F.lit("")), FURTHER, "\n$1")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once; named several times, it would be computed as often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def needed_words(names: Sequence[str]) -> list[str]:
    """Words of which each text with one of the names has one: names without a blank, and a word of each that has none of these."""
    single = [n for n in names if " " not in n]
    return single + [max(n.split(), key=len) for n in names if not set(n.split()) & set(single)]


def field_value(body: Column, field: str, aliases: Mapping[str, Sequence[str]] = ALIASES) -> Column:
    """Value of a field: of the first marked line, else of the first bare one.

    The body is searched once for either, and only where it has a word of the field. The marked line alone is then taken
    apart. Lines that only begin like the field have no mark, so they are left out of the search for bare ones alone.
    """
    unlike, marked, bare, empty = unlike_field(field), marked_line(aliases[field]), bare_line(aliases[field]), F.lit("")

    def of_bare(text: Column) -> Column:
        return F.regexp_extract(F.regexp_replace(text, unlike, "") if unlike else text, bare, 1)

    def of_either(text: Column) -> Column:
        parts = lambda line: F.concat(F.regexp_extract(line, marked, 1), F.regexp_extract(line, marked, 2))
        return _bound(F.regexp_extract(text, marked, 0), lambda line: F.when(line != "", parts(line)).otherwise(of_bare(text)))

    def of(text: Column) -> Column:
        has = functools.reduce(operator.or_, (F.contains(F.lower(text), F.lit(w)) for w in needed_words(aliases[field])))
        return _bound(F.trim(F.when(has, of_either(text)).otherwise(empty)), lambda value: F.when(value != "", value))

    return _bound(body, of)


def marking(line: Column, field: str) -> Column:
    """How a line is marked: signs in front of its label, and what is between label and value; null if it is not of the field."""
    label = _label(ALIASES[field])
    pattern = rf"(?i)^({SIGNS}){label}([ *_#]*(?:{SEPARATOR})?[ *_#]*)"
    return F.when(line.rlike(rf"(?i)^{SIGNS}{label}(?:[ *_#:=-]|//)"), F.concat(F.regexp_extract(line, pattern, 1), F.lit("label"), F.regexp_extract(line, pattern, 2)))


def inline_value(line: Column, field: str) -> Column:
    """Value of a field that shares its line with others: it ends where the next field begins; null if there is none."""
    value = F.regexp_extract(line, INLINE.replace("{a}", field), 1)
    return F.nullif(F.trim(F.regexp_replace(value, NEXT_FIELD, "")), F.lit(""))


def guarded_lines(body: Column, field: str) -> Column:
    """Number of lines that begin like a field but are none; a null body has none."""
    lines = F.split(F.coalesce(body, F.lit("")), "\n")
    return F.size(F.filter(lines, lambda line: line.rlike(NOT_A_FIELD[field]))).cast("long")


def extract(posts: DataFrame, body: str = "body") -> DataFrame:
    """Add a column for each field, null where a body has none."""
    lines = "_field_lines"
    return posts.withColumn(lines, one_field_a_line(F.col(body))).withColumns({field: field_value(F.col(lines), field) for field in ALIASES}).drop(lines)


def kept_and_skipped(extracted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Posts with any field, and those without."""
    any_field = F.coalesce(*[F.col(f) for f in ALIASES]).isNotNull()
    return extracted.where(any_field), extracted.where(~any_field)


def exclusion_reasons(value: Column, rules: Mapping[str, str]) -> Column:
    """Names of the rules whose expression a value fits."""
    return F.array_compact(F.array(*[F.when(value.rlike(p), F.lit(name)) for name, p in rules.items()]))


def with_overrides(extracted: DataFrame, overrides: DataFrame, field: str) -> DataFrame:
    """Replace or create a field's value by (month, id, field, value) rows; `overridden` says where.

    The id comes first among the keys: rows are sorted by it, and hardly any two are alike in it as they are in the month.
    """
    mine = overrides.where(F.col("field") == field).select("id", "month", F.col("value").alias("_value"))
    joined = extracted.join(mine, ["id", "month"], "left")
    return joined.withColumns({field: F.coalesce("_value", field), "overridden": F.col("_value").isNotNull()}).drop("_value")


def unknown_overrides(overrides: DataFrame, posts: DataFrame) -> DataFrame:
    """Overrides of posts that do not exist; there should be none."""
    return overrides.join(posts.select("month", "id"), ["month", "id"], "left_anti")
