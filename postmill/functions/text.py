"""Text normalisation as Column functions. All but `clean_body` run on the JVM."""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A remark behind a product name is in brackets and says how often it was used, that it is new or old, or where it is from.
#: A number of uses: 3, x3, 3x, 3rd, 3-ish, with a word for use behind it.
TIMES = r"(?:x[ ]?\d+|\d+[ ]?(?:x|st|nd|rd|th)?(?:[ ]?-?[ ]?ish)?)(?:[ ]+(?:uses?|shaves?))?"
FRESH = r"(?:brand[ ]+)?(?:new|fresh|first|last|final)(?:[ ]+(?:use|shave|one))?[!?]*"
PLACE = r"(?:made[ ]+in[ ]+)?(?:usa|uk|china|india|japan|russia|germany|egypt|pakistan|israel|turkey)"
#: Remarks in brackets, one left open at the end, and counts without brackets. A year (19xx, 20xx) alone is no count.
USAGE = (
    rf"(?i)[(\[{{]\s*(?!(?:19|20)\d\d\s*[)\]}}])(?:{TIMES}|{FRESH}|{PLACE})\s*[)\]}}]",
    r"[(\[{]\s*(?!(?:19|20)\d\d\s*$)\d+\s*$",
    r"(?i)\s(?:#\d+\b|x\s?\d+\s*$)",
)
#: The same without look-ahead, as other regular expression engines take it: counts of at most three digits.
PLAIN_USAGE = (rf"(?i)[(\[{{][ ]*(?:[0-9]{{1,3}}|[0-9]+x|x[0-9]+|[0-9]+[ ]+uses?|[0-9]+(?:st|nd|rd|th)(?:[ ]+(?:shave|use))?)[ ]*[)\]}}]", r"(?i)[ ]#[0-9]+")


def _fold(text: Column, patterns: Sequence[str], to: str = "") -> Column:
    return functools.reduce(lambda c, p: F.regexp_replace(c, p, to), patterns, text)


def _has(text: Column, *parts: str) -> Column:
    return functools.reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))


def _where(text: Column, needed: Callable[[Column], Column], change: Callable[[Column], Column]) -> Column:
    """The text changed where a cheap look says that there may be something to change.

    The text is bound once by a lambda: named three times, it would be computed, and nested, three times over.
    """
    return F.get(F.transform(F.array(text), lambda t: F.when(needed(t), change(t)).otherwise(t)), F.lit(0))


def one_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \t\r\n\f]+", " "))


def strip_links(text: Column) -> Column:
    """[words](address) becomes words; bare addresses and "(link)" go."""

    def change(t: Column) -> Column:
        return _fold(F.regexp_replace(t, r"\[([^\]]+)\]\([^)]*\)", "$1"), (r"https?://[^ )\]]+", r"(?i)\(link\)"))

    return one_space(_where(text, lambda t: _has(t, "](", "://", "("), change))


def strip_handles(text: Column) -> Column:
    """@name becomes name, where it stands at the beginning or after a blank."""
    return _where(text, lambda t: _has(t, "@"), lambda t: F.regexp_replace(t, r"(^|[ (])@([A-Za-z0-9_]+)", "$1$2"))


def strip_asterisks(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(text, F.lit("*"), F.lit("")), r"^[ \-:;,.]+", ""))


def strip_usage(text: Column, patterns: Sequence[str] = USAGE) -> Column:
    """Without asterisks and without remarks on usage. Remarks need a bracket, or a mark with a digit."""
    plain = F.replace(text, F.lit("*"), F.lit(""))
    return one_space(_where(plain, lambda t: t.rlike(r"[(\[{]|[#xX]\s?\d"), lambda t: _fold(t, patterns)))


def strip_tags(text: Column, strip: Sequence[str], keep: Sequence[str] = ()) -> Column:
    """Remove $TAG and #TAG of a list, with backquotes and asterisks around them; tags to keep stay."""
    tags = sorted({t.upper() for t in strip} - {t.upper() for t in keep}, key=lambda t: (-len(t), t))
    if not tags:
        return text
    return one_space(F.regexp_replace(text, r"(?i)[`*]*[$#](" + "|".join(map(re.escape, tags)) + r")\b[`*]*", ""))


HANDLE_REMARK = r"(?i)\([^)]*\bhandle\b[^)]*\)"
#: Product words in brackets, and behind a dash at the end.
PRODUCT_WORDS = (r"(?i)[ ]*[(\[][ ]*(shaving[ ]+)?(soap|cream|croap|stick|puck)s?[ ]*[)\]]", r"(?i)[ ]+-[ ]+(soap|cream|croap|stick|puck)s?[ ]*$")
LAST_SOAP = r"(?i)[ ]+soaps?[ ]*$"
BRACKETED = r"[(\[{][^)\]}]*[)\]}]"
#: Parts of column names that a title has in capitals.
ACRONYMS = ("ac", "cb", "de", "gem", "hhi", "id")


def strip_handle_remark(text: Column) -> Column:
    return one_space(F.regexp_replace(text, HANDLE_REMARK, ""))


def strip_product_words(text: Column) -> Column:
    return one_space(_fold(text, PRODUCT_WORDS))


def strip_last_soap(text: Column) -> Column:
    """A maker's name without "soap" or "soaps" at its end, as lists of makers often have it."""
    return F.regexp_replace(text, LAST_SOAP, "")


def plain_remainder(text: Column, brackets: bool = True) -> Column:
    """Lower-case letters and digits of a remainder, one blank between them; without what brackets hold, if so asked."""
    kept = F.lower(text) if brackets else F.regexp_replace(F.lower(text), BRACKETED, " ")
    return F.trim(F.regexp_replace(kept, "[^a-z0-9]+", " "))


def titled(name: Column) -> Column:
    """A column name as a title: words with a capital, acronyms in capitals."""
    words = F.transform(F.split(name, "_"), lambda w: F.when(w.isin(*ACRONYMS), F.upper(w)).otherwise(F.initcap(w)))
    return F.array_join(words, " ")


# What the text of a soap says beside its name.
SAMPLES = ("samp", "sample", "smush", "tester")
FORMS = ("cream", "croap", "foam", "gel", "puck", "stick")
OTHER_ENDS = ("crema da barba", "hard", "omnibus", "shaving", "tube")
BASES = ("luxury", "omnibus", "premium", "tallow")
BASE_NAMES = ("milksteak", "professional", "tallow", "tusk", "vegan")

#: Blanks, as all regular expression engines take them.
_B = r"[ \t\r\n\f]"


def _any(*words: str) -> str:
    return "(?:" + "|".join(w.replace(" ", f"{_B}+") for w in words) + ")"


#: A remark in brackets is on a sample, an amount, a year of foundation, or the base.
SOAP_REMARK = rf"(?i){_B}*\({_B}*(?:{_any(*SAMPLES)}[^()]*|(?:[^()]*[^()0-9])?[0-9]+{_B}*oz\b[^()]*|est\.{_B}*[0-9]+[^()]*|{_any(*BASES)}{_B}+{_any('base', 'formulation')}|{_any(*BASE_NAMES)}){_B}*\){_B}*"
#: Words at the end, any number of them: samples, forms with or without a verb, and others. Makers' names end with "soap", so that needs a dash or a verb.
_FORM = rf"(?:shav(?:e|ing){_B}+{_any('soap', *FORMS)}|{_any(*FORMS, *OTHER_ENDS)}){_B}*[.!?]*"
SOAP_END = rf"(?i)(?:[ \t\r\n\f-]+(?:{_any(*SAMPLES)}|{_FORM})|{_B}*-[ \t\r\n\f-]*soap{_B}*[.!?]*)+[ \t\r\n\f-]*$"
SOAP_INSIDE = rf"(?i){_B}+{_any('crema da barba')}{_B}+"
#: In this order, each with what takes its place. One pass is enough: nothing that goes last uncovers what goes first.
SOAP_STEPS = ((SOAP_REMARK, " "), (SOAP_INSIDE, " "), (SOAP_END, ""), (r"^[ \t\r\n\f]*-[ \t\r\n\f-]*|[ \t\r\n\f-]*-[ \t\r\n\f]*$", ""))


def strip_soap_rules(text: Column) -> Column:
    """The maker and name of a soap without remarks in brackets and product words at the end, however many follow each other.

    A remark within the text leaves one blank. Null stays null.
    """
    return one_space(functools.reduce(lambda c, step: F.regexp_replace(c, *step), SOAP_STEPS, text))


def strip_end(text: Column) -> Column:
    return F.regexp_replace(text, r"[.!,;: \t\r\n]+$", "")


def bracket_spaces(text: Column) -> Column:
    """No blanks just inside round brackets."""
    return _where(text, lambda t: _has(t, "( ", " )"), lambda t: _fold(F.regexp_replace(t, r"\([ ]+", "("), (r"[ ]+\)",), ")"))


def for_matching(text: Column, field: str, tags: Sequence[str] = (), usage: Sequence[str] = USAGE) -> Column:
    """The fixed order of steps before a product name is looked up; null and blank stay null."""
    out = strip_links(strip_asterisks(strip_handles(strip_tags(text, tags))))
    if field in ("blade", "razor"):
        out = strip_usage(out, usage)
    if field == "razor":
        out = strip_handle_remark(out)
    if field == "soap":
        out = strip_soap_rules(out)
    return F.nullif(one_space(strip_end(bracket_spaces(out))), F.lit(""))


ACCENTED, PLAIN = "áàâäãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def for_alignment(text: Column) -> Column:
    """Lower case without accents, with "and" for "&"."""
    return one_space(F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), "&", " and "))


@F.pandas_udf(StringType())
def clean_body(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility forms, character references, typographic quotes and escapes made plain; needs Unicode tables, hence Arrow."""
    plain = str.maketrans({0x2019: "'", 0x2018: "'", 0x201C: '"', 0x201D: '"', 0x2013: "-", 0x2014: "-"} | dict.fromkeys((0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        text = html.unescape(unicodedata.normalize("NFKC", text.translate(plain))).translate(plain)
        text = re.sub(r"\\([*_`\\\[\]])", r"\1", text)
        return "\n".join(" ".join(line.split()) for line in text.splitlines())

    for batch in batches:
        yield batch.map(clean)
