"""Dates out of titles, and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
NAME = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"


def _date(year: Column, month: Column, day: Column) -> Column:
    """A date, or null where there is no such day."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _part(title: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(title, pattern, group), F.lit(""))


def _number(name: Column) -> Column:
    return F.nullif(F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name), F.lit(0))


def title_date(title: Column, year: Column) -> Column:
    """The first that a title has of: May 3[, 2025]; 5/3[/2025]; 3 May 2025; 3. May. The year given stands in for none."""
    t = F.lower(title)
    named = rf"\b{NAME}\s+(\d{{1,2}})\b(?:[,\s]+(\d{{4}}))?"
    slashed = r"\b(\d{1,2})/(\d{1,2})(?:/(\d{4}))?"
    long, short = rf"(\d{{1,2}})\s+{NAME}\.?,?\s+(\d{{4}})", rf"\b(\d{{1,2}})\.\s+{NAME}\b"
    return F.coalesce(
        _date(F.coalesce(_part(t, named, 3), year.cast("string")), _number(_part(t, named, 1)), _part(t, named, 2)),
        _date(F.coalesce(_part(t, slashed, 3), year.cast("string")), _part(t, slashed, 1), _part(t, slashed, 2)),
        _date(_part(t, long, 3), _number(_part(t, long, 2)), _part(t, long, 1)),
        _date(year.cast("string"), _number(_part(t, short, 2)), _part(t, short, 1)),
    )


def month_list(first: Column, last: Column) -> Column:
    """All months from one to another, as yyyy-MM."""
    day = lambda m: F.to_date(F.concat(m, F.lit("-01")))
    return F.transform(F.sequence(day(first), day(last), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))
