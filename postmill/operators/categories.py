"""Ranked category tables: group, count posts and distinct people, rank within the period.

All periods are computed in one pass: the period is the first group key and the only partition key of the rank, so the
work spreads over periods and nothing is looped on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.ranking import numbered, ranked


@dataclass(frozen=True)
class CategorySpec:
    """keys: output name to SQL expression; where: SQL condition; display: names shown by the first post of a group."""

    name: str
    keys: dict[str, str]
    where: str = "true"
    display: dict[str, str] = field(default_factory=dict)
    sequential: bool = False


def category_table(posts: DataFrame, spec: CategorySpec, period: str = "month") -> DataFrame:
    """period, keys, displays, shaves, unique_users, rank. Groups with a null key or a null author's posts do not count."""
    rows = posts.where(spec.where).select(period, "id", "author", *[F.expr(e).alias(k) for k, e in spec.keys.items()], *[F.expr(e).alias(f"_{k}") for k, e in spec.display.items()])
    rows = rows.dropna(subset=list(spec.keys))
    # one row per person first: what is left to shuffle by key is small, and a busy key is spread over its people
    by_person = rows.groupBy(period, *spec.keys, "author").agg(F.count("author").alias("n"), *[F.min(F.struct("id", f"_{k}")).alias(f"_first_{k}") for k in spec.display])
    shown = [F.min(f"_first_{k}").getField(f"_{k}").alias(k) for k in spec.display]
    totals = by_person.groupBy(period, *spec.keys).agg(F.sum("n").alias("shaves"), F.count("author").alias("unique_users"), *shown)
    if spec.sequential:
        return numbered(totals, [F.desc("shaves"), F.desc("unique_users"), *[F.asc(k) for k in spec.keys]], [period])
    return ranked(totals, [F.desc("shaves"), F.desc("unique_users")], [period])


RAZOR = "razor_brand IS NOT NULL AND trim(razor_brand) <> '' AND razor_model IS NOT NULL"
BLADE = "blade_brand IS NOT NULL AND trim(blade_brand) <> '' AND blade_model IS NOT NULL"
SPECS: dict[str, CategorySpec] = {
    s.name: s
    for s in (
        CategorySpec("razors", {"name": "concat(razor_brand, ' ', razor_model)"}, RAZOR),
        CategorySpec("blades", {"name": "concat(blade_brand, ' ', blade_model)"}, BLADE),
        CategorySpec("brushes", {"name": "concat(handle_brand, ' ', handle_model)", "fiber": "coalesce(fiber, '')"}, "handle_brand IS NOT NULL"),
        CategorySpec("soaps", {"brand_key": "lower(soap_brand)", "scent_key": "lower(soap_scent)"}, "soap_brand IS NOT NULL AND soap_scent IS NOT NULL", {"name": "concat(soap_brand, ' - ', soap_scent)"}),
        CategorySpec("soap_sample_brands", {"sample_type": "sample_type", "brand": "lower(soap_brand)"}, "sample_type IS NOT NULL AND sample_type <> ''"),
        CategorySpec("soap_sample_brand_scents", {"sample_type": "sample_type", "brand": "lower(soap_brand)", "scent": "lower(soap_scent)"}, "sample_type IS NOT NULL AND sample_type <> ''"),
        CategorySpec("razor_manufacturers", {"brand": "razor_brand"}, RAZOR),
        CategorySpec("blade_manufacturers", {"brand": "blade_brand"}, BLADE),
        CategorySpec("soap_makers", {"brand": "lower(soap_brand)"}, "soap_brand IS NOT NULL"),
        CategorySpec("brush_handle_makers", {"handle_maker": "coalesce(nullif(handle_brand, ''), nullif(knot_brand, ''))"}),
        CategorySpec("brush_knot_makers", {"brand": "coalesce(nullif(knot_brand, ''), nullif(handle_brand, ''))"}),
        CategorySpec("brush_fibers", {"fiber": "nullif(fiber, '')"}),
        CategorySpec("brush_knot_sizes", {"knot_size_mm": "knot_size_mm"}, "knot_size_mm BETWEEN 15 AND 50"),
        CategorySpec("blackbird_plates", {"plate": "plate"}, "lower(razor_brand) = 'brand#7' AND lower(razor_model) LIKE '%bolt%'"),
        CategorySpec("christopher_bradley_plates", {"plate": "concat_ws('-', plate, plate_level)"}, "razor_brand = 'Brand#11'"),
        CategorySpec("game_changer_plates", {"gap": "gap"}, "razor_brand = 'Brand#13'"),
        CategorySpec("super_speed_tips", {"super_speed_tip": "tip"}, "razor_brand = 'Brand#17'"),
        CategorySpec("straight_widths", {"width": "width"}, "razor_format = 'PROMO'"),
        CategorySpec("straight_grinds", {"grind": "grind"}, "razor_format = 'PROMO'"),
        CategorySpec("straight_points", {"point": "point"}, "razor_format = 'PROMO'"),
        CategorySpec("razor_blade_combinations", {"name": "concat(razor_brand, ' ', razor_model, ' + ', blade_brand, ' ', blade_model)"}, f"{RAZOR} AND {BLADE}"),
    )
}
