"""The table language of report templates: {{tables.name|ranks:50|columns:rank, name=razor, shaves desc|deltas:true}}.

A placeholder is read on the driver and becomes one plan; only the finished, limited table is collected for rendering.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.categories import SPECS, category_table
from postmill.operators.periods import rank_moves
from postmill.operators.ranking import numbered, reranked, rows_with_ties, tie_marks, within_ranks
from postmill.plans.base import QUERIES, query
from postmill.plans.categories import category_sql
from postmill.sources.posts import posts

PLACEHOLDER = re.compile(r"\{\{tables\.([a-z_-]+)((?:\|[^{}|]+)*)\}\}")
NUMERIC = ("shaves", "unique_users", "uses", "unique_soaps", "missed_days")


@dataclass
class TableRequest:
    """What a placeholder asks for; columns are (name, shown as), order is (name, descending)."""

    name: str
    ranks: int | None = None
    rows: int | None = None
    deltas: bool = False
    columns: list[tuple[str, str]] = field(default_factory=list)
    order: list[tuple[str, bool]] = field(default_factory=list)
    threshold: tuple[str, float] | None = None


def parse(placeholder: str) -> TableRequest:
    """Read one placeholder; unknown parameters and a second threshold are errors."""
    found = PLACEHOLDER.fullmatch(placeholder.strip())
    if not found:
        raise ValueError(f"no table placeholder: {placeholder}")
    request = TableRequest(found[1].replace("-", "_"))
    for part in filter(None, found[2].split("|")):
        key, _, value = (x.strip() for x in part.partition(":"))
        if key in ("ranks", "rows"):
            setattr(request, key, int(value))
        elif key == "deltas":
            request.deltas = value.lower() == "true"
        elif key == "columns":
            for item in (x.strip() for x in value.split(",")):
                m = re.fullmatch(r"(\w+)(?:\s*=\s*([^=]+?))?(?:\s+(asc|desc))?", item)
                if not m:
                    raise ValueError(f"no column: {item}")
                request.columns.append((m[1], m[2] or m[1]))
                if m[3]:
                    request.order.append((m[1], m[3] == "desc"))
        elif key in NUMERIC:
            if request.threshold:
                raise ValueError("one threshold at most")
            request.threshold = (key, float(value))
        else:
            raise ValueError(f"unknown parameter: {key}")
    return request


def table_plan(tables: DataFrame, request: TableRequest, month: str, key: str) -> DataFrame:
    """The request's table of one month.

    Order of steps: threshold on another column than the first of the order, order with new ranks in all periods, ranks,
    rows with ties, remaining threshold, moves, marks of ties, columns.
    """
    early = request.threshold and request.order and request.threshold[0] != request.order[0][0]
    if early:
        tables = tables.where(F.col(request.threshold[0]) >= request.threshold[1])
    if request.order:
        tables = reranked(tables, [F.desc(c) if down else F.asc(c) for c, down in request.order], ["month"])
    moves = rank_moves(tables, [key], (1, 12, 60)).drop("delta_1", "delta_12", "delta_60") if request.deltas else tables
    out = moves.where(F.col("month") == month)
    if request.ranks:
        out = within_ranks(out, request.ranks)
    if request.rows:
        out = rows_with_ties(out, request.rows)
    if request.threshold and not early:
        out = out.where(F.col(request.threshold[0]) >= request.threshold[1])
    out = tie_marks(out, ["month"])
    shown = request.columns or [(c, c) for c in out.columns if c not in ("month", "rank_text") and not c.startswith("move_")]
    picked = [F.col("rank_text" if c == "rank" else c).alias(a) for c, a in shown]
    return out.orderBy("rank", key).select(*picked, *([c for c in out.columns if c.startswith("move_")]))


def render(frame: DataFrame, people: tuple[str, ...] = ("user",)) -> str:
    """A limited table as markdown: titles from names, thousands separated, u/ before people."""

    def cell(name: str, value) -> str:
        if value is None:
            return ""
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"{value:,}"
        return f"u/{value}" if name in people else str(value)

    heads = [c.replace("_", " ").title() for c in frame.columns]
    lines = ["| " + " | ".join(heads) + " |", "|" + " --- |" * len(heads)]
    return "\n".join(lines + ["| " + " | ".join(cell(c, v) for c, v in zip(frame.columns, row)) + " |" for row in frame.collect()])


def month_variables(spark: SparkSession, sf_dir: str, month: str) -> dict[str, str]:
    """The figures of a month as texts for a template: whole numbers with thousands separated, others with one decimal, and the month's name."""
    row = QUERIES["month_metadata"](spark, sf_dir).where(F.col("month") == month).select(F.date_format(F.to_date(F.concat("month", F.lit("-01"))), "MMMM yyyy").alias("month_year"), "*").first()
    if row is None:
        raise ValueError(f"no posts in {month}")
    return {k: f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:.1f}" if isinstance(v, float) else str(v) for k, v in row.asDict().items() if v is not None}


def report_text(template: str, spark: SparkSession, sf_dir: str, month: str) -> str:
    """A template's report of a month: its figures, its tables, and whatever text stands between."""
    return fill(template, month_variables(spark, sf_dir, month), spark, sf_dir, month)


def fill(template: str, variables: dict[str, str], spark: SparkSession, sf_dir: str, month: str) -> str:
    """A template with its variables, longest names first, and its tables. Unknown placeholders are an error."""
    for name in sorted(variables, key=len, reverse=True):
        template = template.replace("{{" + name + "}}", variables[name])

    def one(found: re.Match) -> str:
        request = parse(found[0])
        spec = SPECS[request.name]
        return render(table_plan(category_table(posts(spark, sf_dir), spec), request, month, next(iter(spec.keys))))

    out = PLACEHOLDER.sub(one, template)
    if left := re.findall(r"\{\{[^}]*\}\}", out):
        raise ValueError(f"unknown placeholders: {left}")
    return out


def rendered(table: DataFrame, columns: dict[str, str], order: list, period: str = "month", people: tuple[str, ...] = ("user",)) -> DataFrame:
    """Tables of all periods as lines of markdown, made where the rows are: (period, place, line); columns are shown as titles.

    Whole numbers have their thousands separated, people a u/ before them, and nulls are empty. A table's head has the
    places -1 and 0.
    """
    kinds = dict(table.dtypes)

    def cell(name: str) -> Column:
        value = F.format_number(name, 0) if kinds[name] in ("int", "bigint", "smallint", "tinyint") else F.col(name).cast("string")
        return F.coalesce(F.concat(F.lit("u/"), value) if name in people else value, F.lit(""))

    row = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    lines = numbered(table, order, [period], "place").select(period, "place", row([cell(c) for c in columns]).alias("line"))
    head = F.array(F.struct(F.lit(-1).alias("place"), row([F.lit(t) for t in columns.values()]).alias("line")), F.struct(F.lit(0).alias("place"), F.lit("|" + " --- |" * len(columns)).alias("line")))
    heads = table.select(period).distinct().select(period, F.explode(head).alias("h")).select(period, "h.*")
    return heads.unionByName(lines)


@query("table_render", f"""WITH g0 AS ({category_sql(SPECS['razor_manufacturers'])}), t AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY rank, brand)::INTEGER AS place FROM g0 WHERE rank <= 10)
    SELECT month, place, '| ' || rank || ' | ' || brand || ' | ' || format('{{:,}}', shaves) || ' | ' || format('{{:,}}', unique_users) || ' |' AS line FROM t UNION ALL SELECT DISTINCT month, -1, '| Rank | Maker | Shaves | Users |' FROM t UNION ALL SELECT DISTINCT month, 0, '| --- | --- | --- | --- |' FROM t""", posts=True)
def table_render(spark, sf):
    """The ten first makers of each month as a table of markdown."""
    tables = within_ranks(category_table(posts(spark, sf), SPECS["razor_manufacturers"]), 10)
    return rendered(tables, {"rank": "Rank", "brand": "Maker", "shaves": "Shaves", "unique_users": "Users"}, [F.asc("rank"), F.asc("brand")])


@query("table_dsl", f"""WITH g0 AS ({category_sql(SPECS['razor_manufacturers'])}), r AS (SELECT * EXCLUDE rank, rank() OVER (PARTITION BY month ORDER BY unique_users DESC)::INTEGER AS rank FROM g0 WHERE shaves >= 5)
    SELECT rank || CASE WHEN count(*) OVER (PARTITION BY rank) > 1 THEN '=' ELSE ' ' END AS rank, brand AS maker, unique_users FROM r WHERE month = '2000-03' AND rank <= 10""", posts=True)
def table_dsl(spark, sf):
    request = parse("{{tables.razor-manufacturers|shaves:5|ranks:10|columns:rank, brand=maker, unique_users desc}}")
    return table_plan(category_table(posts(spark, sf), SPECS["razor_manufacturers"]), request, "2000-03", "brand")
