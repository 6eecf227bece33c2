"""Relation generators: deduplicate, series, spines, stars, unions, pivots."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.group import GroupedData

from touchline.plans.skew import first_rows

MAX_PIVOT_VALUES = 10_000
SOURCE_COLUMN = "_source_relation"
SPINE_PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One whole row per partition, the first in ``order_by``; NULL keys form a partition."""
    return first_rows(df, partition_by, order_by)


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    if n <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, n + 1).withColumnRenamed("id", "generated_number")


def _boundary(part: str, moment: Column) -> Column:
    if part == "week":  # weeks start on Sunday here, on Monday in date_trunc
        return F.date_trunc("week", moment + F.make_dt_interval(days=F.lit(1)))
    return F.date_trunc(part, moment)


def _span(part: str, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """(first moment, last moment, number of part boundaries between them)."""
    if part not in SPINE_PARTS:
        raise ValueError(f"part must be one of {SPINE_PARTS}, got {part!r}")
    first, last = start.cast("timestamp"), end.cast("timestamp")
    return first, last, F.timestamp_diff(part.upper(), _boundary(part, first), _boundary(part, last))


def spine(part: str, start: Column, end: Column) -> Column:
    """Array of moments from ``start``, one per ``part``; as many as part boundaries lie before ``end``."""
    first, last, steps = _span(part, start, end)
    numbers = F.when(steps > 0, F.sequence(F.lit(0).cast("bigint"), steps - 1))
    moments = F.transform(numbers, lambda i: F.timestamp_add(part.upper(), i, first))
    return F.filter(moments, lambda m: m <= last)


def date_spine(spark: SparkSession, part: str, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> DataFrame:
    """``date_<part>`` from ``start`` up to but without ``end``."""
    first, last, steps = _span(part, F.lit(start), F.lit(end))
    count = spark.range(1).select(steps.alias("n")).first()["n"] or 0
    moments = spark.range(max(0, count)).select(F.timestamp_add(part.upper(), F.col("id"), first).alias(f"date_{part}"))
    return moments.where(F.col(f"date_{part}") <= last)


def date_spine_per_row(df: DataFrame, part: str, start: str, end: str) -> DataFrame:
    """A spine for every row, between two of its columns."""
    return df.withColumn(f"date_{part}", F.explode(spine(part, F.col(start), F.col(end))))


def star(df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "") -> list[Column]:
    """The columns of ``df`` but ``exclude`` (in any case), renamed with prefix and suffix."""
    left_out = {c.lower() for c in exclude}
    return [df[f"`{c}`"].alias(f"{prefix}{c}{suffix}") for c in df.columns if c.lower() not in left_out]


def group_by_ordinals(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def union_relations(
    dfs: Mapping[str, DataFrame],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    override: Mapping[str, str] | None = None,
    source_col: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """Rows of all relations, columns by name in the order first seen, NULL where one has no such column."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    types: dict[str, T.DataType | str] = {}
    for df in dfs.values():
        for f in df.schema.fields:
            low = f.name.lower()
            if (not wanted or low in wanted) and low not in unwanted:
                types.setdefault(f.name, f.dataType)
    if not types:
        raise ValueError(f"no columns to union in {', '.join(dfs)}")
    types.update({c: t for c, t in (override or {}).items() if c in types})

    def shaped(name: str, df: DataFrame) -> DataFrame:
        rows = df.where(where) if where else df
        source = [F.lit(name).alias(source_col)] if source_col else []
        cells = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return rows.select(*source, *cells)

    return reduce(lambda a, b: a.unionByName(b), [shaped(n, df) for n, df in dfs.items()])


def relations_by_pattern(
    spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str | None = None
) -> list[str]:
    """Names of tables and views whose name matches an SQL pattern ('%' and '_'), case-insensitive."""

    def matcher(pattern: str) -> Callable[[str], bool]:
        parts = {"%": ".*", "_": "."}
        regex = re.compile("".join(parts.get(ch, re.escape(ch)) for ch in pattern), re.IGNORECASE | re.DOTALL)
        return lambda name: regex.fullmatch(name) is not None

    fits, dropped = matcher(table_pattern), matcher(exclude)
    in_schema = matcher(schema_pattern) if schema_pattern else (lambda name: True)
    databases = [d.name for d in spark.catalog.listDatabases() if in_schema(d.name)] if schema_pattern else [None]
    found = set()
    for database in databases:
        for t in spark.catalog.listTables(database) if database else spark.catalog.listTables():
            if fits(t.name) and not dropped(t.name):
                found.add(t.name if t.isTemporary or not t.namespace else ".".join([*t.namespace, t.name]))
    return sorted(found)


def union_by_pattern(
    spark: SparkSession, table_pattern: str, exclude: str = "", schema_pattern: str | None = None, **options: Any
) -> DataFrame:
    names = relations_by_pattern(spark, table_pattern, exclude, schema_pattern)
    if not names:
        raise ValueError(f"no table matches {table_pattern!r}")
    return union_relations({n: spark.table(n) for n in names}, **options)


def _slug(name: str) -> str:
    slug = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", name.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug


COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg,
}
DISTINCT_AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum_distinct,
    "count": F.count_distinct,
    "min": F.min,
    "max": F.max,
    "avg": lambda c: F.sum_distinct(c) / F.count_distinct(c),
}


def pivot(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    values: Sequence[Any] | DataFrame,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Any = 1,
    else_value: Any = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> DataFrame:
    """A column per value: an aggregate of ``then_value`` where the column compares with it, else ``else_value``.

    ``then_value`` and ``else_value`` may be columns. A DataFrame of values is fetched, as the
    columns of the result depend on it; more than ``MAX_PIVOT_VALUES`` of them is an error.
    """
    if isinstance(values, DataFrame):
        rows = values.limit(MAX_PIVOT_VALUES + 1).collect()
        if len(rows) > MAX_PIVOT_VALUES:
            raise ValueError(f"more than {MAX_PIVOT_VALUES} values to pivot on")
        values = [r[0] for r in rows]
    reduce_to = (DISTINCT_AGGREGATES if distinct else AGGREGATES)[agg]
    cells = []
    for value in values:
        hit = COMPARISONS[cmp](F.col(column), F.lit(value))
        name = f"{prefix}{value}{suffix}"
        cell = reduce_to(F.when(hit, then_value).otherwise(else_value))
        cells.append(cell.alias(name if quote_identifiers else _slug(name)))
    return df.groupBy(*by).agg(*cells)


def unpivot(
    df: DataFrame,
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per row and column other than ``exclude`` (kept) and ``remove`` (dropped); NULLs stay."""
    left_out = {c.lower() for c in [*exclude, *remove]}
    melted = [c for c in df.columns if c.lower() not in left_out]
    typed = df.select(*exclude, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in melted])
    return typed.unpivot(list(exclude), melted, field_name, value_name)


def nullcheck_table(df: DataFrame) -> DataFrame:
    """Empty text becomes NULL in every text column."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values, the most frequent first unless ordered otherwise."""
    rows = df.where(where) if where else df
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(*(order_by or [F.col("n").desc(), F.col("value")]))
    return (ordered if max_records is None else ordered.limit(max_records)).select("value")


def single_value(df: DataFrame, default: Any = None) -> Column:
    """The first cell of a query as a scalar column, ``default`` when there is no row."""
    first = df.columns[0]
    cell = df.limit(1).select(F.col(first).alias("v"))
    if default is None:
        return cell.scalar()
    # count tells an empty query from a NULL cell
    picked = cell.agg(F.when(F.count("*") == 0, F.lit(default)).otherwise(F.first("v")).alias("v"))
    return picked.scalar()
