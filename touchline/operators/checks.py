"""Data checks. Each returns its failing rows; ``run_checks`` turns a list of them into one report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.config import DEFAULTS
from touchline.plans.skew import SLOT_ROWS, expand_copies, order_slots

# Buckets of the hash comparison, as powers of two. Every map task sends a row per bucket, so the first level is small;
# large tables with few differences are worth a second one, such as (12, 18).
TREE_LEVELS = (12,)

GAP_RULES: dict[str, Callable[[Column, Column], Column]] = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    counted = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).where("n_records > 1")


def check_relationships(df: DataFrame, col: str, to: DataFrame, field: str) -> DataFrame:
    return check_relationships_where(df, col, to, field)


def check_relationships_where(
    df: DataFrame, col: str, to: DataFrame, field: str, from_cond: str | None = None, to_cond: str | None = None
) -> DataFrame:
    """Child values, one row each, that no parent row has; conditions apply before either side is read."""
    child = df.where(from_cond) if from_cond else df
    parent = to.where(to_cond) if to_cond else to
    ids = child.where(F.col(col).isNotNull()).select(F.col(col).alias("id"))
    known = parent.where(F.col(field).isNotNull()).select(F.col(field).alias("id")).distinct()
    return ids.join(known, "id", "left_anti")


def check_accepted_values(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    counted = df.groupBy(F.col(col).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.where(~F.col("value_field").isin(list(values)))


def check_not_accepted_values(df: DataFrame, col: str, values: Sequence[Any]) -> DataFrame:
    return df.where(F.col(col).isin(list(values))).select(F.col(col).alias("value_field")).distinct()


def check_accepted_range(
    df: DataFrame, col: str, min_value: Any = None, max_value: Any = None, inclusive: bool = True
) -> DataFrame:
    x = F.col(col)
    outside = F.lit(False)
    if min_value is not None:
        outside = outside | ~(x >= min_value if inclusive else x > min_value)
    if max_value is not None:
        outside = outside | ~(x <= max_value if inclusive else x < max_value)
    return df.where(outside)


def check_at_least_one(df: DataFrame, col: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any value; ungrouped, one row when the whole table has none."""
    if group_by:
        counts = df.groupBy(*group_by).agg(F.count(col).alias("n_values"))
    else:
        counts = df.where(F.col(col).isNotNull()).limit(1).agg(F.count(col).alias("n_values"))
    return counts.where("n_values = 0")


def _fold(side: DataFrame, names: Sequence[str], bits: int) -> DataFrame:
    """One row per bucket of row hashes: how many rows, and order-free sums of two 64-bit hashes of them."""
    def halves(h: str) -> list[Column]:  # sums of 32 bits stay within a long for two thousand million rows a bucket
        return [F.sum(F.shiftrightunsigned(h, 32)).alias(f"{h}_high"), F.sum(F.col(h).bitwiseAND((1 << 32) - 1)).alias(f"{h}_low")]

    return side.groupBy(_bucket(bits).alias("_b")).agg(F.count("*").alias("_rows"), *halves("_h"), *halves("_g"))


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned("_h", 64 - bits).cast("int") if bits else F.lit(0)


def unequal_parts(a: DataFrame, b: DataFrame, names: Sequence[str], levels: Sequence[int] = TREE_LEVELS) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in the hash buckets in which the sides differ, found level by level.

    Each side is reduced to order-free sums of row hashes per bucket, in the map tasks first. Only buckets whose sums
    differ are folded again more finely, and only the rows of those that still differ are returned; two equal tables
    cost one scan each and move no row. Buckets are at most two to the power of the last level, so their list may be
    broadcast. A difference is overlooked only if the count and both 64-bit sums of a bucket agree by chance.
    """
    # NULL leaves a hash as it is, so the places of NULLs take part too.
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in names])
    cells = [F.col(c) for c in names]
    hashes = {"_h": F.xxhash64(*cells, nulls), "_g": F.xxhash64(F.lit(1), nulls, *cells)}
    sides = [side.withColumns(hashes) for side in (a, b)]
    for bits in levels:
        one, other = (_fold(side, names, bits) for side in sides)
        sums = [c for c in one.columns if c != "_b"]
        meet = other.select(F.col("_b").alias("_c"), *[F.col(c).alias(f"{c}_other") for c in sums])
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_other")) for c in sums])
        differ = one.join(meet, F.col("_b") == F.col("_c"), "full_outer").where(~same).select(F.coalesce("_b", "_c").alias("_b"))
        sides = [side.join(F.broadcast(differ), _bucket(bits) == F.col("_b"), "left_semi") for side in sides]
    return tuple(side.select(*names) for side in sides)


def check_cardinality_equality(df: DataFrame, col: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs, as (value, count) of the side that has it."""
    a, b = unequal_parts(df.select(F.col(col).alias("value")), to.select(F.col(field).alias("value")), ["value"])
    both = a.withColumn("_ours", F.lit(True)).unionByName(b.withColumn("_ours", F.lit(False)))
    counts = both.groupBy("value").agg(F.count_if("_ours").alias("_a"), F.count_if(~F.col("_ours")).alias("_b"))
    sides = F.filter(F.array("_a", "_b"), lambda n: n > 0)
    return counts.where("_a <> _b").select("value", F.explode(sides).alias("num_rows"))


def _paired_counts(df: DataFrame, other: DataFrame, group_by: Sequence[str], names: tuple[str, str]) -> DataFrame:
    def counts(side: DataFrame, suffix: str, name: str) -> DataFrame:
        keys = [F.col(c).alias(f"{c}_{suffix}") for c in group_by]
        return side.groupBy(*keys, F.lit(1).alias(f"_one_{suffix}")).agg(F.count("*").alias(name))

    a, b = counts(df, "a", names[0]), counts(other, "b", names[1])
    # A plain equality: a NULL group never meets its like.
    meet = reduce(
        lambda x, y: x & y, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by], F.col("_one_a") == F.col("_one_b")
    )
    return a.join(b, meet, "full_outer").select(
        *[F.col(f"{c}_{s}") for c in group_by for s in "ab"], *names
    )


def check_equal_rowcount(df: DataFrame, other: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side with their difference; the failures are the sum of the differences."""
    both = _paired_counts(df, other, group_by, ("count_a", "count_b"))
    return both.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))


def check_fewer_rows_than(df: DataFrame, other: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Row counts side by side: the surplus when there are more rows, 1 when equal, else 0."""
    both = _paired_counts(df, other, group_by, ("count_our_model", "count_comparison_model"))
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return both.withColumn("row_count_delta", delta)


def check_equality(
    df: DataFrame,
    other: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    precision: int | None = None,
) -> DataFrame:
    """Distinct rows only one side has, with the side in ``which_diff``; compared by hash buckets first."""
    if columns and exclude:
        raise ValueError("give columns or exclude, not both")
    left_out = {c.lower() for c in exclude or ()}
    ours = [c for c in df.columns if c.lower() not in left_out]
    theirs = [c for c in other.columns if c.lower() not in left_out]
    if not columns and {c.lower() for c in ours} != {c.lower() for c in theirs}:
        raise ValueError(f"the relations differ in columns: {sorted(ours)} and {sorted(theirs)}")
    names = list(columns or ours)

    def cells(side: DataFrame) -> DataFrame:
        def cell(c: str) -> Column:
            if precision is not None and isinstance(side.schema[c].dataType, T.FractionalType):
                return F.round(F.col(c).cast("decimal(38,9)"), precision).alias(c)
            return F.col(c)

        return side.select(*[cell(c) for c in names])

    a, b = unequal_parts(cells(df), cells(other), names)
    both = a.withColumn("_ours", F.lit(True)).unionByName(b.withColumn("_ours", F.lit(False)))
    # One pass over what differs: a row that only one side has, whatever its number of copies.
    rows = both.groupBy(*names).agg(F.bool_or("_ours").alias("_a"), F.bool_or(~F.col("_ours")).alias("_b"))
    which = F.when(F.col("_a"), "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    return rows.where(F.col("_a") != F.col("_b")).select(which, *names)


def check_expression(df: DataFrame, expression: str, col: str | None = None) -> DataFrame:
    """Rows where the expression, or ``col`` followed by it, is false; NULL passes."""
    return df.where(~F.expr(expression if col is None else f"{col} {expression}"))


def check_ranges_exclusive(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length: bool = False,
    rows_per_slot: int = SLOT_ROWS,
) -> DataFrame:
    """Ranges that are empty, have a NULL bound, or do not end before the next one starts.

    Equal ranges are counted first, and distinct ones are ordered in slots of their bounds, so neither a large
    partition, a table without partitions nor a frequent bound goes to one task; the first lower bound of the next
    slot follows a slot's last range.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, got {gaps!r}")
    part = [F.col(partition_by).alias("partition_by_col")] if partition_by else []
    keys = ["partition_by_col"] if partition_by else []
    bounds = ["lower_bound", "upper_bound"]
    ranges = df.select(*part, F.col(lower).alias("lower_bound"), F.col(upper).alias("upper_bound"))
    # Every branch below needs the count, so that all read one shuffle of the distinct ranges.
    counted = ranges.groupBy(*keys, *bounds).agg(F.count("*").alias("_n")).where("_n > 0")
    rows = order_slots(counted, [*keys, *bounds], rows_per_slot, source=ranges)
    starts = rows.groupBy(*keys, "_slot").agg(F.min(F.struct(*bounds))["lower_bound"].alias("_first"))
    onward = Window.partitionBy(*keys).orderBy("_slot")
    following = starts.select(
        *[F.col(k).alias("_part") for k in keys], F.col("_slot").alias("_at"),
        F.lead("_first").over(onward).alias("_next_first"),
        F.lead("_slot").over(onward).isNull().alias("_last_slot"),
    )
    meet = F.col("_slot") == F.col("_at")
    if keys:
        meet = meet & F.col("partition_by_col").eqNullSafe(F.col("_part"))
    ordered = Window.partitionBy(*keys, "_slot").orderBy(*bounds)
    within = rows.select(
        *rows.columns,
        F.lead("lower_bound").over(ordered).alias("_lead"),
        F.lead(F.lit(1)).over(ordered).isNull().alias("_end"),
    )
    last_copies = within.join(following, meet).select(
        *keys, *bounds,
        F.when(F.col("_end"), F.col("_next_first")).otherwise(F.col("_lead")).alias("next_lower_bound"),
        (F.col("_end") & F.col("_last_slot")).alias("is_last_record"),
        F.lit(1).cast("bigint").alias("_n"),
    )
    # The other copies are followed by their like.
    copies = rows.where(F.col("_n") > 1).select(
        *keys, *bounds, F.col("lower_bound").alias("next_lower_bound"), F.lit(False).alias("is_last_record"),
        (F.col("_n") - 1).alias("_n"),
    )
    up, low, after = F.col("upper_bound"), F.col("lower_bound"), F.col("next_lower_bound")
    sound = F.coalesce(low <= up if zero_length else low < up, F.lit(False))
    spaced = F.coalesce(GAP_RULES[gaps](up, after), F.col("is_last_record"), F.lit(False))
    failing = (
        last_copies.unionByName(copies)
        .withColumn("bounds_in_order", sound)
        .withColumn("ends_before_next", spaced)
        .where(~(F.col("bounds_in_order") & F.col("ends_before_next")))
    )
    return expand_copies(failing, "_n")


def check_not_constant(df: DataFrame, col: str, group_by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group_by).agg(F.count_distinct(F.col(col)).alias("n_distinct")).where("n_distinct = 1")


def check_not_empty_string(df: DataFrame, col: str, trim: bool = True) -> DataFrame:
    text = F.trim(F.col(col)) if trim else F.col(col)
    return df.where(text == "").select(text.alias(col))


def check_not_null_proportion(
    df: DataFrame, col: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = F.count(col) / F.count("*")
    shares = df.groupBy(*group_by).agg(F.when(F.count("*") > 0, share).alias("not_null_proportion"))
    x = F.col("not_null_proportion")
    return shares.where((x < at_least) | (x > at_most))


def check_recency(
    df: DataFrame,
    field: str,
    part: str,
    n: int,
    as_of: Column | None = None,
    date_only: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups (or the table) whose newest value is older than ``n`` parts before ``as_of``."""
    now = F.current_timestamp() if as_of is None else as_of
    limit = F.timestamp_add(part.upper(), F.lit(-n), now.cast("timestamp"))
    newest = F.max(field)
    if date_only:
        newest, limit = newest.cast("date"), limit.cast("date")
    recent = df.groupBy(*group_by).agg(newest.alias("most_recent")).withColumn("threshold", limit)
    return recent.where(F.col("most_recent") < F.col("threshold"))


def check_sequential_values(
    df: DataFrame, col: str, interval: int = 1, part: str | None = None, group_by: Sequence[str] = (),
    rows_per_slot: int = SLOT_ROWS,
) -> DataFrame:
    """Rows that do not follow the previous value by ``interval`` (numbers, or date parts).

    Copies of a value are counted first, and distinct values are compared within slots that follow the order of
    group and value; only the first and last value of each slot meet those of its neighbours.
    """
    keys, previous = list(group_by), f"previous_{col}"
    known = df.where(F.col(col).isNotNull()).select(*keys, col)
    # Every branch below needs the count, so that all read one shuffle of the distinct values.
    values = known.groupBy(*keys, col).agg(F.count("*").alias("_n")).where("_n > 0")
    slotted = order_slots(values, [*keys, col], rows_per_slot, source=known)

    def follows(before: Column) -> Column:
        step = before + interval if part is None else F.timestamp_add(part.upper(), F.lit(interval), before)
        return F.col(col) == (step if part is None else step.cast(df.schema[col].dataType))

    within = Window.partitionBy(*keys, "_slot").orderBy(col)
    inside = slotted.select(*keys, col, F.lag(col).over(within).alias(previous))
    edges = slotted.groupBy(*keys, "_slot").agg(F.min(col).alias(col), F.max(col).alias("_last"))
    across = edges.select(
        *keys, col, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slot")).alias(previous)
    )
    first_copies = inside.unionByName(across).where(~follows(F.col(previous)))
    copies = values.where(F.col("_n") > 1).select(
        *keys, col, F.col(col).alias(previous), (F.col("_n") - 1).alias("_n")
    )
    return first_copies.unionByName(expand_copies(copies.where(~follows(F.col(previous))), "_n"))


def check_unique_combination(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")


def check_min_rows_per_group(df: DataFrame, by: str, n: int = DEFAULTS.min_players_per_season) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("row_count")).where(F.col("row_count") < n)


def check_fresh(
    df: DataFrame, ts: str, days: int = DEFAULTS.fresh_days, as_of: Column | None = None
) -> DataFrame:
    """One row when the newest load is missing or older than ``days``."""
    now = F.current_timestamp() if as_of is None else as_of
    limit = F.timestamp_add("DAY", F.lit(-days), now.cast("timestamp"))
    newest = df.agg(F.max(ts).alias("last_load"))
    return newest.where(F.col("last_load").isNull() | (F.col("last_load") < limit))


@dataclass(frozen=True)
class Freshness:
    table: str
    loaded_at: str
    warn_after_days: int | None = None
    error_after_days: int | None = None


def source_freshness(
    tables: Mapping[str, DataFrame], spec: Sequence[Freshness], as_of: Column | None = None
) -> DataFrame:
    """Newest load and pass, warn or error per table; a table without rows is an error."""
    now = (F.current_timestamp() if as_of is None else as_of).cast("timestamp")

    def state(s: Freshness) -> DataFrame:
        newest = tables[s.table].agg(F.max(s.loaded_at).cast("timestamp").alias("max_loaded_at"))
        status = F.when(F.col("max_loaded_at").isNull(), "error")
        for days, name in ((s.error_after_days, "error"), (s.warn_after_days, "warn")):
            if days is not None:
                status = status.when(F.col("max_loaded_at") < F.timestamp_add("DAY", F.lit(-days), now), name)
        return newest.select(F.lit(s.table).alias("table"), "max_loaded_at", status.otherwise("pass").alias("status"))

    return reduce(lambda a, b: a.unionByName(b), [state(s) for s in spec])


def check_columns_match(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Column names only the table or only the expected list has, in any case."""
    spark = df.sparkSession

    def listed(side: str, cols: Sequence[str]) -> DataFrame:
        return spark.createDataFrame([(c.lower(),) for c in cols], f"{side} string")

    actual, expected = listed("actual_column", df.columns), listed("expected_column", names)
    both = actual.join(expected, F.col("actual_column") == F.col("expected_column"), "full_outer")
    return both.where(F.col("actual_column").isNull() | F.col("expected_column").isNull())


def check_equal_columns(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b))


def sum_of(column: str) -> Column:
    """Failures as the sum of a column: for the row count checks."""
    return F.coalesce(F.sum(F.coalesce(F.col(column), F.lit(0))), F.lit(0))


def equality_failures() -> Column:
    """Failures of ``check_equality``: the rows, and by how much one side has more of them."""
    a = F.count_if(F.col("which_diff") == "a_minus_b")
    b = F.count_if(F.col("which_diff") == "b_minus_a")
    return F.count("*") + F.abs(a - b)


@dataclass(frozen=True)
class Groups:
    """A check of groups of rows that are equal in ``cols``: ``fails(key, n)`` is true for failing groups, from the struct of
    ``cols`` and the number of rows. With ``skip_null`` rows with a NULL in ``cols`` are in no group, else NULLs are equal."""

    cols: Sequence[str]
    fails: Callable[[Column, Column], Column] = lambda key, n: n > 1
    skip_null: bool = False


def unique_groups(col: str) -> Groups:
    """The failures of ``check_unique``."""
    return Groups((col,), skip_null=True)


def combination_groups(cols: Sequence[str]) -> Groups:
    """The failures of ``check_unique_combination``."""
    return Groups(tuple(cols))


def accepted_groups(col: str, values: Sequence[Any]) -> Groups:
    """The failures of ``check_accepted_values``."""
    return Groups((col,), lambda key, n: ~key[col].isin(list(values)))


def min_rows_groups(by: str, least: int = DEFAULTS.min_players_per_season) -> Groups:
    """The failures of ``check_min_rows_per_group``."""
    return Groups((by,), lambda key, n: n < least)


@dataclass(frozen=True)
class Check:
    """A check of a table: ``row``, true for failing rows, ``groups`` of rows, or ``failing``, which returns the failing rows.

    ``source`` may be a function, so that a failing read fails only the checks of that table.
    """

    name: str
    table: str
    source: DataFrame | Callable[[], DataFrame]
    failing: Callable[[DataFrame], DataFrame] | None = None
    where: str | None = None
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    failures: Column | None = field(default=None)
    warn_when_empty: bool = False
    row: Column | None = field(default=None)
    groups: Groups | None = None


# Grouping sets of one pass; further ones take another.
SETS = 32

# Names of the engine's errors that mean a table is absent or damaged.
READ_ERRORS = (
    "PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER",
    "FileNotFoundException",
)
REPORT = "check string, table string, failures bigint, status string"


def _status(c: Check, empty: Column) -> Column:
    status = F.when(empty, "warn") if c.warn_when_empty else F.when(F.lit(False), "")
    if c.severity == "error":
        status = status.when(F.expr(f"failures {c.error_if}"), "fail")
    return status.when(F.expr(f"failures {c.warn_if}"), "warn").otherwise("pass").alias("status")


def _row_checks(source: DataFrame, group: Sequence[Check]) -> DataFrame:
    """All row checks of a table in one aggregation."""
    counts = []
    for i, c in enumerate(group):
        bad = F.coalesce(c.row, F.lit(False))
        counts.append(F.count_if(bad & F.expr(c.where) if c.where else bad).alias(f"_f{i}"))
    return _listed(source.agg(F.count("*").alias("_rows"), *counts), group)


def _listed(totals: DataFrame, group: Sequence[Check]) -> DataFrame:
    """The report of checks whose failures are the columns ``_f0``, ``_f1``, ... of one row, beside the table's ``_rows``."""
    listed = [
        F.struct(F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), F.col(f"_f{i}").alias("failures"), F.lit(i).alias("_i"))
        for i, c in enumerate(group)
    ]
    rows = totals.select("_rows", F.inline(F.array(*listed)))
    empty = F.col("_rows") == 0
    status = F.coalesce(*[F.when(F.col("_i") == i, _status(c, empty)) for i, c in enumerate(group)])
    return rows.select("check", "table", "failures", status.alias("status"))


def _group_checks(source: DataFrame, group: Sequence[Check]) -> DataFrame:
    """All group checks of a table in one pass over it: a grouping set for each different key.

    A key is NULL where a check leaves a row out, so these rows are one group that is counted in the map tasks.
    """
    keys: dict[tuple, Column] = {}
    for c in group:
        cols = [F.col(k) for k in c.groups.cols]
        inside = [F.expr(c.where)] if c.where else []
        inside += [k.isNotNull() for k in cols] if c.groups.skip_null else []
        keys[_key_of(c)] = F.when(reduce(lambda a, b: a & b, inside, F.lit(True)), F.struct(*cols))
    names = {key: f"_k{i}" for i, key in enumerate(keys)}
    keyed = source.select(*[column.alias(names[key]) for key, column in keys.items()])
    sets = keyed.groupingSets([[n] for n in names.values()], *names.values())
    counted = sets.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n"))
    whole = (1 << len(names)) - 1  # the bit of each column that is not in the set, the first column's highest
    set_of = {key: F.lit(whole ^ (1 << (len(names) - 1 - i))).cast("bigint") for i, key in enumerate(names)}
    failures = []
    for i, c in enumerate(group):
        key = F.col(names[_key_of(c)])
        fails = key.isNotNull() & c.groups.fails(key, F.col("_n"))
        failures.append(F.count_if((F.col("_set") == set_of[_key_of(c)]) & fails).alias(f"_f{i}"))
    rows = F.sum(F.when(F.col("_set") == next(iter(set_of.values())), F.col("_n")))
    return _listed(counted.agg(F.coalesce(rows, F.lit(0)).alias("_rows"), *failures), group)


def _key_of(c: Check) -> tuple:
    return (tuple(c.groups.cols), c.where, c.groups.skip_null)


def _one_check(source: DataFrame, c: Check) -> DataFrame:
    failing = c.failing(source.where(c.where) if c.where else source)
    counted = failing.agg((F.count("*") if c.failures is None else c.failures).cast("bigint").alias("failures"))
    empty = F.lit(False)
    if c.warn_when_empty:
        counted = counted.withColumn("_first", source.limit(1).agg(F.count("*").alias("n")).scalar())
        empty = F.col("_first") == 0
    return counted.select(F.lit(c.name).alias("check"), F.lit(c.table).alias("table"), "failures", _status(c, empty))


def _unreadable(spark: SparkSession, group: Sequence[Check]) -> DataFrame:
    return spark.createDataFrame([(c.name, c.table, None, "unreadable") for c in group], REPORT)


def _report(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    parts, grouped = [], {}
    for c in checks:
        grouped.setdefault(id(c.source), []).append(c)
    for group in grouped.values():
        try:
            source = group[0].source() if callable(group[0].source) else group[0].source
            of_rows = [c for c in group if c.row is not None]
            of_groups = [c for c in group if c.row is None and c.groups is not None]
            own = [_row_checks(source, of_rows)] if of_rows else []
            own += [_group_checks(source, of_groups[i : i + SETS]) for i in range(0, len(of_groups), SETS)]
            parts += own + [_one_check(source, c) for c in group if c.row is None and c.groups is None]
        except AnalysisException as e:
            if not _failed_read(e):
                raise
            parts.append(_unreadable(spark, group))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _failed_read(error: Exception) -> bool:
    """Whether a table's data could not be found or read; all other errors are not the table's."""
    return any(mark in str(error) for mark in READ_ERRORS)


def run_checks(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """(check, table, failures, status) of all checks, one row each.

    All row checks of a table share one pass over it, and all group checks another. The report is worked out as one query; if a table cannot be
    read, then or while running, each check runs alone and those of unreadable tables say so. Any other error, such as a
    check that names no column of its table or a lack of memory, is raised.
    """
    try:
        rows = [tuple(r) for r in _report(spark, checks).collect()]
    except (PySparkException, Py4JJavaError) as failure:
        if not _failed_read(failure):
            raise
        rows = []
        for c in checks:
            try:
                rows += [tuple(r) for r in _report(spark, [c]).collect()]
            except (PySparkException, Py4JJavaError) as e:
                if not _failed_read(e):
                    raise
                rows.append((c.name, c.table, None, "unreadable"))
    return spark.createDataFrame(rows, REPORT)
