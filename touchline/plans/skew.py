"""Ways to work on a group that may hold a large share of all rows without giving it to one task."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group that meet in one task when pairs are built; larger groups are cut into cells.
CELL_ROWS = 2000
COPIES_PER_CHUNK = 100_000
# Rows of a slot, on average. Cut points are a sorted array in the plan: one per so many rows.
SLOT_ROWS = 4_000_000
# Halvings of a search among the cut points. More rows than these allow for make the last slot larger, no row wrong.
SLOT_LEVELS = 16


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key. Spark limits each group in every map task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def order_slots(
    df: DataFrame, cols: Sequence[str], rows_per_slot: int = SLOT_ROWS, out: str = "_slot", source: DataFrame | None = None,
    sample_by: Sequence[str] | None = None,
) -> DataFrame:
    """Number rows by ranges of ``cols``, so that slots follow their order (NULLs first) and number with the rows.

    Cut points are the keys of a sample: those of the rows of ``source`` (``df`` by default; it may be the table that
    ``df`` was counted from) whose hash is divisible by ``rows_per_slot``: the hash of the whole row, with a ``source``
    of the key, or of the columns in ``sample_by``. The sample depends on the data alone, so
    every part of a plan that asks for slots gets the same ones, also when a lost task runs again, and any cut points
    give slots in the right order. They are a scalar subquery: nothing runs while the plan is built, and a row finds
    its slot by bisection. Rows that are equal in ``cols`` share a slot: count them first where they may be many.
    """
    given = df if source is None else source
    key = F.struct(*cols)
    hashed = sample_by or (given.columns if source is None else cols)
    chosen = given.where(F.pmod(F.xxhash64(*hashed), F.lit(rows_per_slot)) == 0)
    cuts = chosen.agg(F.sort_array(F.collect_set(key)).alias("keys")).scalar()
    # One column per halving: generated code that reads the array in place. Beyond the array, get() gives NULL.
    steps, place = [], F.lit(0)
    for level in reversed(range(SLOT_LEVELS)):
        there = place + (1 << level)
        steps.append(F.when(F.get("_cuts", there - 1) <= F.col("_key"), there).otherwise(place).alias(f"_step{level}"))
        place = F.col(f"_step{level}")
    slotted = df.withColumns({"_cuts": cuts, "_key": key}).select("*", *steps)
    # An array of one, unpacked: what follows a join key down the plan (runtime filters) stops here, where it would
    # write the columns into each other and double the expression at every level.
    return slotted.select(*[F.col(c) for c in df.columns], F.explode(F.array("_step0")).alias(out))


def expand_copies(df: DataFrame, count_col: str) -> DataFrame:
    """Repeat each row ``count_col`` times; a large count is spread over tasks in chunks."""
    step = COPIES_PER_CHUNK
    chunks = (
        df.where(F.col(count_col) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col(count_col) - 1) / step))))
        .withColumn("_left", F.least(F.lit(step).cast("bigint"), F.col(count_col) - F.col("_chunk") * step))
    )
    spread = chunks.repartition(F.col("_chunk"), F.rand(7))
    return spread.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_left")))).drop(
        "_chunk", "_left", "_i", count_col
    )


def pairs_within(
    df: DataFrame, group: Sequence[str], key: str, payload: Sequence[str], cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Each unordered pair of rows of a group once, as ``*_a`` and ``*_b`` with ``key_a < key_b``.

    A group above ``cell_rows`` is cut into blocks by key hash, and each pair of blocks is a cell of
    its own, so a task never holds more than two blocks. Groups below it are not replicated.
    """
    sizes = df.groupBy(*group).agg(F.ceil(F.count("*") / cell_rows).alias("_blocks"))
    rows = df.join(sizes, list(group)).withColumn("_blk", F.pmod(F.xxhash64(key), F.col("_blocks")))
    cells = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        *group,
        F.least("_blk", "_other").alias("_lo"),
        F.greatest("_blk", "_other").alias("_hi"),
        "_blk", key, *payload,
    )
    cell = [*group, "_lo", "_hi"]
    own = ["_blk", key, *payload]
    a = cells.select(*cell, *[F.col(c).alias(f"{c}_a") for c in own])
    b = cells.select(*cell, *[F.col(c).alias(f"{c}_b") for c in own])
    meet = (
        (F.col(f"{key}_a") < F.col(f"{key}_b"))
        & (F.col("_lo") == F.least("_blk_a", "_blk_b"))
        & (F.col("_hi") == F.greatest("_blk_a", "_blk_b"))
    )
    return a.join(b, cell).where(meet).drop("_lo", "_hi", "_blk_a", "_blk_b")
