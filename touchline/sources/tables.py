"""Table scans and writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.plans.skew import SLOT_LEVELS, order_slots


def scan_table(
    spark: SparkSession, root: str, name: str, limit: int | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A named table; with a known schema, no file is opened to find it out."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df if limit is None else df.limit(limit)


def rebuild_table(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def with_curve(df: DataFrame, cols: Sequence[str], rows_per_range: int, out: str = "_curve") -> DataFrame:
    """A Z-order key over ``cols``: the range numbers of the columns, interleaved bit by bit, the first column's highest."""
    names = [f"_range{i}" for i in range(len(cols))]
    bits = min(SLOT_LEVELS, 62 // len(cols))
    ranged = df
    for c, name in zip(cols, names, strict=True):
        ranged = order_slots(ranged, [c], rows_per_range, name, source=df, sample_by=df.columns)
    key = F.lit(0).cast("bigint")
    for place, name in enumerate(reversed(names)):
        for bit in range(bits):
            lone = F.shiftright(name, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key + F.shiftleft(lone, bit * len(cols) + place)
    return ranged.withColumn(out, key).drop(*names)


def write_mart(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    touched_only: bool = False,
    observation: Observation | None = None,
    curve_rows: int | None = None,
) -> None:
    """Write a mart, laid out by partition columns and sorted by clustering columns within files.

    Rebalancing brings a partition value's rows together without a sampling pass; a value with many
    rows is split by size over several tasks and files, and small ones share a task. With
    ``touched_only`` only the partitions that occur in ``df`` are replaced, else the whole table. An
    ``observation`` gets the number of ``rows`` as they are written, so nobody has to count them again.

    A sort by several columns is of use to filters on the first. With ``curve_rows`` the files follow a Z-order curve
    over all clustering columns instead: each is cut into ranges of about so many rows, and the bits of the range
    numbers are interleaved. A filter on any of the columns then skips files and row groups.
    """
    layout = [*partition_by, *cluster_by]
    if curve_rows and cluster_by:
        curved = with_curve(df, cluster_by, curve_rows)
        df = curved.repartitionByRange(*partition_by, "_curve").sortWithinPartitions(*partition_by, "_curve").drop("_curve")
    elif layout:
        together = [F.col(c) for c in partition_by or cluster_by]
        df = df.hint("rebalance", *together).sortWithinPartitions(*layout)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    mode = "dynamic" if touched_only else "static"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
