"""The incremental load as a stream: files that arrive are upserted, each batch once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.sources.loads import upsert_path


def arriving(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def upsert_stream(
    stream: DataFrame,
    table_path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: str = "season",
    cluster_by: Sequence[str] = (),
    order_by: Sequence[Column] | None = None,
) -> StreamingQuery:
    """Upsert what has arrived since the last run, then stop.

    A batch that is repeated after a failure merges to the same table, so each key ends up once: what the failed load
    had staged is swapped in first (``loads.complete_upsert``).
    """

    def load(batch: DataFrame, _: int) -> None:
        upsert_path(batch.sparkSession, table_path, batch, keys, partition_by, cluster_by, order_by)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
