"""Load steps: type coercion, partition replacement, upserts, the season ledger and the run log."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import blank_to_null, safe_double
from touchline.plans.skew import first_rows
from touchline.sources.tables import rebuild_table, write_mart

def replace_partitions(target: DataFrame, batch: DataFrame, key: str = "season") -> DataFrame:
    """The target with every partition that occurs in the batch replaced by the batch's rows."""
    loaded = batch.select(key).distinct()
    kept = target.join(loaded, target[key].eqNullSafe(loaded[key]), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows of the target, updated from the source where keys match, and the source rows without a match.

    Two source rows with one key are an error, unless ``order_by`` says which one counts. NULL keys
    never match.
    """
    keys = list(keys)
    cols = target.columns
    updated = [c for c in (update_cols or cols) if c not in keys]
    missing = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in cols if c not in source.columns]
    rows = source.select(*[c for c in cols if c in source.columns], *missing).select(*cols)
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    keyed, unkeyed = rows.where(~has_null), rows.where(has_null)
    if order_by:
        single = first_rows(keyed, keys, order_by)
    else:
        others = [c for c in cols if c not in keys]
        message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys)))
        row = F.when(F.count("*") > 1, F.raise_error(message)).otherwise(F.first(F.struct(*others)))
        single = keyed.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*").select(*cols)
    new = single.select(*keys, F.struct(*updated).alias("_new"))
    met = target.join(new, keys, "left")
    hit = F.col("_new").isNotNull()
    merged = met.select(
        *[(F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)) for c in cols]
    )
    inserted = single.join(target.select(*keys).distinct(), keys, "left_anti").select(*cols)
    return merged.unionByName(inserted).unionByName(unkeyed)


def replace_by_id(target: DataFrame, batch: DataFrame, key: str = "player_id") -> DataFrame:
    """Replace all rows of the ids in the batch; rows with a blank id are not loaded."""
    filled = batch.where(blank_to_null(F.col(key)).isNotNull())
    kept = target.join(filled.select(key).distinct(), key, "left_anti")
    return kept.select(*target.columns).unionByName(filled.select(*target.columns))


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed NULLs; other columns stay."""
    have = {c.lower() for c in df.columns}
    added = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in have}
    return df.withColumns(added) if added else df


def coerce_numeric(df: DataFrame, numeric_cols: Sequence[str], date_cols: Sequence[str] = ()) -> DataFrame:
    """Text to numbers and dates; what does not parse becomes NULL."""
    numbers = {c: safe_double(F.trim(F.col(c).cast("string"))) for c in numeric_cols}
    dates = {c: F.try_to_timestamp(F.col(c).cast("string")).cast("date") for c in date_cols}
    return df.withColumns({**numbers, **dates})


def pending_partitions(requested: DataFrame, ledger: DataFrame, current: Column | str, force: bool = False) -> DataFrame:
    """Seasons still to load: those not marked complete, always the current one, all when forced."""
    if force:
        return requested
    done = ledger.where(F.col("is_complete") & (F.col("season") != F.lit(current))).select("season").distinct()
    return requested.join(done, "season", "left_anti")


def mark_partition_done(
    ledger: DataFrame, matches: DataFrame, players: DataFrame, current: Column | str, scraped_at: Column
) -> DataFrame:
    """The ledger with one row per loaded season: its counts, complete unless it is the current one."""
    tagged = matches.select("season", F.lit(1).alias("m"), F.lit(0).alias("p")).unionByName(
        players.select("season", F.lit(0).alias("m"), F.lit(1).alias("p"))
    )
    loaded = tagged.groupBy("season").agg(
        F.sum("m").alias("matches_count"), F.sum("p").alias("players_count")
    ).withColumns({"is_complete": F.col("season") != F.lit(current), "scraped_at": scraped_at})
    return merge_upsert(ledger, loaded, ["season"])


def run_log(events: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """One row per run from its start and finish events: 'running' until the last finish event tells.

    Events of other kinds do not matter. ``limits`` gives the longest texts to keep per column, for stores that
    bound them; without it texts stay whole.
    """
    limits = limits or {}
    starting, finishing = F.col("event") == "start", F.col("event") == "finish"
    started = F.min(F.when(starting, F.struct("at", "event_id", "pipeline", "season")))
    last = F.max(F.when(finishing, F.struct("at", "event_id", "status", "error_msg", "rows_written")))
    runs = events.groupBy("run_id").agg(started.alias("s"), last.alias("f")).where(F.col("s").isNotNull())

    def cut(c: Column, name: str) -> Column:
        return (F.substring(c, 1, limits[name]) if name in limits else c).alias(name)

    finished = F.col("f").isNotNull()
    empty = F.lit("")
    return runs.select(
        "run_id",
        cut(F.col("s.pipeline"), "pipeline"),
        cut(F.coalesce("s.season", empty), "season"),
        F.col("s.at").alias("started_at"),
        F.col("f.at").alias("finished_at"),
        F.col("f.rows_written").alias("rows_written"),
        cut(F.when(finished, F.coalesce("f.status", F.lit("success"))).otherwise("running"), "status"),
        cut(F.when(finished, F.coalesce("f.error_msg", empty)), "error_msg"),
    )


RUN_EVENTS = (
    "run_id string, event string, at timestamp, event_id bigint, pipeline string, season string, status string, "
    "error_msg string, rows_written bigint"
)


def write_logged(
    df: DataFrame, path: str, events_path: str, pipeline: str, season: str = "", partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (), touched_only: bool = False,
) -> str:
    """Write a mart and append its start and finish events to the run log; returns the run's id.

    The rows are counted by the write itself. A run that fails is recorded with the error's first line, and the error is
    raised; a run whose driver ends has a start event only, which ``run_log`` shows as running.
    """
    spark, run_id = df.sparkSession, uuid.uuid4().hex

    def tell(event: str, place: int, status: str | None = None, error: str | None = None, rows: int | None = None) -> None:
        row = (run_id, event, dt.datetime.now(dt.timezone.utc), place, pipeline, season, status, error, rows)
        spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.mode("append").parquet(events_path)

    tell("start", 0)
    seen = Observation()
    try:
        write_mart(df, path, partition_by, cluster_by, touched_only, seen)
    except Exception as e:
        tell("finish", 1, "error", str(e).strip().splitlines()[0] if str(e).strip() else type(e).__name__)
        raise
    tell("finish", 1, "success", rows=seen.get["rows"])
    return run_id


def _files(spark: SparkSession, path: str):
    """The file system of ``path`` and the path, as the session's storage client sees them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def committed_loads(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the folders ``load=n`` that a finished write has marked as whole, ascending."""
    fs, pattern = _files(spark, f"{path.rstrip('/')}/load=*/_SUCCESS")
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(pattern) or [])


def has_path(spark: SparkSession, path: str) -> bool:
    fs, place = _files(spark, path)
    return fs.exists(place)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder, if there is one."""
    fs, place = _files(spark, path)
    fs.delete(place, True)


def complete_upsert(spark: SparkSession, path: str, partition_by: str = "season", cluster_by: Sequence[str] = ()) -> int:
    """Finish the upserts of ``path`` that a crash interrupted; returns how many were redone.

    A load writes the merged partitions next to the table, and Spark marks that copy as whole (``_SUCCESS``) before
    the table is touched. A whole copy that is still there is swapped in once more, which gives the same partitions
    however far the first swap came; a copy without the mark belongs to a load that never touched the table.
    """
    folder = path.rstrip("/")
    fs, pattern = _files(spark, f"{folder}__merge_*")
    redone = 0
    for status in sorted(fs.globStatus(pattern) or [], key=lambda s: s.getModificationTime()):
        staging = status.getPath().toString()
        if fs.exists(_files(spark, f"{staging}/_SUCCESS")[1]):
            _swap(spark, staging, folder, partition_by, cluster_by)
            redone += 1
        fs.delete(status.getPath(), True)
    return redone


def _swap(spark: SparkSession, staging: str, path: str, partition_by: str, cluster_by: Sequence[str]) -> None:
    ready = spark.read.parquet(staging)
    if not ready.isEmpty():
        write_mart(ready, path, [partition_by], cluster_by, touched_only=True)


def upsert_path(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: str = "season",
    cluster_by: Sequence[str] = (),
    order_by: Sequence[Column] | None = None,
) -> None:
    """Upsert a batch into a partitioned table, reading and writing only the partitions it touches.

    The merged rows are written next to the table first, so the table is never read while it is overwritten and a lost
    executor only repeats its own tasks. If the job itself ends between that copy and the last swapped partition, the
    next load finds the copy and completes the swap before it reads the table (``complete_upsert``), so no row is lost
    and a repeated batch gives the same table. One load at a time may write a table.
    """
    complete_upsert(spark, path, partition_by, cluster_by)
    try:
        target = spark.read.schema(batch.schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        # The first load follows the same rules for repeated keys.
        target = batch.limit(0)
    else:
        if batch.isEmpty():
            return
        touched = batch.select(F.col(partition_by).alias("_touched")).distinct()
        target = target.join(touched, F.col(partition_by).eqNullSafe(F.col("_touched")), "left_semi")
    staging = f"{path.rstrip('/')}__merge_{uuid.uuid4().hex}"
    rebuild_table(merge_upsert(target, batch, keys, order_by=order_by), staging)
    ready = spark.read.schema(batch.schema).parquet(staging)
    write_mart(ready, path, [partition_by], cluster_by, touched_only=True)
    fs, place = _files(spark, staging)
    fs.delete(place, True)
