"""Slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import blank_to_null, clean
from touchline.plans.skew import first_rows
from touchline.sources.loads import committed_loads, drop_path, has_path
from touchline.sources.tables import write_mart

# A new snapshot version is made when one of these changes.
SNAPSHOT_CHECKED = ["market_value_eur", "position", "age", "nationality", "nationality_full"]


def snapshot_source(squad_values: DataFrame) -> DataFrame:
    """Newest row per key; the key is the id, or the lower-case name, with the season."""
    season = clean(F.coalesce(F.col("season").cast("string"), F.lit("")))
    who = F.coalesce(blank_to_null(F.col("player_id")), F.lower(blank_to_null(F.col("player"))))
    keyed = squad_values.withColumn("season", season).withColumn(
        "sk", F.concat(who, F.lit("|"), F.col("season"))
    )
    order = [F.col("scraped_at").desc(), F.col("player"), F.col("player_id")]
    newest = first_rows(keyed, ["sk"], order)
    return newest.select("sk", *[c for c in newest.columns if c != "sk"])


def snapshot_check(
    history: DataFrame | None,
    source: DataFrame,
    key: str = "sk",
    check_cols: Sequence[str] = SNAPSHOT_CHECKED,
    as_of: Column | None = None,
) -> DataFrame:
    """Type-2 snapshot: a change in ``check_cols`` closes the open version at ``as_of`` and opens a
    new one. Keys that are gone stay open."""
    as_of = F.current_timestamp() if as_of is None else as_of
    fresh = source.select(
        *source.columns,
        F.md5(F.concat_ws("|", F.col(key), as_of.cast("string"))).alias("scd_id"),
        as_of.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )
    if history is None:
        return fresh
    is_open = F.col("valid_to").isNull()
    cols = history.columns
    # One join of unique keys: each meeting leaves the old row, the new row, or the old one closed and the new.
    old = history.where(is_open).select(F.struct(*cols).alias("_old"), F.col(key).alias("_old_key"))
    new = fresh.select(F.struct(*cols).alias("_new"), F.col(key).alias("_new_key"))
    met = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    differs = reduce(or_, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_cols])
    closed = F.struct(
        *[(as_of.cast("timestamp") if c == "valid_to" else F.col(f"_old.{c}")).alias(c) for c in cols]
    )
    outcome = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(F.col("_new").isNull() | ~differs, F.array("_old"))
        .otherwise(F.array(closed, F.col("_new")))
    )
    return history.where(~is_open).unionByName(met.select(F.inline(outcome)))


def value_history_scd2(
    history: DataFrame | None, prev_squad: DataFrame, new_squad: DataFrame, today: Column
) -> DataFrame:
    """Value history after a squad load.

    A value is compared with the squad table before the load, not with the history. Rows without id
    or value are skipped and equal values change nothing. A changed value closes the current row of
    the player and season and adds one; a first value, or one that was NULL before, only adds.
    """
    order = [F.col("scraped_at").desc_nulls_last(), F.col("market_value_eur").desc_nulls_last(), F.col("player")]
    key = ["player_id", "season"]
    new = first_rows(
        new_squad.withColumn("player_id", clean(F.coalesce("player_id", F.lit("")))).where(
            (F.col("player_id") != "") & F.col("market_value_eur").isNotNull()
        ),
        key, order,
    )
    prev = first_rows(prev_squad, key, order).select(*key, F.col("market_value_eur").alias("_old"))
    moved = new.join(prev, key, "left").where(
        F.col("_old").isNull() | (F.col("_old") != F.col("market_value_eur"))
    )
    added = moved.select(
        "player_id",
        F.coalesce("player", F.lit("")).alias("player"),
        "season",
        F.col("market_value_eur").cast("bigint").alias("market_value_eur"),
        today.cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        today.cast("timestamp").alias("recorded_at"),
    )
    if history is None:
        return added
    closing = moved.where(F.col("_old").isNotNull()).select(*key, F.lit(True).alias("_close"))
    marked = history.join(closing, key, "left")
    ends = F.col("is_current") & F.col("_close").isNotNull()
    after = marked.select(
        "player_id", "player", "season", "market_value_eur", "valid_from",
        F.when(ends, today.cast("date")).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(ends, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        "recorded_at",
    )
    return after.unionByName(added)


class Versions:
    """A written type-2 history, open and closed versions apart, so that a load reads and writes open rows only.

    Load ``n`` is one write to ``load=n``: ``state=open`` has all versions open after it, ``state=closed/closed_on=...``
    those it closed, by closing date. The write counts once Spark has marked it as whole, so a load that breaks off
    leaves the history as it was, and the next load replaces its folder. Files of closed versions are never touched
    again; open versions are kept for the last two loads, so that readers of the one before can finish.

    A version without ``valid_to`` is open. ``schema`` is that of the rows. One load at a time may write.
    """

    LAYOUT = {"load": T.IntegerType(), "state": T.StringType(), "closed_on": T.DateType()}

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, cluster_by: Sequence[str] = ()):
        if taken := {f.name.lower() for f in schema} & set(self.LAYOUT):
            raise ValueError(f"columns of the layout: {sorted(taken)}")
        self.spark, self.path, self.schema, self.cluster_by = spark, path.rstrip("/"), schema, list(cluster_by)

    def load(self, step: Callable[[DataFrame | None], DataFrame]) -> DataFrame | None:
        """Apply ``step``, from the open versions (None at first) to those open after it and those it closed.

        Returns the open versions it was given, for a look at their plan. ``snapshot_check`` and ``value_history_scd2``
        are such steps, as both leave closed versions alone.
        """
        done = committed_loads(self.spark, self.path)
        before = self._open(done[-1]) if done else None
        found = step(before)
        closed = F.col("valid_to").isNotNull()
        placed = found.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema],
            F.when(closed, "closed").otherwise("open").alias("state"), F.to_date("valid_to").alias("closed_on"),
        )
        number = done[-1] + 1 if done else 0
        write_mart(placed, f"{self.path}/load={number}", ["state", "closed_on"], self.cluster_by)
        for old in done[:-1]:
            drop_path(self.spark, f"{self.path}/load={old}/state=open")
        return before

    def read(self) -> DataFrame:
        """All versions, open and closed."""
        return self._rows(F.lit(True))

    def current(self) -> DataFrame:
        return self._open(max(committed_loads(self.spark, self.path), default=-1))

    def as_of(self, at: Column) -> DataFrame:
        """The versions that held at a time: open ones, and of the closed ones only the files from that day on are read."""
        lasting = (F.col("state") == "open") | (F.col("closed_on") >= F.to_date(at))
        return self._rows(lasting & (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))

    def _open(self, load: int) -> DataFrame:
        """The open versions after a load, without a look at any other folder."""
        folder = f"{self.path}/load={load}/state=open"
        if not has_path(self.spark, folder):
            return self._nothing()
        return self.spark.read.schema(self.schema).parquet(folder).select(*[f.name for f in self.schema])

    def _rows(self, where: Column) -> DataFrame:
        done = committed_loads(self.spark, self.path)
        if not done:
            return self._nothing()
        whole = T.StructType([*self.schema, *[T.StructField(c, t) for c, t in self.LAYOUT.items()]])
        rows = self.spark.read.schema(whole).parquet(self.path)
        kept = F.when(F.col("state") == "open", F.col("load") == done[-1]).otherwise(F.col("load") <= done[-1])
        return rows.where(kept).where(where).select(*[f.name for f in self.schema])

    def _nothing(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)
