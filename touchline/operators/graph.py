"""Graph of players, seasons and clubs: node tables, edge tables, one-hop patterns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.config import DEFAULTS
from touchline.functions import blank_to_null, clean, fingerprint_id, name_key, portrait_url, season_label
from touchline.plans.skew import first_rows, pairs_within
from touchline.sources.tables import write_mart


def graph_players(
    performance: DataFrame, squad_values: DataFrame, portrait_pattern: str = DEFAULTS.portrait_pattern
) -> DataFrame:
    """One node per player name, with id, nation, position and photo of the newest squad row."""
    named = performance.select(name_key(F.col("player")).alias("_key"), clean(F.col("player")).alias("name"))
    names = named.where(F.col("_key") != "").groupBy("_key").agg(F.min("name").alias("name"))
    optional = [c for c in ("nationality_full", "photo_url") if c not in squad_values.columns]
    squad = squad_values.withColumns({c: F.lit(None).cast("string") for c in optional}).select(
        name_key(F.col("player")).alias("_key"), "season", "player_id", "nationality", "nationality_full",
        "position", "photo_url",
    )
    newest = first_rows(
        squad, ["_key"], [F.col("season").desc(), F.col("player_id").desc_nulls_last(), F.col("position")]
    )
    ident = blank_to_null(F.col("player_id"))
    empty = F.lit("")
    return names.join(newest, "_key", "left").select(
        F.coalesce(ident, fingerprint_id(F.col("name"))).alias("player_id"),
        "name",
        F.coalesce("nationality", "nationality_full", empty).alias("nationality"),
        F.coalesce("position", empty).alias("position"),
        F.when(ident.isNotNull(), portrait_url(ident, portrait_pattern))
        .otherwise(F.coalesce("photo_url", empty)).alias("photo_url"),
    )


def graph_seasons(season_summary: DataFrame) -> DataFrame:
    return season_summary.select(
        F.col("season").alias("season_id"),
        season_label(F.col("season")).alias("label"),
        F.col("points").cast("bigint").alias("points"),
        F.col("wins").cast("bigint").alias("wins"),
        F.col("goals_scored").cast("bigint").alias("goals_for"),
    )


def graph_clubs(transfers: DataFrame) -> DataFrame:
    """One node per club name on either side of a transfer."""
    sides = transfers.select(F.explode(F.array("from_club", "to_club")).alias("club"))
    clubs = sides.groupBy("club").agg(F.count("*")).select(
        name_key(F.col("club")).alias("_key"), clean(F.col("club")).alias("name")
    )
    per_key = clubs.where(F.col("_key") != "").groupBy("_key").agg(F.min("name").alias("name"))
    return per_key.select(fingerprint_id(F.col("_key")).alias("club_id"), "name")


def _player_ids(players: DataFrame) -> DataFrame:
    return players.select("player_id", name_key(F.col("name")).alias("_key"))


def edge_played_in(performance: DataFrame, players: DataFrame) -> DataFrame:
    rows = performance.select(
        name_key(F.col("player")).alias("_key"), F.col("season").alias("season_id"),
        "goals", "assists", "minutes", "shots",
    )
    return rows.join(_player_ids(players), "_key").select(
        "player_id", "season_id", "goals", "assists", "minutes", "shots"
    )


def edge_played_with(
    performance: DataFrame, players: DataFrame, squad: tuple[str, ...] = ("season", "team")
) -> DataFrame:
    """Pairs of players who shared a squad, with the seasons shared and both players' goals in them.

    ``squad`` names the columns a squad is equal in; a table of one club may have no team. There is a row per pair by
    definition, so the result grows with the square of a squad's size, which the club keeps small. Rows are first
    reduced to one per squad and player.
    """
    squad = tuple(c for c in squad if c in performance.columns)
    member = [*squad, "player_id"]
    rows = performance.select(
        *squad, name_key(F.col("player")).alias("_key"), F.coalesce("goals", F.lit(0.0)).alias("goals")
    )
    members = (
        rows.join(_player_ids(players), "_key")
        .groupBy(*member, "_key")
        .agg(F.sum("goals").alias("goals"), F.count("*").alias("n"))
    )
    pairs = pairs_within(members, squad, "_key", ["player_id", "goals", "n"])
    goals = F.col("goals_a") * F.col("n_b") + F.col("goals_b") * F.col("n_a")
    return (
        pairs.groupBy("player_id_a", "player_id_b")
        .agg(F.sort_array(F.collect_set("season")).alias("_seasons"), F.sum(goals).alias("combined_goals"))
        .select(
            "player_id_a",
            "player_id_b",
            F.size("_seasons").cast("bigint").alias("shared_seasons"),
            "combined_goals",
            F.array_join("_seasons", ",").alias("seasons_list"),
        )
    )


class Teammates:
    """``edge_played_with`` kept up to date: one written row per pair of name keys and season, in a partition per season.

    A load recomputes the pairs of the seasons it touched from their rows alone and replaces their partitions; the
    edges are then summed over the written rows. Players' ids are joined last, so they may change between loads. Rows
    without a season share no squad.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def load(self, performance: DataFrame, seasons: Sequence[str], squad: tuple[str, ...] = ("season", "team")) -> DataFrame:
        """Recompute ``seasons`` from the table's present rows; returns the rows read, for a look at their plan."""
        rows = performance.where(F.col("season").isin(list(seasons)))
        squad = tuple(c for c in squad if c in performance.columns)
        members = rows.groupBy(*squad, name_key(F.col("player")).alias("_key")).agg(
            F.sum(F.coalesce("goals", F.lit(0.0))).alias("goals"), F.count("*").alias("n")
        )
        pairs = pairs_within(members, squad, "_key", ["goals", "n"])
        goals = F.col("goals_a") * F.col("n_b") + F.col("goals_b") * F.col("n_a")
        found = pairs.groupBy("season", "_key_a", "_key_b").agg(F.sum(goals).alias("goals"))
        # A row without a pair per season: it replaces the partition of a season that has no pairs any more.
        nothing = self.spark.createDataFrame([(s, None, None, None) for s in seasons], "season string, _key_a string, _key_b string, goals double")
        write_mart(found.unionByName(nothing), self.path, ["season"], ["_key_a"], touched_only=True)
        return rows

    def edges(self, players: DataFrame) -> DataFrame:
        parts = self.spark.read.schema("_key_a string, _key_b string, goals double, season string").parquet(self.path)
        sums = parts.where("_key_a is not null").groupBy("_key_a", "_key_b").agg(
            F.sort_array(F.collect_set("season")).alias("_seasons"), F.sum("goals").alias("combined_goals")
        )
        ids = _player_ids(players)
        a, b = (ids.select(F.col("_key").alias(f"_key_{x}"), F.col("player_id").alias(f"player_id_{x}")) for x in "ab")
        return sums.join(a, "_key_a").join(b, "_key_b").select(
            "player_id_a", "player_id_b", F.size("_seasons").cast("bigint").alias("shared_seasons"), "combined_goals",
            F.array_join("_seasons", ",").alias("seasons_list"),
        )


def largest_fee_first() -> list[Column]:
    return [F.col("fee_eur").desc_nulls_last(), F.col("fee_text"), F.col("direction")]


def edge_transferred_to(
    transfers: DataFrame, players: DataFrame, latest_by: list[Column] | None = None
) -> DataFrame:
    """Player to the club on the other side of the transfer.

    With ``latest_by`` only the first row in that order is kept per player, club and season, as an
    upsert on that key needs.
    """
    arriving = name_key(F.col("direction")) == "in"
    club = F.when(arriving, F.col("from_club")).otherwise(F.col("to_club"))
    rows = transfers.select(
        name_key(F.col("player")).alias("_key"), name_key(club).alias("_club"),
        "season", "direction", "fee_eur", "fee_text",
    ).where(F.col("_key") != "")
    if latest_by:
        # Before the join, so that only one row per key is shuffled to it.
        rows = first_rows(rows, ["_key", "_club", "season"], latest_by)
    return rows.join(_player_ids(players), "_key").select(
        "player_id", fingerprint_id(F.col("_club")).alias("club_id"), "season", "direction", "fee_eur", "fee_text"
    )


@dataclass(frozen=True)
class Nodes:
    df: DataFrame
    key: str


@dataclass(frozen=True)
class Edges:
    df: DataFrame
    src: str
    dst: str
    src_label: str
    dst_label: str
    more_keys: tuple[str, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.src, self.dst, *self.more_keys)


@dataclass(frozen=True)
class PropertyGraph:
    nodes: dict[str, Nodes] = field(default_factory=dict)
    edges: dict[str, Edges] = field(default_factory=dict)


def property_graph(
    players: DataFrame, seasons: DataFrame, clubs: DataFrame, played_in: DataFrame, played_with: DataFrame,
    transferred_to: DataFrame,
) -> PropertyGraph:
    return PropertyGraph(
        nodes={
            "Player": Nodes(players, "player_id"),
            "Season": Nodes(seasons, "season_id"),
            "Club": Nodes(clubs, "club_id"),
        },
        edges={
            "PlayedIn": Edges(played_in, "player_id", "season_id", "Player", "Season"),
            "PlayedWith": Edges(played_with, "player_id_a", "player_id_b", "Player", "Player"),
            "TransferredTo": Edges(transferred_to, "player_id", "club_id", "Player", "Club", ("season",)),
        },
    )


def graph_problems(graph: PropertyGraph) -> DataFrame:
    """Per node and edge table: rows, keys that occur more than once, edge ends without a node."""
    parts = []
    for label, n in graph.nodes.items():
        per_key = n.df.groupBy(n.key).agg(F.count("*").alias("n"))
        parts.append(
            per_key.agg(
                F.lit(label).alias("element"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count_if((F.col("n") > 1) | F.col(n.key).isNull()).alias("bad_keys"),
                F.lit(0).cast("bigint").alias("loose_ends"),
            )
        )
    for label, e in graph.edges.items():
        ends = e.df.select(
            F.inline(
                F.array(
                    F.struct(F.lit(e.src_label).alias("label"), F.col(e.src).alias("id")),
                    F.struct(F.lit(e.dst_label).alias("label"), F.col(e.dst).alias("id")),
                )
            )
        )
        known = None
        for end in dict.fromkeys([e.src_label, e.dst_label]):
            n = graph.nodes[end]
            ids = n.df.select(F.lit(end).alias("label"), F.col(n.key).alias("id"))
            known = ids if known is None else known.unionByName(ids)
        # Ends are counted per node before the join, so a node of many edges is one row in it.
        per_end = ends.groupBy("label", "id").agg(F.count("*").alias("n"))
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in e.keys])
        per_key = e.df.groupBy(*e.keys).agg(F.count("*").alias("n")).agg(F.count_if((F.col("n") > 1) | missing).alias("bad"))
        checked = per_end.join(known.withColumn("_known", F.lit(True)).distinct(), ["label", "id"], "left")
        parts.append(
            checked.agg(
                F.lit(label).alias("element"),
                F.coalesce((F.sum("n") / 2).cast("bigint"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("loose_ends"),
            ).select("element", "row_count", per_key.scalar().alias("bad_keys"), "loose_ends")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def match_edges(
    graph: PropertyGraph, edge: str, directed: bool = True, where: Column | None = None
) -> DataFrame:
    """Pattern ``(a)-[e]->(b)``, or ``(a)-[e]-(b)`` when not directed.

    Columns are the edge's properties and the node properties as ``a_*`` and ``b_*``. An undirected
    pattern runs over the edges and their reverse, which keeps the joins on equal keys.
    """
    e = graph.edges[edge]
    src, dst = graph.nodes[e.src_label], graph.nodes[e.dst_label]
    props = [c for c in e.df.columns if c not in (e.src, e.dst)]
    hops = e.df.select(F.col(e.src).alias(f"a_{src.key}"), F.col(e.dst).alias(f"b_{dst.key}"), *props)
    if not directed:
        if e.src_label != e.dst_label:
            raise ValueError("an undirected pattern needs both ends in one node table")
        hops = hops.select(
            F.inline(
                F.array(
                    F.struct(F.col(f"a_{src.key}"), F.col(f"b_{dst.key}"), *props),
                    F.struct(
                        F.col(f"b_{dst.key}").alias(f"a_{src.key}"), F.col(f"a_{src.key}").alias(f"b_{dst.key}"), *props
                    ),
                )
            )
        )
    a = src.df.select(*[F.col(c).alias(f"a_{c}") for c in src.df.columns])
    b = dst.df.select(*[F.col(c).alias(f"b_{c}") for c in dst.df.columns])
    matched = hops.join(a, f"a_{src.key}").join(b, f"b_{dst.key}")
    return matched if where is None else matched.where(where)
