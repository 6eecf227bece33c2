"""Networks on the graph: nodes and edges for drawing, partnerships, search."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import blank_to_null, name_key
from touchline.operators.graph import PropertyGraph, match_edges
from touchline.plans.skew import first_rows
from touchline.session import shared_root
from touchline.sources.tables import write_mart

NODE_COLUMNS = [
    "id", "label", "position", "nationality", "market_value", "photo_url", "goals", "assists", "minutes",
    "node_type",
]
# Patterns a position text is matched with, per class.
POSITION_PATTERNS = {
    "goalkeeper": r"goalkeeper|goal-keeper|keeper|torwart|tw| gk|gk\b",
    "back": r"back|defen[cs]e|defender|iv|cb|rb|lb|außenverteidiger|innverteidiger",
    "midfield": r"midfield|midfielder|zentral|mittelfeld|dm|cm|am|zm|defensive mid|central mid|attacking mid",
    "winger": r"winger|flügel|außen| wide|left w|right w|linksaußen|rechtsaußen",
    "forward": r"forward|striker|sturm|centre-forward|center-forward|centre forward|stürmer|attack",
}
MAX_PARTNERS = 50
# Folders of an adjacency: enough that one holds a small part of the edges.
ADJACENCY_BUCKETS = 64
DEFAULT_PARTNERS = 15


def latest_nonempty_position(squad_values: DataFrame) -> DataFrame:
    filled = squad_values.where(blank_to_null(F.col("position")).isNotNull()).select(
        name_key(F.col("player")).alias("player_key"), "position", "season"
    )
    newest = first_rows(filled, ["player_key"], [F.col("season").desc(), F.col("position")])
    return newest.select("player_key", "position")


def clamp_limit(limit: int | str | None) -> int:
    """A limit given by a caller, between 1 and 50; what is no number, or zero, means 15."""
    try:
        wanted = int(limit) or DEFAULT_PARTNERS
    except (TypeError, ValueError):
        wanted = DEFAULT_PARTNERS
    return min(MAX_PARTNERS, max(1, wanted))


def partnerships(graph: PropertyGraph, player: str, limit: int | str | None = DEFAULT_PARTNERS) -> DataFrame:
    """Teammates of a player, whichever end of the edge the player is on."""
    me = name_key(F.col("a_name")) == name_key(F.lit(player))
    hops = match_edges(graph, "PlayedWith", directed=False, where=me)
    return (
        hops.select(
            F.col("b_name").alias("partner_name"),
            F.col("b_position").alias("partner_position"),
            F.col("b_nationality").alias("partner_nationality"),
            "shared_seasons", "combined_goals", "seasons_list",
        )
        .orderBy(F.col("shared_seasons").desc(), F.col("combined_goals").desc(), "partner_name")
        .limit(clamp_limit(limit))
    )


def _career(performance: DataFrame) -> DataFrame:
    sums = [F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in ("goals", "assists", "minutes")]
    return performance.groupBy(name_key(F.col("player")).alias("player_key")).agg(*sums)


def _career_nodes(players: DataFrame, career: DataFrame, positions: DataFrame, how: str) -> DataFrame:
    """Player nodes with career sums, joined on the name key; ``how`` says if players without sums stay."""
    keyed = players.withColumn("player_key", name_key(F.col("name")))
    latest = positions.withColumnRenamed("position", "_latest")
    joined = keyed.join(career, "player_key", how).join(latest, "player_key", "left")
    number = (lambda c: F.col(c)) if how == "inner" else (lambda c: F.coalesce(F.col(c), F.lit(0.0)))
    return joined.select(
        F.col("name").alias("id"),
        F.col("name").alias("label"),
        F.coalesce(blank_to_null(F.col("position")), F.col("_latest"), F.lit("")).alias("position"),
        F.coalesce("nationality", F.lit("")).alias("nationality"),
        F.lit(0).cast("bigint").alias("market_value"),
        F.coalesce("photo_url", F.lit("")).alias("photo_url"),
        *[number(c).alias(c) for c in ("goals", "assists", "minutes")],
        F.lit("player").alias("node_type"),
    )


def _season_nodes_base(performance: DataFrame, squad_values: DataFrame, players: DataFrame, season: str) -> DataFrame:
    """Players of a season next to their squad row, graph node and newest known position."""
    p = performance.where(F.col("season") == season).select(
        name_key(F.col("player")).alias("player_key"), "player", "goals", "assists", "minutes"
    )
    v = squad_values.where(F.col("season") == season).select(
        name_key(F.col("player")).alias("player_key"),
        blank_to_null(F.col("position")).alias("v_position"),
        F.col("nationality").alias("v_nationality"),
        F.col("nationality_full").alias("v_nationality_full"),
        F.col("market_value_eur").alias("v_value"),
        F.col("photo_url").alias("v_photo"),
    )
    g = players.select(
        name_key(F.col("name")).alias("player_key"),
        blank_to_null(F.col("position")).alias("g_position"),
        F.col("nationality").alias("g_nationality"),
        F.col("photo_url").alias("g_photo"),
    )
    latest = latest_nonempty_position(squad_values).withColumnRenamed("position", "l_position")
    return reduce(lambda left, right: left.join(right, "player_key", "left"), [v, g, latest], p)


def _season_nodes(base: DataFrame, nationality: list[str], zero_stats: bool) -> DataFrame:
    def stat(name: str) -> Column:
        return (F.coalesce(F.col(name), F.lit(0.0)) if zero_stats else F.col(name)).alias(name)

    empty = F.lit("")
    return base.select(
        F.col("player").alias("id"),
        F.col("player").alias("label"),
        F.coalesce("v_position", "g_position", "l_position", empty).alias("position"),
        F.coalesce(*nationality, empty).alias("nationality"),
        F.coalesce("v_value", F.lit(0)).cast("bigint").alias("market_value"),
        F.coalesce("g_photo", "v_photo", empty).alias("photo_url"),
        stat("goals"), stat("assists"), stat("minutes"),
        F.lit("player").alias("node_type"),
    )


def squad_nodes_season(
    performance: DataFrame, squad_values: DataFrame, players: DataFrame, season: str
) -> DataFrame:
    base = _season_nodes_base(performance, squad_values, players, season)
    nodes = _season_nodes(base, ["v_nationality", "v_nationality_full"], zero_stats=False)
    return nodes.orderBy(F.col("minutes").desc_nulls_last(), "id")


def squad_nodes_all(performance: DataFrame, squad_values: DataFrame, players: DataFrame) -> DataFrame:
    nodes = _career_nodes(players, _career(performance), latest_nonempty_position(squad_values), "inner")
    return nodes.orderBy(F.col("minutes").desc(), "id")


def _teammate_edges(edges: DataFrame, players: DataFrame) -> DataFrame:
    a = players.select(F.col("player_id").alias("player_id_a"), F.col("name").alias("source"))
    b = players.select(F.col("player_id").alias("player_id_b"), F.col("name").alias("target"))
    return edges.join(a, "player_id_a").join(b, "player_id_b").select(
        "source",
        "target",
        F.col("shared_seasons").alias("weight"),
        "combined_goals",
        "seasons_list",
        F.lit("PLAYED_WITH").alias("edge_type"),
    )


def _by_weight(edges: DataFrame) -> DataFrame:
    return edges.orderBy(F.col("weight").desc(), F.col("combined_goals").desc(), "source", "target")


def squad_edges_season(
    edges: DataFrame, players: DataFrame, performance: DataFrame, season: str
) -> DataFrame:
    """Pairs who shared ``season`` with both players in that season's squad."""
    squad = performance.where(F.col("season") == season).select(name_key(F.col("player")).alias("_key"))
    in_season = F.array_contains(F.split(F.coalesce("seasons_list", F.lit("")), ","), season)
    nodes = players.withColumn("_key", name_key(F.col("name"))).join(squad, "_key", "left_semi")
    return _by_weight(_teammate_edges(edges.where(in_season), nodes))


def squad_edges_all(edges: DataFrame, players: DataFrame) -> DataFrame:
    return _by_weight(_teammate_edges(edges, players))


def transfer_nodes_season(
    performance: DataFrame, squad_values: DataFrame, players: DataFrame, season: str
) -> DataFrame:
    base = _season_nodes_base(performance, squad_values, players, season)
    return _season_nodes(base, ["v_nationality", "v_nationality_full", "g_nationality"], zero_stats=True)


def transfer_nodes_all(
    transferred_to: DataFrame, performance: DataFrame, squad_values: DataFrame, players: DataFrame, ordered: bool = True
) -> DataFrame:
    moved = players.join(transferred_to.select("player_id").distinct(), "player_id", "left_semi")
    nodes = _career_nodes(moved, _career(performance), latest_nonempty_position(squad_values), "left")
    return nodes.orderBy("id") if ordered else nodes


def _transfer_edges(transferred_to: DataFrame, players: DataFrame, clubs: DataFrame, ordered: bool) -> DataFrame:
    named = players.select("player_id", F.col("name").alias("source"))
    club = clubs.select("club_id", F.col("name").alias("target_label"))
    edges = transferred_to.join(named, "player_id").join(club, "club_id").select(
        "source",
        F.concat(F.lit("club:"), F.col("club_id")).alias("target"),
        "club_id",
        F.lit(1).cast("bigint").alias("weight"),
        "season", "direction", "fee_eur", "fee_text", "target_label",
        F.lit("TRANSFERRED_TO").alias("edge_type"),
    )
    return edges.orderBy(F.col("season").desc(), "source", "club_id", "direction") if ordered else edges


def transfer_edges_season(
    transferred_to: DataFrame, players: DataFrame, clubs: DataFrame, performance: DataFrame, season: str
) -> DataFrame:
    """Every transfer, of any season, of the players in the squad of ``season``."""
    squad = performance.where(F.col("season") == season).select(name_key(F.col("player")).alias("_key"))
    members = players.withColumn("_key", name_key(F.col("name"))).join(squad, "_key", "left_semi")
    return _transfer_edges(transferred_to, members, clubs, ordered=True)


def transfer_edges_all(
    transferred_to: DataFrame, players: DataFrame, clubs: DataFrame, ordered: bool = True
) -> DataFrame:
    """All transfers; without ``ordered`` for use inside other queries."""
    return _transfer_edges(transferred_to, players, clubs, ordered)


def club_nodes(edges: DataFrame, clubs: DataFrame) -> DataFrame:
    """Clubs an edge set ends in, padded to the node columns."""
    used = clubs.join(edges.select("club_id").distinct(), "club_id", "left_semi")
    nothing = F.lit(None).cast("double")
    return used.select(
        F.concat(F.lit("club:"), F.col("club_id")).alias("id"),
        F.col("name").alias("label"),
        F.lit("").alias("position"),
        F.lit("").alias("nationality"),
        F.lit(0).cast("bigint").alias("market_value"),
        F.lit("").alias("photo_url"),
        nothing.alias("goals"),
        nothing.alias("assists"),
        nothing.alias("minutes"),
        F.lit("club").alias("node_type"),
    )


def season_nodes(seasons: DataFrame, ordered: bool = True) -> DataFrame:
    def count_text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0)).cast("string")

    nothing = F.lit(None).cast("double")
    listed = seasons.orderBy(F.col("season_id").desc()) if ordered else seasons
    return listed.select(
        F.concat(F.lit("season:"), F.col("season_id")).alias("id"),
        "label",
        F.concat(F.lit("Pts "), count_text("points"), F.lit(" · W "), count_text("wins")).alias("position"),
        F.lit("").alias("nationality"),
        F.lit(0).cast("bigint").alias("market_value"),
        F.lit("").alias("photo_url"),
        F.col("goals_for").cast("double").alias("goals"),
        nothing.alias("assists"),
        nothing.alias("minutes"),
        F.lit("season").alias("node_type"),
    )


def seasons_player_nodes(
    played_in: DataFrame, performance: DataFrame, squad_values: DataFrame, players: DataFrame
) -> DataFrame:
    return transfer_nodes_all(played_in, performance, squad_values, players)


def seasons_edges(played_in: DataFrame, players: DataFrame) -> DataFrame:
    named = players.select("player_id", F.col("name").alias("source"))
    return played_in.join(named, "player_id").select(
        "source",
        F.concat(F.lit("season:"), F.col("season_id")).alias("target"),
        F.coalesce("minutes", F.lit(0.0)).alias("weight"),
        "goals", "assists", "minutes",
        F.lit("PLAYED_IN").alias("edge_type"),
    )


def network_nodes(*parts: DataFrame) -> DataFrame:
    """Nodes of several kinds in one table."""
    return reduce(lambda left, right: left.unionByName(right), [p.select(*NODE_COLUMNS) for p in parts])


def _induced(edges: DataFrame, ids: DataFrame) -> DataFrame:
    for end in ("source", "target"):
        edges = edges.join(ids.select(F.col("id").alias(end)), end, "left_semi")
    return edges


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("source").isNotNull() & F.col("target").isNotNull()).select(
        F.inline(
            F.array(
                F.struct(F.col("source").alias("id"), F.col("target").alias("other")),
                F.struct(F.col("target").alias("id"), F.col("source").alias("other")),
            )
        )
    )


class Adjacency:
    """Each pair of neighbours once in both directions, in files by bucket of ``id`` and sorted by ``id`` within.

    A search reads only the buckets of the nodes it has just reached, and in them the row groups that may hold these
    nodes. The pairs of a node with very many edges are split over files by size.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = ADJACENCY_BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    @classmethod
    def written(cls, edges: DataFrame, path: str, buckets: int = ADJACENCY_BUCKETS) -> Adjacency:
        out = cls(edges.sparkSession, path, buckets)
        pairs = _both_ways(edges).distinct()
        write_mart(pairs.withColumn("bucket", out.bucket(F.col("id"))), path, ["bucket"], ["id"])
        return out

    def bucket(self, node: Column) -> Column:
        return F.pmod(F.xxhash64(node.cast("string")), F.lit(self.buckets)).cast("int")

    def table(self) -> DataFrame:
        return self.spark.read.schema("id string, other string, bucket int").parquet(self.path)

    def of(self, node: str) -> DataFrame:
        """Neighbours of one node, by its bucket and its place in it."""
        own = F.lit(node)
        return self.table().where((F.col("bucket") == self.bucket(own)) & (F.col("id") == own)).select(F.col("other").alias("id"))

    def reach(self, start: DataFrame, hops: int, path: str) -> DataFrame:
        """Ids within ``hops`` edges of the ids of ``start``. Each hop follows only the nodes that the last one found.

        A hop writes the nodes it finds, so it starts from files, and ends when there are none. The driver sees the
        numbers of their buckets only.
        """
        def layer(hop: int) -> DataFrame:
            return self.spark.read.schema("id string, bucket int").parquet(f"{path}/hop={hop}")

        def write(ids: DataFrame, hop: int) -> None:
            found = ids.where("id is not null").distinct()
            found.withColumn("bucket", self.bucket(F.col("id"))).write.mode("overwrite").parquet(f"{path}/hop={hop}")

        write(start.select(F.col("id").cast("string")), 0)
        seen = layer(0)
        for hop in range(1, hops + 1):
            frontier = layer(hop - 1)
            used = [r[0] for r in frontier.select("bucket").distinct().collect()]
            if not used:
                break
            steps = self.table().where(F.col("bucket").isin(used)).join(frontier, ["bucket", "id"], "left_semi")
            reached = steps.select(F.col("other").alias("id")).distinct()
            write(reached.join(seen, "id", "left_anti"), hop)
            seen = seen.unionByName(layer(hop))
        return seen.select("id")


def search_subgraph(
    nodes: DataFrame, edges: DataFrame, player: str = "", club: str = "", season: str = "", hops: int = 1,
    adjacency: Adjacency | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Nodes found by a part of their name, everything within ``hops`` edges of them, and the edges between.

    Without a search text the network is returned as it is; a search that finds nothing gives nothing. The adjacency
    of the edges is written where none is given.
    """
    wanted = {"player": player, "club": club, "season": season}
    texts = {kind: text.strip().lower() for kind, text in wanted.items() if text and text.strip()}
    if not texts:
        return nodes, edges
    label = F.lower(F.coalesce(F.col("label"), F.lit("")))
    places = {
        "player": F.lower(F.coalesce(F.nullif(F.col("label"), F.lit("")), F.col("id"))),
        "club": label,
        "season": F.concat_ws("\n", F.lower("id"), label),
    }
    found = [(F.col("node_type") == kind) & places[kind].contains(text) for kind, text in texts.items()]
    start = nodes.where(reduce(lambda a, b: a | b, found)).select("id")
    folder = f"{shared_root(nodes.sparkSession)}/search-{uuid.uuid4().hex}"
    if adjacency is None:
        adjacency = Adjacency.written(edges, f"{folder}/adjacency")
    seen = adjacency.reach(start, hops, f"{folder}/seen")
    return nodes.join(seen, "id", "left_semi"), _induced(edges, seen)


def filter_by_position(nodes: DataFrame, edges: DataFrame, position_class: str) -> tuple[DataFrame, DataFrame]:
    """Player nodes of a position class, and the edges between them; 'all' keeps every player."""
    kept = nodes.where(F.col("node_type") == "player")
    pattern = POSITION_PATTERNS.get(position_class)
    if pattern is not None:
        position = F.lower(F.coalesce("position", F.lit("")))
        kept = kept.where(blank_to_null(position).isNotNull() & position.rlike(pattern))
    elif position_class != "all":
        kept = kept.where(blank_to_null(F.col("position")).isNotNull())
    return kept, _induced(edges, kept.select("id").distinct())


def neighbours(edges: DataFrame | Adjacency, node_id: str) -> DataFrame:
    """A node and the nodes it has an edge with; with an adjacency only that node's bucket is read."""
    if isinstance(edges, Adjacency):
        near = edges.of(node_id)
        spark = edges.spark
    else:
        near = _both_ways(edges).where(F.col("id") == node_id).select(F.col("other").alias("id"))
        spark = edges.sparkSession
    itself = spark.range(1).select(F.lit(node_id).alias("id"))
    return near.unionByName(itself).distinct()


def unknown_position_count(nodes: DataFrame) -> DataFrame:
    blank = blank_to_null(F.col("position")).isNull()
    return nodes.agg(F.count_if((F.col("node_type") == "player") & blank).alias("unknown_count"))
