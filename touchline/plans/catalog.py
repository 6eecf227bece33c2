"""Every operator as a query over a folder of test tables: ``name → f(spark, sf_dir)``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import functions as fn
from touchline.operators import checks, graph, history, kpis, marts, names, networks, reads, relations, staging
from touchline.plans import pipeline
from touchline.sources import derived, loads, pages, schemas
from touchline.session import shared_root
from touchline.sources.tables import rebuild_table, scan_table, write_mart

SEASON = "9697"
AS_OF = dt.datetime(2024, 1, 31)
LOAD_DAY = dt.date(2024, 1, 31)
SEARCH_TERMS = ["Player 12", "player 7", "PLAYER 9", "yer 4", "layer 1", "Player 999999999"]

Query = Callable[[SparkSession, str], DataFrame]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a query that writes, in the shared folder of the session."""
    return f"{shared_root(spark)}/touchline-{name}-{uuid.uuid4().hex}"


class Season:
    """The derived tables, marts and graph of one folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return derived.given_table(self.spark, self.sf_dir, name)

    def fixture(self, name: str) -> DataFrame:
        return getattr(derived, name)(self.spark, self.sf_dir)

    @cached_property
    def raw_matches(self) -> DataFrame:
        return self.fixture("raw_matches")

    @cached_property
    def raw_stats(self) -> DataFrame:
        return self.fixture("raw_player_stats")

    @cached_property
    def squad(self) -> DataFrame:
        return self.fixture("squad_values")

    @cached_property
    def transfers(self) -> DataFrame:
        return self.fixture("transfers")

    @cached_property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw_matches)

    @cached_property
    def results(self) -> DataFrame:
        return marts.match_results(self.stg_matches)

    @cached_property
    def summary(self) -> DataFrame:
        return marts.season_summary(self.stg_matches)

    @cached_property
    def performance(self) -> DataFrame:
        return marts.player_performance(staging.stg_player_stats(self.raw_stats))

    @cached_property
    def league(self) -> DataFrame:
        """Performance of all clubs, with the club as the team."""
        return marts.player_performance(staging.stg_player_stats(self.raw_stats, None, "club"), keep=("team",))

    @cached_property
    def squad_value(self) -> DataFrame:
        return marts.squad_value(self.squad)

    @cached_property
    def balance(self) -> DataFrame:
        return marts.transfer_balance(self.transfers)

    @cached_property
    def player_values(self) -> DataFrame:
        return marts.player_values(self.squad, self.performance)

    @cached_property
    def players(self) -> DataFrame:
        return graph.graph_players(self.league, self.squad)

    @cached_property
    def clubs(self) -> DataFrame:
        return graph.graph_clubs(self.transfers)

    @cached_property
    def seasons(self) -> DataFrame:
        return graph.graph_seasons(self.summary)

    @cached_property
    def history(self) -> DataFrame:
        return history.value_history_scd2(
            None, self.squad.limit(0), self.squad, F.lit(dt.date(2024, 1, 1))
        )


class Network(Season):
    """The same, with the tables the graph is built on and its nodes and edges written once.

    A network query reads each of them several times; unwritten, every use would scan and group the
    line items again.
    """

    @cached_property
    def folder(self) -> str:
        return work_dir(self.spark, "graph")

    def written(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        rebuild_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def league(self) -> DataFrame:
        return self.written("performance", super().league)

    @cached_property
    def squad(self) -> DataFrame:
        return self.written("squad_values", super().squad)

    @cached_property
    def players(self) -> DataFrame:
        return self.written("players", super().players)

    @cached_property
    def clubs(self) -> DataFrame:
        """Few rows of a scan of all transfers: written, they are read by each join and broadcast by size."""
        return self.written("clubs", super().clubs)

    @cached_property
    def played_in(self) -> DataFrame:
        return graph.edge_played_in(self.league, self.players)

    @cached_property
    def played_with(self) -> DataFrame:
        edges = graph.edge_played_with(self.league, self.players, squad=("season", "team"))
        return self.written("played_with", edges)

    @cached_property
    def moved(self) -> DataFrame:
        return self.written("transferred_to", _transferred_to(self))

    @cached_property
    def graph(self) -> graph.PropertyGraph:
        return graph.property_graph(
            self.players, self.seasons, self.clubs, self.played_in, self.played_with, self.moved
        )

    def pattern(self, edge: str) -> graph.PropertyGraph:
        """The part of the graph that a pattern over one edge table names; nothing else is built or written."""
        players = {"Player": graph.Nodes(self.players, "player_id")}
        if edge == "PlayedWith":
            ends = graph.Edges(self.played_with, "player_id_a", "player_id_b", "Player", "Player")
            return graph.PropertyGraph(players, {edge: ends})
        ends = graph.Edges(self.moved, "player_id", "club_id", "Player", "Club")
        return graph.PropertyGraph(players | {"Club": graph.Nodes(self.clubs, "club_id")}, {edge: ends})

    def transfer_edges(self, ordered: bool = False) -> DataFrame:
        return networks.transfer_edges_all(self.moved, self.players, self.clubs, ordered)

    @cached_property
    def transfer_nodes(self) -> DataFrame:
        return networks.network_nodes(
            networks.transfer_nodes_all(self.moved, self.league, self.squad, self.players, ordered=False),
            networks.club_nodes(self.moved, self.clubs),
            networks.season_nodes(self.seasons, ordered=False),
        )

    @cached_property
    def written_edges(self) -> DataFrame:
        return self.written("edges", self.transfer_edges())

    def adjacency(self, edges: DataFrame) -> networks.Adjacency:
        return networks.Adjacency.written(edges, f"{self.folder}/adjacency", buckets=8)

    @cached_property
    def squad_nodes(self) -> DataFrame:
        return networks.squad_nodes_season(self.league, self.squad, self.players, SEASON)

    @cached_property
    def squad_edges(self) -> DataFrame:
        return networks.squad_edges_season(self.played_with, self.players, self.league, SEASON)


def _transferred_to(t: Season) -> DataFrame:
    return graph.edge_transferred_to(t.transfers, t.players, latest_by=graph.largest_fee_first())


def _on(kind: type[Season], build: Callable[[Season], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(kind(spark, sf_dir))


# -- sources and loads ----------------------------------------------------------------------------


def _replace_partitions(t: Season) -> DataFrame:
    batch = t.raw_matches.where("season >= '9899'").withColumn("gameweek", F.lit("99")).where("venue = 'Home'")
    return loads.replace_partitions(t.raw_matches, batch)


def _merge_upsert(t: Season) -> DataFrame:
    target = t.squad.where("season < '9900'").select("season", "player", "position", "market_value_eur")
    source = t.fixture("squad_values_new").select(
        "season", "player", F.lit("new").alias("position"), "market_value_eur"
    )
    return loads.merge_upsert(target, source, ["season", "player"], ["market_value_eur"])


def _replace_by_id(t: Season) -> DataFrame:
    cached = t.fixture("player_profiles").select("player_id", "player_name", "agent")
    number = F.col("player_id").cast("bigint")
    batch = cached.where(number % 2 == 0).select(
        F.when(number % 10 == 0, " ").otherwise(F.col("player_id")).alias("player_id"), "player_name",
        F.lit("renewed").alias("agent"),
    )
    return loads.replace_by_id(cached, batch)


def _rebuild_table(t: Season) -> DataFrame:
    path = work_dir(t.spark, "rebuild") + "/season_summary"
    rebuild_table(t.summary, path)
    return t.spark.read.schema(t.summary.schema).parquet(path)


def _write_mart(t: Season) -> DataFrame:
    path = work_dir(t.spark, "mart") + "/match_results"
    write_mart(t.results, path, ["season"], ["date", "game_id"])
    return t.spark.read.schema(t.results.schema).parquet(path)


def _write_curve(t: Season) -> DataFrame:
    """Line items laid out by supplier and part at once; the query reads a range of parts."""
    path = work_dir(t.spark, "curve") + "/lines"
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    write_mart(lines, path, cluster_by=["l_suppkey", "l_partkey"], curve_rows=1000)
    parts = t.table("part").agg((F.max("p_partkey") / 10).cast("bigint").alias("few")).scalar()
    return t.spark.read.schema(lines.schema).parquet(path).where(F.col("l_partkey") <= parts)


def _upsert_path(t: Season) -> DataFrame:
    path = work_dir(t.spark, "upsert") + "/squad_values"
    columns = ["season", "player", "age", "market_value_eur"]
    loads.upsert_path(t.spark, path, t.squad.select(*columns), ["season", "player"])
    batch = t.fixture("squad_values_new").where("season >= '9900'").select(*columns)
    loads.upsert_path(t.spark, path, batch, ["season", "player"], cluster_by=["player"])
    return t.spark.read.schema(batch.schema).parquet(path)


def _pending(t: Season) -> DataFrame:
    requested = t.raw_matches.select("season").distinct()
    return loads.pending_partitions(requested, t.fixture("season_ledger"), "9596")


def _mark_done(t: Season) -> DataFrame:
    ledger = t.fixture("season_ledger").where("season < '9900'").select(
        "season", F.lit(1).cast("bigint").alias("matches_count"), "players_count", "is_complete",
        F.lit(dt.datetime(2023, 1, 1)).cast("timestamp").alias("scraped_at"),
    )
    return loads.mark_partition_done(
        ledger, t.raw_matches.where("season >= '9798'"), t.raw_stats.where("season >= '9798'"), "0102",
        F.lit(AS_OF).cast("timestamp"),
    ).withColumn("scraped_at", F.col("scraped_at").cast("date"))


def _coerce(t: Season) -> DataFrame:
    rows = t.fixture("schedule").select("match_report", "date", "gf", "round", F.col("ga").alias("ga"))
    return loads.coerce_numeric(rows, ["gf", "ga", "round"], ["date"])


def _align(t: Season) -> DataFrame:
    return loads.align_schema(
        t.transfers.drop("l_orderkey", "l_linenumber"), schemas.TRANSFERS
    ).withColumn("scraped_at", F.col("scraped_at").cast("string"))


def _logged_writes(t: Season) -> DataFrame:
    """The log of three writes, one of which fails while it runs."""
    folder = work_dir(t.spark, "logged")
    events = f"{folder}/events"
    loads.write_logged(t.raw_matches, f"{folder}/matches", events, "matches", partition_by=["season"])
    loads.write_logged(t.squad, f"{folder}/squads", events, "squads", cluster_by=["player"])
    broken = t.squad.withColumn("age", F.raise_error(F.concat(F.lit("no age for "), F.col("player"))).cast("int"))
    try:
        loads.write_logged(broken, f"{folder}/broken", events, "broken")
    except (PySparkException, Py4JJavaError):
        pass
    log = loads.run_log(t.spark.read.schema(loads.RUN_EVENTS).parquet(events))
    return log.select("pipeline", "season", "rows_written", "status")


LOADS: dict[str, Callable[[Season], DataFrame]] = {
    "run_log_of_writes": _logged_writes,
    "scan_table": lambda t: scan_table(t.spark, t.sf_dir, "customer"),
    "replace_partitions": _replace_partitions,
    "merge_upsert": _merge_upsert,
    "replace_by_id": _replace_by_id,
    "rebuild_table": _rebuild_table,
    "write_mart": _write_mart,
    "write_mart_curve": _write_curve,
    "incremental_upsert": _upsert_path,
    "align_schema": _align,
    "coerce_numeric": _coerce,
    "pending_partitions": _pending,
    "mark_partition_done": _mark_done,
    "run_log": lambda t: loads.run_log(t.fixture("run_events")),
    "extract_html_table": lambda t: pages.extract_html_table(
        t.fixture("standard_stat_pages"), ["season", "squad_no"], "stats_standard"
    ).select("season", "squad_no", F.col("cells")["Player"].alias("player"),
             F.col("cells")["Playing Time_Min"].alias("minutes"), F.col("cells")["Performance_Gls"].alias("goals")),
    "extract_squad_rows": lambda t: pages.extract_squad_rows(t.fixture("squad_pages"), ["season"]),
    "extract_transfer_rows": lambda t: pages.extract_transfer_rows(
        t.fixture("transfer_pages"), ["season", "l_orderkey"]
    ).drop("transfer_date"),
    "extract_profile_rows": lambda t: pages.extract_profile_rows(t.fixture("profile_pages"), ["player_id"]),
}

# -- staging, marts, history ----------------------------------------------------------------------


def _build_player_rows(t: Season) -> DataFrame:
    rows = staging.build_player_rows(**derived.stat_pages(t.spark, t.sf_dir))
    return rows.select(
        "season", "player", "team", "stat_type", "minutes", "goals", "assists", "xg", "shots", "shots_on_tgt",
        "tackles", "tackles_won", "interceptions", "fouls", "fouled", "offsides", "yellow_cards", "red_cards",
    )


def _name_key(t: Season) -> DataFrame:
    return t.squad.groupBy(fn.name_key(F.col("player")).alias("player_key")).agg(F.count("*").alias("n"))


def _snapshot(t: Season) -> DataFrame:
    first = history.snapshot_check(
        None, history.snapshot_source(t.squad), as_of=F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    )
    second = history.snapshot_check(
        first, history.snapshot_source(t.fixture("squad_values_new")), as_of=F.lit(AS_OF).cast("timestamp")
    )
    return second.select(
        "sk", "position", "age", "market_value_eur", "nationality",
        F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"),
    )


SNAPSHOT_COLUMNS = ["sk", "position", "age", "market_value_eur", "nationality"]


def _written_snapshot(t: Season) -> history.Versions:
    """The same two loads, written with open and closed versions apart."""
    first = history.snapshot_source(t.squad)
    days = [F.lit(day).cast("timestamp") for day in (dt.datetime(2024, 1, 1), AS_OF)]
    schema = history.snapshot_check(None, first, as_of=days[0]).schema
    kept = history.Versions(t.spark, work_dir(t.spark, "snapshot"), schema, ["sk"])
    for source, day in zip((first, history.snapshot_source(t.fixture("squad_values_new"))), days, strict=True):
        kept.load(lambda old, source=source, day=day: history.snapshot_check(old, source, as_of=day))
    return kept


def _snapshot_written(t: Season) -> DataFrame:
    days = [F.col(c).cast("date").alias(c) for c in ("valid_from", "valid_to")]
    return _written_snapshot(t).read().select(*SNAPSHOT_COLUMNS, *days)


def _snapshot_as_of(t: Season) -> DataFrame:
    return _written_snapshot(t).as_of(F.lit(dt.datetime(2024, 1, 15)).cast("timestamp")).select(*SNAPSHOT_COLUMNS)


def _value_history(t: Season) -> DataFrame:
    after = history.value_history_scd2(
        t.history, t.squad, t.fixture("squad_values_new"), F.lit(LOAD_DAY)
    )
    return after.drop("recorded_at")


STAGES: dict[str, Callable[[Season], DataFrame]] = {
    "build_match_rows": lambda t: staging.build_match_rows(t.fixture("schedule")),
    "build_player_rows": _build_player_rows,
    "stg_matches": lambda t: t.stg_matches,
    "stg_player_stats": lambda t: staging.stg_player_stats(t.raw_stats),
    "name_key": _name_key,
    "match_results": lambda t: t.results,
    "season_summary": lambda t: t.summary,
    "player_performance": lambda t: t.performance,
    "squad_value": lambda t: t.squad_value,
    "transfer_balance": lambda t: t.balance,
    "player_values": lambda t: t.player_values,
    "snapshot_source": lambda t: history.snapshot_source(t.squad).select(
        "sk", "season", "player", "position", "age", "market_value_eur"
    ),
    "snapshot_check": _snapshot,
    "snapshot_written": _snapshot_written,
    "snapshot_as_of": _snapshot_as_of,
    "value_history_scd2": _value_history,
}

# -- graph ----------------------------------------------------------------------------------------


def _search(t: Network, part: int) -> DataFrame:
    nodes, edges = t.written("nodes", t.transfer_nodes), t.written_edges
    return networks.search_subgraph(nodes, edges, player="player 7", season="99/00", adjacency=t.adjacency(edges))[part]


def _position(t: Network, part: int) -> DataFrame:
    return networks.filter_by_position(t.squad_nodes, t.squad_edges, "back")[part]


def _match_edges(t: Network) -> DataFrame:
    hops = graph.match_edges(t.pattern("TransferredTo"), "TransferredTo", where=F.col("a_position").startswith("Left"))
    return hops.select("a_name", "b_name", "season", "direction", "fee_eur")


def _teammates(t: Season) -> DataFrame:
    """All seasons loaded, two of them with rows that a later load corrects."""
    kept = graph.Teammates(t.spark, work_dir(t.spark, "teammates"))
    seasons = [r[0] for r in t.league.select("season").distinct().collect()]
    late = [s for s in sorted(seasons) if s >= "9798" and s < "9900"]
    early = t.league.where(~F.col("season").isin(late) | (F.col("minutes") > 100)).withColumn(
        "goals", F.when(F.col("season").isin(late), F.col("goals") + 1).otherwise(F.col("goals"))
    )
    kept.load(early, seasons)
    kept.load(t.league, late)
    return kept.edges(t.players)


TABLES: dict[str, Callable[[Season], DataFrame]] = {
    "edge_played_with_incremental": _teammates,
    "graph_players": lambda t: t.players,
    "graph_seasons": lambda t: t.seasons,
    "graph_clubs": lambda t: t.clubs,
    "edge_played_in": lambda t: graph.edge_played_in(t.league, t.players),
    "edge_played_with": lambda t: graph.edge_played_with(t.league, t.players, squad=("season", "team")),
    "edge_transferred_to": _transferred_to,
    "latest_nonempty_position": lambda t: networks.latest_nonempty_position(t.squad),
}

GRAPH: dict[str, Callable[[Network], DataFrame]] = {
    "property_graph": lambda t: graph.graph_problems(t.graph),
    "match_edges": _match_edges,
    "partnerships": lambda t: networks.partnerships(t.pattern("PlayedWith"), " PLAYER 6", 12),
    "squad_nodes_season": lambda t: t.squad_nodes,
    "squad_nodes_all": lambda t: networks.squad_nodes_all(t.league, t.squad, t.players),
    "squad_edges_season": lambda t: t.squad_edges,
    "squad_edges_all": lambda t: networks.squad_edges_all(t.played_with, t.players),
    "transfer_nodes_season": lambda t: networks.transfer_nodes_season(t.league, t.squad, t.players, SEASON),
    "transfer_nodes_all": lambda t: networks.transfer_nodes_all(t.moved, t.league, t.squad, t.players),
    "transfer_edges_season": lambda t: networks.transfer_edges_season(
        t.moved, t.players, t.clubs, t.league, SEASON
    ),
    "transfer_edges_all": lambda t: t.transfer_edges(ordered=True),
    "club_nodes": lambda t: networks.club_nodes(t.moved, t.clubs),
    "season_nodes": lambda t: networks.season_nodes(t.seasons),
    "network_nodes": lambda t: t.transfer_nodes,
    "seasons_player_nodes": lambda t: networks.seasons_player_nodes(t.played_in, t.league, t.squad, t.players),
    "seasons_edges": lambda t: networks.seasons_edges(t.played_in, t.players),
    "search_subgraph": lambda t: _search(t, 1),
    "search_subgraph_nodes": lambda t: _search(t, 0),
    "filter_by_position": lambda t: _position(t, 1),
    "filter_by_position_nodes": lambda t: _position(t, 0),
    "neighbours": lambda t: networks.neighbours(t.adjacency(t.transfer_edges()), "Player 6"),
    "unknown_position_count": lambda t: networks.unknown_position_count(t.squad_nodes),
}

# -- read queries and reports ---------------------------------------------------------------------


def _profile(t: Season) -> DataFrame:
    found = reads.resolve_player(t.squad, SEARCH_TERMS, SEASON)
    return reads.player_profile(found, t.fixture("player_profiles"))


def _many_terms(t: Season) -> DataFrame:
    """Search terms that grow with the profiles: whole names, the ends of names, numbers, and names nobody has."""
    number, name = F.col("player_id").cast("bigint"), F.col("player_name")
    text = (
        F.when(number % 4 == 0, F.upper(name)).when(number % 4 == 1, F.substring(name, 4, 20))
        .when(number % 4 == 2, F.col("player_id")).otherwise(F.concat(name, F.lit("%x")))
    )
    return t.fixture("player_profiles").select(text.alias("term"))


def _name_index(t: Season) -> names.NameIndex:
    return names.NameIndex.written(t.squad, work_dir(t.spark, "names"))


def _resolve_many(t: Season) -> DataFrame:
    found = names.resolve_players(t.squad, _many_terms(t), SEASON, _name_index(t))
    return found.select("term", "tier", "season_used", "player", "player_id", "market_value_eur")


READS: dict[str, Callable[[Season], DataFrame]] = {
    "matches_of_season": lambda t: reads.matches_of_season(t.results, SEASON),
    "summary_of_season": lambda t: reads.summary_of_season(t.summary, SEASON),
    "players_sorted": lambda t: reads.players_sorted(t.performance, SEASON, "shot_accuracy", "ASC"),
    "seasons_list": lambda t: reads.seasons_list(t.fixture("season_ledger"), "2024/25"),
    "squad_value_history": lambda t: reads.squad_value_history(t.squad_value),
    "balance_history": lambda t: reads.balance_history(t.balance),
    "transfer_history": lambda t: reads.transfer_history(t.transfers, SEASON, "in"),
    "player_values_by_season": lambda t: reads.player_values_by_season(t.player_values, SEASON),
    "resolve_player": lambda t: reads.resolve_player(t.squad, SEARCH_TERMS, SEASON).select(
        "term", "tier", "season_used", "player", "player_id", "market_value_eur"
    ),
    "resolve_players": _resolve_many,
    "name_suggestions": lambda t: names.first_names(_name_index(t), _many_terms(t), 3),
    "player_profile": _profile,
    "player_performance_history": lambda t: reads.player_performance_history(t.performance, [" player 7 ", "Player 8"]),
    "player_value_series": lambda t: reads.player_value_series(t.squad, ["Player 3", "Player 8"]),
    "player_transfer_series": lambda t: reads.player_transfer_series(t.transfers, ["Player 3", "PLAYER 8"]),
    "mv_history_points": lambda t: reads.mv_history_points(t.fixture("player_profiles")),
    "recent_matches": lambda t: reads.recent_matches(t.results, SEASON),
    "top_scorers": lambda t: reads.top_scorers(t.performance, SEASON),
}

REPORTS: dict[str, Callable[[Season], DataFrame]] = {
    "season_kpis": lambda t: kpis.season_kpis(t.stg_matches),
    "result_share": lambda t: kpis.result_share(t.summary),
    "form_strip": lambda t: kpis.form_strip(t.results),
    "top_goals": lambda t: kpis.top_goals(t.performance),
    "shooting_table": lambda t: kpis.shooting_table(t.performance),
    "venue_goals": lambda t: kpis.venue_goals(t.stg_matches),
    "match_goal_series": lambda t: kpis.match_goal_series(t.results),
    "top_offsides": lambda t: kpis.top_offsides(t.performance),
    "attack_totals": lambda t: kpis.attack_totals(t.performance),
    "top_tackles": lambda t: kpis.top_tackles(t.performance),
    "top_interceptions": lambda t: kpis.top_interceptions(t.performance),
    "clean_sheet_summary": lambda t: kpis.clean_sheet_summary(t.stg_matches),
    "discipline_rank": lambda t: kpis.discipline_rank(t.performance),
    "defence_totals": lambda t: kpis.defence_totals(t.performance, t.stg_matches),
    "career_summary": lambda t: kpis.career_summary(t.performance, t.squad),
    "value_share_of_peak": lambda t: kpis.value_share_of_peak(t.squad),
    "peak_squad_season": lambda t: kpis.peak_squad_season(t.squad_value, SEASON),
    "top_transfers": lambda t: kpis.top_transfers(t.transfers, "in"),
    "player_value_table": lambda t: kpis.player_value_table(t.player_values),
    "balance_window": lambda t: kpis.balance_window(t.balance, 5),
    "balance_window_newest": lambda t: kpis.balance_window(t.balance, 5, newest=True),
}

# -- column functions -----------------------------------------------------------------------------


def _codes_per_customer(t: Season, codes: Callable[[Column, Column], Column]) -> DataFrame:
    spans = t.table("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return spans.select("o_custkey", F.explode(codes(F.col("first"), F.col("last"))).alias("season"))


def _season_texts(t: Season) -> DataFrame:
    key, season = F.col("o_orderkey"), fn.season_of_date(F.col("o_orderdate"))
    year = F.year("o_orderdate").cast("string")
    following = F.lpad(((F.year("o_orderdate") + 1) % 100).cast("string"), 2, "0")
    text = (
        F.when(key % 5 == 0, F.concat(year, F.lit("/"), following))
        .when(key % 5 == 1, F.concat(year, F.lit(" - "), following))
        .when(key % 5 == 2, F.concat(F.lit(" "), season))
        .when(key % 5 == 3, F.concat(F.lit("20"), F.lpad((key % 100).cast("string"), 2, "0")))
        .otherwise("season x")
    )
    return t.table("orders").select(key, text.alias("text"), season.alias("season"))


def _urls(t: Season, **columns: Column) -> DataFrame:
    return t.table("pages").select("page_id", *[c.alias(n) for n, c in columns.items()])


def _links(t: Season) -> DataFrame:
    key = F.col("p_partkey")
    ident = key.cast("string")
    href = (
        F.when(key % 5 == 0, F.concat(F.lit("https://site.example.com/a-b/profil/spieler/"), ident, F.lit("?x=/1")))
        .when(key % 5 == 1, F.concat(F.lit("/some-one/profil/spieler/"), ident))
        .when(key % 5 == 2, F.concat(F.lit("/profil/spieler/"), ident))
        .when(key % 5 == 3, F.concat(F.lit("/team/"), ident, F.lit("/")))
        .otherwise("single")
    )
    return t.table("part").select(key, href.alias("href"))


def _images(t: Season) -> DataFrame:
    key = F.col("p_partkey")
    ident = key.cast("string")
    url = F.concat(F.lit("/i/"), ident, F.lit(".jpg"))
    attrs = [
        F.when(key % 4 == 0, url),
        F.when(key % 4 == 1, F.concat(F.lit("//c.example.com/"), ident, F.lit(".png 1x, //c.example.com/b.png 2x"))),
        F.when(key % 4 == 2, "").otherwise("z.webp 1x"),
        F.lit("https://x.example.com/s.gif"),
    ]
    return t.table("part").select(key, fn.first_srcset_url(*attrs).alias("url"))


def _surrogate(t: Season) -> DataFrame:
    nullable = F.when(F.col("o_orderkey") % 4 == 0, None).otherwise(F.col("o_orderstatus"))
    cols = [F.col("o_custkey"), nullable, F.col("o_orderpriority")]
    return t.table("orders").select(
        "o_orderkey",
        fn.surrogate_key(*cols).alias("key"),
        fn.surrogate_key(*cols, nulls_as_empty=True).alias("key_empty"),
    )


def _safe_numbers(t: Season, **columns: Column) -> DataFrame:
    number = F.col("l_linenumber")
    lines = t.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"),
        F.when(number == 3, None).otherwise(number).cast("bigint").alias("a"),
        F.when(number == 5, None).otherwise(number % 2).cast("bigint").alias("b"),
    )
    return lines.select("l_orderkey", "l_linenumber", "q", *[c.alias(n) for n, c in columns.items()])


def _distance(t: Season) -> DataFrame:
    s = t.table("supplier")
    key = F.col("s_suppkey")
    lat, lon = (key % 90).cast("double"), (key % 180).cast("double")
    args = (lat, lon, F.lit(48.81), F.lit(2.06))
    return s.select(
        key,
        F.round(fn.haversine_distance(*args), 3).alias("miles"),
        F.round(fn.haversine_distance(*args, unit="km"), 3).alias("km"),
    )


def _scalars(t: Season) -> DataFrame:
    """The remaining scalar functions, over all orders."""
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    return t.table("orders").select(
        "o_orderkey",
        F.upper(F.left(F.col("o_orderpriority"), F.lit(3))).alias("prefix"),
        F.length("o_orderpriority").cast("bigint").alias("n"),
        F.col("o_orderpriority").like("%URGENT%").alias("urgent"),
        F.date_add(day, 30).alias("due"),
        F.datediff(F.lit(dt.date(2002, 1, 1)), day).cast("bigint").alias("age_days"),
        F.abs(F.round(price) - 200000).cast("bigint").alias("off"),
        F.least(F.ceil(price), F.lit(300000)).cast("bigint").alias("capped"),
        (F.col("o_orderkey") % 7).alias("rest"),
        F.get(F.split("o_orderpriority", "-"), 1).alias("word"),
    )


def _text_values(t: Season) -> DataFrame:
    return t.fixture("value_texts")


COLUMNS: dict[str, Callable[[Season], DataFrame]] = {
    "season_of_date": lambda t: t.table("orders").select(
        "o_orderkey", fn.season_of_date(F.col("o_orderdate")).alias("season")
    ),
    "season_series": lambda t: _codes_per_customer(t, lambda first, last: fn.season_codes(F.year(first), last)),
    "recent_seasons": lambda t: _codes_per_customer(t, lambda first, last: fn.recent_season_codes(last, 3)),
    "season_to_years": lambda t: _season_texts(t).select(
        "o_orderkey", fn.season_to_years(F.col("season")).alias("years"),
        fn.season_start_year(F.col("season")).alias("start_year"),
    ),
    "normalize_season": lambda t: _season_texts(t).select(
        "o_orderkey", fn.normalize_season(F.col("text")).alias("season")
    ),
    "season_label": lambda t: _season_texts(t).select("o_orderkey", fn.season_label(F.col("season")).alias("label")),
    "to_float": lambda t: _text_values(t).select(
        "p_partkey", fn.to_float(F.regexp_replace("fee_text", "000$", ",000 ")).alias("number")
    ),
    "parse_market_value": lambda t: _text_values(t).select(
        "p_partkey", fn.parse_market_value(F.col("fee_text")).alias("value_eur")
    ),
    "parse_fee": lambda t: _text_values(t).select("p_partkey", fn.parse_fee(F.col("fee_text")).alias("f")).select(
        "p_partkey", "f.*"
    ),
    "parse_age": lambda t: t.squad.select("season", "player", fn.parse_age(F.col("dob")).alias("age")),
    "profile_slug": lambda t: _links(t).select("p_partkey", fn.profile_slug(F.col("href")).alias("profile_slug")),
    "profile_id": lambda t: _links(t).select("p_partkey", fn.profile_id(F.col("href")).alias("profile_id")),
    "normalize_url": lambda t: t.squad.select("season", "player", fn.normalize_url(F.col("photo_url")).alias("url")),
    "portrait_url": lambda t: t.squad.select("season", "player", fn.portrait_url(F.col("player_id")).alias("url")),
    "first_srcset_url": _images,
    "get_url_host": lambda t: _urls(t, host=fn.get_url_host(F.col("url"))),
    "get_url_path": lambda t: _urls(t, path=fn.get_url_path(F.col("url"))),
    "get_url_parameter": lambda t: _urls(
        t, page=fn.get_url_parameter(F.col("url"), "page"), utm_source=fn.get_url_parameter(F.col("url"), "utm_source")
    ),
    "haversine_distance": _distance,
    "safe_add": lambda t: _safe_numbers(t, total=fn.safe_add(F.col("a"), F.col("b"), F.col("q"))),
    "safe_subtract": lambda t: _safe_numbers(t, rest=fn.safe_subtract(F.col("q"), F.col("a"), F.col("b"))),
    "safe_divide": lambda t: _safe_numbers(t, ratio=fn.safe_divide(F.col("q"), F.col("b"))),
    "width_bucket": lambda t: _safe_numbers(
        t, bucket=fn.width_bucket(F.col("q"), F.lit(10), F.lit(40), F.lit(6)).cast("bigint")
    ),
    "generate_surrogate_key": _surrogate,
    "slugify": lambda t: t.table("part").select(
        "p_partkey", fn.slugify(F.concat_ws(" - ", F.col("p_size").cast("string"), "p_name", "p_brand")).alias("slug")
    ),
    "goals_per_90": lambda t: staging.stg_player_stats(t.raw_stats).select(
        "season", "player", fn.goals_per_90(F.col("goals"), F.col("minutes")).alias("rate")
    ),
    "fingerprint_id": lambda t: t.squad.select("season", "player", fn.fingerprint_id(F.col("player")).alias("id")),
    "scalar_functions": _scalars,
}

# -- checks ---------------------------------------------------------------------------------------


def _by_nation(t: Season, name: str, column: str) -> DataFrame:
    key = F.col(column)
    return t.table(name).select(F.when(key == 3, None).otherwise(key).alias("nationkey"))


def _order_ranges(t: Season) -> DataFrame:
    key = F.col("o_orderkey")
    return t.table("orders").select(key.alias("low"), (key + F.col("o_custkey") % 3).alias("high"))


def _user_ranges(t: Season) -> DataFrame:
    key = F.col("event_id")
    return t.table("events").select(
        "user_id", F.when(key % 97 == 0, None).otherwise(key).alias("low"), (key + 150).alias("high")
    )


def _freshness(t: Season) -> DataFrame:
    tables = {"events": t.table("events"), "orders": t.table("orders"), "lineitem": t.table("lineitem")}
    spec = [
        checks.Freshness("events", "ts", 10, 20),
        checks.Freshness("orders", "o_orderdate", 14),
        checks.Freshness("lineitem", "l_shipdate", 10, 20),
    ]
    return checks.source_freshness(tables, spec, F.lit(dt.datetime(2024, 2, 15)).cast("timestamp")).select(
        "table", F.col("max_loaded_at").cast("date").alias("loaded_on"), "status"
    )


def contract(t: Season) -> list[checks.Check]:
    """The checks the marts are held to. The marts are written first, as several checks read each."""
    inputs = {"raw_matches": t.raw_matches, "raw_player_stats": t.raw_stats, "squad_values": t.squad,
              "transfers": t.transfers}
    marts_only = {n: s for n, s in pipeline.STEPS.items() if not n.startswith(("graph_", "edge_"))}
    m = pipeline.write_all(t.spark, inputs, work_dir(t.spark, "marts"), marts_only)
    perf, results, summary = m["player_performance"], m["match_results"], m["season_summary"]
    values = m["player_values"]

    def not_null(table: str, df: DataFrame, *cols: str) -> list[checks.Check]:
        return [checks.Check(f"not_null_{c}", table, df, row=F.col(c).isNull()) for c in cols]

    def in_range(table: str, df: DataFrame, col: str, top: int) -> checks.Check:
        return checks.Check(
            f"range_{col}", table, df, row=~F.col(col).between(0, top), severity="warn"
        )

    def one_per(table: str, df: DataFrame, *cols: str) -> checks.Check:
        return checks.Check("unique_rows", table, df, groups=checks.combination_groups(cols))

    return [
        *not_null("player_performance", perf, "season", "player", "goals", "assists", "minutes"),
        checks.Check(
            "known_player", "player_performance", perf,
            lambda d: checks.check_relationships(d, "player", t.raw_stats, "player"), severity="warn",
        ),
        in_range("player_performance", perf, "goals", 60),
        in_range("player_performance", perf, "assists", 40),
        in_range("player_performance", perf, "minutes", 4000),
        one_per("player_performance", perf, "season", "player"),
        checks.Check(
            "enough_players", "player_performance", perf, severity="warn", groups=checks.min_rows_groups("season")
        ),
        *not_null("match_results", results, "season", "game_id", "date"),
        one_per("match_results", results, "season", "date", "opponent", "venue_type"),
        *not_null("season_summary", summary, "season", "points"),
        checks.Check("unique_season", "season_summary", summary, groups=checks.unique_groups("season"),
                     warn_when_empty=True),
        in_range("season_summary", summary, "points", 120),
        checks.Check("unique_season", "squad_value", m["squad_value"], groups=checks.unique_groups("season"),
                     warn_when_empty=True),
        checks.Check("unique_season", "transfer_balance", m["transfer_balance"], groups=checks.unique_groups("season")),
        *not_null("player_values", values, "season", "player"),
        one_per("player_values", values, "season", "player"),
        checks.Check(
            "same_squads", "squad_values", t.squad,
            lambda d: checks.check_equality(d, t.fixture("squad_values_new"), ["season", "player", "market_value_eur"]),
            failures=checks.equality_failures(), error_if="> 1000000000000", warn_if="> 0",
        ),
        checks.Check(
            "columns", "orders", t.table("orders"),
            lambda d: checks.check_columns_match(d, ["O_ORDERKEY", "o_custkey", "o_total"]),
        ),
        checks.Check("readable", "no_such_table", lambda: t.table("no_such_table"), lambda d: d),
    ]


CHECKS: dict[str, Callable[[Season], DataFrame]] = {
    "check_not_null": lambda t: checks.check_not_null(t.raw_matches, "home_goals"),
    "check_unique": lambda t: checks.check_unique(t.table("orders"), "o_custkey"),
    "check_relationships": lambda t: checks.check_relationships(
        t.table("documents"), "doc_id", t.table("labels"), "doc_id"
    ),
    "check_relationships_where": lambda t: checks.check_relationships_where(
        t.table("lineitem"), "l_partkey", t.table("part"), "p_partkey", "l_quantity > 40", "p_size < 25"
    ),
    "check_accepted_values": lambda t: checks.check_accepted_values(t.table("orders"), "o_orderstatus", ["F", "O"]),
    "check_not_accepted_values": lambda t: checks.check_not_accepted_values(
        t.table("lineitem"), "l_returnflag", ["R", "X"]
    ),
    "check_accepted_range": lambda t: checks.check_accepted_range(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 2, 49
    ),
    "check_accepted_range_strict": lambda t: checks.check_accepted_range(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 2, inclusive=False
    ),
    "check_at_least_one": lambda t: checks.check_at_least_one(t.squad, "market_value_eur", ["player"]),
    "check_cardinality_equality": lambda t: checks.check_cardinality_equality(
        t.table("orders"), "o_custkey", t.table("customer"), "c_custkey"
    ),
    "check_equal_rowcount": lambda t: checks.check_equal_rowcount(
        _by_nation(t, "customer", "c_nationkey"), _by_nation(t, "supplier", "s_nationkey"), ["nationkey"]
    ),
    "check_fewer_rows_than": lambda t: checks.check_fewer_rows_than(
        _by_nation(t, "customer", "c_nationkey"), _by_nation(t, "supplier", "s_nationkey"), ["nationkey"]
    ),
    "check_equality": lambda t: checks.check_equality(
        t.squad, t.fixture("squad_values_new"), ["season", "player", "market_value_eur"]
    ),
    "check_equality_precision": lambda t: checks.check_equality(
        t.table("lineitem").select("l_suppkey", F.col("l_discount").alias("rate")),
        t.table("lineitem").select("l_suppkey", F.col("l_tax").alias("rate")), precision=2,
    ).select("which_diff", "l_suppkey", F.col("rate").cast("double").alias("rate")),
    "check_expression": lambda t: checks.check_expression(
        t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"),
        "l_quantity < 30 OR l_discount > 0.02",
    ),
    "check_ranges_exclusive": lambda t: checks.check_ranges_exclusive(_order_ranges(t), "low", "high"),
    "check_ranges_exclusive_grouped": lambda t: checks.check_ranges_exclusive(
        _user_ranges(t), "low", "high", "user_id", gaps="required", zero_length=True
    ),
    "check_not_constant": lambda t: checks.check_not_constant(t.table("lineitem"), "l_returnflag", ["l_orderkey"]),
    "check_not_empty_string": lambda t: checks.check_not_empty_string(t.squad, "position"),
    "check_not_null_proportion": lambda t: checks.check_not_null_proportion(
        t.raw_matches, "home_goals", 0.93, group_by=["season", "venue"]
    ),
    "check_recency": lambda t: checks.check_recency(
        t.table("events"), "ts", "hour", 20, F.lit(AS_OF), group_by=["user_id"]
    ).select("user_id", F.col("most_recent").cast("string").alias("most_recent")),
    "check_sequential_values": lambda t: checks.check_sequential_values(t.table("lineitem"), "l_orderkey"),
    "check_sequential_values_grouped": lambda t: checks.check_sequential_values(
        t.table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day")), "day", 1, "month",
        ["o_custkey"],
    ),
    "check_unique_combination": lambda t: checks.check_unique_combination(
        t.transfers, ["season", "player", "direction", "from_club"]
    ),
    "check_min_rows_per_group": lambda t: checks.check_min_rows_per_group(t.table("orders"), "o_custkey", 8),
    "check_fresh": lambda t: checks.check_fresh(t.table("events"), "ts", 10, F.lit(dt.datetime(2024, 3, 1))).select(
        F.col("last_load").cast("string").alias("last_load")
    ),
    "source_freshness": _freshness,
    "check_equal_columns": lambda t: checks.check_equal_columns(
        t.raw_matches.select("game_id", "home_goals", "away_goals"), "home_goals", "away_goals"
    ),
    "run_checks": lambda t: checks.run_checks(t.spark, contract(t)),
}

# -- relation generators --------------------------------------------------------------------------


def _order_span(t: Season) -> tuple[dt.date, dt.date]:
    row = t.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return row["a"].date(), row["b"].date()


def _customer_spans(t: Season) -> DataFrame:
    return t.table("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )


def _union_by_pattern(t: Season) -> DataFrame:
    e = t.table("events")
    for kind in ("click", "view", "purchase"):
        e.where(F.col("event_type") == kind).select("event_id", "user_id", F.col("value").alias(f"{kind}_value")) \
            .createOrReplaceTempView(f"evt_2024_{kind}")
    return relations.union_by_pattern(t.spark, "EVT%2024%", exclude="%view", source_col="source_relation")


def _contacts(t: Season) -> dict[str, DataFrame]:
    return {
        "customer": t.table("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
        ),
        "supplier": t.table("supplier").select(
            F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
        ),
    }


def _pivot(t: Season) -> DataFrame:
    priorities = relations.column_values(t.table("orders"), "o_orderpriority", [F.col("value")])
    return relations.pivot(
        t.table("orders"), ["o_orderstatus"], "o_orderpriority", priorities, prefix="n ", quote_identifiers=False
    )


RELATIONS: dict[str, Callable[[Season], DataFrame]] = {
    "deduplicate": lambda t: relations.deduplicate(
        t.table("lineitem").withColumn("l_returnflag", F.nullif(F.col("l_returnflag"), F.lit("N"))),
        ["l_suppkey", "l_returnflag"],
        [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")],
    ).select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"),
    "generate_series": lambda t: relations.generate_series(t.spark, t.table("customer").count()),
    "date_spine": lambda t: relations.date_spine(t.spark, "day", *_order_span(t)).select(
        F.col("date_day").cast("date").alias("date_day")
    ),
    "date_spine_per_row": lambda t: relations.date_spine_per_row(_customer_spans(t), "month", "first", "last").select(
        "o_custkey", F.col("date_month").cast("date").alias("date_month")
    ),
    "star": lambda t: (lambda df: df.select(*relations.star(df, ["P_SIZE", "p_type"], "x_", "_y")))(t.table("part")),
    "group_by_ordinals": lambda t: relations.group_by_ordinals(
        t.table("lineitem").select("l_returnflag", "l_linestatus", "l_quantity"), 2
    ).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")),
    "union_relations": lambda t: relations.union_relations(
        _contacts(t), override={"id": "string"}, where="balance > 0"
    ),
    "union_by_pattern": _union_by_pattern,
    "pivot": _pivot,
    "pivot_compare": lambda t: relations.pivot(
        t.table("lineitem"), ["l_returnflag"], "l_quantity", [10, 25, 40], cmp=">=", prefix="from_",
        agg="count", then_value=F.col("l_orderkey"), else_value=None, distinct=True,
    ),
    "unpivot": lambda t: relations.unpivot(
        t.table("nation").join(t.table("customer"), F.col("n_nationkey") == F.col("c_nationkey")).select(
            "c_custkey", "n_name", F.when(F.col("n_regionkey") == 0, None).otherwise(F.col("n_regionkey")).alias("region"),
            (F.col("c_acctbal") > 0).alias("in_credit"), "c_mktsegment", F.lit(1).alias("unused"),
        ),
        ["c_custkey"], ["UNUSED"], field_name="prop", value_name="val",
    ),
    "nullcheck_table": lambda t: relations.nullcheck_table(
        t.squad.select("season", "player", "player_id", "position", "height", "foot", "age")
    ),
    "column_values": lambda t: relations.column_values(
        t.table("lineitem"), "l_partkey", where="l_quantity > 25"
    ),
    "column_values_top": lambda t: relations.column_values(t.table("orders"), "o_custkey", max_records=7),
    "single_value": lambda t: t.table("orders").where(
        F.col("o_totalprice") > relations.single_value(t.table("customer").agg((F.max("c_acctbal") * 40).alias("v")))
    ).select(
        "o_orderkey",
        relations.single_value(t.table("supplier").where("s_acctbal < -100000000").select("s_name"), "nobody").alias("who"),
    ),
}

QUERIES: dict[str, Query] = {
    name: _on(kind, build)
    for kind, group in (
        (Season, LOADS), (Season, STAGES), (Season, TABLES), (Network, GRAPH), (Season, READS), (Season, REPORTS),
        (Season, COLUMNS), (Season, CHECKS), (Season, RELATIONS),
    )
    for name, build in group.items()
}
