"""The mart pipeline: what each table is built from. Tables stay lazy until they are written."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from touchline.operators import graph, marts, staging
from touchline.sources.tables import write_mart


@dataclass(frozen=True)
class Step:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    written: bool = True


def _one_move_per_key(transfers: DataFrame, players: DataFrame) -> DataFrame:
    """Transfers with one row per player, club and season, the key that the written table has."""
    return graph.edge_transferred_to(transfers, players, latest_by=graph.largest_fee_first())


STEPS: dict[str, Step] = {
    "stg_matches": Step(staging.stg_matches, ("raw_matches",), written=False),
    "stg_player_stats": Step(staging.stg_player_stats, ("raw_player_stats",), written=False),
    "match_results": Step(marts.match_results, ("stg_matches",), ("season",), ("date", "game_id")),
    "season_summary": Step(marts.season_summary, ("stg_matches",), (), ("season",)),
    "player_performance": Step(marts.player_performance, ("stg_player_stats",), ("season",), ("player",)),
    "squad_value": Step(marts.squad_value, ("squad_values",), (), ("season",)),
    "transfer_balance": Step(marts.transfer_balance, ("transfers",), (), ("season",)),
    "player_values": Step(marts.player_values, ("squad_values", "player_performance"), ("season",), ("player",)),
    "graph_players": Step(graph.graph_players, ("player_performance", "squad_values"), (), ("player_id",)),
    "graph_seasons": Step(graph.graph_seasons, ("season_summary",), (), ("season_id",)),
    "graph_clubs": Step(graph.graph_clubs, ("transfers",), (), ("club_id",)),
    "edge_played_in": Step(graph.edge_played_in, ("player_performance", "graph_players"), (), ("player_id",)),
    "edge_played_with": Step(graph.edge_played_with, ("player_performance", "graph_players"), (), ("player_id_a",)),
    "edge_transferred_to": Step(_one_move_per_key, ("transfers", "graph_players"), (), ("player_id",)),
}


def build(inputs: Mapping[str, DataFrame], steps: Mapping[str, Step] = STEPS) -> dict[str, DataFrame]:
    """Every table as a lazy DataFrame over the raw inputs."""
    tables = dict(inputs)
    for name, step in steps.items():
        tables[name] = step.build(*[tables[i] for i in step.inputs])
    return tables


def write_all(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    root: str,
    steps: Mapping[str, Step] = STEPS,
) -> dict[str, DataFrame]:
    """Write the marts in order; a later table reads the written one, not its plan."""
    tables = dict(inputs)
    for name, step in steps.items():
        tables[name] = step.build(*[tables[i] for i in step.inputs])
        if step.written:
            path = f"{root.rstrip('/')}/{name}"
            schema = tables[name].schema
            write_mart(tables[name], path, step.partition_by, step.cluster_by)
            tables[name] = spark.read.schema(schema).parquet(path)
    return tables
