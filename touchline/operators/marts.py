"""Season marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import safe_divide
from touchline.plans.skew import SLOT_ROWS, order_slots


def _points() -> Column:
    return F.when(F.col("result") == "W", 3).when(F.col("result") == "D", 1).otherwise(0)


def match_results(stg_matches: DataFrame, rows_per_slot: int = SLOT_ROWS) -> DataFrame:
    """Running points and match number per season.

    Matches of one date share the running points and are numbered by ``game_id``. A season or a date may hold any
    share of the rows, so neither is sorted as a whole. The rows are cut into slots that follow (season, date, id);
    what goes before a slot comes from a small table of one row per date and slot, and rows are numbered within
    theirs. The numbers are the same for any number of slots.
    """
    # One key that is never NULL, so that the joins and the window below share a partitioning.
    day = F.concat_ws("|", F.coalesce("season", F.lit("\0")), F.coalesce(F.col("date").cast("string"), F.lit("\0")))
    rows = stg_matches.select(
        "game_id", "season", "date", "gameweek", "opponent", "venue_type", "goals_for", "goals_against", "result"
    )
    by = ["game_id", "opponent", "venue_type"]
    slotted = order_slots(rows, ["season", "date", *by], rows_per_slot)
    up_to = Window.partitionBy("season").orderBy("date", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    whole_day = Window.partitionBy("season").orderBy("date").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    parts = slotted.groupBy("season", "date", "_slot").agg(F.sum(_points()).alias("_pts"), F.count("*").alias("_n"))
    totals = parts.select(
        day.alias("_day"), "_slot",
        F.sum("_pts").over(whole_day).alias("cumulative_points"),
        F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"),
    )
    place = Window.partitionBy("_day", "_slot").orderBy(*by)
    numbered = slotted.withColumn("_day", day).withColumn("_place", F.row_number().over(place))
    return numbered.join(totals, ["_day", "_slot"]).select(
        *rows.columns, "cumulative_points", (F.col("_before") + F.col("_place")).alias("match_number")
    )


def season_summary(stg_matches: DataFrame) -> DataFrame:
    won, drawn, lost = (F.col("result") == r for r in "WDL")
    scored, conceded = F.sum("goals_for"), F.sum("goals_against")
    return (
        stg_matches.where(F.col("result").isNotNull())
        .groupBy("season")
        .agg(
            F.count("*").alias("played"),
            F.count_if(won).alias("wins"),
            F.count_if(drawn).alias("draws"),
            F.count_if(lost).alias("losses"),
            F.coalesce(scored, F.lit(0)).alias("goals_scored"),
            F.coalesce(conceded, F.lit(0)).alias("goals_conceded"),
            (F.coalesce(scored, F.lit(0)) - F.coalesce(conceded, F.lit(0))).alias("goal_diff"),
            F.sum(_points()).alias("points"),
            F.round(F.avg("goals_for"), 2).alias("avg_goals_for"),
            F.round(F.avg("goals_against"), 2).alias("avg_goals_against"),
            F.count_if(won & (F.col("venue_type") == "home")).alias("home_wins"),
            F.count_if(won & (F.col("venue_type") == "away")).alias("away_wins"),
        )
    )


def player_performance(stg_player_stats: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Combined rows of players who played; ``keep`` adds staging columns such as the team."""
    played = (F.col("stat_type") == "combined") & (F.col("minutes") > 0)
    return stg_player_stats.where(played).select(
        "season",
        "player",
        *keep,
        "minutes",
        "goals",
        "assists",
        (F.coalesce("goals", F.lit(0.0)) + F.coalesce("assists", F.lit(0.0))).alias("goal_contributions"),
        "xg",
        "xag",
        "shots",
        "shots_on_tgt",
        safe_divide(F.col("shots_on_tgt"), F.col("shots")).alias("shot_accuracy"),
        "tackles",
        "interceptions",
        "fouls",
        "fouled",
        "offsides",
        "yellow_cards",
        "red_cards",
    )


def squad_value(squad_values: DataFrame) -> DataFrame:
    """Squad totals per season and the most valuable player; of equals the greatest name."""
    value = F.col("market_value_eur")
    top = F.max(F.struct(value, F.col("player")))
    return (
        squad_values.where(value.isNotNull())
        .groupBy("season")
        .agg(
            F.count("*").alias("squad_size"),
            F.round(F.avg("age"), 1).alias("avg_age"),
            F.sum(value).alias("total_value_eur"),
            F.round(F.avg(value), 0).alias("avg_value_eur"),
            F.max(value).alias("highest_value_eur"),
            top["player"].alias("highest_value_player"),
        )
    )


def transfer_balance(transfers: DataFrame) -> DataFrame:
    fee = F.col("fee_eur")
    arrival, departure = F.col("direction") == "in", F.col("direction") == "out"
    spent = F.coalesce(F.sum(F.when(arrival & (fee > 0), fee)), F.lit(0))
    received = F.coalesce(F.sum(F.when(departure & (fee > 0), fee)), F.lit(0))
    signing = F.max(F.when(arrival & fee.isNotNull(), F.struct(fee, F.col("player"))))
    return transfers.groupBy("season").agg(
        spent.alias("spent_eur"),
        received.alias("received_eur"),
        (spent - received).alias("net_spend_eur"),
        F.count_if(arrival).alias("arrivals"),
        F.count_if(departure).alias("departures"),
        F.max(F.when(arrival, fee)).alias("biggest_buy_eur"),
        F.max(F.when(departure, fee)).alias("biggest_sale_eur"),
        signing["player"].alias("biggest_signing"),
    )


def player_values(squad_values: DataFrame, performance: DataFrame) -> DataFrame:
    """Market values next to the season's output, and contributions per ten million."""
    v = squad_values.where(F.col("market_value_eur").isNotNull()).select(
        "season", "player", "position", "nationality", "age", "market_value_eur",
        F.lower("player").alias("_name"),
    )
    p = performance.select(
        "season", F.lower("player").alias("_name"), "goals", "assists", "minutes", "shots", "tackles"
    )
    output = F.coalesce("goals", F.lit(0.0)) + F.coalesce("assists", F.lit(0.0))
    value = F.col("market_value_eur")
    return v.join(p, ["season", "_name"], "left").select(
        "season", "player", "position", "nationality", "age", "market_value_eur",
        "goals", "assists", "minutes", "shots", "tackles",
        F.when(value > 0, F.round(output / (value / 10_000_000), 2)).alias("contributions_per_10m"),
    )
