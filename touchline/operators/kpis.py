"""KPI reports, one row or one short list per season (or per player), for all seasons at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import name_key
from touchline.plans.skew import first_rows

# List lengths, and what a red card weighs against a yellow one.
FORM_LENGTH = 10
TOP_GOALS = 10
TOP_SHOOTERS = 12
TOP_OFFSIDES = 6
TOP_DEFENDERS = 10
TOP_FEES = 8
BALANCE_SEASONS = 15
RED_CARD_WEIGHT = 3


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def _percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(part / whole * 100, digits)


def _played(matches: DataFrame) -> DataFrame:
    return matches.where(F.col("result").isNotNull())


def season_kpis(matches: DataFrame) -> DataFrame:
    """Goals and games at home and away, clean sheets, and the biggest win (of equals the first by date and id).

    Takes staged matches: a report that does not show match numbers does not pay for them.
    """
    home, away = F.col("venue_type") == "home", F.col("venue_type") == "away"
    margin = F.col("goals_for") - F.col("goals_against")
    win = F.min(
        F.when(
            F.col("result") == "W",
            F.struct((-margin).alias("m"), "date", "game_id", "opponent", "venue_type", "goals_for", "goals_against"),
        )
    )
    return (
        _played(matches)
        .groupBy("season")
        .agg(
            F.sum(F.when(home, F.col("goals_for")).otherwise(0)).alias("home_goals"),
            F.sum(F.when(away, F.col("goals_for")).otherwise(0)).alias("away_goals"),
            F.count_if(home).alias("home_games"),
            F.count_if(away).alias("away_games"),
            F.count_if(F.col("goals_against") == 0).alias("clean_sheets"),
            win.alias("_win"),
        )
        .select(
            "season", "home_goals", "away_goals", "home_games", "away_games", "clean_sheets",
            F.col("_win.date").alias("biggest_win_date"),
            F.col("_win.opponent").alias("biggest_win_opponent"),
            F.col("_win.goals_for").alias("biggest_win_for"),
            F.col("_win.goals_against").alias("biggest_win_against"),
        )
    )


def result_share(season_summary: DataFrame) -> DataFrame:
    total = F.col("wins") + F.col("draws") + F.col("losses")
    return season_summary.where(total > 0).select(
        "season", *[(F.col(c) / total).alias(f"{c}_share") for c in ("wins", "draws", "losses")]
    )


def form_strip(match_results: DataFrame) -> DataFrame:
    """The newest ten matches of a season, '?' for those without a result."""
    last = first_rows(match_results, ["season"], [F.col("match_number").desc()], FORM_LENGTH)
    return last.select(
        "season", "match_number", "date", "opponent", "goals_for", "goals_against",
        F.coalesce("result", F.lit("?")).alias("result"),
    )


def _leaders(performance: DataFrame, stat: str, n: int, extra: list[str]) -> DataFrame:
    """Top ``n`` of a stat per season and each one's share of the leader's."""
    top = first_rows(
        performance.where(F.col(stat) > 0).select("season", "player", stat, *extra),
        ["season"], [F.col(stat).desc(), F.col("player")], n,
    )
    leader = F.max(stat).over(Window.partitionBy("season"))
    return top.withColumn("share_of_leader", F.col(stat) / leader)


def top_goals(performance: DataFrame) -> DataFrame:
    return _leaders(performance, "goals", TOP_GOALS, ["assists", "minutes"])


def top_offsides(performance: DataFrame) -> DataFrame:
    return _leaders(performance, "offsides", TOP_OFFSIDES, ["minutes"])


def top_tackles(performance: DataFrame) -> DataFrame:
    return _leaders(performance, "tackles", TOP_DEFENDERS, ["interceptions", "minutes"])


def top_interceptions(performance: DataFrame) -> DataFrame:
    return _leaders(performance, "interceptions", TOP_DEFENDERS, ["tackles", "minutes"])


def shooting_table(performance: DataFrame) -> DataFrame:
    shots = F.col("shots")
    top = first_rows(performance.where(shots > 0), ["season"], [shots.desc(), F.col("player")], TOP_SHOOTERS)
    return top.select(
        "season", "player", "shots", "shots_on_tgt", "goals",
        _percent(_zero("shots_on_tgt"), shots, 0).alias("on_target_pct"),
        _percent(_zero("goals"), shots, 0).alias("conversion_pct"),
    )


def venue_goals(matches: DataFrame) -> DataFrame:
    goals = F.sum(F.coalesce("goals_for", F.lit(0)))
    return (
        _played(matches)
        .groupBy("season", "venue_type")
        .agg(goals.alias("goals"), F.count("*").alias("games"), F.round(goals / F.count("*"), 2).alias("avg_goals"))
    )


def match_goal_series(match_results: DataFrame) -> DataFrame:
    return _played(match_results).select(
        "season", "match_number",
        F.coalesce("goals_for", F.lit(0)).alias("goals"),
        F.coalesce("goals_against", F.lit(0)).alias("conceded"),
        F.col("venue_type").alias("venue"),
        "opponent", "result",
    )


def attack_totals(performance: DataFrame) -> DataFrame:
    goals, shots, on_target = (F.sum(_zero(c)) for c in ("goals", "shots", "shots_on_tgt"))
    return performance.groupBy("season").agg(
        goals.alias("goals"),
        shots.alias("shots"),
        F.when(on_target > 0, _percent(goals, shots, 1)).otherwise(F.lit(0.0)).alias("conversion_pct"),
    )


def clean_sheet_summary(matches: DataFrame) -> DataFrame:
    conceded = F.coalesce("goals_against", F.lit(0))
    return (
        _played(matches)
        .groupBy("season")
        .agg(
            F.count_if(F.col("goals_against") == 0).alias("clean_sheets"),
            F.round(F.sum(conceded) / F.count("*"), 2).alias("conceded_per_game"),
            F.max(conceded).alias("most_conceded"),
        )
    )


def discipline_rank(performance: DataFrame) -> DataFrame:
    yellow, red = _zero("yellow_cards"), _zero("red_cards")
    points = yellow + red * RED_CARD_WEIGHT
    carded = performance.where(yellow + red > 0).select(
        "season", "player", yellow.alias("yellow_cards"), red.alias("red_cards"), _zero("fouls").alias("fouls"),
        _zero("fouled").alias("fouled"), points.alias("card_points"),
    )
    return carded.orderBy("season", F.col("card_points").desc(), "player")


def defence_totals(performance: DataFrame, matches: DataFrame) -> DataFrame:
    players = performance.groupBy("season").agg(
        F.sum(_zero("tackles")).alias("tackles"), F.sum(_zero("interceptions")).alias("interceptions")
    )
    against = _played(matches).groupBy("season").agg(F.sum("goals_against").alias("goals_against"))
    return players.join(against, "season", "full_outer")


def career_summary(performance: DataFrame, squad_values: DataFrame) -> DataFrame:
    """Career goals, assists, seasons and peak value per player of the performance mart."""
    key = name_key(F.col("player")).alias("player_key")
    career = performance.groupBy(key).agg(
        F.sum(_zero("goals")).alias("career_goals"),
        F.sum(_zero("assists")).alias("career_assists"),
        F.count("*").alias("seasons"),
    )
    peak = squad_values.groupBy(key).agg(F.max("market_value_eur").alias("_peak"))
    return career.join(peak, "player_key", "left").select(
        *career.columns, F.greatest(F.coalesce("_peak", F.lit(0)), F.lit(0)).alias("peak_value_eur")
    )


def value_share_of_peak(squad_values: DataFrame) -> DataFrame:
    """Each season's value over the player's highest."""
    rows = squad_values.select(name_key(F.col("player")).alias("player_key"), "season", "market_value_eur")
    peak = rows.groupBy("player_key").agg(F.greatest(F.lit(1), F.max("market_value_eur")).alias("_peak"))
    return rows.join(peak, "player_key").select(
        "player_key", "season", "market_value_eur",
        (F.coalesce("market_value_eur", F.lit(0)) / F.col("_peak")).alias("share_of_peak"),
    )


def peak_squad_season(squad_value: DataFrame, season: str) -> DataFrame:
    """Season of the largest squad value (the newest of equals), and the value of ``season``."""
    total = F.coalesce("total_value_eur", F.lit(0))
    return squad_value.agg(
        F.max(F.when(total > 0, F.struct(total.alias("v"), "season"))).alias("_peak"),
        F.max(F.when(F.col("season") == season, F.col("total_value_eur"))).alias("current_value_eur"),
    ).select(
        F.col("_peak.season").alias("peak_season"), F.col("_peak.v").alias("peak_value_eur"), "current_value_eur"
    )


def top_transfers(transfers: DataFrame, direction: str, k: int = TOP_FEES) -> DataFrame:
    paid = transfers.where((F.col("direction") == direction) & (F.col("fee_eur") > 0))
    columns = ["season", "player", "from_club", "to_club", "fee_eur"]
    return paid.select(*columns).orderBy(F.col("fee_eur").desc(), F.col("season").desc(), *columns[1:4]).limit(k)


def player_value_table(player_values: DataFrame) -> DataFrame:
    """Valued players per season, with a flag for rows, and for whole seasons, without performance."""
    valued = player_values.where(F.col("market_value_eur") != 0)
    none = F.col("minutes").isNull() & F.col("goals").isNull() & F.col("assists").isNull()
    rows = valued.select(
        "season", "player", "position", "age", "market_value_eur", "goals", "assists", "minutes",
        "contributions_per_10m", none.alias("no_performance"),
    )
    by_season = rows.groupBy("season").agg(F.bool_and("no_performance").alias("season_without_performance"))
    return rows.join(by_season, "season").orderBy("season", F.col("market_value_eur").desc(), "player")


def balance_window(transfer_balance: DataFrame, n: int = BALANCE_SEASONS, newest: bool = False) -> DataFrame:
    """``n`` seasons of the balance in ascending order: the oldest ones unless ``newest``."""
    rows = transfer_balance.select("season", "spent_eur", "received_eur", "net_spend_eur")
    first = F.col("season").desc() if newest else F.col("season")
    return rows.orderBy(first).limit(n).orderBy("season")
