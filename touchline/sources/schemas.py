"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: str) -> T.StructType:
    names = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType(), "t": T.TimestampType(),
             "b": T.BooleanType(), "day": T.DateType()}
    return T.StructType([T.StructField(name, names[kind]) for name, kind in fields.items()])


MATCHES = _schema(
    game_id="s", season="s", date="day", gameweek="l", home_team="s", away_team="s", home_goals="l",
    away_goals="l", venue="s", scraped_at="t",
)
# The stats of one player and season, in table order.
STAT_NAMES = [
    "minutes", "goals", "assists", "xg", "xag", "npxg", "shots", "shots_on_tgt", "shot_on_tgt_pct",
    "passes_cmp", "passes_att", "passes_cmp_pct", "key_passes", "passes_into_final_third",
    "passes_into_pen_area", "prog_passes", "tackles", "tackles_won", "interceptions", "blocks",
    "clearances", "pressures", "pressure_successes", "touches", "touches_att_pen", "prog_carries",
    "carries_into_final_third", "carries_into_pen_area", "take_ons_att", "take_ons_won",
    "prog_passes_received", "yellow_cards", "red_cards", "fouls", "fouled", "offsides",
]
PLAYER_STATS = _schema(
    season="s", player="s", team="s", stat_type="s", **{name: "d" for name in STAT_NAMES}, scraped_at="t"
)
SEASON_LEDGER = _schema(season="s", scraped_at="t", matches_count="l", players_count="l", is_complete="b")
SQUAD_VALUES = _schema(
    season="s", player="s", player_id="s", player_slug="s", position="s", nationality="s",
    nationality_full="s", age="l", market_value_eur="l", photo_url="s", dob="s", height="s", foot="s",
    contract_expires="s", scraped_at="t",
)
TRANSFERS = _schema(
    season="s", player="s", player_id="s", direction="s", from_club="s", to_club="s", fee_eur="l",
    fee_text="s", transfer_date="day", position="s", age_at_transfer="l", scraped_at="t",
)
PROFILES = _schema(
    player_id="s", player_slug="s", player_name="s", photo_url="s", dob="s", height="s", foot="s",
    nationality="s", position="s", contract_expires="s", agent="s", mv_history_json="s", scraped_at="t",
)
VALUE_HISTORY = _schema(
    player_id="s", player="s", season="s", market_value_eur="l", valid_from="day", valid_to="day",
    is_current="b", recorded_at="t",
)
RUN_LOG = _schema(
    run_id="s", pipeline="s", season="s", started_at="t", finished_at="t", rows_written="l", status="s",
    error_msg="s",
)
VALUE_POINTS = T.ArrayType(_schema(x="l", y="l", mw="s"))
