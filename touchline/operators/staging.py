"""Rows from pages to typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.config import DEFAULTS
from touchline.functions import clean, safe_bigint, safe_double, to_float
from touchline.plans.skew import first_rows
from touchline.sources.schemas import PLAYER_STATS

# The column of a stat page each stat is read from.
STANDARD_FIELDS = {
    "minutes": "Playing Time_Min",
    "goals": "Performance_Gls",
    "assists": "Performance_Ast",
    "yellow_cards": "Performance_CrdY",
    "red_cards": "Performance_CrdR",
}
SHOOTING_FIELDS = {
    "shots": "Standard_Sh",
    "shots_on_tgt": "Standard_SoT",
    "shot_on_tgt_pct": "Standard_SoT%",
}
MISC_FIELDS = {
    "tackles": "Performance_TklW",
    "tackles_won": "Performance_TklW",
    "interceptions": "Performance_Int",
    "fouls": "Performance_Fls",
    "fouled": "Performance_Fld",
    "offsides": "Performance_Off",
}
STAGED_STATS = [
    "xg", "xag", "shots", "shots_on_tgt", "tackles", "interceptions", "fouls", "fouled", "offsides",
    "yellow_cards", "red_cards",
]


def build_match_rows(
    schedule: DataFrame, focal: str = DEFAULTS.focal_team, league: str = DEFAULTS.league, id_length: int | None = None
) -> DataFrame:
    """League matches with a date; the own team's goals go to the side it played on.

    The match id is the report's name, or with ``id_length`` the last characters of it; short ids collide as data grow.
    """
    at_home = F.lower(F.col("venue")) == "home"
    own, other = to_float(F.col("gf")), to_float(F.col("ga"))
    week = F.when(
        F.col("round").contains("Matchweek"),
        safe_bigint(clean(F.replace(F.col("round"), F.lit("Matchweek"), F.lit("")))),
    )
    game_id = F.coalesce(F.col("match_report"), F.col("date"))
    if id_length:
        game_id = F.right(game_id, F.lit(id_length))
    dated = F.col("comp").contains(league) & (F.col("date") != "") & (F.col("date") != "nan")

    def sided(home: Column, away: Column) -> Column:
        return F.when(at_home, home).otherwise(away)

    return schedule.where(dated).select(
        game_id.alias("game_id"),
        "season",
        F.substring("date", 1, 10).alias("date"),
        week.alias("gameweek"),
        sided(F.lit(focal), F.col("opponent")).alias("home_team"),
        sided(F.col("opponent"), F.lit(focal)).alias("away_team"),
        sided(own, other).cast("bigint").alias("home_goals"),
        sided(other, own).cast("bigint").alias("away_goals"),
        "venue",
    )


def _numbers(df: DataFrame, fields: dict[str, str]) -> list[Column]:
    return [to_float(F.col(f"`{src}`")).alias(name) for name, src in fields.items() if src in df.columns]


def build_player_rows(
    standard: DataFrame, shooting: DataFrame, misc: DataFrame, focal: str = DEFAULTS.focal_team
) -> DataFrame:
    """Stat rows of the standard page, with the first row per player of the other two pages."""

    def side(page: DataFrame, fields: dict[str, str]) -> DataFrame:
        first = first_rows(page, ["season", "Player"], [F.col("row_no")])
        return first.select("season", F.col("Player").alias("player"), *_numbers(page, fields))

    name = clean(F.col("Player"))
    base = standard.select("season", name.alias("player"), *_numbers(standard, STANDARD_FIELDS)).where(
        ~F.col("player").isin("", "nan", "Player")
    )
    joined = base.join(side(shooting, SHOOTING_FIELDS), ["season", "player"], "left").join(
        side(misc, MISC_FIELDS), ["season", "player"], "left"
    )
    fixed = {"team": F.lit(focal), "stat_type": F.lit("combined")}
    return joined.select(
        *[
            F.col(f.name) if f.name in joined.columns else fixed.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in PLAYER_STATS.fields
            if f.name != "scraped_at"
        ]
    )


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _bigint(df: DataFrame, col: str) -> Column:
    return safe_bigint(F.col(col)) if _is_text(df, col) else F.col(col).try_cast("bigint")


def _double(df: DataFrame, col: str) -> Column:
    return safe_double(F.col(col)) if _is_text(df, col) else F.col(col).cast("double")


def stg_matches(raw: DataFrame, focal: str = DEFAULTS.focal_team) -> DataFrame:
    """Matches of the focal team, seen from its side. A missing score counts as 0 goals, yet an
    unparsable score, or a missing away score alone, is a loss; only a missing home score is no result."""
    home, away = _bigint(raw, "home_goals"), _bigint(raw, "away_goals")
    is_home, is_away = F.col("home_team") == focal, F.col("away_team") == focal
    home0, away0 = F.coalesce(home, F.lit(0)), F.coalesce(away, F.lit(0))
    won = (is_home & (home > away)) | (is_away & (away > home))
    result = (
        F.when(won, "W")
        .when(home == away, "D")
        .when(F.col("home_goals").isNotNull(), "L")
    )
    return raw.where(is_home | is_away).select(
        "game_id",
        "season",
        F.col("date").cast("date").alias("date"),
        _bigint(raw, "gameweek").alias("gameweek"),
        "home_team",
        "away_team",
        home0.alias("home_goals"),
        away0.alias("away_goals"),
        "venue",
        F.when(is_home, "home").otherwise("away").alias("venue_type"),
        F.when(is_home, F.col("away_team")).otherwise(F.col("home_team")).alias("opponent"),
        F.when(is_home, home0).otherwise(away0).alias("goals_for"),
        F.when(is_home, away0).otherwise(home0).alias("goals_against"),
        result.alias("result"),
    )


def stg_player_stats(
    raw: DataFrame, focal: str | None = DEFAULTS.focal_team, team_col: str = "team"
) -> DataFrame:
    """Typed stats of the focal team, or of all teams when ``focal`` is None."""
    kept = raw if focal is None else raw.where(F.col(team_col) == focal)

    def stat(name: str) -> Column:
        return _double(raw, name) if name in raw.columns else F.lit(None).cast("double")

    return kept.select(
        "season",
        "player",
        F.col(team_col).alias("team"),
        "stat_type",
        *[F.coalesce(stat(c), F.lit(0.0)).alias(c) for c in ("minutes", "goals", "assists")],
        *[stat(c).alias(c) for c in STAGED_STATS],
    )
