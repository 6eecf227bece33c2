"""Read queries on the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.config import DEFAULTS
from touchline.functions import name_key, normalize_season, normalize_url, portrait_url, season_label
from touchline.plans.skew import first_rows
from touchline.sources.schemas import VALUE_POINTS

# Columns a player list may be sorted by.
SORT_COLUMNS = [
    "goals", "assists", "goal_contributions", "minutes", "shots", "shots_on_tgt", "shot_accuracy", "tackles",
    "interceptions", "fouls", "offsides",
]
PLAYER_COLUMNS = [
    "player", "season", "minutes", "goals", "assists", "goal_contributions", "shots", "shots_on_tgt",
    "shot_accuracy", "tackles", "interceptions", "fouls", "fouled", "offsides", "yellow_cards", "red_cards",
]
HISTORY_COLUMNS = [
    "season", "goals", "assists", "minutes", "shots", "shots_on_tgt", "tackles", "interceptions", "fouls",
    "fouled", "offsides", "yellow_cards", "red_cards", "goal_contributions", "shot_accuracy",
]
SQUAD_COLUMNS = [
    "player", "player_id", "player_slug", "position", "nationality", "nationality_full", "age",
    "market_value_eur", "photo_url", "dob", "height", "foot", "contract_expires",
]
# Marks of an image that shows nobody.
PLACEHOLDER_MARKS = ["no_picture", "nopicture", "default"]


def _season(df: DataFrame, season: str) -> DataFrame:
    return df.where(F.col("season") == season)


def matches_of_season(match_results: DataFrame, season: str) -> DataFrame:
    return _season(match_results, season).orderBy("date", "match_number")


def summary_of_season(season_summary: DataFrame, season: str) -> DataFrame:
    return _season(season_summary, season).limit(1)


def players_sorted(performance: DataFrame, season: str, sort: str = "goals", order: str = "DESC") -> DataFrame:
    """Players of a season; an unknown column means goals, any order but 'ASC' means descending."""
    by = F.col(sort if sort in SORT_COLUMNS else "goals")
    by = by.asc_nulls_first() if order == "ASC" else by.desc_nulls_last()
    return _season(performance, season).select(*PLAYER_COLUMNS).orderBy(by, "player")


def seasons_list(ledger: DataFrame, default: str = DEFAULTS.default_season) -> DataFrame:
    """Seasons with matches or players, newest first; the default season leads when it is not among them."""
    filled = (F.coalesce("matches_count", F.lit(0)) > 0) | (F.coalesce("players_count", F.lit(0)) > 0)
    known = ledger.where(filled).select(
        normalize_season(F.col("season")).alias("season"),
        "is_complete",
        F.col("matches_count").alias("matches"),
        F.lit(1).alias("_rank"),
        F.col("season").alias("_raw"),
    )
    code = normalize_season(F.lit(default))
    absent = known.agg(F.count_if(F.col("season") == code).alias("n")).where("n = 0")
    added = absent.select(
        code.alias("season"),
        F.lit(False).alias("is_complete"),
        F.lit(None).cast("bigint").alias("matches"),
        F.lit(0).alias("_rank"),
        F.lit(None).cast("string").alias("_raw"),
    )
    every = known.unionByName(added)
    return every.orderBy("_rank", F.col("_raw").desc()).select(
        "season", season_label(F.col("season")).alias("label"), "is_complete", "matches"
    )


def squad_value_history(squad_value: DataFrame) -> DataFrame:
    return squad_value.orderBy(F.col("season").desc())


def balance_history(transfer_balance: DataFrame) -> DataFrame:
    return transfer_balance.orderBy(F.col("season").desc())


def transfer_history(transfers: DataFrame, season: str | None = None, direction: str | None = None) -> DataFrame:
    rows = transfers if not season else _season(transfers, season)
    if direction:
        rows = rows.where(F.col("direction") == direction)
    columns = [
        "season", "player", "direction", "from_club", "to_club", "fee_eur", "fee_text", "position", "age_at_transfer"
    ]
    return rows.select(*columns).orderBy(F.col("season").desc(), F.col("fee_eur").desc_nulls_last(), "player")


def player_values_by_season(player_values: DataFrame, season: str | None = None) -> DataFrame:
    rows = player_values if not season else _season(player_values, season)
    columns = [
        "season", "player", "position", "nationality", "age", "market_value_eur", "goals", "assists", "minutes",
        "contributions_per_10m",
    ]
    return rows.select(*columns).orderBy(F.col("market_value_eur").desc(), "season", "player")


def resolve_player(squad_values: DataFrame, terms: Sequence[str], season: str) -> DataFrame:
    """The squad row each search term means.

    First the exact name in the season, then the shortest name of the season that contains the term,
    then the newest row of any season that fits either way. The terms are a caller's short list, so
    they are matched as literals within the scan, without a join; for many see ``names.resolve_players``.
    """
    texts = list(dict.fromkeys(t.strip() for t in terms))
    wanted = F.array(
        *[
            F.struct(
                F.lit(t).alias("term"),
                name_key(F.lit(t)).alias("exact"),
                F.lit(t.replace("%", "").lower()).alias("part"),
            )
            for t in texts
        ]
    )
    key, low = name_key(F.col("player")), F.lower("player")
    hits = F.filter(wanted, lambda w: (key == w["exact"]) | low.contains(w["part"]))
    rows = squad_values.select("season", *SQUAD_COLUMNS, F.explode(hits).alias("_hit"))
    return best_match(rows.select("season", *SQUAD_COLUMNS, "_hit.*"), season)


def best_match(rows: DataFrame, season: str) -> DataFrame:
    """The first of the squad rows that fit a term, given next to each row as (term, exact, part)."""
    key, low = name_key(F.col("player")), F.lower("player")
    in_season = F.col("season") == season
    tier = (
        F.when(in_season & (key == F.col("exact")), 1).when(in_season & low.contains(F.col("part")), 2).otherwise(3)
    )
    ranked = rows.select("term", tier.cast("bigint").alias("tier"), "season", *SQUAD_COLUMNS)
    length = F.when(F.col("tier") == 2, F.length("player"))
    newest = F.when(F.col("tier") == 3, F.col("season"))
    order = [F.col("tier"), length, newest.desc_nulls_last(), F.col("player"), F.col("player_id")]
    return first_rows(ranked, ["term"], order).withColumnRenamed("season", "season_used")


def _filled(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def player_profile(resolved: DataFrame, cache: DataFrame) -> DataFrame:
    """A resolved squad row with its cached profile; the portrait stands in for a missing photo."""
    bio_columns = ["photo_url", "height", "foot", "contract_expires", "dob", "agent"]
    bio = cache.where(F.col("player_id") != "").select(
        F.col("player_id"), *[F.col(c).alias(f"c_{c}") for c in bio_columns], F.lit(True).alias("_hit")
    )
    joined = resolved.join(bio, "player_id", "left")
    photo = normalize_url(_filled(F.col("c_photo_url"), F.col("photo_url")))
    unusable = (photo == "") | F.lower(photo).rlike("|".join(PLACEHOLDER_MARKS))
    merged = [_filled(F.col(f"c_{c}"), F.col(c)).alias(c) for c in ("height", "foot", "contract_expires", "dob")]
    return joined.select(
        "term", "season_used", "player", "player_id", "player_slug", "position", "nationality",
        _filled(F.col("nationality_full"), F.col("nationality")).alias("nationality_full"),
        "age", "market_value_eur",
        F.when(unusable, portrait_url(F.col("player_id"))).otherwise(photo).alias("photo_url"),
        *merged,
        _filled(F.col("c_agent")).alias("agent"),
        F.coalesce("_hit", F.lit(False)).alias("cache_hit"),
    )


def _of_names(df: DataFrame, names: Sequence[str], columns: Sequence[str], ties: Sequence[str]) -> DataFrame:
    keys = [name_key(F.lit(n)) for n in names]
    key = name_key(F.col("player"))
    rows = df.where(key.isin(*keys)).select(key.alias("player_key"), *columns)
    return rows.orderBy("player_key", "season", *ties)


def player_performance_history(performance: DataFrame, names: Sequence[str]) -> DataFrame:
    return _of_names(performance, names, HISTORY_COLUMNS, ["minutes"])


def player_value_series(squad_values: DataFrame, names: Sequence[str]) -> DataFrame:
    return _of_names(squad_values, names, ["season", "market_value_eur", "age"], ["market_value_eur"])


def player_transfer_series(transfers: DataFrame, names: Sequence[str]) -> DataFrame:
    columns = ["season", "direction", "from_club", "to_club", "fee_eur", "fee_text", "position"]
    return _of_names(transfers, names, columns, ["direction", "fee_eur"])


def mv_history_points(profiles: DataFrame, schema: T.ArrayType = VALUE_POINTS) -> DataFrame:
    """One row per value point of the cached JSON text; bad JSON gives no rows."""
    points = F.from_json("mv_history_json", schema)
    return profiles.select("player_id", F.posexplode(points).alias("pos", "_p")).select(
        "player_id", F.col("pos").cast("bigint").alias("pos"), "_p.*"
    )


def recent_matches(match_results: DataFrame, season: str, k: int = 15) -> DataFrame:
    return (
        _season(match_results, season)
        .select("date", "opponent", "venue_type", "goals_for", "goals_against", "result", "cumulative_points",
                "match_number")
        .orderBy(F.col("date").desc(), F.col("match_number").desc())
        .limit(k)
    )


def top_scorers(performance: DataFrame, season: str, k: int = 10) -> DataFrame:
    columns = [c for c in PLAYER_COLUMNS if c not in ("season", "goal_contributions")]
    return _season(performance, season).select(*columns).orderBy(F.col("goals").desc(), "player").limit(k)
