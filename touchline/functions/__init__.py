"""Column functions. All are native expressions, so they stay inside code generation."""

from touchline.functions.keys import fingerprint_id, surrogate_key
from touchline.functions.numbers import (
    goals_per_90,
    haversine_distance,
    safe_add,
    safe_divide,
    safe_subtract,
    width_bucket,
)
from touchline.functions.seasons import (
    normalize_season,
    recent_season_codes,
    season_code,
    season_codes,
    season_label,
    season_of_date,
    season_start_year,
    season_to_years,
    start_year_of,
)
from touchline.functions.text import (
    blank_to_null,
    clean,
    name_key,
    parse_age,
    parse_fee,
    parse_market_value,
    safe_bigint,
    safe_double,
    slugify,
    to_float,
)
from touchline.functions.urls import (
    first_srcset_url,
    get_url_host,
    get_url_parameter,
    get_url_path,
    normalize_url,
    portrait_url,
    profile_id,
    profile_slug,
)

__all__ = [
    "blank_to_null", "clean", "fingerprint_id", "first_srcset_url", "get_url_host", "get_url_parameter",
    "get_url_path", "goals_per_90", "haversine_distance", "name_key", "normalize_season", "normalize_url",
    "parse_age", "parse_fee", "parse_market_value", "portrait_url", "profile_id", "profile_slug",
    "recent_season_codes", "safe_add", "safe_bigint", "safe_divide", "safe_double", "safe_subtract",
    "season_code", "season_codes", "season_label", "season_of_date", "season_start_year", "season_to_years", "slugify",
    "start_year_of", "surrogate_key", "to_float", "width_bucket",
]
