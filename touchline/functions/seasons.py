"""Season codes: two two-digit years, so August 2024 to July 2025 is '2425'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A season starts in August; two-digit years above 30 belong to the 1900s.
SEASON_START_MONTH = 8
CENTURY_PIVOT = 30


def _two_digits(year: Column) -> Column:
    return F.lpad((year % 100).cast("string"), 2, "0")


def season_code(start_year: Column) -> Column:
    return F.concat(_two_digits(start_year), _two_digits(start_year + 1))


def start_year_of(day: Column) -> Column:
    return F.year(day) - (F.month(day) < SEASON_START_MONTH).cast("int")


def season_of_date(day: Column) -> Column:
    return season_code(start_year_of(day))


def season_codes(first_year: Column, as_of: Column) -> Column:
    """Array of every code from the season starting in ``first_year`` to the one running at ``as_of``."""
    last = start_year_of(as_of)
    years = F.when(first_year.cast("int") <= last, F.sequence(first_year.cast("int"), last))
    return F.transform(years, season_code)


def recent_season_codes(as_of: Column, n: int = 10) -> Column:
    """Array of the ``n`` newest codes at ``as_of``, oldest first."""
    return season_codes(start_year_of(as_of) - (n - 1), as_of)


def season_to_years(season: Column) -> Column:
    def full(part: Column) -> Column:
        return F.concat(F.when(part.cast("int") <= CENTURY_PIVOT, "20").otherwise("19"), part)

    return F.concat_ws("-", full(F.substring(season, 1, 2)), full(F.substring(season, 3, 2)))


def season_start_year(season: Column) -> Column:
    return F.concat(F.lit("20"), F.substring(season, 1, 2))


def normalize_season(season: Column) -> Column:
    """'2024/25', '2024-25' and '2024' become '2425'; codes and other text stay as they are."""
    text = F.trim(season.cast("string"))
    split_years = r"^(20\d{2})\D+(\d{2})$"
    return (
        F.when(text.rlike(r"^\d{4}$") & ~text.startswith("20"), text)
        .when(
            text.rlike(split_years),
            F.concat(
                F.substring(F.regexp_extract(text, split_years, 1), 3, 2),
                F.regexp_extract(text, split_years, 2),
            ),
        )
        .when(text.rlike(r"^20\d{2}$"), season_code(text.try_cast("int")))
        .otherwise(text)
    )


def season_label(season: Column) -> Column:
    return F.concat(F.lit("20"), F.substring(season, 1, 2), F.lit("/"), F.substring(season, 3, 2147483647))
