"""URL parts, profile links and image links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.config import DEFAULTS
from touchline.functions.text import clean

# Path parts of a player's profile link.
ID_MARK = "spieler"
PROFILE_MARK = "profil"


def _without(url: Column, *schemes: str) -> Column:
    for scheme in schemes:
        url = F.replace(url, F.lit(scheme), F.lit(""))
    return url


def _before(text: Column, mark: str) -> Column:
    return F.split_part(text, F.lit(mark), F.lit(1))


def get_url_host(url: Column) -> Column:
    return _before(_before(_without(url, "android-app://", "http://", "https://"), "/"), "?")


def get_url_path(url: Column) -> Column:
    """Text between the first '/' after the host and the query; '' when there is a query but no path."""
    rest = _without(url, "http://", "https://")
    slash = F.position(F.lit("/"), rest)
    query = F.position(F.lit("?"), rest)
    tail = (
        F.when(slash > 0, F.substr(rest, slash + 1))
        .when(query > 0, F.substr(rest, query))
        .otherwise(rest)
    )
    return _before(tail, "?")


def get_url_parameter(url: Column, name: str) -> Column:
    """Text after ``name=`` up to the next '&', NULL when absent or empty."""
    value = _before(F.split_part(url, F.lit(f"{name}="), F.lit(2)), "&")
    return F.nullif(value, F.lit(""))


def normalize_url(url: Column, base: str = DEFAULTS.site_base) -> Column:
    link = F.coalesce(clean(url), F.lit(""))
    return (
        F.when(link.startswith("//"), F.concat(F.lit("https:"), link))
        .when(link.startswith("/"), F.concat(F.lit(base), link))
        .otherwise(link)
    )


def portrait_url(player_id: Column, pattern: str = DEFAULTS.portrait_pattern) -> Column:
    ident = F.coalesce(clean(player_id), F.lit(""))
    head, tail = pattern.split("{id}")
    return F.when(ident == "", F.lit("")).otherwise(F.concat(F.lit(head), ident, F.lit(tail)))


def first_srcset_url(
    data_src: Column, data_srcset: Column, srcset: Column, src: Column, base: str = DEFAULTS.site_base
) -> Column:
    """First filled image attribute; of a set ('a.jpg 1x, b.jpg 2x') the first link."""
    filled = [F.nullif(c, F.lit("")) for c in (data_src, data_srcset, srcset, src)]
    link = clean(F.coalesce(*filled, F.lit("")))
    is_set = link.contains(" ") & link.rlike(r"\.(jpg|png|webp)")
    first = _before(clean(_before(link, ",")), " ")
    return normalize_url(F.when(is_set, first).otherwise(link), base)


def _path_parts(href: Column) -> Column:
    link = clean(href)
    path = F.when(
        link.startswith("http"), F.regexp_extract(link, r"^[^:]+://[^/?#]*([^?#;]*)", 1)
    ).otherwise(link)
    return F.filter(F.split(path, "/"), lambda part: part != "")


def profile_id(href: Column) -> Column:
    parts = _path_parts(href)
    mark = F.array_position(parts, F.lit(ID_MARK)).cast("int")
    found = (
        F.when(mark > 0, F.try_element_at(parts, mark + 1))
        .when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-1)))
    )
    return F.coalesce(found, F.lit(""))


def profile_slug(href: Column) -> Column:
    parts = _path_parts(href)
    first = F.try_element_at(parts, F.lit(1))
    second = F.try_element_at(parts, F.lit(2))
    marked = F.array_contains(parts, F.lit(ID_MARK))
    found = (
        F.when(marked & (first == PROFILE_MARK), second)
        .when(marked | (F.size(parts) >= 2), first)
    )
    return F.coalesce(found, F.lit(""))
