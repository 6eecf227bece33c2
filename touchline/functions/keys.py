"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.text import name_key

# Fixed value: what a NULL field contributes to a surrogate key.
NULL_FIELD = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column, nulls_as_empty: bool = False) -> Column:
    filler = F.lit("" if nulls_as_empty else NULL_FIELD)
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), filler) for c in cols]))


def fingerprint_id(name: Column) -> Column:
    """Stable id of a name, equal for spellings that differ in case or outer blanks."""
    return F.md5(name_key(name))
