"""Names, numbers in text, money texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space found around texts; the cost of trimming grows with this set.
WHITESPACE = " \t\n\r\x0b\x0c\xa0"
# A fee text with one of these is a move without a fee.
NO_FEE_MARKS = ["free", "loan", "draft", "-"]


def clean(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def name_key(name: Column) -> Column:
    """The key names are joined on."""
    return F.lower(clean(name))


def blank_to_null(text: Column) -> Column:
    return F.nullif(clean(text), F.lit(""))


def safe_double(text: Column) -> Column:
    # The JVM parser also takes a type suffix ('1.5f'), which is not a number in SQL.
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def safe_bigint(text: Column) -> Column:
    return text.try_cast("bigint")


def to_float(text: Column) -> Column:
    """Number with thousands separators; unparsable text and NaN become NULL."""
    number = safe_double(clean(F.replace(text.cast("string"), F.lit(","), F.lit(""))))
    return F.when(~F.isnan(number), number)


def parse_market_value(text: Column) -> Column:
    """'€10.5m' → 10500000, '€900k' → 900000, '900' → 900."""
    amount = F.replace(F.replace(clean(text), F.lit("\xa0"), F.lit("")), F.lit(","), F.lit("."))
    lowered = F.lower(amount)
    decimal = safe_double(F.regexp_replace(amount, r"[^0-9.]", ""))
    return (
        F.when(lowered.contains("m"), (decimal * 1_000_000).try_cast("bigint"))
        .when(lowered.contains("k"), (decimal * 1_000).try_cast("bigint"))
        .otherwise(F.regexp_replace(amount, r"[^0-9]", "").try_cast("bigint"))
    )


def parse_fee(text: Column) -> Column:
    """Struct of the amount and the text kept for display; both NULL when there is no text."""
    shown = clean(text)
    no_fee = F.lower(shown).rlike("|".join(NO_FEE_MARKS))
    amount = F.when(no_fee, F.lit(0).cast("bigint")).otherwise(parse_market_value(shown))
    present = F.length(text) > 0
    return F.struct(F.when(present, amount).alias("fee_eur"), F.when(present, shown).alias("fee_text"))


def parse_age(text: Column) -> Column:
    """The number in parentheses: '02/10/1992 (32)' → 32."""
    return F.regexp_extract(text, r"\((\d+)\)", 1).try_cast("bigint")


def slugify(text: Column) -> Column:
    """Text as a column name: lower case, '_' for blanks and dashes, '_' before a leading digit."""
    slug = F.regexp_replace(F.lower(text), r"[ -]+", "_")
    slug = F.regexp_replace(slug, r"[^a-z0-9_]+", "")
    return F.regexp_replace(slug, r"^([0-9])", "_$1")
