"""Verdicts on URLs: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

All of it is DataFrame functions. The filter is a table of blocks of 256 bits, eight words of 32. A URL's 64-bit hash
names its block, a second hash one bit in each word, so a look-up is one row. Blocks are built by ``bit_or`` of the
listed URLs' words, which map tasks pre-aggregate, and probed by an equality join on the block. That join is broadcast
while the filter, whose size follows from the length of the list, has at most ``BROADCAST_BLOCKS`` blocks; beyond that
it is shuffled. What passes is reduced to its distinct URLs and meets the list itself in an exact join, which removes
false positives. Rows that do not pass take no part in it. Rows of a much repeated URL are dealt over ``SALTS`` tasks.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is not listed. A rule
fits its host and all subdomains where the URL's path starts with the rule's; of those that fit, the longest (host and
path together) counts, then the one with the longer host, then a blocking one. The list decides where no rule fits.
Repeated rows stay repeated, repeated list entries count once, null entries not at all. The input row comes back as one
struct ``row``, so its column names cannot clash. Empty tables give no rows, an empty list lists nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
KEYS_PER_BLOCK = 16
# 40 bytes a block as data, less than 100 MB as a broadcast hash table; serves a list of 8 million URLs.
BROADCAST_BLOCKS = 1 << 19
SALTS = 16
# Parameters that tell how a visitor came, not which document is meant.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid|phpsessid)(=.*)?$"


# ---------------------------------------------------------------------------------------------------------------
# Parts of a URL
# ---------------------------------------------------------------------------------------------------------------


def _part(url: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://" + pattern, 1), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; never null."""
    return ascii_lower(_part(url, "([^/?#]*)"))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; never null."""
    return _part(url, "[^/?#]*([^?#]*)")


def canonical(url: Column) -> Column:
    """Host without a default port, path without closing slashes, and the sorted parameters that name the document.

    Scheme, fragment and tracking parameters go; null for a null URL or one without ``://``.
    """
    host = F.regexp_replace(host_of(url), ":(80|443)?$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    kept = F.filter(F.split(_part(url, r"[^?#]*\?([^#]*)"), "&"), lambda p: (p != "") & ~ascii_lower(p).rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(url.contains("://"), F.concat(host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


# ---------------------------------------------------------------------------------------------------------------
# Rules
# ---------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last one written decides first.
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.verdict == "block")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


# ---------------------------------------------------------------------------------------------------------------
# The list
# ---------------------------------------------------------------------------------------------------------------


class UrlList:
    """Distinct canonical URLs (column ``canon``), written once, and the blocked Bloom filter over them."""

    def __init__(self, urls: DataFrame, url: str = "url"):
        canon = urls.select(canonical(F.col(url)).alias("canon")).where("canon is not null").distinct()
        self.table = stored(canon, "url-list")
        size, self.blocks = self.table.count(), 1
        while self.blocks * KEYS_PER_BLOCK < size:
            self.blocks *= 2
        self.broadcast = self.blocks <= BROADCAST_BLOCKS

    def block(self, canon: Column) -> Column:
        return F.pmod(F.xxhash64(canon), F.lit(self.blocks)).cast("int")

    def marks(self, canon: Column) -> list[Column]:
        """One bit in each word of the block."""
        bits = F.xxhash64(canon, F.lit(1))
        place = [F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
        return [F.call_function("shiftleft", F.lit(1), p) for p in place]

    def filter(self) -> DataFrame:
        canon = F.col("canon")
        rows = self.table.select(self.block(canon).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(self.marks(canon))])
        return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])

    def possible(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``possible``: the filter holds all bits of their ``canon``; false where it is null."""
        canon = F.col("canon")
        rows = rows.withColumn("block", F.coalesce(self.block(canon), F.lit(-1)))
        if self.broadcast:
            met = rows.join(F.broadcast(self.filter()), ["block"], "left")
        else:
            salts = self.filter().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            met = rows.withColumn("salt", self._salt()).join(salts, ["block", "salt"], "left").drop("salt")
        held = [F.col(f"w{i}").bitwiseAND(m) != 0 for i, m in enumerate(self.marks(canon))]
        every = held[0]
        for h in held[1:]:
            every = every & h
        return met.select(*rows.drop("block").columns, F.coalesce(every & canon.isNotNull(), F.lit(False)).alias("possible"))

    def _salt(self) -> Column:
        return F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")

    def listed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``listed``: their ``canon`` is on the list."""
        probed = self.possible(rows)
        passed, out = probed.where("possible").drop("possible"), probed.where("not possible").drop("possible")
        confirmed = passed.select("canon").distinct().join(self.table, "canon")
        dealt = confirmed.select("canon", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("listed"))
        found = passed.withColumn("salt", self._salt()).join(dealt, ["canon", "salt"], "left")
        own = [F.col(c) for c in rows.columns]
        return out.select(*own, F.lit(False).alias("listed")).unionByName(
            found.select(*own, F.coalesce("listed", F.lit(False)).alias("listed"))
        )


def judge(pages: DataFrame, urls: UrlList, url: str = "url", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, host, path, rule, listed, verdict) of every row: the verdict of its rule, else block where it is listed.

    ``listed`` is null where a rule decided.
    """
    rows = pages.select(F.struct("*").alias("row"), F.col(url).alias("url"))
    parts = rows.select("row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = parts.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    # A row that a rule decides has nothing to look up.
    asked = ruled.select("row", "host", "path", "fit", F.when(F.col("fit").isNull(), canonical(F.col("url"))).alias("canon"))
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return urls.listed(asked).select(
        "row", "host", "path", F.col("fit.rule").alias("rule"),
        F.when(F.col("fit").isNull(), F.col("listed")).alias("listed"),
        F.coalesce("fit.verdict", by_list).alias("verdict"),
    )


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs that any page was reached at through a campaign link (a ``utm_`` parameter)."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    campaign = UrlList(pages.where(ascii_lower(F.col("url")).rlike(r"[?&]utm_[a-z]+=")))
    return judge(pages, campaign).select("row.page_id", "host", "path", "rule", "verdict")
