"""A written index of names, for searches with many terms at once.

One literal predicate per term is a scan that grows with the number of terms. The index turns it into one join: every
distinct name is listed under its pieces of up to three characters, a term looks only under the rarest of its own
pieces, and the names found there are checked literally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import name_key
from touchline.plans.skew import first_rows
from touchline.sources.tables import write_mart

GRAM = 3


def grams(text: Column, least: int = 0) -> Column:
    """Distinct pieces of ``least`` to three characters; the empty piece is in every text."""

    def of_size(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        count = F.length(text) - (n - 1)
        places = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.substring(text, i, F.lit(n)))

    return F.array_distinct(F.flatten(F.array(*[of_size(n) for n in range(least, GRAM + 1)])))


class NameIndex:
    """Distinct lower-case names, their pieces, and how many names hold each piece, below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def written(cls, names: DataFrame, path: str, col: str = "player") -> NameIndex:
        """NULL names are not listed."""
        index = cls(names.sparkSession, path)
        low = names.select(F.lower(col).alias("low")).where("low is not null").distinct()
        write_mart(low.withColumn("name_key", name_key(F.col("low"))), f"{path}/names", cluster_by=["name_key"])
        pieces = index._read("names").select("low", F.explode(grams(F.col("low"))).alias("gram"))
        write_mart(pieces, f"{path}/grams", cluster_by=["gram"])
        write_mart(index._read("grams").groupBy("gram").agg(F.count("*").alias("n")), f"{path}/counts", cluster_by=["gram"])
        return index

    def _read(self, name: str) -> DataFrame:
        schema = {"names": "low string, name_key string", "grams": "low string, gram string", "counts": "gram string, n bigint"}
        return self.spark.read.schema(schema[name]).parquet(f"{self.path}/{name}")

    def containing(self, terms: DataFrame, part: str = "part") -> DataFrame:
        """``terms`` with each name (``low``) that contains ``part``, taken literally.

        A term below three characters is itself a piece; the empty one is in every name, a NULL one in none. A term
        with a piece that no name has drops out before any name is read.
        """
        asked = terms.select(part).distinct().where(F.col(part).isNotNull())
        size = F.length(part)
        own = F.when(size >= GRAM, grams(F.col(part), GRAM)).otherwise(F.array(part))
        pieces = asked.select(part, F.size(own).alias("pieces"), F.explode(own).alias("gram"))
        known = pieces.join(self._read("counts"), "gram")
        rarest = known.groupBy(part).agg(
            F.count("*").alias("known"), F.first("pieces").alias("pieces"), F.min(F.struct("n", "gram"))["gram"].alias("gram")
        )
        candidates = rarest.where("known = pieces").select(part, "gram").join(self._read("grams"), "gram")
        found = candidates.where(F.col("low").contains(F.col(part))).select(part, "low")
        return terms.join(found, part)

    def called(self, terms: DataFrame, exact: str = "exact") -> DataFrame:
        """``terms`` with each name whose key equals ``exact``."""
        return terms.join(self._read("names").withColumnRenamed("name_key", exact), exact)


def resolve_players(squad_values: DataFrame, terms: DataFrame, season: str, index: NameIndex) -> DataFrame:
    """The squad row each search term (column ``term``) means, by the rules of ``resolve_player``, in one join.

    Terms are trimmed and count once; a NULL term means nobody.
    """
    from touchline.operators.reads import SQUAD_COLUMNS, best_match

    texts = terms.select(F.trim("term").alias("term")).where("term is not null").distinct()
    asked = texts.select("term", name_key(F.col("term")).alias("exact"), F.lower(F.replace("term", F.lit("%"), F.lit(""))).alias("part"))
    hits = index.containing(asked).select("term", "exact", "part", "low").unionByName(index.called(asked).select("term", "exact", "part", "low"))
    rows = squad_values.select("season", *SQUAD_COLUMNS, F.lower("player").alias("low")).join(hits.distinct(), "low")
    return best_match(rows, season)


def first_names(index: NameIndex, terms: DataFrame, n: int = 10) -> DataFrame:
    """Suggestions: for each term (column ``term``) its first ``n`` names, the shortest first."""
    asked = terms.select("term", F.lower("term").alias("part")).distinct()
    return first_rows(index.containing(asked), ["term"], [F.length("low"), F.col("low")], n).select("term", "low")
