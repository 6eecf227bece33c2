"""From raw documents to token files: five stages, each on what the one before kept.

Defined results, for all stages: null and empty texts are rows like others; rows with a null id stay where a stage has
no reason to drop them; repeated rows are documents of their own, except that the second stage keeps one row of an id;
ties go to the smallest id there, then to a hash of the text; further columns, of any name, go along unchanged up to the
fourth stage; empty documents pass through all stages and give no rows; a null in any other column changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import fmindex, jaccard, mixing, quality, tokens
from touchline.llm.common import shared_folder, stored

# Target weights of the mix, by language.
TARGETS = {"en": 0.5, "fr": 0.18, "de": 0.18, "es": 0.14}
# Some stages have no SQL form: the classifier is learned, and rates come from an iteration.
ORACLE_SQL = None


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rule ensemble scores below its threshold go. A row without a text is scored as an empty one."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = "_score"
    while score.lower() in {c.lower() for c in docs.columns}:
        score += "_"
    return quality.scored(docs, model, out=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id; rows without an id all stay."""
    return jaccard.without_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go; those without words stay."""
    return fmindex.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are repeated so that the languages' expected shares of words meet the targets; none is dropped."""
    labelled = mixing.languages(spark, sf_dir, docs)
    if labelled.where("domain is not null").isEmpty():
        return docs
    # Only the languages that have a target are asked for, so their number is that of the targets.
    known = {r[0] for r in labelled.select("domain").where(F.col("domain").isin(list(TARGETS))).distinct().collect()}
    targets = {d: w for d, w in TARGETS.items() if d in known}
    if not targets:
        return docs
    mix, _ = mixing.fit_mix(docs, labelled, targets, low=1.0)
    repeated = mix.apply(docs).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return repeated.select("row.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, and what reading them back gives per row."""
    import public_tokenizers

    folder = shared_folder(spark, "tokens")
    files = stored(tokens.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json")), "tokens-log")
    return tokens.read_tokens(files, folder, with_ids=False).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality classifier", reject_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix_languages),
    ("token files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
