"""Secret scans over an incremental ledger of content-addressed texts.

Every version of every file is a row (path, text). A text's address is its SHA-256, so equal versions are one
blob. The ledger holds one row per (blob, rule, rule version) that was scanned, with the spans found, also when
there are none. A scan looks only at blobs that still miss a rule version, appends to the ledger, and joins the
findings back to all paths. All of it is DataFrame functions.

Defined results: a null text counts as the empty text; a null path stays a row; repeated rows stay repeated;
other columns are ignored; an empty table gives no rows; spans are [start, end) in code points.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import shared_folder

SPANS = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; with ``group``, only those whose group has ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}:{self.version}"


# The patterns of the three base kinds. A run of 20 or 24 characters is written into the pattern
# where that selects the same runs; the assigned value is measured after the match.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES


def spans_of(text: Column, rule: Rule) -> Column:
    """All spans of a rule: the pieces between matches and the matches alternate, so their lengths give the places."""
    pattern = F.lit(rule.pattern)
    found = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"), F.split(text, rule.pattern, -1).alias("gap")
    )

    def place(x: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.element_at(x["gap"], i))
            end = start + F.length(F.element_at(x["hit"], i))
            keep = F.lit(True)
            if rule.group:
                keep = F.length(F.regexp_extract(F.element_at(x["hit"], i), rule.pattern, rule.group)) >= rule.least
            span = F.struct(start.alias("start"), end.alias("end"))
            out = F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
            return F.struct(end.alias("at"), out.alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(x["hit"])), zero, step, lambda acc: acc["out"])

    # One-element array: `found` is worked out once although it is used in several places.
    placed = F.flatten(F.transform(F.array(found), place))
    return F.when(text.rlike(rule.pattern), placed).otherwise(F.array().cast(SPANS))


class Ledger:
    """The scanned (blob, rule, version) triples below a folder that driver and executors share."""

    SCHEMA = f"blob string, rule string, version int, spans {SPANS}"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, but: str | None = None) -> DataFrame:
        """All rows, or those of all batches but one."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(f"{self.SCHEMA}, batch string").parquet(self.path)
        return (rows if but is None else rows.where(F.col("batch") != but)).drop("batch")

    def unseen(self, blobs: DataFrame, rules: Sequence[Rule], batch: str | None = None) -> DataFrame:
        """Blobs that miss a rule version in all batches but ``batch``, with the missing ones in ``pending``."""
        wanted = F.array(*[F.lit(r.key) for r in rules])
        seen = (
            self.read(but=batch)
            .groupBy("blob")
            .agg(F.collect_set(F.concat_ws(":", "rule", F.col("version").cast("string"))).alias("seen"))
        )
        left = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "blob", "left").withColumn("pending", left).where(F.size("pending") > 0).drop("seen")

    def scan(self, files: DataFrame, rules: Sequence[Rule], batch: str | None = None) -> None:
        """Scan what is new in ``files`` (blob, text) and write it as one batch.

        Without a name it is a batch of its own; a repeated name replaces that batch, whose files are not read then.
        """
        batch = uuid.uuid4().hex if batch is None else batch
        blobs = files.groupBy("blob").agg(F.first("text").alias("text"))
        todo = self.unseen(blobs, rules, batch)
        results = F.array(
            *[
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.lit(r.version).alias("version"),
                    F.when(F.array_contains("pending", r.key), spans_of(F.col("text"), r)).alias("spans"),
                )
                for r in rules
            ]
        )
        found = todo.select("blob", F.inline(results)).where("spans is not null")
        found.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """One row per blob: a column of spans per rule, at the asked versions."""
        asked = self.read().where(
            F.concat_ws(":", "rule", F.col("version").cast("string")).isin([r.key for r in rules])
        )
        picked = [F.first(F.when(F.col("rule") == r.name, F.col("spans")), ignorenulls=True).alias(r.name) for r in rules]
        return asked.groupBy("blob").agg(*picked)


def scan_secrets(
    files: DataFrame, path_col: str, text_col: str, ledger_dir: str, rules: Sequence[Rule] = RULES, batch: str | None = None
) -> DataFrame:
    """Findings of every path: (path, blob, one span array per rule). Scans only what the ledger lacks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = files.select(F.col(path_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))
    ledger = Ledger(files.sparkSession, ledger_dir)
    ledger.scan(rows.select("blob", "text"), rules, batch)
    return rows.select("path", "blob").join(ledger.findings(rules), "blob")


def span_text(rules: Sequence[Rule]) -> Column:
    """kind:start:end of the given rules by start, then in the order of the rules."""

    def named(place: int, rule: Rule) -> Column:
        return F.transform(
            F.col(rule.name),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end"), F.lit(rule.name).alias("name")
            ),
        )

    every = F.flatten(F.array(*[named(i, r) for i, r in enumerate(rules)]))
    return F.array_join(
        F.transform(
            F.array_sort(every),
            lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op8_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_secrets(docs, "doc_id", "text", shared_folder(spark, "ledger"))
    base = span_text(BASE_RULES)
    return found.select(
        F.col("path").alias("doc_id"),
        *[F.size(r.name).cast("long").alias(f"n_{r.name}") for r in BASE_RULES],
        F.sha2(base, 256).alias("base_sha256"),
        span_text(RULES).alias("spans"),
    )
