"""Quality classifier: a sparse ensemble of rules over text statistics.

Text statistics are column functions. On a bounded sample of labelled rows (``SAMPLE_ROWS``, the rows with the
smallest hashes of their ids) small regression trees are boosted on the driver; every path from a root to a node is
a rule, a conjunction of comparisons. A lasso-penalised logistic regression over the rules keeps few of them. The
kept rules and weights become one column expression, which scores every row of any table in the scan's stage.

Defined results: a null text counts as empty and gets a score; null ids are never used for training and count as
held out; several labels of an id are several training rows; rows without a label or with a null label do not
train; repeated rows and other columns stay; without labelled rows of both kinds, or without a statistic
that parts them, the score is the share of label 1 (one half without any).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ROWS = 10_000
THRESHOLD = 0.3
FEATURES = ("chars", "words", "word_length", "distinct_words", "distinct_lines", "upper", "marks", "symbols", "digits", "wide")


def statistics(text: Column) -> list[Column]:
    """The statistics of a text, in the order of ``FEATURES``; shares of an empty text are 0."""
    t = F.coalesce(text, F.lit(""))
    chars = F.length(t)
    words = F.split(F.trim(t), r"[ \t\n\x0B\f\r]+", -1)
    lines = F.split(t, "\n", -1)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    def often(pattern: str) -> Column:
        return F.regexp_count(t, F.lit(pattern))

    values = [
        F.log1p(chars),
        F.log1p(F.size(words)),
        share(chars, F.size(words)),
        share(F.size(F.array_distinct(words)), F.size(words)),
        share(F.size(F.array_distinct(lines)), F.size(lines)),
        share(often(r"\p{Lu}"), chars),
        share(often(r"[!|#$%&*@^~<>=]"), chars),
        share(often(r"[^\p{L}\p{N}\s]"), chars),
        share(often(r"[0-9]"), chars),
        share(F.octet_length(t) - chars, chars),
    ]
    return [v.cast("double").alias(name) for v, name in zip(values, FEATURES, strict=True)]


@dataclass(frozen=True)
class Rule:
    """A conjunction of (feature number, is greater, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def applies(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, above, cut in self.terms:
            out &= (x[:, f] > cut) == above
        return out

    def column(self, value: Callable[[str], Column]) -> Column:
        out = F.lit(True)
        for f, above, cut in self.terms:
            out = out & ((value(FEATURES[f]) > cut) if above else (value(FEATURES[f]) <= cut))
        return out


@dataclass
class RuleModel:
    base: float = 0.0
    weights: list[float] = field(default_factory=list)
    rules: list[Rule] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for w, r in zip(self.weights, self.rules, strict=True):
            total += w * r.applies(x)
        return 1 / (1 + np.exp(-total))

    def score(self, value: Callable[[str], Column] = F.col) -> Column:
        """The score over values named as ``FEATURES``, by default columns."""
        total = F.lit(float(self.base))
        for w, r in zip(self.weights, self.rules, strict=True):
            total = total + F.when(r.column(value), F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow(x: np.ndarray, residual: np.ndarray, depth: int, cuts: list[np.ndarray], least: int = 20):
    """Paths to all nodes of a regression tree, and its prediction."""
    paths, fitted = [], np.zeros(len(x))

    def split(rows: np.ndarray, path: tuple, left: int) -> None:
        if path:
            paths.append(path)
        value = residual[rows]
        best = (1e-9, None)
        if left and len(rows) >= 2 * least:
            total, n = value.sum(), len(rows)
            for f, own in enumerate(cuts):
                if not len(own):
                    continue
                slot = np.searchsorted(own, x[rows, f], side="left")
                count = np.cumsum(np.bincount(slot, minlength=len(own) + 1))[:-1]
                below = np.cumsum(np.bincount(slot, value, minlength=len(own) + 1))[:-1]
                fits = (count >= least) & (n - count >= least)
                if fits.any():
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(fits, below**2 / count + (total - below) ** 2 / (n - count) - total**2 / n, -1)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], (f, float(own[k])))
        if best[1] is None:
            fitted[rows] = value.mean()
            return
        f, cut = best[1]
        above = x[rows, f] > cut
        split(rows[~above], (*path, (f, False, cut)), left - 1)
        split(rows[above], (*path, (f, True, cut)), left - 1)

    split(np.arange(len(x)), (), depth)
    return paths, fitted


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, bins: int = 48) -> list[Rule]:
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, bins))) for f in range(x.shape[1])]
    total, rules = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        paths, fitted = grow(x, y - p, depth, cuts)
        total = total + rate * fitted / max(1e-3, float((p * (1 - p)).mean()))
        for path in paths:
            tight: dict[tuple[int, bool], float] = {}
            for f, above, cut in path:  # the tightest comparison of a kind implies the others
                tight[f, above] = (max if above else min)(cut, tight.get((f, above), cut))
            rules.setdefault(tuple(sorted((*k, v) for k, v in tight.items())), None)
    return [Rule(t) for t in rules]


def lasso(matrix: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 600) -> tuple[float, np.ndarray]:
    """Weights of a logistic regression with an absolute penalty, by accelerated proximal gradient steps."""
    n, k = matrix.shape
    spread = np.maximum(matrix.std(axis=0), 0.02)
    z = (matrix - matrix.mean(axis=0)) / spread
    limit = 0.25 * (np.linalg.norm(z, 2) ** 2 / n + 1)
    base, w = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(k)
    ahead, ahead_base, momentum = w, base, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(ahead_base + z @ ahead))) - y
        step = ahead - z.T @ error / n / limit
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / limit, 0)
        new_base = ahead_base - error.mean() / limit
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - w)
        ahead_base = new_base + (momentum - 1) / following * (new_base - base)
        w, base, momentum = new, new_base, following
    w = w / spread
    return base - float(matrix.mean(axis=0) @ w), w


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    rules = tree_rules(x, y) if len(y) and y.min() < y.max() else []
    if not rules:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return RuleModel(base=float(np.log(share / (1 - share))))
    matrix = np.column_stack([r.applies(x) for r in rules]).astype(float)
    base, weights = lasso(matrix, y)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return RuleModel(base, weights[kept].tolist(), [rules[i] for i in kept])


def held_out(key: Column) -> Column:
    """One id in five never trains: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """Fit on at most ``sample_rows`` labelled rows; their statistics (not texts) come to the driver."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_label")).where("_label is not null")
    picked = known.where(~held_out(F.col("_key"))).orderBy(F.xxhash64("_key"), "_key", "_label").limit(sample_rows)
    given = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(picked), "_key")
    rows = given.select(F.col("_label"), *statistics(F.col("_text"))).limit(4 * sample_rows).toPandas().to_numpy(float)
    rows = rows[np.lexsort(rows.T)] if len(rows) else rows.reshape(0, 1 + len(FEATURES))
    return fit(rows[:, 1:], (rows[:, 0] > 0.5).astype(float))


def scored(docs: DataFrame, model: RuleModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score as a further column.

    Every rule uses several statistics. The row number keeps a later filter on the score from moving below their
    projection, where each use would work them out again.
    """
    number = F.monotonically_increasing_id().alias("_number")
    packed = docs.select(F.struct(*docs.columns).alias("_row"), *statistics(F.col(text)), number)
    rated = packed.select("_row", F.when(F.col("_number") >= 0, model.score()).alias("_score"))
    return rated.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c != out], F.col("_score").alias(out))


def op10_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
