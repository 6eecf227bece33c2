"""Mixing documents to target weights of domains, with soft membership. DataFrame functions only.

1. Every text becomes a row of letter shares and a word count, in one scan.
2. A Gaussian naive Bayes classifier is fitted by one grouped aggregation over the rows whose domain a labelled table
   gives; its means and variances (domains x features numbers) become a column expression for domain posteriors.
3. Rates: with ``low`` above 0 the targets are first scaled to the least total that leaves them within reach. Then
   minimise the squared gap between the targets and the expected domain shares of words,
   ``sum_d rate_d * words_d * p_dk / words`` per domain k, plus a pull of each rate to 1, over rates in [low, high].
   The least point has rates ``1 + sum_k weight_k * p_dk``, cut to [low, high], so only the domains' weights are
   sought: by Newton steps, each with one aggregation to the domains' first and second moments, which bring rare and
   hot domains to one scale. The pull starts at ``PULL`` times the least share of a domain and falls until all gaps
   are within ``CLOSE``, or do not shrink any more because the bounds or the posteriors put the targets out of reach;
   :class:`Mix` tells the gaps that remain.
4. A document is taken floor(rate) times, and once more with the probability of the rest, by a hash of its id.

Defined results: a null or empty text has no words, the prior as posterior and no effect on the fit, and its rate
follows like any other; repeated rows and ids are documents of their own; a null or unknown domain does not train; a
labelled table without known domains is an error, as are targets for unknown domains; empty documents give no rows;
other columns stay.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import stored

LETTERS = "eaoiuhwkqzñü"
MAX_DOMAINS = 64
STEPS = 60
PULL = 1e-3
FALL, LEAST_PULL = 0.01, 1e-12
CLOSE = 1e-6
# Target weights of the query, by language.
TARGETS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def letter_shares(text: Column) -> list[Column]:
    """Share of each of ``LETTERS`` in the bytes of a text, and of bytes beyond ASCII's one per character."""
    size = F.octet_length(text)
    some = F.greatest(size, F.lit(1))
    out = [
        ((size - F.octet_length(F.replace(text, F.lit(c), F.lit("")))) / some).alias(f"f{i}") for i, c in enumerate(LETTERS)
    ]
    return [*out, ((size - F.length(text)) / some).alias(f"f{len(LETTERS)}")]


FEATURES = [f"f{i}" for i in range(len(LETTERS) + 1)]


def word_count(text: Column) -> Column:
    """Words between white space (blank, tab, line breaks, vertical tab, form feed); that at the ends makes none."""
    trimmed = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))).otherwise(0).cast("double")


def domain_model(rows: DataFrame, domain: str) -> list[tuple[str, float, list[float], list[float]]]:
    """(domain, log prior, means, variances), from one aggregation over the labelled rows."""
    known = rows.where(F.col(domain).isNotNull() & (F.col("words") > 0))
    stats = [x for f in FEATURES for x in (F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}"))]
    found = known.groupBy(domain).agg(F.count("*").alias("n"), *stats).orderBy(domain).limit(MAX_DOMAINS + 1).collect()
    if not found or len(found) > MAX_DOMAINS:
        raise ValueError(f"the labelled rows have {len(found) or 'no'} domains; 1 to {MAX_DOMAINS} are supported")
    total = sum(r["n"] for r in found)
    floors = [max(1e-8, 0.05 * sum(r[f"v_{f}"] * r["n"] for r in found) / total) for f in FEATURES]
    return [
        (
            str(r[domain]), math.log(r["n"] / total), [r[f"m_{f}"] for f in FEATURES],
            [r[f"v_{f}"] + low for f, low in zip(FEATURES, floors, strict=True)],
        )
        for r in found
    ]


def with_posteriors(rows: DataFrame, model: list[tuple[str, float, list[float], list[float]]], *keep: str) -> DataFrame:
    """Columns ``p0``, ``p1``, ... with the domains' posteriors in the order of the model, beside those to keep."""
    logs = []
    for k, (_, prior, means, variances) in enumerate(model):
        fit = F.lit(prior)
        for f, m, v in zip(FEATURES, means, variances, strict=True):
            fit = fit - ((F.col(f) - m) * (F.col(f) - m) / (2 * v) + 0.5 * math.log(v))
        logs.append(F.when(F.col("words") > 0, fit).otherwise(F.lit(prior)).alias(f"l{k}"))
    names = [f"l{k}" for k in range(len(model))]
    rows = rows.select(*keep, *logs)
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    rows = rows.select(*keep, *names, top.alias("top"))
    rows = rows.select(*keep, *[F.exp(F.col(n) - F.col("top")).alias(n) for n in names])
    rows = rows.select(*keep, *names, sum((F.col(n) for n in names[1:]), F.col(names[0])).alias("total"))
    return rows.select(*keep, *[(F.col(n) / F.col("total")).alias(f"p{k}") for k, n in enumerate(names)])


def free_rate(weights: list[float]) -> Column:
    """The rate before it is cut to its bounds, over the columns ``p0``, ..."""
    return sum((F.lit(float(w)) * F.col(f"p{i}") for i, w in enumerate(weights)), F.lit(1.0))


def rate_of(weights: list[float], low: float, high: float) -> Column:
    return F.least(F.greatest(free_rate(weights), F.lit(float(low))), F.lit(float(high)))


@dataclass(frozen=True)
class Mix:
    """A fitted mix: the domains' models, their weights in the rates, and expected share minus target per domain."""

    model: list
    weights: list
    gaps: list
    low: float
    high: float

    @property
    def domains(self) -> list[str]:
        return [m[0] for m in self.model]

    def rate(self) -> Column:
        """Rate over the posterior columns."""
        return rate_of(self.weights, self.low, self.high)

    def apply(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of ``docs`` as a struct ``row``, with ``rate`` and ``copies``; one more scan, no join."""
        value = F.coalesce(F.col(text), F.lit(""))
        whole = docs.select(F.struct(*docs.columns).alias("row"), word_count(value).alias("words"), *letter_shares(value))
        rated = with_posteriors(whole, self.model, "row").select("row", self.rate().alias("rate"))
        return rated.withColumn("copies", copies(F.col("rate"), F.col(f"row.`{key}`")))


def copies(rate: Column, key: Column) -> Column:
    """floor(rate), and one more with the probability of the rest, by a hash of the id."""
    chance = F.pmod(F.xxhash64(key), F.lit(1 << 32)) / F.lit(float(1 << 32))
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("bigint")


def moments(rows: DataFrame, weights: np.ndarray, low: float, high: float, total: float) -> tuple[float, np.ndarray, np.ndarray]:
    """(value, slope, curvature) of the rates' potential at some weights: the slope has the expected shares, the curvature the
    second moments of the rows whose rate is free."""
    k, p = len(weights), [F.col(f"p{i}") for i in range(len(weights))]
    at = rows.select("words", *p, free_rate(weights).alias("free"))
    at = at.select("*", F.least(F.greatest("free", F.lit(float(low))), F.lit(float(high))).alias("rate"))
    inside = F.when(F.col("free") == F.col("rate"), F.col("words")).otherwise(0.0)
    at = at.select(*p, (F.col("words") * F.col("rate")).alias("mass"), inside.alias("inside"), "rate", "free")
    found = at.agg(
        F.sum(F.col("mass") * (F.col("free") - F.col("rate") / 2)).alias("value"),
        *[F.sum(F.col("mass") * p[i]).alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col("inside") * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)],
    ).first()
    slope = np.array([found[f"s{i}"] or 0.0 for i in range(k)]) / total
    curve = np.array([[found[f"g{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]) / total
    return (found["value"] or 0.0) / total, slope, curve


def fit_rates(
    rows: DataFrame, targets: list[float], steps: int = STEPS, pull: float = PULL, low: float = 0.0, high: float = 1e6,
    close: float = CLOSE,
) -> tuple[list, list]:
    """(weight of each domain, expected share minus target of each) for the rates of ``rows`` (words, p0, p1, ...).

    Ends when all gaps are ``close``, when a smaller pull does not shrink them, or after ``steps`` aggregations.
    """
    k = len(targets)
    first = rows.agg(F.sum("words").alias("words"), *[F.sum(F.col("words") * F.col(f"p{i}")).alias(f"s{i}") for i in range(k)]).first()
    total = first["words"] or 1.0
    shares = np.array([first[f"s{i}"] or 0.0 for i in range(k)]) / total
    # Rates of at least `low` need so many words in all that no domain exceeds its target.
    goal = np.array(targets) * max([1.0, *(low * s / t for s, t in zip(shares, targets, strict=True) if t > 0)])
    if not shares.any():
        return [0.0] * k, (-goal).tolist()
    pull *= min(1.0, shares[shares > 0].min())
    weights, left, best = np.zeros(k), steps - 1, None
    value, slope, curve = moments(rows, weights, low, high, total)
    while True:
        # The least point for this pull: the slope of value - goal * weights + pull / 2 * weights ** 2 is 0.
        height = lambda v, w: v - goal @ w + pull / 2 * (w @ w)
        while left > 0:
            off = slope - goal + pull * weights
            if np.abs(off).max() <= close / 10:
                break
            # Scaled to a diagonal of ones, small domains count like large ones.
            scale = 1 / np.sqrt(np.diag(curve) + pull)
            scaled = (curve + pull * np.eye(k)) * np.outer(scale, scale)
            move, length = -scale * np.linalg.lstsq(scaled, scale * off, rcond=None)[0], 1.0
            while left > 0:
                tried = weights + length * move
                found = moments(rows, tried, low, high, total)
                left -= 1
                least = height(value, weights) + 1e-4 * length * (off @ move)
                if height(found[0], tried) <= least or np.abs(found[1] - goal + pull * tried).max() <= close / 10:
                    weights, (value, slope, curve) = tried, found
                    break
                length /= 4
        gaps = slope - goal
        gap = np.abs(gaps).max()
        better = best is None or gap < 0.5 * best[0]
        if best is None or gap < best[0]:
            best = gap, weights, gaps
        if gap <= close or not better or left <= 0 or pull * FALL < LEAST_PULL:
            return best[1].tolist(), best[2].tolist()
        pull *= FALL


def fit_mix(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], key: str = "doc_id", text: str = "text",
    domain: str = "domain", steps: int = STEPS, low: float = 0.0, high: float = 1e6,
) -> tuple[Mix, DataFrame]:
    """A mix, and the table (key, words, p0, p1, ...) it was fitted on; ``labelled`` gives the domains of some keys.

    The posteriors are in the order of the sorted domain names. Targets are normalised to sum 1.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stored(docs.select(F.col(key).alias("key"), word_count(value).alias("words"), *letter_shares(value)), "letters")
    known = labelled.select(F.col(key).alias("key"), F.col(domain).alias("domain")).where("domain is not null").distinct()
    model = domain_model(rows.join(known, "key"), "domain")
    names = [m[0] for m in model]
    if set(targets) - set(names):
        raise ValueError(f"targets for unknown domains: {sorted(set(targets) - set(names))}")
    whole = sum(targets.values())
    soft = stored(with_posteriors(rows, model, "key", "words"), "posteriors")
    weights, gaps = fit_rates(soft, [targets.get(n, 0.0) / whole for n in names], steps, low=low, high=high)
    return Mix(model, weights, gaps, low, high), soft


def languages(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """The labelled table of the query: the language of those documents that ``labels`` covers."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels, "doc_id", "left_semi")


def op4_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mix, soft = fit_mix(docs, languages(spark, sf_dir, docs), TARGETS)
    p = [F.col(f"p{i}") for i in range(len(mix.domains))]
    top = F.greatest(*p)
    domain = F.coalesce(*[F.when(x == top, F.lit(d)) for x, d in zip(p, mix.domains, strict=True)])
    rated = soft.withColumn("rate", mix.rate())
    return rated.select(
        F.col("key").alias("doc_id"), F.col("words").cast("bigint").alias("n_words"), domain.alias("domain"),
        top.alias("posterior"), "rate", copies(F.col("rate"), F.col("key")).alias("copies"),
    )
