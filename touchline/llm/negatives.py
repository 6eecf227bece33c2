"""Hard negatives: rows of another label that score close to, but safely below, an anchor's positives.

Tasks write the rows as shard files of integer vectors in the shared folder. Anchors are clustered by angle (spherical
k-means on at most ``SAMPLE_ANCHORS`` of them; the clusters steer the work, not the result), put in order of cluster
and angle by a range partitioning, and cut into blocks of at most ``BLOCK`` members of one cluster. A cell is a block
and a part of the shards; each is one row of a table, so Spark deals cells out over tasks and repeats a lost one.

In a cell, each shard's candidates are sorted once by an upper bound that holds for every member of the block:
``|item| * cos(max(0, angle(item, centre) - widest member angle))``. All members walk that one list in steps; a member
leaves it as soon as its own norm times the bound of the next step is below what it still needs, which certifies that
no unseen row counts. Bounds found in one shard serve in the next. The first pass finds the positives among rows of the
anchor's label, the second the negatives in the windows that the positives' scores open. Partial lists of the cells are
merged by score and id.

Defined results: rows with a null label or vector, or a null, NaN or infinite component, take no part. A component x
becomes floor(scale * x). Ties go to the smaller id, null ids last; a null id is never an anchor. A row is excluded as
its own positive by its place, so rows that repeat an id are others, and an anchor each. A vector shorter than another
counts as filled up with zeros. Scores that a 64-bit integer cannot hold are kept at its ends. Empty tables, and anchors
without positives, give no rows. Other columns are ignored.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.blocks import changes
from touchline.llm.common import shared_folder, stored
from touchline.llm.warc import open_folder

SCALE = 256
SHARD_ROWS = 1 << 13
SHARD_VALUES = 1 << 22
BLOCK = 512
SAMPLE_ANCHORS = 4096
CLUSTERS = 256
ROUNDS = 10
STEP = 512
# Products of one cell: a few minutes of work.
CELL_PRODUCTS = 1 << 33
LOW, HIGH = -(1 << 63), (1 << 63) - 1

LOG = "shard string, n bigint, place array<int>, id array<bigint>, label array<bigint>, vector array<array<bigint>>"
FOUND = "block string, member int, slot int, anchor_id bigint, score bigint, id bigint"


# ---------------------------------------------------------------------------------------------------------------
# Files of rows
# ---------------------------------------------------------------------------------------------------------------


class Rows:
    """Integer vectors with ids and labels, in the order of the labels; shorter vectors are filled up with zeros."""

    def __init__(self, vector: np.ndarray, id: np.ndarray, unnamed: np.ndarray, label: np.ndarray, own: np.ndarray):
        self.vector, self.id, self.unnamed, self.label, self.own = vector, id, unnamed, label, own
        self.norm = np.sqrt((vector.astype(np.float64) ** 2).sum(1))

    def __len__(self) -> int:
        return len(self.id)

    def write(self, folder: str) -> str:
        """The file's name, which no other attempt uses."""
        name, data = uuid.uuid4().hex, io.BytesIO()
        np.savez(data, vector=self.vector, id=self.id, unnamed=self.unnamed, label=self.label, own=self.own)
        system, inner = open_folder(folder)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{name}.npz") as out:
            out.write(data.getbuffer())
        return name

    @staticmethod
    def read(folder: str, name: str) -> Rows:
        system, inner = open_folder(folder)
        with system.open_input_stream(f"{inner}/{name}.npz") as source, np.load(io.BytesIO(source.read())) as data:
            return Rows(*(data[k] for k in ("vector", "id", "unnamed", "label", "own")))


def least_type(values: np.ndarray) -> np.ndarray:
    for kind in (np.int16, np.int32):
        if not len(values) or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def rectangle(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Vectors of given sizes as rows of one array."""
    width = int(sizes.max()) if len(sizes) else 0
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def floors(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        whole = np.floor(scale * values.astype(np.float64))
    inside = np.clip(whole, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    return np.where(whole >= 2.0**63, HIGH, inside)


def _shard_writer(folder: str, scale: float, every: int):
    def close(parts: list[tuple], count: int) -> dict:
        flat, sizes, ids, unnamed, labels = (np.concatenate(c) for c in zip(*parts, strict=True))
        vector = least_type(rectangle(floors(flat, scale), sizes))
        order = np.argsort(labels, kind="stable")
        rows = Rows(vector[order], ids[order], unnamed[order], labels[order], np.arange(count))
        name = rows.write(folder)
        place = np.flatnonzero(~rows.unnamed & (rows.id % every == 0))
        return {
            "shard": name, "n": count, "place": place, "id": rows.id[place], "label": rows.label[place],
            "vector": list(rows.vector[place].astype(np.int64)),
        }

    kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]

    def row(parts: list[tuple], count: int) -> pa.RecordBatch:
        out = close(parts, count)
        return pa.RecordBatch.from_arrays([pa.array([out[k]], t) for k, t in zip(out, kinds, strict=True)], list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, count, values = [], 0, 0
        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                part = batch.slice(begin, STEP)
                ids, labels, vectors = part.columns
                sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = vectors.flatten().to_numpy(zero_copy_only=False)
                unnamed = ids.is_null().to_numpy(zero_copy_only=False)
                parts.append((flat, sizes, ids.fill_null(0).to_numpy(zero_copy_only=False), unnamed, labels.to_numpy()))
                count, values = count + part.num_rows, values + len(flat)
                if count >= SHARD_ROWS or values >= SHARD_VALUES:
                    yield row(parts, count)
                    parts, count, values = [], 0, 0
        if count:
            yield row(parts, count)

    return run


# ---------------------------------------------------------------------------------------------------------------
# Clusters of anchors
# ---------------------------------------------------------------------------------------------------------------


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    norm = np.sqrt((vectors**2).sum(1))
    return vectors / np.where(norm == 0, 1, norm)[:, None]


def fitted(a: np.ndarray, width: int) -> np.ndarray:
    """Rows filled up with zeros, or cut where only zeros are wanted, to ``width`` columns."""
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def centres_of(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from evenly spaced starts; an empty cluster keeps its centre."""
    points = unit(vectors)
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        filled = np.bincount(nearest, minlength=k) > 0
        centres = np.where(filled[:, None], unit(sums), centres)
    return centres


def _assigner(centres: np.ndarray):
    """Anchors of the log as rows with their cluster and their angle to its centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, _, place, ids, labels, vectors = (c[i].as_py() for c in batch.columns)
                if not ids:
                    continue
                points = unit(rectangle(np.concatenate([np.array(v, np.int64) for v in vectors]), np.array([len(v) for v in vectors])))
                width = max(points.shape[1], centres.shape[1])
                near = fitted(points, width) @ fitted(centres, width).T
                cluster = near.argmax(1)
                angle = np.arccos(np.clip(near.max(1), -1, 1))
                columns = [pa.array([shard] * len(ids)), pa.array(place, pa.int32()), pa.array(ids, pa.int64()), pa.array(labels, pa.int64()),
                           pa.array(vectors, pa.list_(pa.int64())), pa.array(cluster, pa.int32()), pa.array(angle, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "id", "label", "vector", "cluster", "angle"])

    return run


def _block_writer(folder: str):
    """Blocks of members of one cluster: (block, members, cluster); ``own`` holds the members' places in their shards."""

    def written(rows: list[tuple]) -> pa.RecordBatch:
        shards, place, ids, labels, vectors, cluster = zip(*rows, strict=True)
        vector = rectangle(np.concatenate([np.array(v, np.int64) for v in vectors]), np.array([len(v) for v in vectors]))
        names = Rows(least_type(vector), np.array(ids), np.zeros(len(ids), bool), np.array(labels), np.array(place)).write(folder)
        columns = [pa.array([names]), pa.array([list(shards)], pa.list_(pa.string())), pa.array([cluster[0]], pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["block", "shards", "cluster"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (len(rows) >= BLOCK or rows[-1][-1] != row[-1]):
                    yield written(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield written(rows)

    return run


# ---------------------------------------------------------------------------------------------------------------
# Walks
# ---------------------------------------------------------------------------------------------------------------


class Best:
    """The first ``k`` rows of every (member, window) so far: by score, then id, null ids last.

    A window takes scores from ``low`` to ``high``; ``need`` is the least score that can still enter one.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.least = low.copy()  # raised to the k-th score
        self.slot = np.zeros(0, np.int64)  # member * windows + window
        self.score, self.id, self.unnamed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.settle()

    def settle(self) -> None:
        open_window = self.low <= self.high
        self.need = np.where(open_window, self.least, HIGH).min(1)
        self.most = np.where(open_window, self.high, LOW).max(1)
        self.idle = ~open_window.any(1)

    def add(self, member: np.ndarray, score: np.ndarray, id: np.ndarray, unnamed: np.ndarray) -> None:
        windows = self.low.shape[1]
        slots, scores, ids, nulls = [self.slot], [self.score], [self.id], [self.unnamed]
        for w in range(windows):
            fits = (score >= self.least[member, w]) & (score <= self.high[member, w])
            slots.append(member[fits] * windows + w)
            scores.append(score[fits])
            ids.append(id[fits])
            nulls.append(unnamed[fits])
        slot, score, id, unnamed = (np.concatenate(x) for x in (slots, scores, ids, nulls))
        order = np.lexsort((id, unnamed, ~score, slot))  # ~x = -x - 1 turns the order without overflow
        slot = slot[order]
        starts = np.flatnonzero(changes(slot)) if len(slot) else np.zeros(0, np.int64)
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        full = slot[place == self.k - 1]
        self.least.reshape(-1)[full] = score[last]
        self.slot, self.score, self.id, self.unnamed = slot[place < self.k], score[kept], id[kept], unnamed[kept]
        self.settle()


def products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products; ``largest`` bounds them. Floating point is exact up to its mantissa, integers beyond it."""
    for kind, limit in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if largest < limit:
            return a.astype(kind) @ b.astype(kind).T
    if largest < 2.0**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, LOW, HIGH).astype(np.int64)


def walk(members: Rows, which: np.ndarray, centre: np.ndarray, items: Rows, of: np.ndarray, best: Best, but=None, other_label=False) -> None:
    """The members ``which`` walk the items ``of`` in the order of their shared bound.

    ``but`` gives for each member the item that it must not meet (or -1); with ``other_label`` items of the member's
    label do not count.
    """
    width = max(members.vector.shape[1], items.vector.shape[1], len(centre))
    asked, listed = fitted(members.vector, width), fitted(items.vector[of], width)
    centre = np.pad(centre, (0, width - len(centre)))
    norm, size = members.norm, items.norm[of]

    def angle(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(vectors @ centre / np.where(norms == 0, 1, norms), -1, 1))

    own = angle(asked[which].astype(np.float64), norm[which])
    widest = own[norm[which] > 0].max(initial=0)
    bound = size * np.cos(np.maximum(0, angle(listed.astype(np.float64), size) - widest))
    slack = 1e-6 * size.max(initial=0)  # more than rounding can add to a bound
    order = np.argsort(-bound, kind="stable")
    at, step = 0, STEP
    while at < len(order):
        certain = norm[which] * (bound[order[at]] + slack)
        which = which[~best.idle[which] & (certain >= best.need[which])]
        if not len(which):
            return
        here = order[at : at + step]
        at, step = at + step, min(step * 2, 1 << 13)
        largest = float(norm[which].max() * size[here].max())
        score = products(asked[which], listed[here], largest)
        low, high = (np.clip(x[which], -(2**62), 2**62).astype(score.dtype) for x in (best.need, best.most))
        near = (score >= low[:, None]) & (score <= high[:, None])
        if score.dtype == np.int64:  # ends beyond 2**62
            near = (score >= best.need[which][:, None]) & (score <= best.most[which][:, None])
        if other_label:
            near &= items.label[of[here]][None, :] != members.label[which][:, None]
        row, column = np.nonzero(near)
        member, item = which[row], of[here[column]]
        score = score[row, column].astype(np.int64)
        if but is not None:
            others = but[member] != item
            member, item, score = member[others], item[others], score[others]
        if len(member):
            best.add(member, score, items.id[item], items.unnamed[item])


def _found(block: str, members: Rows, best: Best) -> pa.RecordBatch:
    member, window = np.divmod(best.slot, best.low.shape[1])
    columns = [
        pa.array([block] * len(member), pa.string()), pa.array(member, pa.int32()), pa.array(window, pa.int32()),
        pa.array(members.id[member], pa.int64()), pa.array(best.score, pa.int64()), pa.array(best.id, pa.int64(), mask=best.unnamed),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in FOUND.split(", ")])


def _positives(folder: str, centres: np.ndarray, k: int):
    """The best rows of each anchor's label in each cell (block, shards of its members, cluster, part, shards)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, homes, cluster, _, shards in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                members = Rows.read(folder, block)
                homes = np.array(homes)
                n = len(members)
                best = Best(np.full((n, 1), LOW, np.int64), np.full((n, 1), HIGH, np.int64), k)
                labels = np.unique(members.label)
                for shard in shards:
                    items = Rows.read(folder, shard)
                    but = np.where(homes == shard, members.own, -1)
                    begin, end = (np.searchsorted(items.label, labels, side) for side in ("left", "right"))
                    for label, a, b in zip(labels, begin, end, strict=True):
                        if a < b:
                            walk(members, np.flatnonzero(members.label == label), centres[cluster], items, np.arange(a, b), best, but)
                yield _found(block, members, best)

    return run


def _negatives(folder: str, centres: np.ndarray, k: int, below: tuple[int, int]):
    """The best rows of other labels in the windows of the positives' scores, which the last column holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, cluster, _, shards, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                members = Rows.read(folder, block)
                windows = max(s["slot"] for s in scores) + 1
                low, high = np.full((len(members), windows), HIGH, np.int64), np.full((len(members), windows), LOW, np.int64)
                for s in scores:  # whole numbers n with below[0] * p <= 100 * n <= below[1] * p
                    low[s["member"], s["slot"]] = -(-below[0] * s["score"] // 100)
                    high[s["member"], s["slot"]] = below[1] * s["score"] // 100
                best = Best(low, high, k)
                every = np.arange(len(members))
                for shard in shards:
                    items = Rows.read(folder, shard)
                    walk(members, every, centres[cluster], items, np.arange(len(items)), best, other_label=True)
                yield _found(block, members, best)

    return run


# ---------------------------------------------------------------------------------------------------------------
# The table
# ---------------------------------------------------------------------------------------------------------------


def _first(found: DataFrame, keys: list[str], k: int, place: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn(place, F.row_number().over(order)).where(F.col(place) <= k)


def hard_negatives(
    rows: DataFrame, id: str, label: str | Column, vector: str, every: int = 50, positives: int = 5, negatives: int = 3,
    below: tuple[int, int] = (50, 95), scale: float = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors with ids divisible by ``every``.

    A negative's score lies between the two percentages of the positive's score in ``below``.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark, "vectors")
    fine = F.forall("vector", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    given = rows.select(
        F.col(id).cast("bigint").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    shards = -(-rows.count() // SHARD_ROWS) or 1
    log = stored(given.coalesce(shards).mapInArrow(_shard_writer(folder, scale, every), LOG), "vector-log")
    anchors, n, files = log.agg(F.coalesce(F.sum(F.size("id")), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    if not anchors:
        empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], empty)

    sample = log.select(F.explode("vector").alias("vector")).orderBy(F.xxhash64("vector")).limit(SAMPLE_ANCHORS).collect()
    vectors = [np.array(r[0], np.int64) for r in sample]
    points = rectangle(np.concatenate(vectors), np.array([len(v) for v in vectors]))
    centres = centres_of(points, max(1, min(CLUSTERS, anchors // BLOCK, len(vectors))))

    assigned = log.mapInArrow(
        _assigner(centres), "shard string, place int, id bigint, label bigint, vector array<bigint>, cluster int, angle double"
    )
    in_order = stored(assigned, "anchors").repartitionByRange(-(-anchors // (8 * BLOCK)), "cluster", "angle").sortWithinPartitions("cluster", "angle")
    members = in_order.select("shard", "place", "id", "label", "vector", "cluster")
    blocks = stored(members.mapInArrow(_block_writer(folder), "block string, shards array<string>, cluster int"), "anchor-blocks")

    tasks = 3 * spark.sparkContext.defaultParallelism
    count = blocks.count()
    parts = min(files, max(-(-tasks // count), -(-BLOCK * n // CELL_PRODUCTS)))
    part = F.pmod(F.xxhash64("shard"), F.lit(parts)).cast("int").alias("part")
    by_part = stored(log.groupBy(part).agg(F.collect_list("shard").alias("listed")), "shard-parts")
    cells = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(by_part, "part")
    dealt = cells.select("block", "shards", "cluster", "part", "listed").repartition(count * parts)
    found = dealt.mapInArrow(_positives(folder, centres, positives), FOUND)
    near = stored(_first(found, ["block", "member"], positives, "place"), "positives")

    scores = near.groupBy("block").agg(F.collect_list(F.struct("member", (F.col("place") - 1).alias("slot"), "score")).alias("scores"))
    asked = cells.join(scores, "block").select("block", "cluster", "part", "listed", "scores").repartition(count * parts)
    met = asked.mapInArrow(_negatives(folder, centres, negatives, below), FOUND)
    hard = _first(met, ["block", "member", "slot"], negatives, "rank").select(
        "block", "member", (F.col("slot") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    own = near.select("block", "member", "place", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(own, ["block", "member", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, "vec_id", label, "embedding")
