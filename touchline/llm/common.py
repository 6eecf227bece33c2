"""Shared folders, memory of tasks, word hashing in numpy, and connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import shared_root

# Word separators as a byte table: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
PRIME = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 21


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent and the master is local, a temporary folder takes its place.
    """
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a shared folder and read it back: lineage ends at the files."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return memory that this process has freed to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, beginning and ending with :func:`give_back`.

    A Python worker goes on to further tasks, and would else hold the most that any of its tasks took beside the next one's.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return work


# ---------------------------------------------------------------------------------------------------------------
# Words as 64-bit hashes
# ---------------------------------------------------------------------------------------------------------------


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """256 codes: 0 for separators, else byte + 1; with ``lower`` A-Z count as a-z."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] += np.uint64(32)
    table[list(separators)] = 0
    return table


SPLIT_EXACT = byte_table(BLANKS, lower=False)
SPLIT_LOWER = byte_table(BLANKS, lower=True)
# Everything in ASCII but digits and letters separates.
SPLIT_ALNUM = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a run of texts: hashes, byte places in the joined buffer, and each text's first word."""

    def __init__(self, buffer: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
        self.buffer, self.hashes, self.starts, self.ends, self.first = buffer, hashes, starts, ends, first


class Hasher:
    """Hash the words of many texts at once: differences of one running polynomial sum over the bytes.

    The multiplier is odd, so its powers have inverses modulo 2**64 and a word's hash does not depend on its place.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                size = (n >> 18) + 1 << 18
                steps = np.full(size, PRIME, np.uint64)
                steps[0] = 1
                self.powers = np.cumprod(steps, dtype=np.uint64)
                steps[1:] = np.uint64(pow(PRIME, -1, 1 << 64))
                self.inverse = np.cumprod(steps, dtype=np.uint64)

    def words(self, texts: list[bytes]) -> Words:
        buffer = b" ".join(texts) + b" "
        self._grow(len(buffer) + 1)
        codes = self.table[np.frombuffer(buffer, np.uint8)]
        inside = codes != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edges = np.concatenate([[0], edges])
        starts, ends = edges[0::2], edges[1::2]
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(codes * self.powers[: len(buffer)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts])
        places = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return Words(buffer, hashes, starts, ends, np.searchsorted(starts, places))


def chunks_of(texts: list[bytes], most: int = CHUNK_BYTES):
    """Runs of texts of about ``most`` bytes as (first, after last); one longer text is a run of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive hashes: position-dependent, by doubling."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, size, base = None, 0, hashes, 1, np.uint64(0xD6E8FEB86659FD93)
    factor = int(base)
    left = width
    while True:
        if left & 1:
            part = power[done : done + n]
            out = part.copy() if out is None else out * np.uint64(pow(int(base), size, 1 << 64)) + part
            done += size
        left >>= 1
        if not left:
            return mix(out)
        power = power[:-size] * np.uint64(factor) + power[size:]
        factor = factor * factor % (1 << 64)
        size *= 2


def runs_inside(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of the ``n - width + 1`` runs of words lie within one text; ``first`` as in :class:`Words`."""
    owner = np.zeros(n + 1, np.int64)
    np.add.at(owner, first[1:-1], 1)
    owner = np.cumsum(owner)[:n]
    return owner[: n - width + 1] == owner[width - 1 :] if n >= width else np.zeros(0, bool)


# ---------------------------------------------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest id reachable from each node of ``links`` (a long, b long), as (node, component).

    Alternates the large-star and small-star steps until nothing changes. Each step is a grouped minimum and a
    join, so a node with very many links stays spread by partial aggregation; each round ends in a written table.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
