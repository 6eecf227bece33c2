"""Packed blocks: how the numpy operators hand many small keys to a shuffle.

A map task sorts its keys by bucket and sends one row per bucket with the keys as bytes; a reduce task unpacks all
rows of its buckets into arrays. Texts are named by 16-byte digests, listed once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGEST = 16


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    out = np.ones(len(columns[0]), bool)
    if len(out) > 1:
        out[1:] = columns[0][1:] != columns[0][:-1]
        for c in columns[1:]:
            out[1:] |= c[1:] != c[:-1]
    return out


def slices(first: np.ndarray) -> Iterator[tuple[int, int]]:
    """(begin, end) of the runs that ``changes`` marks."""
    cuts = np.flatnonzero(first).tolist()
    return zip(cuts, [*cuts[1:], len(first)], strict=False)


def expand(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``count`` numbers, one run after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits of a well mixed hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    for a, b in slices(changes(sorted_bucket)):
        yield int(sorted_bucket[a]), [c[order[a:b]] for c in columns]


def used(refs: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, bytes]:
    """References into only those names that occur, and the names."""
    own, inverse = np.unique(refs, return_inverse=True)
    return inverse.astype(np.uint32), names[own].tobytes()


class Names:
    """Numbers, in the order of the names, for digests that arrive in many blocks; kept as one array."""

    def __init__(self, blocks: list[bytes]):
        every = np.frombuffer(b"".join(blocks), f"S{DIGEST}")
        own, self.inverse = np.unique(every, return_inverse=True)
        self.inverse = self.inverse.astype(np.int32)
        self.listed = own.tobytes()
        self.starts = np.cumsum([0, *(len(b) // DIGEST for b in blocks)])

    def __len__(self) -> int:
        return len(self.listed) // DIGEST

    def block(self, i: int) -> np.ndarray:
        """The numbers of the names of block ``i``."""
        return self.inverse[self.starts[i] : self.starts[i + 1]]

    def __getitem__(self, number: int) -> bytes:
        return self.listed[number * DIGEST : (number + 1) * DIGEST]

    def array(self) -> np.ndarray:
        return np.frombuffer(self.listed, f"V{DIGEST}")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Places of the keys that occur more than once, in the order of the keys."""
    order = np.argsort(keys, kind="stable")
    new = changes(keys[order])
    alone = new & np.concatenate([new[1:], np.ones(min(1, len(new)), bool)])
    return order[~alone]


def dealt(blocks: DataFrame, buckets: int) -> DataFrame:
    """Each bucket in a task of its own."""
    return blocks.repartitionById(buckets, F.col("bucket"))


def concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def grouped_positions(owner: np.ndarray, position: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(owner, its positions) for parallel arrays."""
    order = np.lexsort((position, owner))
    owner, position = owner[order], position[order]
    for a, b in slices(changes(owner)):
        yield int(owner[a]), position[a:b]


def rows(schema: pa.Schema, data: list[tuple], most: int = 4096) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(data), most):
        columns = list(zip(*data[i : i + most], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
