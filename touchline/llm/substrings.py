"""Substring dedup by seed and extend.

A window is ``length`` consecutive words of one text. Its anchor is the smallest hash among its runs of
``anchor_words`` words (winnowing), so equal windows have equal anchors at the same place. The steps:

1. every text sends its anchors; anchors that occur at two places anywhere are the seeds;
2. only around seeds, a text sends the hashes of the windows that the anchor stands for, that is the match extended
   to both sides as far as the anchor reaches; windows found at two places are repeats;
3. runs of overlapping repeated windows are the maximal repeats, and their words go.

Occurrences of an anchor are compared by sorting hashes, never pair by pair, so a passage that a third of all texts
share costs as much as its occurrences. Equal texts are handled once under their digest; all their windows are
repeats. Texts meet by digest after one row per digest is kept in each map task.

Defined results: null, empty and short texts have nothing removed; a window that starts twice in the same text is a
repeat; repeated rows and ids stay rows; other columns are ignored; an empty table gives no rows. Windows are
compared by 64-bit hashes within 64-bit anchors.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.blocks import DIGEST, Names, buckets_of, by_bucket, changes, concat, dealt, expand, grouped_positions, repeated, rows, used
from touchline.llm.common import SPLIT_EXACT, Hasher, Words, chunks_of, partitions, rolling, runs_inside, stored

PLACE_BITS = 28  # words of one chunk: a chunk is 2 MB of texts or one text


def window_anchors(words: Words, length: int, anchor_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor place, anchor hash) of each run of windows with the same anchor."""
    n = len(words.hashes)
    inside = runs_inside(words.first, length, n)
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    grams = rolling(words.hashes, anchor_words)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    # Smallest key of each `span` neighbours, by doubling.
    span, width, least = length - anchor_words + 1, 1, key
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        rest = span - width
        least = np.minimum(least[: len(least) - rest], least[rest:])
    window = np.flatnonzero(inside)
    place = (least[window] & low).astype(np.int64)
    head = np.flatnonzero(changes(place, window - np.arange(len(window))))
    count = np.diff(np.concatenate([head, [len(window)]]))
    return window[head], count, place[head], grams[place[head]]


def _runs(texts: Iterator[tuple[bytes, bytes]], hasher: Hasher):
    """(digests as an array, texts, words) for chunks of texts."""
    pending: list[tuple[bytes, bytes]] = []

    def flush():
        for a, b in chunks_of([t for _, t in pending]):
            part = pending[a:b]
            names = np.frombuffer(b"".join(d for d, _ in part), f"V{DIGEST}")
            yield names, hasher.words([t for _, t in part])
        pending.clear()

    for pair in texts:
        pending.append(pair)
        if len(pending) >= 512:
            yield from flush()
    yield from flush()


ANCHORS = pa.schema([("bucket", pa.int32()), ("hash", pa.binary()), ("place", pa.binary()), ("ref", pa.binary()), ("names", pa.binary())])
WINDOWS = pa.schema([*ANCHORS, pa.field("count", pa.binary()), pa.field("windows", pa.binary())])
FOUND = pa.schema([("name", pa.binary()), ("places", pa.binary())])


def send_anchors(length: int, anchor_words: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]):
        hasher, seen = Hasher(SPLIT_EXACT), set()

        def fresh():
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if text and name not in seen:
                        seen.add(name)
                        yield name, text

        for names, words in _runs(fresh(), hasher):
            _, _, place, mark = window_anchors(words, length, anchor_words)
            ref = np.searchsorted(words.first, place, side="right") - 1
            place = place - words.first[ref]
            out = []
            for bucket, (h, p, r) in by_bucket(buckets_of(mark, buckets), mark, place, ref):
                r, own = used(r, names)
                out.append((bucket, h.tobytes(), p.astype(np.uint32).tobytes(), r.tobytes(), own))
            yield from rows(ANCHORS, out)

    return send


def _received(batches: Iterator[pa.RecordBatch]) -> tuple[Names, list[dict]]:
    blocks = [row for batch in batches for row in batch.to_pylist()]
    return Names([row.pop("names") for row in blocks]), blocks


def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors at two places, as places per text."""
    names, blocks = _received(batches)
    hashes = concat([np.frombuffer(row["hash"], np.uint64) for row in blocks], np.uint64)
    places = concat([np.frombuffer(row["place"], np.uint32) for row in blocks], np.uint32)
    owners = concat([names.block(i)[np.frombuffer(row["ref"], np.uint32)] for i, row in enumerate(blocks)], np.int32)
    yield from _repeated(names, hashes, owners, places)


def _repeated(names: Names, hashes: np.ndarray, owner: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = repeated(hashes)
    hashes, owner, place = hashes[order], owner[order], place[order]
    order = np.lexsort((place, owner, hashes))
    hashes, owner, place = hashes[order], owner[order], place[order]
    fresh = changes(hashes, owner, place)  # a text that several tasks sent is one text
    hashes, owner, place = hashes[fresh], owner[fresh], place[fresh]
    new = changes(hashes)
    twice = ~(new & np.concatenate([new[1:], np.ones(min(1, len(new)), bool)]))
    found = [(names[o], p.astype(np.uint32).tobytes()) for o, p in grouped_positions(owner[twice], place[twice])]
    yield from rows(FOUND, found)


def send_windows(length: int, anchor_words: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]):
        hasher, seeds_of = Hasher(SPLIT_EXACT), {}

        def texts():
            for batch in batches:
                for name, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    seeds_of[name] = np.frombuffer(b"".join(places), np.uint32)
                    yield name, text

        for names, words in _runs(texts(), hasher):
            window, count, place, mark = window_anchors(words, length, anchor_words)
            wanted = [seeds_of.pop(n.tobytes()).astype(np.int64) + words.first[i] for i, n in enumerate(names)]
            keep = np.isin(place, concat(wanted, np.int64))
            window, count, mark = window[keep], count[keep], mark[keep]
            ref = np.searchsorted(words.first, window, side="right") - 1
            full = rolling(words.hashes, length)
            out = []
            for bucket, (w, c, r) in by_bucket(buckets_of(mark, buckets), window, count, ref):
                every = expand(w, c)
                start = (w - words.first[r]).astype(np.uint32)
                r, own = used(r, names)
                out.append((bucket, b"", start.tobytes(), r.tobytes(), own, c.astype(np.uint16).tobytes(), full[every].tobytes()))
            yield from rows(WINDOWS, out)

    return send


def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows at two places, as places per text."""
    names, blocks = _received(batches)
    counts = [np.frombuffer(row["count"], np.uint16).astype(np.int64) for row in blocks]
    hashes = concat([np.frombuffer(row["windows"], np.uint64) for row in blocks], np.uint64)
    starts = (np.frombuffer(row["place"], np.uint32).astype(np.int64) for row in blocks)
    places = concat([expand(s, c).astype(np.uint32) for s, c in zip(starts, counts, strict=True)], np.uint32)
    refs = (names.block(i)[np.frombuffer(row["ref"], np.uint32)] for i, row in enumerate(blocks))
    owners = concat([np.repeat(r, c) for r, c in zip(refs, counts, strict=True)], np.int32)
    yield from _repeated(names, hashes, owners, places)


def _gathered(found: DataFrame) -> DataFrame:
    return found.groupBy("name").agg(F.collect_list("places").alias("places"))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + length, n), -1)
    return np.cumsum(edges[:n]) > 0


CLEANED = "name binary, n_words bigint, n_removed bigint, kept binary, spans array<struct<start:int,end:int>>"
CLEANED_ARROW = pa.schema(
    [
        ("name", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def clean(length: int, digest_only: bool):
    """Remove the words of repeats; ``kept`` is the remaining text, or with ``digest_only`` its SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for name, text, copies, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = (text or b"").split()
                n = len(own)
                starts = np.frombuffer(b"".join(places or ()), np.uint32).astype(np.int64)
                if copies > 1 and n >= length:
                    starts = np.arange(0, n - length + 1, dtype=np.int64)
                spans = []
                if len(starts):
                    gone = covered(starts, length, n)
                    own = list(itertools.compress(own, (~gone).tolist()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
                kept = b" ".join(own)
                out.append((name, n, n - len(own), hashlib.sha256(kept).digest() if digest_only else kept, spans))
            yield from rows(CLEANED_ARROW, out)

    return run


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = 35, anchor_words: int = 12, digest_only: bool = False
) -> DataFrame:
    """``docs`` with n_words, n_removed, kept (see :func:`clean`) and the removed word spans of each row.

    A column of ``docs`` with one of these names gives way to the result.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    value = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    named = docs.select(F.struct(*docs.columns).alias("row"), F.unhex(F.md5(value)).alias("name"))
    given = docs.select(F.unhex(F.md5(value)).alias("name"), value.alias("text"))
    texts = given.groupBy("name").agg(F.first("text").alias("text"), F.count("*").alias("copies"))

    blocks = given.mapInArrow(send_anchors(length, anchor_words, buckets), _ddl(ANCHORS))
    found = stored(dealt(blocks, buckets).mapInArrow(seeds, _ddl(FOUND)), "seeds")
    seeded = texts.join(_gathered(found), "name").select("name", "text", "places")
    blocks = seeded.mapInArrow(send_windows(length, anchor_words, buckets), _ddl(WINDOWS))
    again = stored(dealt(blocks, buckets).mapInArrow(repeats, _ddl(FOUND)), "repeats")
    cleaned = texts.join(_gathered(again), "name", "left").select("name", "text", "copies", "places")
    cleaned = cleaned.mapInArrow(clean(length, digest_only), CLEANED)
    results = [c for c in cleaned.columns if c != "name"]
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in results]
    return named.join(cleaned, "name").select(*own, *results)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cleaned = remove_repeats(docs, digest_only=True)
    return cleaned.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))
