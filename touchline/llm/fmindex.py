"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents of about ``SHARD_WORDS`` words from one input partition. Its word sequence, with a
terminator after every document, is sorted into a suffix array by prefix doubling; the Burrows-Wheeler transform is
kept as a wavelet matrix with rank directories, together with every 16th suffix position. Test phrases are found by
backward search, all phrases of a shard at once, and located by walking back to a sampled position. Nothing but
the input is read and nothing is shuffled: a lost task is simply run again.

Defined results: null and empty texts have no words and no hits; equal texts of a shard are indexed once and
reported for each row; repeated and null document ids stay rows of their own; items without words never occur;
a null item id counts as the empty string; other columns are ignored; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
import io
import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from touchline.llm.common import SPLIT_ALNUM, Hasher, chunks_of, released, stored

SHARD_WORDS = 1 << 20
SAMPLE = 16
# Bytes of benchmark text that the driver holds and sends at once; a larger benchmark is searched in blocks.
PHRASE_BYTES = 8 << 20


class BitRank:
    """A bit vector with the number of ones before each 64-bit word."""

    def __init__(self, words: np.ndarray, before: np.ndarray):
        self.words, self.before = words, before

    @classmethod
    def of(cls, bits: np.ndarray) -> BitRank:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        counts = np.cumsum(np.bitwise_count(words), dtype=np.uint32)
        return cls(words, np.concatenate([np.zeros(1, np.uint32), counts[:-1]]))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6].astype(np.int64) + np.bitwise_count(self.words[at >> 6] & below)


class WaveletMatrix:
    """Symbols as bit planes from the highest bit down; each plane's zeros go first in the next one."""

    def __init__(self, planes: list[BitRank], zeros: np.ndarray, length: int):
        self.planes, self.zeros, self.length = planes, zeros, length

    @classmethod
    def of(cls, symbols: np.ndarray, depth: int) -> WaveletMatrix:
        planes, zeros, now = [], [], symbols.astype(np.uint32)
        for level in range(depth - 1, -1, -1):
            bits = (now >> np.uint32(level)) & np.uint32(1) != 0
            planes.append(BitRank.of(bits))
            low = np.compress(~bits, now)
            zeros.append(len(low))
            now = np.concatenate([low, np.compress(bits, now)])
        return cls(planes, np.array(zeros, np.int64), len(symbols))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start, depth = np.zeros(len(at), np.int64), len(self.planes)
        for level, plane in enumerate(self.planes):
            one = (symbol >> (depth - 1 - level)) & 1 != 0
            a, b = plane.ones(start), plane.ones(at)
            start = np.where(one, self.zeros[level] + a, start - a)
            at = np.where(one, self.zeros[level] + b, at - b)
        return at - start

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        symbol, start, depth = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), len(self.planes)
        for level, plane in enumerate(self.planes):
            one = plane.get(at)
            symbol |= one.astype(np.int64) << (depth - 1 - level)
            a, b = plane.ones(start), plane.ones(at)
            start = np.where(one, self.zeros[level] + a, start - a)
            at = np.where(one, self.zeros[level] + b, at - b)
        return symbol, at - start


def suffix_ranks(rank: np.ndarray) -> np.ndarray:
    """Rank of each suffix by prefix doubling; ``rank`` holds the place of the first suffix with the same first symbol.

    Only suffixes that are still tied are sorted again. Two ranks and a place share one integer while they fit.
    """
    n, width = len(rank), 1
    bits = max(1, n.bit_length())
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        behind = tied + width
        second = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        if 3 * bits <= 62:
            key = np.sort((rank[tied] << (2 * bits)) | (second << bits) | tied)
            tied = key & ((1 << bits) - 1)
            key >>= bits
        else:
            key = (rank[tied] << bits) | second
            order = np.argsort(key, kind="stable")
            tied, key = tied[order], key[order]
        group = key >> bits
        at = np.arange(len(tied))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new_group, at, 0))
        first = np.maximum.accumulate(np.where(new_key, at, 0))
        rank[tied] = group + first - head
        alone = new_key & np.concatenate([new_key[1:], [True]])
        tied = tied[~alone]
        width *= 2
    return rank


class ShardIndex:
    """FM-index of a list of documents given as word hashes and the place of each document's first word."""

    def __init__(self, vocab, first, counts, wavelet, marks, samples):
        self.vocab, self.first, self.counts = vocab, first, counts
        self.wavelet, self.marks, self.samples = wavelet, marks, samples

    @classmethod
    def of(cls, hashes: np.ndarray, first: np.ndarray) -> ShardIndex:
        docs, words = len(first) - 1, len(hashes)
        vocab, symbol, often = np.unique(hashes, return_inverse=True, return_counts=True)
        # The text with terminators: word i of document d stands at i + d.
        ends = first[1:] + np.arange(docs)
        text = np.zeros(words + docs, np.int64)
        inner = np.ones(words + docs, bool)
        inner[ends] = False
        text[inner] = symbol + 1
        counts = np.concatenate([[0, docs], docs + np.cumsum(often)]).astype(np.int64)
        rank = counts[text]
        rank[ends] = np.arange(docs)
        rank = suffix_ranks(rank)
        place = np.empty(words + docs, np.int64)
        place[rank] = np.arange(words + docs)
        before = np.where(place > 0, text[place - 1], 0)
        marked = (place % SAMPLE == 0) | (before == 0)
        depth = max(1, int(len(vocab)).bit_length())
        return cls(
            vocab, first, counts, WaveletMatrix.of(before, depth), BitRank.of(marked), place[marked].astype(np.uint32)
        )

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase; phrases are rows of word hashes, filled from the right."""
        symbol = np.searchsorted(self.vocab, phrases)
        known = symbol < len(self.vocab)
        known[known] = self.vocab[symbol[known]] == phrases[known]
        symbol = symbol + 1
        width = phrases.shape[1]
        used = np.arange(width)[None, :] >= width - lengths[:, None]
        alive = np.flatnonzero((known | ~used).all(axis=1) & (lengths > 0))
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        high[alive] = self.wavelet.length
        for column in range(width - 1, -1, -1):
            now = alive[lengths[alive] >= width - column]
            if not len(now):
                break
            s = symbol[now, column]
            low[now] = self.counts[s] + self.wavelet.rank(s, low[now])
            high[now] = self.counts[s] + self.wavelet.rank(s, high[now])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, word offset) of the suffix in each row."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            open_ = open_[~self.marks.get(at[open_])]
            if not len(open_):
                break
            symbol, before = self.wavelet.step(at[open_])
            at[open_] = self.counts[symbol] + before
            steps[open_] += 1
        place = self.samples[self.marks.ones(at)].astype(np.int64) + steps
        starts = self.first[:-1] + np.arange(len(self.first) - 1)
        doc = np.searchsorted(starts, place, side="right") - 1
        return doc, place - starts[doc]

    def dump(self) -> bytes:
        out = io.BytesIO()
        planes = self.wavelet.planes
        np.savez(
            out, vocab=self.vocab, first=self.first, counts=self.counts, zeros=self.wavelet.zeros,
            length=self.wavelet.length, planes=np.array([p.words for p in planes]),
            before=np.array([p.before for p in planes]), marks=self.marks.words, marks_before=self.marks.before,
            samples=self.samples,
        )
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> ShardIndex:
        x = np.load(io.BytesIO(data))
        planes = [BitRank(w, b) for w, b in zip(x["planes"], x["before"], strict=True)]
        wavelet = WaveletMatrix(planes, x["zeros"], int(x["length"]))
        return cls(x["vocab"], x["first"], x["counts"], wavelet, BitRank(x["marks"], x["marks_before"]), x["samples"])


class Phrases:
    """Distinct windows of the items' words, and which items hold each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = [name for name, _ in items]
        words = Hasher(SPLIT_ALNUM).words([text for _, text in items])
        owners: dict[tuple, set[int]] = {}
        for i in range(len(items)):
            own = words.hashes[words.first[i] : words.first[i + 1]].tolist()
            for k in range(max(1, len(own) - window + 1)) if own else ():
                owners.setdefault(tuple(own[k : k + window]), set()).add(i)
        self.lengths = np.array([len(k) for k in owners], np.int64)
        self.rows = np.zeros((len(owners), window), np.uint64)
        for r, k in enumerate(owners):
            self.rows[r, window - len(k) :] = k
        self.owners = [sorted(v) for v in owners.values()]

    def hits(self, index: ShardIndex) -> dict[int, tuple[list[tuple[int, int]], list[str]]]:
        """For each document with occurrences its merged word spans and the names of the items."""
        low, high = index.search(self.rows, self.lengths)
        often = high - low
        phrase = np.repeat(np.arange(len(often)), often)
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(often)[:-1]]), often) + np.arange(len(phrase))
        doc, start = index.locate(rows.astype(np.int64))
        out: dict[int, tuple[list, set]] = {}
        for k in np.lexsort((start, doc)).tolist():
            spans, names = out.setdefault(int(doc[k]), ([], set()))
            begin, end = int(start[k]), int(start[k] + self.lengths[phrase[k]])
            if spans and begin <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
            else:
                spans.append((begin, end))
            names.update(self.owners[phrase[k]])
        return {d: (spans, sorted({self.names[i] for i in names})) for d, (spans, names) in out.items()}


def shards(batches: Iterator[pa.RecordBatch], most: int = SHARD_WORDS) -> Iterator[tuple[list, list[int], ShardIndex]]:
    """(document keys, place of each one's text, index) per shard; batches have a key and a binary text column."""
    hasher = Hasher(SPLIT_ALNUM)
    keys, texts, where, seen, parts, first = [], [], [], {}, [], [0]

    def flush_texts() -> None:
        for a, b in chunks_of(texts):
            words = hasher.words(texts[a:b])
            parts.append(words.hashes)
            first.extend((words.first[1:] + first[-1]).tolist())
        texts.clear()

    def result():
        flush_texts()
        return keys[:], where[:], ShardIndex.of(np.concatenate([np.zeros(0, np.uint64), *parts]), np.array(first))

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or b""
            mark = hashlib.blake2b(text, digest_size=16).digest()
            keys.append(key)
            if mark not in seen:
                seen[mark] = len(seen)
                texts.append(text)
            where.append(seen[mark])
            if sum(map(len, texts[-1:])) > 1 << 20 or len(texts) >= 256:
                flush_texts()
            if first[-1] >= most or len(keys) >= most:
                yield result()
                keys, where, seen, parts, first = [], [], {}, [], [0]
    if keys:
        yield result()


def _given(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, str]:
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")), kind


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard: keys, the place of each key's text, and the index. Write it to search it again later."""
    given = _given(docs, key, text)
    fields = T.StructType.fromDDL("places array<int>, index binary").fields
    schema = T.StructType([T.StructField("keys", T.ArrayType(docs.schema[key].dataType)), *fields])
    arrow = to_arrow_schema(schema)

    def build(batches):
        for keys, places, index in shards(batches, shard_words):
            yield pa.RecordBatch.from_pylist([{"keys": keys, "places": places, "index": index.dump()}], arrow)

    return given.mapInArrow(build, schema)


def phrase_blocks(items: DataFrame, key: str, text: str, window: int, most: int | None = None) -> Iterator[Phrases]:
    """The benchmark's windows in blocks of bounded size, read one partition at a time."""
    block, size, most = [], 0, most or PHRASE_BYTES
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    for name, words in rows.toLocalIterator():
        words = words.encode()
        if block and size + len(words) > most:
            yield Phrases(block, window)
            block, size = [], 0
        block.append((name, words))
        size += len(words)
    yield Phrases(block, window)


FOUND = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def _found(keys: list, places: list[int], index: ShardIndex, phrases: Phrases, arrow: pa.Schema, *more: list) -> pa.RecordBatch:
    hits = phrases.hits(index)
    lengths = np.diff(index.first)
    spans = [[{"start": a, "end": b} for a, b in hits.get(p, ((), ()))[0]] for p in places]
    columns = [keys, lengths[np.array(places, np.int64)].tolist(), spans, [hits.get(p, ((), []))[1] for p in places], *more]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _result(kind: T.DataType, more: str = "") -> T.StructType:
    return T.StructType([T.StructField("key", kind), *T.StructType.fromDDL(FOUND + more).fields])


def _given(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))


def find_contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = 13, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document: key, n_words, merged hit spans [start, end) in words, and the items that occur in it.

    A window is ``window`` consecutive words of an item, or the whole of a shorter item. The documents are indexed
    and searched in the same pass. For a benchmark above ``PHRASE_BYTES`` the index is written once and searched
    for one block of items after the other, and the findings of a document are merged.
    """
    blocks = phrase_blocks(items, item_key, item_text, window)
    phrases, more = next(blocks), next(blocks, None)
    if more is not None:
        return _in_blocks(docs, itertools.chain([phrases, more], blocks), key, text, shard_words)
    schema = _result(docs.schema[key].dataType)
    arrow = to_arrow_schema(schema)

    def search(batches):
        for keys, places, index in shards(batches, shard_words):
            yield _found(keys, places, index, phrases, arrow)

    return _given(docs, key, text).mapInArrow(released(search), schema)


def _in_blocks(docs: DataFrame, blocks: Iterator[Phrases], key: str, text: str, shard_words: int) -> DataFrame:
    index = build_index(docs, key, text, shard_words).withColumn("shard", F.monotonically_increasing_id())
    index = stored(index, "fm-index")
    parts = [stored(search_index(index, phrases), "fm-found") for phrases in blocks]
    every = reduce(lambda a, b: a.unionByName(b), parts)
    together = every.groupBy("shard", "at").agg(
        F.first("key").alias("key"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    schema = _result(docs.schema[key].dataType)
    arrow = to_arrow_schema(schema)

    def merge(batches):
        for batch in batches:
            rows = [{**row, "spans": merged(row["spans"])} for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return together.select("key", "n_words", "spans", "items").mapInArrow(merge, schema)


def merged(spans: list[dict]) -> list[dict]:
    """Sorted spans without overlaps."""
    out: list[dict] = []
    for s in spans:
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    return out


def search_index(index: DataFrame, phrases: Phrases) -> DataFrame:
    """The same rows from a written index with shard numbers, and each row's ``shard`` and place ``at`` in it."""
    schema = _result(index.schema["keys"].dataType.elementType, ", shard bigint, at int")
    arrow = to_arrow_schema(schema)

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["keys"])
                numbers = [row["shard"]] * n, list(range(n))
                yield _found(row["keys"], row["places"], ShardIndex.load(row["index"]), phrases, arrow, *numbers)

    return index.select("keys", "places", "index", "shard").mapInArrow(search, schema)


def judged(found: DataFrame) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated: at least one hit word, and one word in twenty hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).select(
        F.col("key").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated; whole rows pass through the search, so ids need not be unique."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    found = find_contamination(rows, items, key="row")
    return judged(found).where(~F.col("contaminated")).select("doc_id.*")


def op9_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))
