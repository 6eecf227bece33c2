"""Exact top-k search by BM25: an inverted index per shard, block-max WAND, and an exact merge.

A shard holds the postings of up to ``SHARD_DOCS`` documents, ordered by id. Document count, mean length and document
frequencies are summed over all shards before any score is worked out, so the scores of all shards are comparable
and the merged top k is that of a full scan. Short queries keep one cursor per term (WAND); a document is scored only
if the terms' bounds, and then the bounds of the posting blocks around it, reach the k-th best score of the shard.
Queries above ``CURSORS`` terms add up all postings of their terms in numpy, as the bounds of so many terms pass most
documents: those of terms that are frequent both in a shard and in ``ALIKE`` queries as rounded products of matrices, for
``TOGETHER`` queries at once, the others from runs that Arrow copies out for several queries at once. The documents that come near the
k-th best of these sums, or of the scores that the same task found in other shards, are scored exactly, also for all these
queries together. All exact scores are summed in the order of the terms.

Queries are rows of the same table: a query's terms are all distinct words of its whole text, unless ``terms`` asks for
those with the largest (1 + ln tf) * idf only (ties by hash) or ``least_df`` for words that so many documents have.
Shards are files, and queries are written in packed blocks of about ``BLOCK_TERMS`` terms, each with a list of its distinct
terms and with queries of the same frequent terms side by side; each pair of a group of up to ``GROUP`` shards and a block is
a row of paths, whose task reads one after the other.

Defined results: null, empty and wordless texts are in no postings but count as documents of length 0, and as
queries find nothing; a null id is no query; equal scores go by ascending id, null ids last; repeated rows are documents of their own;
rows of one id are one query; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import io
import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.blocks import buckets_of, by_bucket, changes, concat, dealt, expand, rows, slices
from touchline.llm.common import SPLIT_ALNUM, Hasher, chunks_of, mix, partitions, released, shared_folder, stored
from touchline.llm.warc import open_folder

SHARD_DOCS = 8192
SHARD_WORDS = 5 << 20
BLOCK_TERMS = 1 << 20
BLOCK = 64
GROUP = 16
ALIKE = 512  # queries that share a matrix of frequent terms
OFTEN = 100  # what adding a posting by itself costs, in multiplications of such a matrix
OFTEN_ENTRIES = 1 << 22  # numbers in the matrix
TOGETHER = 128
ASKED_ENTRIES = 1 << 24  # marks of asked terms, for all queries that go together
CENTERS, FEATURES, ROUNDS = 8, 256, 4
AT_ONCE = 1 << 20  # postings looked at in one step
LEVELS = (1 << 16) - 2  # of rounded scores
AGAIN = 8  # documents scored by their own postings, as a multiple of k; beyond, all are
CURSORS = 4
K1, B = 1.2, 0.75


def term_counts(texts: list[bytes], hasher: Hasher) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(distinct term hashes, their counts, words) of each text."""
    for a, b in chunks_of(texts):
        words = hasher.words(texts[a:b])
        for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            terms, counts = np.unique(words.hashes[begin:end], return_counts=True)
            yield terms, counts, end - begin


def least_type(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


class Shard:
    """Postings by term: ``docs`` and ``tf`` between ``starts``; ``keys`` and ``lengths`` per document."""

    def __init__(self, keys: list, lengths: np.ndarray, vocab: np.ndarray, starts: np.ndarray, docs: np.ndarray, tf: np.ndarray):
        self.keys, self.lengths, self.vocab, self.starts, self.docs, self.tf = keys, lengths, vocab, starts, docs, tf

    @classmethod
    def of(cls, rows: list[tuple]) -> Shard:
        """From rows (key, terms, counts, words)."""
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
        terms, tf = concat([r[1] for r in rows], np.uint64), concat([r[2] for r in rows], np.int64)
        docs = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        head = np.flatnonzero(changes(terms))
        starts = np.concatenate([head, [len(terms)]])
        lengths = np.array([r[3] for r in rows], np.int64)
        return cls([r[0] for r in rows], lengths, terms[head], starts, docs[order].astype(np.uint32), tf[order].astype(np.uint32))

    def write(self, folder: str) -> str:
        """A new file in the folder, which gets its name when whole."""
        system, inner = open_folder(folder)
        system.create_dir(inner, recursive=True)
        name = uuid.uuid4().hex
        out = io.BytesIO()
        small = {name: least_type(getattr(self, name)) for name in ("lengths", "starts", "docs", "tf")}
        known = np.array([k is not None for k in self.keys], np.bool_)
        np.savez(out, keys=np.array([k or 0 for k in self.keys], np.int64), known=known, vocab=self.vocab, **small)
        with system.open_output_stream(f"{inner}/.{name}") as file:
            file.write(out.getbuffer())
        system.move(f"{inner}/.{name}", f"{inner}/shard-{name}.npz")
        return f"{inner}/shard-{name}.npz"

    @classmethod
    def read(cls, folder: str, path: str) -> Shard:
        x = read_arrays(folder, path)
        keys = [k if known else None for k, known in zip(x["keys"].tolist(), x["known"].tolist(), strict=True)]
        return cls(keys, x["lengths"], x["vocab"], x["starts"], x["docs"], x["tf"])

    def weights(self, mean_length: float, at: np.ndarray) -> np.ndarray:
        """BM25 without the idf factor, for the postings at these places."""
        norm, tf = K1 * (1 - B + B * self.lengths / max(mean_length, 1e-9)), self.tf[at]
        return tf * (K1 + 1) / (tf + norm[self.docs[at]])

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The numbers of terms in this shard, -1 for those it lacks."""
        if not len(self.vocab):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.vocab, terms), len(self.vocab) - 1)
        return np.where(self.vocab[at] == terms, at, -1)


class Postings:
    """A shard's postings of the terms that are asked for: ``docs`` and their scores ``parts`` between ``starts``.

    ``number`` gives the place of each asked term here, -1 for those that the shard lacks.
    """

    def __init__(self, shard: Shard, vocab: np.ndarray, idf: np.ndarray, mean_length: float):
        found = shard.find(vocab)
        held = np.flatnonzero(found >= 0)
        self.number = np.full(len(vocab), -1, np.int32)
        self.number[held] = np.arange(len(held))
        starts = shard.starts.astype(np.int64)
        begin = starts[found[held]]
        self.df = starts[found[held] + 1] - begin
        self.starts = np.concatenate([[0], np.cumsum(self.df)])
        at = expand(begin, self.df)
        self.n, self.docs = len(shard.lengths), shard.docs[at]
        self.parts = shard.weights(mean_length, at) * np.repeat(idf[held], self.df)

    def cursor(self, number: int) -> Cursor:
        a, b = int(self.starts[number]), int(self.starts[number + 1])
        return Cursor(self.docs[a:b], self.parts[a:b])


def steps(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of about ``most`` in all; one entry above it is a run of its own."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def runs_of(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    """Each run of the values as one value of bytes, which Arrow copies as a whole."""
    ends = pa.py_buffer(np.ascontiguousarray(starts * values.itemsize, np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, ends, pa.py_buffer(values)])


def copied(runs: pa.Array, which: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of these runs, one run after the other, and where each begins and ends."""
    kind = np.dtype(kind)
    if not len(which):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, ends, data = runs.take(pa.array(which)).buffers()
    return np.frombuffer(data, kind), np.frombuffer(ends, np.int64, len(which) + 1) // kind.itemsize


class Sums:
    """Scores of a shard's documents for queries of many terms.

    Sums of all but the exact scores are rounded; all addends are positive, so the exact one times ``low`` is no more than
    the sum. Scores of postings outside of the matrix are rounded up to multiples of ``unit``, so ``low`` times a sum, less a
    unit for each of their terms, is no more than the exact one.
    """

    def __init__(self, own: Postings):
        self.own, self.n = own, own.n
        # Each term's documents and rounded scores side by side, and the terms of each document, in their order.
        self.unit = float(own.parts.max(initial=0)) / LEVELS or 1.0
        self.pair = np.dtype([("part", np.uint16), ("doc", np.uint16 if self.n <= 1 << 16 else np.uint32)])
        pairs = np.empty(len(own.docs), self.pair)
        pairs["part"], pairs["doc"] = np.ceil(own.parts / self.unit), own.docs
        self.of_term = runs_of(own.starts, pairs)
        self.order = np.argsort(own.docs, kind="stable").astype(np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(own.docs, minlength=self.n))])
        self.of_doc = runs_of(self.first, np.repeat(np.arange(len(own.df), dtype=np.int32), own.df)[self.order])
        self.together = max(1, min(TOGETHER, ASKED_ENTRIES // max(len(own.df), 1)))
        self.asked = np.zeros(self.together * len(own.df), bool)
        self.choose(np.zeros(0, np.int64), 0)

    def choose(self, terms: np.ndarray, queries: int) -> None:
        """The matrix of the terms that are frequent both in these queries and in the documents."""
        own, most = self.own, OFTEN_ENTRIES // max(self.n, 1)
        cost = np.bincount(terms, minlength=len(own.df)) * own.df
        often = np.flatnonzero((cost * OFTEN >= self.n * queries) & (cost > 0))
        if len(often) > most:
            often = often[np.argsort(-cost[often], kind="stable")[:most]]
        self.row = np.full(len(own.df), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.table = np.zeros((len(often), self.n), np.float32)
        at = expand(own.starts[often], own.df[often])
        self.table[np.repeat(np.arange(len(often)), own.df[often]), own.docs[at]] = own.parts[at]
        self.low = 1 / (1 + 1e-9 + 4 * (len(often) + 8) * 2.0**-24)

    def rounded(self, terms: np.ndarray, owner: np.ndarray, queries: int) -> tuple[np.ndarray, np.ndarray]:
        """The rounded scores of all documents for some queries, and the most that each query's are rounded up.

        ``owner`` numbers the query of each term, in ascending order.
        """
        row = self.row[terms]
        often = row >= 0
        factors = np.zeros((queries, len(self.table)), np.float32)
        factors[owner[often], row[often]] = 1
        sums = factors @ self.table
        others, owner = terms[~often], owner[~often]
        first = np.searchsorted(owner, np.arange(queries + 1))
        for a, b in steps(np.bincount(owner, self.own.df[others], queries), AT_ONCE):
            data, ends = copied(self.of_term, others[first[a] : first[b]], self.pair)
            for i in range(a, b):
                run = data[ends[first[i] - first[a]] : ends[first[i + 1] - first[a]]]
                if len(run):
                    sums[i] += np.bincount(run["doc"], run["part"], self.n) * self.unit
        return sums, np.diff(first) * self.unit

    def exact(self, owner: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of documents from their own postings, each for the query that ``owner`` numbers among those marked."""
        begin, scores = self.first[docs], np.zeros(len(docs))
        count, marks = self.first[docs + 1] - begin, (owner * len(self.own.df)).astype(np.int32)
        for a, b in steps(count, AT_ONCE):
            terms, ends = copied(self.of_doc, docs[a:b], np.int32)
            hit = np.flatnonzero(self.asked[np.repeat(marks[a:b], count[a:b]) + terms])
            pair = np.searchsorted(ends, hit, "right") - 1
            at = self.order[hit + (begin[a:b] - ends[:-1])[pair]]
            scores[a:b] = np.bincount(pair, self.own.parts[at], b - a)
        return scores

    def exact_by_term(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The same for very many documents of a query, from all postings of its terms."""
        at = expand(self.own.starts[terms], self.own.df[terms])
        return np.bincount(self.own.docs[at], self.own.parts[at], self.n)[docs]

    def best(self, terms: np.ndarray, owner: np.ndarray, bars: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, documents, scores) of the k best for each query that finds any, best first, without those that score below its bar."""
        (sums, over), bars = self.rounded(terms, owner, len(bars)), bars.copy()
        for i in np.flatnonzero(bars == 0) if self.n > k else ():
            bars[i] = max(np.partition(sums[i], -k)[-k] * self.low - over[i], 0)
        near = np.maximum((bars * self.low).astype(np.float32), LEAST)
        query, docs = np.divmod(np.flatnonzero(sums >= near[:, None]), self.n)
        many = np.bincount(query, minlength=len(bars)) > AGAIN * k
        scores, few = np.zeros(len(docs)), ~many[query]
        marks = owner * len(self.own.df) + terms
        self.asked[marks] = True
        scores[few] = self.exact(query[few], docs[few])
        self.asked[marks] = False
        for a, b in slices(changes(query)) if len(query) else ():
            i = int(query[a])
            if many[i]:
                scores[a:b] = self.exact_by_term(terms[owner == i], docs[a:b])
            order = a + np.argsort(-scores[a:b], kind="stable")[:k]
            order = order[scores[order] >= bars[i]]
            yield i, docs[order], scores[order]


class Cursor:
    """A place in one term's postings, with the largest score of the term and of each block."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray):
        self.docs, self.scores, self.at = array("I", docs.astype(np.uint32).tobytes()), array("d", scores.tobytes()), 0
        self.block_max = np.maximum.reduceat(scores, np.arange(0, len(scores), BLOCK)).tolist()
        self.block_last = [*docs[BLOCK - 1 : -1 : BLOCK].tolist(), int(docs[-1])]
        self.most = max(self.block_max)
        self.doc = int(docs[0])

    def move(self, doc: int) -> None:
        """To the first posting at ``doc`` or later."""
        self.at = bisect_left(self.docs, doc, self.at)
        self.doc = self.docs[self.at] if self.at < len(self.docs) else END

    def next(self) -> None:
        self.at += 1
        self.doc = self.docs[self.at] if self.at < len(self.docs) else END

    def block(self, doc: int) -> tuple[float, int]:
        """(largest score, last document) of the block that would hold ``doc``."""
        i = bisect_left(self.block_last, doc, self.at // BLOCK)
        return (self.block_max[i], self.block_last[i]) if i < len(self.block_last) else (0.0, END - 1)


def read_arrays(folder: str, path: str):
    with open_folder(folder)[0].open_input_file(path) as file:
        return np.load(io.BytesIO(file.read()))


END = 1 << 60
LEAST = np.finfo(np.float32).tiny
BY_DOC, BY_RANK = attrgetter("doc"), attrgetter("rank")
SLACK = 1 + 1e-9  # bounds are summed in another order than scores


def top_documents(cursors: list[Cursor], k: int) -> list[tuple[float, int]]:
    """The k best (score, document), best first, equal scores by ascending document; block-max WAND."""
    live = list(cursors)
    for rank, c in enumerate(live):
        c.rank = rank
    heap: list[tuple[float, int]] = []  # (score, -document): the worst kept one first
    bar = 0.0
    while live:
        live.sort(key=BY_DOC)
        while live and live[-1].doc == END:
            live.pop()
        total, pivot = 0.0, -1
        for i, c in enumerate(live):
            total += c.most
            if total * SLACK > bar:
                pivot = i
                break
        if pivot < 0:
            break
        doc = live[pivot].doc
        while pivot + 1 < len(live) and live[pivot + 1].doc == doc:
            pivot += 1
        ahead = live[: pivot + 1]
        if bar:
            blocks = [c.block(doc) for c in ahead]
            if sum(m for m, _ in blocks) * SLACK <= bar:
                following = min(last for _, last in blocks) + 1
                if pivot + 1 < len(live):
                    following = min(following, live[pivot + 1].doc)
                for c in ahead:
                    c.move(max(following, doc + 1))
                continue
        if ahead[0].doc == doc:
            if len(ahead) > 1:
                ahead.sort(key=BY_RANK)
            score = 0.0
            for c in ahead:
                score += c.scores[c.at]
                c.next()
            # Documents come in ascending order, so an equal later score does not displace a kept one.
            if len(heap) < k:
                heapq.heappush(heap, (score, -doc))
            elif score > bar:
                heapq.heapreplace(heap, (score, -doc))
            if len(heap) == k:
                bar = heap[0][0]
        else:
            for c in ahead:
                if c.doc < doc:
                    c.move(doc)
    return sorted(((s, -d) for s, d in heap), key=lambda x: (-x[0], x[1]))


def build_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per written shard: the path of its file, documents and words in all, and the folder."""
    schema = pa.schema([("shard", pa.string()), ("docs", pa.int64()), ("words", pa.int64())])
    folder = shared_folder(docs.sparkSession, "shards")

    def build(batches: Iterator[pa.RecordBatch]):
        hasher, found_rows, size = Hasher(SPLIT_ALNUM), [], 0

        def shard():
            own = Shard.of(found_rows)
            return pa.RecordBatch.from_pylist(
                [{"shard": own.write(folder), "docs": len(own.keys), "words": int(own.lengths.sum())}], schema
            )

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [t or b"" for t in part.column(1).to_pylist()]
                for k, found in zip(part.column(0).to_pylist(), term_counts(texts, hasher), strict=True):
                    found_rows.append((k, *found))
                    size += found[2]
                    if len(found_rows) >= shard_docs or size >= SHARD_WORDS:
                        yield shard()
                        found_rows, size = [], 0
        if found_rows:
            yield shard()

    given = docs.select(F.col(key).cast("bigint"), F.col(text).cast("binary"))
    written = stored(given.mapInArrow(released(build), "shard string, docs bigint, words bigint"), "shards-log")
    return written.withColumn("folder", F.lit(folder))


def document_frequencies(shards: DataFrame) -> DataFrame:
    """(term, df) over all shards."""

    def count(batches: Iterator[pa.RecordBatch]):
        for row in (row for batch in batches for row in batch.to_pylist()):
            x = read_arrays(row["folder"], row["shard"])
            vocab, df = x["vocab"], np.diff(x["starts"].astype(np.int64))
            for i in range(0, len(df), 1 << 16):
                terms = vocab[i : i + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df[i : i + (1 << 16)])], names=["term", "df"])

    given = spread(shards.select("shard", "folder"))
    return given.mapInArrow(released(count), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def spread(paths: DataFrame) -> DataFrame:
    """Rows that name files are few and short; what is done with them goes to all tasks."""
    return paths.repartition(partitions(paths.sparkSession))


def query_terms(queries: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query, term, tf) for each distinct word of each query."""

    def split(batches: Iterator[pa.RecordBatch]):
        hasher = Hasher(SPLIT_ALNUM)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for k, (terms, counts, _) in zip(batch.column(0).to_pylist(), term_counts(texts, hasher), strict=True):
                columns = [pa.array([k] * len(terms), pa.int64()), pa.array(terms.view(np.int64)), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "term", "tf"])

    given = queries.select(F.col(key).cast("bigint"), F.col(text).cast("binary"))
    return given.mapInArrow(released(split), "query bigint, term bigint, tf bigint")


def search(shards: DataFrame, queries: DataFrame, k: int = 10, terms: int | None = None, least_df: int = 1) -> DataFrame:
    """(query, rank, doc_id, score): the k best documents of each query; ``queries`` as by :func:`query_terms`."""
    size = shards.agg(F.sum("docs").alias("n"), F.sum("words").alias("words"), F.count("*").alias("shards")).first()
    n, mean_length = size["n"] or 0, (size["words"] or 0) / max(size["n"] or 0, 1)
    # The frequencies are by far larger than the list of shard files they come from, by which Spark would judge them.
    frequent = document_frequencies(shards).where(F.col("df") >= least_df)
    chosen = queries.where("query is not null").join(frequent.hint("merge"), "term").withColumn(
        "idf", F.log1p((F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    )
    if terms is not None:
        best = Window.partitionBy("query").orderBy(F.desc((1 + F.log("tf")) * F.col("idf")), "term")
        chosen = chosen.withColumn("place", F.row_number().over(best)).where(F.col("place") <= terms)
    asked = stored(chosen.groupBy("query").agg(F.collect_set(F.struct("term", "idf")).alias("terms")), "queries")
    blocks, buckets = query_blocks(asked), partitions(queries.sparkSession)
    listed = blocks.agg(F.count("*").alias("n"), (F.max("block_number") + 1).alias("end")).first()
    group = min(GROUP, max(1, 2 * size["shards"] * listed["n"] // buckets))
    groups = -(-size["shards"] // group) or 1
    grouped = shard_groups(shards, groups)
    bucket = (F.col("number") * (listed["end"] or 1) + F.col("block_number")).cast("int").alias("bucket")
    pairs = grouped.crossJoin(blocks).select(bucket, "shards", "folder", "block", "block_folder")
    found = _searched(dealt(pairs, groups * (listed["end"] or 1)), k, mean_length, buckets)
    return dealt(found, buckets).mapInArrow(released(best_of_shards(k)), "query bigint, rank int, doc_id bigint, score double")


def shard_groups(shards: DataFrame, groups: int) -> DataFrame:
    """(number, folder, shards): the paths of the shards of each group; groups hold as many shards and about as many documents.

    The window is over the short list of files.
    """
    number = (F.row_number().over(Window.orderBy(F.desc("docs"), "shard")) - 1) % groups
    return shards.withColumn("number", number).groupBy("number", "folder").agg(F.sort_array(F.collect_list("shard")).alias("shards"))


def side_by_side(counts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """An order of queries by the nearest of a few centers, over the terms that most queries have, and by length.

    Results do not depend on it. ``places`` are terms by number, ``counts`` those of each query.
    """
    often = np.bincount(places)
    common = np.argsort(-often, kind="stable")[:FEATURES]
    column = np.full(len(often), -1, np.int32)
    column[common] = np.arange(len(common))
    found, owner = column[places], np.repeat(np.arange(len(counts)), counts)
    near = np.zeros((len(counts), len(common)), np.float32)
    near[owner[found >= 0], found[found >= 0]] = 1
    near /= np.maximum(np.linalg.norm(near, axis=1, keepdims=True), 1)
    centers = near[:: max(1, len(near) // CENTERS)][:CENTERS].copy()
    for _ in range(ROUNDS):
        group = np.argmax(near @ centers.T, axis=1)
        for c in range(len(centers)):
            middle = near[group == c].sum(axis=0)
            centers[c] = middle / max(np.linalg.norm(middle), 1e-9)
    return np.lexsort((counts, group))


def query_blocks(asked: DataFrame) -> DataFrame:
    """(number, path) of files that each hold a block of the queries: names, number of terms, and the terms by their
    places (ascending) in a list of the block's distinct terms with their idf."""
    spark = asked.sparkSession
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 1) // BLOCK_TERMS)
    folder = shared_folder(spark, "query-blocks")

    def write(batches: Iterator[pa.RecordBatch]):
        system, inner = open_folder(folder)
        parts: dict[int, list[tuple]] = {}
        for batch in batches:
            found = batch.column(2)
            ends = np.asarray(found.offsets)
            values = found.values
            every, idf = values.field(0).to_numpy(), values.field(1).to_numpy()
            for row, (bucket, name) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                own = every[ends[row] : ends[row + 1]].view(np.uint64)
                order = np.argsort(own)
                parts.setdefault(bucket, []).append((name, own[order], idf[ends[row] : ends[row + 1]][order]))
        for bucket, own in parts.items():
            system.create_dir(inner, recursive=True)
            path, temp = f"{inner}/block-{bucket:06d}.npz", f"{inner}/.{uuid.uuid4().hex}"
            packed = io.BytesIO()
            counts = np.array([len(o[1]) for o in own], np.int64)
            vocab, where, places = np.unique(concat([o[1] for o in own], np.uint64), return_index=True, return_inverse=True)
            order = side_by_side(counts, places)
            at = expand((np.cumsum(counts) - counts)[order], counts[order])
            np.savez(
                packed, names=np.array([o[0] for o in own], np.int64)[order], counts=counts[order],
                vocab=vocab, idf=concat([o[2] for o in own], np.float64)[where], places=places[at].astype(np.int32),
            )
            with system.open_output_stream(temp) as out:
                out.write(packed.getbuffer())
            system.move(temp, path)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([path])], names=["block_number", "block"])

    numbered = asked.select(F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("bucket"), "query", "terms")
    written = dealt(numbered, blocks).mapInArrow(released(write), "block_number int, block string")
    return stored(written, "query-blocks-log").withColumn("block_folder", F.lit(folder))


class Asked:
    """A block of queries: ``places`` of their terms in ``vocab``, ascending in each query, and the query of each by ``owner``."""

    def __init__(self, names: np.ndarray, counts: np.ndarray, vocab: np.ndarray, idf: np.ndarray, places: np.ndarray):
        self.names, self.vocab, self.idf, self.places = names, vocab, idf, places
        self.owner = np.repeat(np.arange(len(names), dtype=np.int32), counts)

    @classmethod
    def read(cls, folder: str, path: str) -> Asked:
        x = read_arrays(folder, path)
        return cls(x["names"], x["counts"], x["vocab"], x["idf"], x["places"])


BEST = pa.schema([("query", pa.int64()), ("rank", pa.int32()), ("doc_id", pa.int64()), ("score", pa.float64())])


def best_of_shards(k: int):
    def run(batches: Iterator[pa.RecordBatch]):
        """The k best of all shards' findings, for the queries of one task; null ids are packed as a mask."""
        blocks = [row for batch in batches for row in batch.to_pylist()]
        query, doc, score, known = (
            concat([np.frombuffer(b[c], t) for b in blocks], t)
            for c, t in (("queries", np.int64), ("docs", np.int64), ("scores", np.float64), ("known", np.bool_))
        )
        order = np.lexsort((doc, ~known, -score, query))
        out = []
        for a, b in slices(changes(query[order])):
            own = order[a : min(b, a + k)].tolist()
            out += [(int(query[i]), r + 1, int(doc[i]) if known[i] else None, float(score[i])) for r, i in enumerate(own)]
        yield from rows(BEST, out)

    return run


def _found(shard: Shard, asked: Asked, bars: np.ndarray, mean_length: float, k: int):
    """(query, documents, scores) for the queries that find any."""
    own = Postings(shard, asked.vocab, asked.idf, mean_length)
    terms = own.number[asked.places]
    present = np.flatnonzero(terms >= 0)
    terms, owner = terms[present], asked.owner[present]
    count = np.bincount(owner, minlength=len(bars))
    first = np.concatenate([[0], np.cumsum(count)])
    for q in np.flatnonzero((count > 0) & (count <= CURSORS)).tolist():
        found = top_documents([own.cursor(int(t)) for t in terms[first[q] : first[q + 1]]], k)
        yield q, np.array([d for _, d in found], np.int64), np.array([score for score, _ in found], np.float64)
    long = np.flatnonzero(count > CURSORS)
    sums = Sums(own) if len(long) else None
    for i in range(0, len(long), ALIKE):
        alike = long[i : i + ALIKE]
        sums.choose(terms[expand(first[alike], count[alike])], len(alike))
        for j in range(0, len(alike), sums.together):
            some = alike[j : j + sums.together]
            at = expand(first[some], count[some])
            for q, docs, scores in sums.best(terms[at], np.repeat(np.arange(len(some)), count[some]), bars[some], k):
                if len(docs):
                    yield int(some[q]), docs, scores


def _searched(pairs: DataFrame, k: int, mean_length: float, buckets: int) -> DataFrame:
    """For each pair of a group of shards and a block of queries the best documents, packed for the task that merges their query."""

    def run(batches: Iterator[pa.RecordBatch]):
        for row in (row for batch in batches for row in batch.to_pylist()):
            asked = Asked.read(row["block_folder"], row["block"])
            names = asked.names
            # The k best scores of each query so far; the least of them is its bar.
            top, which, found = np.zeros((len(names), k)), [], []
            for path in row["shards"]:
                shard = Shard.read(row["folder"], path)
                keys, known = np.array([key or 0 for key in shard.keys], np.int64), np.array([key is not None for key in shard.keys], np.bool_)
                for query, docs, scores in _found(shard, asked, top[:, 0], mean_length, k):
                    top[query] = np.sort(np.concatenate([top[query], scores]))[-k:]
                    which.append(np.full(len(docs), query))
                    found.append((keys[docs], known[docs], scores))
            query = concat(which, np.int64)
            docs, known, scores = (concat([f[i] for f in found], t) for i, t in enumerate((np.int64, np.bool_, np.float64)))
            kept = scores >= top[query, 0]
            query, columns = names[query[kept]], (docs[kept], known[kept], scores[kept])
            packed = by_bucket(buckets_of(mix(query.view(np.uint64)), buckets), query, *columns) if len(query) else ()
            yield from rows(SENT, [(bucket, *(p.tobytes() for p in own)) for bucket, own in packed])

    return pairs.mapInArrow(released(run), "bucket int, queries binary, docs binary, known binary, scores binary")


SENT = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("queries", "docs", "known", "scores"))])


def op6_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(build_shards(docs), query_terms(docs.where(F.col("doc_id") % 50 == 0)))
