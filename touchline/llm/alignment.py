"""Alignment of two tokenizers over a corpus: which ids of one stand where which ids of the other stand.

The corpus is shuffled by full text, so each distinct text is tokenized and aligned once, and counts weight it by its
copies. Byte offsets at which tokens of both end cut a text into groups; all pairs within a group are links. Tasks
write aligned texts to block files in the shared folder and hand on only each block's distinct id pairs with the number
of documents that hold them. Those rows, not the texts' own links, are summed over the corpus and joined back, so a
pair that every document holds is one row per block. Per block, counts meet the file again, without moving its texts.
Measures are joined to documents by the text's SHA-256; texts that hold more than a thousandth of all rows (a thousand
of them at most) are dealt over 64 tasks.

Defined results: a null or empty text, and one that either tokenizer does not give back byte for byte, has no tokens;
it counts nowhere. Every row is a document, also when ids or texts repeat or an id is null. Ties for the best count all
count as best. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.blocks import changes, concat, expand
from touchline.llm.common import chunks_of, shared_folder, stored
from touchline.llm.tokens import Encoder
from touchline.llm.warc import open_folder

CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
# Links of a group beyond which its pairs are counted from its distinct ids and not one by one.
WIDE_GROUP = 1 << 12
# A text of this many copies may hold a thousandth of the corpus; only those are named to the driver.
COPIES = 1000
SALTS = 64

FILE = pa.schema(
    [("name", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
     ("groups", pa.large_string()), ("refs", pa.large_binary()), ("links", pa.large_binary())]
)
LOG = "block string, pairs array<bigint>, docs array<bigint>, copied array<struct<name:string,copies:bigint>>"
MEASURES = "name string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


# ---------------------------------------------------------------------------------------------------------------
# The two tokenizers
# ---------------------------------------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """Bytes of the letters of byte-level models: printable bytes stand for themselves, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """Ids of texts by one tokenizer, and of each id its bytes and its digits with the mark that may follow."""

    def __init__(self, encode: Callable[[list[bytes]], list[np.ndarray]], pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(pieces), np.uint8)
        self.digits = {mark: np.array([f"{i}{mark}" for i in range(len(pieces))], object) for mark in ",|;"}
        self.bits = max(1, (len(pieces) - 1).bit_length())

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return self.letters[expand(self.starts[ids], self.sizes[ids])]


def byte_level(path: str) -> Tokens:
    """A byte-level model of the tokenizers library on a blank and the text; strings of special tokens are plain text."""
    encoder = Encoder(path)
    encoder.tokenizer.encode_special_tokens = True
    letters = byte_letters()
    pieces = [b""] * encoder.tokenizer.get_vocab_size()
    for token, i in encoder.tokenizer.get_vocab().items():
        known = all(c in letters for c in token)
        pieces[i] = bytes(letters[c] for c in token) if known else token.encode()
    return Tokens(lambda texts: encoder.encode([b" " + t for t in texts]), pieces)


def sentence_pieces(path: str) -> Tokens:
    """A SentencePiece model, which adds the blank itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def bytes_of(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes.fromhex(piece[3:5])
        return piece.replace("▁", " ").encode()

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in model.encode([t.decode() for t in texts], num_threads=1)]

    return Tokens(encode, [bytes_of(model.id_to_piece(i)) for i in range(model.get_piece_size())])


def worker_tokens(a_path: str, b_path: str) -> tuple[Tokens, Tokens]:
    """Both tokenizers, loaded once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    kept = vars(sys.modules.setdefault("_alignment_tokens", types.ModuleType("_alignment_tokens")))
    if (a_path, b_path) not in kept:
        kept[a_path, b_path] = byte_level(a_path), sentence_pieces(b_path)
    return kept[a_path, b_path]


# ---------------------------------------------------------------------------------------------------------------
# Alignment of a run of texts
# ---------------------------------------------------------------------------------------------------------------


class Aligned:
    """Measures of texts in order, and their distinct pairs: text number, pair (a << 32 | b) and links of each."""

    def __init__(self, n: int):
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        self.groups = [""] * n
        self.text = self.pair = self.links = np.zeros(0, np.int64)


def _given_back(texts: list[bytes], lists: list[np.ndarray], tokens: Tokens) -> np.ndarray:
    """Which texts, with a blank before them, the ids spell byte for byte."""
    sizes = np.array([len(t) + 1 for t in texts])
    ids, counts = np.concatenate(lists), np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(texts)), counts)
    same = np.bincount(owner, tokens.sizes[ids], len(texts)) == sizes
    spelled = tokens.spelled(ids[same[owner]])
    kept = np.flatnonzero(same)
    wanted = np.frombuffer(b"".join([b" " + texts[i] for i in kept.tolist()]), np.uint8)
    wrong = np.flatnonzero(spelled != wanted)
    same[kept[np.searchsorted(np.cumsum(sizes[kept]), wrong, "right")]] = False
    return same


def _pairs(a: np.ndarray, b: np.ndarray, count_a, count_b, group_a, text_of_group, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, links) of all groups; a wide group by its distinct ids, the others token by token."""
    first_a, first_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    wide = count_a * count_b > WIDE_GROUP
    narrow = ~wide[group_a]
    groups = group_a[narrow]
    each = count_b[groups]
    pair = np.repeat(a[narrow], each) << bits | b[expand(first_b[groups], each)]
    # One sort of text and pair together; the count of equal ones is their links.
    shift = 2 * bits
    key = np.sort(np.repeat(text_of_group[groups], each) << shift | pair)
    new = np.flatnonzero(changes(key)) if len(key) else np.zeros(0, np.int64)
    links = np.diff(np.append(new, len(key)))
    key = key[new]
    if wide.any():
        keys, times = [key], [links]
        for g in np.flatnonzero(wide).tolist():
            ids_a, times_a = np.unique(a[first_a[g] : first_a[g] + count_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[first_b[g] : first_b[g] + count_b[g]], return_counts=True)
            keys.append((text_of_group[g] << shift) | (ids_a[:, None] << bits | ids_b[None, :]).ravel())
            times.append((times_a[:, None] * times_b[None, :]).ravel())
        key, number = np.unique(np.concatenate(keys), return_inverse=True)
        links = np.zeros(len(key), np.int64)
        np.add.at(links, number, np.concatenate(times))
    pair = key & ((1 << shift) - 1)
    return key >> shift, (pair >> bits) << 32 | (pair & ((1 << bits) - 1)), links


def align(texts: list[bytes], one: Tokens, other: Tokens) -> Aligned:
    out = Aligned(len(texts))
    kept = np.array([i for i, t in enumerate(texts) if t], np.int64)
    own = [texts[i] for i in kept.tolist()]
    if not own:
        return out
    lists_a, lists_b = one.encode(own), other.encode(own)
    valid = _given_back(own, lists_a, one) & _given_back(own, lists_b, other)
    kept = kept[valid]
    if not len(kept):
        return out
    lists_a, lists_b = ([ids for ids, v in zip(x, valid.tolist(), strict=True) if v] for x in (lists_a, lists_b))
    n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (lists_a, lists_b))
    a, b = np.concatenate(lists_a).astype(np.int64), np.concatenate(lists_b)
    # Both spell the same bytes, so the ends of all texts, one after the other, are ends of both.
    ends_a, ends_b = np.cumsum(one.sizes[a]), np.cumsum(other.sizes[b])
    shared = np.zeros(int(ends_a[-1]) + 1, np.int8)
    shared[ends_a] = 1
    shared[ends_b] += 1
    meets = shared == 2
    number = np.cumsum(meets)  # groups that end at or before a byte
    group_a, group_b = number[ends_a] - meets[ends_a], number[ends_b] - meets[ends_b]
    groups = int(number[-1])
    count_a, count_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    last_group = group_a[np.cumsum(n_a) - 1]
    n_groups = np.diff(last_group, prepend=-1)
    text_of_group = np.repeat(np.arange(len(kept)), n_groups)
    out.n_a[kept], out.n_b[kept], out.n_groups[kept] = n_a, n_b, n_groups
    out.n_links[kept] = np.add.reduceat(count_a * count_b, last_group - n_groups + 1)
    text, out.pair, out.links = _pairs(a, b, count_a, count_b, group_a, text_of_group, max(one.bits, other.bits))
    out.text = kept[text]
    # Ids in the order in which they are written: a group's ids of one, then those of the other, each with what follows.
    before_a, before_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    place_a = np.arange(len(a)) + before_b[group_a]
    place_b = np.arange(len(b)) + (before_a + count_a)[group_b]
    written = np.empty(len(a) + len(b), object)
    for tokens, ids, place, group, mark in ((one, a, place_a, group_a, "|"), (other, b, place_b, group_b, ";")):
        last = np.append(group[1:] != group[:-1], True)
        written[place] = tokens.digits[","][ids]
        written[place[last]] = tokens.digits[mark][ids[last]]
    cuts = np.cumsum([0, *(n_a + n_b)]).tolist()
    pieces = written.tolist()
    for i, begin, end in zip(kept.tolist(), cuts[:-1], cuts[1:], strict=True):
        out.groups[i] = "".join(pieces[begin:end])[:-1]
    return out


# ---------------------------------------------------------------------------------------------------------------
# Blocks
# ---------------------------------------------------------------------------------------------------------------


def _write(folder: str, names: list[str], copies: np.ndarray, texts: list[bytes], one: Tokens, other: Tokens) -> dict:
    """Align one block, write its file under a name of its own, and tell its pairs."""
    parts = [(begin, align(texts[begin:end], one, other)) for begin, end in chunks_of(texts, CHUNK_BYTES)]
    pairs = concat([p.pair for _, p in parts], np.int64)
    every = np.unique(pairs)
    refs = np.searchsorted(every, pairs).astype(np.uint32)
    held = concat([copies[begin + p.text] for begin, p in parts], np.int64)
    docs = np.zeros(len(every), np.int64)
    np.add.at(docs, refs, held)
    rows, at = [], 0
    for begin, part in parts:
        cuts = (at + np.searchsorted(part.text, np.arange(len(part.groups) + 1))).tolist()
        links = part.links.astype(np.uint64)
        for i, groups in enumerate(part.groups):
            rows.append(
                (names[begin + i], part.n_a[i], part.n_b[i], part.n_groups[i], part.n_links[i], groups,
                 refs[cuts[i] : cuts[i + 1]].tobytes(), links[cuts[i] - at : cuts[i + 1] - at].tobytes())
            )
        at += len(part.pair)
    block = uuid.uuid4().hex
    system, inner = open_folder(folder)
    system.create_dir(inner, recursive=True)
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with system.open_output_stream(f"{inner}/{block}.arrow") as out, pa.ipc.new_stream(out, FILE, options=options) as sink:
        for i in range(0, len(rows), 1024):
            columns = zip(*rows[i : i + 1024], strict=True)
            sink.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FILE, strict=True)], schema=FILE))
    often = np.flatnonzero(copies >= COPIES).tolist()
    copied = [{"name": names[i], "copies": int(copies[i])} for i in often]
    return {"block": block, "pairs": every, "docs": docs, "copied": copied}


def _aligner(folder: str, a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, copies, texts, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            row = _write(folder, names, np.array(copies, np.int64), texts, *worker_tokens(a_path, b_path))
            kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.struct([("name", pa.string()), ("copies", pa.int64())]))]
            return pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in zip(row, kinds, strict=True)], list(row))

        for batch in batches:
            for name, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names.append(name)
                texts.append(text.encode())
                copies.append(n)
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield close()
                    names, copies, texts, size = [], [], [], 0
        if names:
            yield close()

    return run


def _measures(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = open_folder(folder)
        for batch in batches:
            for i in range(batch.num_rows):
                block, answers = batch.column(0)[i].as_py(), batch.column(1)[i].values
                order = np.argsort(answers.field("pair").to_numpy(zero_copy_only=False))
                count = answers.field("count").to_numpy(zero_copy_only=False)[order]
                best = answers.field("best").to_numpy(zero_copy_only=False).astype(bool)[order]
                with system.open_input_stream(f"{inner}/{block}.arrow") as source:
                    for part in pa.ipc.open_stream(source):
                        yield from _measured(part, count, best)

    return run


def _measured(part: pa.RecordBatch, count: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    n_best, sums = [], []
    for refs, links in zip(part.column("refs").to_pylist(), part.column("links").to_pylist(), strict=True):
        refs, links = np.frombuffer(refs, np.uint32), np.frombuffer(links, np.uint64).astype(np.int64)
        n_best.append(int(links[best[refs]].sum()))
        sums.append(int((links * count[refs]).sum()))
    own = [part.column(c) for c in ("name", "n_a", "n_b", "n_groups", "n_links")]
    columns = [*own, pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), part.column("groups").cast(pa.string())]
    yield pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in MEASURES.split(", ")])


# ---------------------------------------------------------------------------------------------------------------
# The corpus
# ---------------------------------------------------------------------------------------------------------------


class Alignment:
    """Aligned texts below a folder: ``counts`` (pair, a, b, count, best), ``texts()`` and ``per_document()``."""

    def __init__(self, docs: DataFrame, key: str, text: str, a_path: str, b_path: str, folder: str | None = None):
        spark = docs.sparkSession
        self.folder = folder or shared_folder(spark, "alignment")
        self.rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        distinct = self.rows.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
        named = distinct.select(F.sha2("text", 256).alias("name"), "text", "copies")
        self.log = stored(named.mapInArrow(_aligner(self.folder, a_path, b_path), LOG), "alignment-log")
        self.held = self.log.select("block", F.inline(F.arrays_zip("pairs", "docs"))).withColumnRenamed("pairs", "pair")
        a = F.shiftright("pair", 32)
        counts = self.held.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", a)
        best = F.col("count") == F.max("count").over(Window.partitionBy("a"))
        self.counts = stored(
            counts.select("pair", "a", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "count", best.alias("best")), "pair-counts"
        )

    def texts(self) -> DataFrame:
        """One row per distinct text: its SHA-256, measures, and groups as ``a1,a2|b1;a3|b2,b3``."""
        answers = self.held.select("block", "pair").join(self.counts.select("pair", "count", "best"), "pair")
        per_block = answers.groupBy("block").agg(F.collect_list(F.struct("pair", "count", "best")).alias("answers"))
        return per_block.mapInArrow(_measures(self.folder), MEASURES)

    def _heavy(self) -> list[str]:
        """Names of texts above a thousandth of all rows, so a thousand at most."""
        copied = self.log.select(F.inline("copied"))
        return [r[0] for r in copied.where(F.col("copies") * 1000 > self.rows.count()).collect()]

    def per_document(self, measures: DataFrame) -> DataFrame:
        """Columns of ``measures`` (by ``name``) for every row as ``key``; zeros and empty texts where there are none."""
        heavy = self._heavy()

        def salted(number: Column) -> Column:
            return F.when(F.col("name").isin(heavy), number).otherwise(F.lit(0)) if heavy else F.lit(0)

        own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))  # rows without a text meet nothing
        name = F.when(F.col("text") == "", own).otherwise(F.coalesce(F.sha2("text", 256), own))
        rows = self.rows.select("key", name.alias("name"))
        rows = rows.withColumn("salt", salted(F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")))
        dealt = measures.withColumn("salt", F.explode(F.sequence(F.lit(0), salted(F.lit(SALTS - 1)))))
        zero = {"string": ""}
        filled = [
            F.coalesce(c, F.lit(zero.get(t, 0)).cast(t)).alias(c) for c, t in measures.dtypes if c != "name"
        ]
        return rows.join(dealt, ["name", "salt"], "left").select("key", *filled)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    paths = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    aligned = Alignment(docs, "doc_id", "text", *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    measures = aligned.texts().withColumn("groups_sha256", digest).drop("groups")
    return aligned.per_document(measures).withColumnRenamed("key", "doc_id")
