"""Token ids in one wavelet-matrix file per shard.

Documents are dealt by ranges of their id, so shards follow the ascending order. A task tokenizes its documents,
appends the end id to each, and writes files of up to ``SHARD_TOKENS`` ids. A file holds the ids as bit planes of a
wavelet matrix (zeros of a plane go first in the next), cut into blocks that are compressed one by one, with the
number of ones before each block. So one file answers token access, counting and occurrence lookup without being
unpacked as a whole, and a full read undoes the planes from the lowest up. Files get their final name when whole.

Tokenization works on pieces (white space and the word after it, cut before ASCII punctuation that follows an ASCII
letter), for which the byte-level rules give the same ids alone as in the text; a worker keeps the ids of pieces it
has seen lately, up to a bounded number. A text with white space outside ASCII, or with the content of an added token of
the tokenizer (a marker such as the end of a text), is encoded as a whole.

Defined results: a null text is empty and has the end id only; null ids come first; rows with equal ids follow the
hash of their text and keep a row each; other columns are ignored; an empty table writes no files and reads no rows.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.blocks import changes
from touchline.llm.common import BLANKS, PRIME, Hasher, chunks_of, mix, partitions, shared_folder
from touchline.llm.warc import open_folder

END_ID = 0
SHARD_TOKENS = 4 << 20
BLOCK_BITS = 1 << 16
KEPT_PIECES = 250_000
KEPT_BYTES = 48
MAGIC = b"WMTK0001"
# UTF-8 of the white space characters outside ASCII.
WIDE_SPACE = re.compile(rb"[\xc2\xe1-\xe3](?:(?<=\xc2)[\x85\xa0]|(?<=\xe1)\x9a\x80|(?<=\xe2)(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|(?<=\xe3)\x80\x80)")


# ---------------------------------------------------------------------------------------------------------------
# Tokenizing
# ---------------------------------------------------------------------------------------------------------------


class Encoder:
    """Token ids of many texts, through the ids of their distinct pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.hasher = Hasher(np.arange(1, 257, dtype=np.uint64))
        self.blank = np.zeros(256, bool)
        self.blank[list(BLANKS)] = True
        self.letter, self.mark = np.zeros(256, bool), np.zeros(256, bool)
        self.letter[[*range(65, 91), *range(97, 123)]] = True
        self.mark[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
        # Byte-level models write byte b as character b if that is printable, and the others as 256, 257, ...
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.byte_letters = {b: 256 + i for i, b in enumerate(others)}
        self.older: dict[bytes, bytes] = {}
        self.newer: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if (not text.isascii() and WIDE_SPACE.search(text)) or any(a in text for a in self.added):
                out[i] = np.array(self._ids([text.decode()])[0], np.uint32)
            else:
                plain.append(i)
        own = [texts[i] for i in plain]
        for a, b in chunks_of(own):
            for i, ids in zip(plain[a:b], self._pieces(own[a:b]), strict=True):
                out[i] = ids
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        buffer = b"".join(texts)
        ends = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(buffer, np.uint8)
        blank = self.blank[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = (blank[1:] & ~blank[:-1]) | (self.mark[data[1:]] & self.letter[data[:-1]])
        edge[ends[:-1]] = True
        edge[-1] = True
        places = np.flatnonzero(edge)
        starts, stops = places[:-1], places[1:]
        self.hasher._grow(len(buffer) + 1)
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.hasher.powers[: len(buffer)], out=sums[1:])
        hashes = mix((sums[stops] - sums[starts]) * self.hasher.inverse[starts]) ^ (stops - starts).astype(np.uint64) * np.uint64(PRIME)
        order = np.argsort(hashes)
        new = changes(hashes[order])
        first, inverse = order[new], np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        found = self._found([buffer[s:e] for s, e in zip(starts[first].tolist(), stops[first].tolist(), strict=True)])
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        begin, length = (np.cumsum(size) - size)[inverse], size[inverse]
        after = np.cumsum(length)
        ids = flat[np.repeat(begin - (after - length), length) + np.arange(int(after[-1]) if len(after) else 0)]
        cuts = np.concatenate([[0], after])[np.searchsorted(starts, ends)]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def _found(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces as bytes; pieces not asked for in a while are forgotten."""
        found = list(map(self.newer.get, pieces))
        absent = [i for i, ids in enumerate(found) if ids is None]
        for i in absent:
            found[i] = self.older.get(pieces[i])
        new = [i for i in absent if found[i] is None]
        tokenize, table, blank = self.tokenizer.model.tokenize, self.byte_letters, chr(self.byte_letters[0x20])
        flat: list[int] = []
        ends, rest = [], []
        for i in new:  # one blank and letters are a single unit of the byte-level rules, which the model takes directly
            piece = pieces[i]
            if piece[0] == 0x20 and piece[1:].isalpha():
                flat += [t.id for t in tokenize(blank + piece[1:].decode())]
            elif piece[0] == 0x20 and piece[1:].decode().isalpha():
                flat += [t.id for t in tokenize(piece.decode("latin-1").translate(table))]
            else:
                rest.append(i)
                continue
            ends.append((i, len(flat)))
        for i, ids in zip(rest, self._ids([pieces[i].decode() for i in rest]), strict=True):
            flat += ids
            ends.append((i, len(flat)))
        data, begin = np.array(flat, np.uint32).tobytes(), 0
        for i, end in ends:
            found[i] = data[4 * begin : 4 * end]
            begin = end
        self.newer.update((pieces[i], found[i]) for i in absent if len(pieces[i]) <= KEPT_BYTES)
        if len(self.newer) > KEPT_PIECES:
            self.older, self.newer = self.newer, {}
        return found


def worker_encoder(path: str) -> Encoder:
    """One encoder per Python worker: tasks that follow one another share what it has seen."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    state = sys.modules.setdefault("touchline_worker_state", types.ModuleType("touchline_worker_state"))
    if getattr(state, "path", None) != path:
        state.path, state.encoder = path, Encoder(path)
    return state.encoder


# ---------------------------------------------------------------------------------------------------------------
# Files
# ---------------------------------------------------------------------------------------------------------------


def planes_of(ids: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, int]]:
    """(bits, number of zeros) per plane, from the highest."""
    now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
    for level in range(depth - 1, -1, -1):
        bits = (now >> now.dtype.type(level)) & now.dtype.type(1) != 0
        low = np.compress(~bits, now)  # several times faster than a boolean index
        yield bits, len(low)
        now = np.concatenate([low, np.compress(bits, now)])


def pack(ids: np.ndarray, depth: int, keys: list, lengths: np.ndarray) -> bytes:
    """A file: magic, header length, header, document table, then the blocks of all planes."""
    packer, blocks, body, size = zstandard.ZstdCompressor(level=1), [], [], 0
    zeros, ones = [], []
    for bits, none in planes_of(ids, depth):
        zeros.append(none)
        packed = np.packbits(bits, bitorder="little").tobytes()
        counts = np.array([np.count_nonzero(bits[i : i + BLOCK_BITS]) for i in range(0, len(bits), BLOCK_BITS)], np.int64)
        ones.append(np.cumsum(counts) - counts)
        for i in range(0, len(packed), BLOCK_BITS // 8):
            raw = packed[i : i + BLOCK_BITS // 8]
            small = packer.compress(raw)
            small = small if len(small) < len(raw) else raw
            blocks.append(size)
            body.append(small)
            size += len(small)
    blocks.append(size)
    documents = packer.compress(json.dumps(keys).encode()), packer.compress(lengths.astype("<i8").tobytes())
    tables = packer.compress(np.array(blocks, "<i8").tobytes()), packer.compress(np.concatenate(ones).astype("<i8").tobytes())
    header = {
        "tokens": len(ids), "documents": len(keys), "depth": depth, "block_bits": BLOCK_BITS, "zeros": zeros,
        "parts": [len(x) for x in (*documents, *tables)],
    }
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *documents, *tables, *body])


class TokenFile:
    """Queries on one file, through an open file object; blocks are read and unpacked when needed."""

    def __init__(self, file):
        self.file = file
        if file.read(8) != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack("<I", file.read(4))
        self.head = json.loads(file.read(size))
        unpack = zstandard.ZstdDecompressor().decompress
        keys, lengths, blocks, ones = (unpack(file.read(n)) for n in self.head["parts"])
        self.keys, self.lengths = json.loads(keys), np.frombuffer(lengths, "<i8")
        self.body = 12 + size + sum(self.head["parts"])
        self.tokens, self.depth, self.zeros = self.head["tokens"], self.head["depth"], self.head["zeros"]
        self.per_plane = -(-self.tokens // BLOCK_BITS)
        self.blocks = np.frombuffer(blocks, "<i8")
        self.before = np.frombuffer(ones, "<i8").reshape(self.depth, self.per_plane)
        self.block = lru_cache(maxsize=256)(self._block)

    def _raw(self, first: int, last: int) -> list[bytes]:
        """Unpacked blocks [first, last), in one read."""
        self.file.seek(self.body + int(self.blocks[first]))
        data = self.file.read(int(self.blocks[last] - self.blocks[first]))
        out, at, unpack = [], 0, zstandard.ZstdDecompressor().decompress
        for k in range(first, last):
            size = int(self.blocks[k + 1] - self.blocks[k])
            bits = min(BLOCK_BITS, self.tokens - (k % self.per_plane) * BLOCK_BITS)
            part = data[at : at + size]
            out.append(part if size == -(-bits // 8) else unpack(part))
            at += size
        return out

    def _block(self, plane: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(bits, ones before each bit) of a block."""
        k = plane * self.per_plane + number
        bits = np.unpackbits(np.frombuffer(self._raw(k, k + 1)[0], np.uint8), bitorder="little")
        return bits, np.concatenate([[0], np.cumsum(bits)])

    def _ones(self, plane: int, at: int) -> int:
        """Ones before a place of a plane."""
        if at >= self.tokens:
            return self.tokens - self.zeros[plane]
        number, rest = divmod(at, BLOCK_BITS)
        return int(self.before[plane, number] + self.block(plane, number)[1][rest])

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = 0
        for plane in range(self.depth):
            number, rest = divmod(at, BLOCK_BITS)
            bit, ones = int(self.block(plane, number)[0][rest]), self._ones(plane, at)
            value = 2 * value + bit
            at = self.zeros[plane] + ones if bit else at - ones
        return value

    def rank(self, token: int, at: int) -> int:
        """How often ``token`` stands before a place."""
        if token >> self.depth:
            return 0
        low = 0
        for plane in range(self.depth):
            a, b = self._ones(plane, low), self._ones(plane, at)
            one = (token >> (self.depth - 1 - plane)) & 1
            low, at = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (low - a, at - b)
        return at - low

    def count(self, token: int, begin: int = 0, end: int | None = None) -> int:
        return self.rank(token, self.tokens if end is None else end) - self.rank(token, begin)

    def select(self, token: int, number: int) -> int:
        """The place of the ``number``-th occurrence, counted from 0."""
        if number >= self.rank(token, self.tokens):
            raise IndexError(number)
        low, path = 0, []
        for plane in range(self.depth):
            ones = self._ones(plane, low)
            one = (token >> (self.depth - 1 - plane)) & 1
            low = self.zeros[plane] + ones if one else low - ones
            path.append(one)
        at = low + number
        for plane in range(self.depth - 1, -1, -1):
            at = self._select_bit(plane, path[plane], at - self.zeros[plane] if path[plane] else at)
        return at

    def _select_bit(self, plane: int, bit: int, number: int) -> int:
        """The place of the ``number``-th one or zero of a plane."""
        starts = np.arange(self.per_plane) * BLOCK_BITS
        before = self.before[plane] if bit else starts - self.before[plane]
        block = int(np.searchsorted(before, number, side="right")) - 1
        bits = self.block(plane, block)[0][: self.tokens - block * BLOCK_BITS]
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[number - int(before[block])])

    def occurrences(self, token: int) -> Iterator[int]:
        for number in range(self.rank(token, self.tokens)):
            yield self.select(token, number)

    def all_ids(self) -> np.ndarray:
        """All ids: each plane's bits put back the order of the plane above."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        now = np.zeros(self.tokens, kind)
        for plane in range(self.depth - 1, -1, -1):
            raw = b"".join(self._raw(plane * self.per_plane, (plane + 1) * self.per_plane))
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little", count=self.tokens).view(bool)
            above = np.empty(self.tokens, kind)
            above[np.flatnonzero(~bits)] = now[: self.zeros[plane]]
            above[np.flatnonzero(bits)] = now[self.zeros[plane] :] | kind(1 << (self.depth - 1 - plane))
            now = above
        return now


# ---------------------------------------------------------------------------------------------------------------
# Jobs
# ---------------------------------------------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the files; one row (part, number, path, documents, tokens) per file. Running it writes them.

    Files follow ascending ids in the order of (part, number).
    """
    value = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).cast("bigint").alias("key"), value.alias("text")).withColumn("tie", F.xxhash64("text"))
    # The hash of the text splits an id that many rows share.
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "key", "tie").sortWithinPartitions("key", "tie")

    def write(batches: Iterator[pa.RecordBatch]):
        encoder = worker_encoder(tokenizer)
        depth = max(1, (max(encoder.tokenizer.get_vocab_size(), end_id + 1) - 1).bit_length())
        part, system, inner = TaskContext.get().partitionId(), *open_folder(folder)
        keys, pieces, size, number = [], [], 0, 0

        def flush():
            ids = np.concatenate(pieces)
            system.create_dir(inner, recursive=True)
            path, temp = f"{inner}/shard-{part:05d}-{number:04d}.wmt", f"{inner}/.{uuid.uuid4().hex}"
            with system.open_output_stream(temp) as out:
                out.write(pack(ids, depth, keys, np.fromiter(map(len, pieces), np.int64, len(pieces))))
            system.move(temp, path)
            row = {"part": [part], "number": [number], "path": [path], "documents": [len(keys)], "tokens": [len(ids)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                own = batch.slice(i, 1024)
                for k, ids in zip(own.column(0).to_pylist(), encoder.encode(own.column(1).to_pylist()), strict=True):
                    keys.append(k)
                    pieces.append(np.append(ids, np.uint32(end_id)))
                    size += len(ids) + 1
                    if size >= shard_tokens:
                        yield flush()
                        keys, pieces, size, number = [], [], 0, number + 1
        if keys:
            yield flush()

    return ordered.select("key", "text").mapInArrow(write, "part int, number int, path string, documents bigint, tokens bigint")


def read_tokens(files: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document: key, start, n_tokens, ids_crc32 and, if asked, its ids; from the files that ``files`` lists."""
    base = F.sum("tokens").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("base", F.coalesce(base, F.lit(0).cast("bigint")))
    fields = [("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int32()))] if with_ids else []
    schema = pa.schema(fields)
    system, _ = open_folder(folder)

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["path"]) as file:
                    shard = TokenFile(file)
                    ids = shard.all_ids()
                ends = np.cumsum(shard.lengths)
                own = np.split(ids, ends[:-1])
                for i in range(0, len(own), 4096):
                    part = own[i : i + 4096]
                    columns = [shard.keys[i : i + 4096], row["base"] + ends[i : i + 4096] - shard.lengths[i : i + 4096]]
                    columns += [shard.lengths[i : i + 4096], [zlib.crc32(x.astype("<u4").tobytes()) for x in part]]
                    columns += [[x.astype(np.int32) for x in part]] if with_ids else []
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    ddl = "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    spread = placed.repartition(partitions(files.sparkSession), "part", "number")
    return spread.select("path", "base").mapInArrow(read, ddl)


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, log = shared_folder(spark, "tokens"), shared_folder(spark, "tokens-log")
    write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json")).write.parquet(log)
    return read_tokens(spark.read.parquet(log), folder, with_ids=False).withColumnRenamed("key", "doc_id")
