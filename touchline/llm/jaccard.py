"""Join of texts whose sets of word shingles have a Jaccard similarity of at least 3/4, with PartEnum signatures.

Signatures. Sizes fall into bands [2^b, 2^(b+1)); a set of at least 1.5 * 2^b elements also joins the next band, so
two similar sets meet in a band. Each band cuts the 64-bit shingle domain into ranges, and a set sends one signature
per filled range: the hash of its elements there. (PartEnum with subsets of size one: k2 = 0, n2 = 1.) Similar sets
differ in at most ``H = (|s| + |t|) / 7 <= |s| / 3`` elements, hence in at most H ranges, and there are more than H
ranges. So a set with more than ``|s| / 3`` filled ranges shares one of them with every similar set. A set with
fewer sends its empty ranges too: two such sets agree in some range, filled or empty.

Frequent signatures. A signature of more than ``GROUP`` sets is hot (a line or passage that many texts share). If a
set has more than ``|s| / 3`` filled ranges that are not hot, each of its similar sets is found through those, since
agreeing ranges are hot for both. It is taken out of the hot groups, and only the few sets that consist mostly of
frequent passages stay there. No similar pair is lost.

Signature groups are not expanded into pairs. First every set is compared with the smallest members of its groups,
and connected components are formed. Then the members of a group that are still in different components are compared, all of them.
Before each comparison stands a parity sketch of the set: the number of different bits is at most the number of
different elements. A pair that several signatures find is compared once, and exactly, on the texts.

Shuffles carry packed signatures with 16-byte names of sets; equal sets are one name and one node.

Defined results: null, empty and blank texts have no shingles and no links; below five words the whole sequence is
the one shingle; repeated rows share a component; rows with a null id get a null component and link nothing; rows
that share an id count as one document; other columns are kept by :func:`without_near_copies`, else ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.blocks import DIGEST, Names, buckets_of, by_bucket, changes, concat, dealt, grouped_positions, repeated, rows, slices, used
from touchline.llm.common import SPLIT_LOWER, Hasher, chunks_of, components, mix, partitions, released, rolling, stored

SHINGLE = 5
TOP_LOAD = 2.0  # mean elements per range at the upper end of a band; below 2.8, so that filled ranges exceed a third
GROUP = 64  # sets per signature beyond which it is hot
SLICE = 1024  # rows of an Arrow batch that are worked on at once
SLICE_BYTES = 4 << 20  # and bytes of texts in them, where rows hold two
KEPT_BYTES = 16 << 20  # sets that a task keeps between pairs
REF_BITS, BAND_BITS = 16, 5  # a packed signature is 43 bits of hash, the band, and a reference into the block's names


def similar(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common) and a + b > 0


def shingle_sets(texts: list[bytes], hasher: Hasher) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for a, b in chunks_of(texts):
        words = hasher.words(texts[a:b])
        grams = rolling(words.hashes, SHINGLE)
        for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            n = end - begin
            if n >= SHINGLE:
                yield np.unique(grams[begin : end - SHINGLE + 1])
            elif n:
                yield mix(rolling(words.hashes[begin:end], n) + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=DIGEST).digest()


def bands_of(n: int) -> list[int]:
    """Sizes 1 and 2 are similar to equal sets only, which share a name."""
    if n < 3:
        return []
    b = n.bit_length() - 1
    return [b, b + 1] if 2 * n >= 3 << b else [b]


def ranges_of(shingles: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(range of each element, first element of each filled range)."""
    cell = (shingles >> np.uint64(32)) * np.uint64(ranges_in(band)) >> np.uint64(32)
    return cell, np.flatnonzero(changes(cell))


def ranges_in(band: int) -> int:
    return int(np.ceil((2 << band) / TOP_LOAD))


def signatures(shingles: np.ndarray) -> np.ndarray:
    """Signature hashes with the band in the bits above the reference."""
    n, out = len(shingles), []
    scrambled = mix(shingles ^ np.uint64(0x51ED270B9F0C1D35))
    clear = ~np.uint64((1 << (REF_BITS + BAND_BITS)) - 1)
    for band in bands_of(n):
        cell, head = ranges_of(shingles, band)
        sigs = mix(np.add.reduceat(scrambled, head))
        if len(head) <= n // 3:
            empty = np.setdiff1d(np.arange(ranges_in(band), dtype=np.uint64), cell[head])
            sigs = np.concatenate([sigs, mix(mix(empty + np.uint64(1)))])
        out.append((sigs & clear) | np.uint64(band << REF_BITS))
    return concat(out, np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the elements per bin, in as many bins as the next power of two; 64-bit words."""
    bins = max(64, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """The sketches over fewer bins."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_match(n_a: np.ndarray, n_b: np.ndarray, different: np.ndarray) -> np.ndarray:
    return (7 * different <= n_a + n_b) & (3 * n_a <= 4 * n_b) & (3 * n_b <= 4 * n_a)


INFO = pa.schema(
    [
        ("row", pa.int64()), ("text_name", pa.binary()), ("name", pa.binary()), ("n", pa.int64()),
        ("sketch", pa.binary()), ("filled", pa.list_(pa.int32())),
    ]
)
BLOCKS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("names", pa.binary())])
# What the signature groups of a bucket send on, by kind: "group" (names of its members), "star" and "inside" (packed
# pairs and members, for the task ``to``), "hot" (a set's number of hot ranges) and "hot group" (with its signature).
SENT = pa.schema(
    [
        ("kind", pa.string()), ("bucket", pa.int32()), ("to", pa.int32()), ("names", pa.binary()),
        ("data", pa.binary()), ("band", pa.int32()), ("hot", pa.int32()),
    ]
)
SENT_DDL = "kind string, bucket int, to int, names binary, data binary, band int, hot int"
PAIRS = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(SPLIT_LOWER)
    for part in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
        ids, names, texts = (c.to_pylist() for c in part.columns)
        sets = shingle_sets([t or b"" for t in texts], hasher)
        out = []
        for row, text_name, own in zip(ids, names, sets, strict=True):
            filled = [len(ranges_of(own, band)[1]) for band in bands_of(len(own))]
            out.append((row, text_name, set_name(own), len(own), sketch(own).tobytes(), filled))
        yield from rows(INFO, out)


def send_signatures(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]):
        hasher, seen = Hasher(SPLIT_LOWER), set()
        names, parts, counts, size = [], [], [], 0

        def blocks():
            every = concat(parts, np.uint64)
            ref = np.repeat(np.arange(len(names)), counts)
            listed = np.frombuffer(b"".join(names), f"V{DIGEST}")
            out = []
            for bucket, (sig, r) in by_bucket(buckets_of(every, buckets), every, ref):
                r, own = used(r, listed)
                key = (sig & ~np.uint64((1 << REF_BITS) - 1)) | r.astype(np.uint64)
                out.append((bucket, np.sort(key).tobytes(), own))
            return rows(BLOCKS, out)

        for part in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            texts = [t for t in part.column(0).to_pylist() if t]
            for shingles in shingle_sets(texts, hasher):
                name = set_name(shingles)
                if name in seen:
                    continue
                seen.add(name)
                sigs = signatures(shingles)
                names.append(name)
                parts.append(sigs)
                counts.append(len(sigs))
                size += len(sigs)
                if size > 1 << 20 or len(names) == 1 << REF_BITS:
                    yield from blocks()
                    names, parts, counts, size = [], [], [], 0
        if names:
            yield from blocks()

    return send


def packed_pairs(a: np.ndarray, b: np.ndarray, names: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(task, names, pairs as places in them) for pairs of numbers; equal pairs of names come to the same task."""
    marks = np.frombuffer(names.tobytes(), np.uint64).reshape(-1, 2)[:, 0]
    for to, (x, y) in by_bucket(buckets_of(mix(marks[a] + np.uint64(3) * marks[b]), buckets), a, b):
        ref, own = used(np.concatenate([x, y]), names)
        yield to, own, ref.tobytes()


def _as_groups(bucket: int, listed: Names, owner: np.ndarray, count: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Stars, members and distinct groups, for numbers in the order of the names."""
    if not len(owner):
        return
    names, head = listed.array(), np.cumsum(count) - count
    leader = np.repeat(owner[head], count)
    pair = np.unique((leader << 32 | owner)[owner != leader])
    stars = packed_pairs(pair >> 32, pair & 0xFFFFFFFF, names, buckets)
    yield from rows(SENT, [("star", bucket, to, own, ref, None, None) for to, own, ref in stars])
    inside = np.unique(owner)
    marks = np.frombuffer(names.tobytes(), np.uint64).reshape(-1, 2)[:, 0]
    sent = by_bucket(buckets_of(mix(marks[inside]), buckets), inside)
    yield from rows(SENT, [("inside", bucket, to, names[own].tobytes(), None, None, None) for to, (own,) in sent])
    mark = np.add.reduceat(mix(owner.astype(np.uint64) + np.uint64(1)), head)
    _, kept = np.unique(mark + count.astype(np.uint64), return_index=True)
    out = [("group", bucket, None, names[owner[head[k] : head[k] + count[k]]].tobytes(), None, None, None) for k in kept.tolist()]
    yield from rows(SENT, out, 512)


def groups(buckets: int):
    return lambda batches: _groups(batches, buckets)


def _groups(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One task's signature groups, and of the hot ones their members with the number of hot ranges per band."""
    blocks = [row for batch in batches for row in batch.to_pylist()]
    bucket = blocks[0]["bucket"] if blocks else 0
    listed = Names([row.pop("names") for row in blocks])
    keys, owners = [], []
    for i, row in enumerate(blocks):
        key = np.frombuffer(row.pop("keys"), np.uint64)
        keys.append(key >> np.uint64(REF_BITS))
        owners.append(listed.block(i)[(key & np.uint64((1 << REF_BITS) - 1)).astype(np.int32)])
    sig, owner = concat(keys, np.uint64), concat(owners, np.int32)
    del keys, owners
    order = repeated(sig)  # most signatures belong to one set
    sig, owner = sig[order], owner[order].astype(np.int64)
    order = np.lexsort((owner, sig))
    sig, owner = sig[order], owner[order]
    fresh = changes(sig, owner)
    sig, owner = sig[fresh], owner[fresh]
    head = np.flatnonzero(changes(sig))
    count = np.diff(np.concatenate([head, [len(sig)]]))
    band = (sig & np.uint64((1 << BAND_BITS) - 1)).astype(np.int64)
    each = np.repeat(count, count)
    yield from _as_groups(bucket, listed, owner[(each > 1) & (each <= GROUP)], count[(count > 1) & (count <= GROUP)], buckets)
    hot = each > GROUP
    if hot.any():
        marked, often = np.unique(owner[hot] << BAND_BITS | band[hot], return_counts=True)
        mask = (1 << BAND_BITS) - 1
        out = [("hot", bucket, None, listed[m >> BAND_BITS], None, m & mask, k) for m, k in zip(marked.tolist(), often.tolist(), strict=True)]
        yield from rows(SENT, out)
        joined = listed.array()
        for h, c in zip(head[count > GROUP].tolist(), count[count > GROUP].tolist(), strict=True):
            for i in range(h, h + c, 1 << 16):  # long groups in parts: the signature holds them together
                part = owner[i : min(i + (1 << 16), h + c)]
                yield from rows(SENT, [("hot group", bucket, None, joined[part].tobytes(), sig[h].tobytes(), int(band[h]), c)])


def of_unsafe(buckets: int):
    def run(key, hot: pa.Table, unsafe: pa.Table) -> pa.Table:
        """The hot groups of a bucket without the sets that are found elsewhere."""
        listed = Names(unsafe.column("member").to_pylist())
        number = {listed[i]: i for i in range(len(listed))}
        keep = set(zip(unsafe.column("member").to_pylist(), unsafe.column("band").to_pylist(), strict=True))
        parts: dict[bytes, list[int]] = {}
        for sig, blob, band in zip(*(hot.column(c).to_pylist() for c in ("sig", "sets", "level")), strict=True):
            own = (blob[i : i + DIGEST] for i in range(0, len(blob), DIGEST))
            parts.setdefault(sig, []).extend(number[m] for m in own if (m, band) in keep)
        left = [np.unique(np.array(p, np.int64)) for p in parts.values() if len(p) > 1]
        count = np.array([len(p) for p in left], np.int64)
        return pa.Table.from_batches(list(_as_groups(key[0].as_py(), listed, concat(left, np.int64), count, buckets)), SENT)

    return run


PLACES = pa.schema([("name", pa.binary()), ("buckets", pa.list_(pa.int32()))])


def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets that each set is a member in."""
    blocks = [row for batch in batches for row in batch.to_pylist()]
    names = Names([row["names"] for row in blocks])
    own = np.repeat([row["own"] for row in blocks], np.diff(names.starts)).astype(np.int64)
    out = []
    for n, held in grouped_positions(names.inverse.astype(np.int64), own):
        out.append((names[n], np.unique(held).tolist()))
    yield from rows(PLACES, out)


MEMBERS = pa.schema(
    [("own", pa.int32()), ("names", pa.binary()), ("components", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("sketches", pa.binary())]
)
MEMBERS_DDL = "own int, names binary, components binary, sizes binary, words binary, sketches binary"


def pack_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, buckets, component, n, sketch) as one block per bucket."""
    for batch in batches:
        names, held, component, size, sketches = (c.to_pylist() for c in batch.columns)
        listed = np.frombuffer(b"".join(names), f"V{DIGEST}")
        component, size = np.array(component, np.int64), np.array(size, np.int64)
        words = np.array([len(x) // 8 for x in sketches], np.int64)
        who = np.repeat(np.arange(len(names)), [len(h) for h in held])
        out = []
        for bucket, (own,) in by_bucket(np.array([b for h in held for b in h], np.int64), who):
            parts = [a[own].tobytes() for a in (listed, component, size, words)]
            out.append((bucket, *parts, b"".join([sketches[i] for i in own.tolist()])))
        yield from rows(MEMBERS, out)


def open_pairs(members: np.ndarray, component: np.ndarray, size: np.ndarray, words: np.ndarray, sketches: list, block: int = 256):
    """Pairs of members (as numbers) in different components that sizes and sketches allow to be similar."""
    members = members[np.argsort(size[members], kind="stable")]
    kinds = [members[a:b] for a, b in slices(changes(words[members]))]
    stacks = [np.stack([sketches[m] for m in kind.tolist()]) for kind in kinds]
    for x in range(len(kinds)):
        for y in range(x, len(kinds)):
            left, right = stacks[x], folded(stacks[y], stacks[x].shape[1])
            for a in range(0, len(kinds[x]), block):
                own = kinds[x][a : a + block]
                begin = int(np.searchsorted(size[kinds[y]], size[own[0]]))
                end = int(np.searchsorted(3 * size[kinds[y]], 4 * size[own[-1]], side="right"))
                for lo in range(begin, end, 1024):
                    other = kinds[y][lo : min(end, lo + 1024)]
                    open_ = component[own][:, None] != component[other][None, :]
                    if x == y:
                        open_ &= np.arange(a, a + len(own))[:, None] < np.arange(lo, lo + len(other))[None, :]
                    i, j = np.nonzero(open_)
                    for k in range(0, len(i), 1 << 16):
                        p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                        different = np.bitwise_count(left[a + p] ^ right[lo + q]).sum(axis=1, dtype=np.int64)
                        near = may_match(size[own[p]], size[other[q]], different)
                        yield from zip(own[p[near]].tolist(), other[q[near]].tolist(), strict=True)


def cross_pairs(buckets: int):
    def run(key, groups_table: pa.Table, members_table: pa.Table) -> pa.Table:
        """Per bucket: all pairs to compare, from its groups and its members' components, sizes and sketches.

        Several buckets may find a pair; packed blocks take it to one task.
        """
        blocks = members_table.to_pylist()
        names = np.frombuffer(b"".join(b["names"] for b in blocks), f"S{DIGEST}")
        component, size, words = (
            np.frombuffer(b"".join(b[c] for b in blocks), np.int64) for c in ("components", "sizes", "words")
        )
        every = np.frombuffer(b"".join(b["sketches"] for b in blocks), np.uint64)
        order = np.argsort(names)  # numbers in the order of the names
        ends = np.cumsum(words)
        sketches = [every[ends[i] - words[i] : ends[i]] for i in order.tolist()]
        names, component, size, words = names[order], component[order], size[order], words[order]
        found: set[int] = set()
        for blob in groups_table.column("sets").to_pylist():
            wanted = np.frombuffer(blob, f"S{DIGEST}")
            own = np.minimum(np.searchsorted(names, wanted), max(0, len(names) - 1))
            own = own[names[own] == wanted] if len(names) else own[:0]
            if len(own) > 1 and (component[own] != component[own[0]]).any():
                found.update(min(x, y) << 32 | max(x, y) for x, y in open_pairs(own, component, size, words, sketches))
        pairs = np.array(sorted(found), np.int64)
        listed = np.frombuffer(names.tobytes(), f"V{DIGEST}")
        out = list(packed_pairs(pairs >> 32, pairs & 0xFFFFFFFF, listed, buckets))
        return pa.Table.from_batches(list(rows(PACKED, out)), PACKED)

    return run


PACKED = pa.schema([("bucket", pa.int32()), ("names", pa.binary()), ("pairs", pa.binary())])


def distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each pair of one task's blocks once."""
    blocks = [row for batch in batches for row in batch.to_pylist()]
    names, keys = Names([row["names"] for row in blocks]), []
    for i, row in enumerate(blocks):
        a, b = names.block(i)[np.frombuffer(row["pairs"], np.uint32)].astype(np.int64).reshape(2, -1)
        keys.append(a << 32 | b)
    keys = np.unique(concat(keys, np.int64))
    yield from rows(PAIRS, [(names[k >> 32], names[k & 0xFFFFFFFF]) for k in keys.tolist()])


def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, n_b, sketch_a, sketch_b) that sizes and sketches allow to be similar."""
    for batch in batches:
        out = []
        for a, b, n_a, n_b, s_a, s_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x, y = np.frombuffer(s_a, np.uint64)[None, :], np.frombuffer(s_b, np.uint64)[None, :]
            words = min(x.shape[1], y.shape[1])
            if may_match(n_a, n_b, int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())):
                out.append((a, b))
        yield from rows(PAIRS, out)


def byte_slices(batch: pa.RecordBatch, columns: list[str], most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs whose ``columns`` hold about ``most`` bytes; a longer row is a run with those around it."""
    size = sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    for a, b in slices(changes(np.cumsum(size) // most)):
        yield batch.slice(a, b - a)


def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) whose shingle sets are similar. Texts become Python objects a slice at a time."""
    hasher, kept, held = Hasher(SPLIT_LOWER), OrderedDict(), 0

    def set_of(name: bytes, text: bytes) -> np.ndarray:
        nonlocal held
        if name not in kept:
            kept[name] = next(shingle_sets([text], hasher))
            held += kept[name].nbytes
            while held > KEPT_BYTES and len(kept) > 2:
                held -= kept.popitem(last=False)[1].nbytes
        return kept[name]

    for part in (p for b in batches if b.num_rows for p in byte_slices(b, ["text_a", "text_b"], SLICE_BYTES)):
        out = []
        for i in range(part.num_rows):
            a, b, text_a, text_b = (c[i].as_py() for c in part.columns)
            x, y = set_of(a, text_a), set_of(b, text_b)
            if similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                out.append((a, b))
        yield from rows(PAIRS, out)


class Join:
    """The steps of the join over one table."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        self.spark = docs.sparkSession
        self.buckets = partitions(self.spark)
        value = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
        self.given = docs.select(F.col(key).cast("bigint").alias("row"), F.unhex(F.md5(value)).alias("text_name"), value.alias("text"))
        info = self.given.mapInArrow(
            released(describe), "row bigint, text_name binary, name binary, n bigint, sketch binary, filled array<int>"
        )
        self.info = stored(info, "shingles")
        # One node per set: the smallest id, and one text of it.
        least = self.info.where("n > 0 and row is not null").groupBy("name").agg(
            F.min(F.struct("row", "text_name")).alias("least"), F.first("n").alias("n"),
            F.first("sketch").alias("sketch"), F.first("filled").alias("filled"),
        )
        self.nodes = least.select(
            "name", F.col("least.row").alias("node"), F.col("least.text_name").alias("text_name"), "n", "sketch", "filled"
        )

    def links(self) -> DataFrame:
        """(a, b) node ids of links that connect all that is connected."""
        blocks = self.given.where("row is not null").select("text").mapInArrow(
            released(send_signatures(self.buckets)), "bucket int, keys binary, names binary"
        )
        sent = stored(dealt(blocks, self.buckets).mapInArrow(released(groups(self.buckets)), SENT_DDL), "signatures")
        shared = stored(sent.where(~F.col("kind").startswith("hot")).unionByName(self.hot_groups(sent)), "groups")
        stars = shared.where("kind = 'star'").select(F.col("to").alias("bucket"), "names", F.col("data").alias("pairs"))
        first = dealt(stars, self.buckets).mapInArrow(released(distinct_pairs), "a binary, b binary")
        sizes = self.nodes.select("name", "n", "sketch")
        both = first.join(sizes.toDF("a", "n_a", "sketch_a"), "a").join(sizes.toDF("b", "n_b", "sketch_b"), "b")
        both = both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(released(allowed), "a binary, b binary")
        found = stored(self.numbered(self.checked(stored(both, "stars"))), "near")
        packed = self.meeting(shared, found).applyInArrow(cross_pairs(self.buckets), "bucket int, names binary, pairs binary")
        pairs = dealt(packed, self.buckets).mapInArrow(released(distinct_pairs), "a binary, b binary")
        more = stored(self.checked(stored(pairs, "pairs")), "more")
        return stored(found.unionByName(self.numbered(more)).unionByName(self.repeated_ids()), "links")

    def repeated_ids(self) -> DataFrame:
        """(id, node of a set) for ids of several rows: these count as one document."""
        several = self.info.where("row is not null").groupBy("row").agg(F.count("*").alias("times")).where("times > 1")
        own = self.info.where("n > 0").join(several, "row").join(self.nodes.select("name", "node"), "name")
        return own.select(F.col("row").alias("a"), F.col("node").alias("b"))

    def meeting(self, shared: DataFrame, found: DataFrame):
        """The groups of each bucket beside its members as they are connected so far."""
        inside = shared.where("kind = 'inside'").select(F.col("to").alias("bucket"), "names", F.col("bucket").alias("own"))
        held = dealt(inside, self.buckets).mapInArrow(released(places), "name binary, buckets array<int>")
        nodes = self.nodes.join(components(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
        members = held.join(nodes, "name").select("name", "buckets", "component", "n", "sketch")
        blocks = members.mapInArrow(released(pack_members), MEMBERS_DDL)
        several = shared.where("kind = 'group'").select(F.col("bucket").alias("part"), F.col("names").alias("sets"))
        return several.groupBy("part").cogroup(blocks.groupBy("own"))

    def numbered(self, pairs: DataFrame) -> DataFrame:
        a = self.nodes.select(F.col("name").alias("a"), F.col("node").alias("node_a"))
        b = self.nodes.select(F.col("name").alias("b"), F.col("node").alias("node_b"))
        return pairs.join(a, "a").join(b, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    def checked(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs of names whose sets are similar, by their texts."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
        # One row per set, by its id too: copies stay behind, and no key holds a large group of them.
        wanted = wanted.join(self.nodes.select("name", F.col("node").alias("row"), "text_name"), "name")
        texts = stored(self.given.join(wanted, ["row", "text_name"]).groupBy("name").agg(F.first("text").alias("text")), "texts")
        a = texts.select(F.col("name").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("name").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(released(compare), "a binary, b binary")

    def hot_groups(self, sent: DataFrame) -> DataFrame:
        """Hot groups, of those sets only that have too few ranges that are not hot."""
        counts = sent.where("kind = 'hot'").select("bucket", F.col("names").alias("member"), "band", "hot")
        hot = counts.groupBy("member", "band").agg(F.sum("hot").alias("hot"))
        filled = self.nodes.select(F.col("name").alias("member"), "n", F.posexplode("filled").alias("place", "filled"))
        low = F.length(F.bin("n")) - 1
        unsafe = hot.join(filled.withColumn("band", low + F.col("place")), ["member", "band"]).where(
            "filled - hot <= floor(n / 3)"
        )
        left = counts.select("bucket", "member", "band").join(unsafe.select("member", "band"), ["member", "band"])
        held = sent.where("kind = 'hot group'").select(
            F.col("bucket").alias("part"), F.col("data").alias("sig"), F.col("names").alias("sets"), F.col("band").alias("level")
        )
        return held.groupBy("part").cogroup(left.groupBy("bucket")).applyInArrow(of_unsafe(self.buckets), SENT_DDL)


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, and the smallest key that links lead to, itself included.

    Rows of one key are one document, which is linked with what any of them is linked with.
    """
    join = Join(docs, key, text)
    settled = components(join.links())
    nodes = join.nodes.join(settled, "node", "left").select("name", F.coalesce("component", "node").alias("component_id"))
    own = F.when(F.col("row").isNotNull(), F.coalesce("component_id", "component", "row"))
    by_key = settled.withColumnRenamed("node", "row")  # for the wordless rows of a key that has others
    return join.info.join(nodes, "name", "left").join(by_key, "row", "left").select(
        F.col("row").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that with the smallest id, of rows that share it one; rows without an id stay."""
    found = near_copies(docs, key, text)
    heads = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("key")).distinct()
    # The row goes along as one value, so its column names cannot clash with those used here.
    whole = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    one = Window.partitionBy("key").orderBy(F.xxhash64("text"), F.col("text"))
    kept = whole.join(heads, "key", "left_semi").withColumn("number", F.row_number().over(one)).where(F.col("number") == 1)
    return kept.select("row").unionByName(whole.where("key is null").select("row")).select("row.*")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
