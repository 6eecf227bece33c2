"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writing: each task appends its records to archives of its own, one gzip member per record. A file gets its final
name only when it is whole, so a task that is run again replaces its own files. Reading: the driver lists files and
sizes; each task gets a byte range, looks for gzip magic in it, takes a place for a member only if the bytes from
there decompress to a WARC header, and then owns every record that starts inside its range, also when the record
ends beyond it. Paths are URIs; ``pyarrow.fs`` opens them in the tasks.

Defined results: a null html is an empty payload; a null id never is the response of a group that has an id; among
equal payloads the largest id is the response, and all rows with that id are; repeated rows are repeated records;
other columns are ignored; an empty table writes no records and reads back no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import partitions, shared_folder, stored

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES = 256 << 20
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
SLICE_ROWS = 256
DATE = "2024-01-01T00:00:00Z"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    system, inner = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return system, inner.rstrip("/")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, fields: dict[str, object], body: bytes) -> bytes:
    lines = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}"])
    return head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 3) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---------------------------------------------------------------------------------------------------------------
# Writing
# ---------------------------------------------------------------------------------------------------------------


class ArchiveWriter:
    """Members into ``<name>-<number>.warc.gz``, a new file beyond ``most`` bytes; files appear whole.

    Files of the same name that an earlier attempt left go first.
    """

    def __init__(self, folder: str, name: str, most: int):
        self.system, self.folder = open_folder(folder)
        self.name, self.most, self.number, self.out, self.size = name, most, 0, None, 0
        for f in self.system.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True)):
            if f.base_name.startswith(f"{name}-"):  # left by an earlier attempt
                self.system.delete_file(f.path)

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.system.create_dir(self.folder, recursive=True)
            self.temp = f"{self.folder}/.{self.name}-{uuid.uuid4().hex}"
            self.out, self.size = self.system.open_output_stream(self.temp), 0
        self.out.write(member)
        self.size += len(member)
        if self.size >= self.most:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.system.move(self.temp, f"{self.folder}/{self.name}-{self.number:04d}.warc.gz")
            self.out, self.number = None, self.number + 1


def with_originals(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """(key, url, payload, digest, original): ``original`` is the key of the response that a page repeats, else null.

    Only digests and keys take part in the grouping; a payload is moved once, to its place in an archive.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload")
    ).withColumn("digest", F.struct(F.sha1("payload").alias("sha1"), F.length("payload").alias("size")))
    groups = rows.groupBy("digest").agg(F.max("key").alias("newest"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = F.col("newest").eqNullSafe(F.col("key"))
    original = F.when(~same & (F.col("digest.size") >= least), F.col("newest"))
    return rows.join(groups, "digest", "left").select(
        "key", "url", "payload", F.when(F.col("newest").isNotNull(), original).alias("original")
    )


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = 0, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write all pages; a row (folder, name, records) per task that wrote. Running it writes the files."""

    def write(batches: Iterator[pa.RecordBatch]):
        name = f"part-{TaskContext.get().partitionId():05d}"
        writer, count = ArchiveWriter(folder, name, file_bytes), 0
        for row in (r for b in batches for i in range(0, b.num_rows, SLICE_ROWS) for r in b.slice(i, SLICE_ROWS).to_pylist()):
            body = row["payload"]
            fields = {
                "WARC-Target-URI": re.sub(r"[\r\n]+", " ", row["url"]) if row["url"] is not None else None,
                "X-Row-Id": row["key"],
                "WARC-Payload-Digest": f"sha1:{sha1_base32(body)}",
                "X-Payload-Length": len(body),
            }
            if row["original"] is None:
                data = record("response", fields | {"Content-Type": "text/html; charset=utf-8"}, body)
            else:
                fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                data = record("revisit", fields | {"X-Refers-To-Row": row["original"]}, b"")
            writer.add(gzip_member(data))
            count += 1
        writer.close()
        if count:
            yield pa.RecordBatch.from_pydict({"name": [name], "records": [count]})

    rows = with_originals(pages, key, url, payload, least)
    return rows.mapInArrow(write, "name string, records bigint")


# ---------------------------------------------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------------------------------------------


def ranges(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row (path, start, end) per byte range of the archives in a folder."""
    system, inner = open_folder(folder)
    listed = system.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    files = [(f.path, f.size) for f in listed if f.path.endswith(".warc.gz") and not f.base_name.startswith(".")]
    files = spark.createDataFrame(files, "path string, size bigint")
    step = F.lit(split_bytes).cast("bigint")
    return files.where("size > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, step)).alias("start")
    ).withColumn("end", F.col("start") + step)


class Source:
    """Random access over an open file through one buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def read(self, at: int, most: int = 1 << 16) -> bytes:
        """Up to ``most`` bytes from ``at`` on; fewer only where the file ends."""
        if at >= self.size:
            return b""
        if not (self.at <= at and min(at + most, self.size) <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(READ_BYTES, most))
        return self.data[at - self.at : at - self.at + most]


def member_at(source: Source, at: int) -> tuple[bytes, int] | None:
    """(data, end) of the gzip member at ``at``, or None if it does not decompress to a WARC header and a sound rest."""
    try:
        if not zlib.decompressobj(31).decompress(source.read(at, 1 << 12), 16).startswith(b"WARC/"):
            return None
        unpack, out, place = zlib.decompressobj(31), [], at
        while not unpack.eof:
            data = source.read(place)
            if not data:
                return None
            out.append(unpack.decompress(data))
            place += len(data) - len(unpack.unused_data)
    except zlib.error:
        return None
    return b"".join(out), place


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (names in lower case) and body of a record; None when the declared length is not there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    return fields, rest[: int(length)]


def records_in(source: Source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, fields, body) of every record that starts in [start, end)."""
    at = start
    while at < min(end, source.size):
        data = source.read(at)
        hit = data.find(MAGIC)
        if hit < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        found = member_at(source, at)
        parsed = parse(found[0]) if found else None
        if parsed is None:
            at += 1
            continue
        yield at, *parsed
        at = found[1]


def read_archives(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records: path, offset, kind, fields (map) and body."""
    schema = "path string, offset bigint, kind string, fields map<string,string>, body binary"
    arrow = pa.schema(
        [("path", pa.string()), ("offset", pa.int64()), ("kind", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("body", pa.binary())]
    )
    system, _ = open_folder(folder)

    def read(batches: Iterator[pa.RecordBatch]):
        rows, size = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                with system.open_input_file(part["path"]) as file:
                    source = Source(file, file.size())
                    for at, fields, body in records_in(source, part["start"], part["end"]):
                        kind = fields.get("warc-type")
                        rows.append({"path": part["path"], "offset": at, "kind": kind, "fields": list(fields.items()), "body": body})
                        size += len(body) + 1000
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    parts = ranges(spark, folder, split_bytes)
    return parts.repartition(max(partitions(spark), 1), "path", "start").mapInArrow(read, schema)


def base32_sha1(body: Column) -> Column:
    """As :func:`sha1_base32`: four times 40 bits as eight digits to base 32."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(body), 1 + i, 10), 16, 32), 8, "0") for i in range(0, 40, 10)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payloads(records: DataFrame) -> DataFrame:
    """Row id, length and digest of the payload, kind and the row referred to, of what :func:`read_archives` gives.

    Length and digest of a response are those of its body. A revisit takes them from the response of the row it
    refers to whose body has the digest that the revisit names; both are null where there is none.
    """
    field = F.col("fields")
    read = stored(
        records.select(
            field["x-row-id"].cast("bigint").alias("page_id"), F.length("body").cast("bigint").alias("bytes"), base32_sha1(F.col("body")).alias("sha1"),
            F.regexp_replace(field["warc-payload-digest"], "^sha1:", "").alias("named"), F.col("kind").alias("record_type"),
            field["x-refers-to-row"].cast("bigint").alias("refers_to"),
        ), "warc-records",
    )
    responses = read.where("record_type = 'response'")
    columns = ["page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", "refers_to"]
    bodies = responses.select(F.col("page_id").alias("refers_to"), F.col("sha1").alias("named"), "bytes", "sha1").distinct()
    revisits = read.where("record_type = 'revisit'").drop("bytes", "sha1").join(bodies, ["refers_to", "named"], "left")
    return responses.select(*columns).unionByName(revisits.select(*columns))


def op1_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    write_archives(pages, folder).write.parquet(shared_folder(spark, "warc-log"))
    return payloads(read_archives(spark, folder))
