"""WARC records, their files, and the Merkle audit of replicas.

Every record is hashed as the bytes it is in its file. Hashes of an ordered
range of offsets make a node, nodes of neighbouring ranges make a parent, up to
one root per file. Replicas are compared from the roots down: only children of
differing nodes are looked at, and only records of differing ranges are
compared.

Files hold one gzip member per record, or plain records. They are written and
read as streams, record by record, so their size doesn't matter to a task.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm.common import stored

# Bytes of a lowest range, ranges of a parent, and levels above the lowest: the
# top level spans 2^15 * 16^6 bytes, 512 GB, more than any file.
RANGE_BYTES, FANOUT, LEVELS = 1 << 15, 16, 6
SEPARATOR = b"\r\n\r\n"
CHUNK = 1 << 20
GZIP_LEVEL = 6


def record_bytes(record_id: Column, uri: Column, payload: Column) -> Column:
    """A WARC resource record without its closing separator; NULL parts count as empty.

    The payload may be text or bytes; it is taken as it is.
    """
    body = F.coalesce(payload.cast("binary"), F.lit("").cast("binary"))
    headers = (
        ("WARC-Type: ", F.lit("resource")),
        ("WARC-Record-ID: ", F.concat(F.lit("<urn:x-record:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"))),
        ("WARC-Target-URI: ", F.coalesce(uri, F.lit(""))),
        ("WARC-Payload-Digest: ", F.concat(F.lit("sha256:"), F.sha2(body, 256))),
        ("Content-Length: ", F.octet_length(body).cast("string")),
    )
    lines = [F.lit("WARC/1.0"), *(F.concat(F.lit(name), value) for name, value in headers)]
    return F.concat(F.concat_ws("\r\n", *lines, F.lit(""), F.lit("")).cast("binary"), body)


def archive(pages: DataFrame, per_file: int) -> DataFrame:
    """page_id, file, record: pages as records, in files by ranges of `per_file` ids.

    Pages without an id share the file -1. Repeated pages are records of their own.
    """
    file = F.coalesce(F.floor(F.col("page_id") / per_file), F.lit(-1)).cast("bigint")
    return pages.select(
        "page_id", file.alias("file"), record_bytes(F.col("page_id"), F.col("url"), F.col("html")).alias("record")
    )


# --- Files ---------------------------------------------------------------------------


def _filesystem(path: str):
    """The file system of a path and the path on it."""
    from pyarrow import fs

    # Spark writes s3a where Arrow writes s3.
    path = re.sub("^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class _Writer:
    """One file, which takes its name once it is complete, so that tasks may be repeated."""

    def __init__(self, path: str) -> None:
        self.files, self.path = _filesystem(path)
        self.files.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        context = TaskContext.get()
        self.temporary = f"{self.path}.{context.taskAttemptId() if context else 0}.part"
        self.stream = self.files.open_output_stream(self.temporary, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.files.move(self.temporary, self.path)


def member(data: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_warc(records: DataFrame, path: str, compress: bool = True) -> int:
    """Write each `file` of `records` (page_id, file, record) below `path`; the number of files.

    Records of a file stand in order of page_id, then of their hash, each
    followed by the separator. They are compressed before the shuffle, which
    carries nothing else.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            record = [bytes(r) for r in batch["record"]]
            batch["hash"] = [hashlib.sha256(r).digest() for r in record]
            batch["record"] = [member(r + SEPARATOR) if compress else r + SEPARATOR for r in record]
            yield batch[["page_id", "file", "hash", "record"]]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, out, written = None, None, []
        for batch in batches:
            for file, record in zip(batch["file"], batch["record"]):
                if file != current:
                    if out:
                        out.close()
                    current, out = file, _Writer(file_name(path, file, compress))
                    written.append(file)
                out.write(record)
        if out:
            out.close()
        yield pd.DataFrame({"file": written}, dtype="int64")

    # The id as text: pandas would make doubles of whole numbers beside NULLs.
    rows = records.select(F.col("page_id").cast("string").alias("page_id"), "file", F.col("record").cast("binary").alias("record"))
    packed = rows.mapInPandas(pack, "page_id string, file bigint, hash binary, record binary")
    ordered = packed.repartition("file").sortWithinPartitions("file", F.col("page_id").cast("bigint"), "hash")
    return ordered.select("file", "record").mapInPandas(write, "file bigint").count()


def file_name(path: str, file: int, compress: bool = True) -> str:
    return f"{path}/pages-{file:012d}.warc" + (".gz" if compress else "")


def _chunks(files, path: str) -> Iterator[bytes]:
    with files.open_input_stream(path, compression=None) as stream:
        while data := stream.read(CHUNK):
            yield data


def _unpacked(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of gzip members; a broken one counts for what could be unpacked,
    and reading goes on at the next member."""
    held, unpack = b"", None
    for data in chunks:
        held += data
        while held:
            if unpack is None:
                at = held.find(b"\x1f\x8b\x08")
                if at < 0:
                    held = held[-2:]
                    break
                held, unpack = held[at:], zlib.decompressobj(31)
            try:
                yield unpack.decompress(held)
            except zlib.error:
                held, unpack = held[3:], None
                continue
            held = unpack.unused_data if unpack.eof else b""
            if unpack.eof:
                unpack = None


_HEAD = re.compile(rb"WARC/\d")


def cut(chunks: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """offset, bytes of the records of a stream, without their separators.

    A record whose header can't be read, or whose length leads to no separator,
    goes up to the next thing that looks like a record's start behind a
    separator, or to the end: nothing is lost. Zero bytes between records are a
    hole that a lost block left, and no record.
    """
    data, at, done = bytearray(), 0, False

    def fill(n: int) -> bool:
        nonlocal done
        while len(data) < n and not done:
            more = next(chunks, None)
            done = more is None
            data.extend(more or b"")
        return len(data) >= n

    def find(what: bytes, start: int) -> int:
        while True:
            found = data.find(what, start)
            if found >= 0 or not fill(len(data) + 1):
                return found

    while fill(1):
        if not data[0]:
            zeros = len(data) - len(data.lstrip(b"\0"))
            # The hole's own separator may be part of it.
            del data[:zeros]
            at += zeros
            if fill(4) and data[:4] == SEPARATOR:
                del data[:4]
                at += 4
            continue
        head = find(SEPARATOR, 0)
        sizes = [x[15:].strip() for x in bytes(data[: max(head, 0)]).split(b"\r\n") if x[:15].lower() == b"content-length:"]
        end = head + 4 + int(sizes[0]) if head >= 0 and _HEAD.match(data) and len(sizes) == 1 and re.fullmatch(rb"\d{1,15}", sizes[0]) else -1
        if end < 0 or (fill(end + 4) and data[end : end + 4] != SEPARATOR) or len(data) < end:
            end = find(SEPARATOR + b"WARC/", 0)
            if end < 0:
                end = len(data) - 4 if data[-4:] == SEPARATOR else len(data)
        yield at, bytes(data[:end])
        step = min(end + 4, len(data))
        del data[:step]
        at += step


def read_records(path: str) -> Iterator[tuple[int, bytes]]:
    """offset (in the unpacked file), bytes of the records of one file."""
    files, path = _filesystem(path)
    chunks = _chunks(files, path)
    return cut(_unpacked(chunks) if path.endswith(".gz") else chunks)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path of every WARC file below `path`; only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", "*.warc*").load(path).where(~F.col("path").endswith(".part")).select("path")


def read_warc(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """path, offset, length, hash, record_id, and with `content` the record, of the files below `path`.

    Each file is read as a stream by one task; see :func:`cut` for damaged files.
    `record_id` is what the header says, NULL if it says nothing.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                rows, held = [], 0
                for offset, record in read_records(file):
                    found = re.search(rb"\r\nWARC-Record-ID: *<urn:x-record:([^>\r\n]*)>", record[:4096])
                    name = found.group(1).decode("utf-8", "replace") if found else None
                    rows.append((file, offset, len(record), hashlib.sha256(record).hexdigest(), name, record if content else None))
                    held += len(record) if content else 0
                    if held > 8 * CHUNK or len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=columns)

    columns = ["path", "offset", "length", "hash", "record_id", "record"]
    schema = "path string, offset bigint, length bigint, hash string, record_id string, record binary"
    found = list_files(spark, path).mapInPandas(read, schema)
    return found if content else found.drop("record")


def rewrite(spark: SparkSession, source: str, target: str, change: Callable[[str | None, bytes], bytes]) -> int:
    """Copy the files below `source` to `target` with `change` (record id, record) made; their number."""

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                packed = file.endswith(".gz")
                out = _Writer(f"{target}/{file.rsplit('/', 1)[-1]}")
                for _, record in read_records(file):
                    found = re.search(rb"\r\nWARC-Record-ID: *<urn:x-record:([^>\r\n]*)>", record[:4096])
                    data = change(found.group(1).decode("utf-8", "replace") if found else None, record) + SEPARATOR
                    out.write(member(data) if packed else data)
                out.close()
            yield batch[["path"]]

    return list_files(spark, source).mapInPandas(copy, "path string").count()


# --- Audit ----------------------------------------------------------------------------


def leaves(records: DataFrame) -> DataFrame:
    """file, offset, length, hash of each record, from its bytes if it has no hash yet."""
    if "hash" in records.columns:
        return records.select("file", "offset", "length", "hash")
    data = F.coalesce(F.col("record"), F.lit("")).cast("binary")
    return records.select(
        "file", "offset", F.octet_length(data).cast("bigint").alias("length"), F.sha2(data, 256).alias("hash")
    )


def tree_levels(hashed: DataFrame) -> list[DataFrame]:
    """file, node, hash of every level, lowest first; the last has one node per file.

    A node's hash covers its children in order, with their places, so that
    moved records show. A node has at most as many children as a range has
    records, or `FANOUT`.
    """
    node = F.floor(F.col("offset") / RANGE_BYTES).cast("bigint")
    child = F.struct(F.col("offset").alias("at"), "length", "hash")
    current = hashed.groupBy("file", node.alias("node")).agg(_joined(child, ("at", "length", "hash")))
    levels = [stored(current, "tree")]
    for level in range(LEVELS):
        last = level == LEVELS - 1
        parent = F.lit(0).cast("bigint") if last else F.floor(F.col("node") / FANOUT).cast("bigint")
        child = F.struct(F.col("node").alias("at"), "hash")
        current = levels[-1].groupBy("file", parent.alias("parent")).agg(_joined(child, ("at", "hash")))
        levels.append(stored(current.withColumnRenamed("parent", "node"), "tree"))
    return levels


def _joined(child: Column, parts: tuple[str, ...]) -> Column:
    """Hash of the ordered children."""
    texts = F.transform(
        F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(":", *(c[p].cast("string") for p in parts))
    )
    return F.sha2(F.array_join(texts, "|").cast("binary"), 256).alias("hash")


def differing_ranges(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """file, node of the lowest ranges whose hashes differ, found from the roots down."""
    suspects = None
    for level in range(len(left) - 1, -1, -1):
        sides = []
        for tree in (left[level], right[level]):
            if suspects is not None:
                up = F.lit(0).cast("bigint") if level == LEVELS - 1 else F.floor(F.col("node") / FANOUT).cast("bigint")
                tree = tree.withColumn("parent", up).join(suspects, ["file", "parent"], "left_semi").drop("parent")
            sides.append(tree)
        a, b = sides[0].alias("a"), sides[1].alias("b")
        same_place = (F.col("a.file") == F.col("b.file")) & (F.col("a.node") == F.col("b.node"))
        both = a.join(b, same_place, "full").where(~F.col("a.hash").eqNullSafe(F.col("b.hash")))
        found = both.select(F.coalesce("a.file", "b.file").alias("file"), F.coalesce("a.node", "b.node").alias("node"))
        suspects = stored(found.withColumnRenamed("node", "parent"), "suspects")
        if suspects.isEmpty():
            break
    return suspects.withColumnRenamed("parent", "node")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """file, offset, status of the records that differ: damaged, missing or extra in the replica.

    Both hold file and offset, and either the record or its length and hash.
    Records are named by file and offset; NULL records count as empty. Records
    moved by a change of length before them are missing at the old offset and
    extra at the new one. Repeated places are compared by their smallest and
    largest hash and their number. Two empty tables have no differences.
    """
    sides = [stored(leaves(x), "leaves") for x in (primary, replica)]
    trees = [tree_levels(x) for x in sides]
    suspects = differing_ranges(*trees)
    node = F.floor(F.col("offset") / RANGE_BYTES).cast("bigint")
    # Only records of differing ranges are read further.
    near = [
        x.withColumn("node", node)
        .join(suspects, ["file", "node"], "left_semi")
        .groupBy("file", "offset")
        .agg(F.struct(F.min("hash"), F.max("hash"), F.count(F.lit(1))).alias("seen"))
        for x in sides
    ]
    a, b = near[0].alias("a"), near[1].alias("b")
    place = (F.col("a.file") == F.col("b.file")) & (F.col("a.offset") == F.col("b.offset"))
    status = (
        F.when(F.col("b.seen").isNull(), "missing").when(F.col("a.seen").isNull(), "extra").otherwise("damaged")
    )
    return a.join(b, place, "full").where(~F.col("a.seen").eqNullSafe(F.col("b.seen"))).select(
        F.coalesce("a.file", "b.file").alias("file"),
        F.coalesce("a.offset", "b.offset").alias("offset"),
        status.alias("status"),
    )
