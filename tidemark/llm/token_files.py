"""Token ids in files of patched frame-of-reference blocks, and their reader.

A shard file holds the ids of consecutive documents in ascending doc_id order::

    magic "PFOR1\\0\\0\\0"
    blocks of up to 4096 ids, one after another
    index  u64 byte position of each block
    docs   i64 doc_id, u64 number of ids, of each document; of one with a NULL id
           0, and the number's top bit is set
    footer u64 number of blocks, u64 number of documents, u64 number of ids, magic

A block stores ``id - minimum`` in as many bits as the ``PERCENTILE`` of its
values needs; larger values are exceptions: their low bits are packed like the
rest and their position and high bits stand in a list after the packed words::

    u16 ids, u8 width, u8 zero, u32 minimum, u16 exceptions, u16 zero,
    packed bits (padded to a byte), u16 positions, u32 high parts

All numbers are little-endian. The index gives random access to any block. A
file is written under a name of its own attempt and then renamed, so a task that
is repeated after a lost executor replaces it with equal bytes.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import batches, keep, small_side, table, whole_text
from tidemark.llm.token_ids import TextEncoder, tokenizer_path
from tidemark.session import shared_dir

MAGIC = b"PFOR1\0\0\0"
BLOCK = 4096
PERCENTILE = 95
END_ID = 1
#: Ids after which a task starts its next file (bounds a reader's memory).
SHARD_IDS = 4_000_000
NAMELESS = 1 << 63


def _packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after another from the lowest bit."""
    if width == 0:
        return b""
    if width > 16:
        octets = values.astype("<u4").view(np.uint8).reshape(len(values), -1)
        bits = np.unpackbits(octets, axis=1, count=width, bitorder="little")
        return np.packbits(bits.ravel(), bitorder="little").tobytes()
    # Four values make a word of at most 64 bits, and two such words ``width`` bytes.
    padded = np.zeros(-(-len(values) // 8) * 8, np.uint64)
    padded[: len(values)] = values & np.uint32((1 << width) - 1)
    fours = padded.reshape(-1, 4)
    words = fours[:, 0].copy()
    for place in (1, 2, 3):
        words |= fours[:, place] << np.uint64(place * width)
    pairs = words.reshape(-1, 2)
    out = pairs.copy()
    if width < 16:
        out[:, 0] |= pairs[:, 1] << np.uint64(4 * width)
        out[:, 1] >>= np.uint64(64 - 4 * width)
    packed = out.astype("<u8").view(np.uint8).reshape(-1, 16)[:, :width].tobytes()
    return packed[: (len(values) * width + 7) // 8]


def _unpacked(data: bytes, at: int, size: int, count: int, width: int) -> np.ndarray:
    """``count`` values of ``width`` bits from ``size`` bytes."""
    if width == 0:
        return np.zeros(count, np.uint32)
    octets = np.frombuffer(data, np.uint8, size, at)
    if width > 16:
        bits = np.unpackbits(octets, bitorder="little")
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :width] = bits[: count * width].reshape(count, width)
        return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)
    groups = -(-count // 8)
    filled = np.zeros(groups * width, np.uint8)
    filled[:size] = octets
    wide = np.zeros((groups, 16), np.uint8)
    wide[:, :width] = filled.reshape(groups, width)
    pairs = wide.view("<u8").astype(np.uint64)
    words = pairs.copy()
    if width < 16:
        words[:, 0] &= np.uint64((1 << (4 * width)) - 1)
        words[:, 1] = (pairs[:, 0] >> np.uint64(4 * width)) | (pairs[:, 1] << np.uint64(64 - 4 * width))
    values = np.empty((groups, 2, 4), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for place in range(4):
        values[:, :, place] = (words >> np.uint64(place * width)) & mask
    return values.ravel()[:count]


def pack_block(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    values = (ids - low).astype(np.uint32)
    rank = (len(values) * PERCENTILE - 1) // 100
    width = int(np.partition(values, rank)[rank]).bit_length()
    high = values >> np.uint32(width) if width < 32 else np.zeros_like(values)
    at = np.flatnonzero(high).astype("<u2")
    head = struct.pack("<HBBIHH", len(ids), width, 0, low, len(at), 0)
    return head + _packed(values, width) + at.tobytes() + high[at].astype("<u4").tobytes()


def unpack_block(data: bytes, at: int) -> np.ndarray:
    n, width, _, low, odd, _ = struct.unpack_from("<HBBIHH", data, at)
    at += 12
    size = (n * width + 7) // 8
    values = _unpacked(data, at, size, n, width)
    where = np.frombuffer(data, "<u2", odd, at + size)
    values[where] |= np.frombuffer(data, "<u4", odd, at + size + 2 * odd) << np.uint32(width)
    return values + np.uint32(low)


def shard_bytes(docs: list[tuple[int | None, bytes]]) -> bytes:
    """The file of documents given as (doc_id, ids as u32 bytes)."""
    ids = np.frombuffer(b"".join(d for _, d in docs), dtype="<u4")
    out, index = [MAGIC], []
    at = len(MAGIC)
    for start in range(0, len(ids), BLOCK):
        block = pack_block(ids[start : start + BLOCK])
        index.append(at)
        at += len(block)
        out.append(block)
    rows = ((0, NAMELESS | len(d) // 4) if i is None else (i, len(d) // 4) for i, d in docs)
    table_of_docs = b"".join(struct.pack("<qQ", *r) for r in rows)
    footer = struct.pack("<QQQ", len(index), len(docs), len(ids)) + MAGIC
    return b"".join([*out, np.array(index, dtype="<u8").tobytes(), table_of_docs, footer])


def read_shard(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every document of a file, in order."""
    blocks, docs, _ = struct.unpack_from("<QQQ", data, len(data) - 32)
    if data[-8:] != MAGIC or data[:8] != MAGIC:
        raise ValueError("not a token file")
    docs_at = len(data) - 32 - 16 * docs
    index = np.frombuffer(data, "<u8", blocks, docs_at - 8 * blocks)
    parts = [unpack_block(data, int(at)) for at in index]
    ids = np.concatenate([np.zeros(0, np.uint32), *parts]).astype("<u4")
    start = 0
    for doc_id, n in struct.iter_unpack("<qQ", data[docs_at : docs_at + 16 * docs]):
        if n & NAMELESS:
            doc_id, n = None, n ^ NAMELESS
        yield doc_id, ids[start : start + n]
        start += n


def _write(folder: str, name: str, data: bytes) -> None:
    """One file, complete or absent, on a local or a remote file system."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (None, folder.removeprefix("file:"))
    draft = f"{root}/.{name}.{uuid.uuid4().hex}"
    if system is None:
        system = fs.LocalFileSystem()
    system.create_dir(root, recursive=True)
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{root}/{name}")


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
    null_ids: bool = False,
) -> DataFrame:
    """Write ``docs(doc_id, text)`` in ascending doc_id order; returns a row per file.

    Rows are dealt by ranges of doc_id and sorted, so files follow each other in
    order of (task, number). A NULL text is empty. Rows of one id follow the order
    of their texts. Rows with a NULL id come first with ``null_ids``, dealt by
    ranges of their texts too; without it they are refused.
    """
    end = end_id.to_bytes(4, "little")

    def write(task: int, held: list, number: int) -> pd.DataFrame:
        data = shard_bytes(held)
        name = f"{task:06d}-{number:06d}.pfor"
        _write(folder, name, data)
        ids = sum(len(d) // 4 for _, d in held)
        return pd.DataFrame({"file": [name], "ids": [ids], "docs": [len(held)], "bytes": [len(data)]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder = TextEncoder.of(path)
        task = TaskContext.get().partitionId()
        held, total, number = [], 0, 0
        for frame in batches(frames):
            nameless = frame["nameless"].to_numpy()
            if nameless.any() and not null_ids:
                raise ValueError("doc_id is NULL: a token file needs one for every document")
            names = [None if n else int(i) for i, n in zip(frame["doc_id"], nameless, strict=True)]
            for doc_id, ids in zip(names, encoder.encode(frame["text"].tolist()), strict=True):
                held.append((doc_id, ids + end))
                total += len(ids) // 4 + 1
                if total >= shard_ids:
                    yield write(task, held, number)
                    held, total, number = [], 0, number + 1
        if held:
            yield write(task, held, number)

    ordered = docs.select("doc_id", whole_text().alias("text"))
    nameless = F.col("doc_id").isNull()
    ordered = ordered.repartitionByRange("doc_id", F.when(nameless, F.col("text")))
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    # A NULL would turn a batch's ids into floats.
    ordered = ordered.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text", nameless.alias("nameless"))
    return keep(ordered.mapInPandas(run, "file string, ids long, docs long, bytes long"))


def read_token_files(spark: SparkSession, folder: str, written: DataFrame) -> DataFrame:
    """Every document of the listed files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: those of earlier files and
    of earlier documents of its own file. Documents carry their file's name, so that
    it is narrow rows, and no file's content, that meet the files' offsets.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["file"], frame["content"], strict=True):
                names, places, sizes, sums, start = [], [], [], [], 0
                for doc_id, ids in read_shard(content):
                    names.append(doc_id)
                    places.append(start)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids))
                    start += len(ids)
                yield pd.DataFrame(
                    {
                        "file": name,
                        "doc_id": pd.array(names, dtype="Int64"),
                        "place": places,
                        "n_tokens": sizes,
                        "ids_crc32": sums,
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    docs = named.mapInPandas(run, "file string, doc_id long, place long, n_tokens long, ids_crc32 long")
    placed = docs.join(small_side(keep(offsets_of(written))), "file")
    start = (F.col("first") + F.col("place")).alias("start")
    return placed.select("doc_id", start, "n_tokens", "ids_crc32")


def offsets_of(written: DataFrame, block: int = 1024) -> DataFrame:
    """(file, first): the ids of all files before each, by sums over tasks and blocks.

    A file's name is its task and its number. Only one row for each ``block`` tasks
    meets in one window.
    """
    parts = F.split(F.element_at(F.split("file", "[.]"), 1), "-")
    files = written.select("file", "ids", parts[0].cast("long").alias("task"), parts[1].cast("long").alias("number"))
    files = files.withColumn("block", F.expr(f"task div {block}"))

    def before(sums: DataFrame, keys: list[str], order: str, name: str) -> DataFrame:
        window = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(order)
        earlier = F.sum("ids").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return sums.withColumn(name, F.coalesce(earlier, F.lit(0)))

    tasks = files.groupBy("block", "task").agg(F.sum("ids").alias("ids"))
    blocks = tasks.groupBy("block").agg(F.sum("ids").alias("ids"))
    blocks = before(blocks, [], "block", "blocks_before").select("block", "blocks_before")
    tasks = before(tasks, ["block"], "task", "tasks_before").select("task", "tasks_before")
    files = before(files, ["task"], "number", "files_before")
    files = files.join(small_side(keep(tasks)), "task").join(small_side(keep(blocks)), "block")
    first = F.col("files_before") + F.col("tasks_before") + F.col("blocks_before")
    return files.select("file", first.alias("first"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    written = write_token_files(docs, tokenizer_path(), folder, null_ids=True)
    if written.isEmpty():
        return docs.select(
            F.col("doc_id").cast("long"),
            *[F.lit(0).cast(LongType()).alias(c) for c in ("start", "n_tokens", "ids_crc32")],
        ).limit(0)
    return read_token_files(spark, folder, written)
