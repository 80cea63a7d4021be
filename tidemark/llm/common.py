"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.sieve import sieve, with_chance
from tidemark.session import shared_dir

#: Rows of a narrow key table that may be broadcast (24 bytes a row: 12 MB).
BROADCAST_KEYS = 500_000

#: Two salts make two independent 64-bit hashes of one value.
SALTS = ("tidemark-a", "tidemark-b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder: cuts lineage, prunes columns.

    Unlike a checkpoint it has its true size as a statistic, so loops do not
    inflate the planner's estimates and small tables are known to be small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Gives what this worker has freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_memory: dict[Hashable, Any] = {}


def worker_memory(owner: Hashable, make: Callable[[], Any]) -> Any:
    """What ``owner`` remembers in this worker, made once.

    Workers outlive a stage. Only one owner's memory is held at a time, so the
    operators of a pipeline do not add up in a worker.
    """
    if owner not in _memory:
        _memory.clear()
        release_memory()
        _memory[owner] = make()
    return _memory[owner]


def forget() -> None:
    """Ends what this worker remembers and gives the memory back, at a task's end."""
    _memory.clear()
    release_memory()


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the cycle collector: for work that makes many objects and no cycles."""
    collects = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collects:
            gc.enable()


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Sends workers at most ``rows`` texts at a time, a few MB, from now on.

    A worker holds one batch while it reads the next; the default of 10,000 whole
    texts each is more than a small executor has beside its heap.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside send workers at most ``rows`` rows at a time.

    For rows of some MB each, of which the usual batch would be a whole task's.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def whole_text(column: str | Column = "text") -> Column:
    """The text, a NULL counting as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def hash_pair(value: Column) -> list[Column]:
    """A 128-bit hash as two long columns."""
    return [F.xxhash64(F.lit(salt), value) for salt in SALTS]


def crc_of_id(modulus: int) -> Column:
    """``crc32`` of the id's text modulo ``modulus``; NULL ids have NULL."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def small_side(keys: DataFrame) -> DataFrame:
    """The side of a join, broadcast only if its counted rows are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def without_keys(docs: DataFrame, keys: DataFrame, names: dict[str, Column]) -> DataFrame:
    """``docs`` without the rows whose ``names`` expressions match a row of ``keys``.

    ``keys`` is counted: few rows are broadcast, so texts are not shuffled. Of more,
    a sieve of bounded size tells which rows may match; those alone are joined by
    shuffle, the others pass as they are. NULL matches NULL. Columns of ``docs`` stay
    as they are, whatever their names.
    """
    columns = docs.columns
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in columns]).alias("_row"))
    marked = marked.select("_row", *[e.alias(f"_l_{n}") for n, e in names.items()])
    left = [f"_l_{n}" for n in names]
    right = keys.select(*[F.col(n).alias(f"_r_{n}") for n in names])
    on = [F.col(f"_l_{n}").eqNullSafe(F.col(f"_r_{n}")) for n in names]
    count = keys.count()
    if count <= BROADCAST_KEYS:
        return marked.join(F.broadcast(right), on, "left_anti").select("_row.*")
    kinds = {n: marked.schema[f"_l_{n}"].dataType for n in names}
    alike = keys.select(*[F.col(n).cast(kinds[n]).alias(f"_l_{n}") for n in names])
    bitmaps = keep(sieve(alike, left, count))
    chances = with_chance(marked, left, bitmaps, bitmaps.first()["_pages"])
    kept = chances.filter("_may").join(right, on, "left_anti")
    return chances.filter("NOT _may").unionByName(kept).select("_row.*")


def ranked(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Integer names in the order of unique ``keys``; no two rows share one.

    Rows are dealt by range and sorted, so the name is the partition's number
    and the place in it. The result is written: names never change afterwards.
    """
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return keep(ordered.withColumn(name, F.monotonically_increasing_id()))


def best_rows(rows: DataFrame, keys: list[str], order: list[Column], k: int, groups: int = 256) -> DataFrame:
    """The first ``k`` rows of each key, with their ``place`` from 1.

    ``rows`` has the ``task`` that made it; rows of a key are first thinned in
    ``groups`` groups of tasks, so many tasks do not meet in one group.
    """
    for spread in ([F.col("task") % groups], []):
        own = Window.partitionBy(*keys, *spread).orderBy(*order)
        rows = rows.withColumn("place", F.row_number().over(own)).filter(F.col("place") <= k)
    return rows


def batches(frames: Iterator, size: int = 1_000_000) -> Iterator:
    """Slices of Arrow-sized pandas frames of about ``size`` characters."""
    for frame in frames:
        start = total = 0
        for i, text in enumerate(frame["text"]):
            total += len(text)
            if total >= size:
                yield frame.iloc[start : i + 1]
                start, total = i + 1, 0
        if start < len(frame):
            yield frame.iloc[start:]
