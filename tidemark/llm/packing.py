"""Best-fit packing of token sequences with a bounded number of open bins.

Each task packs its documents online: a piece goes to the open bin with the
least free space that still holds it. The open bins are a bitset keyed by free
space (bit f is set when a bin with f free tokens is open), so the best fit is
the lowest set bit at or above the piece's length. At most ``open_bins`` bins
are open; opening one more closes the fullest.

Bins that a task still holds open at its end travel on as items of a second
packing with a sixteenth of the tasks, and so on down to one task, whose input
is at most 16 x ``open_bins`` items however large the corpus is. A bin is moved
whole, so its documents keep their order and only the offset shifts.

Documents longer than ``capacity`` are cut into full pieces and a rest; full
pieces are bins of their own. Empty texts still hold the end token. Rows with a
NULL id and repeated rows are packed like any others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, forget, keep, table, whole_text
from tidemark.llm.token_ids import REMEMBERED, TextEncoder, tokenizer_path

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 1024
FAN_IN = 16

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """The open bins of one task, in a bitset keyed by free space."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free_bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins: dict[int, list[int]] = {}
        self.count = self.next_bin = 0

    def _put(self, bin_no: int, free: int) -> None:
        self.by_free[free].append(bin_no)
        self.free_bits |= 1 << free

    def _take(self, free: int) -> int:
        bin_no = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free_bits &= ~(1 << free)
        return bin_no

    def add(self, item: int, length: int) -> list[tuple[list[int], int]]:
        """Place an item; returns the bins (items, free) that close for it."""
        closed = []
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bin_no = self._take(free)
        else:
            if len(self.bins) >= self.limit:
                fullest = (self.free_bits & -self.free_bits).bit_length() - 1
                closed.append((self.bins.pop(self._take(fullest)), fullest))
            free, bin_no = self.capacity, self.next_bin
            self.next_bin += 1
            self.bins[bin_no] = []
        self.bins[bin_no].append(item)
        left = free - length
        if left == 0:
            closed.append((self.bins.pop(bin_no), 0))
        else:
            self._put(bin_no, left)
        return closed

    def rest(self) -> list[tuple[list[int], int]]:
        """All bins still open, the fullest first."""
        out = []
        for free, numbers in enumerate(self.by_free):
            out += [(self.bins[n], free) for n in numbers]
        return out


def pieces_of(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    remembered: int = REMEMBERED,
    forgetful: bool = False,
) -> DataFrame:
    """The pieces (``PIECES``) of every document: ids and the end id, cut."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = TextEncoder.of(path, remembered)
        end = END_ID.to_bytes(4, "little")
        step = 4 * capacity
        for frame in batches(frames):
            rows = []
            for doc_id, ids in zip(frame["doc_id"], encoder.encode(frame["text"].tolist()), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
        if forgetful:
            forget()

    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(cut, PIECES)


def _pack_round(items: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """One online packing per task of ``items(length, pieces)``.

    ``pieces`` is an array of the piece structs of an item in order. Returns
    items again; ``closed`` tells the bins that closed before the task's end.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenBins(capacity, open_bins)
        held: dict[int, list] = {}
        number = 0

        def gathered(members: list[int]) -> list:
            return [piece for m in members for piece in held.pop(m)]

        for frame in frames:
            out = []
            for length, pieces in zip(frame["length"], frame["pieces"], strict=True):
                held[number] = list(pieces)
                for members, free in bins.add(number, int(length)):
                    out.append((capacity - free, gathered(members), True))
                number += 1
            if out:
                yield pd.DataFrame(out, columns=["length", "pieces", "closed"])
        out = [(capacity - free, gathered(members), False) for members, free in bins.rest()]
        if out:
            yield pd.DataFrame(out, columns=["length", "pieces", "closed"])

    return items.mapInPandas(run, f"length long, pieces array<struct<{_fields()}>>, closed boolean")


def _fields() -> str:
    return ", ".join(part.replace(" ", ": ", 1) for part in PIECES.split(", "))


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces (``PIECES``) with their ``sequence_id`` and ``offset``."""
    names = [part.split(" ")[0] for part in PIECES.split(", ")]
    items = pieces.select("length", F.array(F.struct(*names)).alias("pieces"))
    closed = None
    while True:
        done = keep(_pack_round(items, capacity, open_bins))
        still = done.filter("NOT closed").select("length", "pieces")
        tasks = still.select(F.spark_partition_id().alias("task")).distinct().count()
        final = done if tasks <= 1 else done.filter("closed")
        closed = final if closed is None else closed.unionByName(final)
        if tasks <= 1:
            break
        # Longest first within a task: large items are settled, small ones fill the gaps.
        items = still.coalesce(-(-tasks // FAN_IN))
        items = items.sortWithinPartitions(F.col("length").desc(), "pieces")
    numbered = closed.select(F.monotonically_increasing_id().alias("sequence_id"), "pieces")
    placed = numbered.select(
        "sequence_id",
        F.expr(
            "transform(pieces, (p, i) -> struct(p, "
            "aggregate(slice(pieces, 1, i), 0L, (a, q) -> a + q.length) AS offset))"
        ).alias("placed"),
    )
    each = placed.select("sequence_id", F.inline("placed"))
    return each.select("p.*", "sequence_id", "offset")


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    remembered: int = REMEMBERED,
    forgetful: bool = False,
) -> DataFrame:
    """Every document of ``docs(doc_id, text)`` cut and packed.

    ``remembered`` bounds what a worker keeps of earlier texts, and a ``forgetful`` one
    gives it back after each task: that costs time where memory is short, and changes
    no result.
    """
    return pack(pieces_of(docs, path, capacity, remembered, forgetful), capacity, open_bins)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
