"""Lempel-Ziv phrase fingerprints and their likeness.

A text is parsed into the phrases of an incremental (LZ78) dictionary. The set
of phrases is hashed and kept as a minimum-hash signature of ``BINS`` values
(one permutation, empty bins filled from the next). The share of equal values
estimates the resemblance of two phrase sets, a cheap stand-in for how well one
text compresses the other. Equal texts have equal fingerprints; the empty text
has an empty one, alike only to itself.

``neighbours`` compares each document with its edited text and with the next
document in descending doc_id. Rows are dealt by ranges of doc_id; the rows
that open a range are sent to the range before it too, so a task sees the
successor of its last row and texts cross the network once. NULL ids come
last; rows of one id follow the order of their texts. A NULL text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, whole_text

BINS = 128
BIN_BITS = 7
#: Characters of text a range aims at.
RANGE_CHARS = 24_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_NO_ID = -(1 << 63)


class PhraseParse:
    """An incremental dictionary parse that can be continued in two ways."""

    def __init__(self):
        self.trie: dict[int, int] = {}
        self.node = 0
        self.length = 0
        self.ends: list[int] = []

    def copy(self) -> PhraseParse:
        other = PhraseParse()
        other.trie, other.node = self.trie.copy(), self.node
        other.length, other.ends = self.length, self.ends.copy()
        return other

    def feed(self, codes: list[int]) -> PhraseParse:
        trie, node, ends = self.trie, self.node, self.ends
        find = trie.get
        for at, code in enumerate(codes, self.length + 1):
            key = node << 21 | code
            seen = find(key)
            if seen is None:
                trie[key] = len(ends) + 1
                ends.append(at)
                node = 0
            else:
                node = seen
        self.node = node
        self.length += len(codes)
        return self


def signature(codes: np.ndarray, ends: list[int]) -> np.ndarray | None:
    """The signature of the phrases that end at ``ends``, from one another on."""
    if not ends:
        return None
    # A phrase is a stretch of the text: its hash follows from running sums.
    with np.errstate(over="ignore"):
        n = len(codes)
        powers = np.full(n, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers)])
        last = np.array(ends)
        first = np.concatenate([[0], last[:-1]])
        back = np.full(n, _INVERSE, np.uint64)
        back[0] = 1
        back = np.cumprod(back)
        hashes = (sums[last] - sums[first]) * back[first]
        hashes += (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for shift, factor in ((32, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            hashes = (hashes ^ (hashes >> np.uint64(shift))) * np.uint64(factor)
        hashes ^= hashes >> np.uint64(32)
    hashes.sort()
    # Bins are the leading bits, so the least hash of a bin is its first.
    bins = (hashes >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    opens = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    filled, least = bins[opens], (hashes[opens] & np.uint64(0xFFFF)).astype(np.int64)
    at = np.searchsorted(filled, np.arange(BINS)) % len(filled)
    distance = (filled[at] - np.arange(BINS)) % BINS
    return ((least[at] + distance * 40503) & 0xFFFF).astype(">u2")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprint(text: str) -> np.ndarray | None:
    codes = _codes(text)
    return signature(codes, PhraseParse().feed(codes.tolist()).ends)


def fingerprint_pair(text: str, edited: str, common: int) -> tuple:
    """The signatures of two texts that share their first ``common`` characters."""
    if text == edited:
        mark = fingerprint(text)
        return mark, mark
    own, other = _codes(text), _codes(edited)
    shared = PhraseParse().feed(own[:common].tolist())
    forked = shared.copy()
    shared.feed(own[common:].tolist())
    forked.feed(other[common:].tolist())
    return signature(own, shared.ends), signature(other, forked.ends)


def printed(mark: np.ndarray | None) -> str:
    return "" if mark is None else mark.tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is b)
    return float(np.mean(a == b))


def edit(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced, and the length of what stays."""
    third = len(text) // 3
    stays = len(text) - third
    return text[:stays] + following[:third], stays


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """(part, extra, place, doc_id, text): each range with the row after it."""
    place = F.coalesce(F.col("doc_id"), F.lit(_NO_ID))
    ids = docs.select(place.alias("place"))
    cuts = ids.agg(
        F.percentile_approx("place", [i / parts for i in range(1, parts)], 100 * parts).alias("cuts")
    ).first()["cuts"] if parts > 1 else []
    cuts = np.array(sorted(set(cuts or [])), dtype=np.int64)

    def parts_of(places: np.ndarray) -> np.ndarray:
        return len(cuts) - np.searchsorted(cuts, places, side="left")

    def numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"part": parts_of(frame["place"].to_numpy()), "place": frame["place"]})

    # One row a range: its largest id, the first in descending order.
    tops = (
        ids.mapInPandas(numbered, "part long, place long")
        .groupBy("part")
        .agg(F.max("place").alias("top"))
        .orderBy("part")
        .collect()
    )
    before = {t.top: tops[i - 1].part for i, t in enumerate(tops)}

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame.assign(part=parts_of(frame["place"].to_numpy()), extra=0)
            yield frame
            opens = frame[frame["place"].isin(before)]
            if len(opens):
                yield opens.assign(part=opens["place"].map(before), extra=1)

    rows = docs.select(place.alias("place"), "doc_id", whole_text().alias("text"))
    shape = "place long, doc_id long, text string, part long, extra int"
    return rows.mapInPandas(deal, shape)


def neighbours(docs: DataFrame) -> DataFrame:
    """``ROWS`` for every row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // RANGE_CHARS))
    dealt = _dealt(docs, parts)
    ordered = dealt.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions(
        "part", "extra", F.col("place").desc(), "text"
    )

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        def finish(row, following: str, mark_next) -> tuple:
            _, _, doc_id, text = row
            edited, stays = edit(text, following)
            own, other = fingerprint_pair(text, edited, stays)
            return (
                (
                    doc_id,
                    len(text),
                    hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    printed(own),
                    printed(other),
                    likeness(own, other),
                ),
                own,
            )

        names = [part.split(" ")[0] for part in ROWS.split(", ")]
        # A row is finished once its successor is known, and returned once the
        # successor's signature is: `waiting` holds rows of the second kind.
        held = waiting = None
        out = []
        for frame in frames:
            for row in zip(frame["part"], frame["extra"], frame["doc_id"], frame["text"], strict=True):
                if held is not None and row[0] == held[0]:
                    values, mark = finish(held, row[3], None)
                    if waiting is not None:
                        out.append((*waiting[0], likeness(waiting[1], mark)))
                    waiting = values, mark
                    if row[1]:
                        out.append((*values, likeness(mark, fingerprint(row[3]))))
                        held = waiting = None
                        continue
                if row[1]:
                    held = waiting = None
                else:
                    held = row
                if len(out) >= 500:
                    yield _frame(out, names)
                    out = []
        if out:
            yield _frame(out, names)

    return ordered.select("part", "extra", "doc_id", "text").mapInPandas(compare, ROWS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


def op8_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "documents"))
