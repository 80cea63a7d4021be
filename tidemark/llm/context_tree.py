"""Language-model scores by context-tree weighting over byte contexts.

The scored event is the token stream of a text: A-Z lower-cased, its words (split
at ASCII white space) joined by one space, then an end byte. Each byte is eight
binary decisions. A decision at context depth d has a node (last d bytes, bits of
the byte so far) with counts (a, b) of training data and the Krichevsky-Trofimov
estimate (b + 1/2) / (a + b + 1). Weighting gives a node

    P_w = 1/2 KT + 1/2 prod P_w(children),     weight = KT / (KT + prod P_w(children))

and a prediction mixes the estimates of all depths: from the deepest node of the
context that exists up to the root, p = weight * KT + (1 - weight) * p(deeper).
Which nodes exist does not depend on the bit, so probabilities sum to one.

Every context of up to ``DEPTH`` bytes that training texts hold is a node, however
rare: the tree grows with the corpus and nobody holds it whole. A byte's score depends
on its gram alone, the byte and the ``DEPTH`` before it:

* texts are taken in blocks of about ``BLOCK`` characters; a block asks for its distinct
  grams and tells how often training texts have them;
* buckets of grams, by a hash of their last ``SPLIT`` bytes, build the subtrees of
  their contexts from the counts of all blocks and work out what the depths from
  ``SPLIT`` on predict for each gram;
* the depths above are one small tree of at most 256 ** (SPLIT - 1) contexts, whatever
  the corpus; it is weighed by the driver and completes the scores of the buckets;
* scores go back to the blocks that asked, where they meet the texts again.

The base score needs the exact count of every token. Counts are summed by Spark;
tokens of at least ``FREQUENT`` of all occurrences (so at most 1 / ``FREQUENT``)
are sent to the workers, the others are joined. Tokens are identified by a 64-bit
hash. NULL texts are empty: one end token. NULL ids are not held out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batch_rows, batches, crc_of_id, keep, release_memory, table, whole_text

#: Bytes of context; with the byte itself a gram has to fit 64 bits.
DEPTH = 6
#: Depths from here on are worked out in buckets of their contexts, those above by the driver.
SPLIT = 3
#: Characters of a block of texts, and of all texts for each bucket of grams.
BLOCK = 32 << 20
BUCKET = 8 << 20
FREQUENT = 5e-6
END = b"\n"
#: Grams of texts that are gathered before they are counted.
TALLIED = 2 << 20
#: Texts, and rows of blobs (of some MB) that a worker is sent at once.
TEXTS_AT_ONCE, BLOBS = 1_000, 8
#: Bytes handled at once, and distinct tokens a task gathers before it passes them on.
WINDOW = 1 << 20
GATHERED = 500_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def token_hashes(tokens: list[bytes] | np.ndarray) -> np.ndarray:
    return pd.util.hash_array(np.array(tokens, object), categorize=False).view(np.int64)


def streams(docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte stream, and where each one's own bytes begin and end.

    ``DEPTH`` end bytes stand before every text as the context of its start.
    """
    return stream([b" ".join(words) for words in docs])


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``streams`` of texts whose words are joined already."""
    parts = [END * DEPTH + text + END for text in texts]
    ends = np.cumsum([0] + [len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), ends


def coded_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of a stream start, their codes, and the token hash of each code."""
    gap = (data == ord(" ")) | (data == ord(END))
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    lengths = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1 - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])]
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    hashes = token_hashes(coded.dictionary.to_numpy(zero_copy_only=False))
    return starts, coded.indices.to_numpy(), hashes


def grams(data: np.ndarray) -> np.ndarray:
    """Context and byte at each position from ``DEPTH`` on: latest byte first, then the byte."""
    n = len(data) - DEPTH
    out = np.zeros(max(n, 0), np.uint64)
    for back in range(1, DEPTH + 1):
        out = (out << np.uint64(8)) | data[DEPTH - back : DEPTH - back + n]
    return (out << np.uint64(8)) | data[DEPTH:]


def own_positions(ends: np.ndarray) -> np.ndarray:
    """Marks of the gram positions that belong to a text, not to its padding."""
    own = np.ones(max(int(ends[-1]) - DEPTH, 0), bool)
    for start in ends[1:-1]:
        own[start - DEPTH : start] = False
    return own


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 (shifted Stirling series)."""
    y = np.array(x, np.float64)
    shift = np.zeros_like(y)
    for _ in range(7):
        low = y < 7
        shift[low] -= np.log(y[low])
        y[low] += 1
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)


#: Nearly all nodes are seen a few times; their values are looked up.
FEW = 64
_FEW = _log_kt(*np.indices((FEW, FEW)).astype(np.float64))


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a zeros and b ones (whole numbers)."""
    few = (a < FEW) & (b < FEW)
    out = np.empty(len(few))
    out[few] = _FEW[a[few].astype(np.int64), b[few].astype(np.int64)]
    out[~few] = _log_kt(a[~few], b[~few])
    return out


def contexts(gram: np.ndarray, depth: int) -> np.ndarray:
    """The last ``depth`` bytes before each byte, with room for eight bits below."""
    if depth == 0:
        return np.zeros(len(gram), np.uint64)
    return (gram >> np.uint64(8 * (DEPTH - depth) + 8)) << np.uint64(8)


def node_keys(gram: np.ndarray, depth: int, bit: int) -> np.ndarray:
    """The node of each gram's decision ``bit`` at a depth: context bytes, bits before it."""
    byte = gram & np.uint64(255)
    return contexts(gram, depth) | np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))


def decided(gram: np.ndarray, bit: int) -> np.ndarray:
    return ((gram >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)


def shorter(gram: np.ndarray, count: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams cut to ``depth`` context bytes, in order, and their counts."""
    if depth < DEPTH:
        unused = np.uint64(8 * (DEPTH - depth))
        gram = contexts(gram, depth) << unused | (gram & np.uint64(255))
        gram, where = np.unique(gram, return_inverse=True)
        count = np.bincount(where, count, minlength=len(gram))
    return gram, count


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each value of ordered ones stands first."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])


def nodes_at(gram: np.ndarray, count: np.ndarray, depth: int, bit: int) -> tuple[np.ndarray, ...]:
    """(key, zeros, ones) of a depth's nodes of decision ``bit``, keys in order as the grams are."""
    key = node_keys(gram, depth, bit)
    first = firsts(key)
    total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
    one = np.add.reduceat(count * decided(gram, bit), first) if len(first) else np.zeros(0)
    return key[first], total - one, one


def parents(key: np.ndarray) -> np.ndarray:
    """The key of the node one byte less deep: the oldest byte goes."""
    return ((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(255))


def below(key: np.ndarray, children: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The sum of log P_w over each node's children, given as (key, log P_w)."""
    at = np.searchsorted(key, parents(children[0]))
    return np.bincount(at, children[1], minlength=len(key))


def weigh(a: np.ndarray, b: np.ndarray, lower: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(weight, log P_w) of nodes; ``lower`` is the sum of log P_w of their children."""
    own = log_kt(a, b)
    if lower is None:
        return np.ones(len(a)), own
    weight = 1 / (1 + np.exp(np.clip(lower - own, -700, 700)))
    return weight, np.logaddexp(own, lower) - math.log(2)


@dataclass
class Level:
    """The nodes of a depth: keys in order, the chances of a zero and of a one, weights.

    Both chances are kept, as one less a chance close to one is nothing.
    """

    key: np.ndarray
    chance: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(key: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> Level:
        both = a + b + 1
        return Level(key, np.stack([(a + 0.5) / both, (b + 0.5) / both], axis=1), weight)


class Mix:
    """The mixed chance of one decision of many grams, depth by depth from above.

    ``chance`` is the mix if the last depth that had a node is the deepest; ``before``
    is what that depth and those above it add, ``rest`` what they leave to deeper ones.
    """

    def __init__(self, count: int):
        self.chance = np.full(count, np.nan)
        self.before, self.rest = np.zeros(count), np.ones(count)

    def add(self, level: Level, key: np.ndarray, one: np.ndarray) -> None:
        if not len(level.key):
            return
        at = np.minimum(np.searchsorted(level.key, key), len(level.key) - 1)
        hit = np.flatnonzero(level.key[at] == key)
        at = at[hit]
        chance, weight = level.chance[at, one[hit]], level.weight[at]
        rest = self.rest[hit]
        self.chance[hit] = self.before[hit] + rest * chance
        self.before[hit] += rest * weight * chance
        self.rest[hit] = rest * (1 - weight)


def subtrees(cuts: list[tuple[np.ndarray, np.ndarray]], bit: int) -> tuple[list[Level], tuple[np.ndarray, ...]]:
    """The levels ``SPLIT`` to ``DEPTH`` of a decision, and the depth above them.

    That is (key, zeros, ones, sum of the children's log P_w): the part of these grams.
    ``cuts`` are the trained grams and counts cut to ``DEPTH`` bytes and fewer.
    """
    levels, children = [], None
    for depth, (gram, count) in zip(range(DEPTH, SPLIT - 1, -1), cuts, strict=False):
        key, a, b = nodes_at(gram, count, depth, bit)
        weight, log_w = weigh(a, b, None if children is None else below(key, children))
        children = key, log_w
        levels.append(Level.of(key, a, b, weight))
    key, a, b = nodes_at(*cuts[-1], SPLIT - 1, bit)
    return levels[::-1], (key, a, b, below(key, children))


def deep_chances(trained: np.ndarray, count: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """What the depths from ``SPLIT`` on predict, and the depth above them, keys in order.

    (gram, decision) chances of the ``asked`` grams by the tree of the ``trained``, NaN where
    it has no node. No decision shares a node with another: they are taken one at a time.
    """
    cuts = [(trained, count.astype(np.float64))]
    for depth in range(DEPTH - 1, SPLIT - 2, -1):
        cuts.append(shorter(*cuts[-1], depth))
    out, sums = np.empty((len(asked), 8)), []
    for bit in range(8):
        levels, above = subtrees(cuts, bit)
        sums.append(above)
        mix, one = Mix(len(asked)), decided(asked, bit)
        for depth, level in enumerate(levels, SPLIT):
            mix.add(level, node_keys(asked, depth, bit), one)
        out[:, bit] = mix.chance
    above = [np.concatenate(x) for x in zip(*sums, strict=True)]
    order = np.argsort(above[0])
    return out, tuple(x[order] for x in above)


def top_levels(key: np.ndarray, a: np.ndarray, b: np.ndarray, lower: np.ndarray) -> list[Level]:
    """The levels above ``SPLIT`` from the sums of all buckets, keys in order."""
    levels = []
    for _ in range(SPLIT):
        weight, log_w = weigh(a, b, lower)
        levels.append(Level.of(key, a, b, weight))
        up, where = np.unique(parents(key), return_inverse=True)
        a, b, lower = (np.bincount(where, x, minlength=len(up)) for x in (a, b, log_w))
        key = up
    return levels[::-1]


def gram_scores(top: list[Level], gram: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """log10 of each gram's byte in its context."""
    total = np.zeros(len(gram))
    # The depths above see the latest bytes only: few grams differ in them.
    seen = contexts(gram, SPLIT - 1) | (gram & np.uint64(255))
    _, first, where = np.unique(seen, return_index=True, return_inverse=True)
    few = gram[first]
    for bit in range(8):
        mix, one = Mix(len(few)), decided(few, bit)
        for depth, level in enumerate(top):
            mix.add(level, node_keys(few, depth, bit), one)
        own = deep[:, bit].astype(np.float64)
        chance = np.where(np.isnan(own), mix.chance[where], mix.before[where] + mix.rest[where] * own)
        total += np.log10(np.where(np.isnan(chance), 0.5, chance))
    return total


def scores_of(trained: np.ndarray, count: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """log10 of the bytes of ``asked`` grams by the tree of ``trained`` ones (in order).

    What buckets and driver do, in one piece.
    """
    deep, sums = deep_chances(trained, count, asked)
    return gram_scores(top_levels(*sums), asked, deep)


@cache
def _press() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@cache
def _unpress() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def planes(values: np.ndarray, kind: str = "<u8") -> bytes:
    """Numbers with their lowest bytes together, then the next, pressed: most are alike."""
    octets = np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return _press().compress(octets.T.tobytes())


def from_planes(data: bytes, kind: str = "<u8") -> np.ndarray:
    octets = np.frombuffer(_unpress().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T
    return np.ascontiguousarray(octets).view(kind).ravel()


def squeezed(ordered: np.ndarray) -> bytes:
    """Ordered numbers by their differences."""
    return planes(np.diff(ordered.astype(np.uint64), prepend=np.uint64(0)))


def unsqueezed(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint64)


class GramTable:
    """The scores of a block's grams, found by the high bits of a hash."""

    def __init__(self, gram: np.ndarray, score: np.ndarray):
        self.mixed = gram * ODD
        order = np.argsort(self.mixed)
        self.mixed, self.score = self.mixed[order], score[order]
        del order
        bits = max(1, len(gram).bit_length())
        self.shift = np.uint64(64 - bits)
        high = self.mixed >> self.shift
        self.starts = np.empty((1 << bits) + 1, np.uint32 if len(gram) < 1 << 32 else np.int64)
        for start in range(0, len(self.starts), WINDOW):
            part = self.starts[start : start + WINDOW]
            part[:] = np.searchsorted(high, np.arange(start, start + len(part), dtype=np.uint64))

    def __getitem__(self, gram: np.ndarray) -> np.ndarray:
        mixed = gram * ODD
        at = self.starts[(mixed >> self.shift).astype(np.int64)].astype(np.int64)
        at = np.minimum(at, len(self.mixed) - 1)
        lost = np.flatnonzero(self.mixed[at] != mixed)
        while len(lost):
            at[lost] += 1
            if at[lost].max() >= len(self.mixed):
                raise ValueError("a block holds a gram that it has not asked for")
            lost = lost[self.mixed[at[lost]] != mixed[lost]]
        return self.score[at]

    def texts(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of each text of a stream."""
        values = np.zeros(len(data) + 1)
        own = own_positions(ends)
        for start in range(0, max(len(data) - DEPTH, 0), WINDOW):
            part = data[start : start + WINDOW + DEPTH]
            mine = own[start : start + WINDOW]
            values[start + DEPTH : start + len(part)][mine] = self[grams(part)[mine]]
        # Each text by itself, padding left out: a text has one byte at least.
        bounds = np.stack([ends[:-1] + DEPTH, ends[1:]], axis=1).ravel()
        return np.add.reduceat(values, bounds)[::2]


def _counted(found: Counter) -> pd.DataFrame:
    return pd.DataFrame({"token": token_hashes(list(found)), "n": np.fromiter(found.values(), np.int64, len(found))})


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) of all tokens of ``docs(text)``, ends included."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        for frame in batches(frames):
            for text in frame["text"]:
                found.update(words_of(text))
            found[END] += len(frame)
            if len(found) > GATHERED:
                yield _counted(found)
                found = Counter()
        if found:
            yield _counted(found)
        found = Counter()
        release_memory()

    counted = docs.select(whole_text().alias("text")).mapInPandas(count, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def in_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Slices of frames with their block: the part and its characters before, by ``BLOCK``.

    A block depends on the rows of a part alone, not on how they come in batches.
    """
    before = 0
    for frame in batches(frames, WINDOW):
        first = int(frame["part"].iloc[0]) << 24
        sizes = frame["text"].str.len().to_numpy()
        ends = before + np.cumsum(sizes)
        numbers = (ends - sizes) // BLOCK
        for number in np.unique(numbers):
            yield first + int(number), frame[numbers == number]
        before = int(ends[-1])


class Tally:
    """Distinct grams in order and their counts in training texts, kept as such while texts come."""

    def __init__(self):
        self.gram, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, data: np.ndarray, ends: np.ndarray, trained: bool) -> None:
        """The grams of a stream, each with the mark of training in its lowest bit."""
        own = own_positions(ends)
        for start in range(0, max(len(data) - DEPTH, 0), WINDOW):
            found = grams(data[start : start + WINDOW + DEPTH])[own[start : start + WINDOW]]
            found <<= np.uint64(1)
            found |= np.uint64(trained)
            self.waiting.append(found)
            self.size += len(found)
            if self.size >= TALLIED:
                self.settle()

    def settle(self) -> None:
        if not self.size:
            return
        found = np.concatenate(self.waiting)
        self.waiting, self.size = [], 0
        found.sort()
        times = (found & np.uint64(1)).astype(np.int8)
        found >>= np.uint64(1)
        first = firsts(found)
        found, times = found[first], np.add.reduceat(times, first, dtype=np.int64)
        at = np.searchsorted(self.gram, found)
        new = np.ones(len(found), bool)
        inside = at < len(self.gram)
        new[inside] = self.gram[at[inside]] != found[inside]
        self.count[at[~new]] += times[~new]
        place = at[new] + np.arange(np.count_nonzero(new))
        old = np.ones(len(self.gram) + len(place), bool)
        old[place] = False
        for name, more in (("gram", found), ("count", times)):
            both = np.empty(len(old), more.dtype)
            both[old], both[place] = getattr(self, name), more[new]
            setattr(self, name, both)

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        return self.gram, self.count


def block_grams(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, distinct grams in order, their count in training texts)."""
    current, tally = None, None
    for block, frame in in_blocks(frames):
        if block != current:
            if tally is not None:
                yield current, *tally.all()
            current, tally = block, Tally()
        held = frame["held_out"].to_numpy(dtype=bool)
        for mine, trained in ((~held, True), (held, False)):
            tally.add(*streams([words_of(t) for t in frame["text"][mine]]), trained)
    if tally is not None:
        yield current, *tally.all()


def bucket_of(gram: np.ndarray, buckets: int) -> np.ndarray:
    mixed = (contexts(gram, SPLIT) >> np.uint64(8)) * ODD
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def asked_grams(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, grams, counts): what each block asks and tells each bucket."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, gram, count in block_grams(frames):
            # Grams of a context stand together, and go to a bucket together.
            first = firsts(contexts(gram, SPLIT))
            bucket = bucket_of(gram[first], buckets)
            bucket = np.repeat(bucket, np.diff(first, append=len(gram)))
            order = np.argsort(bucket, kind="stable")
            starts = firsts(bucket[order])
            rows = []
            for number, own in zip(bucket[order[starts]], np.split(order, starts[1:]), strict=True):
                rows.append((number, block, squeezed(gram[own]), planes(count[own])))
            del gram, count, bucket, order
            yield pd.DataFrame(rows, columns=["bucket", "block", "grams", "counts"])
            rows = []
        release_memory()

    rows = docs.select(F.spark_partition_id().alias("part"), "held_out", "text")
    return rows.mapInPandas(run, "bucket int, block long, grams binary, counts binary")


DEEP = (
    "grams binary, deep binary, blocks array<long>, places array<binary>, "
    "top_keys binary, top_zeros binary, top_ones binary, top_below binary"
)


def _bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: the chances of its grams, who asked for which, and the depth above."""
    asked = [unsqueezed(g) for g in frame["grams"]]
    gram, where = np.unique(np.concatenate(asked), return_inverse=True)
    ends = np.cumsum([len(g) for g in asked])
    del asked
    counts = np.concatenate([from_planes(c) for c in frame["counts"]])
    count = np.bincount(where, counts, minlength=len(gram))
    places = [squeezed(p) for p in np.split(where, ends[:-1])]
    del where, counts
    known = count > 0
    deep, sums = deep_chances(gram[known], count[known], gram)
    top = [sums[0].astype("<u8").tobytes(), *(x.astype("<f8").tobytes() for x in sums[1:])]
    row = [squeezed(gram), planes(deep.ravel(), "<f4"), frame["block"].to_numpy(), places, *top]
    del gram, deep, sums
    release_memory()
    return pd.DataFrame([row], columns=[c.split(" ")[0] for c in DEEP.split(", ")])


def _top(buckets: DataFrame) -> list[Level]:
    """The tree above ``SPLIT``: at most 256 ** (SPLIT - 1) contexts of 255 nodes."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, *sums in zip(*[frame[c] for c in names], strict=True):
                columns = {"key": np.frombuffer(key, "<i8")}
                yield pd.DataFrame(columns | {n: np.frombuffer(x, "<f8") for n, x in zip("abc", sums, strict=True)})

    names = ["top_keys", "top_zeros", "top_ones", "top_below"]
    found = buckets.select(*names).mapInPandas(rows, "key long, a double, b double, c double")
    summed = found.groupBy("key").agg(*[F.sum(n).alias(n) for n in "abc"]).toArrow()
    key = summed.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    return top_levels(key[order], *(summed.column(n).to_numpy()[order] for n in "abc"))


TEXTS = "ids array<long>, nameless array<boolean>, held array<boolean>, sizes array<int>, words binary"
TEXTS_OF = ("ids", "nameless", "held", "sizes")
PARTS = f"block long, kind int, grams binary, scores binary, {TEXTS}"


def _answers(buckets: DataFrame, top: list[Level]) -> DataFrame:
    """(block, 0, grams, scores) for every block that asked, from every bucket."""
    sent = buckets.sparkSession.sparkContext.broadcast(top)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for grams_, deep, blocks, places in zip(
                frame["grams"], frame["deep"], frame["blocks"], frame["places"], strict=True
            ):
                gram = unsqueezed(grams_)
                chances = from_planes(deep, "<f4").reshape(-1, 8)
                score = gram_scores(sent.value, gram, chances).astype("<f4")
                rows = []
                for place in places:
                    own = unsqueezed(place).astype(np.int64)
                    rows.append((squeezed(gram[own]), score[own].tobytes()))
                yield pd.DataFrame(rows, columns=["grams", "scores"]).assign(block=blocks)
                rows = []
        release_memory()

    found = buckets.select("grams", "deep", "blocks", "places").mapInPandas(run, "block long, grams binary, scores binary")
    return found.withColumn("kind", F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    """(block, 1, ``TEXTS``): texts on their way to the scores."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, frame in in_blocks(frames):
            texts = [b" ".join(words_of(t)) for t in frame["text"]]
            columns = [frame[c].tolist() for c in ("doc_id", "nameless", "held_out")]
            row = (block, *columns, [len(t) for t in texts], _press().compress(b"".join(texts)))
            yield pd.DataFrame([row], columns=["block", "ids", "nameless", "held", "sizes", "words"])
        release_memory()

    # A NULL would turn a batch's ids into floats.
    nameless = F.col("doc_id").isNull().alias("nameless")
    part = F.spark_partition_id().alias("part")
    rows = docs.select(part, F.coalesce("doc_id", F.lit(0)).alias("doc_id"), nameless, "held_out", "text")
    return rows.mapInPandas(run, f"block long, {TEXTS}").withColumn("kind", F.lit(1))


def _words(data: np.ndarray, ends: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of the texts of a stream: tokens, known ones and base score by ``often``, and the others.

    ``often`` is (hash, chance) and n for each, hashes in order. The others are where each
    text's begin, their hashes and how often the text has them.
    """
    starts, codes, hashes = coded_words(data)
    # The end is the last code, once a text.
    hashes = np.concatenate([hashes, token_hashes([END])])
    texts, kinds = len(ends) - 1, len(hashes)
    text = np.searchsorted(ends, starts, side="right") - 1
    pairs = np.concatenate([text * kinds + codes, np.arange(1, texts + 1) * kinds - 1])
    n_tokens = np.bincount(text, minlength=texts) + 1
    pairs, times = np.unique(pairs, return_counts=True)
    text, codes = np.divmod(pairs, kinds)
    key, chance = often
    at = np.searchsorted(key, hashes)
    known = np.zeros(kinds, bool)
    known[at < len(key)] = key[at[at < len(key)]] == hashes[at < len(key)]
    gain = np.zeros(kinds)
    gain[known] = chance[at[known]]
    mine = known[codes]
    base = np.bincount(text, times * gain[codes], minlength=texts)
    n_known = np.bincount(text[mine], times[mine], minlength=texts).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(np.bincount(text[~mine], minlength=texts))])
    return n_tokens, n_known, base, begins, hashes[codes[~mine]], times[~mine]


def score_texts(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """Scores of every row of ``docs(doc_id, held_out, text)``.

    Learns from the rows of ``docs`` that are not held out, or else from ``training``.
    Both are read several times and must give a task the same rows each time, as
    tables in files do; a block that finds other texts than it asked for fails.
    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "held_out", whole_text().alias("text"))
    learned = docs.filter("NOT held_out") if training is None else training.select(whole_text().alias("text"))
    with batch_rows(spark, TEXTS_AT_ONCE):
        counts = keep(token_counts(learned))
    facts = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = facts[0] or 0, facts[1]
    space = total + 0.5 * (distinct + 1)
    limit = max(total * FREQUENT, 1)
    often = counts.filter(F.col("n") >= limit).toPandas().sort_values("token")
    chances = np.log10((often["n"].to_numpy(np.float64) + 0.5) / space)
    sent = spark.sparkContext.broadcast((often["token"].to_numpy(np.int64), chances))

    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(size // BUCKET) + 16
    if training is None:
        asked = asked_grams(docs, buckets)
    else:
        # Blocks of the training texts are told apart from those that are scored.
        asked = asked_grams(docs.withColumn("held_out", F.lit(True)), buckets)
        told = asked_grams(learned.withColumn("held_out", F.lit(False)), buckets)
        asked = asked.unionByName(told.withColumn("block", -1 - F.col("block")))
    with batch_rows(spark, TEXTS_AT_ONCE):
        worked = keep(asked.groupBy("bucket").applyInPandas(_bucket, DEEP))
        texts = keep(_texts(docs))
    parts = _answers(worked, _top(worked)).unionByName(texts, allowMissingColumns=True)
    parts = parts.filter("block >= 0").select(*[c.split(" ")[0] for c in PARTS.split(", ")])

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        block, answers, known_grams = None, [], None
        for batch in found:
            for i in range(batch.num_rows):
                row = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                if row["block"].as_py() != block:
                    block, answers, known_grams = row["block"].as_py(), [], None
                if row["kind"].as_py() == 0:
                    # A copy, as a view would hold the whole batch.
                    scores = np.frombuffer(row["scores"].as_buffer(), "<f4").copy()
                    answers.append((unsqueezed(row["grams"].as_buffer()), scores))
                    continue
                if known_grams is None:
                    both = [np.concatenate(x) for x in zip(*answers, strict=True)]
                    answers = []
                    known_grams = GramTable(*both)
                    both = []
                out = scored(row, known_grams, number)
                yield out
                number += len(out)
        known_grams = None
        release_memory()

    def scored(row: dict, known_grams: GramTable, number: int) -> pa.RecordBatch:
        ids, nameless, held, sizes = (row[n].values.to_numpy(zero_copy_only=False) for n in TEXTS_OF)
        words = _unpress().decompress(row["words"].as_buffer())
        data, ends = stream([words[e - n : e] for e, n in zip(np.cumsum(sizes), sizes, strict=True)])
        tokens, known, base, begins, rare, times = _words(data, ends, sent.value)
        lists = [pa.ListArray.from_arrays(begins.astype(np.int32), x) for x in (rare, pa.array(times, pa.int32()))]
        columns = [np.arange(number, number + len(ids)), pa.array(ids, mask=nameless), held.astype(bool), tokens, known]
        columns += [base, known_grams.texts(data, ends), *lists]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split(" ")[0] for c in shape.split(", ")])

    shape = (
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
        "score double, tokens array<long>, times array<int>"
    )
    ordered = parts.repartition("block").sortWithinPartitions("block", "kind")
    with batch_rows(spark, BLOBS):
        scored_rows = keep(ordered.mapInArrow(score, shape))
    rare = scored_rows.select("row", F.inline(F.arrays_zip("tokens", "times")))
    rare = rare.withColumnRenamed("tokens", "token")
    joined = rare.join(counts.filter(F.col("n") < limit), "token", "left")
    chance = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(float(space)))
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times"))).alias("more_known"),
        F.sum(F.col("times") * chance).alias("more_base"),
    )
    return scored_rows.drop("tokens", "times").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id(5) == 1, F.lit(False))
    return score_texts(documents.select("doc_id", held_out.alias("held_out"), "text"))
