"""Near duplicates by MinHash with tensored banding, verified on full sets.

A document's set holds its distinct shingles of five words (A-Z lower-cased,
words split at ASCII white space; fewer words make one shingle) as 64-bit
hashes. Documents with equal sets form a class; one of each class is compared.

Tensoring: two collections of ``SIDE`` hashes of ``DEPTH`` minimum hashes each
are kept, and table (i, j) is keyed by the pair (A_i, B_j). So ``SIDE``^2 = 64
tables of depth 6 cost 48 minimum hashes instead of 384. Two sets of
resemblance s meet with probability (1 - (1 - s^3)^8)^2: 0.999 at 0.85.

Candidates are confirmed exactly, without listing a bucket's pairs:

* a set whose shingles are too often found in no other candidate cannot reach
  the threshold with any partner; it leaves (|x & y| <= |x| - unique(x)).
* each bucket's centre, the member with the smallest share of unique shingles,
  is compared with all members: one pair a member. Links join components.
* buckets of one centre are then merged, which only adds candidates. What is left
  are members outside their centre's component. They are compared with members
  of other components around that centre, after the same exact bound on the
  pair. While that would be many pairs, further centres are taken from them
  first. The rounds end when no pair is left, so every pair that shares a bucket
  is confirmed, excluded by the bound, or already joined.

A document without words links with nothing. Rows with a NULL id take part as
copies, but name a component only as NULL, if no row of it has an id. Of a
component one row stays, of its least id; rows are told apart by id and text, as
ids may be NULL or repeated, and rows equal in both by their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    batches,
    forget,
    hash_pair,
    keep,
    small_side,
    table,
    whole_text,
    without_keys,
    worker_memory,
)
from tidemark.llm.components import components

WORDS = 5
DEPTH = 3
SIDE = 8
PERCENT = 85
#: Words a worker remembers the hash of.
REMEMBERED = 150_000
#: Pairs that the last comparison may weigh by size alone (some nanoseconds each)
#: for each entry, and in all; above both, more centres are taken first.
PAIRS_PER_ENTRY = 2_000
FEW_PAIRS = 20_000_000

_MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, 2 * SIDE * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = worker_memory("word hashes", _WordHashes)
    if len(known) > REMEMBERED:
        known.clear()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def min_hashes(found: np.ndarray) -> np.ndarray:
    """2 x SIDE hashes, each of DEPTH minimum hashes."""
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 4096):
        part = found[start : start + 4096, None] * _MULTIPLIERS[None, :]
        least = np.minimum(least, part.min(axis=0))
    least ^= least >> np.uint64(31)
    least = least.reshape(2 * SIDE, DEPTH)
    joined = np.zeros(2 * SIDE, np.uint64)
    for i in range(DEPTH):
        joined = (joined ^ least[:, i]) * np.uint64(0xD6E8FEB86659FD93)
        joined ^= joined >> np.uint64(32)
    return joined


def _digest(found: np.ndarray) -> tuple[int, int]:
    data = found.tobytes()
    value = xxhash.xxh3_128_intdigest(data)
    high, low = value >> 64, value & (1 << 64) - 1
    return tuple(v - (1 << 64) if v >> 63 else v for v in (high, low))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, row, n_shingles, d1, d2, marks) of every row; no marks without words.

    t1 and t2 are a hash of the text; ``row`` is unique once the result is written.
    """
    named = ["doc_id", "nameless", "t1", "t2", "row"]

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames):
            rows = []
            for *name, text in zip(*[frame[c] for c in named], frame["text"], strict=True):
                found = shingles(text)
                if len(found):
                    marks = min_hashes(found).view(np.int64)
                    rows.append((*name, len(found), *_digest(found), marks))
                else:
                    rows.append((*name, 0, 0, 0, None))
            yield pd.DataFrame(rows, columns=[*named, "n_shingles", "d1", "d2", "marks"])
        forget()

    t1, t2 = hash_pair(whole_text())
    row = F.monotonically_increasing_id().alias("row")
    # A NULL would turn a batch's ids into floats.
    name = [F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("nameless")]
    texts = docs.select(*name, t1.alias("t1"), t2.alias("t2"), row, whole_text().alias("text"))
    shape = "doc_id long, nameless boolean, t1 long, t2 long, row long, n_shingles long, d1 long, d2 long"
    signed = texts.mapInPandas(sign, f"{shape}, marks array<long>")
    return signed.withColumn("doc_id", F.when(~F.col("nameless"), F.col("doc_id"))).drop("nameless")


def _tables() -> Column:
    """The keys of all tables: one for each pair of an A and a B hash."""
    pairs = F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))
    return F.transform(
        pairs,
        lambda t: F.xxhash64(
            t, F.get("marks", F.floor(t / SIDE).cast("int")), F.get("marks", t % SIDE + SIDE)
        ),
    )


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, n, shingles) of the classes ``wanted(cid, place, d1, d2)``.

    ``place`` is an id that has the set or, of rows without one, a text's hash.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames):
            found = [shingles(t) for t in frame["text"]]
            marks = [_digest(f) if len(f) else (0, 0) for f in found]
            yield pd.DataFrame(
                {
                    "cid": frame["cid"],
                    "n": [len(f) for f in found],
                    "same": [m == (a, b) for m, a, b in zip(marks, frame["d1"], frame["d2"], strict=True)],
                    "shingles": [f.view(np.int64) for f in found],
                }
            )
        forget()

    own = F.coalesce(F.col("doc_id").cast("long"), hash_pair(whole_text())[0])
    texts = docs.select(own.alias("own"), whole_text().alias("text"))
    joined = texts.join(small_side(wanted), F.col("own") == F.col("place"))
    shape = "cid long, n long, same boolean, shingles array<long>"
    read_back = joined.select("cid", "d1", "d2", "text").mapInPandas(read, shape)
    return keep(read_back.filter("same").select("cid", "n", "shingles").dropDuplicates(["cid"]))


def _may_link(nx: Column, fx: Column, ny: Column, fy: Column) -> Column:
    """Whether sets of these sizes and shared parts can reach the threshold."""
    common = F.least(nx - fx, ny - fy)
    return common * 100 >= (nx + ny - common) * PERCENT


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    ``b`` may be a centre with many pairs: narrow rows meet its set first, and
    the shuffle of sets is by ``a``.
    """
    first = sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    second = sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    joined = pairs.join(first, "b").join(second, "a")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    kept = joined.select("a", "b", "na", "nb", common.alias("common"))
    return kept.filter(
        F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * PERCENT
    ).select("a", "b")


def _around_centres(docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(centre, cid, sizes) for all classes that share a bucket, and their sets."""
    entries = classes.select("cid", F.explode(_tables()).alias("key"))
    counts = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = keep(counts.select(F.col("key").alias("shared_key")))
    members = entries.join(small_side(shared), F.col("key") == F.col("shared_key"))
    members = keep(members.select("key", "cid"))
    wanted = members.select("cid").distinct()
    wanted = keep(classes.select("cid", "place", "d1", "d2").join(wanted, "cid"))
    sets = _sets(docs, wanted)

    seen = sets.select("cid", F.explode("shingles").alias("h"))
    alone = seen.groupBy("h").agg(F.count("*").alias("c"), F.min("cid").alias("cid")).filter("c = 1")
    alone = alone.groupBy("cid").agg(F.count("*").alias("alone"))
    facts = sets.select("cid", "n").join(alone, "cid", "left")
    facts = facts.select("cid", "n", F.coalesce("alone", F.lit(0)).alias("alone"))
    facts = keep(facts.filter((F.col("n") - F.col("alone")) * 100 >= F.col("n") * PERCENT))
    members = members.join(small_side(facts), "cid")

    order = F.struct((F.col("alone") / F.col("n")).alias("share"), "cid", "n", "alone")
    centres = members.groupBy("key").agg(F.min(order).alias("c"))
    centres = centres.select(
        F.col("key").alias("bucket"),
        F.col("c.cid").alias("centre"),
        F.col("c.n").alias("centre_n"),
        F.col("c.alone").alias("centre_alone"),
    )
    around = members.join(centres, F.col("key") == F.col("bucket"))
    around = around.filter(F.col("cid") != F.col("centre"))
    return keep(around.drop("key", "bucket").distinct()), sets


def _joined(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of all classes that have a link."""
    rest, sets = _around_centres(docs, classes)
    possible = _may_link(F.col("n"), F.col("alone"), F.col("centre_n"), F.col("centre_alone"))
    pairs = rest.filter(possible).select(F.col("cid").alias("a"), F.col("centre").alias("b"))
    found = components(_confirmed(pairs, sets))
    rest = rest.drop("centre_n", "centre_alone")
    taken = 1
    while True:
        named = rest.join(found.withColumnRenamed("node", "cid"), "cid", "left")
        named = named.withColumn("component", F.coalesce("component", "cid"))
        homes = found.select(F.col("node").alias("centre"), F.col("component").alias("home"))
        named = named.join(homes, "centre", "left")
        named = keep(named.withColumn("home", F.coalesce("home", "centre")))
        apart = F.col("component") != F.col("home")
        sizes = named.groupBy("centre").agg(
            F.count("*").alias("size"), F.count_if(apart).alias("outside")
        )
        work, outsiders, entries = sizes.agg(
            F.sum(F.col("size") * F.col("outside")), F.sum("outside"), F.sum("size")
        ).first()
        if not outsiders:
            return found
        outside = named.filter(apart)
        last = work <= max(PAIRS_PER_ENTRY * entries, FEW_PAIRS)
        if not last:
            # Some of the outsiders of each centre are centres of this round; four
            # times as many of them in the next.
            by_share = F.struct(F.col("alone") / F.col("n"), "cid")
            chosen = outside.groupBy("centre").agg(F.min_by("cid", by_share).alias("cid"))
            place = F.pmod(F.xxhash64(F.lit(taken), "centre", "cid"), F.lit(max(2, 128 // taken)))
            chosen = chosen.select("centre", "cid")
            if taken > 1:
                chosen = chosen.unionByName(outside.filter(place == 0).select("centre", "cid"))
            tested = keep(chosen.distinct())
            outside = outside.join(tested, ["centre", "cid"], "left_semi")
        other = named.select(
            "centre", *[F.col(c).alias(f"o_{c}") for c in ("cid", "n", "alone", "component")]
        )
        near = _may_link(F.col("n"), F.col("alone"), F.col("o_n"), F.col("o_alone"))
        pairs = outside.join(other, "centre").filter(
            (F.col("component") != F.col("o_component")) & near
        )
        # Of a pair met from both sides one is kept.
        pairs = pairs.select(F.greatest("cid", "o_cid").alias("a"), F.least("cid", "o_cid").alias("b"))
        more = _confirmed(pairs.distinct(), sets)
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(stars.unionByName(more))
        if last:
            return found
        rest = keep(rest.join(tested, ["centre", "cid"], "left_anti"))
        taken *= 4


def _marked(docs: DataFrame) -> DataFrame:
    """Every row with its component, whether it stays and whether it is as the one that does.

    Returns doc_id, t1, t2, n_shingles, component_id, kept, twin; a twin is not
    kept and equals the row that stays in id and text.
    """
    docs = docs.select("doc_id", "text")
    rows = keep(signatures(docs))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "t1", "t2", "row")
    grouped = rows.filter("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min(order).alias("best"), F.first("marks").alias("marks")
    )
    place = F.coalesce("best.doc_id", "best.t1")
    grouped = grouped.select("d1", "d2", "best", "marks", place.alias("place"))
    classes = keep(grouped.withColumn("cid", F.monotonically_increasing_id()))
    joined = _joined(docs, classes.select("cid", "place", "d1", "d2", "marks"))
    named = classes.select("cid", "best", "d1", "d2").join(
        joined.withColumnRenamed("node", "cid"), "cid", "left"
    )
    named = keep(named.withColumn("component", F.coalesce("component", "cid")))
    least = named.groupBy("component").agg(F.min("best").alias("stays"))
    named = named.join(least, "component").select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "stays")
    named = keep(named)
    on = (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n_shingles") > 0)
    out = rows.drop("marks").join(named, on, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("stays.doc_id")).otherwise(F.col("doc_id"))
    kept = (F.col("n_shingles") == 0) | (F.col("row") == F.col("stays.row"))
    same = F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
    for name in ("t1", "t2"):
        same &= F.col(name) == F.col(f"stays.{name}")
    out = out.withColumns({"component_id": component, "kept": kept})
    out = out.withColumn("twin", ~F.col("kept") & same)
    return out.select("doc_id", "t1", "t2", "n_shingles", "component_id", "kept", "twin")


def near_groups(docs: DataFrame) -> DataFrame:
    """Every row with its set's size, its component and whether it stays.

    Returns doc_id, n_shingles, component_id, kept.
    """
    return _marked(docs).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of the least id of each component, all columns unchanged."""
    dropped = keep(_marked(docs).filter(~F.col("kept")).select("doc_id", "t1", "t2", "twin").distinct())
    t1, t2 = hash_pair(whole_text(F.col("_row.text")))
    names = {"doc_id": F.col("_row.doc_id").cast(T.LongType()), "t1": t1, "t2": t2}
    twins = dropped.filter("twin")
    rest = without_keys(docs, dropped, names)
    if twins.isEmpty():
        return rest
    # Rows equal in id and text to the one that stays: one of them.
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    rows = rows.select("_row", *[e.alias(f"_l_{n}") for n, e in names.items()])
    on = [F.col(f"_l_{n}").eqNullSafe(F.col(n)) for n in names]
    equal = rows.join(small_side(twins.select(*names)), on, "left_semi")
    one = equal.groupBy(*[f"_l_{n}" for n in names]).agg(F.first("_row").alias("_row"))
    return rest.unionByName(one.select("_row.*"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one id stand and fall together here; ``near_groups`` keeps one of them."""
    rows = near_groups(table(spark, sf_dir, "documents"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
