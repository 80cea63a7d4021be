"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of ``block_bytes`` bytes. Distinct blocks are
sorted and named by integers; adjacent names are paired, the distinct pairs
sorted and named again, until each text has one name at one level. Equal
(level, name) means equal texts, without collisions:

* the sort key of a block is (128-bit hash, bytes). The bytes only decide
  between blocks of equal hash, so only blocks whose hash occurs more than once
  are shuffled with their bytes; all others sort by the hash alone. Should two
  different blocks ever share a hash, the salts are changed and the level is
  named anew, so no name rests on an unverified hash.
* pairs of names are compared as integers, exactly.

Repeated rows are copies like any others; a NULL text equals an empty one. Rows
that share both id and text are one record, counted as often as it occurs. A
NULL id never stays in place of a real one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import hash_pair, keep, ranked, table, whole_text, without_keys
from tidemark.operators.sieve import matching

BLOCK_BYTES = 4096
KEY = ["doc_id", "k1", "k2"]


def _blocks(text: Column, block_bytes: int, salt: str, with_bytes: bool) -> Column:
    """The blocks of a text as structs (pos, h1, h2[, block])."""
    data = text.cast("binary")
    last = F.greatest(F.ceil(F.octet_length(text) / block_bytes).cast("int") - 1, F.lit(0))

    def one(i: Column) -> Column:
        block = F.substring(data, i * block_bytes + 1, F.lit(block_bytes))
        parts = [
            i.alias("pos"),
            F.xxhash64(F.lit(f"{salt}-a"), block).alias("h1"),
            F.xxhash64(F.lit(f"{salt}-b"), block).alias("h2"),
        ]
        return F.struct(*parts, *([block.alias("block")] if with_bytes else []))

    return F.transform(F.sequence(F.lit(0), last), one)


def _differ(docs: DataFrame, counts: DataFrame, block_bytes: int, salt: str) -> bool:
    """Whether two different blocks share a hash: compares the bytes of those whose hash
    repeats, others being sifted out before the shuffle."""
    repeated = keep(counts.filter(F.col("n") > 1).select("h1", "h2"))
    blocks = docs.select(F.inline(_blocks(whole_text(), block_bytes, salt, True)))
    matched = matching(blocks, repeated, ["h1", "h2"], common.BROADCAST_KEYS)
    sides = matched.groupBy("h1", "h2").agg(
        F.min("block").alias("low"), F.max("block").alias("high")
    )
    return not sides.filter(F.col("low") != F.col("high")).isEmpty()


def _name_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, k1, k2, pos, name) for every block of every record."""
    keys = hash_pair(whole_text())
    attempt = 0
    while True:
        salt = f"block-{attempt}"
        cut = docs.select(
            "doc_id",
            keys[0].alias("k1"),
            keys[1].alias("k2"),
            F.inline(_blocks(whole_text(), block_bytes, salt, False)),
        )
        cut = keep(cut)
        counts = keep(cut.groupBy("h1", "h2").agg(F.count("*").alias("n")))
        if not _differ(docs, counts, block_bytes, salt):
            break
        attempt += 1
    names = ranked(counts.select("h1", "h2"), ["h1", "h2"], "name")
    return cut.join(names, ["h1", "h2"]).select(*KEY, "pos", "name")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, k1, k2, level, name) of every record of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", "text")
    rows = _name_blocks(docs, block_bytes)
    level = 0
    done = None
    while True:
        paired = rows.groupBy(*KEY, F.expr("pos div 2").cast("int").alias("half")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"),
        )
        paired = keep(paired)
        longer = paired.filter(F.col("half") > 0).select(*KEY).distinct()
        last = paired.filter(F.col("half") == 0)
        if longer.isEmpty():
            open_rows = None
            single = last
        else:
            # A record ends at this level when it has one block or pair left.
            on = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in KEY]
            others = longer.select(*[F.col(c).alias(f"o_{c}") for c in KEY])
            single = last.join(others, on, "left_anti")
            open_rows = paired.join(others, on, "left_semi")
        ended = single.filter(F.col("right").isNull())
        ended = ended.select(*KEY, F.lit(level).alias("level"), F.col("left").alias("name"))
        done = ended if done is None else done.unionByName(ended)
        going = single.filter(F.col("right").isNotNull())
        going = going if open_rows is None else going.unionByName(open_rows)
        if going.isEmpty():
            return done
        going = going.withColumn("right", F.coalesce("right", F.lit(-1).cast("long")))
        names = ranked(going.select("left", "right").distinct(), ["left", "right"], "name")
        rows = going.join(names, ["left", "right"]).select(*KEY, F.col("half").alias("pos"), "name")
        level += 1


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with the id that stays of its group of equal texts.

    Returns doc_id, keep_id (largest id of the group), group_size, kept,
    text_sha256.
    """
    docs = docs.select("doc_id", "text")
    k1, k2 = hash_pair(whole_text())
    rows = docs.select(
        "doc_id", k1.alias("k1"), k2.alias("k2"), F.sha2(whole_text(), 256).alias("text_sha256")
    )
    named = identities(docs, block_bytes).select(
        *[F.col(c).alias(f"i_{c}") for c in KEY], "level", "name"
    )
    on = [F.col(c).eqNullSafe(F.col(f"i_{c}")) for c in KEY]
    rows = keep(rows.join(named, on).select("doc_id", "text_sha256", "level", "name"))
    groups = rows.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return rows.join(groups, ["level", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one id of each group of equal texts, all columns unchanged."""
    dropped = exact_groups(docs, block_bytes).filter(~F.col("kept"))
    dropped = keep(dropped.select("doc_id", "text_sha256").distinct())
    names = {"doc_id": F.col("_row.doc_id"), "text_sha256": F.sha2(whole_text(F.col("_row.text")), 256)}
    return without_keys(docs, dropped, names)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
