import hashlib
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, oracle_rows, spark_rows  # noqa: E402

from tidemark.llm.merkle_manifest import (  # noqa: E402
    FIELDS,
    SQL,
    folded,
    leaf_digest,
    merkle_manifest,
    op13_merkle_manifest,
    proof_text,
)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*parts)


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root of the cut text) of (fields...) rows."""

    def tree(digests):
        levels = [digests]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([h(*last[i : i + 3]) for i in range(0, len(last), 3)])
        return levels

    def climb(levels, pos, own):
        sent = ""
        for level in levels[:-1]:
            run = level[pos // 3 * 3 : pos // 3 * 3 + 3]
            k = pos % 3
            sent += "".join(run[:k] + run[k + 1 :])
            own = h(*run[:k], own, *run[k + 1 :])
            pos //= 3
        return sent, own

    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf_of(r)))
        trees[s] = mine, tree([leaf_of(r) for r in mine])
    top = tree([trees[s][1][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for pos, r in enumerate(trees[s][0]):
            cut = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                cut = (*r[:4], r[4].replace("\n", ""))
            low, subroot = climb(trees[s][1], pos, leaf_of(cut))
            high, root = climb(top, k, subroot)
            out.append((r[0], leaf_of(r), trees[s][1][-1][0], top[-1][0], h(low, high), root, root == top[-1][0]))
    return sorted(out, key=repr)


def derived(docs, span):
    fields = {c: F.col(c) for c in FIELDS}
    cut = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", ""))
    changed = leaf_digest({**fields, "text": F.coalesce(cut, F.col("text"))})
    leaves = docs.select("doc_id", "source", leaf_digest(fields).alias("leaf"), changed.alias("changed"))
    rows = merkle_manifest(leaves, span).collect()
    assert [c for c in ("pos", "changed") if c not in rows[0]] == []
    frame = docs.sparkSession.createDataFrame(
        [(r.doc_id, r.leaf, r.subroot, r.root, r.changed, r.proof) for r in rows],
        "doc_id long, leaf string, subroot string, root string, changed string, "
        "proof array<struct<place: int, others: array<string>>>",
    )
    rows = frame.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("proof")), 256), folded("changed", F.col("proof"))
    ).collect()
    return sorted(((*r, r[5] == r[3]) for r in rows), key=repr)


@pytest.mark.parametrize("span", [3, 9, 729])
def test_odd_rows_match_brute_force_at_any_range_size(odd_docs, span):
    rows = [tuple(r) for r in odd_docs.select(*FIELDS).collect()]
    assert derived(odd_docs, span) == brute(rows)


def test_trees_of_every_size(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "é": 10, "z": 28, None: 9, "hot": 100}
    rows = [(10 * i + n, s, None, i, f"t\n{i}") for n, s in enumerate(sizes) for i in range(sizes[s])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert derived(docs.repartition(7), 9) == brute(rows)
    assert derived(docs.filter("source = 'a'"), 9) == brute([r for r in rows if r[1] == "a"])


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(1, "s", None, 0, "x")] * 40 + [(2, "s", None, 0, "y\n")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert derived(docs, 3) == brute(rows)


def test_empty(no_docs):
    leaves = no_docs.select("doc_id", "source", F.lit("").alias("leaf"))
    assert merkle_manifest(leaves).collect() == []


def test_query_matches_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert spark_rows(op13_merkle_manifest(spark, sf_dir)) == oracle_rows(connect(sf_dir), SQL)
