import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.vector_graph import (
    beam_search,
    build_graph,
    equally_long,
    grow_graph,
    op12_vector_graph,
    robust_prune,
    rows_of,
    search_graph,
)


def brute(rows, queries, most):
    """{(query_id, rank): (vec_id, score)} over (id, vector) rows."""
    out = {}
    for q, v in queries:
        near = []
        for i, w in rows:
            if i != q and len(w) == len(v):
                near.append((-float(np.dot(np.array(w, float), np.array(v, float))), i is None, i or 0))
        for rank, (score, nameless, i) in enumerate(sorted(near)[:most], 1):
            out[q, rank] = (None if nameless else i, -score)
    return out


def answers(frame):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in frame.collect()}


def test_odd_vectors_match_brute_force(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 0.0]), (1, [0.5, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [1.0, inf])]
    rows += [(7, [nan, 1.0]), (20, [1.0, 1.0, 1.0]), (21, [3.0, 0.0, 1.0]), (40, [0.0, -1.0]), (None, [1.0, 0.0])]
    rows += [(9, [1.0, 0.0]), (9, [1.0, 0.0]), (8, [1.0, 0.0]), (60, [-1e300, 2.0]), (80, [7.0]), (61, [1e-300, 0.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, vector string, rank int")
    usable = {(i, tuple(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    queries = [r for r in usable if r[0] is not None and r[0] % 20 == 0]
    clean = rows_of(frame, "embedding")
    asked = clean.filter("vec_id % 20 = 0")
    for most, shard in ((20, 8192), (3, 2), (1, 1)):
        graph = build_graph(clean, most, shard)
        assert answers(search_graph(graph, asked, most)) == brute(usable, queries, most)
        assert answers(search_graph(graph, asked, most, block_bytes=20)) == brute(usable, queries, most)
    assert build_graph(clean.limit(0)).collect() == []
    assert search_graph(build_graph(clean.limit(0)), asked).collect() == []
    assert search_graph(build_graph(clean), asked.limit(0)).collect() == []


def test_ties_and_a_very_common_vector(spark):
    rng = np.random.default_rng(3)
    common = [0.6, 0.8, 0.0]
    rows = [(i, common if i % 3 else [float(x) for x in rng.normal(size=3)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    clean = rows_of(frame.repartition(5), "embedding")
    got = answers(search_graph(build_graph(clean, 20, 64), clean.filter("vec_id % 20 = 0")))
    expected = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    same = [k for k in expected if got[k][0] == expected[k][0]]
    assert len(got) == len(expected) and len(same) >= 0.99 * len(expected)
    assert all(abs(got[k][1] - expected[k][1]) < 1e-12 for k in same)


def recall(got, expected):
    found = {(q, i) for (q, _), (i, _) in got.items()}
    return sum((q, i) in found for (q, _), (i, _) in expected.items()) / len(expected)


@pytest.mark.parametrize("shard", [8192, 700])
def test_recall_of_the_query_s_graph(spark, shard):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in rows]
    clean = rows_of(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "embedding")
    got = answers(search_graph(build_graph(clean, 20, shard), clean.filter("vec_id % 20 = 0")))
    expected = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert recall(got, expected) >= 0.95


def test_recall_of_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1500, 16)) * np.exp(rng.normal(size=(1500, 1)))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    clean = rows_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding")
    got = answers(search_graph(build_graph(clean), clean.filter("vec_id % 20 = 0")))
    assert recall(got, brute(rows, [r for r in rows if r[0] % 20 == 0], 20)) >= 0.95


def test_query_returns_whole_ranks(spark):
    rows = op12_vector_graph(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 20 * 25 and {r.rank for r in rows} == set(range(1, 21))
    assert all(r.vec_id != r.query_id for r in rows)
    by_query = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert all(v == sorted(v) for v in by_query.values())


def test_pruning_keeps_the_nearest_and_drops_what_it_covers():
    angles = np.radians([0, 10, 12, 14, 60, -40, 180])
    data = equally_long(np.stack([np.cos(angles), np.sin(angles)], axis=1))
    kept = robust_prune(np.array([0]), np.array([[6, 5, 4, 3, 2, 1, 0, 1, -1]]), data, 4, 1.2)[0]
    assert kept[0] == 1 and 2 not in kept and 3 not in kept and {5, 4} <= set(kept)


def test_every_node_is_reached_and_found():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(900, 8)) + 6 * np.eye(8)[rng.integers(0, 8, 900)]
    order, edges = grow_graph(vectors)
    assert sorted(order) == list(range(900)) and np.median((edges >= 0).sum(axis=1)) <= 40
    reached, front = {0}, [0]
    while front:
        front = [int(n) for p in front for n in edges[p] if n >= 0 and n not in reached and not reached.add(int(n))]
    assert len(reached) == 900
    data = equally_long(vectors[order])
    found, far, _ = beam_search(data[:50], data, edges, 32)
    assert (np.diff(far, axis=1) >= 0).all() and (found[:, 0] == np.arange(50)).mean() >= 0.95
