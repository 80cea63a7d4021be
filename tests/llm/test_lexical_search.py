import math
import os
import random
import re
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import connect, oracle_rows, spark_rows  # noqa: E402

from tidemark.llm import lexical_search  # noqa: E402
from tidemark.llm.lexical_search import SQL, Best, Items, grow, op11_lexical_search, search, search_tree  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def terms_of(text):
    return Counter(TERM.findall((text or "").translate(SMALL)))


def brute(docs, items, k=50):
    """(item_id, rank, doc_id, score) over (id, text) rows."""
    docs = [(i, terms_of(t)) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, counts in docs:
            m = 100 - 50 + 50 * counts.total() * n // total
            score = 0
            for t in terms_of(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, nameless, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if nameless else doc_id, -score))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_odd_rows_match_brute_force(spark, odd_docs, monkeypatch):
    items = [(1, "same words ab"), (1, "same words ab"), (2, None), (3, "!?"), (4, "ÉÈ éè one zzz"), (None, "at all x")]
    frame = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = brute(docs, items)
    assert expected
    assert rows_of(search(odd_docs, frame, leaf=1)) == expected
    # Several blocks of items, and several shards in a task.
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", 1)
    assert rows_of(search(odd_docs, frame, block_terms=3)) == expected
    assert rows_of(search(odd_docs, frame, k=2)) == brute(docs, items, 2)


def test_empty(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    assert search(no_docs, items).collect() == []
    assert search(odd_docs, items.limit(0)).collect() == []
    assert search(odd_docs.filter("text IS NULL"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_matches_sql_and_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = spark_rows(op11_lexical_search(spark, sf_dir))
    assert got == oracle_rows(connect(sf_dir), SQL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    frame = spark.createDataFrame([tuple(i) for i in items], "item_id long, text string")
    whole = search(spark.createDataFrame([tuple(d) for d in docs], "doc_id long, text string"), frame)
    assert rows_of(whole) == brute([tuple(d) for d in docs], [tuple(i) for i in items])


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_and_prune(seed):
    """Bounds cover every document of their ball, and clusters are passed over."""
    rng = np.random.default_rng(seed)
    width, groups, each = 400, 20, 60
    rows = [np.sort(rng.choice(20, 8, replace=False)) + 20 * g for g in range(groups) for _ in range(each)]
    cols = np.concatenate(rows)
    starts = np.arange(0, 8 * len(rows), 8)
    impacts = rng.integers(1, 1_000_000, len(cols))
    weights = rng.integers(0, 20_000, width)
    wanted = [sorted(random.Random(i).sample(range(20 * i, 20 * i + 20), 6)) for i in range(10)]
    items = Items(list(range(10)), wanted, weights)
    tree = grow(np.arange(len(rows)), starts, cols, impacts, items, 16)

    def check(ball):
        if ball.children is None:
            for place, item in enumerate(items.filled):
                own = np.zeros(width, np.int64)
                own[items.terms[item]] = weights[items.terms[item]]
                scores = np.add.reduceat(ball.impacts * own[ball.cols], ball.starts)
                tops[place] = max(int(scores.max()), tops[place]) if place in tops else int(scores.max())
                assert scores.max() <= ball.bounds[place]
            return list(ball.ids)
        return check(ball.children[0]) + check(ball.children[1])

    tops = {}
    assert sorted(check(tree)) == list(range(len(rows)))
    assert all(top <= tree.bounds[place] for place, top in tops.items())
    best = [Best(5) for _ in items.names]
    opened = search_tree(tree, items, best)
    assert all(max(b.heap)[0] == tops[p] for p, b in enumerate(best) if b.heap)
    assert opened < 0.9 * 10 * len(rows) / 16
