import random
from itertools import combinations

import pytest

from tidemark.llm import common
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import drop_copies
from tidemark.llm.near_dedup import drop_near_copies, near_groups, op7_minhash_dedup


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = {r.doc_id: plain_set(r.text) for r in rows if r.doc_id is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


@pytest.fixture(scope="module")
def edited(spark):
    """A large group of copies edited more and more, and shared passages."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    base = [word() for _ in range(150)]
    passage = [word() for _ in range(120)]
    rows = []
    for i in range(90):
        text = base.copy()
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            text[rng.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    for i in range(160, 200):
        own = [word() for _ in range(rng.randint(10, 60))]
        rows.append((i, " ".join(own + passage)))
    for i in range(240, 260):
        rows.append((i, " ".join(word() for _ in range(rng.randint(1, 40)))))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("which", ["edited", "sample", "odd_docs"])
def test_components_match_brute_force(request, which):
    docs = request.getfixturevalue(which)
    got = {tuple(r) for r in near_groups(docs).collect() if r.doc_id is not None}
    assert got == brute(docs.collect())


def test_further_centres_give_the_same(edited, monkeypatch):
    import tidemark.llm.near_dedup as module

    expected = {tuple(r) for r in near_groups(edited).collect()}
    monkeypatch.setattr(module, "PAIRS_PER_ENTRY", 0)
    monkeypatch.setattr(module, "FEW_PAIRS", 0)
    assert {tuple(r) for r in near_groups(edited).collect()} == expected


def test_odd_rows(odd_docs, no_docs):
    rows = near_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    (no_id,) = [r for r in rows if r.doc_id is None]
    assert no_id.kept and no_id.component_id is None
    kept = drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert near_groups(no_docs).collect() == []
    assert drop_near_copies(no_docs).collect() == []


def test_null_and_repeated_ids_lose_only_their_copies(spark):
    words = lambda start: [f"w{start + i}" for i in range(200)]
    near = lambda start: " ".join([*words(start)[:-1], "other"])
    text = lambda start: " ".join(words(start))
    rows = [
        (1, text(0), "stays"),
        (None, near(0), "near copy without an id"),
        (None, text(1000), "stays: unique, without an id"),
        (None, text(2000), "one of two without an id"),
        (None, near(2000), "one of two without an id"),
        (7, text(3000), "stays: unique, its id occurs twice"),
        (7, near(0), "near copy of 1"),
        (9, text(4000), "one of two equal rows"),
        (9, text(4000), "one of two equal rows"),
        (None, None, "stays: no words"),
        (None, None, "stays: no words"),
        (2**60 + 1, text(5000), "stays"),
        (2**60 + 2, near(5000), "near copy"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string").repartition(1)
    kept = sorted(r.note for r in drop_near_copies(docs).collect())
    once = ["one of two equal rows", "one of two without an id"]
    stays = ["stays", "stays", *["stays: no words"] * 2]
    stays += ["stays: unique, its id occurs twice", "stays: unique, without an id"]
    assert kept == once + stays
    groups = near_groups(docs).collect()
    assert len(groups) == len(rows) and sum(r.kept for r in groups) == len(kept)


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(61)} | {(100, 100), (101, 100), (103, 100)}


def test_the_query_keeps_by_id(spark, tmp_path):
    rows = [(9, "one text of a few words here"), (9, "one text of a few words here"), (12, "one text of a few words here"), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in op7_minhash_dedup(spark, str(tmp_path)).collect()), key=repr)
    assert got == [(12, 3, 9, False), (9, 3, 9, True), (9, 3, 9, True), (None, 1, None, True)]


@pytest.mark.parametrize("drop", [drop_near_copies, drop_copies])
def test_many_dropped_keys_are_sifted(spark, odd_docs, edited, monkeypatch, drop):
    """Beyond what is broadcast the same rows stay."""
    for docs in (odd_docs, edited):
        expected = sorted(map(repr, drop(docs).collect()))
        monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
        assert sorted(map(repr, drop(docs).collect())) == expected
        monkeypatch.undo()
