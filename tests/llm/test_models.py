import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm.context_tree import (
    DEPTH,
    END,
    GramTable,
    block_grams,
    grams,
    op3_context_tree,
    own_positions,
    score_texts,
    scores_of,
    squeezed,
    streams,
    token_hashes,
    unsqueezed,
    words_of,
)
from tidemark.llm.language_id import identify, keep_identified, learn_languages, op2_language_id
from tidemark.llm.quality_fm import FactorisationMachine, best_cut, features, keep_good, learn_quality, scorer
from tidemark.llm.quality_fm import op6_quality_fm

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    rows = op2_language_id(spark, SF).filter("held_out")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    hits = rows.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert hits.first()[0] > 0.97


def test_language_odd_rows(spark, odd_docs, no_docs, sample):
    model = learn_languages(sample)
    rows = {r.text: r.language for r in identify(odd_docs, model).collect()}
    assert rows[None].lang_pred == rows[""].lang_pred == rows["1234 5678 $$$"].lang_pred == "und"
    assert rows["one"].lang_pred in model.languages
    kept = keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert identify(odd_docs, learn_languages(no_docs)).filter("language.lang_pred != 'und'").isEmpty()
    assert identify(no_docs, model).collect() == []


def test_quality_held_out(spark):
    rows = op6_quality_fm(spark, SF).filter("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    hits = rows.join(labels, "doc_id").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int")))
    assert hits.first()[0] > 0.9


def test_factorisation_identity_and_odd_rows(spark, odd_docs, no_docs):
    slots, values = features("some words here", 15)
    rng = np.random.default_rng(1)
    size = slots.max() + 1
    n = len(values) - 3
    fm = FactorisationMachine(0.1, rng.normal(size=size), rng.normal(size=(size, 8)), np.zeros(n), np.ones(n))
    x = fm._scaled(values)
    pairs = sum(
        fm.factors[slots[i]] @ fm.factors[slots[j]] * x[i] * x[j]
        for i in range(len(x))
        for j in range(i)
    )
    z = 0.1 + fm.weights[slots] @ x + pairs
    assert fm.score(slots, values) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
    model = learn_quality(odd_docs.withColumn("quality", F.lit(1)))
    score = scorer(spark, model)
    got = odd_docs.select(score("text", F.col("n_chars").cast("double")).alias("s")).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.s <= 1 for r in got)
    assert keep_good(odd_docs, model).columns == odd_docs.columns
    assert keep_good(no_docs, learn_quality(no_docs.withColumn("quality", F.lit(1)))).collect() == []


def test_the_cut_lies_in_the_widest_gap():
    assert best_cut([3.0, 4.0, 9.0], [-2.0, 0.0, 1.0]) == 2.0
    assert best_cut([1.0, 2.0, 3.0, -9.0], [0.0, -1.0]) == 0.5
    assert best_cut([1.0], [1.0]) is not None


def test_the_threshold_parts_held_out_labels(spark):
    """Few bad documents are predicted good, and no good one is lost."""
    rows = op6_quality_fm(spark, "/root/testdata/sf0.1").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    shares = rows.join(labels, "doc_id").groupBy("quality").agg(F.avg("predicted").alias("share")).collect()
    shares = {r.quality: r.share for r in shares}
    assert shares[1] > 0.97 and shares[0] < 0.2


def test_a_labelled_id_of_very_many_rows_is_thinned(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("7 AS doc_id", "'some words' AS text", "10 AS n_chars", "1 AS quality")
    learnt = []
    monkeypatch.setattr("tidemark.llm.quality_fm.calibrated", lambda rows: learnt.append(len(rows)))
    learn_quality(rows, 200)
    assert 250 < learnt[0] < 550


def trained_grams(texts):
    data, ends = streams([words_of(t) for t in texts])
    return np.unique(grams(data)[own_positions(ends)], return_counts=True)


def test_next_byte_probabilities_sum_to_one(sample):
    gram, count = trained_grams([r.text or "" for r in sample.collect()])
    for context in (b"\n\n\n\n\n", b"the o", b"zqxjk"):
        data = np.frombuffer(b"".join(context.rjust(DEPTH, END) + bytes([b]) for b in range(256)), np.uint8)
        found = grams(data)[:: DEPTH + 1]
        assert (10 ** scores_of(gram, count, found)).sum() == pytest.approx(1, abs=1e-4)


def plain_tree(data: bytes, texts):
    """Context-tree weighting by recursion over dictionaries: (context, bits) -> probability."""
    counts: dict = {}
    for text in texts:
        stream = END * DEPTH + b" ".join(words_of(text)) + END
        for i in range(DEPTH, len(stream)):
            bits = format(stream[i], "08b")
            for depth in range(DEPTH + 1):
                for k in range(8):
                    key = (stream[i - depth : i], bits[:k])
                    a, b = counts.get(key, (0, 0))
                    counts[key] = (a + (bits[k] == "0"), b + (bits[k] == "1"))
    children: dict = {}
    for context, bits in counts:
        if context:
            children.setdefault((context[1:], bits), []).append((context, bits))
    lg = math.lgamma

    def kt(key):
        a, b = counts[key]
        return lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi)

    known: dict = {}

    def weighted(key):
        if key not in known:
            own = kt(key)
            if len(key[0]) == DEPTH:
                known[key] = own, 1.0
            else:
                low = sum(weighted(c)[0] for c in children[key])
                weight = 1 / (1 + math.exp(min(max(low - own, -700), 700)))
                top = max(own, low)
                known[key] = top + math.log(math.exp(own - top) + math.exp(low - top)) - math.log(2), weight
        return known[key]

    def chance(context, bits, bit, depth=0):
        key = (context[len(context) - depth :], bits)
        own = (counts[key][bit == "1"] + 0.5) / (sum(counts[key]) + 1)
        deeper = (context[len(context) - depth - 1 :], bits)
        if depth == DEPTH or deeper not in counts:
            return own
        weight = weighted(key)[1]
        return weight * own + (1 - weight) * chance(context, bits, bit, depth + 1)

    out = 0.0
    for i in range(DEPTH, len(data)):
        bits = format(data[i], "08b")
        for k in range(8):
            seen = (b"", bits[:k]) in counts
            out += math.log10(chance(data[i - DEPTH : i], bits[:k], bits[k]) if seen else 0.5)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_scores_equal_a_plain_context_tree(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(12)]
    gram, count = trained_grams(texts)
    for text in [*texts[:3], "abab ba", "ccc ab", "", "é a"]:
        data, _ = streams([words_of(text)])
        got = scores_of(gram, count, grams(data)).sum()
        assert got == pytest.approx(plain_tree(data.tobytes(), texts), rel=1e-6)


def test_queries_scores_equal_those_of_one_piece(spark, sample, odd_docs):
    """Blocks, buckets and the driver's part give what one process gives."""
    rows = [(r.doc_id, r.doc_id is not None and r.doc_id % 5 == 1, r.text) for d in (sample, odd_docs) for r in d.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string")
    gram, count = trained_grams([t or "" for _, held, t in rows if not held])
    data, ends = streams([words_of(t or "") for _, _, t in rows])
    values = scores_of(gram, count, grams(data)) * own_positions(ends)
    sums = [values[max(a, 0) : max(b - DEPTH, 0)].sum() for a, b in zip(ends, ends[1:], strict=False)]
    expected = [(r[0], value) for r, value in zip(rows, sums, strict=True)]
    got = [(r.doc_id, r.score) for r in score_texts(docs.repartition(3).checkpoint()).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for (a, x), (b, y) in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert a == b and x == pytest.approx(y, rel=1e-5)


def test_blocks_change_no_score(spark, sample, monkeypatch):
    docs = sample.select("doc_id", (F.col("doc_id") % 5 == 1).alias("held_out"), "text")
    whole = {r.doc_id: r.score for r in score_texts(docs).collect()}
    monkeypatch.setattr("tidemark.llm.context_tree.BLOCK", 20_000)
    monkeypatch.setattr("tidemark.llm.context_tree.BUCKET", 1_000)
    cut = {r.doc_id: r.score for r in score_texts(docs).collect()}
    assert cut == pytest.approx(whole, rel=1e-6)


def test_grams_and_tables_round_trip():
    rng = np.random.default_rng(3)
    gram = np.unique(np.concatenate([rng.integers(0, 2**64, 5000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)]))
    assert np.array_equal(unsqueezed(squeezed(gram)), gram)
    table = GramTable(gram, np.arange(len(gram)))
    assert np.array_equal(table[gram[::-1]], np.arange(len(gram))[::-1])
    with pytest.raises(ValueError):
        GramTable(gram[::2], gram[::2])[gram]


def test_base_score_is_exact_and_model_beats_it(spark):
    rows = op3_context_tree(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts: dict = {}
    for r in rows:
        if not r.held_out:
            for w in [*words_of(docs[r.doc_id] or ""), END]:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    for r in rows[:200]:
        words = [*words_of(docs[r.doc_id] or ""), END]
        base = sum(math.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.train_tokens) == (len(words), total)
        assert r.n_known == sum(w in counts for w in words)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    rows = score_texts(docs, docs).collect()
    assert len(rows) == odd_docs.count() and all(r.score < 0 for r in rows)
    empty = no_docs.select("doc_id", F.lit(False).alias("held_out"), "text")
    assert score_texts(empty, empty).collect() == []
    assert all(r.score < 0 and r.n_known == 0 for r in score_texts(docs, empty).collect())


def test_chances_of_large_counts_stay_apart():
    """A byte always seen the same way 2^25 times, and then another one."""
    gram, count = trained_grams(["aaaa aaaa aaaa", "aaaa"])
    texts = []
    for text in ("aaaa", "\u00e9\u00e9\u00e9", "aaaa"):
        data, _ = streams([words_of(text)])
        texts.append(scores_of(gram, count << 25, grams(data)).sum())
    first, rare, last = texts
    assert np.isfinite(rare) and rare < -7 * 6
    assert first == pytest.approx(last) and -5 < last < 0


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_block_takes_little_memory_beside_its_grams():
    """Before, windows and the block's grams were merged at once: 420 MB here, and 95 bytes a gram in the table."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 50_000, dtype=np.uint8).tobytes().decode() for _ in range(120)]
    held = [i % 3 == 0 for i in range(len(texts))]
    frame = pd.DataFrame({"part": 1, "held_out": held, "text": texts})
    frames = [frame[i : i + 10] for i in range(0, len(frame), 10)]
    found, peak = peak_of(lambda: list(block_grams(iter(frames))))
    ((block, gram, count),) = found
    every, times = trained_grams(texts)
    assert block == 1 << 24 and np.array_equal(gram, every)
    known, times = trained_grams([t for t, h in zip(texts, held, strict=True) if not h])
    assert np.array_equal(gram[count > 0], known) and np.array_equal(count[count > 0], times)
    assert peak < 30 * len(gram) + (100 << 20)
    score = np.arange(len(gram), dtype=np.float32)
    table, peak = peak_of(lambda: GramTable(gram, score))
    assert peak < 50 * len(gram)
    assert np.array_equal(table[gram[::7]], score[::7])


def test_tokens_have_hashes_of_their_own():
    tokens = [b"a", b"b", END, "\u00e9".encode(), b"a" * 100, b"a\x00", b"\x00"]
    hashes = token_hashes(tokens)
    assert len(set(hashes.tolist())) == len(tokens)
    assert hashes.dtype == np.int64 and np.array_equal(token_hashes(np.array(tokens, object)), hashes)
    assert len(token_hashes([])) == 0
