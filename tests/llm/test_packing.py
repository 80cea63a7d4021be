import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import OpenBins, pack, pack_documents
from tidemark.llm.token_ids import TextEncoder, tokenizer_path


def direct(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [
        (r.doc_id, np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"))
        for r in rows
    ]


@pytest.mark.parametrize("which", ["odd_docs", "sample"])
def test_pieces_are_exact_and_bins_gapless(request, which):
    docs = request.getfixturevalue(which)
    expected = []
    for doc_id, ids in direct(docs.collect()):
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            expected.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    rows = pack_documents(docs, tokenizer_path()).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= sum(r.length for r in rows) / 2048 * 1.05 + 2


def test_encoder_equals_the_library():
    words = ["a<|endoftext|>b", "It's", "İx", "é", " ", "\x1c", "\r\n", "12,5", "\U0001f600"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(words + [" ", "\n", "\t"]) for _ in range(30)) for _ in range(200)]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    for text, ids in zip(texts, TextEncoder(tokenizer_path()).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_open_bins_take_the_best_fit_and_close_the_fullest():
    bins = OpenBins(10, 2)
    assert bins.add(0, 6) == [] and bins.add(1, 7) == []
    assert bins.add(2, 3) == [([1, 2], 0)]
    assert bins.add(3, 5) == []
    assert bins.add(4, 9) == [([0], 4)]
    assert sorted(bins.rest()) == [([3], 5), ([4], 1)]


def test_bins_travel_on_between_tasks(spark):
    rows = [(i, 0, 0, 1 + i * 37 % 1500, i) for i in range(600)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(pieces.repartition(20), open_bins=16).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    used = {}
    for r in got:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048
    assert len(used) <= sum(used.values()) / 2048 * 1.12


def test_empty(no_docs):
    assert pack_documents(no_docs, tokenizer_path()).collect() == []
