import hashlib
import random

import pytest

from tidemark.llm.phrase_fingerprint import (
    PhraseParse,
    edit,
    fingerprint,
    fingerprint_pair,
    likeness,
    neighbours,
    printed,
)


def plain_phrases(text):
    seen, word = set(), ""
    for c in text:
        word += c
        if word not in seen:
            seen.add(word)
            word = ""
    return seen


def test_parse_is_the_plain_dictionary_parse():
    rng = random.Random(3)
    for n in (0, 1, 5, 400):
        text = "".join(rng.choice("abé\U0001f600") for _ in range(n))
        ends = PhraseParse().feed([ord(c) for c in text]).ends
        assert {text[a:b] for a, b in zip([0, *ends], ends, strict=False)} == plain_phrases(text)


def test_forked_parse_equals_two_parses():
    rng = random.Random(4)
    text = "".join(rng.choice("abc ") for _ in range(900))
    edited, stays = edit(text, "zzz" * 400)
    own, other = fingerprint_pair(text, edited, stays)
    assert printed(own) == printed(fingerprint(text))
    assert printed(other) == printed(fingerprint(edited))


def test_likeness_follows_the_phrase_sets():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    text = " ".join(rng.choice(words) for _ in range(2000))
    for keep in (0.9, 0.6, 0.2):
        cut = int(len(text) * keep)
        other = text[:cut] + "".join(rng.choice("qrstuvw") for _ in range(len(text) - cut))
        a, b = plain_phrases(text), plain_phrases(other)
        assert abs(likeness(fingerprint(text), fingerprint(other)) - len(a & b) / len(a | b)) < 0.15
    assert likeness(fingerprint(""), fingerprint("")) == 1.0
    assert likeness(fingerprint(""), fingerprint("a")) == 0.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (-(r.doc_id if r.doc_id is not None else -(2**63)), r.text or ""))
    out = []
    for i, r in enumerate(rows):
        text, following = r.text or "", rows[(i + 1) % len(rows)].text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = fingerprint(text), fingerprint(edited), fingerprint(following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((r.doc_id, len(text), sha, printed(a), printed(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("which", ["odd_docs", "sample", "no_docs"])
def test_neighbours_match_brute_force(request, which):
    docs = request.getfixturevalue(which)
    got = sorted((tuple(r) for r in neighbours(docs).collect()), key=repr)
    assert got == brute(docs.collect())


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(1, "abcabc")], "doc_id long, text string")
    (row,) = neighbours(docs).collect()
    assert row.near_next == 1.0
    assert row.edited_sha256 == hashlib.sha256(b"abcaab").hexdigest()
