import hashlib
from collections import defaultdict

from tidemark.llm.exact_dedup import drop_copies, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[r.text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256((r.text or "").encode()).hexdigest()
        out.append((r.doc_id, keep, len(ids), r.doc_id == keep, sha))
    return sorted(out, key=repr)


def test_groups_match_brute_force_at_any_block_size(odd_docs):
    expected = brute(odd_docs.collect())
    for size in (64, 4096):
        got = exact_groups(odd_docs, size).collect()
        assert sorted((tuple(r) for r in got), key=repr) == expected


def test_sample(sample):
    got = exact_groups(sample).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(sample.collect())


def test_drop_copies_keeps_columns_and_one_id_a_group(odd_docs, no_docs):
    kept = drop_copies(odd_docs, 64)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [
        -3, 2, 4, 4, 6, 7, 8, 9, 10, 11, 12,
    ]
    assert drop_copies(no_docs).collect() == []
    assert exact_groups(no_docs).collect() == []
