import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm.token_files import (
    _packed,
    _unpacked,
    offsets_of,
    pack_block,
    read_shard,
    read_token_files,
    shard_bytes,
    unpack_block,
    write_token_files,
)
from tidemark.llm.token_ids import tokenizer_path


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for ids in (
        rng.integers(0, 50_000, 4096),
        rng.integers(7, 9, 100),
        np.full(17, 5),
        np.array([3]),
        np.where(rng.random(4096) < 0.02, 2**32 - 1, rng.integers(0, 4, 4096)),
    ):
        ids = ids.astype("<u4")
        block = pack_block(ids)
        assert np.array_equal(unpack_block(b"xx" + block, 2), ids)
    assert len(pack_block(np.arange(4096, dtype="<u4") % 2)) < 600


@pytest.mark.parametrize("width", range(0, 33))
def test_bits_of_every_width(width):
    rng = np.random.default_rng(width)
    for count in (1, 7, 8, 9, 4096):
        values = rng.integers(0, 2**width, count, dtype=np.uint64).astype(np.uint32)
        data = _packed(values, width)
        plain = sum(int(v) << (i * width) for i, v in enumerate(values)).to_bytes((count * width + 7) // 8, "little")
        assert data == plain
        assert np.array_equal(_unpacked(b"x" + data, 1, len(data), count, width), values)


def test_offsets_over_tasks_and_blocks(spark):
    rows = [(f"{task:06d}-{number:06d}.pfor", task * 7 + number, 1, 1) for task in range(40) for number in range(task % 4)]
    written = spark.createDataFrame(rows, "file string, ids long, docs long, bytes long").repartition(5)
    got = {r.file: r.first for r in offsets_of(written, 8).collect()}
    assert got == {name: sum(r[1] for r in sorted(rows) if r[0] < name) for name, *_ in rows}


def test_shard_round_trip():
    rng = np.random.default_rng(2)
    docs = [(i - 3, rng.integers(0, 50_000, n).astype("<u4").tobytes()) for i, n in enumerate([0, 1, 9000, 4096, 0, 4095, 1])]
    assert [(i, a.astype("<u4").tobytes()) for i, a in read_shard(shard_bytes(docs))] == docs


@pytest.mark.parametrize("which", ["odd_docs", "sample", "no_docs"])
def test_files_hold_every_id(request, spark, tmp_path, which):
    docs = request.getfixturevalue(which).filter("doc_id IS NOT NULL")
    written = write_token_files(docs, tokenizer_path(), str(tmp_path / "t"), shard_ids=5000)
    if which == "no_docs":
        assert written.collect() == []
        return
    got = read_token_files(spark, str(tmp_path / "t"), written).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, expected = 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id, r.text or "")):
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_null_ids_are_refused(odd_docs, tmp_path):
    with pytest.raises(Exception, match="doc_id is NULL"):
        write_token_files(odd_docs, tokenizer_path(), str(tmp_path / "t"))


def test_null_ids_have_a_place(spark, odd_docs, tmp_path):
    import tidemark.llm.token_files as module

    more = [(None, "another one"), (None, None), (None, None), (2**60 + 1, "large id"), (2**60 + 3, "large id")]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = module.op9_token_files(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    start, expected = 0, []
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
