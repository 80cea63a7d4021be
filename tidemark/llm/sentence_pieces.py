"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read field by field. From it are rebuilt: the normaliser
(character map, extra white space, metaspace marker and leading marker), the
unigram scores or the merges that the scores of a BPE model imply, and byte
fallback. Texts are cut where no piece of the vocabulary can cross (before a run
of markers); a worker remembers the ids of the stretches it has met, encodes new
ones in multithreaded batches, and compares each with the sentencepiece library.
A text is in parity if all its stretches are; unigram models, whose ties are broken
along the whole text, encode and compare whole texts. Lists of ids are decoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import batches, table, uncollected, whole_text, worker_memory

MODEL = "piece_bpe_32k.model"
MARK = "▁"

#: Fixed values of the model file: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Stretches a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Stretches encoded as one text.
TOGETHER = 64
#: Threads of a worker that encode a batch.
THREADS = 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    suffix_mark: bool = False
    character_map: bytes = b""
    leading_mark: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True


def parse_model(data: bytes) -> PieceModel:
    model = PieceModel()
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    (score,) = struct.unpack("<f", v)
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in fields(value):
                if n == 3:
                    model.model_type = v
                elif n == 24:
                    model.suffix_mark = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
                elif n == 40:
                    model.unk_id = v
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    model.character_map = v
                elif n == 3:
                    model.leading_mark = bool(v)
                elif n == 4:
                    model.trim_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    if model.model_type not in (UNIGRAM, BPE) or model.suffix_mark or not model.escape_spaces:
        raise ValueError("only unigram and BPE models with a leading space marker are rebuilt")
    return model


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """The merges of a BPE model, best first: every split of every piece."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, at in ids.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in ids and right in ids:
                found.append((-model.pieces[at][1], at, ids[left], ids[right], left, right))
    return [f[4:] for f in sorted(found)]


class PieceTokenizer:
    """A model rebuilt for the tokenizers library."""

    def __init__(self, path: str):
        # A task has a core or two; more threads would wait for each other.
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        import sentencepiece
        from tokenizers import Tokenizer, decoders, models, normalizers

        with open(path, "rb") as file:
            self.model = model = parse_model(file.read())
        self.reference = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.model_type == UNIGRAM:
            vocabulary = [(p, s) for p, s, _ in model.pieces]
            core = models.Unigram(vocabulary, model.unk_id, model.byte_fallback)
        else:
            core = models.BPE(
                {p: i for i, (p, _, _) in enumerate(model.pieces)},
                merges_of(model),
                unk_token=model.pieces[model.unk_id][0],
                fuse_unk=True,
                byte_fallback=model.byte_fallback,
            )
        self.tokenizer = Tokenizer(core)
        steps = [normalizers.Precompiled(model.character_map)] if model.character_map else []
        if model.trim_spaces:
            from tokenizers import Regex

            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        self.normaliser = normalizers.Sequence(steps) if steps else None
        self.tokenizer.decoder = decoders.Sequence(
            [
                decoders.Replace(MARK, " "),
                decoders.ByteFallback(),
                decoders.Fuse(),
            ]
        )
        inner = re.compile(f"[^{MARK}]{MARK}")
        # Merges of a BPE model never cross into a stretch that no piece spans. Of a
        # unigram model's segmentations, ties are broken along the whole text, and
        # user-defined symbols are cut out of it first: such texts stay whole.
        parted = model.model_type == BPE and all(k != USER_DEFINED for _, _, k in model.pieces)
        self.separable = parted and not any(inner.search(p) for p, _, k in model.pieces if k == NORMAL)
        self.begins = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.unequal: set[str] = set()

    def normalise(self, text: str) -> str:
        """The text as the model sees it: mapped, marked."""
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text)
        if not text:
            return ""
        return (MARK if self.model.leading_mark else "") + text.replace(" ", MARK)

    def plain(self, text: str) -> str:
        """The normalised text as decoding should give it back."""
        if self.normaliser is None and MARK not in text:
            return text
        lead = 1 if self.model.leading_mark else 0
        return self.normalise(text)[lead:].replace(MARK, " ")

    def stretches(self, normal: str) -> list[str]:
        """Parts of a normalised text that are encoded independently."""
        if not normal:
            return []
        return _STRETCH.findall(normal) if self.separable else [normal]

    def _ids_of(self, new: list[str]) -> list[bytes]:
        """The ids of stretches, as u32 bytes, encoded in batches.

        Stretches that begin with their only marker are encoded ``TOGETHER`` and cut
        before the pieces that begin with one; what does not come apart into as many
        stretches, and all others, is encoded by itself.
        """
        out: dict[str, bytes] = {}
        single = [s for s in new if self.separable and s.rfind(MARK) == 0]
        groups = [single[i : i + TOGETHER] for i in range(0, len(single), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found, strict=True):
            ids = np.array(encoding.ids, dtype="<u4")
            starts = (np.flatnonzero(self.begins[ids]) * 4).tolist()
            if len(starts) == len(group) and starts[0] == 0:
                data = ids.tobytes()
                ends = [*starts[1:], len(data)]
                out.update(zip(group, (data[a:b] for a, b in zip(starts, ends, strict=True)), strict=True))
        rest = [s for s in new if s not in out]
        for stretch, encoding in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[stretch] = np.array(encoding.ids, dtype="<u4").tobytes()
        return [out[s] for s in new]

    def learn(self, new: list[str]) -> None:
        """Encode new stretches in batches and compare them with the library's own."""
        lead = 1 if self.model.leading_mark else 0
        asked = [s[lead:].replace(MARK, " ") if s[:lead] == MARK[:lead] else None for s in new]
        plain = self.reference.encode([a or "" for a in asked], num_threads=1)
        for stretch, ids, question, own in zip(new, self._ids_of(new), asked, plain, strict=True):
            if question == "":
                own = [self.reference.piece_to_id(stretch)] if len(ids) == 4 else own
            self.known[stretch] = ids
            if question is not None and ids != struct.pack(f"<{len(own)}I", *own):
                self.unequal.add(stretch)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """For each text its ids as u32 bytes, and whether it is in parity."""
        if len(self.known) > REMEMBERED or not self.separable:
            # Whole texts seldom come again and are not worth their room.
            self.known, self.words, self.unequal = {}, {}, set()
        plain = self.separable and self.normaliser is None and self.model.leading_mark
        # A text of words with single spaces between needs no marks: its words are
        # looked up as they are.
        cut, simple = [], []
        for text in texts:
            easy = plain and text[:1] not in ("", " ") and text[-1] != " "
            simple.append(easy and "  " not in text and MARK not in text)
            cut.append(text.split(" ") if simple[-1] else self.stretches(self.normalise(text)))
        words: set[str] = set()
        others: set[str] = set()
        for parts, easy in zip(cut, simple, strict=True):
            (words if easy else others).update(parts)
        fresh = words - self.words.keys()
        new = (others | {MARK + w for w in fresh}) - self.known.keys()
        self.learn(list(new))
        self.words.update((w, self.known[MARK + w]) for w in fresh)
        out = []
        for parts, easy in zip(cut, simple, strict=True):
            find = (self.words if easy else self.known).__getitem__
            lead = MARK if easy else ""
            same = not self.unequal or not any(lead + p in self.unequal for p in parts)
            out.append((b"".join(map(find, parts)), same))
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        """The text of each list of ids, given as u32 bytes."""
        lists = [np.frombuffer(data, "<u4").tolist() for data in ids]
        texts = self.tokenizer.decode_batch(lists, skip_special_tokens=False)
        return [t.removeprefix(" ") for t in texts] if self.model.leading_mark else texts


_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def tokenizer_of(path: str) -> PieceTokenizer:
    """The worker's tokenizer of a model file, made once."""
    return worker_memory(("pieces", path), lambda: PieceTokenizer(path))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` encoded, decoded and compared.

    Returns doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit integers), parity with the sentencepiece library, and round_trip:
    whether decoding gives back the normalised text. A NULL text is empty.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_of(path)
        for frame in batches(frames, 1_000_000):
            texts = frame["text"].tolist()
            with uncollected():
                found = tokenizer.encode(texts)
                decoded = tokenizer.decode([ids for ids, _ in found])
                rows = [
                    (doc_id, len(ids) // 4, zlib.crc32(ids), same)
                    + (back == tokenizer.plain(text),)
                    for doc_id, text, (ids, same), back in zip(frame["doc_id"], texts, found, decoded, strict=True)
                ]
            out = pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    shape = "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    return docs.select("doc_id", whole_text().alias("text")).mapInPandas(run, shape)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), model_path())
