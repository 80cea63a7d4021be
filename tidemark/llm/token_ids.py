"""Token ids of whole texts with a tokenizer file of the tokenizers library.

The word tokenizer drops white space and never joins characters across it, so
the ids of a text are those of its space-separated pieces in order. Each worker
keeps the ids of pieces it has met as little-endian 32-bit bytes; a text is then
one join of byte strings, and only new pieces reach the library.

The tokenizer lowers all letters, so a text of Latin-1 letters alone is lowered first
and has fewer pieces to know. Of a new piece that is a Latin word with closing
punctuation, word and punctuation are known apart: the word is given to the library's
model alone, which costs half of the way through its normaliser and splitter and gives
the same ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

import numpy as np

from tidemark.llm.common import uncollected, worker_memory

TOKENIZER = "word_bpe_49k.json"

#: Entries (about 200 bytes each) of a worker's memory before the older half goes.
REMEMBERED = 600_000

#: Latin-1 letters, composed, then ASCII marks that split off as one run.
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
#: The parts of a tokenizer file for which pieces are independent.
NORMALISERS = ["NFC", "Replace", "Lowercase"]
SPLITTERS = ["Split", "ByteLevel"]

#: The byte alphabet's places of bytes that are not printable characters.
_MOVED = {b: 256 + 33 + b - 0x7F for b in range(0x7F, 0xA1)} | {0xAD: 256 + 33 + 34}



def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Memory(dict):
    """Remembers what ``find`` gives for a key; forgets what was not asked for lately."""

    def __init__(self, find: Callable[[str], bytes], most: int):
        self.find, self.half = find, most // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class TextEncoder:
    """Encodes texts with one tokenizer file, remembering pieces."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        kinds = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = [n["type"] for n in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != NORMALISERS or splits != SPLITTERS:
            raise ValueError("the tokenizer's pieces are not independent of each other")
        self.model = self.tokenizer.model
        self.pieces = Memory(self._piece, remembered)
        self.marks = Memory(self._whole, remembered // 10)

    @staticmethod
    def of(path: str, remembered: int = REMEMBERED) -> TextEncoder:
        """The worker's encoder of a file, made once."""
        return worker_memory(("token ids", path, remembered), lambda: TextEncoder(path, remembered))

    def _whole(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        # The model's alphabet writes each UTF-8 byte as one character; those of
        # Latin letters are printable or, from 0x80 to 0xA0 and 0xAD, moved up.
        written = word if word.isascii() else word.encode().decode("latin-1").translate(_MOVED)
        ids = [token.id for token in self.model.tokenize(written)]
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _piece(self, piece: str) -> bytes:
        match = WORD.fullmatch(piece)
        if match is None:
            return self._whole(piece)
        word, marks = match.groups()
        lowered = word.lower()
        if lowered == piece:
            return self._word(piece)
        ids = self.pieces[lowered]
        return ids + self.marks[marks] if marks else ids

    def _text(self, text: str) -> bytes:
        if text.isascii() or _latin(text):
            text = text.lower()
        return b"".join(map(self.pieces.__getitem__, text.replace("\n", " ").split(" ")))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit bytes."""
        with uncollected():
            return [self._text(t) for t in texts]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True
