"""Ids of whole texts under a tokenizer file, the same as the library gives, with a bounded memory of pieces.

A byte-level BPE cuts a text into pieces by a fixed pattern and encodes each piece by itself. Words recur, so the
pieces met last keep their ids and only new ones reach the library. Texts outside the letters that the pattern below
is known for, and files of any other make, take the library's own way.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

KEPT_PIECES = 400_000

# The piece pattern of byte-level BPE, restricted to Latin letters and ASCII digits; white space of Unicode.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
FOREIGN = re.compile(rf"[^\t\n\r -~{LETTERS}]")
SPACE = " \t-\r\x85\xa0  -     　"
# No piece holds a white space after something else, so a text may be cut before any run of white space.
CHUNK = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


class _Pieces(dict):
    """Piece to id bytes. When full, the pieces become the older generation, of which those still met are kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.pop(piece, None)
        if found is None:
            found = self.encode(piece)
        if len(self) >= KEPT_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


class TextEncoder:
    """`encode` gives the ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        known = [c for c in map(chr, range(0x250)) if not FOREIGN.match(c)]
        self.spelling = {ord(c): spelled(c)[0][0] for c in known}
        before = made["pre_tokenizer"] or {}
        self.n_ids = self.tokenizer.get_vocab_size()
        self.by_piece = (
            made["model"]["type"] == "BPE"
            and made["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not made["truncation"]
        )
        self.special = [token["content"] for token in made["added_tokens"]]
        self.pieces, self.chunks = _Pieces(self._piece), _Pieces(self._chunk)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        spelled = "Ġ" + piece[1:] if piece[0] == " " and piece[1:].isalpha() and piece.isascii() else piece.translate(self.spelling)
        ids = [token.id for token in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        return self._whole(chunk) if FOREIGN.search(chunk) else b"".join([self.pieces[p] for p in PIECE.findall(chunk)])

    def encode(self, text: str) -> bytes:
        if not self.by_piece or any(token in text for token in self.special):
            return self._whole(text)
        if FOREIGN.search(text):
            return b"".join([self.chunks[c] for c in CHUNK.findall(text)])
        return b"".join([self.pieces[p] for p in PIECE.findall(text)])


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """One encoder for each file and process: the tasks of one worker share its pieces."""
    return TextEncoder(path)
