"""Token ids of whole texts by the `tokenizers` library, with a bounded memory of pieces already encoded.

A byte-level tokenizer cuts a text into pieces by its public pattern and encodes each piece alone, and no
piece crosses a place where `CHUNK` cuts. So a text's ids are the ids of its chunks one after another, a chunk's
those of its pieces, and a piece that a worker has not met is encoded by the library's model.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import regex

DEFAULT_FILE = "byte_bpe_50k.json"
# The public pattern of byte-level BPE vocabularies.
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = re.compile(r" ?[^\s]+|\s+(?!\S)|\s+")
# Characters on which Python's and the library's notion of white space differ: such texts are encoded whole.
UNSAFE = re.compile("[\x1c-\x1f]")
# Entries a worker remembers before it starts anew; about 200 bytes each.
MEMORY_CHUNKS = 900_000
MEMORY_PIECES = 900_000


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


LETTERS = byte_letters()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class Chunks(dict):
    """Ids of chunks; a chunk that is not there is encoded when asked for, so a text is cut and looked up once."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model.tokenize
        self.cut = regex.compile(PIECE).findall
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        return array("I", [token.id for token in self.model(piece.encode().decode("latin-1").translate(LETTERS))]).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isascii() and word.isalpha():  # one piece
            ids = self._piece(chunk)
        else:
            pieces, found = self.pieces, []
            for piece in self.cut(chunk):
                known = pieces.get(piece)
                if known is None:
                    known = pieces[piece] = self._piece(piece)
                found.append(known)
            ids = b"".join(found)
        self[chunk] = ids
        return ids


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids as bytes; one per worker and tokenizer file."""

    _made: dict[tuple[str, bool], "Encoder"] = {}

    def __init__(self, path: str, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [
            str(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.chunks = Chunks(self.tokenizer)

    @classmethod
    def of(cls, path: str, special_as_text: bool = False) -> "Encoder":
        if (path, special_as_text) not in cls._made:
            cls._made[path, special_as_text] = cls(path, special_as_text)
        return cls._made[path, special_as_text]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, without an end id. Null and empty texts have none."""
        if not text:
            return b""
        if UNSAFE.search(text) or any(token in text for token in self.special):
            return self.whole(text)
        if len(self.chunks) > MEMORY_CHUNKS:
            self.chunks = Chunks(self.tokenizer)
        elif len(self.chunks.pieces) > MEMORY_PIECES:
            self.chunks.pieces = {}
        return b"".join(map(self.chunks.__getitem__, CHUNK.findall(text)))


def encoded(texts, path: str, special_as_text: bool = False) -> Iterator[bytes]:
    encoder = Encoder.of(path, special_as_text)
    return map(encoder.encode, texts)
