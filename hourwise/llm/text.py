"""Words of UTF-8 texts, for functions that run in tasks."""

from __future__ import annotations

import pyarrow as pa

from hourwise.llm.common import travels

travels(__name__)

#: Very long texts are read in pieces of so many bytes.
PIECE = 1 << 20
#: 1:1 over the bytes of UTF-8: A-Z to a-z, digits, a-z and non-ASCII as they are, all others to a space.
FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
             for c in range(256))


def folded_pieces(raw: bytes):
    """The folded text in pieces that end between two words."""
    at, n = 0, len(raw)
    while at < n:
        end = at + PIECE
        piece = raw[at:end].translate(FOLD)
        while end < n and (gap := piece.rfind(b" ")) < 0:
            end += PIECE
            piece = raw[at:end].translate(FOLD)
        if end < n:
            piece = piece[:gap + 1]
        yield piece
        at += len(piece)


def words_in(raw: bytes):
    """Lists of the words of a text, in order, piece by piece."""
    for piece in folded_pieces(raw):
        yield piece.split()


def texts_of(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
