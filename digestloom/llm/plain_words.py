"""Words ``[^\\x20\\x09-\\x0D]+`` of one text as bytes: these separators are those of ``bytes.split``.

UTF-8 keeps ASCII bytes apart from all others, so words of the bytes are words of the text. Long
texts are split in pieces between words, so memory follows a piece and the different words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

PIECE_BYTES = 1 << 20
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    at = 0
    while len(data) - at > size:
        gap = _GAP.search(data, at + size)
        if not gap:
            break
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:] if at else data


def n_words(data: bytes) -> int:
    return sum(len(piece.split()) for piece in pieces(data))


def words_and_distinct(data: bytes) -> tuple[int, int]:
    if len(data) <= PIECE_BYTES:
        words = data.split()
        return len(words), len(set(words))
    n, seen = 0, set()
    for piece in pieces(data):
        words = piece.split()
        n += len(words)
        seen.update(words)
    return n, len(seen)


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; empty for a null one."""
    for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""
