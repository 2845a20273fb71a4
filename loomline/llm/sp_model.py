"""Reads a SentencePiece model file: pieces, scores, kinds and normaliser.

Only the fields that the operators need are read from the protocol buffer.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

#: Fixed values of the file format: kinds of pieces, and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: How the format writes a space.
MARK = "▁"


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
    """(number, value) of each field of a message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceFile:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    identity: bool = True
    dummy_prefix: bool = True
    squeeze_spaces: bool = True

    @property
    def plain(self) -> bool:
        """Whether a text is only given a leading space, and nothing else."""
        return self.identity and self.dummy_prefix and not self.squeeze_spaces

    @property
    def breaks_at_spaces(self) -> bool:
        """Whether no piece goes on with a space after anything else."""
        return not any(a != MARK and b == MARK for p in self.pieces for a, b in zip(p, p[1:]))


def read(path: str) -> PieceFile:
    with open(path, "rb") as f:
        data = f.read()
    out = PieceFile()
    for number, value in fields(data):
        if number == 1:
            got = dict(fields(value))
            out.pieces.append(got.get(1, b"").decode())
            out.scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
            out.kinds.append(got.get(3, NORMAL))
        elif number == 2:
            out.model_type = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            got = dict(fields(value))
            out.identity = not got.get(2)
            out.dummy_prefix = bool(got.get(3, 1))
            out.squeeze_spaces = bool(got.get(4, 1))
    return out
