"""Reader for SentencePiece model files: the few fields of the protocol buffer that encoding needs."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    suffix_mark: bool = False
    normaliser: str = ""
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True

    @property
    def unk_id(self) -> int:
        return self.types.index(UNKNOWN)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message: varints as int, everything else as raw bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            elif wire in (1, 5):
                size = 8 if wire == 1 else 4
            else:
                raise ValueError(f"wire type {wire} at byte {at}")
            value, at = data[at:at + size], at + size
        yield number, value


def parse(data: bytes) -> Model:
    model = Model()
    for number, value in fields(data):
        if number == 1:
            piece = dict(fields(value))
            model.pieces.append(piece.get(1, b"").decode())
            model.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            model.types.append(piece.get(3, NORMAL))
        elif number == 2:
            spec = dict(fields(value))
            model.model_type, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            model.suffix_mark = bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(fields(value))
            model.normaliser, model.charsmap = spec.get(1, b"").decode(), spec.get(2, b"")
            model.add_dummy_prefix, model.remove_extra_whitespaces = bool(spec.get(3, 1)), bool(spec.get(4, 1))
            model.escape_whitespaces = bool(spec.get(5, 1))
    return model


def read(path: str = VOCABULARY) -> Model:
    """Parse a model file that lies on the driver; executors get the parsed model."""
    with open(path, "rb") as file:
        return parse(file.read())
