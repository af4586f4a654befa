"""Texts as numbered tokens, in chunks: what operators that look tokens up in tables of the whole corpus share.

A chunk holds the texts of one task up to a bounded number of tokens, as numbers into the chunk's own
list of distinct tokens. Lookups then travel once per chunk and distinct token, not once per token.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import zstandard

CHUNK_TOKENS = 2_000_000


def squeeze(x: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T if len(x) else np.empty(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).reshape(-1) if len(raw) else np.empty(0, dtype)


class Numbering:
    """Tokens to numbers, in order of their first appearance."""

    def __init__(self):
        self.ids = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.texts: list[np.ndarray] = []
        self.tokens = 0

    def add(self, tokens: list) -> None:
        x = np.fromiter(map(self.ids.__getitem__, tokens), np.int32, len(tokens))
        self.texts.append(x)
        self.tokens += len(x)

    def numbers(self) -> np.ndarray:
        return np.concatenate(self.texts) if self.texts else np.empty(0, np.int32)

    def lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.texts], np.int64)


#: Bits of a chunk's number within its task. A task of more chunks would hold billions of tokens.
NUMBER_BITS = 12


def chunk_id(partition: int, number: int) -> int:
    if number >> NUMBER_BITS:
        raise OverflowError("a task has too many chunks: read its table in smaller splits")
    return partition << NUMBER_BITS | number
