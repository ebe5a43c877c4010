"""Compact binary forms of sorted keys, counts and flags that travel in one row."""

from __future__ import annotations

import zlib

import numpy as np


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys: the first, then differences in as few bytes as the largest needs."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + low.tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    steps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(steps) + 1, 8), np.uint8)
    wide[1:, :width] = steps
    wide[0] = np.frombuffer(data, np.uint8, 8, 1)
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    kind = "u1" if not len(counts) or counts.max() < 1 << 8 else "<u2" if counts.max() < 1 << 16 else "<u8"
    return kind[-1].encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def unpack_counts(data: bytes) -> np.ndarray:
    kind = {"1": "u1", "2": "<u2", "8": "<u8"}[chr(data[0])]
    return np.frombuffer(zlib.decompress(data[1:]), kind).astype(np.int64)


def key_range(keys: np.ndarray, parts: int, bits: int = 64) -> np.ndarray:
    """Which of ``parts`` equal ranges of the key space each key of ``bits`` bits lies in."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def range_edges(sorted_keys: np.ndarray, parts: int, bits: int = 64):
    """``(part, first, end)`` of the ranges that hold keys."""
    places = key_range(sorted_keys, parts, bits)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(places)]):
        yield int(places[a]), a, b
