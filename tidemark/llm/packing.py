"""Numbers packed into bytes for shuffles between tasks that exchange whole arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def pack_numbers(x: np.ndarray) -> bytes:
    """Byte planes, lowest first, as many as the largest number needs; the first byte says how many.

    Planes of equal bytes cost nothing under the shuffle's codec.
    """
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_numbers(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel()


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys, as their differences."""
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(raw), dtype=np.uint64)


def edges(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each of `buckets` equal ranges of the key space begins among ascending keys, and the end."""
    firsts = np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << bits) // max(2, buckets))
    return np.concatenate([[0], np.searchsorted(keys, firsts), [len(keys)]])


def by_chunk(chunks: np.ndarray, places: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each chunk with its distinct places (below `n`), both ascending."""
    if not len(chunks):
        return
    chunk, place = np.divmod(np.unique(chunks * n + places), n)
    turn = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))
    yield from zip(chunk[turn].tolist(), np.split(place, turn[1:]))
