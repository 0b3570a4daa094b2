"""Word shingles of texts as sorted 64-bit hashes, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd

CHUNK_BYTES = 2 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB, 0xBF58476D1CE4E5B9], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    """Lower-case words: A-Z lowered, cut at space and \\x09-\\x0D (what bytes.split cuts at)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    table = np.empty(len(words), object)
    table[:] = words
    return pd.util.hash_array(table, categorize=False)


def chunks(texts: list[str | None], size: int = CHUNK_BYTES):
    """Slices of `texts` of about `size` characters, so that word lists stay small."""
    at, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t) if t else 0
        if held >= size:
            yield slice(at, k + 1)
            at, held = k + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Per text its distinct shingles of `n` words, ascending; a shorter text is one shingle of all its words."""
    out: list[np.ndarray] = []
    for part in chunks(texts):
        split = [split_words(t) for t in texts[part]]
        counts = [len(w) for w in split]
        hashes = hash_words([w for ws in split for w in ws])
        total = len(hashes)
        if total >= n:
            rolled = np.zeros(total - n + 1, np.uint64)
            for k in range(n):
                rolled += hashes[k : total - n + 1 + k] * _ODD[k % 8] * np.uint64(2 * (k // 8) + 1)
            rolled = mix(rolled)
        at = 0
        for c in counts:
            if c >= n:
                out.append(np.unique(rolled[at : at + c - n + 1]))
            elif c:
                short = (hashes[at : at + c] * _ODD[np.arange(c) % 8]).sum(dtype=np.uint64)
                out.append(mix(np.array([short + np.uint64(c)])))
            else:
                out.append(np.zeros(0, np.uint64))
            at += c
    return out
