"""Phrases of texts as 96-bit keys, and bounded filters over keys, in numpy, for use inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np

from tidemark.llm.shingles import _ODD, mix

LONGEST = 4
GAP = b"\xff"  # stands between pieces; no UTF-8 text has this byte
# A-Z lowered; what ends a piece becomes a line feed.
_PIECE_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_LEVELS = np.arange(LONGEST + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


# A random number for each (place in a word, byte); places beyond come round again with another factor.
_PLACES = 64
_TABLES = mix(np.arange(2 * _PLACES * 256, dtype=np.uint64) + np.uint64(0x517CC1B727220A95)).reshape(2, -1)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first hash, second hash) of the words of `raw`, which spaces and tabs part."""
    text = np.frombuffer(b" " + raw + b" ", np.uint8)
    inside = (text != 32) & (text != 9)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]  # places in `raw`
    if not len(start):
        return start, end, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    body = text[1 + start[0] : -1]
    first, last = start - start[0], end - start[0] - 1
    place = np.arange(len(body), dtype=np.int32) - np.repeat(first.astype(np.int32), np.diff(first, append=len(body)))
    cell, far = ((place & (_PLACES - 1)) << 8) | body, np.flatnonzero(place >= _PLACES)
    out = []
    for table in _TABLES:
        value = table[cell]
        if len(far):
            value[far] = mix(value[far] + (place[far] // _PLACES).astype(np.uint64) * _ODD[0])
        upto = np.cumsum(value)
        out.append(mix(upto[last] - upto[first] + value[first]))
    return start, end, *out


def seal(first: np.ndarray, second: np.ndarray, k: int, lang: tuple[np.uint64, np.uint64]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (64-bit, 32-bit) from sums over words; the lowest 3 bits of the second hold the number of words."""
    high = mix(first + lang[0] + _LEVELS[k])
    low = (mix(second + lang[1] + _LEVELS[k]) >> np.uint64(32)).astype(np.uint32)
    return high.view(np.int64), ((low & ~np.uint32(7)) | np.uint32(k)).view(np.int32)


def lang_hash(lang: str) -> tuple[np.uint64, np.uint64]:
    """Hashes of the whole name, whatever bytes it has."""
    digest = hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.uint64))


class Filter:
    """A set of keys as bits of bounded size: none is missed, a few others pass."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def has(self, high: np.ndarray) -> np.ndarray:
        key = high.view(np.uint64)
        out = np.ones(len(key), bool)
        for slot in (key & self.mask, (key >> np.uint64(36)) & self.mask):
            out &= (self.bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


class Chunk:
    """Texts of one language as a row of words with gaps between pieces."""

    def __init__(self, lang: str, texts: list[bytes]) -> None:
        self.raw = (b" " + GAP + b" ").join(t.translate(_PIECE_BYTES).replace(b"\n", b" " + GAP + b" ") for t in texts)
        self.start, self.end, *self.h = word_hashes(self.raw)
        self.word = np.frombuffer(self.raw, np.uint8)[self.start] != GAP[0]
        self.lang = lang_hash(lang)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys and counts of all words, and of the phrase of no word, which counts them all."""
        high, low, counts = tally(*self.keys(1, np.flatnonzero(self.word)))
        none = seal(np.zeros(1, np.uint64), np.zeros(1, np.uint64), 0, self.lang)
        return np.append(high, none[0]), np.append(low, none[1]), np.append(counts, counts.sum())

    def keys(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the phrases of `k` words that begin at `at`."""
        sums = [np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)]
        for j in range(k):
            for s, h in zip(sums, self.h):
                s += h[at + j] * _ODD[j]
        return seal(*sums, k, self.lang)

    def begins(self, stages: list[dict[int, Filter]], upto: int = LONGEST) -> dict[int, list[np.ndarray]]:
        """Per length from 2, and for each stage of filters, where phrases begin both of whose parts one
        word shorter pass. What passes in a stage must pass in the last."""
        good, out = [self.word] * len(stages), {}
        for k in range(1, upto + 1):
            if k > 1:
                begin = [g.copy() for g in good]
                for b, g in zip(begin, good):
                    b[:-1] &= g[1:]
                    b[-1:] = False
                out[k] = begin
            else:
                begin = good
            if k < upto and any(k in filters for filters in stages):
                at = np.flatnonzero(begin[-1])
                high = self.keys(k, at)[0]
                good = [b.copy() for b in begin]
                for g, filters in zip(good, stages):
                    g[at] &= filters[k].has(high)
            else:
                good = begin
        return out

    def text(self, k: int, at: int) -> str:
        return b" ".join(self.raw[self.start[i] : self.end[i]] for i in range(at, at + k)).decode("utf-8", "surrogatepass")


def tally(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and how often each occurs; two keys that share their first part may come in several rows."""
    order = np.argsort(high, kind="stable")
    high, low = high[order], low[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    return high[at], low[at], np.diff(np.append(at, len(high)))


def part_keys(lang: str, phrases: list[str], k: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """For phrases of `k` words the keys of each run of words (first, stop) shorter than the whole."""
    _, _, *h = word_hashes(b" ".join(p.encode("utf-8", "surrogatepass") for p in phrases))
    of, (a, b) = lang_hash(lang), (x.reshape(-1, k) for x in h)
    runs = [(i, j) for i in range(k) for j in range(i + 1, k + 1) if j - i < k]
    odd = _ODD[:k]
    return {(i, j): seal((a[:, i:j] * odd[: j - i]).sum(1, dtype=np.uint64), (b[:, i:j] * odd[: j - i]).sum(1, dtype=np.uint64), j - i, of) for i, j in runs}
