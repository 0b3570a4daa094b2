"""External induced suffix sorting with common-prefix lengths, in numpy.

The suffixes that begin a rise after a fall (the seeds) are sorted first: their stretches up to the
next seed are named by rank, and the string of names, less than half as long, is sorted by the same
method again, or in memory once it is small. All other suffixes follow by induction: a sweep over
the sorted suffixes puts each one's left neighbour into a priority queue under its first letter,
with the rank of its rest, and takes from the queue what is due next. The queue works in batches
(all suffixes of the least letter at once) and moves to disk beyond a bound. Common-prefix lengths
ride along: two neighbours of one letter share one letter more than the least length between the
ranks of their rests. Lengths are cut at `cap`. Letters, places and lengths are kept in the smallest
types that hold them, as most of the time goes into random reads of these arrays.
"""

from __future__ import annotations

import tempfile

import numpy as np

IN_MEMORY = 1 << 24
BLOCK = 1 << 14  # letters that are packed at once, in a core's cache
SMALL = 1 << 13  # letters and lengths below need 16 bits, also doubled


def room(n: int, in_memory: int, kind: type = np.int64) -> np.ndarray:
    """An array of `n` numbers, in an unlinked scratch file of the task beyond `in_memory`."""
    if n <= in_memory:
        return np.empty(n, kind)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, kind, "w+", shape=(n,))


def place_type(n: int) -> type:
    """The type of places in a text of `n` letters."""
    return np.int32 if n < 1 << 31 else np.int64


class LetterQueue:
    """Priority queue of suffixes (position, rank of the rest), taken letter by letter.

    At most `in_memory` entries stay in memory; the rest is in an unlinked scratch file.
    """

    def __init__(self, in_memory: int):
        self.in_memory, self.held = in_memory, 0
        self.near: dict[int, list[np.ndarray]] = {}
        self.far: dict[int, list[tuple[int, int]]] = {}
        self.file, self.kind = None, np.dtype(np.int64)

    def push(self, letters: np.ndarray, pos: np.ndarray, rank: np.ndarray) -> None:
        if not len(pos):
            return
        # Few letters: 16 bits sort by radix.
        order = np.argsort(letters.astype(np.uint16) if letters.max() < 1 << 16 else letters, kind="stable")
        letters, pair = letters[order], np.stack([pos[order], rank[order]])
        self.kind = pair.dtype
        cut = np.flatnonzero(np.diff(letters)) + 1
        for letter, part in zip(letters[np.concatenate([[0], cut])].tolist(), np.split(pair, cut, axis=1)):
            self.near.setdefault(letter, []).append(part)
        self.held += len(pos)
        if self.held > self.in_memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for letter, parts in self.near.items():
            both = np.concatenate(parts, axis=1)
            self.far.setdefault(letter, []).append((self.file.tell(), both.shape[1]))
            self.file.write(both.tobytes())
        self.near, self.held = {}, 0

    def pop(self, letter: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Everything queued under `letter`, by rank; None if there is nothing."""
        parts = self.near.pop(letter, [])
        self.held -= sum(p.shape[1] for p in parts)
        for at, n in self.far.pop(letter, []):
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(2 * self.kind.itemsize * n), self.kind).reshape(2, n))
        if not parts:
            return None
        pos, rank = np.concatenate(parts, axis=1) if len(parts) > 1 else parts[0]
        if (rank[1:] < rank[:-1]).any():  # a sweep pushes in rank order, also across spills
            order = np.argsort(rank)
            pos, rank = pos[order], rank[order]
        return pos, rank

    def close(self) -> None:
        if self.file:
            self.file.close()


def rising(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour; the last one is not."""
    n = len(text)
    turn = np.zeros(n, np.int8)
    turn[:-1] = np.sign(text[1:] - text[:-1])
    turn[-1] = -1
    nearest = np.where(turn != 0, np.arange(n, dtype=place_type(n)), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]  # equal letters go as the next unequal pair goes
    return turn[nearest] > 0


def run_lengths(text: np.ndarray, at: int) -> int:
    end = at + 1
    while end < len(text) and text[end] == text[at]:
        end += 1
    return end - at


def _sweep(text, seeds, seed_lcp, induce, cap, descending, in_memory, total):
    """One sweep: the seeds in scan order, and in front of a letter's seeds what is induced under it.

    Returns positions, common-prefix lengths with the entry before, and whether the entry was induced.
    """
    place, small = place_type(total), np.int16 if cap < SMALL else np.int64
    pos_out, lcp_out, was_induced = room(total, in_memory, place), room(total, in_memory, small), np.zeros(total, bool)
    queue, at = LetterQueue(in_memory), 0
    seed_letters = text[seeds]
    letters = np.flatnonzero(np.bincount(text)) if text.dtype == np.int16 else np.unique(text)
    # The letter where a suffix is induced, else -1, which also stands left of the first place.
    due_under = np.append(np.where(induce, text, text.dtype.type(-1)), text.dtype.type(-1))
    borders = np.searchsorted(-seed_letters if descending else seed_letters, -letters if descending else letters)
    ends = np.searchsorted(-seed_letters if descending else seed_letters, -letters if descending else letters, side="right")

    def follow(begin: int, end: int) -> None:
        left = np.asarray(pos_out[begin:end]) - 1
        under = due_under[left]
        ok = np.flatnonzero(under >= 0)
        queue.push(under[ok], left[ok], (ok + begin).astype(place))

    if not descending:  # the end of the text is the smallest suffix of all; before it stands the last letter
        queue.push(text[-1:], np.array([len(text) - 1], place), np.array([-1], place))
    for k in range(len(letters) - 1, -1, -1) if descending else range(len(letters)):
        letter, first, rank_before = int(letters[k]), at, None
        while (due := queue.pop(letter)) is not None:
            pos, rank = due
            m = len(pos)
            lcp = np.ones(m, small)
            before = np.empty(m, place)
            before[0], before[1:] = -2 if rank_before is None else rank_before, rank[:-1]
            # The rest of the very last suffix is empty (rank -1) and shares nothing.
            some = np.flatnonzero((before >= 0) & (rank >= 0))
            if len(some):
                begin, end = before[some] + 1, rank[some] + 1
                low = int(begin[0])
                span = np.asarray(lcp_out[low : int(end[-1])])
                cuts = np.stack([begin - low, np.minimum(end - low, len(span) - 1)], 1).ravel()
                least = np.minimum.reduceat(span, cuts)[::2]
                tail = end - low == len(span)  # reduceat needs a start inside, so the last range is done apart
                if tail.any():
                    least[-1] = span[int(begin[-1]) - low :].min()
                lcp[some] += least
            if rank_before is None:
                lcp[0] = 0
            np.minimum(lcp, cap, out=lcp)
            pos_out[at : at + m], lcp_out[at : at + m], was_induced[at : at + m] = pos, lcp, True
            rank_before = int(rank[-1])
            at += m
            follow(at - m, at)
        a, b = int(borders[k]), int(ends[k])
        if b > a:
            m = b - a
            pos_out[at : at + m], lcp_out[at : at + m] = seeds[a:b], seed_lcp[a:b]
            lcp_out[at] = 0 if at == first else min(cap, run_lengths(text, int(pos_out[at - 1])), run_lengths(text, int(seeds[a])))
            at += m
            follow(at - m, at)
    queue.close()
    return pos_out[:at], lcp_out[:at], was_induced[:at]


def letter_words(text: np.ndarray, rise: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(words, width, bits): `width` letters of `bits` bits from each place on, and a word beyond the end.

    The lowest bit of a letter is its kind (whether the suffix rises there). A letter of zeros, which no
    text has, stands beyond the end.
    """
    kind = text * 2 + rise + text.dtype.type(2)
    if int(kind.max()) >= 1 << 10:
        return np.append(kind, 0).astype(np.uint64), 1, 63
    n, words = len(text), np.zeros(len(text) + 1, np.uint64)
    for at in range(0, n, BLOCK):
        one = np.zeros(min(BLOCK, n - at) + 5, np.uint64)
        part = kind[at : at + len(one)]
        one[: len(part)] = part
        two = one[:-1] << np.uint64(10) | one[1:]
        three = two[:-1] << np.uint64(10) | one[2:]
        words[at : at + len(one) - 5] = three[:-3] << np.uint64(30) | three[3:]
    return words, 6, 10


def _names(text: np.ndarray, seeds: np.ndarray, words: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Ranks of the seeds' stretches (both ends included), in text order; equal stretches share one.

    Letters carry their kind, as a stretch that ends is greater than one that falls there.
    """
    ends = np.append(seeds[1:], len(text) - 1)
    lengths = ends - seeds + 1
    rank, active, offset = np.zeros(len(seeds), np.int64), np.arange(len(seeds)), 0
    while len(active):
        beyond = (np.maximum(0, width - (lengths[active] - offset)) * bits).astype(np.uint64)  # bits after the stretch
        word = words[seeds[active] + offset] >> beyond << beyond
        order = np.lexsort((word, rank[active])) if offset else np.argsort(word)
        r, w = rank[active][order], word[order]
        new_group = np.append(True, r[1:] != r[:-1])
        change = new_group | np.append(True, w[1:] != w[:-1])
        # A group's ranks start at its old rank; a member's is that plus the members before its word.
        index = np.arange(len(order))
        group_start = np.maximum.accumulate(np.where(new_group, index, 0))
        word_start = np.maximum.accumulate(np.where(change, index, 0))
        rank[active[order]] = r + (word_start - group_start)
        same = ~change
        tied = same.copy()
        tied[:-1] |= same[1:]
        offset += width
        open_ends = active[order][tied]
        active = np.sort(open_ends[lengths[open_ends] > offset])
    return rank


def _doubling(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names, in memory, by doubling.

    A name is the number of smaller ones, so a group of equal names begins at its name's place and
    only members of such groups are sorted again.
    """
    n, step, rank = len(names), 1, names.astype(np.int64)
    active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(active):
        after = np.zeros(len(active), np.int64)
        inside = active + step < n
        after[inside] = rank[active[inside] + step] + 1
        key = rank[active] * (n + 1) + after
        order = np.argsort(key)
        key, who = key[order], active[order]
        old = rank[who]
        index = np.arange(len(who))
        new_group = np.append(True, old[1:] != old[:-1])
        change = np.append(True, key[1:] != key[:-1])
        group_start = np.maximum.accumulate(np.where(new_group, index, 0))
        rank[who] = old + np.maximum.accumulate(np.where(change, index, 0)) - group_start
        tied = ~change
        tied[:-1] |= ~change[1:]
        active = who[tied]
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def _common(words: np.ndarray, width: int, bits: int, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common-prefix lengths of pairs of different suffixes, at most `cap`."""
    last = len(words) - 1
    letters = np.uint64(sum(((1 << bits) - 2) << (bits * j) for j in range(width)))  # without their kinds
    out, active, k = np.zeros(len(a), np.int64), np.arange(len(a)), 0
    while len(active) and k < cap:
        x, y = a[active] + k, b[active] + k
        differ = (words[np.minimum(x, last)] ^ words[np.minimum(y, last)]) & letters
        stop = differ != 0
        ended, differ = active[stop], differ[stop]
        out[ended] = k
        for j in range(1, width):
            out[ended] += differ < np.uint64(1 << (bits * (width - j)))
        active = active[~stop]
        k += width
    out[active] = cap
    return np.minimum(out, cap)


def suffix_array(text: np.ndarray, cap: int = 1 << 30, in_memory: int = IN_MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes of `text` (non-negative integers) in order, and each one's
    common-prefix length with the one before, at most `cap` (0 for the first)."""
    text = np.asarray(text)
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = text.astype(np.int16 if text.max() < SMALL else np.int64)
    rise = rising(text)
    seeds = np.flatnonzero(rise[1:] & ~rise[:-1]) + 1
    if len(seeds):
        words, width, bits = letter_words(text, rise)
        names = _names(text, seeds, words, width, bits)
        if np.bincount(names).max() == 1:
            order = np.empty(len(names), np.int64)
            order[names] = np.arange(len(names))
        elif len(seeds) <= in_memory:
            order = _doubling(names)
        else:
            order, _ = suffix_array(np.unique(names, return_inverse=True)[1], 1, in_memory)
        seeds = seeds[order]
        seed_lcp = np.append(0, _common(words, width, bits, seeds[:-1], seeds[1:], cap))
        del words
    else:
        seed_lcp = np.zeros(0, np.int64)
    pos, lcp, induced = _sweep(text, seeds, seed_lcp, ~rise, cap, False, in_memory, n)
    # The falling suffixes are in place now and seed the sweep back, which induces the rising ones.
    at = np.flatnonzero(induced)[::-1]
    shared = np.append(lcp.dtype.type(0), lcp[at[:-1]])  # seen from the right, an entry's length is that of the one after it
    pos, lcp, _ = _sweep(text, np.asarray(pos[at]), shared, rise, cap, True, in_memory, n)
    return np.asarray(pos[::-1]), np.append(lcp.dtype.type(0), np.asarray(lcp[1:])[::-1])
