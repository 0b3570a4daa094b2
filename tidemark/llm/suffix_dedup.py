"""Removal of byte strings that repeat from an earlier document, by external induced suffix sorting.

Every string of `length` bytes that also starts in a document of a smaller id is removed, exactly
and across the whole corpus, although no task sees more than a shard:

1. Anchors. Among the grams inside any window of `length` bytes the one of the smallest hash is its
   anchor. Equal windows have the same anchor at the same place, so they meet under its hash. Tasks
   send the anchor hashes of a chunk of documents (a hash of the id) to buckets of the hash space;
   a bucket tells each chunk which of its anchors occur in another document too.
   An anchor in very many different segments would fill one shard. Its windows are asked about once
   more, one by one under a hash of their own bytes, and those in two documents are segments of one
   window each, which go to shards by that hash.
2. Shards. A chunk sends the segment of each shared anchor (the stretch of all windows it stands
   for), once per distinct segment with its smallest id, to the shard of the anchor. The shard sorts
   the suffixes of its segments by induced sorting with common prefixes (induced_sorting, with its
   queues on disk beyond a bound); suffixes whose common prefix reaches `length` form a run, and
   the smallest id of a run is what each of its windows gets. The shard answers the chunks.
3. Texts. A chunk marks the windows whose smallest id is below the document's own, and cuts.

Windows without a shared anchor are in one document only and need no sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import written
from tidemark.llm.induced_sorting import IN_MEMORY, suffix_array
from tidemark.llm.packing import by_chunk, edges, pack, pack_numbers, unpack, unpack_numbers
from tidemark.llm.shingles import mix

LENGTH, GRAM = 50, 16
CHUNK_BYTES = 8 << 20
PIECE_BYTES = 1 << 17  # the hashes of a piece fit a core's cache
BUCKET_ANCHORS = 400_000
SHARD_BYTES = 4 << 20
FLUSH_BYTES = 24 << 20
SLICE = 1 << 14  # segments that are copied or compared at once
SPREAD = 64  # of 256 marks: an anchor whose segments have more is in many different ones
MAX_BUCKETS = 1 << 16
PLACE_BITS = np.uint64(24)
FILTER_BITS = 20


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the `gram` bytes from each place on; `gram` is a power of two."""
    h, n = mix(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED))[raw], 1
    while n < gram:
        left = h[:-n] * np.uint64(0x9E3779B97F4A7C15)
        left += h[n:]
        h = left
        h ^= h >> np.uint64(29)
        n *= 2
    return mix(h)


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every `width` neighbours."""
    n, out = 1, x
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    rest = width - n
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(h: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of each anchor, for texts joined with gram hashes `h`.

    `starts` has where each text begins, and the total length last. Windows lie within one text.
    """
    if starts[-1] < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    ranked = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
    at = (_lowest(ranked, length - gram + 1) & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    whole = np.ones(len(at), bool)
    for begin in starts[1:-1]:
        whole[max(0, begin - length + 1) : begin] = False
    window = np.flatnonzero(whole)
    at = at[window]
    new = np.append(True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(at) else first
    return h[at[first]], window[first], window[last]


def window_hashes(h: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Hash of all `length` bytes from each of the places `at` on, from the gram hashes."""
    out = np.full(len(at), 0xA5, np.uint64)
    for step in [*range(0, length - gram, gram), length - gram]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[at + step])
    return out


NONE_HOT = np.zeros(0, np.uint64)


class Joined:
    """Texts of a few documents as one run of bytes, with their anchors.

    Each window of an anchor in `hot` (ascending) stands alone, under the hash of its bytes.
    """

    def __init__(self, ids: list[int], texts: list[bytes], length: int, hot: np.ndarray = NONE_HOT):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.raw, self.ids, self.length = np.frombuffer(b"".join(texts), np.uint8), np.array(ids, np.int64), length
        self.grams = gram_hashes(self.raw)
        least, self.first, self.last = anchors(self.grams, self.starts, length)
        self.hash = mix(least)  # minima are small numbers and would come to few buckets
        self.single = np.zeros(len(self.hash), bool)
        if len(hot) and len(self.hash):
            cut = hot[np.minimum(np.searchsorted(hot, self.hash), len(hot) - 1)] == self.hash
            n = np.where(cut, self.last - self.first + 1, 1)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            self.single = np.repeat(cut, n)
            self.first = np.repeat(self.first, n) + step
            self.last = np.where(self.single, self.first, np.repeat(self.last, n))
            self.hash = np.repeat(self.hash, n)
            self.hash[self.single] = window_hashes(self.grams, self.first[self.single], length)
        self.owner = np.repeat(np.arange(len(sizes)), np.diff(np.searchsorted(self.first, self.starts)))

    def marks(self) -> np.ndarray:
        """8 bits of a hash of each segment; its first and last window cover it."""
        ends = [window_hashes(self.grams, at, self.length) for at in (self.first, self.last)]
        return (mix(ends[0] * np.uint64(3) + ends[1]) >> np.uint64(56)).astype(np.uint8)


def joined(ids: list[int], texts: list[str | None], length: int, hot: np.ndarray = NONE_HOT) -> Iterator[Joined]:
    """Documents in groups of about PIECE_BYTES; places must fit PLACE_BITS, so a longer text is
    cut into overlapping pieces, in which every window is whole once."""
    held_ids, held, size = [], [], 0
    most = 1 << (int(PLACE_BITS) - 1)
    for i, text in zip(ids, texts):
        body = text.encode("utf-8", "surrogatepass") if text else b""
        for at in range(0, max(1, len(body)), most - length):
            if at and at + length > len(body):
                break
            held_ids.append(i)
            held.append(body[at : at + most])
            size += len(held[-1])
            if size >= PIECE_BYTES:
                yield Joined(held_ids, held, length, hot)
                held_ids, held, size = [], [], 0
    if held:
        yield Joined(held_ids, held, length, hot)


def asked(docs: DataFrame, buckets: int, length: int, hot: np.ndarray = NONE_HOT) -> DataFrame:
    """Rows (bucket, chunks, keys, times, marks): the anchor hashes that a task met, ascending, each beside its chunk;
    twice how often it occurs again in the chunk, plus 1 if that is in two of its documents; and the mark of one of
    its segments. One row holds all chunks of a flush, so rows do not grow with chunks times buckets.

    With `hot`, only the single windows of these anchors.
    """

    def flush(held: list[tuple]) -> Iterator[pd.DataFrame]:
        if not held:
            return
        keys, docs_of, chunks, marks = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(keys)
        again = keys[order[1:]] == keys[order[:-1]]
        tied = np.flatnonzero(np.append(again, False) | np.append(False, again)) if len(keys) else order
        own = order[tied]
        order[tied] = own[np.lexsort((own, docs_of[own], chunks[own], keys[own]))]
        keys, docs_of, chunks = keys[order], docs_of[order], chunks[order]
        first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1]))) if len(keys) else order
        last = np.append(first[1:], len(keys)) - 1 if len(keys) else first
        times = (2 * (last - first) + (docs_of[first] != docs_of[last])).astype(np.uint64)
        keys, chunks, marks = keys[first], chunks[first], marks[order[first]]
        at = edges(keys, buckets, 64)
        rows = [
            (int(b), pack_numbers(chunks[s]), pack(keys[s]), pack_numbers(times[s]), marks[s].tobytes())
            for b in np.flatnonzero(np.diff(at))
            for s in [slice(at[b], at[b + 1])]
        ]
        if rows:
            yield pd.DataFrame(rows, columns=["bucket", "chunks", "keys", "times", "marks"])

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, chunks = batch["id"].to_numpy(np.int64), batch["chunk"].to_numpy(np.int32)
            for part in joined(list(range(len(batch))), batch["text"].tolist(), length, hot):
                own = np.flatnonzero(part.single) if len(hot) else slice(None)
                doc = part.ids[part.owner[own]]
                held.append((part.hash[own], ids[doc], chunks[doc], np.zeros(len(doc), np.uint8) if len(hot) else part.marks()))
                size += len(part.raw)
                if size >= FLUSH_BYTES:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)

    return docs.mapInPandas(met, "bucket long, chunks binary, keys binary, times binary, marks binary")


def shared_anchors(asked_rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows (chunk, bucket, keys, n): the anchors of a chunk that are in two documents or more.

    Anchors that occur more than `most` times, in many different segments, are told apart under
    chunk -1, with the sum of their occurrences as `n` (else 0).
    """

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = rows["bucket"].iloc[0]
        keys, place = np.unique(np.concatenate([unpack(k) for k in rows["keys"]]), return_inverse=True)
        chunks = np.concatenate([unpack_numbers(c) for c in rows["chunks"]]).astype(np.int64)
        # An anchor is shared if two rows have it, or two chunks of one, or one says so. Two entries of one chunk can be
        # one document; such an anchor is sent to its shard for nothing, which decides by ids.
        times = np.concatenate([unpack_numbers(t) for t in rows["times"]]).astype(np.int64)
        shared = np.bincount(place, 1 + times % 2, len(keys)) > 1
        out = []
        if most is not None:
            times = times // 2 + 1
            total = np.bincount(place, times, len(keys))
            hot = shared & (total > most)
            if hot.any():
                # Copies of one segment come to one mark; many within one entry count as different.
                own = hot[place]
                marks = np.frombuffer(b"".join(rows["marks"]), np.uint8)[own]
                spread = np.bincount(np.unique(place[own] * 256 + marks) // 256, minlength=len(keys))
                np.maximum.at(spread, place[own], times[own])
                hot &= spread > SPREAD
            if hot.any():
                shared &= ~hot
                out.append((-1, bucket, pack(keys[hot]), int(total[hot].sum())))
        own = shared[place]
        out += [(chunk, bucket, pack(keys[places]), 0) for chunk, places in by_chunk(chunks[own], place[own], len(keys))]
        return pd.DataFrame(out, columns=["chunk", "bucket", "keys", "n"])

    return asked_rows.groupBy("bucket").applyInPandas(told, "chunk long, bucket long, keys binary, n long")


def shared_keys(docs: DataFrame, size: int, length: int) -> tuple[DataFrame, np.ndarray]:
    """Rows (chunk, bucket, keys) of what each chunk has to send, and the anchors cut into single windows.

    These anchors are known to every task: at most one in `most` occurrences of anchors.
    """
    most = max(1, SHARD_BYTES // (2 * length))
    buckets = int(min(MAX_BUCKETS, max(1, size // 18 // BUCKET_ANCHORS)))
    shared = written(shared_anchors(asked(docs, buckets, length), most), "anchors")
    apart = shared.where("chunk = -1").select("keys", "n").collect()
    shared = shared.where("chunk >= 0").select("chunk", "bucket", "keys")
    if not apart:
        return shared, NONE_HOT
    hot = np.sort(np.concatenate([unpack(bytes(r["keys"])) for r in apart]))
    buckets = int(min(MAX_BUCKETS, max(1, sum(r["n"] for r in apart) * 18 // BUCKET_ANCHORS)))
    windows = written(shared_anchors(asked(docs, buckets, length, hot)), "windows")
    return shared.union(windows.select("chunk", "bucket", "keys")), hot


def stretches(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the stretches of `size` bytes from `first` on, one after another."""
    out = [np.zeros(0, np.uint8)]
    for at in range(0, len(first), SLICE):
        n = size[at : at + SLICE]
        out.append(raw[np.repeat(first[at : at + SLICE] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
    return np.concatenate(out)


class Segments:
    """The distinct segments of a chunk's shared anchors, by shard, in an order that can be made again.

    They are told apart by hashes of their first and last window, which cover them, and compared byte by
    byte where these are equal. `first` and `size` are stretches of `raw`; `least` is the smallest id;
    `by_shard` has the range of each shard. `occurs` has, per part of the chunk, the segment of each
    shared anchor (or -1).
    """

    def __init__(self, ids: list[int], texts: list[str | None], shared: np.ndarray, shards: int, length: int, hot: np.ndarray = NONE_HOT):
        self.parts, self.occurs = list(joined(ids, texts, length, hot)), []
        found, base = [tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64))], 0
        chosen_of = []
        # The low bits of a hash tell of most anchors that they are not shared.
        low = np.uint64((1 << FILTER_BITS) - 1)
        maybe = np.zeros(1 << FILTER_BITS, bool)
        maybe[(shared & low).view(np.int64)] = True
        for part in self.parts:
            chosen = np.flatnonzero(maybe[(part.hash & low).view(np.int64)])
            place = np.searchsorted(shared, part.hash[chosen])
            place[place == len(shared)] = 0
            chosen = chosen[shared[place] == part.hash[chosen]]
            first, last = part.first[chosen], part.last[chosen]
            ends = (window_hashes(part.grams, at, length) for at in (first, last))
            found.append((first + base, last - first + length, part.ids[part.owner[chosen]], part.hash[chosen] % np.uint64(shards), *ends))
            chosen_of.append(chosen)
            base += len(part.raw)
        first, size, doc, shard, *ends = (np.concatenate(x) for x in zip(*found))
        self.raw = np.concatenate([np.zeros(0, np.uint8), *(part.raw for part in self.parts)])
        order, new = self._sorted(shard, size, *ends)
        if not self._equal(first[order], size[order], new):
            # Different segments under equal hashes: their bytes tell them apart.
            whole = np.empty(len(first), object)
            whole[:] = [self.raw[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist())]
            order, new = self._sorted(shard, size, np.unique(whole, return_inverse=True)[1], np.zeros(len(first)))
        heads = np.flatnonzero(new)
        kept = order[heads]
        self.first, self.size = first[kept], size[kept]
        self.least = np.minimum.reduceat(doc[order], heads) if len(heads) else doc
        at = np.append(np.flatnonzero(np.append(True, shard[kept][1:] != shard[kept][:-1])), len(kept)) if len(kept) else []
        self.by_shard = {int(shard[kept[a]]): (a, b) for a, b in zip(at[:-1], at[1:])}
        segment = np.empty(len(order), np.int64)
        segment[order] = np.cumsum(new) - 1
        for part, chosen in zip(self.parts, chosen_of):
            occurs = np.full(len(part.hash), -1, np.int64)
            occurs[chosen], segment = segment[: len(chosen)], segment[len(chosen) :]
            self.occurs.append(occurs)

    @staticmethod
    def _sorted(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order by `keys`, and where it comes to a new one."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for key in keys:
            key = key[order]
            new[1:] |= key[1:] != key[:-1]
        return order, new

    def _equal(self, first: np.ndarray, size: np.ndarray, new: np.ndarray) -> bool:
        """Whether the stretches have the bytes of the last new one up to them."""
        again = np.flatnonzero(~new)
        head = first[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))][again]
        for at in range(0, len(again), SLICE):
            own, n = again[at : at + SLICE], size[again[at : at + SLICE]]
            if not np.array_equal(stretches(self.raw, first[own], n), stretches(self.raw, head[at : at + SLICE], n)):
                return False
        return True


def sent(docs: DataFrame, shared: DataFrame, shards: int, length: int, hot: np.ndarray = NONE_HOT) -> DataFrame:
    """Rows (shard, chunk, body, sizes, least): the distinct segments of each chunk, one after another."""

    def cut(texts: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame(columns=["shard", "chunk", "body", "sizes", "least"])
        own = Segments(texts["id"].tolist(), texts["text"].tolist(), _keys(keys), shards, length, hot)
        chunk = texts["chunk"].iloc[0]
        rows = [
            (shard, chunk, stretches(own.raw, own.first[a:b], own.size[a:b]).tobytes(), pack_numbers(own.size[a:b]), own.least[a:b].tobytes())
            for shard, (a, b) in own.by_shard.items()
        ]
        return pd.DataFrame(rows, columns=["shard", "chunk", "body", "sizes", "least"])

    kind = "shard long, chunk long, body binary, sizes binary, least binary"
    return docs.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(cut, kind)


def _keys(rows: pd.DataFrame) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *map(unpack, rows["keys"])]))


def sorted_shards(rows: DataFrame, length: int, in_memory: int) -> DataFrame:
    """Rows (chunk, shard, runs, ids): for each window of the chunk's segments, one after another, the
    smallest id that has the same window, as lengths of equal stretches and their values."""

    def decided(group: pd.DataFrame) -> pd.DataFrame:
        shard = group["shard"].iloc[0]
        bodies = group["body"].tolist()
        sizes = [unpack_numbers(s).astype(np.int64) for s in group["sizes"]]
        least = np.concatenate([np.frombuffer(x, np.int64) for x in group["least"]])
        ends, flat = np.cumsum(np.concatenate(sizes)), np.frombuffer(b"".join(bodies), np.uint8)
        # Equal segments of several chunks are sorted once, under the smallest of their ids.
        whole, begins = flat.tobytes(), ends - np.concatenate(sizes)
        known: dict[bytes, int] = {}
        place = np.array([known.setdefault(whole[a:b], len(known)) for a, b in zip(begins.tolist(), ends.tolist())], np.int64)
        owner = np.full(len(known), np.iinfo(np.int64).max)
        np.minimum.at(owner, place, least)
        lengths = np.array([len(s) for s in known], np.int64)
        text = np.frombuffer(b"\0".join([*known, b""]), np.uint8).astype(np.int16) + np.int16(1)
        text[np.cumsum(lengths + 1) - 1] = 0  # ends each segment
        found = np.repeat(owner, lengths + 1)
        order, lcp = suffix_array(text, length, in_memory)
        # Most runs are of one suffix, which keeps its own id.
        again = lcp >= length
        several = again.copy()
        several[:-1] |= again[1:]
        members, first = order[several], np.flatnonzero(~again[several])
        if len(first):
            lowest = np.minimum.reduceat(found[members], first)
            found[members] = np.repeat(lowest, np.diff(np.append(first, len(members))))
        # A run's windows lie inside segments: no other suffix shares `length` letters with one that
        # reaches an end before.
        base = np.append(0, np.cumsum(lengths + 1))[:-1]
        out, at = [], 0
        for chunk, mine in zip(group["chunk"].tolist(), sizes):
            own = place[at : at + len(mine)]
            at += len(mine)
            n = lengths[own] - length + 1
            shift = np.repeat(base[own] - (np.cumsum(n) - n), n)
            values = found[np.arange(int(n.sum())) + shift]
            turn = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            runs = np.diff(np.append(turn, len(values))).astype(np.uint64)
            out.append((chunk, shard, pack_numbers(runs), pack_numbers(values[turn].view(np.uint64))))
        return pd.DataFrame(out, columns=["chunk", "shard", "runs", "ids"])

    return rows.groupBy("shard").applyInPandas(decided, "chunk long, shard long, runs binary, ids binary")


def cut_spans(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for a, b in spans:
        kept.append(body[at:a])
        at = b
    return b"".join([*kept, body[at:]])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, in_memory: int = IN_MEMORY) -> DataFrame:
    """Rows (key, n_bytes, spans, kept): the removed byte ranges [from, to), ascending and not touching,
    and the bytes that stay, one row per row of `docs`.

    Texts are UTF-8 bytes; null and empty texts have none. A text shorter than `length` has no window
    and stays. Ids are compared as numbers. Rows of one id are one document: they remove nothing from
    each other, though each loses what an earlier id has. A row without id stays whole and removes
    nothing. An empty table gives an empty result. Only the two columns asked for are read, so
    others cannot clash. `in_memory` bounds the sorting queues (entries) before they go to disk.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    named = rows.where("id is not null")
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    named = named.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-size // CHUNK_BYTES)))))
    shards = int(min(MAX_BUCKETS, max(1, size // SHARD_BYTES)))
    shared, hot = shared_keys(named, size, length)
    found = written(sorted_shards(sent(named, shared, shards, length, hot), length, in_memory), "runs")

    def finished(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(texts):
            return pd.DataFrame(columns=["id", "n_bytes", "spans", "kept"])
        told = answers["runs"].isna()
        own = Segments(texts["id"].tolist(), texts["text"].tolist(), _keys(answers[told]), shards, length, hot)
        values = {}
        for shard, runs, ids in answers.loc[~told, ["part", "runs", "ids"]].itertuples(index=False):
            values[shard] = np.repeat(unpack_numbers(ids).view(np.int64), unpack_numbers(runs).astype(np.int64))
        windows = own.size - length + 1
        begin, flat = np.cumsum(windows) - windows, [np.zeros(0, np.int64)]
        for shard, (a, b) in own.by_shard.items():
            flat.append(values[shard])
            if len(values[shard]) != windows[a:b].sum():
                raise ValueError("the input changed between two readings")
        flat = np.concatenate(flat)
        marks: dict[int, list[np.ndarray]] = {}
        # Pieces of one text come one after another; `row` counts the texts.
        pieces = _pieces(texts, length)
        for part, occurs in zip(own.parts, own.occurs):
            base = [next(pieces) for _ in range(len(part.ids))]
            chosen = np.flatnonzero(occurs >= 0)
            n = part.last[chosen] - part.first[chosen] + 1
            steps = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            window = np.repeat(part.first[chosen], n) + steps
            owner = np.repeat(part.owner[chosen], n)
            gone = flat[np.repeat(begin[occurs[chosen]], n) + steps] < part.ids[owner]
            window, owner = window[gone], owner[gone]
            # Anchors stand in the order of the texts, so each text's windows are in one stretch.
            turn = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
            for k, own_windows in zip(owner[turn].tolist(), np.split(window, turn[1:])):
                row, start = base[k]
                marks.setdefault(row, []).append(own_windows - part.starts[k] + start)
        out = []
        for row, (i, body) in enumerate(zip(texts["id"].tolist(), texts["text"].tolist())):
            body = body.encode("utf-8", "surrogatepass") if body else b""
            spans = []
            if row in marks:
                w = np.unique(np.concatenate(marks[row]))
                new = np.append(True, w[1:] > w[:-1] + length)
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(w)) - 1
                spans = list(zip(w[first].tolist(), (w[last] + length).tolist()))
            out.append((i, len(body), [{"from": a, "to": b} for a, b in spans], cut_spans(body, spans)))
        return pd.DataFrame(out, columns=["id", "n_bytes", "spans", "kept"])

    answers = shared.select("chunk", F.col("bucket").alias("part"), "keys", F.lit(None).cast("binary").alias("runs"), F.lit(None).cast("binary").alias("ids")).union(
        found.select("chunk", F.col("shard").alias("part"), F.lit(None).cast("binary").alias("keys"), "runs", "ids")
    )
    kind = "id long, n_bytes long, spans array<struct<from: long, to: long>>, kept binary"
    done = named.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finished, kind)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    spared = rows.where("id is null").select("id", F.octet_length(body).cast("long").alias("n_bytes"), F.array().cast("array<struct<from: bigint, to: bigint>>").alias("spans"), body.alias("kept"))
    return done.unionByName(spared).withColumnRenamed("id", key)


def _pieces(texts: pd.DataFrame, length: int) -> Iterator[tuple[int, int]]:
    """(row, first byte) of every piece that `joined` makes of these texts."""
    most = 1 << (int(PLACE_BITS) - 1)
    for row, text in enumerate(texts["text"].tolist()):
        n = len(text.encode("utf-8", "surrogatepass")) if text else 0
        for at in range(0, max(1, n), most - length):
            if at and at + length > n:
                break
            yield row, at
