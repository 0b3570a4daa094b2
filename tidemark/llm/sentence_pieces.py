"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

The words of a batch (a run of space marks and what follows it) are made distinct and sorted by
length; words of equal length advance together. All substrings up to the longest piece are hashed
at once, those that a table of the hashes' top bits lets through are looked up among the sorted
hashes of the pieces and verified letter by letter; then every end position takes the best of its pieces with one vectorised maximum, which stores the
backpointer. Characters without a piece become byte pieces.

The segmentation is the one with the greatest sum of piece scores. Models of the unigram kind
bring log-probabilities; models of the merge kind bring ranks only, which are read as a Zipf law,
-log(rank + 2.7). Either way the ids are the model's own and the model's library decodes them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shingles import chunks
from tidemark.llm.textcols import free_name

SPACE_MARK = "▁"
REMEMBERED_WORDS = 300_000
CELLS_AT_ONCE = 1 << 19
SLICE_CHARS = 1 << 20
KNOWN_CHARS = 64
FILTER_BITS = 20
MARKED_WORDS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+")
PRIME = np.uint64(0x9E3779B97F4A7C15)
BYTE_SCORE, ABSENT = -1e4, -1e30


class Pieces:
    """The pieces of a model, ready for lookup by hash."""

    def __init__(self, model_file: str, remembered: int = REMEMBERED_WORDS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        kept = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
        self.unknown = sp.unk_id()
        self.names = names
        self.hidden = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i)}
        self.bytes_of = {int(i): b for b, i in enumerate(self.byte_ids) if i != self.unknown}
        # Pieces that decode to their names.
        self.plain = np.array([i not in self.hidden and i not in self.bytes_of for i in range(size)])
        self.prefixed = sp.encode("x", out_type=str)[0].startswith(SPACE_MARK)
        score = np.array([sp.get_score(i) for i in kept])
        if (score <= -1).mean() > 0.9 and len(np.unique(np.diff(np.sort(score)[1000:2000]))) == 1:  # ranks
            order = np.argsort(np.argsort(-score, kind="stable"), kind="stable")
            score = -np.log(order + 2.7)
        texts = [names[i] for i in kept]
        self.longest = max(map(len, texts))
        # A piece with a space mark after another letter would cross the border of a word.
        self.by_word = all(SPACE_MARK not in t.lstrip(SPACE_MARK) for t in texts)
        letters = np.zeros((len(kept), self.longest), np.uint32)
        for k, t in enumerate(texts):
            letters[k, : len(t)] = [ord(c) for c in t]
        lengths = np.array([len(t) for t in texts])
        hashes = np.zeros(len(kept), np.uint64)
        for j in range(self.longest):
            live = lengths > j
            hashes[live] = hashes[live] * PRIME + letters[live, j].astype(np.uint64) + np.uint64(1)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.letters, self.lengths = hashes[order], letters[order], lengths[order]
        self.scores, self.ids = score[order], np.array(kept, np.int32)[order]
        if len(np.unique(self.hashes)) != len(self.hashes):
            raise ValueError("two pieces share a hash; take another PRIME")
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self._slots(self.hashes)] = True
        self.remembered, self.known = remembered, {}

    @staticmethod
    def _slots(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FILTER_BITS)).view(np.int64)

    # -- words ---------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """Marked words: a run of marks and the letters after it. Their concatenation is the text."""
        marked = text.replace(" ", SPACE_MARK)
        if self.prefixed:
            marked = SPACE_MARK + marked
        if not self.by_word:
            return [marked]
        if marked.startswith(SPACE_MARK) and SPACE_MARK * 2 not in marked:
            return [SPACE_MARK + part for part in marked[1:].split(SPACE_MARK)]
        return MARKED_WORDS.findall(marked)

    def best(self, words: list[str]) -> list[bytes]:
        """Ids of the best segmentation of each word, 4 bytes each."""
        found = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if w:
                by_length.setdefault(len(w), []).append(k)
        for n, places in by_length.items():
            at_once = max(1, CELLS_AT_ONCE // (n * self.longest))
            for at in range(0, len(places), at_once):
                part = places[at : at + at_once]
                raw = "".join([words[k] for k in part]).encode("utf-32-le", "surrogatepass")
                letters = np.frombuffer(raw, "<u4").reshape(len(part), n)
                for k, ids in zip(part, self._viterbi(letters)):
                    found[k] = ids
        return found

    def _viterbi(self, letters: np.ndarray) -> list[np.ndarray]:
        rows, n = letters.shape
        longest = min(self.longest, n)
        # which[r, e, l]: the place among the pieces of the substring of l + 1 letters that ends at e, or -1;
        # gain: its score
        which = np.full((rows, n, longest), -1, np.int32)
        gain = np.full((rows, n, longest), ABSENT)
        h, wide = np.zeros((rows, n), np.uint64), letters.astype(np.uint64) + np.uint64(1)
        for l in range(longest):
            # Hash of the l + 1 letters from each start, grown by one letter per round.
            h = h[:, : n - l] * PRIME
            h += wide[:, l:]
            r, start = np.nonzero(self.maybe[self._slots(h)])
            own = h[r, start]
            at = np.searchsorted(self.hashes, own)
            at[at == len(self.hashes)] = 0
            hit = (self.hashes[at] == own) & (self.lengths[at] == l + 1)
            r, start, piece = r[hit], start[hit], at[hit]
            same = np.ones(len(r), bool)
            for j in range(l + 1):
                same &= self.letters[piece, j] == letters[r, start + j]
            r, end, piece = r[same], start[same] + l, piece[same]
            which[r, end, l], gain[r, end, l] = piece, self.scores[piece]
        gain[:, :, 0][which[:, :, 0] < 0] = BYTE_SCORE
        total = np.full((rows, n + 1), ABSENT)
        total[:, 0] = 0
        back = np.zeros((rows, n + 1), np.int32)
        line = np.arange(rows)
        for e in range(1, n + 1):
            m = min(longest, e)
            # before[:, l]: the best sum before a piece of l + 1 letters that ends here
            options = total[:, e - m : e][:, ::-1] + gain[:, e - 1, :m]
            pick = options.argmax(1)
            total[:, e] = options[line, pick]
            back[:, e] = pick + 1
        return self._traced(letters, which, back)

    def _traced(self, letters: np.ndarray, which: np.ndarray, back: np.ndarray) -> list[bytes]:
        """Ids along the backpointers, last first, for all rows together; letters without a piece give their bytes."""
        rows, n = letters.shape
        # Each row is filled from its end; `at` is where it begins.
        width = 4 * n
        end, out, at = np.full(rows, n), np.zeros((rows, width), np.int32), np.full(rows, width)
        while len(live := np.flatnonzero(end)):
            e = end[live]
            step = back[live, e]
            piece = which[live, e - 1, step - 1]
            known = piece >= 0
            k = live[known]
            at[k] -= 1
            out[k, at[k]] = self.ids[piece[known]]
            for r in live[~known].tolist():
                raw = chr(letters[r, end[r] - 1]).encode("utf-8", "surrogatepass")
                out[r, at[r] - len(raw) : at[r]] = self.byte_ids[list(raw)]
                at[r] -= len(raw)
            end[live] = e - step
        raw, stops = out.tobytes(), range(4 * width, 4 * width * rows + 1, 4 * width)
        return [raw[stop - 4 * c : stop] for stop, c in zip(stops, (width - at).tolist())]

    # -- texts ---------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids per text; null for null, none for the empty text. Texts go in slices of bounded size."""
        out: list[np.ndarray | None] = []
        for part in chunks(texts, SLICE_CHARS):
            out.extend(self._encode(texts[part]))
        return out

    def _encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        split = [None if t is None else self.words(t) if t else [] for t in texts]
        known = self.known
        new = list(set(chain.from_iterable(filter(None, split))).difference(known))
        known.update(zip(new, self.best(new)))
        encoded = [None if ws is None else np.frombuffer(b"".join(map(known.__getitem__, ws)), np.int32) for ws in split]
        if len(known) > self.remembered:
            self.known = known = {w: known[w] for w in new} if len(new) <= self.remembered else {}
        for w in new:
            if len(w) > KNOWN_CHARS:
                known.pop(w, None)
        return encoded

    def decode(self, ids: np.ndarray | list[int] | None) -> str | None:
        """The text of `ids`: pieces joined, byte pieces read as UTF-8, marks turned into spaces."""
        if ids is None:
            return None
        ids = np.asarray(ids, np.int64)
        odd, names = np.flatnonzero(~self.plain[ids]).tolist(), [self.names[i] for i in ids.tolist()]
        parts, run, at = [], bytearray(), 0
        for k in [*odd, len(names)]:
            byte = self.bytes_of.get(int(ids[k])) if k < len(names) else None
            if run and (k > at or byte is None):
                parts.append(run.decode("utf-8", "replace"))
                run = bytearray()
            parts.extend(names[at:k])
            if byte is not None:
                run.append(byte)
            at = k + 1
        marked = "".join(parts)
        if self.prefixed and marked.startswith(SPACE_MARK):
            marked = marked[1:]
        return marked.replace(SPACE_MARK, " ")


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    return Pieces(model_file)


def _place(file: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


def encode(docs: DataFrame, file: str, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with the ids of each text as array<int>; nulls stay null, the empty text has no ids.

    `file` is the name of a public model file, found by each worker on its own disk. Rows are judged
    one by one, so repeated rows come out repeated; an empty table gives an empty result. A column
    of `docs` called `into` gives way to the new one. A text that holds the space mark itself is
    decoded with spaces in its place; `round_trip` tells.
    """

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pieces(_place(file))
        for texts in batches:
            yield pd.Series(own.encode(texts.tolist()), dtype=object)

    return docs.drop(into).withColumn(into, ids(F.col(f"`{text}`").cast("string")))


def decode(docs: DataFrame, file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`docs` with the text of each array of ids; a null array gives null."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pieces(_place(file))
        for arrays in batches:
            yield pd.Series([own.decode(a) for a in arrays], dtype=object)

    return docs.drop(into).withColumn(into, texts(F.col(f"`{ids}`")))


def encoded(docs: DataFrame, file: str, text: str = "text") -> DataFrame:
    """`docs` with ids, n_tokens and round_trip (decoding gives the text back; null for null texts).

    Both ways run in one function, so a task keeps one Python worker and its memory.
    """
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])

    @F.pandas_udf(kind)
    def both_ways(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = pieces(_place(file))
        for texts in batches:
            values = texts.tolist()
            for part in chunks(values, SLICE_CHARS):
                ids = own.encode(values[part])
                same = [None if t is None else own.decode(i) == t for t, i in zip(values[part], ids)]
                yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "round_trip": pd.Series(same, dtype=object)})

    both = free_name(docs, "both_ways")
    out = docs.drop("ids", "n_tokens", "round_trip").withColumn(both, both_ways(F.col(f"`{text}`").cast("string")))
    return out.withColumns(
        {
            "ids": F.col(both)["ids"],
            "n_tokens": F.coalesce(F.size(F.col(both)["ids"]), F.lit(0)).cast("long"),
            "round_trip": F.col(both)["round_trip"],
        }
    ).drop(both)
