"""Token counts of texts under a byte-level BPE with word ends, by the whole-token shortcut.

Once per process it is proved which vocabulary strings come out of the merges as one token when
they are a whole word. A word of a text that is one of those counts 1 by a table lookup; only the
others are merged, pair by pair, in the order of the vocabulary's merges. Texts go through the
workers in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

REMEMBERED_WORDS = 500_000
SHORT_WORD, NEVER = 40, 1 << 40
UNSURE = regex.compile("[\U00030000-\U0010FFFF]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordCounter(dict):
    """word -> number of tokens. Known one-token words are entries; others are merged on first use.

    The words learned on the way are forgotten when there are `remembered` of them, so memory is
    bounded; the proved ones stay.
    """

    def __init__(self, spec: dict, remembered: int = REMEMBERED_WORDS):
        model = spec["model"]
        self.letters, self.end = byte_letters(), model["end_of_word_suffix"]
        self.vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: k for k, pair in enumerate(pairs)}
        self.remembered, self.proved = remembered, {}
        back = {v: k for k, v in self.letters.items()}
        for piece in self.vocab:
            if not piece.endswith(self.end) or any(c not in back for c in piece[: -len(self.end)]):
                continue
            try:
                word = bytes(back[c] for c in piece[: -len(self.end)]).decode()
            except UnicodeDecodeError:
                continue
            if word and len(self.merge(word)) == 1:
                self.proved[word] = 1
        self.update(self.proved)

    def merge(self, word: str) -> list[str]:
        """Tokens of one word: always the pair of lowest rank, leftmost first."""
        parts = [self.letters[b] for b in word.encode()]
        if not parts:
            return []
        parts[-1] += self.end
        return self.merge_short(parts) if len(parts) <= SHORT_WORD else self.merge_long(parts)

    def merge_short(self, parts: list[str]) -> list[str]:
        rank = self.rank.get
        ranks = [rank(pair, NEVER) for pair in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) < NEVER:
            i = ranks.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NEVER)
        return parts

    def merge_long(self, parts: list[str]) -> list[str]:
        """Neighbours in a linked list and pairs in a heap: n log n for a word of n bytes."""
        n = len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, *pair) for i, pair in enumerate(zip(parts, parts[1:])) if (r := self.rank.get(pair)) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = right[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x in (left[i], i):
                if x >= 0 and right[x] >= 0 and (r := self.rank.get((parts[x], parts[right[x]]))) is not None:
                    heappush(heap, (r, x, parts[x], parts[right[x]]))
        return [p for p in parts if p is not None]

    def __missing__(self, word: str) -> int:
        n = len(self.merge(word))
        if len(self) - len(self.proved) >= self.remembered:
            self.clear()
            self.update(self.proved)
        self[word] = n
        return n


class TokenCounter:
    """Counts as the tokenizer file at `path` gives them, without added or special tokens.

    Special strings inside a text are one token each, as the library's default has it; the text
    between them is normalised (composed, white space to one space, lower case) and cut into words.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path} is not a word BPE with composing, lower-casing normalisation")
        # The library's own normaliser and word pattern, so that both follow the same Unicode tables.
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.library_cut = Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.words = WordCounter(spec)
        self.split = regex.compile(pattern)
        marks = [regex.escape(t["content"]) for t in spec["added_tokens"]]
        self.marks = regex.compile("|".join(sorted(marks, key=len, reverse=True))) if marks else None

    def cut(self, text: str) -> list[str]:
        """The words of a text, normalised."""
        try:
            text.encode("latin-1")  # composed already, and lower case there is the same everywhere
        except UnicodeEncodeError:
            text = self.normalise(text)
            if UNSURE.search(text):  # far planes, where the two pattern libraries know other letters
                return [w for w, _ in self.library_cut(text)]
            return self.split.findall(text)
        return self.split.findall(text.lower())

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        parts = self.marks.split(text) if self.marks else [text]
        return len(parts) - 1 + sum(sum(map(self.words.__getitem__, self.cut(p))) for p in parts if p)


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, file: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit (more than `limit` tokens).

    `file` is the name of a public tokenizer file, found by each worker on its own disk. Nulls and
    empty texts have 0 bytes and 0 tokens. Rows are judged one by one, so repeated rows come out
    repeated; an empty table gives an empty result. Columns of `docs` with the new names give way.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import public_tokenizers

        count = counter(public_tokenizers.path(file)).count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    counted = docs.drop("n_bytes", "n_tokens", "over_limit").withColumns(
        {"n_bytes": F.octet_length(body).cast("long"), "n_tokens": tokens(body)}
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
