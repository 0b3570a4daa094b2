"""Language-model scores by deleted interpolation.

The probability of a word after another mixes three estimates: the share of the pair among the
pairs of its context, the share of the word among all, and 1 / (vocabulary + 1). The weights
depend on how often the context was seen (one bucket per power of two) and are learned by
expectation-maximisation on a part of the training texts that was left out of the counts for this.

Counting and lookup in Spark, without a table of counts in any one place:

1. Texts are read where they lie. A task sends the distinct words and pairs it met to buckets of
   the hash space, per chunk of documents (a hash of the id), as packed sorted hashes with counts.
2. A bucket adds up the counts of its hashes and answers every chunk with the counts of what the
   chunk asked for, in the same order, so the answers carry no keys.
3. Chunks meet their answers and score their texts, after the weights were learned from the
   left-out chunks; what the driver sees of these is one bounded histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import written
from tidemark.llm.packing import by_chunk, edges, pack, pack_numbers, unpack, unpack_numbers
from tidemark.llm.shingles import chunks, hash_words, mix, split_words

CHUNK_BYTES = 8 << 20
BUCKET_TOKENS = 1 << 20
MAX_BUCKETS = 1 << 16
FLUSH_TOKENS = 2_000_000
READ_ROWS = 2000  # texts that are cut into words together
YIELD_BYTES = 4 << 20
CONTEXT_BUCKETS = 48
STEPS_PER_OCTAVE, OCTAVES = 4, 40
ROUNDS = 40
END = np.uint64(0x5851F42D4C957F2D)

TRAIN, LEFT_OUT, UNSEEN = 0, 1, 2


@dataclass
class Weights:
    """Per context bucket the weights of pair, word and uniform estimates, and the corpus' size."""

    mix: np.ndarray  # CONTEXT_BUCKETS x 3
    tokens: int
    words: int


def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text, and the number of tokens of each text."""
    parts, counts = [], []
    for part in chunks(texts):
        split = [split_words(t) for t in texts[part]]
        lengths = np.array([len(w) for w in split], np.int64)
        hashes = np.full(int((lengths + 1).sum()), END, np.uint64)
        word = np.ones(len(hashes), bool)
        word[np.cumsum(lengths + 1) - 1] = False
        hashes[word] = hash_words([w for ws in split for w in ws])
        parts.append(hashes)
        counts.append(lengths + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(counts)


def word_keys(tokens: np.ndarray) -> np.ndarray:
    """Keys of words are even, keys of pairs odd."""
    return mix(tokens) << np.uint64(1) >> np.uint64(1) & ~np.uint64(1)


def pair_keys(tokens: np.ndarray) -> np.ndarray:
    """Each token with the one before it; before the first of a text stands the end."""
    before = np.empty_like(tokens)
    before[1:], before[:1] = tokens[:-1], END
    return mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + tokens) >> np.uint64(1) | np.uint64(1)


def asked(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, chunks, keys, seen, left): what a task met, by bucket: ascending keys, each beside its chunk.

    `docs` has rows (id, text, fold, chunk). `seen` are the counts in training texts, `left` those
    in left-out ones; texts to be scored only ask. One row holds all chunks of a flush, so neither rows
    nor packed arrays grow with chunks times buckets.
    """

    def flush(held: list[tuple]) -> Iterator[pd.DataFrame]:
        of_chunk: dict[int, list] = {}
        for chunk, fold, keys in held:
            of_chunk.setdefault(chunk, []).append((fold, keys))
        held.clear()
        found = []
        for chunk, parts in of_chunk.items():
            keys, place = np.unique(np.concatenate([k for _, k in parts]), return_inverse=True)
            folds = np.repeat([f for f, _ in parts], [len(k) for _, k in parts])
            seen = np.bincount(place[folds == TRAIN], minlength=len(keys))
            left = np.bincount(place[folds == LEFT_OUT], minlength=len(keys))
            found.append((np.full(len(keys), chunk, np.int32), keys, seen.astype(np.int32), left.astype(np.int32)))
        if not found:
            return
        of_chunk.clear()
        chunks, keys, seen, left = (np.concatenate(x) for x in zip(*found))
        found.clear()
        order = np.argsort(keys)
        keys = keys[order]
        at = edges(keys, buckets, 63)
        out, waiting = [], 0
        for b in np.flatnonzero(np.diff(at)):
            s = slice(at[b], at[b + 1])
            own = order[s]
            out.append((int(b), pack_numbers(chunks[own]), pack(keys[s]), pack_numbers(seen[own]), pack_numbers(left[own])))
            waiting += sum(map(len, out[-1][1:]))
            if waiting >= YIELD_BYTES:
                yield pd.DataFrame(out, columns=["bucket", "chunks", "keys", "seen", "left"])
                out, waiting = [], 0
        if out:
            yield pd.DataFrame(out, columns=["bucket", "chunks", "keys", "seen", "left"])

    def met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, tokens = [], 0
        for batch in batches:
            batch = batch.sort_values(["chunk", "fold"])
            for at in range(0, len(batch), READ_ROWS):
                rows = batch.iloc[at : at + READ_ROWS]
                hashes, lengths = token_hashes(rows["text"].tolist())
                words, pairs, ends = word_keys(hashes), pair_keys(hashes), np.append(0, np.cumsum(lengths))
                chunk, fold = rows["chunk"].to_numpy(), rows["fold"].to_numpy()
                turn = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (fold[1:] != fold[:-1])))
                for a, b in zip(turn.tolist(), [*turn[1:].tolist(), len(rows)]):
                    own = slice(ends[a], ends[b])
                    held.append((int(chunk[a]), int(fold[a]), np.concatenate([words[own], pairs[own]])))
                tokens += len(hashes)
                if tokens >= FLUSH_TOKENS:
                    yield from flush(held)
                    tokens = 0
        yield from flush(held)

    return docs.mapInPandas(met, "bucket long, chunks binary, keys binary, seen binary, left binary")


def answered(asked_rows: DataFrame) -> DataFrame:
    """Rows (chunk, bucket, full, part) with the counts of each chunk's keys, in ascending order.

    `full` counts all training texts, `part` those that are not left out (for left-out chunks
    only). One more row per bucket, of chunk -1, has the bucket's totals.
    """

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = rows["bucket"].iloc[0]
        keys, place = np.unique(np.concatenate([unpack(k) for k in rows["keys"]]), return_inverse=True)
        seen, left = (np.bincount(place, np.concatenate([unpack_numbers(c) for c in rows[side]]), len(keys)).astype(np.int64) for side in ("seen", "left"))
        word = keys % np.uint64(2) == 0
        full = seen + left
        out = [(-1, bucket, None, None, int(full[word].sum()), int((full[word] > 0).sum()), int(seen[word].sum()), int((seen[word] > 0).sum()))]
        chunks = np.concatenate([unpack_numbers(c) for c in rows["chunks"]]).astype(np.int64)
        for chunk, own in by_chunk(chunks, place, len(keys)):
            part = pack_numbers(seen[own]) if chunk % 2 else None
            out.append((chunk, bucket, pack_numbers(full[own]), part, 0, 0, 0, 0))
        return pd.DataFrame(out, columns=["chunk", "bucket", "full", "part", "tokens", "words", "part_tokens", "part_words"])

    kind = "chunk long, bucket long, full binary, part binary, tokens long, words long, part_tokens long, part_words long"
    return asked_rows.groupBy("bucket").applyInPandas(added, kind)


class Lookup:
    """Counts of the words and pairs of one chunk."""

    def __init__(self, texts: list[str | None], answers: pd.DataFrame, column: str):
        tokens, self.lengths = token_hashes(texts)
        words, pairs = word_keys(tokens), pair_keys(tokens)
        keys = np.unique(np.concatenate([words, pairs]))
        counts = np.concatenate([np.zeros(0, np.int64), *[unpack_numbers(c).astype(np.int64) for c in answers.sort_values("bucket")[column]]])
        if len(counts) != len(keys):
            raise ValueError(f"{len(keys)} keys, {len(counts)} counts: the input changed between two readings")
        self.word = counts[np.searchsorted(keys, words)]
        self.pair = counts[np.searchsorted(keys, pairs)]
        self.end = counts[np.searchsorted(keys, word_keys(np.array([END])))[0]] if len(tokens) else 0
        self.context = np.concatenate([[self.end], self.word[:-1]]) if len(tokens) else self.word

    def estimates(self, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of the context, share of the pair, share of the word, per token."""
        bucket = np.minimum(np.frexp(self.context.astype(float))[1], CONTEXT_BUCKETS - 1)
        pair = self.pair / np.maximum(self.context, 1)
        return bucket, pair, self.word / max(total, 1)


def _octaves(ratio: np.ndarray) -> np.ndarray:
    """Logarithms in quarter octaves around 0; the lowest cell is for none."""
    safe = np.log2(np.where(ratio > 0, ratio, 1.0)) * STEPS_PER_OCTAVE
    return np.where(ratio > 0, np.clip(np.rint(safe), 1 - OCTAVES * STEPS_PER_OCTAVE, OCTAVES * STEPS_PER_OCTAVE), -OCTAVES * STEPS_PER_OCTAVE)


def learn(cells: pd.DataFrame) -> np.ndarray:
    """Weights per context bucket by expectation-maximisation on cells (bucket, pair, word, n).

    `pair` and `word` are the two estimates over the uniform one, in quarter octaves. A bucket that
    was not met keeps equal weights, without the pair in the bucket of unseen contexts.
    """
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for bucket, rows in cells.groupby("bucket"):
        floor = -OCTAVES * STEPS_PER_OCTAVE
        p = np.stack([np.where(rows[c] > floor, 2.0 ** (rows[c] / STEPS_PER_OCTAVE), 0.0) for c in ("pair", "word")] + [np.ones(len(rows))], 1)
        n, w = rows["n"].to_numpy(float), weights[bucket]
        for _ in range(ROUNDS):
            share = p * w
            w = ((share / share.sum(1, keepdims=True)) * n[:, None]).sum(0) / n.sum()
        # A little of the uniform estimate is always kept: any text has a probability.
        w = np.maximum(w, [0, 0, 1e-6])
        weights[bucket] = w / w.sum()
    return weights


def score_texts(docs: DataFrame, fold: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, n_tokens, n_known, train_tokens, base_score, score), one per row of `docs`.

    `fold` is TRAIN, LEFT_OUT (training texts that the weights are learned on) or UNSEEN (null too:
    a text without key is never learned from). Scores are log10 probabilities. The base score takes
    (count + 1) / (tokens + words + 1) for every token. A null or empty text has its end only.
    Repeated rows are each counted and scored. With nothing to learn from, every token gets 1 / 1
    in the base and the uniform estimate in the score; an empty table gives an empty result. Only
    the two columns asked for are read, so others cannot clash.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(fold, F.lit(UNSEEN)).alias("fold")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_chunks = max(1, -(-size // CHUNK_BYTES))
    n_buckets = int(min(MAX_BUCKETS, max(1, size // 6 // BUCKET_TOKENS)))
    # Left-out texts are in chunks of their own, of odd number.
    chunk = 2 * F.pmod(F.xxhash64("id"), F.lit(n_chunks)) + (F.col("fold") == LEFT_OUT).cast("long")
    rows = rows.withColumn("chunk", chunk)
    answers = written(answered(asked(rows, n_buckets)), "counts")
    total = answers.where("chunk = -1").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words", "part_tokens", "part_words")]
    ).first()

    def cells(docs_of: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if not len(docs_of):
            return pd.DataFrame(columns=["bucket", "pair", "word", "n"], dtype="int64")
        bucket, pair, word = Lookup(docs_of["text"].tolist(), counts, "part").estimates(total["part_tokens"])
        uniform = 1 / (total["part_words"] + 1)
        table = pd.DataFrame({"bucket": bucket, "pair": _octaves(pair / uniform), "word": _octaves(word / uniform)}).astype("int64")
        return table.value_counts().rename("n").reset_index()

    left_docs = rows.where(F.col("fold") == LEFT_OUT).select("chunk", "text").groupBy("chunk")
    left_counts = answers.where("chunk % 2 = 1").select("chunk", "bucket", "part").groupBy("chunk")
    met = left_docs.cogroup(left_counts).applyInPandas(cells, "bucket long, pair long, word long, n long")
    weights = Weights(learn(met.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).toPandas()), total["tokens"], total["words"])

    def scored(docs_of: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if not len(docs_of):
            return pd.DataFrame(columns=["id", "n_tokens", "n_known", "base_score", "score"])
        found = Lookup(docs_of["text"].tolist(), counts, "full")
        bucket, pair, word = found.estimates(weights.tokens)
        w = weights.mix[bucket]
        p = w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (weights.words + 1)
        base = np.log10((found.word + 1) / (weights.tokens + weights.words + 1))
        begin = np.cumsum(found.lengths) - found.lengths
        add = lambda x: np.add.reduceat(x, begin)  # noqa: E731  every text has a token at least
        return pd.DataFrame(
            {
                "id": docs_of["id"], "n_tokens": found.lengths, "n_known": add((found.word > 0).astype(np.int64)),
                "base_score": add(base), "score": add(np.log10(p)),
            }
        )

    kind = rows.schema["id"].dataType.simpleString()
    out = (
        rows.select("chunk", "id", "text").groupBy("chunk")
        .cogroup(answers.where("chunk >= 0").select("chunk", "bucket", "full").groupBy("chunk"))
        .applyInPandas(scored, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    )
    return out.select(F.col("id").alias(key), "n_tokens", "n_known", F.lit(weights.tokens).cast("long").alias("train_tokens"), "base_score", "score")
