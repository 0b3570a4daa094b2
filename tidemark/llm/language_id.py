"""Language ID by a bidirectional gated recurrent network over the bytes of a text.

The network reads the UTF-8 bytes in both directions, gives every position a distribution over the
languages, and a document the mean of its positions. It is written in numpy and trained by
backpropagation through time on a bounded sample of labelled rows (`SAMPLE_PER_LANG` documents per
language, `SAMPLE_WINDOWS` passages of each); everything after training covers every byte of every
text. Texts are read in windows of `WINDOW` bytes whose states start at zero, so a worker advances
thousands of windows together and a text of any length takes the same memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textcols import free_name

WINDOW = 128
EMBED, HIDDEN = 8, 12
SAMPLE_PER_LANG = 200
SAMPLE_WINDOWS = 6
MAX_LANGS = 200
STEPS, BATCH, RATE = 160, 128, 0.015
ROWS_AT_ONCE = 4096
UNKNOWN = "und"


@dataclass
class BiGru:
    """Weights; index 0 of the leading axis reads forwards, 1 backwards."""

    langs: list[str]
    embed: np.ndarray  # 257 x EMBED, the last row for the padding
    w_in: np.ndarray  # 2 x EMBED x 3H: update, reset, candidate
    w_state: np.ndarray  # 2 x H x 3H
    bias: np.ndarray  # 2 x 3H
    w_out: np.ndarray  # 2H x languages
    b_out: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], seed: int = 7) -> BiGru:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
        k = len(langs)
        return cls(
            langs,
            rng.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            draw(2, EMBED, 3 * HIDDEN),
            draw(2, HIDDEN, 3 * HIDDEN),
            np.zeros((2, 3 * HIDDEN), np.float32),
            draw(2 * HIDDEN, k),
            np.zeros(k, np.float32),
        )

    def params(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in ("embed", "w_in", "w_state", "bias", "w_out", "b_out")}


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _read(net: BiGru, codes: np.ndarray, side: int, keep: list | None = None) -> np.ndarray:
    """States of one direction, time x rows x H. `keep` collects what the backward pass needs.

    States stay zero over padding before the text's last byte, which the backward direction reads
    first; what the forward direction makes of padding after it is never used.
    """
    steps, rows = codes.shape
    h, out = np.zeros((rows, HIDDEN), net.embed.dtype), np.empty((steps, rows, HIDDEN), net.embed.dtype)
    fed = net.embed @ net.w_in[side] + net.bias[side]  # what each byte adds to the gates
    w_gate, w_cand = np.ascontiguousarray(net.w_state[side][:, : 2 * HIDDEN]), np.ascontiguousarray(net.w_state[side][:, 2 * HIDDEN :])
    fed_gate, fed_cand = np.ascontiguousarray(fed[:, : 2 * HIDDEN]), np.ascontiguousarray(fed[:, 2 * HIDDEN :])
    padded = (codes == 256) if side else None
    some = padded.any(1) if side else np.zeros(steps, bool)
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        gates = h @ w_gate
        gates += fed_gate[codes[t]]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        rh = r * h
        c = rh @ w_cand
        c += fed_cand[codes[t]]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h, z, r, rh, c))
        step = c - h
        step *= z
        h = h + step
        if some[t]:
            h[padded[t]] = 0
        out[t] = h
    return out


def positions(net: BiGru, codes: np.ndarray) -> np.ndarray:
    """Probabilities of every position: time x rows x languages, for `codes` of time x rows."""
    logits = _read(net, codes, 0) @ net.w_out[:HIDDEN] + _read(net, codes, 1) @ net.w_out[HIDDEN:] + net.b_out
    return _softmax(logits)


def _gradients(net: BiGru, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Loss per position and its gradients by backpropagation through time."""
    kept: tuple[list, list] = ([], [])
    states = [_read(net, codes, side, kept[side]) for side in (0, 1)]
    both = np.concatenate(states, axis=2)
    p = _softmax(both @ net.w_out + net.b_out)
    real = (codes != 256).astype(np.float32)[..., None]
    n = max(real.sum(), 1.0)
    rows = np.arange(codes.shape[1])
    loss = -float((np.log(p[:, rows, labels] + 1e-9) * real[..., 0]).sum() / n)
    d = p.copy()
    d[:, rows, labels] -= 1
    d *= real / n
    g = {k: np.zeros_like(v) for k, v in net.params().items()}
    g["w_out"] = np.einsum("trh,trk->hk", both, d)
    g["b_out"] = d.sum((0, 1))
    back = d @ net.w_out.T
    for side in (0, 1):
        into = back[..., :HIDDEN] if side == 0 else back[..., HIDDEN:]
        w = net.w_state[side]
        w_gate, w_cand = w[:, : 2 * HIDDEN], w[:, 2 * HIDDEN :]
        dh = np.zeros((codes.shape[1], HIDDEN), np.float32)
        d_fed = np.zeros((257, 3 * HIDDEN), np.float32)
        for t, h, z, r, rh, c in reversed(kept[side]):
            live = real[t]
            dn = (dh + into[t]) * live
            dz, dc = dn * (c - h) * z * (1 - z), dn * z * (1 - c * c)
            drh = dc @ w_cand.T
            dr = drh * h * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            g["w_state"][side][:, : 2 * HIDDEN] += h.T @ gates
            g["w_state"][side][:, 2 * HIDDEN :] += rh.T @ dc
            np.add.at(d_fed, codes[t], np.concatenate([gates, dc], axis=1))
            dh = dn * (1 - z) + drh * r + gates @ w_gate.T
        g["w_in"][side] = net.embed.T @ d_fed
        g["bias"][side] = d_fed.sum(0)
        g["embed"] += d_fed @ net.w_in[side].T
    return loss, g


def train(texts: list[str], labels: list[str], steps: int = STEPS, seed: int = 7) -> BiGru | None:
    """A network for the languages in `labels`; None if there are none. Deterministic in its input."""
    langs = sorted(set(labels))
    if not langs:
        return None
    net, rng = BiGru.fresh(langs, seed), np.random.default_rng(seed)
    rows, owner = [], []
    for text, lang in zip(texts, labels):
        windows = _windows(text.encode("utf-8", "surrogatepass"))
        rows.extend(windows)
        owner.extend([langs.index(lang)] * len(windows))
    if not rows:
        return None
    rows, owner = np.stack(rows), np.array(owner)
    by_lang = [np.flatnonzero(owner == k) for k in range(len(langs))]
    by_lang = [x for x in by_lang if len(x)]
    mean = {k: np.zeros_like(v) for k, v in net.params().items()}
    square = {k: np.zeros_like(v) for k, v in net.params().items()}
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(by_lang[i]) for i in rng.integers(0, len(by_lang), BATCH)])
        _, g = _gradients(net, rows[pick].T, owner[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in net.params().items():
            mean[k] = 0.9 * mean[k] + 0.1 * g[k]
            square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
            v -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return net


def _windows(raw: bytes) -> np.ndarray:
    """Rows of WINDOW byte values; 256 pads the last one."""
    n = -(-len(raw) // WINDOW)
    flat = np.full(n * WINDOW, 256, np.int64)
    flat[: len(raw)] = np.frombuffer(raw, np.uint8)
    return flat.reshape(n, WINDOW)


def _sums(net: BiGru, rows: np.ndarray) -> np.ndarray:
    """Per window, the sum of its positions' probabilities."""
    out = np.zeros((len(rows), len(net.langs)), np.float64)
    for at in range(0, len(rows), ROWS_AT_ONCE):
        codes = np.ascontiguousarray(rows[at : at + ROWS_AT_ONCE].T)
        p = positions(net, codes)
        out[at : at + ROWS_AT_ONCE] = np.einsum("trk,tr->rk", p, codes != 256)
    return out


def predict(net: BiGru | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and pooled probability per text; `und` with 0 for nulls and texts without a letter.

    Windows of the batch are read in blocks of about ROWS_AT_ONCE, also across texts, so memory does
    not grow with the length of a text.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    todo = [i for i, t in enumerate(texts) if net is not None and t is not None and any(map(str.isalpha, t))]
    pooled = np.zeros((len(texts), len(net.langs) if net else 0))
    block, owners, held = [], [], 0

    def flush() -> None:
        nonlocal block, owners, held
        if block:
            np.add.at(pooled, np.concatenate(owners), _sums(net, np.concatenate(block)))
        block, owners, held = [], [], 0

    for i in todo:
        rows = _windows(texts[i].encode("utf-8", "surrogatepass"))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            part = rows[at : at + ROWS_AT_ONCE]
            block.append(part)
            owners.append(np.full(len(part), i))
            held += len(part)
            if held >= ROWS_AT_ONCE:
                flush()
    flush()
    for i in todo:
        best = int(pooled[i].argmax())
        names[i], scores[i] = net.langs[best], min(1.0, pooled[i][best] / pooled[i].sum())
    return names, scores


def labelled_sample(docs: DataFrame, text: str, lang: str, key: str, per_lang: int = SAMPLE_PER_LANG) -> list[T.Row]:
    """At most `per_lang` labelled rows per language, those with the smallest hash of `key`.

    Keys are ranked first, without the texts; the group limit cuts them before the shuffle. Then the
    texts of these keys alone are read. More than MAX_LANGS languages raise an error.
    """
    named = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    usable = named.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("key").isNotNull() & (F.length("text") > 0))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key"))
    keys = usable.select("key", "lang").withColumn("rank", rank).where(F.col("rank") <= per_lang).select("key")
    chosen = keys.limit(per_lang * MAX_LANGS + 1).collect()
    if len(chosen) > per_lang * MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not chosen:
        return []
    small = F.broadcast(docs.sparkSession.createDataFrame(chosen, keys.schema).distinct())
    # Passages at even distances over the whole text, the same number for every text.
    last = F.greatest(F.length("text") - WINDOW, F.lit(0))
    starts = F.array_distinct(
        F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)), lambda k: F.floor(k * last / (SAMPLE_WINDOWS - 1)).cast("int"))
    )
    passages = F.transform(starts, lambda at: F.col("text").substr(at + 1, F.lit(WINDOW)))
    rows = usable.join(small, "key", "left_semi").select("key", "lang", F.explode(passages).alias("text"))
    return sorted(rows.collect(), key=lambda r: (str(r["key"]), r["lang"], r["text"]))


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> BiGru | None:
    """Train on a sample of the rows where `learn` holds; rows without text or language teach nothing."""
    rows = labelled_sample(docs.where(learn), text, lang, key)
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, net: BiGru | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (0 to 1), from the text alone.

    Null texts and texts without a letter give `und` and 0; so does every text when nothing was
    learned. Rows are judged one by one, so repeated rows come out repeated; an empty table gives an
    empty result. Columns lang_pred and score of `docs` give way to the new ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers
    result = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(result)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = predict(shared.value, texts.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": scores})

    both = free_name(docs, "judged")
    out = docs.drop("lang_pred", "score").withColumn(both, judged(F.col(f"`{text}`").cast("string")))
    return out.withColumns({"lang_pred": F.col(both)["lang_pred"], "score": F.col(both)["score"]}).drop(both)
