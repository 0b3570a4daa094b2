"""Ranked lexical search by bag deduplication: all documents against each query item.

1. A scan restricts every document to the items' vocabulary: its bag is the sorted term numbers with
   their counts, and its length counts all its terms.
2. Documents with one bag and one length normaliser `m` are one class. The digest of the bag deals
   the rows, the grouping compares the bags themselves, so a class is verified and never a guess.
   Copies and texts that differ only outside the vocabulary cost one class.
3. Each class is scored once against all items, term by term over a block of classes.
4. The ten best documents of an item lie in its ten best classes by (score, least id): each class
   before that of a document holds a document before it. So a task keeps ten classes an item, and
   only the ten least ids of each chosen class are expanded, ascending.

Items are dealt into blocks of bounded vocabulary; a block's terms and weights are all that tasks
are sent. Numbers of documents and terms, and document frequencies, count all rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import sized, written

TOP = 10
BLOCK_POSTINGS = 400_000  # distinct (item, term) pairs of a block of items
SCORE_CELLS = 4_000_000  # classes times items scored at once in a task
SALTS = 16

# Bytes to terms: A-Z lowered, every other ASCII byte that is no letter or digit becomes a space.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z lowered; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """Rows (item, term, times) for rows (item, text)."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                counts = Counter(terms_of(text))
                yield pd.DataFrame({"item": [item] * len(counts), "term": list(counts), "times": list(counts.values())})

    schema = f"item {items.schema['item'].dataType.simpleString()}, term binary, times long"
    found = items.where("item is not null").distinct().mapInPandas(made, schema)
    return found.groupBy("item", "term").agg(F.sum("times").alias("times"))


def item_blocks(postings: DataFrame) -> tuple[DataFrame, int]:
    """`postings` with a column `block`; no block of several items has over 2 * BLOCK_POSTINGS rows."""
    per_item = postings.groupBy("item").agg(F.count(F.lit(1)).alias("rows"))
    blocks = max(1, -(-postings.count() // BLOCK_POSTINGS))
    while True:
        block = F.expr(f"pmod(xxhash64(item), {blocks})").cast("int")
        full = per_item.groupBy(block.alias("block")).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("items"))
        if not full.where(f"items > 1 and rows > {2 * BLOCK_POSTINGS}").limit(1).count():
            return postings.withColumn("block", block), blocks
        blocks *= 2


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Rows (id, n, bag) of the documents with a term: term numbers ascending, then their counts, 4 bytes each."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, packed = [], []
            for text in batch["text"]:
                terms = terms_of(text)
                known = sorted((vocabulary[t], c) for t, c in Counter(terms).items() if t in vocabulary)
                lengths.append(len(terms))
                packed.append(np.array(known, "<u4").reshape(-1, 2).T.tobytes())
            out = pd.DataFrame({"id": batch["id"].astype("Int64"), "n": lengths, "bag": packed})
            yield out[out["n"] > 0]

    return docs.mapInPandas(made, "id long, n long, bag binary")


def _flat(bag: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of all entries of a column of bags."""
    sizes = np.array([len(b) // 8 for b in bag], np.int64)
    pairs = [np.frombuffer(b, "<u4").reshape(2, -1) for b in bag]
    terms, counts = np.concatenate(pairs, axis=1).astype(np.int64) if pairs else np.zeros((2, 0), np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), terms, counts


def document_frequencies(classes: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term, summed over the classes."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            row, term, _ = _flat(batch["bag"])
            np.add.at(total, term, batch["members"].to_numpy(np.int64)[row])
        there = np.flatnonzero(total)
        yield pd.DataFrame({"term": there, "df": total[there]})

    out = np.zeros(terms, np.int64)
    for row in classes.select("bag", "members").mapInPandas(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row.term] = row.df
    return out


def block_scores(bag: pd.Series, m: np.ndarray, by_term: dict[int, tuple[np.ndarray, np.ndarray]], items: int) -> np.ndarray:
    """Scores (classes x items) in 64-bit integers; `by_term` holds each term's items and weights."""
    row, term, tf = _flat(bag)
    impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[row])
    order = np.argsort(term, kind="stable")
    row, term, impact = row[order], term[order], impact[order]
    first = np.flatnonzero(np.diff(term, prepend=-1))
    out = np.zeros((len(m), items), np.int64)
    for at, stop in zip(first, np.append(first[1:], len(term))):
        of, weight = by_term[int(term[at])]
        out[row[at:stop, None], of] += impact[at:stop, None] * weight
    return out


def _best(found: pd.DataFrame, top: int) -> pd.DataFrame:
    return found.sort_values(["score", "lead"], ascending=[False, True], kind="stable").groupby("item_no", sort=False).head(top)


def class_scores(classes: DataFrame, by_term: dict[int, tuple[np.ndarray, np.ndarray]], items: int, top: int) -> DataFrame:
    """Rows (item_no, score, lead, key, m): each task's `top` classes of an item by score and least id."""
    schema = "item_no int, score long, lead long, key binary, m long"

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            step = max(1, SCORE_CELLS // items)
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                scores = block_scores(part["bag"], part["m"].to_numpy(np.int64), by_term, items)
                rank = max(0, len(part) - top)
                bound = np.maximum(np.partition(scores, rank, axis=0)[rank], 1)
                row, item = np.nonzero(scores >= bound)
                lead = part["lead"].to_numpy(np.int64)[row]
                found = pd.DataFrame({"item_no": item, "score": scores[row, item], "lead": lead, "row": row})
                found = _best(found, top)
                found["key"], found["m"] = part["key"].to_numpy()[found["row"]], part["m"].to_numpy()[found["row"]]
                held = [_best(pd.concat([*held, found]), top)]
        for frame in held:
            yield frame[["item_no", "score", "lead", "key", "m"]]

    return classes.select("key", "m", "bag", "lead").mapInPandas(scored, schema)


def _least(rows: DataFrame, by: list[str], order: list, top: int, rank: str = "place") -> DataFrame:
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= top)


def _searched(docs: DataFrame, postings: DataFrame, top: int) -> DataFrame:
    """Rows (item, rank, id, score) for one block of items, whose postings fit in memory."""
    spark, item_type = docs.sparkSession, postings.schema["item"].dataType.simpleString()
    rows = postings.select("item", "term", "times").collect()
    vocabulary = {t: k for k, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    names = sorted({r.item for r in rows})
    number = {name: k for k, name in enumerate(names)}

    found = written(bags(docs, vocabulary).withColumn("key", F.unhex(F.sha2("bag", 256))), "bags")
    totals = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals.docs, totals.terms or 1
    found = found.withColumn("m", F.expr(f"25L + (75L * n * {n_docs}L) div {n_terms}L")).where(F.length("bag") > 0)
    lead = F.coalesce(F.min("id"), F.lit((1 << 63) - 1))
    classes = written(found.groupBy("key", "m", "bag").agg(F.count(F.lit(1)).alias("members"), lead.alias("lead")), "classes")

    df = document_frequencies(classes, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    lists: dict[int, list[tuple[int, int]]] = {k: [] for k in range(len(vocabulary))}
    for r in rows:
        t = vocabulary[bytes(r.term)]
        lists[t].append((number[r.item], weight[t] * r.times))
    by_term = {t: tuple(np.array(p, np.int64).reshape(-1, 2).T) for t, p in lists.items()}

    best = class_scores(classes, by_term, max(1, len(names)), top)
    best = written(_least(best, ["item_no"], [F.desc("score"), F.col("lead")], top).drop("place"), "best")
    chosen = sized(written(best.select("key", "m").distinct(), "chosen"))
    members = found.select("id", "key", "m").join(chosen, ["key", "m"], "left_semi")
    ascending = [F.col("id").asc_nulls_last()]
    members = members.withColumn("salt", F.expr(f"pmod(hash(id), {SALTS})"))
    members = _least(_least(members, ["key", "m", "salt"], ascending, top), ["key", "m"], ascending, top)
    ranked = _least(
        best.join(members.select("key", "m", "id"), ["key", "m"]), ["item_no"], [F.desc("score"), *ascending], top, "rank"
    )
    named = spark.createDataFrame(list(enumerate(names)), f"item_no int, item {item_type}")
    return ranked.join(F.broadcast(named), "item_no").select("item", F.col("rank").cast("int"), "id", "score")


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """Rows (item_key, rank, key, score): the `top` documents of each item with a score above 0.

    With N documents, L terms in all, n in a document and df documents of a term, a term weighs
    floor(1000 ln((2N + 2) / (2 df + 1))); m is 25 + (75 n N) div L; a score sums, over the item's
    terms with repeats, weight * ((10^9 tf) div (1000 tf + 8 m)). Null and empty texts and texts
    without a term are no documents: they count nowhere and are never returned. Documents
    of equal score rank by ascending key, those without a key last; repeated rows are documents of
    their own. Repeated rows of an item are one; rows that share an item's key but differ in text are
    one item with the terms of all; items without a key or a term have no rows. Very long texts are
    read whole. Empty tables give an empty result. Only the four columns named are read, so others
    cannot clash.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_key}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    postings, blocks = item_blocks(written(item_terms(asked), "postings"))
    done = [_searched(rows, postings.where(F.col("block") == b), top) for b in range(blocks)]
    if blocks > 1:
        done = [written(d, "ranked") for d in done]
    return reduce(DataFrame.unionByName, done).select(
        F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score"
    )
