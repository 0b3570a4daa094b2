"""Benchmark decontamination with SimHash windows, in DataFrame functions only.

1. Where a document shares a shingle of words with a benchmark item, the item is lined up with it:
   a window as long as the item, moved back inside at the ends of the text (a shorter text is one
   window). A passage that the text's begin or end cuts off is so measured together with words
   beside it, and may not be found. Windows that share no shingle with any item have similarity 0
   to all and are not made.
2. Every window and every item gets a 128-bit SimHash of its shingles, weighted by how often each
   occurs in it.
3. The fingerprint is cut into BLOCKS blocks. Two fingerprints within RADIUS = BLOCKS - 1 bits
   agree in one block at least, so an equi-join on (window length, block number, block value)
   finds all pairs within the radius; the others of its pairs are dropped by their distance.
4. The pairs left are verified exactly: the weighted Jaccard similarity of the two bags of shingles,
   the sum of the smaller counts over the sum of the larger ones.

Windows of similarity 0.8 differ in 19 of the 128 bits on average, with a deviation of 4; the radius
of 31 bits is three deviations away, and fingerprints further apart are not compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import sized, written
from tidemark.llm.textcols import free_name, lower_ascii, words
from tidemark.sizing import counted_side

SHINGLE = 5
NUM, DEN = 80, 100
BLOCKS, BLOCK_BITS = 32, 4
RADIUS = BLOCKS - 1
BROADCAST_SHINGLES = 100_000
BROADCAST_BLOCKS = 100_000


def _shingle_hash(tokens: Column, at: Column, k: int) -> Column:
    """Hash of the `k` words from place `at` (from 1) on."""
    return F.xxhash64(*[F.get(tokens, at + (j - 1)) for j in range(k)])


def _places(n: Column, k: int) -> Column:
    return F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))


def bag(tokens: Column, k: Column) -> Column:
    """The shingles of a window, numbered among equals, so that bags can be intersected as sets."""
    n = F.size(tokens)
    starts = F.when(n >= k, F.sequence(F.lit(1), n - k + 1)).otherwise(F.array().cast("array<int>"))
    plain = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, k), " "))
    numbered = F.transform(
        F.array(plain),
        lambda all_: F.transform(
            all_, lambda s, i: F.concat(F.size(F.filter(F.slice(all_, F.lit(1), i), lambda x: x == s)).cast("string"), F.lit(" "), s)
        ),
    )
    return F.element_at(numbered, 1)


def simhash(shingles: Column, salt: int) -> Column:
    """64 bits: each says what most shingles, counted as often as they occur, have there."""
    hashes = F.transform(shingles, lambda s: F.xxhash64(F.lit(salt), F.regexp_replace(s, r"^\d+ ", "")))
    return F.element_at(
        F.transform(
            F.array(hashes),
            lambda hs: F.aggregate(
                F.sequence(F.lit(0), F.lit(63)),
                F.lit(0).cast("long"),
                lambda acc, b: acc.bitwiseOR(
                    F.when(
                        2 * F.aggregate(hs, F.lit(0), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long")).cast("int"))
                        > F.size(hs),
                        F.call_function("shiftleft", F.lit(1).cast("long"), b),
                    ).otherwise(F.lit(0).cast("long"))
                ),
            ),
        ),
        1,
    )


def _blocks(low: Column, high: Column) -> Column:
    half = 64 // BLOCK_BITS

    def block(j: Column) -> Column:
        part = F.when(j < half, low).otherwise(high)
        bits = F.call_function("shiftrightunsigned", part, (F.pmod(j, F.lit(half)) * BLOCK_BITS).cast("int"))
        return F.struct(j.alias("block"), bits.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long")).alias("value"))

    return F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), block)


def _distance(a: str, b: str) -> Column:
    return sum(F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in ("low", "high"))


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (key, item_key, similarity, first_word, n_windows): items found in documents.

    A pair is there if a window of the document has weighted-shingle similarity of NUM / DEN or more
    to the item; `similarity` is that of its best window, `first_word` where that begins (words count
    from 0; ties: the first), `n_windows` how many windows reach the threshold. Words are lower-cased
    in A-Z; an item of fewer than SHINGLE words is one shingle. Null and empty texts and null keys
    are not found and find nothing. Rows that share a key are one document. No rows in either table
    give no rows. Only the columns asked for are read, so others cannot clash.

    The shingles of the items are broadcast if counted small, else joined by shuffle on their hash.
    Windows grow with the shared shingles, not with the texts; they are written, counted, and
    broadcast to the texts only up to a bound.
    """
    named_items = (
        items.select(F.col(f"`{item_key}`").alias("item"), words(lower_ascii(F.col(f"`{item_text}`").cast("string"))).alias("iw"))
        .where(F.col("item").isNotNull() & (F.size("iw") > 0))
        .withColumn("n", F.size("iw"))
        .withColumn("k", F.least(F.col("n"), F.lit(SHINGLE)))
    )
    sizes = sorted(r["k"] for r in named_items.select("k").distinct().collect())  # 1 to SHINGLE
    texts = docs.select(F.col(f"`{key}`").alias("id"), words(lower_ascii(F.col(f"`{text}`").cast("string"))).alias("w")).where(
        F.col("id").isNotNull() & (F.size("w") > 0)
    )
    windows = None
    for k in sizes:
        own = named_items.where(F.col("k") == k)
        parts = own.select("n", "iw", F.explode(_places(F.col("n"), k)).alias("q")).select(
            _shingle_hash(F.col("iw"), F.col("q"), k).alias("h"), "n", "q"
        )
        parts = counted_side(parts.distinct(), BROADCAST_SHINGLES)
        placed = texts.select("id", "w", F.explode(_places(F.size("w"), k)).alias("p")).select(
            "id", F.size("w").alias("size"), "p", _shingle_hash(F.col("w"), F.col("p"), k).alias("h")
        )
        start = F.greatest(F.lit(1), F.least(F.col("p") - F.col("q") + 1, F.col("size") - F.col("n") + 1))
        found = placed.join(parts, "h").select("id", "n", F.lit(k).alias("k"), start.alias("start")).distinct()
        windows = found if windows is None else windows.union(found)
    if windows is None:
        return _nothing(docs, items, key, item_key)

    cut = (
        texts.join(sized(written(windows, "windows")), "id")
        .select("id", "n", "start", "k", F.slice("w", F.col("start"), F.col("n")).alias("tokens"))
        .select("id", "n", "start", bag(F.col("tokens"), F.col("k")).alias("bag"))
        .where(F.size("bag") > 0)
    )
    prints = cut.withColumns({"wlow": simhash(F.col("bag"), 1), "whigh": simhash(F.col("bag"), 2)})
    item_prints = named_items.select("item", "n", bag(F.col("iw"), F.col("k")).alias("ibag")).withColumns(
        {"ilow": simhash(F.col("ibag"), 1), "ihigh": simhash(F.col("ibag"), 2)}
    )
    index = item_prints.select("item", "n", "ibag", "ilow", "ihigh", F.explode(_blocks(F.col("ilow"), F.col("ihigh"))).alias("b")).select(
        "item", "n", "ibag", "ilow", "ihigh", "b.block", "b.value"
    )
    asked = prints.select("id", "n", "start", "bag", "wlow", "whigh", F.explode(_blocks(F.col("wlow"), F.col("whigh"))).alias("b")).select(
        "id", "n", "start", "bag", "wlow", "whigh", "b.block", "b.value"
    )
    near = (
        asked.join(counted_side(index, BROADCAST_BLOCKS), ["n", "block", "value"])
        .where(_distance("w", "i") <= RADIUS)
        .withColumn("both", F.size(F.array_intersect("bag", "ibag")))
        .withColumn("all", F.size("bag") + F.size("ibag") - F.col("both"))
        .where(F.col("both") * DEN >= F.col("all") * NUM)
        .select("id", "item", "start", (F.col("both") / F.col("all")).alias("similarity"))
        .distinct()
    )
    best = near.groupBy("id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"), F.count(F.lit(1)).alias("n_windows")
    )
    return best.select(
        F.col("id").alias(key),
        F.col("item").alias(item_key),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.back") - 1).cast("long").alias("first_word"),
        "n_windows",
    )


def _nothing(docs: DataFrame, items: DataFrame, key: str, item_key: str) -> DataFrame:
    kinds = {key: docs.schema[key].dataType.simpleString(), item_key: items.schema[item_key].dataType.simpleString()}
    columns = ", ".join(f"`{n}` {t}" for n, t in kinds.items())
    return docs.sparkSession.createDataFrame([], f"{columns}, similarity double, first_word long, n_windows long")


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the documents in which an item was found; all columns and other rows stay."""
    other = free_name(docs, "found_key")
    found = sized(written(contaminated(docs, items, key, text).select(F.col(key).alias(other)).distinct(), "found"))
    return docs.join(found, F.col(f"`{key}`") == F.col(other), "left_anti")
