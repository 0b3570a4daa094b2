"""Phrase collocations by Toivonen's sampling method, exact counts from full passes.

1. A sample of the documents proposes phrases of 1 to 3 words, level by level, at a lowered count.
2. The proposals become bit filters of bounded size, one a length. A full pass counts every word and
   every longer phrase both of whose parts one word shorter pass: the proposals' extensions and their
   negative border at once. A filter's false hits only add phrases that are counted as exactly.
3. A frequent phrase that the filters miss is a failure of the border. Failures join the filters, and
   a further pass counts what only now passes, each phrase in one pass and wholly. When no frequent
   phrase is missed, every frequent phrase has been counted: its parts are frequent, so they pass.
4. Texts of the frequent phrases come from the sample, and from the whole for those it lacks. Cuts,
   the drop of phrases inside longer ones and the ranking are joins and aggregates.

Counts are kept by 96-bit keys of (language, words). All rows are shuffled by key; a frequent word or
phrase is one row of a task's partial sums. The ranking sorts by ranges, so a language that holds
most phrases is in many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import sized, small_batches, written
from tidemark.llm.phrase_keys import LONGEST, Chunk, Filter, part_keys, tally

SAMPLE_EVERY = 8  # one document in so many proposes phrases
LOWERED = 0.5  # share of the count expected in the sample that makes a proposal
BITS_A_PHRASE = 16
MAX_BITS = 1 << 28  # 32 MB a filter; beyond it more phrases pass and are counted
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
KEY = ["high", "low"]

Emit = Callable[[Chunk], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Chunk]]:
    """The texts of each language in slices; they are taken from the batch as bytes, a slice at a time."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes, rows = pc.binary_length(texts).to_pylist(), {}
        for k, lang in enumerate(batch.column("lang").to_pylist()):
            rows.setdefault(lang, []).append(k)
        for lang in sorted(rows):
            held, size = [], 0
            for k in rows[lang]:
                held.append(texts[k].as_py())
                size += sizes[k]
                if size >= SLICE_BYTES:
                    yield lang, Chunk(lang, held)
                    held, size = [], 0
            if held:
                yield lang, Chunk(lang, held)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def counted(docs: DataFrame, emit: Emit, least: int, name: str) -> DataFrame:
    """Rows (high, low, f) of the phrases that `emit` gives and that occur `least` times or more."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in _slices(batches):
            for high, low, f in emit(chunk):
                yield _batch(high=high, low=low, f=f.astype(np.int64))

    rows = docs.mapInArrow(made, "high long, low int, f long").groupBy(*KEY).agg(F.sum("f").alias("f"))
    return written(rows.where(F.col("f") >= least), name)


def level(k: int, filters: dict[int, Filter]) -> Emit:
    """Phrases of `k` words whose parts pass."""

    def emit(chunk: Chunk) -> Iterator[tuple]:
        if k == 1:
            yield chunk.words()
        else:
            yield tally(*chunk.keys(k, np.flatnonzero(chunk.begins([filters], k)[k][0])))

    return emit


def full(filters: dict[int, Filter]) -> Emit:
    """All words, and the phrases whose parts pass."""

    def emit(chunk: Chunk) -> Iterator[tuple]:
        yield chunk.words()
        for k, (begin,) in chunk.begins([filters]).items():
            yield tally(*chunk.keys(k, np.flatnonzero(begin)))

    return emit


def further(before: dict[int, Filter], filters: dict[int, Filter]) -> Emit:
    """The phrases whose parts pass now and did not before."""

    def emit(chunk: Chunk) -> Iterator[tuple]:
        for k, (old, begin) in chunk.begins([before, filters]).items():
            yield tally(*chunk.keys(k, np.flatnonzero(begin & ~old)))

    return emit


def filter_of(keys: DataFrame, size: int | None = None) -> Filter:
    """The filter of the column `high`, put together in tasks; the driver gets its bits alone."""
    if size is None:
        size = min(MAX_BITS, 1 << max(18, (BITS_A_PHRASE * keys.count()).bit_length()))
    slot = F.explode(F.array(F.col("high").bitwiseAND(size - 1), F.shiftrightunsigned("high", 36).bitwiseAND(size - 1)))
    slots = keys.select(slot.alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("word"))

    def page(rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(4096, np.int64)
        out[rows["at"].to_numpy() & 4095] = rows["word"].to_numpy()
        return pd.DataFrame({"page": [int(rows["at"].iloc[0]) >> 12], "bits": [out.tobytes()]})

    bits = np.zeros(max(size // 8, 1 << 15), np.uint8)
    for row in words.groupBy(F.shiftright("at", 12).alias("page")).applyInPandas(page, "page int, bits binary").collect():
        bits[row.page << 15 : (row.page + 1) << 15] = np.frombuffer(row.bits, np.uint8)
    return Filter(bits[: size // 8])


def _length(k: int) -> F.Column:
    return F.col("low").bitwiseAND(7) == k


def missed(frequent: DataFrame, filters: dict[int, Filter]) -> DataFrame:
    """The frequent phrases that can be part of a longer one and do not pass their filter."""

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, out = batch["low"].to_numpy() & 7, np.zeros(len(batch), bool)
            for size, seen in filters.items():
                out |= (k == size) & ~seen.has(batch["high"].to_numpy())
            yield batch[out]

    return frequent.select(*KEY).mapInPandas(kept, "high long, low int")


def frequent_phrases(docs: DataFrame, sample: DataFrame, least: int) -> DataFrame:
    """Rows (high, low, f) of all phrases of 0 to LONGEST words that occur `least` times or more in `docs`."""
    lowered = max(2, int(least * LOWERED / SAMPLE_EVERY))
    filters: dict[int, Filter] = {}
    for k in range(1, LONGEST):
        filters[k] = filter_of(counted(sample, level(k, filters), lowered, f"proposed-{k}").where(_length(k)))
    found = counted(docs, full(filters), least, "counted")
    fresh = found
    while True:
        failures = written(missed(fresh, filters), "failures")
        if not failures.limit(1).count():
            return found
        before = filters
        filters = {k: Filter(f.bits | filter_of(failures.where(_length(k)), 8 * len(f.bits)).bits) for k, f in before.items()}
        fresh = counted(docs, further(before, filters), least, "counted")
        found = found.unionByName(fresh)


def named(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (high, low, f, lang, phrase) of the `wanted` that occur in `docs`."""
    seen = filter_of(wanted)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _slices(batches):
            for k, (begin,) in chunk.begins([{}]).items():
                at = np.flatnonzero(begin)
                high, low = chunk.keys(k, at)
                hit = np.flatnonzero(seen.has(high))
                _, first = np.unique(high[hit], return_index=True)
                first = hit[first]
                texts = pa.array([chunk.text(k, i) for i in at[first].tolist()], pa.string())
                yield _batch(high=high[first], low=low[first], lang=pa.array([lang] * len(first), pa.string()), phrase=texts)

    found = docs.mapInArrow(made, "high long, low int, lang string, phrase string")
    return found.join(sized(wanted), KEY).groupBy(*KEY, "f").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))


def parts(phrases: DataFrame) -> DataFrame:
    """Rows (high, low, f, first, stop, part_high, part_low): the runs of words inside each phrase, and of its language."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (lang, k), rows in batch.groupby(["lang", batch["low"] & 7]):
                for (first, stop), (high, low) in part_keys(lang, rows["phrase"].tolist(), int(k)).items():
                    yield pd.DataFrame(
                        {"high": rows["high"], "low": rows["low"], "f": rows["f"], "first": first, "stop": stop, "part_high": high, "part_low": low}
                    )

    return phrases.mapInPandas(made, "high long, low int, f long, first int, stop int, part_high long, part_low int")


def totals(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rows (lang, n): the words of each language that has a frequent phrase."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [Chunk(lang, []).words() for lang in batch.column("lang").to_pylist()]
            yield _batch(lang=batch.column("lang"), high=[int(k[0][0]) for k in keys], low=pa.array([int(k[1][0]) for k in keys], pa.int32()))

    langs = docs.select("lang").distinct().mapInArrow(made, "lang string, high long, low int")
    return langs.join(frequent.where(_length(0)), KEY).select("lang", F.col("f").alias("n"))


def scored(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """Rows (high, low, a, l, r, score) at the lowest-scoring cut, without phrases that a longer one explains."""
    part = {"high": "part_high", "low": "part_low", "f": "part_f"}
    counts = sized(frequent.select(*[F.col(a).alias(b) for a, b in part.items()]))
    inside = written(parts(phrases), "parts")
    sizes = F.col("low").bitwiseAND(7)
    ends = inside.where((F.col("first") == 0) | (F.col("stop") == sizes)).join(counts, ["part_high", "part_low"])
    cut = F.when(F.col("first") == 0, F.col("stop")).otherwise(F.col("first"))
    cuts = ends.groupBy(*KEY, "f", cut.alias("cut")).agg(
        F.max(F.when(F.col("first") == 0, F.col("part_f"))).alias("l"), F.max(F.when(F.col("first") > 0, F.col("part_f"))).alias("r")
    )
    score = F.expr("cast((cast(2000000 as decimal(10, 0)) * cast(f as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) as long)")
    best = cuts.groupBy(*KEY, F.col("f").alias("a")).agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    longer = inside.where(F.col("stop") - F.col("first") >= 2).groupBy("part_high", "part_low").agg(F.max("f").alias("above"))
    longer = longer.select(F.col("part_high").alias("high"), F.col("part_low").alias("low"), "above")
    kept = best.join(longer, KEY, "left").where("above is null or cast(100 as decimal(3, 0)) * above < cast(80 as decimal(3, 0)) * a")
    return kept.select(*KEY, "a", "best.l", "best.r", "best.score")


def ranked(rows: DataFrame, by: str, order: list, top: int) -> DataFrame:
    """`rows` with their `rank` (from 1) within `by`, up to `top`: sorted by ranges, groups span tasks."""
    sort = [F.col(by), *order]
    dealt = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = written(dealt.withColumns({"part": F.spark_partition_id(), "line": F.monotonically_increasing_id()}), "sorted")
    starts = dealt.groupBy("part", by).agg(F.min("line").alias("from"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).where(F.col("before") < top)
    placed = dealt.join(sized(starts.drop("rows")), ["part", by])
    placed = placed.withColumn("rank", F.col("line") - F.col("from") + F.col("before") + 1)
    return placed.where(F.col("rank") <= top).drop("part", "line", "from", "before")


def mine_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, top: int = 2000) -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to 4 words.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends and into words at spaces and
    tabs. A phrase occurs a times, within pieces, overlaps included, `least` times or more. Cut after
    k words it scores floor(2000000 a / (l + r)), l and r being how often its two parts occur; the
    lowest-scoring cut counts, of equal ones that after the fewest words. Phrases inside a longer one
    that occurs 0.8 times as often or more are dropped. Order: score, then a, descending, then the
    phrase's bytes; n counts the language's words.

    Null texts are empty, a null language is `und`. Repeated rows count each for itself. Empty tables,
    and languages without a frequent phrase, give no rows. Texts of any length are read whole. Only the
    two columns named are read, so others cannot clash.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text")
    ).where(F.col("text").isNotNull())
    with small_batches(docs.sparkSession):
        return _mined(rows, least, top)


def _mined(rows: DataFrame, least: int, top: int) -> DataFrame:
    """`mine_phrases` for rows (lang, text) without nulls."""
    sample = written(rows.where(F.expr(f"pmod(xxhash64(text), {SAMPLE_EVERY}) = 0")), "sample")
    frequent = frequent_phrases(rows, sample, least)
    wanted = frequent.where(F.col("low").bitwiseAND(7) >= 2)
    phrases = written(named(sample, wanted), "named")
    rest = written(wanted.join(sized(phrases.select(*KEY)), KEY, "left_anti"), "unnamed")
    if rest.limit(1).count():
        phrases = phrases.unionByName(written(named(rows, rest), "named"))
    best = scored(phrases, frequent).join(phrases.select(*KEY, "lang", "phrase"), KEY)
    top_rows = ranked(best.drop(*KEY), "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], top)
    return top_rows.join(sized(totals(rows, frequent)), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
