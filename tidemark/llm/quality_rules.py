"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a name, a predicate that is true for a text to reject, and the counts it needs. The
cascade asks the rules one after another and stops at the first that rejects; the order is the
one with most rejections per unit of cost, both estimated on a sample of the rows. The order
changes the work and the name in `rejected_by`, never which rows are kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textcols import SPACE, free_name, words
from tidemark.sizing import shared_dir

SAMPLE_ROWS = 2_000
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """`rejects` is built from a column of the text and a column of its words."""

    name: str
    rejects: object  # Callable[[Column, Column], Column]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def symbol_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = lines_with_words(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def windows(tokens: Column, n: int) -> Column:
    """The windows of `n` words, joined by spaces (which no word holds)."""
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + (k - 1)) for k in range(n)])
    )


def repeated_window_words(tokens: Column, n: int = 3) -> Column:
    """Words inside `n`-word windows that the text has twice or more.

    Windows are sorted with their places, so equal ones are neighbours; the places of those with
    an equal neighbour, in order, each add the words up to the next such place, `n` at most.
    """
    placed = F.array_sort(F.transform(windows(tokens, n), lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def with_twin(x: Column, k: Column, rows: Column) -> Column:
        before, after = F.get(rows, k - 1)["w"] == x["w"], F.get(rows, k + 1)["w"] == x["w"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    def places(rows: Column) -> Column:
        return F.array_sort(F.transform(F.filter(rows, lambda x, k: with_twin(x, k, rows)), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        # From one place to the next, plus a whole window at the last one.
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(n), i - acc["last"])).cast("long").alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    # One-element transforms give the sorted arrays a name, so each is computed once per row.
    return F.coalesce(
        F.element_at(F.transform(F.array(placed), lambda rows: covered(places(rows))), 1), F.lit(0).cast("long")
    )


DEFAULT_RULES = (
    Rule("few_words", lambda text, w: F.size(w) < 50),
    Rule("many_words", lambda text, w: F.size(w) > 1_000_000),
    Rule("word_length", lambda text, w: ~_share(word_chars(text), F.size(w)).between(2.0, 15.0)),
    Rule("symbols", lambda text, w: _share(symbol_count(text), F.size(w)) > 0.1),
    Rule("duplicate_lines", lambda text, w: _share(duplicate_lines(text), F.size(lines_with_words(text))) > 0.3),
    Rule("few_letters", lambda text, w: _share(F.regexp_count(text, F.lit(r"\p{L}")), word_chars(text)) < 0.6),
    Rule("shouting", lambda text, w: _share(F.regexp_count(text, F.lit(r"\p{Lu}")), word_chars(text)) > 0.5),
    Rule("repetition", lambda text, w: 2 * repeated_window_words(w) > F.size(w)),
)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on a sample of at most `sample_rows` rows, best first.

    The sample is written once to the shared folder, so timing a rule does not read the input
    again. Rules that reject nothing come last, cheapest first.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "rule-sample")
    docs.limit(sample_rows).write.parquet(path)
    sample = spark.read.parquet(path)
    tokens = free_name(sample, "words")
    body = F.col(f"`{text}`").cast("string")
    sample = sample.withColumn(tokens, words(body))
    scored = []
    for place, rule in enumerate(rules):
        began = time.perf_counter()
        rejects = F.coalesce(rule.rejects(body, F.col(tokens)), F.lit(False))
        hits = sample.agg(F.count_if(rejects).alias("n")).first()["n"]
        cost = max(time.perf_counter() - began, 1e-6)
        scored.append((-hits / cost, cost, place, rule))
    return [rule for *_, rule in sorted(scored, key=lambda x: x[:3])]


def cascade(
    docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text: str = "text", order: list[Rule] | None = None
) -> DataFrame:
    """`docs` with `kept` and `rejected_by` (the first rule of the cascade that rejects; null if kept).

    Nulls and empty texts have no words and are rejected by `few_words`; a rule that gives null
    does not reject. Repeated rows are judged one by one; an empty table gives an empty result.
    Columns of `docs` called `kept` or `rejected_by` give way to the new ones.
    """
    order = rule_order(docs, tuple(rules), text) if order is None else order
    tokens, verdict = free_name(docs, "words"), free_name(docs, "verdict")
    body = F.col(f"`{text}`").cast("string")
    with_words = docs.withColumn(tokens, words(body))
    chain = reduce(
        lambda c, rule: c.when(rule.rejects(body, F.col(tokens)), F.lit(rule.name)),
        order[1:],
        F.when(order[0].rejects(body, F.col(tokens)), F.lit(order[0].name)),
    ) if order else F.lit(None).cast("string")
    judged = with_words.withColumn(verdict, chain).drop(tokens, "kept", "rejected_by")
    return judged.withColumns({"kept": F.col(verdict).isNull(), "rejected_by": F.col(verdict)}).drop(verdict)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    tokens = free_name(docs, "words")
    body, w = F.col(f"`{text}`").cast("string"), F.col(tokens)
    counted = docs.withColumn(tokens, words(body)).withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": word_chars(body),
            "n_symbols": symbol_count(body),
            "n_dup_lines": duplicate_lines(body),
            "n_repeat_words": repeated_window_words(w),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.drop(tokens).withColumn("base_failed", failed)
