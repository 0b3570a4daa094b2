"""Rows that every operator must survive: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(5)
    base = prose(rng, 120)
    out = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \n\t ", "de", "a", 4),
        (None, base, "en", None, 1),
        (6, base.replace(" ", "\n", 40) + " ÄÖ ß 日本語 🙂", "de", "b", 1),
        (7, prose(rng, 6000), "fr", "b", 1),
        (8, "word", "en", None, 4),
        (9, base[:300] + " " + prose(rng, 90), "en", "a", 1),
        (10, "#*$%&|<> " * 60, "en", "a", 1),
    ]
    return out


# One extra column for every name that an operator makes.
CLASHING = [
    "kept", "rejected_by", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "words",
    "verdict", "n_lines", "n_dropped", "site", "drop", "host", "key", "pages", "total", "n_bytes", "n_tokens", "over_limit",
    "lang_pred", "score", "judged", "ids", "decoded", "round_trip", "id", "size", "d1", "d2", "part", "leader", "component",
    "fold", "chunk", "bucket", "h", "p", "q", "n", "k", "start", "bag", "w", "item", "gone", "again", "spans",
]


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in CLASHING})
