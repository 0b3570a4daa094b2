"""All training-data queries with their check SQL."""

from tidemark.llm import q_benchmark, q_html, q_jaccard, q_language, q_lines, q_lm, q_phrases, q_pieces, q_quality, q_search, q_suffixes, q_tokens, q_urls  # noqa: F401
from tidemark.llm.registry import ORACLES, QUERIES  # noqa: F401
