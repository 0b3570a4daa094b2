"""Main text of web pages by tag-path ratios.

Every text block has the path of its elements from the root, class words included. Text length and
punctuation are added up per path and divided by the blocks of the path, so a short paragraph counts
as much as its long sisters. The two ratios are smoothed along the page, fused by multiplication and
cut at a share of their spread; what passes is the core of the text. Menus, page headers and footers,
sidebars, notices, adverts, forms and comments are taken out before by element, role and class word.
Blocks between those of the core, headings before it, and lists, tables and headings in the elements
that hold it belong to it; paths that are mostly links do not. Where a page names its article, all of
that is its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.page_blocks import HEADINGS, Element, PageReader
from tidemark.llm.textcols import free_name

KERNEL = (0.06, 0.24, 0.4, 0.24, 0.06)  # Gaussian over neighbours in page order
SPREAD_SHARE = 0.5  # a path passes at this share of the fused ratio's standard deviation
LINK_SHARE = 0.5  # paths with more of their text in links are menus
COMPANIONS = HEADINGS | frozenset("li dt dd td th pre blockquote figcaption caption".split())
STRUCTURE = frozenset("ul ol dl table tbody thead tfoot tr figure li dd".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？«»\"'()“”]+")


def _smooth(x: np.ndarray) -> np.ndarray:
    half = len(KERNEL) // 2
    weight = np.convolve(np.ones(len(x)), KERNEL)[half : half + len(x)]
    return np.convolve(x, KERNEL)[half : half + len(x)] / weight


def core_blocks(paths: np.ndarray, chars: np.ndarray, linked: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per block whether its path passes the fused ratio, and whether its path is mostly links."""
    _, path = np.unique(paths, return_inverse=True)
    blocks = np.bincount(path)
    plain = np.bincount(path, np.maximum(chars - linked, 0))
    links = np.bincount(path, linked) > LINK_SHARE * np.maximum(np.bincount(path, chars), 1)
    text_ratio = np.where(links, 0.0, plain / blocks)
    mark_ratio = np.where(links, 0.0, np.bincount(path, marks) / blocks)
    fused = _smooth(text_ratio[path]) * (1 + _smooth(mark_ratio[path]))
    mean = np.bincount(path, fused) / blocks
    # A path is judged by its smoothed mean, but smoothing alone cannot lift one without text of its own.
    passed = (mean >= SPREAD_SHARE * fused.std()) & (text_ratio * (1 + mark_ratio) >= SPREAD_SHARE * fused.std())
    return passed[path] & ~links[path], links[path]


def _out(element: Element) -> bool:
    """Whether a block of `element` is outside the main text by name, role or class word.

    Of the header of an article its headings stay.
    """
    if element.gone or element.readers:
        return True
    heading, at = element.tag in HEADINGS, element
    while at is not None:
        if at.marked and not (heading and at.heads and at.scope):
            return True
        at = at.parent
    return False


def _beside(element: Element, containers: set[int]) -> bool:
    """Whether the block is a list item, cell, heading or the like in an element that holds blocks of the core."""
    if element.tag not in COMPANIONS:
        return False
    above = element.parent
    while above is not None and above.parent is not None:  # the root holds everything
        if id(above) in containers:
            return True
        above = above.parent if above.tag in STRUCTURE else None
    return False


def main_text(html: str | None) -> str:
    """The blocks of the main text, white space made single, joined by empty lines."""
    if not html:
        return ""
    verdict: dict[int, bool] = {}
    kept: list[tuple[Element, str, int]] = []
    for block in PageReader(html).blocks:
        element = block.element
        if id(element) not in verdict:
            verdict[id(element)] = _out(element)
        text = "" if verdict[id(element)] else " ".join("".join(block.parts).split())
        if text:
            inside = "".join(p for p, link in zip(block.parts, block.linked) if link)
            kept.append((element, text, min(len(text), len(" ".join(inside.split())))))
    for scope in ("article", "main"):
        if any(e.scope == scope for e, _, _ in kept):
            kept = [k for k in kept if k[0].scope == scope]
            break
    if not kept:
        return ""
    chars = np.array([len(t) for _, t, _ in kept], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for _, t, _ in kept], float)
    core, links = core_blocks(np.array([e.path for e, _, _ in kept]), chars, np.array([n for _, _, n in kept], float), marks)
    if kept[0][0].scope:  # inside an article all that is no menu is its text
        chosen = ~links
    else:
        chosen = core.copy()
        at = np.flatnonzero(core)
        if len(at):
            first = at[0]
            while first and kept[first - 1][0].tag in HEADINGS and not links[first - 1]:
                first -= 1
            containers = {id(kept[k][0].parent) for k in at if kept[k][0].parent is not None}
            for k in range(len(kept)):
                element = kept[k][0]
                near = first <= k < at[0] or (at[0] < k < at[-1] and (id(element.parent) in containers or element.tag in HEADINGS))
                chosen[k] |= (near or _beside(element, containers)) and not links[k]
    return "\n\n".join(text for (_, text, _), keep in zip(kept, chosen) if keep)


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """`pages` without its column `html`, with `text` (empty if there is none) and n_chars, its code points.

    Null and empty pages have an empty text, as have pages of nothing but menus, forms or scripts.
    Pages may be cut off anywhere and of any length; the whole page is read. Repeated rows are read
    each for itself, ties cannot arise, an empty table gives an empty result. Columns of `pages` that
    are named like the two new ones are replaced; all others pass through.
    """

    @F.pandas_udf("string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text, na_action=None)

    made = free_name(pages, "main_text")
    taken = {html.lower(), text.lower(), "n_chars"}
    others = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in taken]
    return pages.withColumn(made, read(F.col(f"`{html}`").cast("string"))).select(
        *others, F.col(made).alias(text), F.length(made).cast("long").alias("n_chars")
    )
