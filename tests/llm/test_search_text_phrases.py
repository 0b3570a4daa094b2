"""Lexical search, main text of pages and phrase mining beside brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import PLAIN, clashing, prose, rows
from pyspark.sql import functions as F

from tidemark.llm import html_text, lexical_search, phrase_mining
from tidemark.llm.html_text import extract_text, main_text
from tidemark.llm.lexical_search import search
from tidemark.llm.phrase_keys import Chunk, Filter, part_keys
from tidemark.llm.phrase_mining import mine_phrases

# -- ranked search --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def brute_search(data, items, top):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in data if terms(t)]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    wanted: dict = defaultdict(list)
    for item, text in set(items):
        if item is not None:
            wanted[item] += terms(text)
    out = []
    for item, query in wanted.items():
        found = []
        for i, bag, n in bags:
            m = 25 + 75 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in query if t in bag
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    data = [(i, t) for i, t, *_ in rows()]
    base = prose(rng, 30)
    for i in range(20, 140):  # copies in two lengths, texts that differ in words no item has, and tied scores
        other = " ".join("zz" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(10))
        data.append((i, f"{base} {other}" if i % 3 else prose(rng, 25, "abc")))
    return data + data[-5:]


ITEMS = [(1, "AB ba cab, cab."), (1, "AB ba cab, cab."), (2, None), (3, "--- !"), (None, "ab"), (4, "日本語 ß word"), (5, "bac")]


@pytest.mark.parametrize(("postings", "cells"), [(400_000, 4_000_000), (12, 64)])
def test_search_equals_brute_force(spark, corpus, monkeypatch, postings, cells):
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", postings)  # 12: several blocks; 64 cells: many slices of classes
    monkeypatch.setattr(lexical_search, "SCORE_CELLS", cells)
    items = [*ITEMS, (6, corpus[20][1]), (7, prose(random.Random(7), 12))]
    docs = clashing(spark.createDataFrame(corpus, "doc_id long, text string").repartition(5))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({"term": F.lit(1), "block": F.lit(1)})
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in search(docs, asked).collect()), key=repr)
    assert got == brute_search(corpus, items, 10)
    assert {g[0] for g in got} >= {1, 4, 6, 7}


def test_search_of_empty_tables(spark, corpus):
    docs, asked = spark.createDataFrame(corpus, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    for d, i in ((docs.limit(0), asked), (docs, asked.limit(0)), (docs.where("text is null"), asked)):
        out = search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_classes_are_scored_once(spark, monkeypatch):
    scored = []
    whole = lexical_search.class_scores
    monkeypatch.setattr(lexical_search, "class_scores", lambda classes, *a: scored.append(classes.count()) or whole(classes, *a))
    docs = spark.createDataFrame([(i, f"ab ba w{i % 7}" if i < 300 else "zz") for i in range(700)], "doc_id long, text string")
    got = search(docs, spark.createDataFrame([(1, "ba")], "item_id long, text string")).orderBy("rank").collect()
    assert scored == [1] and [r.doc_id for r in got] == list(range(10))


# -- main text of pages ---------------------------------------------------------------------

ARTICLE = ["A heading", "First words, of a text; with marks.", "Short.", "“Quoted” & more text, to the end.", "one", "two"]
INNER = (
    "<h1>A heading</h1><p>First <b>words</b>, of\n a&nbsp;text; with <a href='#'>marks</a>.<p>Short.<div>&ldquo;Quoted&rdquo; &amp; more<br>text, to the end.</div>"
    "<ul><li>one<li>two</ul>"
)
AROUND = [
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a href=1>Home</a></nav>",
    "<header><h1>Site</h1><p>Slogan, of a site.</p></header><div class='cookie-notice'>We use cookies, a lot of them. Agree?</div>",
    "<!-- <p>no</p> --><div id='topAds'>Buy this, now, and that.</div><aside>Also of note, here.</aside><form><label>Name, please.</label></form>",
]
AFTER = "<section class='comments'><article><p>I read it, and I disagree. Very much.</p></article></section><footer>&copy; site, all rights.</footer></body></html>"


@pytest.mark.parametrize("body", ["<article>{}</article>", "<main>{}</main>", "<div class='site-header'><div role='main'></div><article>{}</article></div>", "<div class='text'>{}</div>"])
def test_main_text_is_the_article(body):
    assert main_text("".join(AROUND) + body.format(INNER) + AFTER).split("\n\n") == ARTICLE


def test_paths_with_little_text_are_left_out():
    strips = "".join(f"<div class='strip'><p>Tag {k}</p></div>" for k in range(6))
    body = "".join(f"<p>{prose(random.Random(k), 40)}, and so on. {'Yes.' * (k % 2)}</p>" for k in range(8))
    kept = main_text(f"{strips}<div class='box'><h2>Title</h2>{body}<p>Ok.</p></div><ul class='list'><li><a href=1>One link</a><li><a href=2>Other</a></ul>{strips}")
    assert kept.split("\n\n")[0] == "Title" and kept.split("\n\n")[-1] == "Ok." and len(kept.split("\n\n")) == 10 and "Tag" not in kept and "link" not in kept


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (None, ""), ("", ""), (" \n", ""), ("plain &lt;text&gt; &#233;&#x20AC; &amp", "plain <text> é€ &"), ("<p>a<script>1</script>b<style>", "ab"),
        ("<p title='a>b'>x</p><p hidden>y</p>", "x"), ("<article><p>cut <b>off<br>he", "cut off he"), ("<p>a < b <3 c", "a < b <3 c"), ("<!-- open <p>x", ""),
        ("<script>never ended <p>x", ""), ("<SCRIPT>x</Script ><P>y", "y"), ("İİ<script>x</script>z", "İİz"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ("<nav><p>menu, words.</p></nav>", ""), ("<article><p>a</p><article><p>reply, of a reader</p></article></article>", "a"),
    ],
)
def test_main_text_of_odd_pages(html, want):
    assert main_text(html) == want


def test_long_pages_take_time_in_proportion():
    for piece in ("<div>", "<a ", "<p title=\"", "<p>x", "</b>", "<!-- ", "&#", "<td><li>"):
        main_text(piece * 60_000)


def test_extract_text_of_a_table(spark):
    data = [(1, "u", "<p>a, b.</p>", "x"), (1, "u", "<p>a, b.</p>", "x"), (None, None, None, None), (2, "v", "<p>\U0001f642 é</p>" + "<p>long</p>" * 50_000, "y")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, main_text string").withColumn("N_chars", F.lit("z"))
    got = sorted(extract_text(pages).collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert got[0].asDict() == {"page_id": 1, "url": "u", "main_text": "x", "text": "a, b.", "n_chars": 5} and got[1] == got[0]
    assert got[2].n_chars == 3 + 50_000 * 6 and got[3].text == "" and got[3].n_chars == 0
    assert extract_text(pages.limit(0)).count() == 0


def test_smoothing_keeps_a_constant():
    assert np.allclose(html_text._smooth(np.full(9, 3.0)), 3.0) and np.allclose(html_text._smooth(np.array([2.0])), 2.0)


# -- phrase mining --------------------------------------------------------------------------


def brute_phrases(data, least, top):
    f: dict = defaultdict(Counter)
    for lang, text in data:
        low = re.sub("[A-Z]", lambda c: c.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside: Counter = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        best = []
        for p, a in cand.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def phrase_corpus():
    rng = random.Random(3)
    data = [(lang, text) for _, text, lang, *_ in rows()]
    for i in range(260):
        lang = ("en", "en", "de", None)[i % 4]
        words = [rng.choice("ab cd ef gh ij kl".split()) for _ in range(40)]
        words[rng.randrange(20)] += rng.choice(",.;\n!")
        data.append((lang, " ".join(words) + (" new york city hall" if i % 2 else " New\tYork city park") + " né à côté" * (i % 3 == 0)))
    # A phrase in few documents, which a sample of documents is likely to lack.
    data.append(("en", "rare pair of words. " * 40))
    return data + data[:3]


@pytest.mark.parametrize(("every", "lowered"), [(4, 0.2), (1000, 0.5), (8, 50.0)])
def test_phrases_equal_brute_force(spark, monkeypatch, every, lowered):
    """1000: an empty sample, and 50: too few proposals, so that border failures take several passes."""
    monkeypatch.setattr(phrase_mining, "SAMPLE_EVERY", every)
    monkeypatch.setattr(phrase_mining, "LOWERED", lowered)
    passes = []
    whole = phrase_mining.further
    monkeypatch.setattr(phrase_mining, "further", lambda *a: passes.append(1) or whole(*a))
    data = phrase_corpus()
    docs = clashing(spark.createDataFrame(data, "lang string, text string").repartition(5))
    got = sorted(tuple(r) for r in mine_phrases(docs, top=40).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = brute_phrases(data, 30, 40)
    assert got == want and {r[0] for r in want} == {"en", "de", "und"} and any("rare" in r[2] for r in want)
    assert every < 1000 or len(passes) >= 2


def test_phrases_of_empty_tables_and_rare_words(spark):
    docs = spark.createDataFrame(rows(), PLAIN)
    assert mine_phrases(docs.limit(0)).count() == 0
    assert mine_phrases(docs.where("text is null or text = ''")).count() == 0
    assert mine_phrases(docs.where("doc_id = 7")).count() == 0


def test_keys_of_parts_are_those_of_the_phrases():
    chunk = Chunk("en", [b"One two three four. FIVE six"])
    at = np.array([0])
    for (first, stop), (high, low) in part_keys("en", ["one two three four"], 4).items():
        other = Chunk("en", [b"x " * first + b"one two three four"])
        want = other.keys(stop - first, at + 2 * first)
        assert (high[0], low[0]) == (want[0][0], want[1][0])
    assert chunk.keys(4, at)[0] != Chunk("de", [b"one two three four"]).keys(4, at)[0]
    assert [np.flatnonzero(b).tolist() for (b,) in chunk.begins([{}]).values()] == [[0, 1, 2, 5], [0, 1], [0]]


def test_filter_misses_no_key(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    made = phrase_mining.filter_of(spark.createDataFrame([(int(k),) for k in keys], "high long"))
    assert isinstance(made, Filter) and made.has(keys).all() and made.has(keys + 1).mean() < 0.05
