from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edge import PLAIN, clashing, prose, rows
from tidemark.llm import decontamination, line_dedup, quality_rules, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), PLAIN)


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(grams)
    hit = {j for i, g in enumerate(grams) if twice[g] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_base_counts_equal_brute_force(spark, docs):
    rng = random.Random(1)
    more = [(100 + i, prose(rng, rng.randint(0, 60), "ab") + "\nx\nx", "en", "a", 1) for i in range(40)]
    got = quality_rules.base_counts(clashing(docs.union(spark.createDataFrame(more, PLAIN)))).collect()
    assert len(got) == len(rows()) + 40
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_counts(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_order_of_rules_changes_no_verdict(docs):
    forward = quality_rules.cascade(clashing(docs), order=list(quality_rules.DEFAULT_RULES))
    backward = quality_rules.cascade(docs, order=list(quality_rules.DEFAULT_RULES)[::-1])
    key = lambda df: sorted((str(r.doc_id), str(r.text), r.kept) for r in df.collect())
    assert key(forward) == key(backward)
    assert {r.rejected_by for r in backward.where("doc_id = 3").collect()} & {r.name for r in quality_rules.DEFAULT_RULES}


def test_cheap_strong_rules_come_first(docs):
    order = quality_rules.rule_order(docs, quality_rules.DEFAULT_RULES)
    assert {r.name for r in order} == {r.name for r in quality_rules.DEFAULT_RULES}
    assert order[-1].name != "few_words"  # it rejects something, "many_words" does not
    assert quality_rules.cascade(docs.limit(0)).count() == 0


def test_boilerplate_lines_go(spark):
    data = [(i, f"own line {i}\nshared line\n\nend {i}", "en", "a", 1) for i in range(20)]
    data += [(50 + i, "shared line", "en", None, 1) for i in range(3)] + [(60, None, "en", "a", 0), (61, "", "en", "a", 0)]
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(clashing(spark.createDataFrame(data, PLAIN)), "source").collect()}
    assert len(got) == len(data)
    assert got[3].text == "own line 3\n\nend 3" and (got[3].n_lines, got[3].n_dropped) == (3, 1)
    assert got[51].text == "shared line"  # three pages are too few
    assert got[60].text is None and got[60].n_lines == 0 and got[61].text == ""


def test_line_dedup_edge_rows(docs):
    got = line_dedup.drop_boilerplate(clashing(docs), "source", max_ratio=0.5, min_pages=2)
    assert got.count() == len(rows())
    assert line_dedup.drop_boilerplate(docs.limit(0), "source").count() == 0


def test_url_lists_in_force(spark):
    events = spark.createDataFrame(
        [("bad.com", 10, True), ("bad.com", 20, False), ("bad.com", 30, True), ("bad.com", 30, False), ("ok.org/ads", 5, True),
         ("ok.org/ads", 7, True), (None, 1, True), ("x.y", None, True), ("ok.org", 50, True)],
        "pattern string, at int, listed boolean",
    )
    spans = {(r.pattern, r.valid_from, r.valid_to) for r in url_filter.intervals(events).collect()}
    assert spans == {("bad.com", 10, 20), ("bad.com", 30, None), ("ok.org/ads", 5, None), ("ok.org", 50, None)}
    captures = spark.createDataFrame(
        [(1, "http://www.bad.com/x", 10), (2, "http://bad.com", 20), (3, "https://BAD.com:80/", 31), (4, "http://notbad.com/", 15),
         (5, "http://a.ok.org/ads/1?q", 6), (6, "http://ok.org/adsense", 6), (7, None, 6), (8, "http://bad.com/", None), (9, "no url", 9),
         (1, "http://www.bad.com/x", 10), (10, "http://ok.org/ads", 60), (None, "http://bad.com", 11)],
        "page_id int, url string, fetched_at int",
    ).withColumns({c: F.lit(1) for c in ("key", "ks", "pattern", "blocked", "best", "fetched")})
    got = {r.page_id: (r.blocked, r.n_active, r.pattern, r.listed_since) for r in url_filter.filter_urls(captures, events, "page_id").collect()}
    assert got == {
        1: (True, 2, "bad.com", 10), 2: (False, 0, None, None), 3: (True, 1, "bad.com", 30), 4: (False, 0, None, None),
        5: (True, 1, "ok.org/ads", 5), 6: (False, 0, None, None), 7: (False, 0, None, None), 8: (False, 0, None, None),
        9: (False, 0, None, None), 10: (True, 2, "ok.org/ads", 5), None: (True, 1, "bad.com", 10),
    }
    assert url_filter.filter_urls(captures.limit(0), events, "page_id").count() == 0
    assert url_filter.filter_urls(captures, events.limit(0), "page_id").where("blocked").count() == 0


def test_url_entries_of_many_segments_match(spark):
    events = spark.createDataFrame([("x.org/a/b/c/d", 1, True), (None, 1, True)], "pattern string, at int, listed boolean")
    captures = spark.createDataFrame(
        [(1, "http://www.x.org/a/b/c/d/e", 2), (2, "http://x.org/a/b/c/de", 2), (3, "http://x.org/a/b/c", 2)], "page_id int, url string, fetched_at int"
    )
    got = {r.page_id: r.pattern for r in url_filter.filter_urls(captures, events, "page_id").collect()}
    assert got == {1: "x.org/a/b/c/d", 2: None, 3: None}


def test_benchmark_passages_are_found(spark, docs):
    rng = random.Random(9)
    items = [(i, prose(rng, n, "klmnop")) for i, n in enumerate((40, 40, 30, 8, 3, 60))] + [(50, None), (51, ""), (None, "a b c d e f")]
    texts = dict(items)
    changed = texts[5].split()
    changed[58] = "zzz"
    planted = [
        (20, prose(rng, 80) + " " + texts[0].upper() + " " + prose(rng, 30), "en", "a", 1),
        (21, texts[3], "en", "a", 1), (22, prose(rng, 5) + "\n" + texts[4], "en", "a", 1),
        (23, " ".join(changed), "en", "a", 1), (24, " ".join(texts[2].split()[:15]), "en", "a", 1),
        (25, texts[1] + " " + texts[1], "en", "a", 1), (25, texts[1], "en", "a", 1),
    ]
    all_docs = clashing(docs.union(spark.createDataFrame(planted, PLAIN)))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit(0) for c in ("n", "k", "item", "iw", "h")})
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(all_docs, bench).collect()}
    assert set(got) == {(20, 0), (21, 3), (22, 4), (23, 5), (25, 1)}
    assert got[20, 0].similarity == 1.0 and got[20, 0].first_word == 80
    assert 0.8 <= got[23, 5].similarity < 1
    assert got[25, 1].n_windows == 2
    left = decontamination.without_contaminated(all_docs, bench)
    assert left.count() == len(rows()) + 1 and left.columns == all_docs.columns
    assert decontamination.contaminated(all_docs.limit(0), bench).count() == 0
    assert decontamination.contaminated(all_docs, bench.limit(0)).count() == 0


def test_simhash_blocks_find_all_within_radius(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(200):
        a = [rng.getrandbits(64) - (1 << 63) for _ in range(2)]
        b = list(a)
        for bit in rng.sample(range(128), rng.randint(0, 31)):
            b[bit // 64] = (b[bit // 64] ^ (1 << bit % 64) if bit % 64 < 63 else b[bit // 64] ^ -(1 << 63))
        pairs.append((*a, *b))
    df = spark.createDataFrame(pairs, "alow long, ahigh long, blow long, bhigh long")
    same = F.size(F.filter(
        F.zip_with(decontamination._blocks(F.col("alow"), F.col("ahigh")), decontamination._blocks(F.col("blow"), F.col("bhigh")), lambda x, y: x == y),
        lambda z: z))
    out = df.select(same.alias("same"), decontamination._distance("a", "b").alias("d")).collect()
    assert all(r.same >= 1 and r.d <= 31 for r in out)
