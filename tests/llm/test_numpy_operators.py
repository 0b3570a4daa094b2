from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pytest
from edge import PLAIN, clashing, prose, rows
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, language_id, lm_scoring, suffix_dedup
from tidemark.llm.components import components
from tidemark.llm.induced_sorting import suffix_array
from tidemark.llm.packing import edges, pack, pack_numbers, unpack, unpack_numbers
from tidemark.llm.prefix_trie import build, matches
from tidemark.llm.sentence_pieces import SPACE_MARK, Pieces, encode, encoded
from tidemark.llm.token_counts import TokenCounter, count_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), PLAIN)


# -- packing and suffix sorting -------------------------------------------------------------


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert (unpack(pack(keys)) == keys).all()
        small = rng.integers(0, 300, n).astype(np.uint64)
        assert (unpack_numbers(pack_numbers(small)) == small).all()
    keys = np.sort(rng.integers(0, 1 << 63, 500, dtype=np.uint64))
    for buckets in (1, 2, 7):
        at = edges(keys, buckets, 63)
        assert at[0] == 0 and at[-1] == 500 and len(at) == buckets + 1 and (np.diff(at) >= 0).all()


def brute_suffixes(t, cap):
    order = sorted(range(len(t)), key=lambda i: t[i:])
    lcp = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while k < cap and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        lcp.append(k)
    return order, lcp


@pytest.mark.parametrize("in_memory", [2, 7, 1 << 20])  # 2 and 7 force recursion and queues on disk
def test_induced_sorting_equals_brute_force(in_memory):
    rng = np.random.default_rng(in_memory)
    for k in range(250):
        t = rng.integers(0, int(rng.integers(1, 6)), int(rng.integers(1, 70)))
        if k % 3 == 0:
            t = np.tile(t[: max(1, len(t) // 4)], 5)
        cap = int(rng.choice([3, 50, 1000]))
        order, lcp = suffix_array(t, cap, in_memory)
        want = brute_suffixes(t.tolist(), cap)
        assert (order.tolist(), lcp.tolist()) == want
    assert len(suffix_array(np.zeros(0))[0]) == 0


def brute_repeats(data, length):
    first: dict[bytes, int] = {}
    bodies = [(i, (t or "").encode()) for i, t in data]
    for i, b in bodies:
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1) if i is not None else ():
            if first[b[k : k + length]] < i:
                gone[k : k + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        out.append((i, len(b), list(zip(edge[::2].tolist(), edge[1::2].tolist())), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=str)


@pytest.mark.parametrize("scale", ["one chunk", "many chunks"])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, scale):
    rng = random.Random(3)
    pool = [prose(rng, rng.randint(5, 40)) for _ in range(8)]
    data = [(i, " ".join(rng.sample(pool, 2) + [prose(rng, 20)])) for i in range(60)] + [(i, t) for i, t, *_ in rows() if i != 7]
    data += [(200, "aaaa" * 200), (201, "aaaa" * 100), (202, "ab" * 49), (203, "x" * 49), (204, "x" * 50), (205, "x" * 50)]
    if scale == "many chunks":
        for name, value in (("CHUNK_BYTES", 3000), ("PIECE_BYTES", 700), ("SHARD_BYTES", 4000), ("BUCKET_ANCHORS", 100), ("FLUSH_BYTES", 5000)):
            monkeypatch.setattr(suffix_dedup, name, value)
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    got = suffix_dedup.remove_repeats(df, in_memory=500).collect()
    got = sorted([(r.doc_id, r.n_bytes, [(s["from"], s["to"]) for s in r.spans], bytes(r.kept)) for r in got], key=str)
    assert got == brute_repeats(data, 50)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [False, True])
def test_segments_of_a_hot_anchor_are_spread_over_shards(spark, monkeypatch, copies):
    for name, value in (("CHUNK_BYTES", 3000), ("PIECE_BYTES", 700), ("SHARD_BYTES", 4000), ("BUCKET_ANCHORS", 100), ("FLUSH_BYTES", 5000), ("SPREAD", 16)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    rng = random.Random(8)
    passage = prose(rng, 20)
    around = [prose(rng, 6), prose(rng, 6)]
    data = [(i, " ".join([around[0], passage, around[1]] if copies else [prose(rng, 6), passage, prose(rng, 6)])) for i in range(600)]
    largest, sort = [], suffix_dedup.sorted_shards

    def watched(sent_rows, *args):
        largest.append(sent_rows.groupBy("shard").agg(F.sum(F.length("body")).alias("n")).agg(F.max("n")).first()[0])
        return sort(sent_rows, *args)

    monkeypatch.setattr(suffix_dedup, "sorted_shards", watched)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(data, "doc_id long, text string")).collect()
    got = sorted([(r.doc_id, r.n_bytes, [(s["from"], s["to"]) for s in r.spans], bytes(r.kept)) for r in got], key=str)
    assert got == brute_repeats(data, 50)
    assert copies or largest[0] < 5 * 4000


def test_rows_of_anchors_do_not_grow_with_chunks_times_buckets(spark):
    """A task sends a row a bucket for all chunks that it met, and the chunks get the same anchors as alone."""
    rng = random.Random(5)
    passage = prose(rng, 30)
    data = [(i, " ".join([prose(rng, 10), passage, prose(rng, 10)]), i % 40) for i in range(120)]
    docs = spark.createDataFrame(data, "id long, text string, chunk long").coalesce(1)
    found = suffix_dedup.asked(docs, 8, 50)
    assert found.count() == 8
    of_chunk = {}
    for r in suffix_dedup.shared_anchors(found).collect():
        of_chunk.setdefault(r.chunk, []).append(suffix_dedup.unpack(bytes(r["keys"])))
    met = {}
    for i, text, chunk in data:
        for h in next(suffix_dedup.joined([i], [text], 50)).hash.tolist():
            met.setdefault(h, set()).add((i, chunk))
    want = {}
    for h, docs_of in met.items():
        for _, chunk in docs_of if len(docs_of) > 1 else ():
            want.setdefault(chunk, set()).add(h)
    assert {c: set(np.concatenate(k).tolist()) for c, k in of_chunk.items()} == want and len(want) == 40


def test_sorting_keeps_its_arrays_small():
    """Lengths in 16 bits and places in 32."""
    text = np.array(list(b"banana band banana") + [0])
    order, lcp = suffix_array(text, 50)
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())
    assert order.dtype == np.int32 and lcp.dtype == np.int16


def counted_lookups(monkeypatch, table_size):
    """A list that gets how many values each np.searchsorted looks up in a table of `table_size`."""
    plain, counts = np.searchsorted, []

    def counting(table, values, *args, **kwargs):
        if len(table) == table_size:
            counts.append(np.size(values))
        return plain(table, values, *args, **kwargs)

    monkeypatch.setattr(np, "searchsorted", counting)
    return counts


def test_few_anchors_are_looked_up_if_few_are_shared(monkeypatch):
    rng = random.Random(12)
    texts = [prose(rng, 4000), prose(rng, 4000)]
    (part,) = suffix_dedup.joined([1, 2], texts, 50)
    shared = np.sort(part.hash)[::40]
    shared = np.unique(shared)
    counts = counted_lookups(monkeypatch, len(shared))
    own = suffix_dedup.Segments([1, 2], texts, shared, 3, 50)
    assert np.array_equal(own.occurs[0] >= 0, np.isin(part.hash, shared))
    assert 0 < sum(counts) < len(part.hash) / 5


@pytest.mark.parametrize("clash", [False, True])
def test_segments_of_equal_hashes_are_told_apart_by_their_bytes(monkeypatch, clash):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 700)
    monkeypatch.setattr(suffix_dedup, "SLICE", 7)
    if clash:
        monkeypatch.setattr(suffix_dedup, "window_hashes", lambda h, at, *_: np.zeros(len(at), np.uint64))
    rng = random.Random(9)
    passage = prose(rng, 60)
    ids, texts = [5, 4, 3], [passage, prose(rng, 30) + passage + prose(rng, 300), None]
    parts = list(suffix_dedup.joined(ids, texts, 50))
    shared = np.unique(np.concatenate([p.hash for p in parts]))
    own = suffix_dedup.Segments(ids, texts, shared, 3, 50)
    want: dict[bytes, int] = {}
    for part, occurs in zip(own.parts, own.occurs):
        for a, b, at, k in zip(part.first.tolist(), part.last.tolist(), part.owner.tolist(), occurs.tolist()):
            segment = part.raw[a : b + 50].tobytes()
            want[segment] = min(want.get(segment, 9), int(part.ids[at]))
            assert own.raw[own.first[k] :][: own.size[k]].tobytes() == segment
    got = {own.raw[a : a + n].tobytes(): d for a, n, d in zip(own.first.tolist(), own.size.tolist(), own.least.tolist())}
    assert got == want and len(own.first) == len(want) and len(want) < sum(len(p.hash) for p in own.parts)
    assert sorted(own.by_shard) == list(own.by_shard) and sum(b - a for a, b in own.by_shard.values()) == len(want)


def test_long_texts_are_cut_without_losing_windows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", np.uint64(9))
    rng = random.Random(4)
    for n in (49, 50, 255, 256, 257, 1000):
        text = prose(rng, n)[:n]
        seen = [
            (part.first[k] + at, part.last[k] + at)
            for part, (_, at) in zip(suffix_dedup.joined([1], [text], 50), suffix_dedup._pieces(pd.DataFrame({"text": [text]}), 50))
            for k in range(len(part.hash))
        ] if n < 256 else None
        pieces = list(suffix_dedup._pieces(pd.DataFrame({"text": [text]}), 50))
        covered = {w for _, at in pieces for w in range(at, min(at + 256, n) - 49)}
        assert covered == set(range(max(0, n - 49)))
        if seen:
            assert sorted(w for a, b in seen for w in range(a, b + 1)) == list(range(n - 49))


# -- language model -------------------------------------------------------------------------


def brute_lm(texts, fold):
    import re
    from collections import Counter

    toks = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\0end"] for t in texts]
    count = Counter(w for ws, f in zip(toks, fold) if f != lm_scoring.UNSEEN for w in ws)
    n, v = sum(count.values()), len(count)
    base = [sum(np.log10((count[w] + 1) / (n + v + 1)) for w in ws) for ws in toks]
    return toks, count, n, v, base


@pytest.mark.parametrize("chunk", [8 << 20, 2000])
def test_lm_counts_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 1000)
    monkeypatch.setattr(lm_scoring, "FLUSH_TOKENS", 3000)
    rng = random.Random(6)
    data = rows() + [(100 + i, prose(rng, 30, "abc"), "en", "a", 1) for i in range(60)]
    df = clashing(spark.createDataFrame(data, PLAIN))
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    fold_of = F.when(rest == 2, 2).when(rest == 3, 1).when(rest.isNotNull(), 0)
    fold = [2 if i is None else {2: 2, 3: 1}.get(zlib.crc32(str(i).encode()) % 7, 0) for i, *_ in data]
    toks, count, n, v, base = brute_lm([t for _, t, *_ in data], fold)
    got = lm_scoring.score_texts(df, fold_of).collect()
    want = sorted((str(r[0]), len(t), sum(count[w] > 0 for w in t), n, round(float(b), 6)) for r, t, b in zip(data, toks, base))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scoring.score_texts(df.limit(0), fold_of).count() == 0


def test_rows_of_words_do_not_grow_with_chunks_times_buckets(spark, monkeypatch):
    """A task sends a row a bucket for all chunks that it met; each chunk gets the counts of its own keys, in order."""
    monkeypatch.setattr(lm_scoring, "READ_ROWS", 7)
    rng = random.Random(5)
    data = [(i, prose(rng, 30, "abc"), i % 3, 2 * (i % 20) + (i % 3 == 1)) for i in range(120)]
    docs = spark.createDataFrame(data, "id long, text string, fold long, chunk long").coalesce(1)
    found = lm_scoring.asked(docs, 8)
    assert found.count() == 8
    got = {}
    for r in lm_scoring.answered(found).where("chunk >= 0").orderBy("chunk", "bucket").collect():
        got.setdefault(r.chunk, []).extend(lm_scoring.unpack_numbers(bytes(r.full)).tolist())
    keys_of = {}
    for _, text, fold, chunk in data:
        tokens, _ = lm_scoring.token_hashes([text])
        keys_of.setdefault((chunk, fold), []).append(np.concatenate([lm_scoring.word_keys(tokens), lm_scoring.pair_keys(tokens)]))
    learned = np.concatenate([k for (_, fold), own in keys_of.items() if fold != lm_scoring.UNSEEN for k in own])
    count = dict(zip(*(x.tolist() for x in np.unique(learned, return_counts=True))))
    for chunk in {c for c, _ in keys_of}:
        keys = np.unique(np.concatenate([k for (c, _), own in keys_of.items() if c == chunk for k in own]))
        assert got[chunk] == [count.get(k, 0) for k in keys.tolist()]


def test_lm_probabilities_sum_to_one_and_beat_the_base(spark):
    rng = random.Random(8)
    chain = {a: rng.sample("abcdefghijklmnop", 3) for a in "abcdefghijklmnop"}

    def walk(n):
        out = ["a"]
        for _ in range(n):
            out.append(rng.choice(chain[out[-1]]))
        return " ".join(out)

    df = spark.createDataFrame([(i, walk(60)) for i in range(200)], "doc_id long, text string")
    rest = F.crc32(F.col("doc_id").cast("string")) % 7
    got = lm_scoring.score_texts(df, F.when(rest == 2, 2).when(rest == 3, 1).otherwise(0)).toPandas()
    unseen = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    assert (got.score[unseen] > got.base_score[unseen]).all()
    # One step after a known word costs about log10(3), as the chain has three branches.
    assert abs(got.score[unseen].sum() / got.n_tokens[unseen].sum() + np.log10(3)) < 0.1


def test_weights_are_learned():
    cells = pd.DataFrame({"bucket": [3, 3, 4], "pair": [40, -160, 20], "word": [4, 4, 40], "n": [90, 10, 5]})
    w = lm_scoring.learn(cells)
    assert np.allclose(w.sum(1), 1) and w[3, 0] > 0.8 and w[4, 1] > 0.9 and w[0, 0] == 0


# -- near duplicates ------------------------------------------------------------------------


def brute_groups(data, n, num, den):
    sets = []
    for i, t in data:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()))
    head = {i: i for i, _ in sets}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                x, y = top(i), top(j)
                head[max(x, y)] = min(x, y)
    return sorted((str(i), len(s), str(top(i))) for i, s in sets)


@pytest.mark.parametrize("n,num,blocks", [(4, 85, 200_000), (5, 80, 300)])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, n, num, blocks):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", blocks)
    monkeypatch.setattr(jaccard_join, "MAX_BLOCKS", 24 if blocks > 1000 else 3)
    rng = random.Random(num)
    data, bases = [(i, t) for i, t, *_ in rows()], [prose(rng, k).split() for k in (3, 12, 40, 90, 150, 400)]
    passage = prose(rng, 60).split()
    for i in range(160):
        w = list(bases[i % 6])
        for _ in range(rng.randint(0, max(1, len(w) // 40))):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [prose(rng, 1)]
        data.append((100 + i, " ".join(w)))
    data += [(400 + i, " ".join(prose(rng, 50).split() + passage)) for i in range(30)]
    rng.shuffle(data)
    df = clashing(spark.createDataFrame(data, "doc_id long, text string"))
    got = jaccard_join.jaccard_groups(df, n=n, num=num, den=100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_groups(data, n, num, 100)
    assert jaccard_join.jaccard_groups(df.limit(0)).count() == 0


def test_similar_sets_always_meet():
    rng = np.random.default_rng(5)
    for num in (80, 85):
        ends = jaccard_join.size_classes(num, 100)
        for _ in range(300):
            size = int(rng.integers(1, 400))
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            differ = rng.integers(0, (100 - num) * size // 100 + 1)
            b = np.concatenate([a[differ:], rng.integers(0, 1 << 63, int(rng.integers(0, differ + 1))).astype(np.uint64)])
            if not len(b) or 100 * (size - differ) < num * len(np.union1d(a, b)):
                continue
            keys = []
            for s in (np.unique(a), np.unique(b)):
                level = int(np.searchsorted(np.array(ends), len(s)))
                keys.append({int(h) for at in {level, max(level - 1, 0)} for h in jaccard_join.part_hashes(s, at, *jaccard_join.parts_of(at, num, 100))})
            assert keys[0] & keys[1]


def test_sketches_never_rule_out_similar_sets():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a = rng.integers(0, 1 << 63, int(rng.integers(1, 500))).astype(np.uint64)
        b = np.concatenate([a[int(rng.integers(0, len(a))) :], rng.integers(0, 1 << 63, int(rng.integers(0, 60))).astype(np.uint64)])
        x, y = jaccard_join.sketch(a), jaccard_join.sketch(b)
        words = min(len(x), len(y))
        differ = np.bitwise_count(jaccard_join.folded(x, words) ^ jaccard_join.folded(y, words)).sum()
        assert differ <= len(np.setxor1d(a, b)) and (jaccard_join.folded(x, len(x)) == x).all()


def test_sets_that_meet_but_are_not_similar_stay_home(spark, monkeypatch):
    """Texts that share two thirds of their words have equal parts, and their sketches tell them apart."""
    rng = random.Random(8)
    body = prose(rng, 300).split()
    data = [(i, " ".join(body + prose(rng, 150).split())) for i in range(40)]
    data += [(100 + i, " ".join(body[:280] + prose(rng, 20).split() + prose(random.Random(9), 150).split())) for i in range(3)]
    counts: dict[str, list[int]] = {}
    monkeypatch.setattr(jaccard_join, "BUCKET_TOKENS", 5000)
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 4000)
    inner = jaccard_join.written

    def counted(df, name):
        out = inner(df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = jaccard_join.jaccard_groups(df, n=5, num=80, den=100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_groups(data, 5, 80, 100)
    assert counts["wanted"][0] > 40 and sum(counts["sets"]) <= 10


def test_trie_walk_equals_brute_force():
    rng = random.Random(7)
    for _ in range(60):
        sets = [tuple(sorted(rng.sample(range(30), rng.randint(1, 20)))) for _ in range(40)]
        root, order = build(sets)
        assert sorted(order) == list(range(40)) and (root.first, root.stop) == (0, 40)
        for q in sets[:10]:
            want = [k for k, s in enumerate(sets) if 100 * len(set(q) & set(s)) >= 80 * len(set(q) | set(s))]
            assert sorted(matches(root, q, 80, 100)) == want


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 199), (40, 39)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 199: 199, 200: 199}


# -- tokens and languages -------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), TokenCounter(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    rng = random.Random(1)
    letters = "aAbBeE's 'll\n\t1²½ǅİßΣσς éé日本語🙂<|endoftext|>#$_ẞﬁK٣\x85 Ꟛ\U0003285c"
    for _ in range(1500):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) + rng.choice(["", "<|endoftext|>x", "<|startoftext|>"])
        assert own.count(t) == count(t), repr(t)
    long = "ab" * 3000
    assert own.count(long) == count(long)
    got = count_tokens(clashing(docs), "word_bpe_49k.json", limit=100).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), count(r.text or ""), count(r.text or "") > 100)
    assert count_tokens(docs.limit(0), "word_bpe_49k.json").count() == 0


def test_pieces_are_the_best_and_decode(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own, library = Pieces(path, remembered=50), sentencepiece.SentencePieceProcessor(model_file=path)
    score = {own.names[i]: s for i, s in zip(own.ids, own.scores)}
    rng = random.Random(3)
    for _ in range(400):
        t = "".join(rng.choice("abctheing  \n\té日本🙂‍ 한ß.\u0000") for _ in range(rng.randint(0, 40)))
        ids = own.encode([t])[0]
        assert own.decode(ids) == t and library.decode(ids.tolist()) == t
        marked = "▁" + t.replace(" ", "▁") if t else ""
        best = [0.0] + [-1e30] * len(marked)
        for e in range(1, len(marked) + 1):
            for s in range(max(0, e - own.longest), e):
                v = score.get(marked[s:e], -1e4 if e - s == 1 else None)
                best[e] = max(best[e], best[s] + v) if v is not None else best[e]
        lone = sum(c not in score for c in marked)
        assert abs(sum(score.get(own.names[i], 0) for i in ids) - 1e4 * lone - best[-1]) < 1e-6
    got = encoded(clashing(docs), "piece_bpe_32k.model").collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.round_trip is None) == (r.text is None) and r.round_trip in (None, True)
        assert r.n_tokens == len(r.ids or [])
    assert encode(docs.limit(0), "piece_bpe_32k.model").count() == 0


def test_few_substrings_are_looked_up_among_the_pieces(monkeypatch):
    own = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    words = sorted({SPACE_MARK + w for w in prose(random.Random(13), 3000).split()})
    substrings = sum(len(w) - k for w in words for k in range(min(len(w), own.longest)))
    counts = counted_lookups(monkeypatch, len(own.hashes))
    found = own.best(words)
    assert 0 < sum(counts) < 0.75 * substrings
    assert [own.decode(np.frombuffer(ids, np.int32)) for ids in found] == [w[1:] for w in words]


def test_pieces_words_are_runs_of_marks_and_letters():
    own = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("a b", " a", "a  b ", "  ", " ", f"{SPACE_MARK}a{SPACE_MARK}", "a\n b\t"):
        words = own.words(text)
        assert "".join(words) == (SPACE_MARK * own.prefixed + text).replace(" ", SPACE_MARK)
        assert all(w.startswith(SPACE_MARK) and SPACE_MARK not in w.lstrip(SPACE_MARK) for w in words)
        assert all(w.strip(SPACE_MARK) for w in words[:-1])



def test_gradients_by_finite_differences():
    net = language_id.BiGru.fresh(["a", "b"])
    for k, v in net.params().items():
        setattr(net, k, v.astype(np.float64))
    codes = np.concatenate([language_id._windows(b"hello world this")[:, :20], language_id._windows(b"abc")[:, :20]]).T
    labels = np.array([0, 1])
    _, g = language_id._gradients(net, codes, labels)
    for k, v in net.params().items():
        for at in [tuple(np.array(v.shape) // 2), tuple(np.array(v.shape) - 1)] if k != "embed" else [(ord("o"), 3), (ord("c"), 0)]:
            v[at] += 1e-4
            up, _ = language_id._gradients(net, codes, labels)
            v[at] -= 2e-4
            down, _ = language_id._gradients(net, codes, labels)
            v[at] += 1e-4
            assert abs((up - down) / 2e-4 - g[k][at]) < 1e-5


def test_languages_are_told_apart(spark, docs):
    rng = random.Random(11)
    alphabets = {"xx": "abcdefg", "yy": "hijklmn", "zz": "äöüßñéà"}
    data = [(1000 + i, prose(rng, 40, alphabets[lang]), lang, "s", 1) for i in range(90) for lang in [list(alphabets)[i % 3]]]
    train = spark.createDataFrame(data, PLAIN)
    net = language_id.fit(train, F.col("doc_id") % 2 == 0)
    got = language_id.identify(clashing(train.union(docs)), net).collect()
    assert len(got) == 90 + len(rows())
    unseen = [r for r in got if r.doc_id and r.doc_id >= 1000 and r.doc_id % 2]
    assert sum(r.lang_pred == dict((d[0], d[2]) for d in data)[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if not any(map(str.isalpha, r.text or "")))
    assert all(0 <= r.score <= 1 for r in got)
    assert language_id.fit(train, F.lit(False)) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), net).count() == 0
    one, two = (language_id.predict(net, [prose(random.Random(2), 4000, "abcdefg"), "hij klm"]) for _ in range(2))
    assert one[0] == two[0] == ["xx", "yy"]
