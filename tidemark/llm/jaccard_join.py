"""N-gram Jaccard join with a prefix tree: documents whose shingle sets are similar, and their groups.

1. Documents with equal sets are one class (by a 128-bit digest of the set); its smallest id stands
   for it, so copies cost one row each.
2. Two sets of about `a` and `b` tokens that are similar differ in at most
   D = (a + b)(den - num) / (den + num) tokens. The tokens are dealt by hash into more than D parts,
   so some part is equal in both. Sets of one size class meet in Spark by the hash of a part.
   Frequent passages do no harm: a part is equal only if all its tokens are.
3. Every set has a sketch of one or two bits a token, the parities of its tokens dealt into places.
   Sets that differ in d tokens have sketches that differ in d places at most, so what the sketches
   rule out is not similar, and only sets that are left travel whole.
4. In every meeting the smallest id leads. Each document is compared with the leader it meets most
   often, which is linear in the documents, and components are formed.
5. Meetings whose members are still in several components are sifted completely by their sketches,
   those of the same members once. A unit gives links between sets that may be similar, fewer than
   its members; what these connect is a cluster, whose sets are joined completely. So no link that
   would change a component goes unseen.

Both parts of 5 work in blocks of bounded size. Meetings that share members (for the sets: clusters)
ship a member once per block and not once per meeting; beyond MAX_BLOCKS blocks they are taken meeting
by meeting. Sets of a block are put into a prefix tree in the global order of the hashes, which each
query walks; see prefix_trie. No step emits the pairs of a meeting, only links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components, sized, small_batches, written
from tidemark.llm.prefix_trie import build, matches
from tidemark.llm.shingles import mix, shingle_sets

BLOCK_TOKENS = 200_000
ENOUGH_DEVIATIONS = 4
MAX_BLOCKS = 24
BUCKET_TOKENS = 40 * BLOCK_TOKENS  # of small units of sketches, which go to Python together


def size_classes(num: int, den: int, upto: int = 1 << 40) -> list[int]:
    """Upper ends of the size classes; a similar set is in the same class or the next."""
    ends, end = [], 1
    while end < upto:
        ends.append(end)
        end = max(end + 1, end * den // num)
    return [*ends, end, max(end + 1, end * den // num)]


@cache
def parts_of(level: int, num: int, den: int) -> tuple[int, int]:
    """(parts, spare) at a level, which joins sets of its class and the next.

    There are `spare` parts more than differences, plus one: a set with up to `spare` empty parts
    need not be met in those. `spare` is as many that few sets of the least size have more.
    """
    ends = size_classes(num, den)
    differ = (ends[level] + ends[level + 1]) * (den - num) // (den + num)
    if not differ:
        return 1, 0
    least = ends[level - 1] + 1 if level else 1
    best, chosen = -math.inf, 0
    for spare in range(2 * differ + 5):
        parts = differ + 1 + spare
        empty = parts * (1 - 1 / parts) ** least
        margin = (spare - empty) / math.sqrt(max(empty, 1e-9))  # in deviations of a count of rare events
        if margin > best:
            best, chosen = margin, spare
        if margin >= ENOUGH_DEVIATIONS:
            break
    return differ + 1 + chosen, chosen


def part_hashes(tokens: np.ndarray, level: int, parts: int, spare: int) -> np.ndarray:
    """Hashes of the parts of one set; empty parts are left out if there are at most `spare`."""
    part = ((tokens * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)) % np.uint64(parts)
    sums = np.zeros(parts, np.uint64)
    np.add.at(sums, part.astype(np.int64), mix(tokens + np.uint64(1)))
    full = np.bincount(part.astype(np.int64), minlength=parts) > 0
    named = mix(sums + mix(np.arange(parts, dtype=np.uint64) + (np.uint64(level + 1) << np.uint64(40))))
    return named[full] if parts - full.sum() <= spare else named


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the tokens dealt into places, 64 to a word; as many words as a power of two."""
    words = 1 << max(0, int(len(tokens) * 1.25).bit_length() - 6)
    place = (mix(tokens + np.uint64(3)) & np.uint64(64 * words - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(words: np.ndarray, count: int) -> np.ndarray:
    """The sketch of the same set in `count` words."""
    return np.bitwise_xor.reduce(words.reshape(-1, count), axis=0)


def digests(docs: DataFrame, n: int) -> DataFrame:
    """Rows (id, size, d1, d2, sketch) for rows (id, text): the digest of each shingle set and its sketch."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist(), n)
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "size": [len(s) for s in sets],
                    "d1": np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                    "d2": np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                    "sketch": [sketch(s).tobytes() for s in sets],
                }
            )

    return docs.mapInPandas(made, "id long, size long, d1 long, d2 long, sketch binary")


def meetings(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Rows (part, id): one for each part hash of each set that is not empty."""
    ends = size_classes(num, den)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tops = np.array(ends)
        for batch in batches:
            ids, keys = [], []
            for i, tokens in zip(batch["id"].tolist(), shingle_sets(batch["text"].tolist(), n)):
                if not len(tokens):
                    continue
                level = int(np.searchsorted(tops, len(tokens)))
                for at in {level, max(level - 1, 0)}:
                    keys.append(part_hashes(tokens, at, *parts_of(at, num, den)))
                    ids.append(np.full(len(keys[-1]), i, np.int64))
                if len(keys) >= 2000:
                    yield pd.DataFrame({"part": np.concatenate(keys).view(np.int64), "id": np.concatenate(ids)})
                    ids, keys = [], []
            if keys:
                yield pd.DataFrame({"part": np.concatenate(keys).view(np.int64), "id": np.concatenate(ids)})

    return docs.mapInPandas(made, "part long, id long")


def packed_sets(docs: DataFrame, n: int) -> DataFrame:
    """Rows (id, size, tokens): the set as 8 bytes a shingle, ascending."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingle_sets(batch["text"].tolist(), n)
            yield pd.DataFrame({"id": batch["id"], "size": [len(s) for s in sets], "tokens": [s.tobytes() for s in sets]})

    return docs.mapInPandas(made, "id long, size long, tokens binary")


def part_bytes(tokens: np.ndarray, parts: int) -> np.ndarray:
    """One byte per part of a set: sets that differ in d tokens differ in d of these at most."""
    out = np.zeros(parts, np.uint8)
    mixed = mix(tokens + np.uint64(2))
    np.add.at(out, (mixed % np.uint64(parts)).astype(np.int64), (mixed >> np.uint64(48)).astype(np.uint8))
    return out


def block_links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between the two sides of each unit.

    Rows are (u1, u2, u3, side, id, component, tokens). Side 0 asks, side 1 is in the tree; side 2
    is both. Ids of one component are not compared, and a link found joins its components, so a
    unit of m members gives fewer than m links. A set is of interest to a query only if the part
    bytes of the two differ in no more places than similar sets of their sizes can.
    """

    def linked(unit: pd.DataFrame) -> pd.DataFrame:
        raw = [np.frombuffer(t, np.uint64) for t in unit["tokens"]]
        ids, side, group = unit["id"].tolist(), unit["side"].tolist(), unit["component"].tolist()
        head = {g: g for g in group}

        def top(g: int) -> int:
            while head[g] != g:
                head[g] = head[head[g]]
                g = head[g]
            return g

        kept = [k for k in range(len(ids)) if side[k]]
        asking = [k for k in range(len(ids)) if side[k] != 1]
        if not kept or not asking or len(set(group)) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sets = {k: tuple(raw[k].tolist()) for k in kept}
        tree, order = build([sets[k] for k in kept])
        in_tree = [kept[k] for k in order]
        parts = 1 << int(np.clip(np.median([len(t) for t in raw]) * 0.4, 64, 4096)).bit_length()
        marks = np.stack([part_bytes(raw[k], parts) for k in in_tree])
        sizes = np.array([len(raw[k]) for k in in_tree])
        place_of = {k: at for at, k in enumerate(in_tree)}
        tops = np.array([top(group[k]) for k in in_tree])
        found = []
        for q in asking:
            differ = (marks != part_bytes(raw[q], parts)).sum(1)
            near = (differ * (den + num) <= (sizes + len(raw[q])) * (den - num)) & (tops != top(group[q]))
            if side[q] == 2:
                near[: place_of[q] + 1] = False  # the others asked already
            if not near.any():
                continue
            before = np.concatenate([[0], np.cumsum(near)]).tolist()
            query = sets[q] if q in sets else tuple(raw[q].tolist())
            for place in matches(tree, query, num, den, before):
                k = kept[place]
                x, y = top(group[k]), top(group[q])
                if x != y:
                    head[x] = y
                    tops[tops == x] = y
                    found.append((ids[q], ids[k]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("u1", "u2", "u3").applyInPandas(linked, "a long, b long")


def _blocks(size_sum: Column) -> Column:
    return F.ceil(size_sum / BLOCK_TOKENS).cast("int")


def near_leaders(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The rows (leader, id) of `pairs` whose sketches do not rule out that they are similar."""

    def sifted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = []
            for a, b, size in zip(batch["sketch"], batch["other"], (batch["size"] + batch["other_size"]).tolist()):
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                words = min(len(x), len(y))
                differ = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
                near.append(differ * (den + num) <= size * (den - num))
            yield batch.loc[near, ["leader", "id"]]

    heads = sketches.select(F.col("id").alias("leader"), F.col("size").alias("other_size"), F.col("sketch").alias("other"))
    return pairs.join(sketches, "id").join(heads, "leader").mapInPandas(sifted, "leader long, id long").distinct()


def leader_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links among the rows (leader, id) of `pairs`; a leader's members come in blocks."""
    sizes = pairs.join(sets.select("id", "size"), "id")
    count = sizes.groupBy("leader").agg(_blocks(F.sum("size")).alias("blocks"))
    dealt = sizes.join(count, "leader").select("leader", "id", F.expr("pmod(xxhash64(id), blocks)").alias("block"))
    heads = count.select("leader", F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("block"), F.col("leader").alias("id"))
    rows = dealt.withColumn("side", F.lit(0)).unionByName(heads.withColumn("side", F.lit(1))).join(sets.select("id", "tokens"), "id")
    units = rows.select(
        F.col("leader").alias("u1"), F.col("block").alias("u2"), F.lit(0).alias("u3"), "side", "id", F.col("id").alias("component"), "tokens"
    )
    return block_links(units, num, den)


def open_members(met: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, id, component, low) of the meetings whose members are in several components.

    Of meetings of the same members one stays; `low` is the smallest component.
    """
    members = met.join(labels.withColumnRenamed("node", "id"), "id", "left")
    members = members.select("part", "id", F.coalesce("component", "id").alias("component"))
    who = [F.sum(F.xxhash64("id", F.lit(salt)).cast("decimal(20,0)")).alias(f"h{salt}") for salt in (1, 2)]
    several = members.groupBy("part").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"), *who)
    several = several.where("low < high").groupBy("h1", "h2", "n").agg(F.min(F.struct("part", "low")).alias("of"))
    several = written(several.select("of.part", "of.low"), "several")
    return written(members.join(several, "part"), "open")


def dealt_units(whole: DataFrame, members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (u1, u2, u3, side, id, component) of the blocks of `whole` (rows id, component, unit).

    Each unit is dealt into blocks that meet each other; of units of more than MAX_BLOCKS blocks the
    meetings of `members` (rows part, id, component) are dealt in their place.
    """
    whole = written(whole.join(sizes, "id"), "clusters")
    blocks = whole.groupBy("unit").agg(_blocks(F.sum("size")).alias("blocks"))
    large = blocks.where(F.col("blocks") > MAX_BLOCKS).select("unit")
    by_meeting = (
        members.select(F.col("part").alias("unit"), "id", "component")
        .join(whole.select("id", F.col("unit").alias("of"), "size").distinct(), "id")
        .join(large.withColumnRenamed("unit", "of"), "of", "left_semi")
        .select("id", "component", "unit", "size")
    )
    meeting_blocks = by_meeting.groupBy("unit").agg(_blocks(F.sum("size")).alias("blocks"))
    dealt = (
        whole.join(blocks.where(F.col("blocks") <= MAX_BLOCKS), "unit").withColumn("kind", F.lit(0))
        .unionByName(by_meeting.join(meeting_blocks, "unit").withColumn("kind", F.lit(1)))
        .withColumn("own", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
    )
    return dealt.select(
        "unit", "kind", "id", "component", "own", "blocks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    ).select(
        F.col("unit").alias("u1"), F.col("kind").alias("u2"),
        (F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")).alias("u3"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "id", "component",
    )


def near_links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect, in each unit, what sketches do not rule out as similar.

    Rows are (u1, u2, u3, side, id, component, size, sketch), with sides as in block_links. Two members
    of different components that may be similar are connected by links of their unit; a unit of m
    members gives fewer than m. Units go to Python in buckets, as most are small.
    """
    units = ["u1", "u2", "u3"]

    def linked(bucket: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 2), np.int64)]
        bucket = bucket.sort_values(units, ignore_index=True)
        names = bucket[units].to_numpy()
        ids, side, group, size = (bucket[c].to_numpy() for c in ("id", "side", "component", "size"))
        words = [np.frombuffer(s, "<u8") for s in bucket["sketch"]]
        at = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(bucket)]
        for a, b in zip(at[:-1], at[1:]):
            pairs = _connected(words[a:b], size[a:b], side[a:b], group[a:b], num, den)
            if pairs:
                found.append(ids[a:b][np.array(pairs)])
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    total = rows.agg(F.coalesce(F.sum(F.col("size") + 100), F.lit(0)).alias("n")).first()["n"]
    bucket = F.pmod(F.xxhash64(*units), F.lit(max(1, -(-total // BUCKET_TOKENS))))
    return rows.groupBy(bucket.alias("bucket")).applyInPandas(linked, "a long, b long")


def _connected(words: list[np.ndarray], size: np.ndarray, side: np.ndarray, group: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of places that connect the members of a unit which may be similar."""
    if (group == group[0]).all():
        return []
    pairs = []
    head = np.arange(len(words))
    width = np.array([len(w) for w in words])
    for count in np.unique(width).tolist():
        asking = np.flatnonzero(width == count)
        inside = np.flatnonzero((width >= count) & (size * num <= size[asking].max() * den))
        table = np.stack([folded(words[k], count) for k in inside])
        for q in asking.tolist():
            near = (group[inside] != group[q]) & (head[inside] != head[q]) & ((side[inside] != side[q]) | (side[q] == 2))
            if not near.any():
                continue
            differ = np.bitwise_count(table[near] ^ folded(words[q], count)).sum(axis=1, dtype=np.int64)
            kept = inside[near]
            for k in kept[differ * (den + num) <= (size[kept] + size[q]) * (den - num)].tolist():
                if head[k] != head[q]:
                    head[head == head[k]] = head[q]
                    pairs.append((q, k))
    return pairs


def clusters_of(open_rows: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Rows (id, component, unit): members of open meetings, by the clusters of those that may be similar."""
    # Sifted together are clusters of components, of which a meeting of near copies has few, and not of members.
    stars = open_rows.select(F.col("low").alias("a"), F.col("component").alias("b")).distinct()
    joint = components(stars).select(F.col("node").alias("component"), F.col("component").alias("unit"))
    named = open_rows.select("id", "component").distinct()
    sizes = sketches.groupBy("id").agg(F.sum("size").alias("size"))
    units = written(dealt_units(named.join(joint, "component").select("id", "component", "unit"), open_rows, sizes), "units")
    near = components(written(near_links(units.join(sketches, "id"), num, den), "near"))
    return written(named.join(near.select(F.col("node").alias("id"), F.col("component").alias("unit")), "id"), "sifted")


def remaining_links(whole: DataFrame, open_rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links among the members of each unit of `whole` (rows id, component, unit) that are in several components."""
    sizes = sets.groupBy("id").agg(F.sum("size").alias("size"))
    units = dealt_units(whole, open_rows, sizes).join(sets.select("id", "tokens"), "id")
    return block_links(units.select("u1", "u2", "u3", "side", "id", "component", "tokens"), num, den)


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Links between the components of `labels` in place of their nodes."""
    ends = links
    for end in ("a", "b"):
        of = labels.select(F.col("node").alias(end), F.col("component").alias("to"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return ends.select("a", "b")


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of `docs`: `key`, n_shingles, component_id.

    A link is den * intersection >= num * union of the distinct `n`-word shingles; component_id is
    the smallest key that links reach. Null and empty texts and texts without a word have no
    shingles and link with nothing. A null key takes part in nothing and has a null component.
    Rows that share a key are one document for its links; each is returned. An empty table gives
    an empty result, and only the two columns asked for are read, so others cannot clash.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return _grouped(rows, n, num, den).withColumnRenamed("id", key)


def _grouped(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Rows (id, n_shingles, component_id) for rows (id, text)."""
    members = written(digests(rows, n), "members")
    usable = members.where("id is not null and size > 0")
    classes = usable.groupBy("d1", "d2", "size").agg(F.min("id").alias("rep"))
    classed = usable.join(classes, ["d1", "d2", "size"]).select("id", "rep")
    copies = written(classed.where("id <> rep").distinct(), "copies")
    # A key can have several rows; it is left out here only if none of them leads its class.
    followers = written(copies.select("id").join(classes.select(F.col("rep").alias("id")), "id", "left_anti").distinct(), "followers")
    reps = rows.where("id is not null").join(sized(followers), "id", "left_anti")

    whole = Window.partitionBy("part")
    met = (
        meetings(reps, n, num, den)
        .withColumns({"leader": F.min("id").over(whole), "last": F.max("id").over(whole)})
        .where("leader < last")
        .select("part", "id", "leader")
    )
    met = written(met, "meetings")
    wanted = written(met.select("id").distinct(), "wanted")
    sketches = usable.select("id", "size", "sketch").join(sized(wanted), "id", "left_semi").distinct()
    sketches = written(sketches, "sketches")

    def sets_of(ids: DataFrame) -> DataFrame:
        ids = written(ids.distinct(), "needed")
        return written(packed_sets(rows.join(sized(ids), "id", "left_semi"), n).where("size > 0"), "sets")

    often = met.where("id <> leader").groupBy("id", "leader").agg(F.count(F.lit(1)).alias("n"))
    nearest = often.groupBy("id").agg(F.max(F.struct("n", (-F.col("leader")).alias("low"))).alias("best"))
    pairs = written(near_leaders(nearest.select((-F.col("best.low")).alias("leader"), "id"), sketches, num, den), "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("leader", "id")).alias("id")))
    first = written(leader_links(pairs, sets, num, den), "first")
    early = components(first.union(copies.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    open_rows = open_members(met, early)
    whole = clusters_of(open_rows, sketches, num, den)
    more = written(remaining_links(whole, open_rows, sets_of(whole.select("id")), num, den), "more")
    late = components(_between(more, early)).select(F.col("node").alias("component"), F.col("component").alias("lower"))
    labels = early.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(early, "node", "left_anti").withColumn("component", F.col("node")))
    labels = labels.join(sized(late), "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
    found = members.join(labels.withColumnRenamed("node", "id"), "id", "left")
    return found.select("id", F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
