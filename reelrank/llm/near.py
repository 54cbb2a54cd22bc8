"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text's words (lower-cased, without signs) give its five-word shingles, each
labelled with its occurrence number. A sketch takes the PICKED labelled
shingles with the least hash values and keeps them in text order; two texts
whose sketches agree for any of SKETCHES hash functions are candidates. Two
texts with similarity s agree on one with about s^PICKED, so at 0.8 a pair
escapes all with a chance of 1e-5.

Similarity is that of an alignment of the shingle sequences: the longest
common subsequence L within the band that 0.8 allows, over len(a)+len(b)-L.
For texts that differ by edits in place this is their Jaccard similarity.

Texts with equal words are one node. Candidates that share a sketch are never
written out as all pairs:

1. each member of a bucket is compared with the bucket's leader (its least
   node), which settles dense groups; links give components;
2. only buckets that still hold several components are looked at again: their
   members are compared across components, in blocks of bounded size.

Leaders and blocks are dealt out in bounded portions, so a group with a third
of all rows is spread over many tasks. Components come from label propagation
over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import (join_groups, map_texts, one_of_each, ship, unpacked, whole_row,
                                 words_of, written)

ship(__name__)

SHINGLE, SIMILARITY = 5, 0.8
PICKED, SKETCHES = 3, 16
PORTION = 100_000  # shingles that are compared with a leader in one portion
BLOCK = 200_000  # shingles of a block when members are compared with each other

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _MIX + np.uint64(seed)) | np.uint64(1)


_TIMES, _PLUS = _odd_numbers(SKETCHES, 11), _odd_numbers(SKETCHES, 12)


def shingles(words: list[bytes]) -> np.ndarray:
    """Hashes of the five-word shingles in order; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    w = np.array([digest(x) for x in words], np.uint64)
    n = max(1, len(w) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(w))):
        out = _mixed(out * _MIX + w[k:k + n])
    return out


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by their occurrence number in the text."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]])
    if not same.any():
        return hashes
    place = np.arange(len(ranked))
    first = np.maximum.accumulate(np.where(same, 0, place))
    out = np.empty_like(hashes)
    out[order] = _mixed(ranked + (place - first).astype(np.uint64) * _MIX)
    return out


def sketches(labels: np.ndarray) -> np.ndarray:
    """One 64-bit key per sketch; none for a text without words."""
    n = len(labels)
    if not n:
        return np.zeros(0, np.uint64)
    some = max(1, (1 << 20) // n)
    keys = []
    for i in range(0, SKETCHES, some):
        values = (labels[None, :] ^ _PLUS[i:i + some, None]) * _TIMES[i:i + some, None]
        if n > PICKED:
            at = np.sort(np.argpartition(values, PICKED - 1, axis=1)[:, :PICKED], axis=1)
        else:
            at = np.broadcast_to(np.arange(n), (len(values), n))
        key = np.arange(i, i + len(values), dtype=np.uint64)
        for k in range(at.shape[1]):  # in text order
            key = _mixed(key * _MIX + labels[at[:, k]])
        keys.append(key)
    return np.concatenate(keys)


def common_in_order(a: list, b: list, band: int) -> int:
    """Longest common subsequence of pairs (i, j) with -band <= i - j <= band, bit-parallel.

    Zeros of ``row`` mark the columns at which the best length grows. Rows go
    in blocks; a block works on the columns of its band, as columns to the
    left can't be matched any more and those to the right not yet.
    """
    n = len(b)
    row = (1 << n) - 1
    height = max(64, band)
    for top in range(0, len(a), height):
        bottom = min(len(a), top + height)
        low, high = max(0, top - band), min(n, bottom + band)
        if low >= high:
            continue
        mask = (1 << (high - low)) - 1
        places: dict = {}
        for j in range(low, high):
            places[b[j]] = places.get(b[j], 0) | 1 << (j - low)
        window = (row >> low) & mask
        for i in range(top, bottom):
            hits = places.get(a[i])
            if hits is None:
                continue
            left, right = max(0, i - band - low), min(high, i + band + 1) - low
            if left >= right:
                continue
            hits &= ((1 << (right - left)) - 1) << left
            match = window & hits
            window = ((window + match) | (window & ~hits)) & mask
        row = (row & ~(mask << low)) | (window << low)
    return n - row.bit_count()


class Text:
    """What comparisons need of a text."""

    __slots__ = ("hashes", "sorted", "n")

    def __init__(self, text: str) -> None:
        self.hashes = shingles(words_of(text))
        self.sorted = np.sort(labelled(self.hashes))
        self.n = len(self.hashes)


def similar(a: Text, b: Text) -> bool:
    """Whether the alignment similarity of two texts is at least SIMILARITY."""
    small, large = sorted((a.n, b.n))
    if not large:
        return True
    need = SIMILARITY / (1 + SIMILARITY) * (a.n + b.n) - 1e-9
    if small < need:
        return False
    at = np.searchsorted(b.sorted, a.sorted)
    at[at == b.n] = 0
    if np.count_nonzero(b.sorted[at] == a.sorted) < need:
        return False  # not even without regard to order
    x, y = a.hashes, b.hashes
    differ = np.flatnonzero(x[:small if a.n >= b.n else a.n] != y[:small if b.n >= a.n else b.n])
    head = int(differ[0]) if len(differ) else small
    if head >= need:
        return True
    rest = small - head
    differ = np.flatnonzero(x[a.n - rest:][::-1] != y[b.n - rest:][::-1])
    tail = int(differ[0]) if len(differ) else rest
    if head + tail >= need:
        return True
    band = int(a.n + b.n - 2 * need) + 1
    middle = common_in_order(x[head:a.n - tail].tolist(), y[head:b.n - tail].tolist(), band)
    return head + tail + middle >= need


def _sketch_kernel(texts: list[str]) -> list:
    nodes, counts, keys = [], [], []
    for text in texts:
        words = words_of(text)
        labels = labelled(shingles(words))
        nodes.append(xxhash.xxh3_128_digest(b" ".join(words)))
        counts.append(len(labels))
        keys.append(sketches(labels).view(np.int64))
    return [nodes, counts, keys]


def _compare_with_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by portion, its leader first; yields the links."""
    portion, leader = None, None
    for batch in batches:
        a, b = [], []
        for group, first, node, text in zip(*(batch.column(c).to_pylist() for c in (
                "portion", "other", "node", "text"))):
            if not first:
                portion, leader, name = group, Text(text), node
            elif group == portion and similar(leader, Text(text)):
                a.append(name)
                b.append(node)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                         names=["a", "b"])


def shared_counts(texts: list[Text]):
    """Function from a text's place to its numbers of shared labelled shingles with all texts.

    An inverted index over the shingles that occur in several of the texts;
    one call costs as much as the postings it meets, without pairs.
    """
    m = len(texts)
    labels = np.concatenate([t.sorted for t in texts])
    owner = np.repeat(np.arange(m), [t.n for t in texts])
    names, number, df = np.unique(labels, return_inverse=True, return_counts=True)
    several = df[number] > 1
    owner, number = owner[several], number[several]
    own_from = np.searchsorted(owner, np.arange(m + 1))
    order = np.argsort(number, kind="stable")
    posts = owner[order]
    start = np.searchsorted(number[order], np.arange(len(names) + 1))

    def counts(i: int) -> np.ndarray:
        mine = number[own_from[i]:own_from[i + 1]]
        size = start[mine + 1] - start[mine]
        total = int(size.sum())
        if not total:
            return np.zeros(m, np.int64)
        first = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        return np.bincount(posts[first + np.arange(total)], minlength=m)

    return counts


def _compare_block(key: tuple, rows: pa.Table) -> pa.Table:
    """Links across components among the members of a block (or of two blocks).

    A pair that shares several buckets is looked at in that of its first
    sketch only.
    """
    node, part, own, texts = (rows.column(c).to_pylist() for c in ("node", "comp", "own", "text"))
    texts = [Text(t) for t in texts]
    sketch = rows.column("sketch")[0].as_py()
    keys = np.array(rows.column("keys").to_pylist(), np.int64)[:, :sketch]
    size, own = np.array([t.n for t in texts]), np.array(own)
    comp = np.unique(np.array(part, object), return_inverse=True)[1]
    parent = list(range(comp.max() + 1))

    def find(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    a, b = [], []
    across = own.any() and not own.all()
    counts = shared_counts(texts)
    for i in range(len(node)):
        need = SIMILARITY / (1 + SIMILARITY) * (size + size[i]) - 1e-9
        hits = np.flatnonzero(counts(i) >= need)
        hits = hits[(hits > i) & (comp[hits] != comp[i])]
        if across:
            hits = hits[own[hits] != own[i]]
        hits = hits[~(keys[hits] == keys[i]).any(axis=1)]
        for j in hits.tolist():
            x, y = find(comp[i]), find(comp[j])
            if x != y and similar(texts[i], texts[j]):
                parent[x] = y
                a.append(node[i])
                b.append(node[j])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, comp) for every end of a link (a, b); comp is the least node of its component.

    Each round a node takes the least label among its own and its neighbours'
    and then that label's label; rounds go on until nothing changes, about
    the logarithm of the longest path. ``degree`` lets hot nodes be joined
    without gathering their links.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), f"{name}-links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.count(F.lit(1)).alias("degree"), F.least(F.min("b"), F.first("a")).alias("comp")),
        f"{name}-labels")
    while True:
        seen = join_groups(both, labels.select(F.col("node").alias("b"), "degree", "comp"),
                           ["b"], "degree", "a")
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(nearest, "node").select(
            "node", "degree", "comp", F.least("comp", "near").alias("to"))
        step = written(step, f"{name}-step")
        # how many nodes point at a label, so that the jump has no hot key either
        targets = step.groupBy(F.col("to").alias("node")).agg(F.count(F.lit(1)).alias("n"))
        jump = written(targets.join(step.select("node", F.col("to").alias("next")), "node"),
                       f"{name}-jump").select(F.col("node").alias("to"), "n", "next")
        new = join_groups(step, jump, ["to"], "n", "node")
        new = written(new.select("node", "degree", F.col("next").alias("comp"),
                                 (F.col("next") != F.col("comp")).alias("moved")),
                      f"{name}-labels")
        labels = new.drop("moved")
        if new.where("moved").isEmpty():
            return labels.drop("degree")


class _Corpus:
    """The written tables of one run, and access to texts by node."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.base = docs.select(F.col(id_col).alias("id"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        # (id, th) names a row; rows that repeat both are the same document
        named = self.base.select(F.struct("id", F.xxhash64("text").alias("th")).alias("row"),
                                 "text")
        self.rows = written(map_texts(named, "row", "text", _sketch_kernel,
                                      "node binary, n int, keys array<long>"
                                      ).withColumnRenamed("id", "row"), "near-sketches")
        self.nodes = written(self.rows.groupBy("node").agg(
            F.min("row").alias("row"), F.first("n").alias("n"), F.first("keys").alias("keys")),
            "near-nodes")

    def with_text(self, wanted: DataFrame, *more: str) -> DataFrame:
        """``wanted`` (node, ...) with the node's text, read from the corpus again."""
        rows = wanted.join(self.nodes.select("node", "row", *more), "node")
        rows = rows.withColumn("id", F.col("row.id")).withColumn("th", F.col("row.th")).drop("row")
        text = self.base.select(F.col("id").alias("t_id"), F.xxhash64("text").alias("t_th"),
                                "text")
        rows = rows.join(text, F.col("id").eqNullSafe(F.col("t_id")) &
                         (F.col("th") == F.col("t_th")))
        return rows.drop("id", "th", "t_id", "t_th")


def _leader_links(corpus: _Corpus, members: DataFrame) -> DataFrame:
    """Links between buckets' leaders and their members."""
    pairs = members.select("leader", "node", "n").where("node != leader").distinct()
    pairs = written(pairs, "near-pairs")
    load = written(pairs.groupBy("leader").agg(
        F.sum("n").alias("load"), F.count(F.lit(1)).alias("n_pairs")), "near-loads")
    pairs = join_groups(pairs, load, ["leader"], "n_pairs", "node")
    number = F.pmod(F.xxhash64("node"), F.ceil(F.col("load") / PORTION) + 1)
    pairs = pairs.select("leader", "node", F.struct("leader", number.alias("k")).alias("portion"))
    wanted = pairs.select("portion", "node", F.lit(1).alias("other")).unionByName(
        pairs.select("portion", F.col("leader").alias("node"), F.lit(0).alias("other")).distinct())
    rows = corpus.with_text(wanted).repartition("portion").sortWithinPartitions("portion", "other")
    return rows.select("portion", "other", "node", "text").mapInArrow(
        _compare_with_leader, "a binary, b binary")


def _cross_links(corpus: _Corpus, members: DataFrame, comps: DataFrame) -> DataFrame:
    """Links between components that still share a bucket."""
    placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = written(placed.select("key", "sketch", "node", "n", "comp"), "near-placed")
    mixed = placed.groupBy("key").agg(
        F.first("sketch").alias("sketch"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
        F.count(F.lit(1)).alias("size"),
        F.sum("n").alias("load"), F.bit_xor(F.xxhash64("node")).alias("h0"),
        F.sum(F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(1 << 40))).alias("h1"))
    # of two members one is the leader, and that pair has been compared;
    # buckets with the same members need one look, that of the first sketch
    mixed = mixed.where("c0 != c1 and size > 2").groupBy("size", "h0", "h1").agg(
        F.min(F.struct("sketch", "key")).alias("first"), F.first("load").alias("load"))
    mixed = written(mixed.select("first.key", "size", "load"), "near-mixed")
    left = join_groups(placed, mixed, ["key"], "size", "node").where("load is not null")
    blocks = (F.floor(F.col("load") / BLOCK) + 1).cast("int")
    left = left.withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least("own", other).alias("i"), F.greatest("own", other).alias("j")))
    wanted = left.select("key", "sketch", "node", "comp", "own", F.explode(pair).alias("pair"))
    rows = corpus.with_text(wanted, "keys").select(
        "key", "pair", "sketch", "keys", "node", "comp",
        (F.col("own") == F.col("pair.i")).alias("own"), "text")
    return rows.groupBy("key", "pair").applyInArrow(_compare_block, "a binary, b binary")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, class_row, class_size, links): the class of every row; row is struct(id, th).

    Classes are the connected components of "equal words" and "similar";
    ``class_row`` is the least row of the class, ``links`` the verified links
    of the row's node. Null texts count as empty; texts without words are one
    class; texts of under five words are alike only when equal (their one
    shingle is all their words). Rows that repeat id and text are one document
    (one row each in the result). An empty table gives an empty result.
    """
    corpus = _Corpus(docs, id_col, text_col)
    buckets = written(corpus.nodes.select(
        "node", "n", F.posexplode("keys").alias("sketch", "key")), "near-buckets")
    leaders = written(buckets.groupBy("key").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1"),
        "near-leaders")
    members = written(join_groups(buckets, leaders, ["key"], "size", "node")
                      .where("leader is not null"), "near-members")
    links = written(_leader_links(corpus, members).distinct(), "near-links")
    comps = components(links, "near")
    more = written(_cross_links(corpus, members, comps), "near-cross")
    if not more.isEmpty():
        links = links.unionByName(more)
        comps = components(links, "near-all")
    degree = links.select(F.col("a").alias("node")).unionByName(
        links.select(F.col("b").alias("node"))).groupBy("node").agg(
            F.count(F.lit(1)).alias("links"))
    # class of each node, then of each row; a class is hot, its least row is aggregated first
    nodes = corpus.nodes.select("node", "row").join(comps, "node", "left").join(
        degree, "node", "left")
    nodes = nodes.select("node", F.coalesce("comp", "node").alias("comp"),
                         F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    counted = corpus.rows.groupBy("node").agg(F.count(F.lit(1)).alias("copies"),
                                              F.min("row").alias("first"))
    nodes = written(nodes.join(counted, "node"), "near-comps")
    classes = written(nodes.groupBy("comp").agg(
        F.min("first").alias("class_row"), F.sum("copies").alias("class_size"),
        F.count(F.lit(1)).alias("n_nodes")), "near-classes")
    nodes = written(join_groups(nodes, classes, ["comp"], "n_nodes", "node").select(
        "node", "class_row", "class_size", "links", "copies"), "near-verdicts")
    return join_groups(corpus.rows.select("row", "node"), nodes, ["node"], "copies", "row"
                       ).select("row", "class_row", "class_size", "links")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class: the one with the least id.

    Of rows that repeat id and text one stays. All columns are kept as they
    are, whatever their names; see ``near_classes`` for the other cases.
    """
    found = near_classes(docs, id_col, text_col)
    gone = found.where("not (row <=> class_row)").select(
        F.col("row.id").alias("g_id"), F.col("row.th").alias("g_th")).distinct()
    many = found.where("row <=> class_row").groupBy("row").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    many = written(many.select(F.col("row.id").alias("g_id"), F.col("row.th").alias("g_th")),
                   "near-repeated")
    rows = docs.select(whole_row(docs), F.col(id_col).alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"))
    match = F.col("id").eqNullSafe(F.col("g_id")) & (F.col("th") == F.col("g_th"))
    left = rows.join(gone, match, "left_anti")
    if many.isEmpty():
        return unpacked(left, docs)
    again = left.join(many, match, "left_semi")
    return unpacked(left.join(many, match, "left_anti"), docs).unionByName(
        unpacked(one_of_each(again, ["id", "th"], "near-repeated-rows"), docs))
