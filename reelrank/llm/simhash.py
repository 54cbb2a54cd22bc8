"""SimHash near-duplicate components with pigeonring filtering.

A text's 64-bit fingerprint is the majority vote, bit by bit, of the XXH64
hashes of its word shingles. Texts link when their fingerprints differ in at
most ``DISTANCE`` = 3 bits; components are the transitive closure.

Pigeonring: cut the 64 bits into a ring of four segments. If the differences
of all four sum to at most 3, some segment starts a chain whose sums over 1,
2, 3, 4 consecutive segments stay within 0, 1, 2, 3 (a share of 3/4 per
segment). So the first segment of the chain is equal and the second differs in
at most one bit, hence one half of it is equal too. That gives the index:
eight keys per distinct fingerprint, (segment, half of the next one), 24 bits
each. Rows that share a key are candidates; the sums along the chain are
tested before the whole distance.

Keys that more than ``MOST`` fingerprints share are refined, not compared: of
the bits the key leaves open, cut into four parts, at least one part is equal
as well, so four longer keys take the place of the short one. With nine bits
open a key holds at most 512 distinct fingerprints, so this ends, and no
bucket is ever compared all against all beyond that bound. A bucket yields a
spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelrank.llm.common import join_groups, ship, written
from reelrank.llm.near import components

ship(__name__)

SHINGLE, SEED = 3, 42
DISTANCE, SEGMENTS, WIDTH = 3, 4, 16
#: Distinct fingerprints under one key that are compared with each other.
MOST = 1000
#: Texts are cut into words in windows of about so many bytes.
WINDOW = 1 << 20
_SPACE = b" \t\n\r\v\f"


def _windows(raw: bytes, window: int) -> Iterator[list[bytes]]:
    start = 0
    while start < len(raw):
        end = min(len(raw), start + window)
        while end < len(raw) and raw[end] not in _SPACE:
            end += 1
        yield raw[start:end].split()
        start = end


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest bit first."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros(64, np.int64)
    for i in range(0, len(bits), 255):  # sums of at most 255 fit the bytes
        total += bits[i:i + 255].sum(axis=0, dtype=np.uint8)
    return total


def fingerprint(raw: bytes, window: int = WINDOW) -> int:
    """Fingerprint of a UTF-8 text; 0 if it has no words."""
    digest, votes, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    before: list[bytes] = []
    for fresh in _windows(raw.lower(), window):  # bytes.lower: A-Z only
        words = before + fresh
        if len(words) >= SHINGLE:
            text = b" ".join(words)
            ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
            starts = [0, *[e + 1 for e in ends]]
            hashes = [digest(text[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1:])]
            votes += _votes(np.array(hashes, "<u8"))
            n += len(hashes)
            before = words[1 - SHINGLE:]
        else:
            before = words
    if not n and before:
        votes, n = _votes(np.array([digest(b" ".join(before), SEED)], "<u8")), 1
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each whole text as a signed long; null texts are empty."""
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("raw"))
    schema = StructType([base.schema["id"], *StructType.fromDDL("fp long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py()) for x in batch.column("raw")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps.view(np.int64))],
                                             names=["id", "fp"])

    return base.mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_masks() -> list[tuple[int, int]]:
    """(segment, mask of the key's bits): a whole segment and a half of the next one."""
    out = []
    for i in range(SEGMENTS):
        segment = ((1 << WIDTH) - 1) << WIDTH * i
        for half in range(2):
            at = WIDTH * ((i + 1) % SEGMENTS) + half * WIDTH // 2
            out.append((i, segment | ((1 << WIDTH // 2) - 1) << at))
    return out


def _longer(mask: int) -> list[int]:
    """The key's bits with one of four parts of the open bits added; none if few are open."""
    still = [b for b in range(64) if not mask >> b & 1]
    if 1 << len(still) <= MOST:
        return []
    cuts = [len(still) * j // (DISTANCE + 1) for j in range(DISTANCE + 2)]
    return [mask | sum(1 << b for b in still[low:high]) for low, high in zip(cuts, cuts[1:])]


def chain_passes(diff: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Places of the differences whose sums along the chain from ``segment`` stay in budget."""
    shift = (segment * WIDTH).astype(np.uint64)
    back = (np.uint64(64) - shift) & np.uint64(63)
    ring = (diff >> shift) | np.where(shift > 0, diff << back, np.uint64(0))
    at = np.arange(len(ring))
    for n in range(1, SEGMENTS + 1):
        low = np.uint64((1 << WIDTH * n) - 1)
        at = at[np.bitwise_count(ring[at] & low) <= n * DISTANCE // SEGMENTS]
    return at


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's least reachable node, as links of nodes that aren't their own."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            moved = np.flatnonzero(label != np.arange(n))
            return label[moved], moved
        label = new


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key; links of the rows with the same key, a batch at a time."""
    kept = None

    def links(rows: np.ndarray) -> pa.RecordBatch:
        path, part, fp = rows
        segment, found = path & 3, []
        at, step = np.arange(len(fp)), 0
        while len(at):
            step += 1
            at = at[at + step < len(fp)]
            at = at[(path[at] == path[at + step]) & (part[at] == part[at + step])]
            diff = (fp[at] ^ fp[at + step]).view(np.uint64)
            near = at[chain_passes(diff, segment[at])]
            if len(near):
                found.append((near, near + step))
        if not found:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])
        a, b = _forest(len(fp), *map(np.concatenate, zip(*found)))
        return pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in ("path", "part", "fp")])
        rows = rows if kept is None else np.concatenate([kept, rows], axis=1)
        # the last key may go on in the next batch; a key has at most MOST rows
        last = (rows[:2] == rows[:2, -1:]).all(axis=0)
        cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
        kept = rows[:, cut:]
        if cut:
            yield links(rows[:, :cut])
    if kept is not None:
        yield links(kept)


def fingerprint_links(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b): links that connect all ``fp`` of ``nodes`` (distinct) within DISTANCE of each other.

    Not every pair in reach is returned, but each is connected by what is.
    """
    spark = nodes.sparkSession
    masks = [(i, i, _signed(mask)) for i, mask in _first_masks()]
    # the low two bits of a path are the segment its chain starts from
    masks = [(k * 4 + i, i, mask) for k, (_, i, mask) in enumerate(masks)]
    keys = F.array(*[F.struct(F.lit(path).cast("long").alias("path"),
                              F.col("fp").bitwiseAND(F.lit(mask).cast("long")).alias("part"))
                     for path, _, mask in masks])
    rows = nodes.select("fp", F.explode(keys).alias("key")).select("key.path", "key.part", "fp")
    known = {path: mask & ((1 << 64) - 1) for path, _, mask in masks}
    links, level = None, 0
    while True:
        more = {path: _longer(mask) for path, mask in known.items()}
        found = written(rows.groupBy("path", "part").agg(F.count(F.lit(1)).alias("size"))
                        .where(F.col("size") > most), f"simhash-large-{level}")
        large = any(more.values()) and not found.isEmpty()
        if large:
            rows = written(join_groups(rows, found, ["path", "part"], "size", "fp"),
                           f"simhash-keys-{level}")
        few = rows.where("size is null") if large else rows
        few = few.select("path", "part", "fp").repartition("path", "part").sortWithinPartitions(
            "path", "part")
        got = written(few.mapInArrow(_bucket_links, "a long, b long"), f"simhash-links-{level}")
        links = got if links is None else links.unionByName(got)
        if not large:
            return links
        # a number of rows that depends on the level alone: 8, 32, 128, ...
        longer = [(path, (k * 4 + j) * 4 + (path & 3), _signed(mask))
                  for k, (path, parts) in enumerate(more.items()) for j, mask in enumerate(parts)]
        known = {new: mask & ((1 << 64) - 1) for _, new, mask in longer}
        table = spark.createDataFrame(longer, "path long, new_path long, mask long")
        rows = rows.where("size is not null").select("path", "fp").join(
            F.broadcast(table), "path").select(
            F.col("new_path").alias("path"), F.expr("fp & mask").alias("part"), "fp").distinct()
        level += 1


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
                       ) -> DataFrame:
    """One row per document: id, fingerprint, component_id, component_size.

    ``fingerprint`` is 16 hex digits; ``component_id`` the least id of the
    component (null ids don't count; null if there is no other). Null and
    empty texts and those without words have fingerprint zero and link like
    any other. Texts of any length are read whole, in windows. Rows that
    repeat id or text give a row each. An empty table gives an empty result.
    Other columns, whatever their names, don't matter.
    """
    rows = written(fingerprints(docs, id_col, text_col), "simhash-rows")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least"),
                                           F.count(F.lit(1)).alias("n")), "simhash-nodes")
    links = written(fingerprint_links(nodes).distinct(), "simhash-links")
    comps = components(links, "simhash").withColumnRenamed("node", "fp")
    nodes = written(nodes.join(comps, "fp", "left").withColumn(
        "comp", F.coalesce("comp", "fp")), "simhash-comps")
    classes = written(nodes.groupBy("comp").agg(
        F.min("least").alias("component_id"), F.sum("n").alias("component_size"),
        F.count(F.lit(1)).alias("n_nodes")), "simhash-classes")
    nodes = written(join_groups(nodes, classes, ["comp"], "n_nodes", "fp").select(
        "fp", "n", "component_id", "component_size"), "simhash-verdicts")
    return join_groups(rows, nodes, ["fp"], "n", "id").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        "component_size")
