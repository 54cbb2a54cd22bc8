"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers' tokens of a text, seen as byte ranges, end together at some
offsets; those cut the text into groups. Every A token of a group is linked to
every B token of it, and an id pair counts in how many documents it is linked.

1. A task encodes its texts and inverts them in chunks of at most ``DOCUMENTS``
   documents: a posting row per (chunk, pair) with bitmaps of the chunk's
   documents, one plane per bit of the pair's multiplicity (a document is in
   plane p if bit p of its number of links is set). Bitmaps are compressed: up
   to ``DENSE`` documents as a list of 16-bit places, more as 32,768 bits.
2. The OR of the planes holds the documents of the pair; its popcount is the
   chunk's document count, and plane popcounts weighted by 2^p are its links.
   Chunks have no document in common, so over chunks counts add up; the best
   count of each A id follows.
3. Posting rows fetch their pair's count and return it to the documents: dealt
   by chunk, a task adds up 2^p times the count over its planes' documents.

So what moves is postings of a few bytes, never a row per link, and no task
holds more than one chunk. A text of any length is one document of a chunk.

Long texts are encoded in windows, cut where a non-space is followed by one
blank and a non-space: the byte-level pattern never joins those, nor has any
piece text before a space sign. A window stands for a blank and its text, which
is the blank that either tokenizer puts in front.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelrank.llm.common import join_groups, ship, worker_cache, written

ship(__name__)

SPACE = "▁"
DOCUMENTS = 32_768  # of a chunk at most
POSTINGS = 1 << 21  # of a chunk, after which no further document is added
DENSE = 2047  # documents in a list of places; a full bitmap takes 4,096 bytes
WINDOW = 1 << 20  # characters of a text that are encoded at a time
ENUMERATED = 4096  # links of a group that are listed one by one
CUT = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: the pattern that cuts texts of byte-level BPE models.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
           r"""|\s+(?!\S)|\s+""")
_SHIFT = 32


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers: a byte-level BPE as JSON and a SentencePiece model."""

    def __init__(self, a_json: bytes, b_model: bytes) -> None:
        import sentencepiece

        spec = json.loads(a_json)
        letter = _byte_letters()
        tokens = {bytes(map(letter.__getitem__, t)): i
                  for t, i in spec["model"]["vocab"].items()}
        self._encode_a = _encoder(a_json, spec, tokens)
        n_a = max(tokens.values()) + 1
        self.a_size = np.zeros(n_a, np.int64)
        for t, i in tokens.items():
            self.a_size[i] = len(t)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.b_unknown = self.b.unk_id()
        n_b = self.b.get_piece_size()
        names = list(map(self.b.id_to_piece, range(n_b)))
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                   else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        if any(p.lstrip(b" ").count(b" ") for p in b_bytes):
            raise ValueError("pieces that hold a blank after text are not supported")
        self.b_size = np.array(list(map(len, b_bytes)), np.int64)
        # texts of ids within and at the end of a side of a group, as characters and a mask
        self.n_a, self.n_b = n_a, n_b
        printed = np.array([f"{i}{sign}".encode() for n, signs in ((n_a, ",|"), (n_b, ",;"))
                            for sign in signs for i in range(n)])
        self.printed = printed.view(np.uint8).reshape(len(printed), -1)
        self.present = self.printed > 0

    def align(self, text: str):
        """(n_a, n_b, n_groups, printed groups, pairs, [(A ids, B ids) of large groups]).

        Of a blank and the text; None if either side's tokens don't give it back.
        """
        size = 1 + len(text.encode())
        a, b = (np.array(ids, np.int64) for ids in (
            self._encode_a(" " + text), self.b.encode(text, num_threads=1)))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        # tokens are parts of the text (pieces: with blanks as space signs), so they give it
        # back unless it has that sign itself, a piece is unknown or the lengths differ
        if SPACE in text or (b == self.b_unknown).any() or not (
                a_end[-1] == b_end[-1] == size):
            return None
        at = np.searchsorted(b_end, a_end)
        a_last = np.flatnonzero(b_end[at] == a_end)  # both sides end with the last byte
        b_last = at[a_last]
        a_first, b_first = (np.concatenate([[0], x[:-1] + 1]) for x in (a_last, b_last))
        p, q = a_last - a_first + 1, b_last - b_first + 1
        a_group, b_group = (np.repeat(np.arange(len(p)), x) for x in (p, q))
        # a token is preceded by its own side's tokens and by the groups' other sides before
        codes = np.empty(len(a) + len(b), np.int64)
        code, other = a.copy(), 2 * self.n_a + b
        code[a_last] += self.n_a
        other[b_last] += self.n_b
        codes[np.arange(len(a)) + b_first[a_group]] = code
        codes[np.arange(len(b)) + a_last[b_group] + 1] = other
        groups = self.printed[codes][self.present[codes]].tobytes()[:-1]
        large = p * q > ENUMERATED
        times = np.where(large, 0, q)[a_group]  # links of each A token
        before = np.cumsum(times) - times
        partner = np.arange(times.sum()) + np.repeat(b_first[a_group] - before, times)
        pairs = np.repeat(a << _SHIFT, times) | b[partner]
        more = [(a[a_first[g]:a_last[g] + 1].tolist(), b[b_first[g]:b_last[g] + 1].tolist())
                for g in np.flatnonzero(large)]
        return len(a), len(b), len(p), groups, pairs, more


def _encoder(a_json: bytes, spec: dict, tokens: dict[bytes, int]):
    """Function from text to ids of a byte-level BPE.

    Where ids count up in the order of the merges and text is cut by the usual
    pattern, tiktoken encodes by the file's vocabulary, several times as fast
    as the tokenizers library, which is used for any other file.
    """
    model, cutter = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    letter = _byte_letters()
    merged = [tokens.get(bytes(map(letter.get, "".join(m)))) for m in merges]
    ranked = (merged == sorted(set(merged) - {None}) and len(tokens) == 256 + len(merges)
              and cutter.get("type") == "ByteLevel" and cutter.get("use_regex")
              and not cutter.get("add_prefix_space") and not spec.get("normalizer")
              and not model.get("ignore_merges"))
    if ranked:
        import tiktoken

        encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=tokens,
                                     special_tokens={})
        return encoding.encode_ordinary
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(a_json.decode())
    library.encode_special_tokens = True
    return lambda text: library.encode(text, add_special_tokens=False).ids


def _windows(text: str) -> Iterator[str]:
    start = 0
    while True:
        at = CUT.search(text, start + WINDOW) if len(text) - start > WINDOW else None
        yield text[start:at.start()] if at else text[start:]
        if not at:
            return
        start = at.end()


def _weighted(a: list[int], b: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, links) of a large group, an A id at a time."""
    ids, times = map(np.array, zip(*Counter(b).items()))
    for x, n in Counter(a).items():
        yield ids.astype(np.int64) + (x << _SHIFT), times.astype(np.int64) * n


def align_text(aligner: Aligner, text: str):
    """(n_a, n_b, n_groups, n_links, digest, pairs, links per pair) of a text.

    Zeros and '' for an empty text and one that the tokens don't give back.
    """
    zero = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not text:
        return zero
    digest, counts, pairs, links = hashlib.sha256(), np.zeros(3, np.int64), [], []
    for window in _windows(text):
        found = aligner.align(window)
        if found is None:
            return zero
        if counts[2]:
            digest.update(b";")
        digest.update(found[3])
        counts += found[:3]
        some, times = np.unique(found[4], return_counts=True)
        pairs.append(some)
        links.append(times)
        for a, b in found[5]:
            for some, times in _weighted(a, b):
                pairs.append(some)
                links.append(times)
    if len(pairs) > 1:
        all_pairs, all_links = np.concatenate(pairs), np.concatenate(links)
        some, at = np.unique(all_pairs, return_inverse=True)
        times = np.zeros(len(some), np.int64)
        np.add.at(times, at, all_links)
    else:
        some, times = pairs[0], links[0]
    return (*counts.tolist(), int(times.sum()), digest.hexdigest(), some, times)


def _bitmaps(plane: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the compressed bitmaps of runs of equal ``plane`` numbers.

    ``plane`` is sorted and counts from 0 without gaps.
    """
    size = np.bincount(plane)
    start = np.concatenate([[0], np.cumsum(size)])
    width = np.where(size > DENSE, DOCUMENTS // 8, 2 * size)
    offsets = np.concatenate([[0], np.cumsum(width)])
    raw = place.astype("<u2").view(np.uint8)
    if len(raw) == offsets[-1] and not (size > DENSE).any():
        return offsets, raw
    out, done = [], 0
    for i in np.flatnonzero(size > DENSE):
        out.append(raw[2 * done:2 * start[i]])
        bits = np.zeros(DOCUMENTS, bool)
        bits[place[start[i]:start[i + 1]]] = True
        out.append(np.packbits(bits, bitorder="little"))
        done = start[i + 1]
    return offsets, np.concatenate([*out, raw[2 * done:]])


def unpacked(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap number, place) of every document of compressed bitmaps."""
    width = np.diff(offsets)
    dense = np.flatnonzero(width == DOCUMENTS // 8)
    lists = np.ones(len(raw), bool)
    for i in dense:
        lists[offsets[i]:offsets[i + 1]] = False
    place = [raw[lists].view("<u2").astype(np.int64)]
    number = [np.repeat(np.arange(len(width)), np.where(width == DOCUMENTS // 8, 0, width // 2))]
    for i in dense:
        found = np.flatnonzero(np.unpackbits(raw[offsets[i]:offsets[i + 1]], bitorder="little"))
        place.append(found)
        number.append(np.full(len(found), i))
    return np.concatenate(number), np.concatenate(place)


def _postings(chunk: int, pairs: list, links: list) -> list[pa.Array]:
    """Arrays chunk, pair, n_docs, n_links, planes of a chunk's documents, by pair."""
    place = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
    pair, link = np.concatenate(pairs), np.concatenate(links)
    order = np.argsort(pair, kind="stable")
    pair, place, link = pair[order], place[order], link[order]
    first = np.concatenate([[True], pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    names, row = pair[start], np.cumsum(first) - 1
    n_docs = np.diff(np.concatenate([start, [len(pair)]]))  # the popcount of the planes' OR
    n_links = np.add.reduceat(link, start) if len(start) else np.zeros(0, np.int64)
    top = np.maximum.reduceat(link, start) if len(start) else np.zeros(0, np.int64)
    planes = np.frexp(top.astype(float))[1]  # bits of the largest multiplicity
    before = np.concatenate([[0], np.cumsum(planes)])
    numbers, places = [], []
    for p in range(int(planes.max(initial=0))):
        at = np.flatnonzero(link >> p & 1)
        numbers.append(before[row[at]] + p)
        places.append(place[at])
    number = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
    places = np.concatenate(places) if places else np.zeros(0, np.int64)
    order = np.argsort(number, kind="stable")
    number, places = number[order], places[order]
    # a plane below the highest may be empty: its bitmap has no bytes
    filled, dense_number = np.unique(number, return_inverse=True)
    ends, raw = _bitmaps(dense_number, places)
    width = np.zeros(int(before[-1]), np.int64)
    width[filled] = np.diff(ends)
    offsets = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
    values = pa.BinaryArray.from_buffers(pa.binary(), len(width), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])
    return [pa.array(np.full(len(names), chunk, np.int64)), pa.array(names),
            pa.array(n_docs.astype(np.int64)), pa.array(n_links.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), values)]


_DOCUMENT = ("place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")
_POSTING = "pair long, n_docs long, pair_links long, planes array<binary>"


def _machine(a_json: bytes, b_model: bytes) -> Aligner:
    name = f"aligner-{zlib.crc32(a_json)}-{zlib.crc32(b_model)}"
    return worker_cache(name, lambda: Aligner(a_json, b_model))


class Alignment:
    """The alignment of a table's texts under two tokenizers, from written tables.

    Null and empty texts have no tokens, nor have texts that the tokens of
    either side don't give back (with U+2581, which decodes as a blank): zeros
    and ''. Texts are read whole, whatever their length. Rows that repeat id
    or text are documents of their own; null ids stay null. An empty table
    gives empty tables. Of the input only the id and the text column are used,
    so others may have any name. The tokenizer files are read on the driver
    and shipped.
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
        with open(a_path, "rb") as f, open(b_path, "rb") as g:
            a_json, b_model = f.read(), g.read()
        base = docs.select(F.col(id_col).alias("id"), F.coalesce(
            F.col(text_col).cast("string"), F.lit("")).alias("text"))
        schema = StructType([*StructType.fromDDL("chunk long"), base.schema["id"],
                             *StructType.fromDDL(_DOCUMENT), *StructType.fromDDL(_POSTING)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            kinds = list(arrow)
            machine = _machine(a_json, b_model)
            # partitions number their chunks from here on
            chunk = TaskContext.get().partitionId() << _SHIFT
            ids, rows, pairs, links, held = [], [], [], [], 0

            def flushed() -> Iterator[pa.RecordBatch]:
                n = len(rows)
                cols = [pa.array(np.full(n, chunk, np.int64)), pa.array(ids, kinds[1].type),
                        pa.array(np.arange(n, dtype=np.int32))]
                cols += [pa.array(c, k.type) for c, k in zip(zip(*rows), kinds[3:8])]
                cols += [pa.nulls(n, k.type) for k in kinds[8:]]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)
                if held:
                    number, *posting = _postings(chunk, pairs, links)
                    m = len(number)
                    cols = [number, *[pa.nulls(m, k.type) for k in kinds[1:8]],
                            *[c.cast(k.type) for c, k in zip(posting, kinds[8:])]]
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)

            for batch in batches:
                for name, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                    *row, some, times = align_text(machine, text.as_py())
                    ids.append(name)
                    rows.append(row)
                    pairs.append(some)
                    links.append(times)
                    held += len(some)
                    if held >= POSTINGS or len(rows) == DOCUMENTS:
                        yield from flushed()
                        chunk += 1
                        ids, rows, pairs, links, held = [], [], [], [], 0
            if rows:
                yield from flushed()

        table = written(base.mapInArrow(run, schema), "align-chunks")
        self._rows = table.where("place is not null").select("chunk", *[
            c for c in schema.names[1:8]])
        self._postings = table.where("pair is not null").select(
            "chunk", "pair", "n_docs", "pair_links", "planes")
        counts = written(self._postings.groupBy("pair").agg(
            F.sum("n_docs").alias("count"), F.sum("pair_links").alias("links"),
            F.count(F.lit(1)).alias("chunks")), "align-counts")
        a_id = F.shiftright("pair", _SHIFT)
        # one row per A id: bounded by its vocabulary
        best = counts.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("best"))
        self._pairs = written(counts.withColumn("a_id", a_id).join(
            F.broadcast(best), "a_id").select(
            "pair", "count", "links", "chunks", (F.col("count") == F.col("best")).alias("best")),
            "align-pairs")

    def pairs(self) -> DataFrame:
        """(a_id, b_id, n_docs, n_links, best): counts of each linked id pair over all texts."""
        return self._pairs.select(
            F.shiftright("pair", _SHIFT).cast("int").alias("a_id"),
            F.col("pair").bitwiseAND((1 << _SHIFT) - 1).cast("int").alias("b_id"),
            F.col("count").alias("n_docs"), F.col("links").alias("n_links"), "best")

    def documents(self) -> DataFrame:
        """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

        ``n_best`` counts the links whose pair has its A id's highest count,
        ``count_sum`` adds up the counts over all links.
        """
        scored = join_groups(self._postings.select("chunk", "pair", "planes"),
                             self._pairs.select("pair", "count", "best", "chunks"),
                             ["pair"], "chunks", "chunk")
        none = [F.lit(None).cast(t).alias(c) for c, t in self._rows.dtypes if c != "chunk"]
        scored = scored.select("chunk", "planes", "count", F.col("best").cast("long").alias("best"),
                               *none)
        rows = self._rows.select("chunk", *[F.lit(None).cast(t).alias(c) for c, t in
                                            scored.dtypes[1:4]], *self._rows.columns[1:])
        # a chunk's postings come before its documents
        both = scored.unionByName(rows).repartition("chunk").sortWithinPartitions(
            "chunk", F.asc_nulls_first("place"))
        names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        schema = StructType([*[both.schema[c] for c in names],
                             *StructType.fromDDL("n_best long, count_sum long")])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, sums = None, np.zeros((2, DOCUMENTS), np.int64)
            for batch in batches:
                chunk = batch.column("chunk").to_numpy()
                cuts = np.flatnonzero(chunk[1:] != chunk[:-1]) + 1
                for low, high in zip([0, *cuts], [*cuts, len(chunk)]):
                    part = batch.slice(low, high - low)
                    if chunk[low] != at:
                        at, sums[:] = chunk[low], 0
                    n = part.column("place").null_count
                    _returned(part.slice(0, n), sums)
                    part = part.slice(n)
                    if part.num_rows:
                        place = part.column("place").to_numpy()
                        yield pa.RecordBatch.from_arrays(
                            [*[part.column(c) for c in names], *map(pa.array, sums[:, place])],
                            names=schema.names)

        return both.mapInArrow(run, schema).select(
            *names[:-1], "n_best", "count_sum", "groups_sha256")


def _returned(part: pa.RecordBatch, sums: np.ndarray) -> None:
    """Add what a chunk's postings return: best links, then counts, by document."""
    if not part.num_rows:
        return
    planes = part.column("planes")
    start = planes.offsets.to_numpy()
    sizes = np.diff(start)
    flat = planes.values.slice(start[0], start[-1] - start[0])
    row = np.repeat(np.arange(len(sizes)), sizes)
    plane = np.arange(len(row)) - np.repeat(start[:-1] - start[0], sizes)
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    number, place = unpacked(offsets.astype(np.int64) - int(offsets[0]), raw)
    times = np.left_shift(1, plane[number])
    for to, name in zip(sums, ("best", "count")):
        np.add.at(to, place, times * part.column(name).to_numpy()[row[number]])
