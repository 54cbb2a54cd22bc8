"""Token-ID output as fixed-width bit-packed files (data source ``packed_ids``).

Format of a file: blocks of BLOCK ids, each id in the least number of bits
that holds the vocabulary, bits little-endian, blocks byte-aligned; then four
int64 arrays (document ids, their first places in the file, a null mark each,
block byte offsets); then a JSON footer, its length (uint32) and a magic. An
id's place gives its block and bit, so any range of ids is read by seeking to
its blocks and unpacked with numpy, without what comes before.

Files are written by tasks under names unique to the attempt; the commit
lists them in task order in a manifest. The driver sees one entry per file.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

from reelrank.llm.common import map_texts, ship, worker_cache
from reelrank.llm.files import delete_files, new_part, open_fs, read_manifest, write_manifest

ship(__name__)

MAGIC = b"PKIDS001"
BLOCK = 1 << 16
SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
_BLANKS = re.compile(r"[\t-\r ]+")
WORDS_KEPT, UNITS_KEPT = 350_000, 250_000
# Words of which each character is visible ASCII or a Latin-1 letter. In them
# tokens end between letters and signs and around digits, unless an apostrophe
# or a special token's mark is about.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
_UNITS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
# The text preparation for which that holds.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> list[str]:
    """The letter that byte-level tokenizers write for each byte."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


def width_of(vocabulary: int) -> int:
    """Least number of bits that holds the ids below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each, little-endian; whole bytes at the end."""
    if width in (8, 16, 32):  # the same bits, without handling them one by one
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype("<u4")[:, None] >> np.arange(width, dtype="<u4")) & 1
    return np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, width: int, first: int, count: int) -> np.ndarray:
    """``count`` ids from the ``first`` on, as uint32."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(data, f"<u{size}", count, first * size).astype("<u4")
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    windows = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at = (first + np.arange(count, dtype=np.int64)) * width
    picked = windows[at >> 3] >> (at & 7).astype("<u8")
    return (picked & np.uint64((1 << width) - 1)).astype("<u4")


class _PackedFile:
    """A file being written: ids go out block by block."""

    def __init__(self, path: str, width: int) -> None:
        system, inner = open_fs(path)
        self.out = system.open_output_stream(inner, compression=None, buffer_size=1 << 20)
        self.path, self.width, self.size, self.n_ids = path, width, 0, 0
        self.docs, self.starts, self.nulls, self.offsets = [], [], [], []
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(0 if doc_id is None else doc_id)
        self.nulls.append(int(doc_id is None))
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            self._blocks(False)

    def _blocks(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            data = pack(ids[i:min(i + BLOCK, whole)], self.width)
            self.offsets.append(self.size)
            self.out.write(data)
            self.size += len(data)
        self.held = [ids[whole:]]
        self.n_held = len(ids) - whole

    def close(self) -> dict:
        self._blocks(True)
        for array in (self.docs, self.starts, self.nulls, self.offsets):
            self.out.write(np.asarray(array, "<i8").tobytes())
        footer = json.dumps({"width": self.width, "block": BLOCK, "n_ids": self.n_ids,
                             "n_docs": len(self.docs), "n_blocks": len(self.offsets),
                             "index": self.size}).encode()
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()
        return {"path": self.path, "n_ids": self.n_ids, "n_docs": len(self.docs),
                "bytes": self.size}


class PackedReaderFile:
    """Random access to a packed file."""

    def __init__(self, path: str) -> None:
        system, inner = open_fs(path)
        self.src = system.open_input_file(inner)
        size = self.src.size()
        tail = self._at(size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is not a packed id file")
        n = struct.unpack("<I", tail[:4])[0]
        meta = json.loads(self._at(size - 12 - n, n))
        self.width, self.block, self.n_ids = meta["width"], meta["block"], meta["n_ids"]
        self.n_docs, self.index, self.n_blocks = meta["n_docs"], meta["index"], meta["n_blocks"]

    def _at(self, start: int, n: int) -> bytes:
        self.src.seek(start)
        return self.src.read(n)

    def _ints(self, first: int, n: int) -> np.ndarray:
        return np.frombuffer(self._at(self.index + 8 * first, 8 * n), "<i8")

    def docs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, null marks and n+1 bounds of documents ``low`` up to ``high``."""
        count = self.n_docs
        bounds = self._ints(count + low, high - low)
        after = self._ints(count + high, 1) if high < count else np.array([self.n_ids])
        return (self._ints(low, high - low), self._ints(2 * count + low, high - low),
                np.concatenate([bounds, after]))

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from place ``start`` up to ``end``, from their blocks alone."""
        if start >= end:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (end - 1) // self.block
        offsets = self._ints(3 * self.n_docs + first, last - first + 1)
        bytes_end = int(offsets[-1]) + (self.block * self.width + 7) // 8
        data = self._at(int(offsets[0]), min(bytes_end, self.index) - int(offsets[0]))
        # whole blocks take whole bytes, so the blocks are one run of bits
        return unpack(data, self.width, start - first * self.block, end - start)


class _DocRange(InputPartition):
    def __init__(self, path: str, base: int, low: int, high: int) -> None:
        super().__init__(None)
        self.path, self.base, self.low, self.high = path, base, low, high


class PackedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns, self.options = schema.fieldNames(), options
        from pyspark.sql.pandas.types import to_arrow_schema
        self.arrow = to_arrow_schema(schema)

    def partitions(self) -> list[InputPartition]:
        most = int(self.options.get("idsperpartition", 1 << 25))
        parts, base = [], 0
        for f in read_manifest(self.options["path"]) or []:
            cuts = max(1, -(-f["n_ids"] // most))
            for i in range(cuts):
                low, high = f["n_docs"] * i // cuts, f["n_docs"] * (i + 1) // cuts
                if low < high:
                    parts.append(_DocRange(f["path"], base, low, high))
            base += f["n_ids"]
        return parts or [_DocRange("", 0, 0, 0)]

    def read(self, p: _DocRange) -> Iterator[pa.RecordBatch]:
        if p.low == p.high:
            return
        src = PackedReaderFile(p.path)
        docs, nulls, bounds = src.docs(p.low, p.high)
        low = 0
        while low < len(docs):
            # about a million ids, or one document, at a time
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + (1 << 20), "right")) - 1)
            n = high - low
            columns = {
                "doc_id": pa.array(docs[low:high], mask=nulls[low:high].astype(bool)),
                "start": pa.array(bounds[low:high] + p.base),
                "n_tokens": pa.array(np.diff(bounds[low:high + 1])),
            }
            if {"ids", "ids_crc32"} & set(self.columns):
                data = src.ids(int(bounds[low]), int(bounds[high])).tobytes()
                ends = (bounds[low:high + 1] - bounds[low]) * 4
                view = memoryview(data)
                columns["ids_crc32"] = pa.array([zlib.crc32(view[a:b]) for a, b in
                                                 zip(ends.tolist(), ends[1:].tolist())], pa.int64())
            if "ids" in self.columns:
                columns["ids"] = pa.Array.from_buffers(pa.binary(), n, [
                    None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [columns[c].cast(self.arrow.field(c).type) for c in self.columns],
                schema=self.arrow)
            low = high


class _Written(WriterCommitMessage):
    def __init__(self, partition: int, files: list[dict]) -> None:
        self.partition, self.files = partition, files


class PackedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path, self.width = options["path"], width_of(int(options["vocabulary"]))
        self.roll = int(options.get("idsperfile", 1 << 30))
        self.tokenizer, self.end = None, b""
        if "tokenizer" in options:  # on the driver; workers get the file's bytes
            with open(options["tokenizer"], "rb") as f:
                self.tokenizer = f.read()
            self.end = struct.pack("<I", int(options["end_id"]))

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        partition, files, out = TaskContext.get().partitionId(), [], None
        system, inner = open_fs(self.path)
        system.create_dir(inner, recursive=True)
        coder = _encoder(self.tokenizer) if self.tokenizer else None
        for batch in batches:
            values = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                if out is None:
                    out = _PackedFile(new_part(self.path, partition, ".ids"), self.width)
                ids = coder.encode(values[i].as_py()) + self.end if coder else values[i].as_buffer()
                out.add(doc_id, np.frombuffer(ids, "<u4"))
                if out.n_ids >= self.roll:
                    files.append(out.close())
                    out = None
        if out is not None:
            files.append(out.close())
        return _Written(partition, files)

    def commit(self, messages: list[_Written]) -> None:
        done = sorted((m for m in messages if m), key=lambda m: m.partition)
        write_manifest(self.path, [f for m in done for f in m.files])

    def abort(self, messages: list[_Written]) -> None:
        delete_files([f["path"] for m in messages if m for f in m.files])


class PackedIds(DataSource):
    """Options: path; vocabulary, idsPerFile, tokenizer, end_id (write); idsPerPartition (read)."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PackedReader:
        return PackedReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> PackedWriter:
        return PackedWriter(dict(self.options))


KEY_CHARS = 64  # of a remembered key


class _Memory(dict):
    """What ``make`` gives for a key, remembered for up to ``most`` keys at a time.

    Long keys are made anew each time, which bounds the bytes as well.
    """

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if isinstance(key, int) or len(key) <= KEY_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = got
        return got


class WordEncoder:
    """Ids of whole texts through a bounded memory of word encodings.

    For tokenizers that drop white space and never let a token cross it, a
    text's ids are its words' ids in order. If the tokenizer's preparation is
    the one that ``_UNITS`` describes, plain words are cut into units for
    which preparation is known, and the library's merge model encodes them;
    all other words go through the whole library. Memories are emptied when
    full.
    """

    def __init__(self, tokenizer_json: bytes) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_json)
        spec = json.loads(tokenizer_json)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_unit = steps == _NORMALIZER and [n["type"] for n in splits] == [
            "Split", "ByteLevel"] and splits[0]["pattern"].get("Regex") == _SPLIT and (
            splits[0]["invert"] and not splits[1]["add_prefix_space"]
            and not splits[1]["use_regex"] and splits[0]["behavior"] == "Removed")
        self.letters = _byte_letters()
        self.words = _Memory(self._word, WORDS_KEPT)
        self.units = _Memory(self._unit, UNITS_KEPT)

    def _unit(self, unit: str) -> bytes:
        letters = unit if unit.isascii() else "".join([self.letters[b] for b in unit.encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if self.by_unit and _PLAIN.fullmatch(word) and "'" not in word and "<|" not in word:
            return b"".join([self.units[u] for u in _UNITS.findall(word.lower())])
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        # str.split() cuts at four separators that aren't white space in Unicode
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")
        words = _BLANKS.split(text) if odd else text.split()
        return b"".join(map(self.words.__getitem__, words))


def _encoder(tokenizer_json: bytes) -> WordEncoder:
    return worker_cache(f"word-encoder-{zlib.crc32(tokenizer_json)}",
                        lambda: WordEncoder(tokenizer_json))


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids): each text's token ids and the end id, uint32 little-endian, in row order.

    The tokenizer file is read on the driver and shipped, so workers need no
    copy. Null texts count as empty.
    """
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    end = struct.pack("<I", end_id)

    def kernel(texts: list[str]) -> list:
        coder = _encoder(data)
        return [[coder.encode(t) + end for t in texts]]

    return map_texts(docs, id_col, text_col, kernel, "ids binary")


def in_order(docs: DataFrame, id_col: str, payload: str) -> DataFrame:
    """(doc_id, payload) sorted over all partitions by id, then by a hash of the payload.

    Ranges are cut over (id, hash), so a repeated id is no hot key and ties
    have a fixed order; null ids come first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(payload),
                       F.xxhash64(F.col(payload)).alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return rows.select("doc_id", payload)


def write_packed(docs: DataFrame, path: str, vocabulary: int, tokenizer_path: str | None = None,
                 end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> None:
    """Write documents as packed files in ascending id order.

    With ``tokenizer_path`` the writing tasks encode the texts (null: empty)
    and append ``end_id``; without it ``docs`` has ``ids``, uint32
    little-endian. An empty table writes an empty manifest.
    """
    docs.sparkSession.dataSource.register(PackedIds)
    if tokenizer_path is not None:
        text = docs.withColumn("text", F.coalesce(F.col(text_col), F.lit("")))
        rows = in_order(text, id_col, "text")
        options |= {"tokenizer": tokenizer_path, "end_id": end_id}
    else:
        rows = in_order(docs, id_col, "ids")
    rows.write.format("packed_ids").mode("append").option("vocabulary", vocabulary).options(
        **options).save(path)


def read_packed(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    ``ids`` are uint32 little-endian and ``ids_crc32`` the unsigned CRC-32 of
    those bytes as read. With neither among the columns only the indexes are
    read.
    """
    spark.dataSource.register(PackedIds)
    schema = StructType.fromDDL(SCHEMA)
    if columns is not None:
        schema = StructType([schema[c] for c in columns])
    return spark.read.format("packed_ids").schema(schema).load(path)
