"""Importance resampling towards a target distribution, over hashed word n-grams.

Every run of 1 to 3 consecutive words is a feature that falls into one of
``buckets`` buckets by its CRC-32. Comparing the buckets' counts in the target
texts and in all documents gives each bucket a gain; the gains are one short
array, and a document's weight is the sum of that array over its features. A
random term per document turns "the highest scores" into a draw without
replacement (Gumbel top-k).

The k highest are found by numeric bisection, not by a global sort: scored
rows are written once, and count jobs over the narrow score column close in on
the cutoff score, then on the cutoff id among the rows tied at it. Only the
drawn rows are range-partitioned and sorted for their ranks; a rank is the
rows of all partitions before plus the place in the partition.

A CRC of a run of words follows from the CRCs of its words: appending n bytes
is a linear map of the 32 bits, read from tables. So each word is hashed once
and all runs are array operations.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from reelrank.llm.common import fold_words, ship, worker_cache, written

ship(__name__)

BUCKETS, LONGEST = 10_000, 3
#: Thresholds that one count job looks at: four steps of bisection at a time.
FAN = 15
#: Texts are cut into words in windows of about so many bytes.
WINDOW = 1 << 20
CRC32_POLYNOMIAL = 0xEDB88320  # fixed value: reflected polynomial of CRC-32
SHORT = 64


class Crc:
    """CRC-32 of joined byte strings from the CRCs of the parts."""

    def __init__(self) -> None:
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & 1, (one >> 1) ^ np.uint32(CRC32_POLYNOMIAL), one >> 1)
        # short[n, k, b]: the CRC b << 8k after n more zero bytes
        byte = np.arange(256, dtype=np.uint32)
        tables = [np.stack([byte << np.uint32(8 * k) for k in range(4)])]
        for _ in range(SHORT):
            tables.append(one[tables[-1] & 255] ^ (tables[-1] >> 8))
        self.short, long = np.stack(tables[:SHORT]), [tables[SHORT]]
        while len(long) < 32:  # 64, 128, 256, ... bytes
            long.append(self._apply(long[-1], long[-1]))
        self.long = long

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255]
                ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])

    def shifted(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRCs after ``length`` more zero bytes each."""
        low = length % SHORT
        out = (self.short[low, 0, crc & 255] ^ self.short[low, 1, (crc >> 8) & 255]
               ^ self.short[low, 2, (crc >> 16) & 255] ^ self.short[low, 3, crc >> 24])
        high, k = length // SHORT, 0
        while high.any():
            at = np.flatnonzero(high & 1)
            if len(at):
                out[at] = self._apply(self.long[k], out[at])
            high, k = high >> 1, k + 1
        return out


def feature_buckets(raw: bytes, crc: Crc, buckets: int, window: int = WINDOW
                    ) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them), window by window."""
    folded = fold_words(raw)
    before: list[bytes] = []
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + window)
        end = len(folded) if end < 0 else end
        fresh = folded[start:end].split()
        start = end
        if not fresh:
            continue
        words, old = before + fresh, len(before)
        code = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        tail = crc.shifted(np.full(len(words), zlib.crc32(b" "), np.uint32), size) ^ code
        found, run = [code[old:]], code
        for n in range(2, LONGEST + 1):  # run[i]: the n - 1 words that end at i + n - 2
            run = crc.shifted(run[:-1], size[n - 1:] + 1) ^ tail[n - 1:]
            found.append(run[max(0, old - n + 1):])
        yield len(fresh), np.concatenate(found) % np.uint32(buckets)
        before = words[1 - LONGEST:]


def _machine() -> Crc:
    return worker_cache("crc", Crc)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; summed in each task first."""
    raw = texts.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
                       .alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = _machine(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("raw"):
                for _, found in feature_buckets(text.as_py(), crc, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                         names=["bucket", "n"])

    return raw.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket: 1000 times the log of its smoothed share in target over source."""
    # at most ``buckets`` rows each
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (source, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log(float(t.get(b, 0) + 1) * all_s
                                       / (float(s.get(b, 0) + 1) * all_t)))
            for b in range(buckets)]


def weights(docs: DataFrame, gains: list[int], row: Column, text_col: str = "text") -> DataFrame:
    """(row, n_words, n_features, weight) of each whole text by the array of gains."""
    base = docs.select(row.alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
                       .cast("binary").alias("raw"))
    schema = StructType([base.schema["row"], *StructType.fromDDL(
        "n_words long, n_features long, weight long")])
    gain, buckets = np.array(gains, np.int64), len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = _machine()
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column("raw")):
                for words, found in feature_buckets(text.as_py(), crc, buckets):
                    out[:, i] += (words, len(found), gain[found].sum())
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, out)],
                                             names=schema.names)

    return base.mapInArrow(run, schema)


def gumbel(seed: int, id_col: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256(``seed:id``); null id: ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def first_rows(rows: DataFrame, keys: list[str], k: int) -> Column:
    """Condition for exactly the ``k`` first rows in ascending order of long columns ``keys``.

    For each key in turn the least value v with at least k rows up to v is
    bisected by exact counts; if rows tied at v exceed k, the next key
    decides among them. The last key must be unique. ``rows`` should be a
    written table: each job reads one key column of it.
    """
    chosen, tied = [], F.lit(True)
    for name in keys:
        if k <= 0:
            break
        key, at = F.col(name), rows.where(tied)
        low, high = at.agg(F.min(key), F.max(key)).first()
        if low is None:
            break
        low, at_high, below = low - 1, None, 0  # count(low) < k <= count(high)
        while high - low > 1:
            cuts = sorted({low + (high - low) * i // (FAN + 1) for i in range(1, FAN + 1)}
                          - {low, high})
            counts = at.agg(*[F.count_if(key <= F.lit(c).cast("long")).alias(f"c{i}")
                              for i, c in enumerate(cuts)]).first()
            for cut, n in zip(cuts, counts):
                if n < k:
                    low, below = cut, n
                else:
                    high, at_high = cut, n
                    break
        if at_high is None:
            at_high = at.where(key <= F.lit(high).cast("long")).count()
        value = F.lit(high).cast("long")
        if at_high <= k:
            chosen.append(tied & (key <= value))
            break
        chosen.append(tied & (key < value))
        tied, k = tied & (key == value), k - below
    return reduce(Column.__or__, chosen, F.lit(False))


ORDER = ["o_score", "o_null", "o_id", "o_text", "o_row"]


def importance_draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", target_text_col: str = "text", percent: int = 5,
                    min_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
                    with_rows: bool = False) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank (null: not drawn).

    Draws floor(percent/100 of the documents with ``min_words`` words) by the
    highest scores. Ties go to the smaller id, a null id after all others;
    rows that repeat the id go by a hash of their text, then by their place in
    the written table (such rows are equal). Null texts have no words: weight
    0, never drawn (unless ``min_words`` is 0). A text of any length is read
    whole, in windows. Empty tables give an empty result, an empty ``target``
    equal shares. Other columns, whatever their names, don't matter;
    ``with_rows`` adds the input row as the struct ``row``. Ids are integers.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    gains = bucket_gains(bucket_counts(docs, text_col, buckets),
                         bucket_counts(target, target_text_col, buckets), buckets)
    parts = [F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"),
                                                              F.lit(""))).alias("text")]
    if with_rows:
        parts.append(F.struct(*docs.columns).alias("all"))
    scored = weights(docs, gains, F.struct(*parts), text_col)
    score = F.col("weight") + gumbel(seed, F.col("row.id"))
    rows = written(scored.select(
        F.col("row.id").alias("id"), "n_words", "n_features", "weight", score.alias("score"),
        (-score).alias("o_score"), F.col("row.id").isNull().cast("long").alias("o_null"),
        F.coalesce("row.id", F.lit(0)).cast("long").alias("o_id"),
        F.col("row.text").alias("o_text"), F.monotonically_increasing_id().alias("o_row"),
        *([F.col("row.all").alias("row")] if with_rows else [])), "resample-scores")
    able = rows.where(F.col("n_words") >= min_words)
    drawn = (F.col("n_words") >= min_words) & first_rows(able, ORDER, able.count() * percent // 100)
    names = ["id", "n_words", "n_features", "weight", "score", *(["row"] if with_rows else [])]
    placed = rows.where(drawn).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    placed = written(placed.select(*names, F.monotonically_increasing_id().alias("place")),
                     "resample-drawn")
    # the id numbers the partition from bit 33 up and the row in it below
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    start, before = 0, []
    for r in sorted(sizes):  # one row per partition
        before.append((r["part"], start))
        start += r["n"]
    before = rows.sparkSession.createDataFrame(before, "part long, start long")
    ranked = placed.withColumn("part", part).join(F.broadcast(before), "part").select(
        *names, (F.col("start") + within + 1).alias("rank"))
    return rows.where(~drawn).select(*names, F.lit(None).cast("long").alias("rank")).unionByName(
        ranked)


def importance_sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns (options as for ``importance_draw``)."""
    drawn = importance_draw(docs, target, with_rows=True, **options).where("rank is not null")
    return drawn.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
