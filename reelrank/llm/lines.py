"""Line dedup over overlapping three-line windows.

The lines of a document that hold more than white space are taken in order;
every three consecutive ones form a window (a document with fewer such lines
is one window). Windows are hashed to 128 bits, equal windows are found over
the whole corpus, and all but the first occurrence (smallest id, then place)
go: the lines they cover are merged and removed. Blank lines stay.

A window that a third of all documents share is counted with map-side
combining and found again through ``join_groups``; no group is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelrank.llm.common import join_groups, ship, written

WINDOW = 3
_WHITE = " \t\n\x0b\x0c\r"

ship(__name__)


def solid_lines(lines: list[str]) -> list[int]:
    """Places of the lines that hold more than (ASCII) white space."""
    return [i for i, x in enumerate(lines) if x.strip(_WHITE)]


def window_hashes(text: str) -> list[tuple[int, int]]:
    """128-bit hashes (as two signed longs) of the windows of a text, in order."""
    lines = text.split("\n")
    solid = [lines[i].encode("utf-8", "surrogatepass") for i in solid_lines(lines)]
    out = []
    for i in range(max(1, len(solid) - WINDOW + 1) if solid else 0):
        part = solid[i:i + WINDOW]
        digest = xxhash.xxh3_128_digest(b"\n".join(part), len(part))
        out.append((int.from_bytes(digest[:8], "big", signed=True),
                    int.from_bytes(digest[8:], "big", signed=True)))
    return out


def without_windows(text: str, starts: list[int]) -> tuple[str, int]:
    """The text without the lines that the windows at ``starts`` cover; lines removed."""
    lines = text.split("\n")
    solid = solid_lines(lines)
    covered = {solid[i] for s in starts for i in range(s, min(s + WINDOW, len(solid)))}
    return "\n".join(x for i, x in enumerate(lines) if i not in covered), len(covered)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, place, high, low = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            for i, (a, b) in enumerate(window_hashes(text)):
                at.append(row)
                place.append(i)
                high.append(a)
                low.append(b)
        index = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(index), batch.column("th").take(index),
             pa.array(place, pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())],
            names=["id", "th", "place", "h1", "h2"])


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed, total = [], [], []
        for text, starts in zip(batch.column("text").to_pylist(),
                                batch.column("starts").to_pylist()):
            total.append(0 if text is None else text.count("\n") + 1)
            if text is not None and starts:
                text, n = without_windows(text, starts)
                removed.append(n)
            else:
                removed.append(0)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
             pa.array(removed, pa.int64())], names=["row", "text", "n_lines", "n_removed"])


def repeated_windows(docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, th, starts): places of the windows of a document that go.

    ``th`` is a hash of the text; (id, th) is a document's identity.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("th")).where("text is not null")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, th long, place int, h1 long, h2 long"
    found = written(base.mapInArrow(_windows, schema), "line-windows")
    first = found.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "th", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = written(first.where("n > 1"), "line-repeats")
    again = join_groups(found, first, ["h1", "h2"], "n", "id")
    again = again.where("first is not null and not (id <=> first.id and th = first.th "
                        "and place = first.place)")
    return again.groupBy("id", "th").agg(F.collect_set("place").alias("starts"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                details: bool = False) -> DataFrame:
    """``docs`` with the text free of repeated three-line windows.

    All rows and columns stay; ``details=True`` adds n_lines and n_removed.
    Null texts stay null (0 lines) and have no windows; rows with the same id
    and text are one document, so neither loses lines to the other; a null id
    sorts first. Lines are compared byte by byte through the hash, case and
    inner white space included. ``details`` takes the place of columns of these
    names; others may have any name. An empty table gives an empty result.
    """
    starts = repeated_windows(docs, id_col, text_col).select(
        F.col("id").alias("s_id"), F.col("th").alias("s_th"), "starts")
    rest = [c for c in docs.columns if c != text_col]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("th"))
    rows = rows.join(starts, F.col("id").eqNullSafe(F.col("s_id")) &
                     (F.col("th") == F.col("s_th")), "left").select("row", "text", "starts")
    schema = StructType([rows.schema["row"], *StructType.fromDDL(
        "text string, n_lines long, n_removed long")])
    out = rows.mapInArrow(_clean, schema)
    extra = ["n_lines", "n_removed"] if details else []
    return out.select(*[F.col("text").alias(c) if c == text_col
                        else F.col("row").getField(c).alias(c)
                        for c in docs.columns if c not in extra], *extra)
