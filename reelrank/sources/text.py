"""Text loaders for movies (``^``-separated), ratings and tags (comma-separated).

Each loader returns ``(good, rejects)``: malformed lines do not fail the job,
they go to a reject DataFrame with the raw line. Reads are splittable text /
CSV scans, so they parallelise over the input files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelrank.config import MOVIE_FIELD_SEP

MOVIE_COLUMNS = ["mid", "name", "descri", "timelog", "issue", "shoot", "language",
                 "genres", "actors", "directors"]
RATING_SCHEMA = "uid bigint, mid bigint, score double, timestamp bigint"
TAG_COLUMNS = ["uid", "mid", "tag", "timestamp"]


def parse_movie_lines(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``mid^name^descri^...^directors`` -> 10 trimmed columns, mid as bigint.

    Fewer than 10 fields or a non-numeric id makes the line a reject; fields
    after the tenth are ignored. Empty fields stay empty strings.
    """
    parts = F.split(F.col(value_col), "\\" + MOVIE_FIELD_SEP, -1)
    fields = [F.trim(F.try_element_at(parts, F.lit(i + 1))) for i in range(len(MOVIE_COLUMNS))]
    mid = fields[0].try_cast("bigint")
    parsed = lines.select(
        F.col(value_col).alias("_line"),
        ((F.size(parts) >= len(MOVIE_COLUMNS)) & mid.isNotNull()).alias("_ok"),
        mid.alias("mid"),
        *[f.alias(name) for f, name in zip(fields[1:], MOVIE_COLUMNS[1:])])
    good = parsed.filter("_ok").select(*MOVIE_COLUMNS)
    rejects = parsed.filter(~F.col("_ok")).select(F.col("_line").alias("value"))
    return good, rejects


def read_movies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_movie_lines(spark.read.text(path))


def parse_csv_lines(lines: DataFrame, names: list[str], types: list[str],
                    value_col: str = "value", trim: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split on every comma (no quoting), cast with ``try_cast``; exact field count."""
    parts = F.split(F.col(value_col), ",", -1)
    cols = []
    ok = F.size(parts) == len(names)
    for i, (name, typ) in enumerate(zip(names, types)):
        raw = F.try_element_at(parts, F.lit(i + 1))
        if trim:
            raw = F.trim(raw)
        val = raw if typ == "string" else F.trim(raw).try_cast(typ)
        ok = ok & val.isNotNull()
        cols.append(val.alias(name))
    parsed = lines.select(F.col(value_col).alias("_line"), ok.alias("_ok"), *cols)
    good = parsed.filter("_ok").select(*names)
    rejects = parsed.filter(~F.col("_ok")).select(F.col("_line").alias("value"))
    return good, rejects


def _separator(sep: str) -> str:
    """Pattern of one character, escaped if need be: such a pattern is not compiled for every line."""
    return re.escape(sep) if len(sep) == 1 else f"[{sep}]"


def line_fault(value: Column, names: list[str], types: list[str], sep: str = ",") -> Column:
    """Why a line is rejected, null if it isn't: its first fault from the left.

    ``fields:<n>`` for a wrong number of fields, ``empty:<name>`` for a field
    without text, ``type:<name>`` for one that isn't of its type. A null line
    has no fields.
    """
    parts = F.split(value, _separator(sep), -1)
    size = F.coalesce(F.size(parts), F.lit(0))
    fault = F.when(value.isNull(), "fields:0").when(
        size != len(names), F.concat(F.lit("fields:"), size.cast("string")))
    for i, (name, typ) in enumerate(zip(names, types)):
        field = F.trim(F.try_element_at(parts, F.lit(i + 1)))
        if typ != "string":
            fault = fault.when(field == "", f"empty:{name}").when(
                field.try_cast(typ).isNull(), f"type:{name}")
    return fault


def split_faults(lines: DataFrame, names: list[str], types: list[str], sep: str = ",",
                 value_col: str = "value", metrics: Observation | str | None = None
                 ) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects (value, reason)) of delimited lines, batch or stream.

    ``metrics`` counts lines, rejects and rejects by kind of fault while
    whichever side reads all lines runs: an ``Observation`` for a batch, a
    name for a stream's progress events.
    """
    told = _told_faults(lines, names, types, sep, value_col, metrics)
    good = told.where("reason is null").select(*_typed_fields(names, types, sep))
    return good, told.where("reason is not null")


def load_faults(lines: DataFrame, names: list[str], types: list[str], path: str, sep: str = ",",
                value_col: str = "value", metrics: Observation | str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """:func:`split_faults` of a batch, written to ``path`` as one table; both sides read from it.

    Each line is read and parsed once, and ``metrics`` are there on return. A
    row of the table has its fields, or the line and the reason; the other
    columns are null and take no room.
    """
    told = _told_faults(lines, names, types, sep, value_col, metrics)
    bad = F.col("reason").isNotNull()
    told.select(F.struct(*[F.when(~bad, f).alias(n) for f, n in zip(
        _typed_fields(names, types, sep), names)]).alias("fields"),
        F.struct(F.when(bad, F.col("value")).alias("value"), "reason").alias("fault")
    ).write.mode("errorifexists").parquet(path)
    table = lines.sparkSession.read.parquet(path)
    return (table.where("fault.reason is null").select("fields.*"),
            table.where("fault.reason is not null").select("fault.*"))


def _told_faults(lines: DataFrame, names: list[str], types: list[str], sep: str, value_col: str,
                 metrics: Observation | str | None) -> DataFrame:
    """(value, reason) of each line, counted by ``metrics``."""
    value = F.col(value_col)
    told = lines.select(value.alias("value"), line_fault(value, names, types, sep).alias("reason"))
    if metrics is None:
        return told
    bad = F.col("reason")
    return told.observe(metrics, F.count(F.lit(1)).alias("n_lines"),
                        F.count(bad).alias("n_rejects"),
                        *[F.count_if(bad.startswith(kind)).alias(f"n_{kind}")
                          for kind in ("fields", "empty", "type")])


def _typed_fields(names: list[str], types: list[str], sep: str) -> list[Column]:
    parts = F.split("value", _separator(sep), -1)
    fields = [F.try_element_at(parts, F.lit(i + 1)) for i in range(len(names))]
    return [(f if t == "string" else F.trim(f).try_cast(t)).alias(n)
            for f, n, t in zip(fields, names, types)]


def read_ratings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``uid,mid,score,timestamp`` lines (no header)."""
    return parse_csv_lines(spark.read.text(path), ["uid", "mid", "score", "timestamp"],
                           ["bigint", "bigint", "double", "bigint"])


def read_ratings_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Same through the CSV reader (PERMISSIVE mode, corrupt-record column)."""
    df = (spark.read.schema(RATING_SCHEMA + ", _corrupt string")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
          .csv(path))
    good = df.filter(F.col("_corrupt").isNull()).drop("_corrupt")
    rejects = df.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("value"))
    return good, rejects


def read_tags(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``uid,mid,tag,timestamp`` lines; the tag is kept as written (no trim, case kept)."""
    return parse_csv_lines(spark.read.text(path), TAG_COLUMNS,
                           ["bigint", "bigint", "string", "bigint"])


def to_delimited_text(df: DataFrame, columns: list[str], sep: str) -> DataFrame:
    """One ``value`` string per row (nulls as empty fields), for ``write.text``."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                        for c in columns]).alias("value"))


def write_delimited_text(df: DataFrame, columns: list[str], sep: str, path: str) -> None:
    to_delimited_text(df, columns, sep).write.mode("overwrite").text(path)
