"""Exact dedup by distributed MSD radix partitioning.

Texts are split by successive runs of bytes, most significant first: level 0
looks at the byte length and the first 64 bytes, the next levels at the
following 448, 3,584, ... bytes (each digit eight times the previous offset).
Within a level one aggregation splits every group by its next digit. A
document leaves as soon as its group is a singleton (unique) or its bytes are
used up (every byte was compared: its group is a class of equal texts). No
digest takes part in deciding equality.

Hot groups: each level counts (group, digit) with map-side combining, and the
rows find their new group through ``join_groups``, which broadcasts a bounded
number of the largest groups and shuffles the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import (join_groups, lower_ascii, one_of_each, unpacked, whole_row,
                                 written)

FIRST_BYTES = 64
GROWTH = 8
# The hot digits of a level take at most so many bytes in a broadcast.
HOT_BYTES = 8 << 20


def _normalised(col: Column) -> Column:
    return lower_ascii(F.coalesce(col.cast("string"), F.lit("")))


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs.select(F.col(id_col).alias("id"), _normalised(F.col(text_col)).alias("norm"))
    return text.select("id", F.sha2("norm", 256).alias("sha"), F.octet_length("norm").alias("n"),
                       F.col("norm").cast("binary").alias("rest"))


def _split(rows: DataFrame, keys: list[str], level: int, width: int) -> DataFrame:
    """One radix step: rows in a group of at least two by ``keys``, digit cut off."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = written(groups.withColumn("new_gid", F.monotonically_increasing_id()),
                     f"radix-groups-{level}")
    hot = max(1, min(1000, HOT_BYTES // width))
    out = join_groups(rows, groups, keys, "size", "id", hot).where("new_gid is not null")
    return out.select("id", "sha", "n", F.col("new_gid").alias("gid"),
                      F.expr(f"substring(rest, {width + 1})").alias("rest"))


def equal_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sha, level, gid) of every row whose text equals another row's text.

    ``(level, gid)`` names the class; equal means identical after lower-casing
    A-Z. Null texts count as empty. Rows without an equal are not returned.
    """
    rows = _base(docs, id_col, text_col)
    width, end, level, keys = FIRST_BYTES, FIRST_BYTES, 0, ["n", "digit"]
    done = None
    while True:
        digit = rows.withColumn("digit", F.expr(f"substring(rest, 1, {width})"))
        step = written(_split(digit, keys, level, width)
                       .withColumn("ended", F.col("n") <= end), f"radix-level-{level}")
        ended = step.where("ended").select("id", "sha", F.lit(level).alias("level"), "gid")
        done = ended if done is None else done.unionByName(ended)
        rows = step.where("not ended").drop("ended")
        if rows.isEmpty():
            return done
        width, level, keys = end * (GROWTH - 1), level + 1, ["gid", "digit"]
        end += width


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts (A-Z lower-cased, null as empty) the row with the largest
    id stays. A null id is smaller than any other. Of rows that repeat both
    id and text exactly one is kept. An empty table gives an empty result.
    Digit sizes grow with the offset, so a text of any length takes
    logarithmically many levels. Other input columns are ignored, whatever
    their names.
    """
    flags = _flags(docs, id_col, text_col)
    base = docs.select(F.col(id_col).alias("id"),
                       F.sha2(_normalised(F.col(text_col)), 256).alias("sha"))
    out = base.join(flags, F.col("id").eqNullSafe(F.col("f_id")) &
                    (F.col("sha") == F.col("f_sha")), "left")
    stays = F.coalesce(F.col("id").eqNullSafe(F.col("keep_id")), F.lit(True))
    out = out.select(
        "id", "sha", F.when(F.col("f_sha").isNull(), F.col("id")).otherwise(F.col("keep_id"))
        .alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("same", F.lit(1).cast("long")).alias("same"),
        F.when(F.col("f_sha").isNull(), True).otherwise(stays).alias("stays"))
    names = [F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("stays").alias("kept"),
             F.col("sha").alias("text_sha256")]
    if flags.where("same > 1 and id_stays").isEmpty():
        return out.select(*names)
    # of rows that repeat id and text one stays
    once, again = out.where("same = 1 or not stays"), out.where("same > 1 and stays")
    again = written(again.withColumn("place", F.monotonically_increasing_id()), "radix-repeated")
    first = again.groupBy("id", "sha").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first"))
    again = again.join(first, "place", "left").withColumn("stays", F.col("first").isNotNull())
    return once.select(*names).unionByName(again.select(*names))


def _flags(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(f_id, f_sha, keep_id, group_size, same, id_stays) of texts that occur more than once."""
    members = written(equal_classes(docs, id_col, text_col), "radix-classes")
    classes = written(members.groupBy("level", "gid").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "radix-keepers")
    flags = join_groups(members, classes, ["level", "gid"], "group_size", "id")
    return written(flags.groupBy(F.col("id").alias("f_id"), F.col("sha").alias("f_sha")).agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("same"),
        F.first(F.col("id").eqNullSafe(F.col("keep_id"))).alias("id_stays")), "radix-flags")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``docs`` with one row per class of equal texts (see ``exact_duplicates``).

    All columns are kept as they are. Rows that share no text with another
    row pass without a join of their text: only ids and digests of classes
    with at least two rows are matched.
    """
    flags = _flags(docs, id_col, text_col).drop("keep_id", "group_size")
    rows = docs.select(whole_row(docs), F.col(id_col).alias("id"),
                       F.sha2(_normalised(F.col(text_col)), 256).alias("sha"))
    rows = rows.join(flags, F.col("id").eqNullSafe(F.col("f_id")) &
                     (F.col("sha") == F.col("f_sha")), "left")
    rows = rows.where("coalesce(id_stays, true)")
    if flags.where("same > 1 and id_stays").isEmpty():
        return unpacked(rows, docs)
    again = rows.where("same > 1").select("row", "id", "sha")
    return unpacked(rows.where("coalesce(same, 1) = 1"), docs).unionByName(
        unpacked(one_of_each(again, ["id", "sha"], "radix-repeated"), docs))
