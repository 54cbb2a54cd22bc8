"""Helpers shared by the training-data operators.

Every operator first selects its id and text columns under names of its own;
what else an input row has travels in one struct (``whole_row``), so extra or
clashing columns never meet the plan's internals.
"""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelrank.session import scratch_path
from reelrank.sources.tables import read_table

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEEP else 0x20 for c in range(256))

# Groups that are broadcast at most by ``join_groups``.
HOT_GROUPS = 1000


def ship(module_name: str) -> None:
    """Send a module's functions to the workers by value.

    Executors then need no copy of the package on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as the struct ``row``."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, from the struct ``row`` of ``df``."""
    return df.select(*columns_of_row(docs))


def columns_of_row(docs: DataFrame) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in docs.columns]


def one_of_each(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row for each value of ``keys``, whatever number of rows one value holds.

    Places in a written table are compared with map-side combining; no value's
    rows come together in a task.
    """
    placed = written(rows.withColumn("place_", F.monotonically_increasing_id()), name)
    first = placed.groupBy(*keys).agg(F.min("place_").alias("place_")).select("place_")
    return placed.join(first, "place_", "left_semi").drop("place_")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` only where all is ASCII)."""
    ascii_only = F.octet_length(col) == F.char_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, _UPPER, _UPPER.lower()))


def fold_words(raw: bytes) -> bytes:
    """UTF-8 text lower-cased in A-Z with a space for each byte that no word holds."""
    return raw.translate(_FOLD)


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text lower-cased in A-Z, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage: later stages survive a lost executor by re-reading files.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], weight: str,
                spread: str, hot: int = HOT_GROUPS, few: bool = False) -> DataFrame:
    """``rows`` left join ``groups`` on ``keys`` (null-safe), whatever one key holds.

    ``groups`` has one row per key and its number of rows in ``weight``; pass
    a written table, it is read more than once. The ``hot`` heaviest groups
    (of equal weights those with the least keys, so that every read picks the
    same) are broadcast, a count bound by construction; every other key holds at
    most one in ``hot`` of the rows and is joined by shuffle. Rows that the
    broadcast has served are dealt by ``spread`` (any well-mixed column).
    ``few``: as a rule there are no more than ``hot`` groups (sources, say);
    they are counted, and if so the rows don't move at all.
    """
    payload = [c for c in groups.columns if c not in keys]
    top = groups.orderBy(F.desc(weight), *keys).limit(hot)
    renamed = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]

    def matches(mark: str) -> Column:
        cond = F.lit(True)
        for i, k in enumerate(keys):
            cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        return cond

    side = top.select(*renamed, F.struct(*payload).alias("__hot"))
    rows = rows.join(F.broadcast(side), matches("__hot"), "left").drop(
        *[f"__k{i}" for i in range(len(keys))])
    if few and groups.count() <= hot:
        return rows.select(*[c for c in rows.columns if c != "__hot"],
                           *[F.col(f"__hot.{c}").alias(c) for c in payload])
    rest = groups.join(F.broadcast(side.select(*[f"__k{i}" for i in range(len(keys))])),
                       matches(""), "left_anti")
    rest = rest.select(*renamed, F.lit(0).cast("long").alias("__s0"),
                       F.struct(*payload).alias("__cold"))
    rows = rows.withColumn("__s", F.when(F.col("__hot").isNull(), F.lit(0).cast("long"))
                           .otherwise(F.abs(F.xxhash64(F.lit(7), F.col(spread)) % 1000000) + 1))
    # one plan at every size: a runtime switch to broadcast would depend on the
    # number of groups
    out = rows.join(rest.hint("merge"), matches("") & (F.col("__s") == F.col("__s0")), "left")
    picked = F.coalesce(F.col("__hot"), F.col("__cold"))
    return out.select(*[c for c in rows.columns if c not in ("__hot", "__s")],
                      *[picked.getField(c).alias(c) for c in payload])


def worker_cache(name: str, make):
    """An object that a Python worker keeps from task to task (made once per process).

    Only for things a task could make again: automata, tokenizers, bounded
    caches. Functions shipped by value get fresh globals, hence the module.
    """
    module = sys.modules.setdefault("_reelrank_worker", types.ModuleType("_reelrank_worker"))
    store = module.__dict__.setdefault("store", {})
    if name not in store:
        store.clear()  # one operator at a time: what another one kept goes
        store[name] = make()
    return store[name]


def map_texts(docs: DataFrame, id_col: str, text_col: str, kernel, fields: str) -> DataFrame:
    """Row-parallel text kernel: ``id`` and the columns of ``fields`` per row of ``docs``.

    ``kernel`` takes the texts of an Arrow batch (null as '') and returns one
    list or Arrow array per field. Order and number of rows stay.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = StructType([base.schema["id"], *StructType.fromDDL(fields)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            columns = kernel(batch.column("text").to_pylist())
            arrays = [batch.column("id")] + [
                c if isinstance(c, pa.Array) else pa.array(c, f.type)
                for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return base.mapInArrow(run, schema)
