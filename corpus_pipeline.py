"""From raw documents to token ids: quality, exact and near dedup, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet in the shared folder and rereads it as the
next stage's input, so a lost executor costs at most one stage's work. All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import exact, mixing, near, quality, spm
from reelrank.llm.common import documents, written
from reelrank.llm.queries import MIX_SEED, MIX_TEMPERATURE, tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.keep_good(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts, the one with the largest id."""
    return exact.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least id."""
    return near.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target share and globally shuffled."""
    return mixing.mix_sources(docs, temperature=MIX_TEMPERATURE, seed=MIX_SEED)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document (uint32 little-endian), checked by decoding them.

    A text that holds U+2581 itself comes back with spaces there: round_trip
    is false for it alone.
    """
    rows = docs.withColumn("row", F.struct(*docs.columns))
    out = spm.round_trips(rows, tokenizer_file("piece_bpe_32k.model"), "row", with_ids=True)
    same = F.col("decoded") == F.coalesce(F.col("id.text"), F.lit(""))
    return out.select("id.doc_id", "id.lang", "id.source", "n_pieces", "n_bytes", "ids_crc32",
                      same.alias("round_trip"), "ids")


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_exact),
    ("near dedup", drop_near),
    ("mixing", mix),
    ("sentencepiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Outlier estimates, Order MinHash and the transducer aren't SQL; see tests/llm.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
