"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture. The mean repetition rate of
its documents is ``target rows of the source / rows of the source``. A
document's number of copies is the quantile of that Poisson distribution at a
uniform number hashed from (seed, id, text): the same document gets the same
count in every run, on every partitioning and after every retry. Copies are
then dealt to random partitions and random places within them; the rates are
all that is shipped to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import columns_of_row, join_groups, unpacked, whole_row, written


def uniform(seed: int, *cols: Column) -> Column:
    """52 bits of md5(seed|cols) as a number in [0, 1); nulls hash as ''."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_quantile(rate: Column, u: Column) -> Column:
    """Number of k with P(X <= k) <= u: the Poisson quantile of ``rate`` at ``u``.

    The terms are kept as logarithms, so large rates do not underflow. The
    search runs up to a tail below the 52 bits of ``uniform``: steps in
    proportion to the copies that the row gets on average.
    """
    top = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    log_rate = F.ln(F.greatest(rate, F.lit(1e-300)))
    start = F.struct((-rate).alias("lp"), F.exp(-rate).alias("cdf"),
                     (F.exp(-rate) <= u).cast("int").alias("n"))

    def step(acc, k):
        lp = acc["lp"] + log_rate - F.ln(k.cast("double"))
        cdf = acc["cdf"] + F.exp(lp)
        return F.struct(lp.alias("lp"), cdf.alias("cdf"),
                        (acc["n"] + (cdf <= u).cast("int")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["n"])


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict | None = None,
                 temperature: float = 0.5, total: int | None = None) -> DataFrame:
    """(source, n_rows, rate): mean copies per document of each source.

    ``weights`` maps sources to target weights (any positive scale; sources
    that are not named get weight 0). Without it a source with n rows gets
    weight ``n ** temperature``. ``total`` is the expected size of the mixture
    (default: as many rows as the input). Null is a source of its own.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        weight = F.pow(F.col("n_rows").cast("double"), F.lit(float(temperature)))
    else:
        pairs = [F.when(F.col("source").eqNullSafe(F.lit(k)), F.lit(float(w)))
                 for k, w in weights.items()]
        weight = F.coalesce(*pairs, F.lit(0.0)) if pairs else F.lit(0.0)
    weighted = counts.withColumn("weight", weight)
    sums = weighted.agg(F.sum("weight").alias("w"), F.sum("n_rows").alias("n"))
    target = F.lit(float(total)) if total is not None else F.col("n").cast("double")
    # sums is one row: the broadcast is bounded by construction
    rate = F.when(F.col("w") > 0, F.col("weight") / F.col("w") * target / F.col("n_rows")
                  ).otherwise(F.lit(0.0))
    return weighted.join(F.broadcast(sums)).select("source", "n_rows", rate.alias("rate"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: dict | None = None,
                temperature: float = 0.5, total: int | None = None, seed: int = 17,
                details: bool = False) -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, globally shuffled.

    Rows with count 0 leave; ``details=True`` adds rate, n_copies, copy (from
    0) and shuffle_key in place of columns of these names. Rows that repeat id
    and text get the same count each, but places of their own. A null id or
    text hashes as the empty string; a null source is a source of its own. An
    empty table gives an empty result. Whole texts of any length are hashed;
    other columns may have any name.
    """
    rates = written(source_rates(docs, source_col, weights, temperature, total).select(
        F.col("source").alias("src"), F.col("n_rows").alias("n"), "rate"), "rates")
    # ``place`` sets apart rows that repeat id and text, for the deal only
    drawn = docs.select(
        whole_row(docs), F.col(source_col).alias("src"), F.monotonically_increasing_id()
        .alias("place"), uniform(seed, F.col(id_col), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
        .alias("u"))
    drawn = join_groups(drawn, rates, ["src"], "n", "u", few=True)
    drawn = drawn.withColumn("copies", poisson_quantile(F.col("rate"), F.col("u"))).where(
        "copies > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    copies = copies.withColumn("key", F.xxhash64(F.lit(seed), "u", "copy", "place"))
    dealt = copies.repartition(F.col("key")).sortWithinPartitions("key")
    if not details:
        return unpacked(dealt, docs)
    extra = [F.col("rate"), F.col("copies").cast("long").alias("n_copies"),
             F.col("copy").cast("long").alias("copy"), F.col("key").alias("shuffle_key")]
    named = ("rate", "n_copies", "copy", "shuffle_key")
    return dealt.select(*[c for c, name in zip(columns_of_row(docs), docs.columns)
                          if name not in named], *extra)
