"""Quality rules: robust multivariate outliers per language and source (DataFrame functions only).

Each document gets counts from its whole text and from them a vector of four
transformed statistics (mean word length, share of symbols, of repeated lines,
of words in repeated five-word windows). Shares are taken over the text and a
few neutral words, so that short texts don't stand out by chance.

Per group (language, source) location and scatter are minimum covariance
determinant (MCD) estimates. Concentration steps take the ``H_SHARE`` of
documents with the least distances, estimate mean and covariance from them and
repeat until the group's determinant stops falling, however many steps that
takes. There are two starts, both from coordinatewise median and MAD, one
without correlations and one with those of the hyperbolic tangents of the
standardised statistics; of the two ends the one with the smaller determinant
stays. The covariance is regularised by a diagonal of
least spreads, as groups often have a statistic without any spread. Groups
under ``MIN_GROUP`` documents are judged by the estimates over all documents of
their language, in smaller languages by those over the whole corpus; a corpus
of fewer rejects nothing. A document is rejected when
its squared Mahalanobis distance exceeds the chi-squared quantile ``LIMIT``,
or by the base rules (under ten words, or over a fifth of them in repeated
windows); documents that fail the base rules don't enter the estimates.

A step is two aggregations with map-side combining over a narrow table, so a
source with a third of all rows is no hot group; groups meet their rows
through ``join_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import join_groups, written

_WHITE = "[ \\t-\\r]"
_SOLID = "[^ \\t-\\r]"
_SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

X = ("x0", "x1", "x2", "x3")
#: Least standard deviation per statistic.
FLOORS = (0.08, 0.05, 0.12, 0.12)
#: Chi-squared with len(X) degrees of freedom: median, and quantile 1 - 1e-5.
MEDIAN, LIMIT = 3.3567, 28.473
#: A step that lowers the log determinant by less than SETTLED is the last of its pool.
H_SHARE, MIN_GROUP, SETTLED = 0.75, 50, 1e-3
ACCURACY = 2000  # of percentile_approx: ranks within 1/2000 of a group


def with_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines.

    Null texts have no words. Each step is a projection of its own, as later
    ones use its arrays more than once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    solid = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(_SOLID)))
    one = docs.withColumns({"__words": F.array_remove(F.split(text, _WHITE + "+"), ""),
                            "__lines": solid})
    two = one.withColumns({
        "n_words": F.size("__words").cast("long"),
        "__flat": F.array_join("__words", ""),
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    }).drop("__words", "__lines")
    # windows by a 64-bit hash of their five words' hashes
    windows = F.transform(F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")),
                          lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]))
    three = two.withColumns({
        "word_chars": F.char_length("__flat").cast("long"),
        "n_symbols": (F.char_length("__flat") - F.char_length(
            F.regexp_replace("__flat", _SYMBOLS, ""))).cast("long"),
        "__keys": F.when(F.col("n_words") >= WINDOW, windows),
    }).drop("__flat", "__hashes")
    repeats = F.size(F.array_distinct("__keys")) < F.size("__keys")
    numbered = F.transform("__keys", lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    four = three.withColumn("__sorted", F.when(repeats, F.sort_array(numbered))).drop("__keys")
    # neighbours with equal keys give the starts of windows found twice or more
    equal = F.zip_with("__sorted", F.slice("__sorted", 2, F.greatest(F.size("__sorted"), F.lit(1))),
                       lambda a, b: F.when(a["k"] == b["k"], F.array(a["i"], b["i"]))
                       .otherwise(F.array().cast("array<int>")))
    five = four.withColumn("__starts", F.sort_array(F.array_distinct(F.flatten(equal)))
                           ).drop("__sorted")
    gaps = F.zip_with("__starts", F.slice("__starts", 2, F.greatest(F.size("__starts"), F.lit(1))),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)
    return five.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")
                           ).drop("__starts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The transformed statistics, smoothed by 50 words of 5 characters, or 5 lines."""
    words, chars = F.col("n_words") + 50, F.col("word_chars") + 250
    return {
        "x0": F.ln(chars / words),
        "x1": F.sqrt(F.col("n_symbols") / chars),
        "x2": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)),
        "x3": F.sqrt(F.col("n_repeat_words") / words),
    }


def _pools(rows: DataFrame) -> DataFrame:
    """(lang, source, pool, n, feeds): the pool that judges each language and source.

    ``feeds`` are the pools that its passing documents are estimated in: its
    own unless it is small, and its language's and the whole corpus's where a
    small group is judged by them.
    """
    groups = rows.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("failed")).alias("good"))
    groups = written(groups, "quality-groups")
    small, enough = F.col("good") < MIN_GROUP, F.col("l_good") >= MIN_GROUP
    by_lang = groups.groupBy(F.col("lang").alias("l")).agg(
        F.sum("good").alias("l_good"), F.bool_or(small & (F.col("good") > 0)).alias("l_used"))
    # one row: the broadcast is bounded by construction
    over_all = by_lang.agg(F.coalesce(
        F.bool_or(F.col("l_used") & ~enough), F.lit(False)).alias("a_used"))
    out = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).join(F.broadcast(over_all))
    own, of_lang = F.to_json(F.array("lang", "source")), F.to_json(F.array("lang"))
    pool = F.when(~small | (F.col("good") == 0), own).when(enough, of_lang).otherwise("all")
    feeds = F.array_compact(F.array(
        F.when(~small, own), F.when(F.col("l_used") & enough, of_lang),
        F.when(F.col("a_used"), "all")))
    return out.select("lang", "source", pool.alias("pool"), "n", feeds.alias("feeds"))


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` from location m<i> and Cholesky factor c<i><j>."""
    total = F.lit(0.0)
    for i in range(len(X)):
        rest = F.col(X[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"c{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", rest / F.col(f"c{i}{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return rows.withColumn("d2", total)


def _cholesky(params: DataFrame) -> DataFrame:
    """Cholesky factor c<i><j> of s<i><j> plus the floors, and its log determinant."""
    for i in range(len(X)):
        for j in range(i + 1):
            rest = F.col(f"s{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            params = params.withColumn(
                f"c{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 100))) if i == j
                else rest / F.col(f"c{j}{j}"))
    log_det = sum((2 * F.ln(F.col(f"c{i}{i}")) for i in range(1, len(X))), 2 * F.ln("c00"))
    return params.withColumn("log_det", log_det)


_PARAMS = ([f"m{i}" for i in range(len(X))]
           + [f"c{i}{j}" for i in range(len(X)) for j in range(i + 1)])


def _measured(rows: DataFrame, params: DataFrame) -> DataFrame:
    return _distance(join_groups(rows, params, ["pool"], "n", "id", few=True))


def _starts(rows: DataFrame) -> DataFrame:
    """Two starts per pool: median and scaled MAD, alone and with tanh correlations."""
    middle = rows.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), *[
        F.percentile_approx(x, 0.5, ACCURACY).alias(f"m{i}") for i, x in enumerate(X)])
    middle = written(middle, "mcd-medians")
    away = join_groups(rows, middle, ["pool"], "n", "id", few=True)
    spread = written(away.groupBy("pool").agg(F.first("n").alias("n"), *[
        F.first(f"m{i}").alias(f"m{i}") for i in range(len(X))], *[
        (1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, ACCURACY)
         ).alias(f"a{i}") for i, x in enumerate(X)]), "mcd-spreads")
    pairs = [(i, j) for i in range(len(X)) for j in range(i)]
    bent = [F.tanh((F.col(x) - F.col(f"m{i}")) / F.greatest(F.col(f"a{i}"), F.lit(FLOORS[i])))
            for i, x in enumerate(X)]
    bent_rows = join_groups(rows, spread, ["pool"], "n", "id", few=True).select(
        "pool", *[b.alias(f"b{i}") for i, b in enumerate(bent)])
    # a statistic without spread has no correlations
    like = bent_rows.groupBy("pool").agg(*[F.when(
        (F.var_pop(f"b{i}") > 0) & (F.var_pop(f"b{j}") > 0),
        F.covar_pop(f"b{i}", f"b{j}") / F.sqrt(F.var_pop(f"b{i}") * F.var_pop(f"b{j}"))
    ).otherwise(0.0).alias(f"r{i}{j}") for i, j in pairs])
    both = spread.join(like, "pool").withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    diag = {f"s{i}{i}": F.pow(f"a{i}", F.lit(2.0)) for i in range(len(X))}
    rest = {f"s{i}{j}": F.col("start") * F.col(f"r{i}{j}") * F.col(f"a{i}") * F.col(f"a{j}")
            for i, j in pairs}
    return _cholesky(both.withColumns(diag | rest))


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One C-step from each of ``params``: mean and covariance of the nearest ``H_SHARE``.

    ``rows`` of pools that ``params`` doesn't hold are left out.
    """
    by_pool = params.groupBy("pool").agg(
        F.first("n").alias("n"), F.collect_list(F.struct("start", *_PARAMS)).alias("from"))
    near = join_groups(rows, written(by_pool, "mcd-from"), ["pool"], "n", "id", few=True)
    near = near.select("pool", "id", "n", F.explode("from").alias("from"), *X)
    near = _distance(near.select("pool", "id", "n", "from.*", *X)).select(
        "pool", "start", "id", "n", "d2", *X)
    reach = near.groupBy("pool", "start").agg(
        F.percentile_approx("d2", H_SHARE, ACCURACY).alias("reach"), F.first("n").alias("n"))
    reach = written(reach, "mcd-reach")
    core = join_groups(near.drop("n"), reach, ["pool", "start"], "n", "id", few=True)
    sums = core.where("d2 <= reach").groupBy("pool", "start").agg(
        F.first("n").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(X)],
        *[F.covar_pop(X[i], X[j]).alias(f"s{i}{j}") for i in range(len(X)) for j in range(i + 1)])
    return _cholesky(sums)


def mcd(rows: DataFrame) -> DataFrame:
    """(pool, n, m<i>, c<i><j>, scale) of rows (id, pool, x<i>); read-once tables are written.

    A step that doesn't lower a determinant is not taken, and the floors bound
    every determinant from below, so each start settles after finitely many
    steps; what has settled takes no part in further ones. ``scale`` makes the
    median squared distance no larger than that of a normal sample (never
    below 1).
    """
    keep = ["pool", "start", "n", *_PARAMS, "log_det"]
    params = written(_starts(rows).select(*keep, F.lit(True).alias("falling")), "mcd-start")
    while params.where("falling").limit(1).count():
        step = _concentrate(rows, params.where("falling")).select(
            F.col("pool").alias("pool_"), F.col("start").alias("start_"),
            F.struct(*keep).alias("new"))
        old = params.select("pool", "start", F.struct(*keep).alias("old"))
        same = F.col("pool").eqNullSafe(F.col("pool_")) & (F.col("start") == F.col("start_"))
        falls = F.coalesce(F.col("new.log_det") < F.col("old.log_det") - SETTLED, F.lit(False))
        taken = old.join(step, same, "left").select(
            F.when(falls, F.col("new")).otherwise(F.col("old")).alias("p"),
            falls.alias("falling"))
        params = written(taken.select("p.*", "falling"), "mcd-step")
    best = params.groupBy("pool").agg(F.min(F.struct(
        "log_det", "start", "n", *_PARAMS)).alias("best")).select("pool", "best.*")
    best = written(best.drop("log_det", "start"), "mcd-best")
    spread = _measured(rows, best).groupBy("pool").agg(
        F.greatest(F.percentile_approx("d2", 0.5, ACCURACY) / MEDIAN, F.lit(1.0)).alias("scale"))
    return written(best.join(spread, "pool"), "mcd-params")


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", source_col: str = "source",
                     whole_rows: bool = False) -> DataFrame:
    """id, the counts, base_failed and kept, one row per document.

    ``whole_rows`` also returns the input row as the struct ``doc``. Null
    texts have no words and fail the base rules; null languages and sources
    are groups of their own; repeated rows are judged alike; an empty table
    gives an empty result. Distances are null (kept) in a pool too small to
    estimate.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       *([F.struct(*docs.columns).alias("doc")] if whole_rows else []))
    counted = with_counts(base, "text").drop("text")
    counted = counted.withColumn("failed", base_failed()).withColumns(statistics())
    counted = written(counted, "quality-counts")
    pools = written(_pools(counted.select("lang", "source", "failed")), "quality-pools")
    pooled = join_groups(counted, pools, ["lang", "source"], "n", "id", few=True).drop("n")
    params = mcd(pooled.where("not failed").select("id", F.explode("feeds").alias("pool"), *X))
    judged = _distance(join_groups(pooled.drop("feeds"), params, ["pool"], "n", "id", few=True))
    outlier = (F.col("n") >= MIN_GROUP) & (F.col("d2") / F.col("scale") > LIMIT)
    kept = ~F.col("failed") & ~F.coalesce(outlier, F.lit(False))
    return judged.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.col("failed").alias("base_failed"), kept.alias("kept"), "d2",
        *(["doc"] if whole_rows else []))


def keep_good(docs: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` that the quality rules keep, columns as they are."""
    judged = quality_verdicts(docs, whole_rows=True, **columns).where("kept")
    return judged.select("doc.*")
