"""Rejects with reasons, the document index, seen bitmaps, dealt terms, ALS fit checks."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from reelrank.operators import als, rerank, tfidf
from reelrank.plans.queries import QUERIES
from reelrank.session import scratch_path
from reelrank.sources import sinks, text

NAMES, TYPES = ["uid", "mid", "score", "timestamp"], ["bigint", "bigint", "double", "bigint"]


def test_line_faults(spark):
    want = {"1,2,3.5,4": None, " 1 ,2,3.5,4": None, "1,2,3.5": "fields:3", "": "fields:1",
            "1,2,3.5,4,5": "fields:5", ",2,3,4": "empty:uid", "x,,3,4": "type:uid",
            "1, ,3,4": "empty:mid", "1,2.5,3,4": "type:mid", "1,2,abc,4": "type:score",
            "1,2,3,9999999999999999999": "type:timestamp"}
    lines = spark.createDataFrame([(v,) for v in [*want, None]], "value string")
    seen = Observation("faults")
    good, rejects = text.split_faults(lines, NAMES, TYPES, metrics=seen)
    assert {r.value: r.reason for r in rejects.collect()} == {
        **{v: r for v, r in want.items() if r}, None: "fields:0"}
    n = seen.get
    assert (n["n_lines"], n["n_rejects"], n["n_fields"], n["n_empty"], n["n_type"]) == (
        12, 10, 4, 2, 4)
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.5, 4)] * 2


def test_loaded_faults(spark):
    """One table holds both sides: the lines are not read again for the rejects."""
    lines = ["1,2,3.5,4", " 1 ,2,3.5,4", "1,2", "", "x,2,3,4", "1,2,3,4,5"]
    src, path = scratch_path(spark, "in"), scratch_path(spark, "loaded")
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(src)
    seen = Observation("loaded")
    sides = text.load_faults(spark.read.text(src), NAMES, TYPES, path, metrics=seen)
    assert (seen.get["n_lines"], seen.get["n_rejects"]) == (6, 4)
    for side, plain in zip(sides, text.split_faults(spark.read.text(src), NAMES, TYPES)):
        assert side.schema == plain.schema
        assert sorted(map(str, side.collect())) == sorted(map(str, plain.collect()))
        assert side.inputFiles() and all(os.path.basename(path) in f for f in side.inputFiles())


def test_rejects_are_read_from_the_loaded_table(spark):
    sf = scratch_path(spark, "sf")
    rows = spark.range(80)
    rows.selectExpr("id as o_orderkey", "id % 7 as o_custkey", "timestamp '2020-01-01' as o_orderdate",
                    "'1-URGENT' as o_orderpriority").write.parquet(f"{sf}/orders.parquet")
    rows.selectExpr("id as l_orderkey", "id % 9 as l_partkey", "1 as l_linenumber",
                    "double(id % 50 + 1) as l_quantity").write.parquet(f"{sf}/lineitem.parquet")
    table = QUERIES["load_rejects"](spark, sf)
    assert not any("faulty-text" in f for f in table.inputFiles())
    assert {(r.n_lines, r.n_rejects, r.n_good) for r in table.collect()} == {(80, 10, 70)}


@pytest.mark.parametrize("sep", list(",|^.$-\\]\t "))
def test_separators(spark, sep):
    lines = spark.createDataFrame([(sep.join("1234"),), (sep.join("123"),)], "value string")
    good, rejects = text.split_faults(lines, NAMES, TYPES, sep=sep)
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3.0, 4)]
    assert [r.reason for r in rejects.collect()] == ["fields:3"]


def test_faults_of_a_stream(spark):
    path, out, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    spark.createDataFrame([("1|2|3.5|4",), ("1|2",), ("1|2|x|4",)], "value string").coalesce(
        1).write.text(path)
    stream = spark.readStream.text(path)
    _, rejects = text.split_faults(stream, NAMES, TYPES, sep="|", metrics="faults")
    query = rejects.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", ckpt).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.reason for r in spark.read.parquet(out).collect()) == ["fields:2", "type:score"]
    counted = [p["observedMetrics"]["faults"] for p in query.recentProgress
               if "faults" in p["observedMetrics"]]
    assert sum(m["n_rejects"] for m in counted) == 2 and sum(m["n_lines"] for m in counted) == 3


def test_document_index(spark):
    path = scratch_path(spark, "index")
    first = spark.range(50).select(F.col("id").alias("mid"), F.lit("a").alias("name"))
    sinks.write_index(first, path, shards=4)
    assert sinks.read_index(spark, path).count() == 50
    ran = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    second = spark.range(30).select(F.col("id").alias("mid"), F.lit("b").alias("name"))
    sinks.write_index(second.mapInArrow(count, second.schema), path, shards=4)
    assert ran.value == 30  # the plan ran once
    assert {r.name for r in sinks.read_index(spark, path).collect()} == {"b"}
    for bad in (second.unionByName(second.where("mid = 7")),
                second.unionByName(second.limit(1).select(F.lit(None).cast("long").alias("mid"),
                                                          "name"))):
        with pytest.raises(sinks.DuplicateIdError):
            sinks.write_index(bad, path)
        assert sinks.read_index(spark, path).count() == 30  # the old index is left
    sinks.write_index(second.limit(0), path)
    assert sinks.read_index(spark, path).count() == 0


def test_seen_bitmaps(spark):
    ids = [-70_000, -1, 0, 1, 7, 8, 32_767, 32_768, 32_769, 10**12]
    rated = [(u, m) for u in range(3) for i, m in enumerate(ids) if (i + u) % 3] + [(0, 1)] * 40
    seen = spark.createDataFrame(rated, "uid long, mid long")
    cand = spark.createDataFrame([(u, m) for u in range(4) for m in ids], "uid long, sim_mid long")
    got = {tuple(r) for r in rerank.drop_seen(cand, rerank.seen_bitmaps(seen)).collect()}
    assert got == {(u, m) for u in range(4) for m in ids} - set(rated)


def test_frequent_term_in_no_prefix_adds_no_rows(spark):
    """A term of half of all profiles moves nothing unless a prefix holds it."""
    ids = spark.range(20_000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("p"), "id")
    terms = ids.select("p", "id", F.explode(F.array(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.lit("rest")),
        F.concat(F.lit("t"), (F.col("id") % 4000).cast("string")))).alias("term"))
    prefix = terms.where("term like 't%'").select(F.col("p").alias("pa"), "term")
    postings = terms.select(F.col("p").alias("pb"), "term")
    left, right = tfidf._dealt_terms(prefix, postings, portion=100)
    assert (left.count(), right.count()) == (20_000, 20_000)
    # in one prefix: that row meets the term's postings part by part
    one = prefix.unionByName(terms.where("term = 'hot'").limit(1).select(F.col("p").alias("pa"),
                                                                         "term"))
    left, right = tfidf._dealt_terms(one, postings, portion=100)
    assert (left.count(), right.count()) == (20_100, 30_000)


def test_wrong_parameters_show(spark):
    data = [(u, m, float(1 + (u * m) % 5)) for u in range(1, 31) for m in range(1, 21)
            if (u + m) % 3]
    ratings = spark.createDataFrame(data, "uid long, mid long, score double")
    train, test = ratings.where("(uid + mid) % 5 > 0"), ratings.where("(uid + mid) % 5 = 0")
    model = als.make_als(3, 8, 0.05, 1).fit(als._als_input(train))
    good = als.check_fit(model, train, test, 3, 0.05).first()
    assert good.has_rank and good.solves_ridge and good.n_test == test.count()
    assert good.rmse_of_factors == pytest.approx(als.model_rmse(model, test).first().rmse, rel=1e-4)
    assert not als.check_fit(model, train, test, 4, 0.05).first().has_rank
    for reg in (0.005, 0.5):
        assert not als.check_fit(model, train, test, 3, reg).first().solves_ridge
    grid = als.als_grid(train, test, [2, 3], [0.1], max_iter=3, checks=True).collect()
    assert all(r.has_rank and r.solves_ridge and abs(r.rmse - r.rmse_of_factors) < 1e-3
               for r in grid)
