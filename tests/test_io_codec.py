import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reelrank.functions import recs as codec
from reelrank.sources import sinks, text
from reelrank.streaming import source as msg
from tests.conftest import rows


def _write(lines):
    d = tempfile.mkdtemp(prefix="reelrank-test-")
    path = os.path.join(d, "in.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_movies_loader_rejects(spark):
    path = _write([
        "260^Star Wars ^ Leia captured ^121minutes^September 21, 2004^1977^English^"
        "Action|Adventure|Sci-Fi^Mark Hamill|Harrison Ford^George Lucas",
        "261^Empty tail^d^t^i^s^l^g^^",          # empty last fields are kept
        "262^Nine^fields^only^x^x^x^x^x",        # 9 fields: reject
        "abc^Bad id^d^t^i^s^l^g^a^d",            # non-numeric id: reject
    ])
    good, bad = text.read_movies(spark, path)
    got = {r.mid: r for r in good.collect()}
    assert set(got) == {260, 261}
    assert got[260].name == "Star Wars" and got[260].descri == "Leia captured"
    assert got[260].genres == "Action|Adventure|Sci-Fi"
    assert got[261].actors == "" and got[261].directors == ""
    assert bad.count() == 2


def test_ratings_and_tags_loaders(spark):
    rpath = _write(["1,2968,1.0,1260759200", "1,31,2.5,1260759144", "x,1,1.0,1", "2,3,4.0"])
    good, bad = text.read_ratings(spark, rpath)
    assert rows(good) == [(1, 31, 2.5, 1260759144), (1, 2968, 1.0, 1260759200)]
    assert bad.count() == 2
    good_csv, bad_csv = text.read_ratings_csv(spark, rpath)
    assert rows(good_csv) == rows(good)
    tpath = _write(["15,1955,dentist,1193435061", "15,1955, Dentist,1193435062", "1,2,a,b,3"])
    tg, tbad = text.read_tags(spark, tpath)
    assert rows(tg, "tag") == [(" Dentist",), ("dentist",)]   # not trimmed, case kept
    assert tbad.count() == 1


def test_messages(spark):
    df = spark.createDataFrame([("1|2|4.5|100",), ("1|2|4.5",), ("a|2|1|1",), ("",), (None,)],
                               "value string")
    parsed = msg.parse_messages(df)
    assert rows(msg.good_messages(parsed)) == [(1, 2, 4.5, 100)]
    assert msg.rejected_messages(parsed).count() == 4


@pytest.mark.parametrize("style", ["list", "genre", "stream"])
def test_recs_codec_roundtrip(spark, style):
    df = spark.createDataFrame(
        [(1, [(5, 0.5)]), (2, [(7, 4.25), (8, 1.0e-4), (9, -2.0)]), (3, [])],
        "k int, recs array<struct<mid:bigint,score:double>>")
    txt = df.select("k", codec.recs_to_text("recs", style).alias("t"))
    back = txt.select("k", codec.parse_recs_text("t").alias("recs"))
    assert rows(back) == rows(df)


def test_recs_text_layouts(spark):
    df = spark.createDataFrame([([(5, 0.5), (6, 1.0e-4)],)], "recs array<struct<mid:bigint,score:double>>")
    got = df.select(codec.recs_to_text("recs", "list").alias("a"),
                    codec.recs_to_text("recs", "genre").alias("b"),
                    codec.recs_to_text("recs", "stream").alias("c")).first()
    assert got.a == "List(Recommendation(5,0.5), Recommendation(6,1.0E-4))"
    assert got.b == 'List({"mid":5,"score":0.5}, {"mid":6,"score":1.0E-4})'
    assert got.c == "((5,0.5), (6,1.0E-4))"


def test_document_sink_checks_ids(spark):
    out = tempfile.mkdtemp(prefix="reelrank-test-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "mid long, tags string")
    sinks.write_documents(df, os.path.join(out, "ok"), fmt="json")
    assert spark.read.json(os.path.join(out, "ok")).count() == 2
    dup = df.union(df.filter(F.col("mid") == 1))
    with pytest.raises(sinks.DuplicateIdError):
        sinks.write_documents(dup, os.path.join(out, "dup"), fmt="json")


def test_materialize_table_reads_back_pruned(spark):
    from reelrank.session import ensure_checkpoint_dir, materialize_table

    df = spark.range(100).select(F.col("id").alias("uid"), (F.col("id") % 7).alias("mid"),
                                 (F.col("id") * 0.5).alias("score"))
    out = materialize_table(df, "unit-ratings")
    assert rows(out) == rows(df)
    # Written under the checkpoint folder, as a plain parquet table.
    files = out.inputFiles()
    assert files and all(ensure_checkpoint_dir(spark).rstrip("/").split("/")[-2] in f
                         for f in files)
    plan = out.select("mid")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<mid:bigint>" in plan
    # Each call gets its own folder.
    again = materialize_table(df, "unit-ratings")
    assert set(again.inputFiles()).isdisjoint(files)


def test_codec_keeps_null_elements(spark):
    df = spark.createDataFrame([([(1, 0.5), (2, None), (None, 1e-9)],)],
                               "recs array<struct<mid:bigint,score:double>>")
    for style in ("list", "genre", "stream"):
        text_col = df.select(codec.recs_to_text("recs", style).alias("t"))
        assert "null" in text_col.first().t
        back = text_col.select(codec.parse_recs_text("t").alias("recs")).first().recs
        assert [(r.mid, r.score) for r in back] == [(1, 0.5), (2, None), (None, 1e-9)]


def test_similarity_lists_roundtrip(spark):
    sims = spark.createDataFrame([(1, 2, 0.7), (1, 3, 0.9), (1, 4, 0.7), (2, 1, 0.7)],
                                 "mid long, sim_mid long, sim double")
    lists = sinks.similarity_lists(sims)
    by_item = {r.mid: [(x.mid, x.score) for x in r.recs] for r in lists.collect()}
    assert by_item[1] == [(3, 0.9), (2, 0.7), (4, 0.7)]
    want = sorted(tuple(r) for r in sims.collect())
    for form in (lists, sinks.with_text_recs(lists)):
        assert sorted(tuple(r) for r in sinks.matrix_from_lists(form).collect()) == want


def test_epoch_seconds_in_two_zones(spark):
    from reelrank.functions.dates import epoch_seconds

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = spark.sql("select timestamp_seconds(1260759200) as a, "
                            "timestamp_ntz '2009-12-14 02:53:20' as b").select(
                                epoch_seconds("a").alias("a"), epoch_seconds("b").alias("b")).first()
            assert (row.a, row.b) == (1260759200, 1260759200)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from reelrank import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return SimpleNamespace(get=lambda key, default: default)

    fake = SimpleNamespace(sparkContext=Context(),
                           conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_release_scratch_deletes_written_tables(spark):
    from reelrank.session import materialize_table, release_scratch, scratch_path

    release_scratch(spark)
    path = materialize_table(spark.range(5), "t").inputFiles()[0]
    local = path.removeprefix("file://")
    assert os.path.exists(local)
    assert release_scratch(spark) == 1
    assert not os.path.exists(local)
    scratch_path(spark, "never-written")
    release_scratch(spark)
