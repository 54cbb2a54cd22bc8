"""Message log, committed sink and keyed state: positions, replay, crashes, late messages."""

import random

import pytest
from pyspark.sql import functions as F

from reelrank.session import scratch_path
from reelrank.streaming import commits, files, log, recent


def lines(spark, values, parts=1):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(parts)


def test_log_positions_and_ranges(spark):
    path = scratch_path(spark, "log")
    assert log.read_messages(spark, path).collect() == []
    log.append_messages(lines(spark, [f"a{i}" for i in range(10)], 3), path)
    log.append_messages(lines(spark, []), path)
    log.append_messages(lines(spark, [f"b{i}" for i in range(7)], 2), path)
    got = log.read_messages(spark, path).collect()
    assert sorted(r.value for r in got) == sorted([f"a{i}" for i in range(10)]
                                                  + [f"b{i}" for i in range(7)])
    by_part = {}
    for r in got:
        by_part.setdefault(r.msg_partition, []).append((r.msg_offset, r.value))
    for rows in by_part.values():  # dense from 0, older appends first
        rows.sort()
        assert [o for o, _ in rows] == list(range(len(rows)))
        assert [v[0] for _, v in rows] == sorted(v[0] for _, v in rows)
    part = by_part[0]
    some = log.read_messages(spark, path, {0: 1}, {0: len(part) - 1}).collect()
    assert sorted((r.msg_offset, r.value) for r in some) == part[1:-1]
    # segments that were never committed don't exist
    system, inner = files.open_fs(path)
    system.copy_file(f"{inner}/{log._Log({'path': path}).segments()[0][1]}", f"{inner}/stray.arrow")
    assert log.read_messages(spark, path).count() == 17


def collected(spark, path, start, ckpt, out):
    stream = log.log_stream(spark, path, start)
    commits.write_stream(stream, out, ckpt).awaitTermination()
    return sorted(r.value for r in commits.read_committed(spark, out, log.SCHEMA).collect())


def test_stream_starts_and_restarts(spark):
    path = scratch_path(spark, "log")
    log.append_messages(lines(spark, ["x1", "x2", "x3"], 2), path)
    a, a_ckpt, b, b_ckpt, c, c_ckpt = (scratch_path(spark, n) for n in "abcdef")
    assert collected(spark, path, "earliest", a_ckpt, a) == ["x1", "x2", "x3"]
    assert collected(spark, path, "latest", b_ckpt, b) == []
    log.append_messages(lines(spark, ["y1", "y2"], 2), path)
    assert collected(spark, path, "earliest", a_ckpt, a) == ["x1", "x2", "x3", "y1", "y2"]
    assert collected(spark, path, "latest", b_ckpt, b) == ["y1", "y2"]
    assert "x1" not in collected(spark, path, {0: 99, 1: 99}, c_ckpt, c)


def test_batch_ended_before_its_commit(spark, monkeypatch):
    path, out, ckpt = (scratch_path(spark, n) for n in ("log", "out", "ckpt"))
    log.append_messages(lines(spark, [f"m{i}" for i in range(20)], 4), path)
    stream = log.log_stream(spark, path)

    class Dies(commits.CommittedRows):
        def streamWriter(self, schema, overwrite):
            sink = super().streamWriter(schema, overwrite)

            class Sink(type(sink)):
                def commit(self, messages, batchId):
                    raise RuntimeError("ended between write and commit")

                def abort(self, messages, batchId):
                    pass  # a lost driver deletes nothing
            sink.__class__ = Sink
            return sink

    spark.dataSource.register(Dies)
    query = stream.writeStream.format(commits.FORMAT).option("path", out).option(
        "checkpointLocation", ckpt).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        query.awaitTermination()
    system, inner = files.open_fs(out)
    from pyarrow import fs
    left = [f.path for f in system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
            if f.path.endswith(".parquet")]
    assert left and commits.read_committed(spark, out, log.SCHEMA).count() == 0
    commits.write_stream(stream, out, ckpt).awaitTermination()
    rows = commits.read_committed(spark, out, log.SCHEMA)
    assert sorted(r.value for r in rows.collect()) == sorted(f"m{i}" for i in range(20))


def test_repeated_batch_id_is_ignored(spark):
    out = scratch_path(spark, "out")
    schema = "k long, at timestamp, list array<struct<mid: bigint, score: double>>"
    df = spark.range(5).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("at"),
                               F.array(F.struct(F.col("id").alias("mid"), F.lit(.5).alias("score")))
                               .alias("list"))
    for batch in (0, 0, 1, 0):
        commits.write_batch(df, out, batch)
    got = commits.read_committed(spark, out, schema)
    assert got.count() == 10 and {r.batch_id for r in got.collect()} == {0, 1}
    assert sorted(map(tuple, got.where("batch_id = 1").drop("batch_id").collect())) == sorted(
        map(tuple, df.collect()))


def test_recent_ratings_over_batches(spark):
    """Late messages, equal times, a hot user, several batches and restarts."""
    rng = random.Random(3)
    path, out, ckpt = (scratch_path(spark, n) for n in ("log", "out", "ckpt"))
    sent = []
    for batch in range(3):
        rows = [(1 if i % 3 == 0 else rng.randint(2, 9), rng.randint(1, 50), rng.randint(1, 10) / 2,
                 rng.randint(0, 12)) for i in range(60)]  # times overlap between batches
        rows.append((77 + batch, 5, 1.0, 3))
        sent += rows
        log.append_messages(lines(spark, ["|".join(map(str, r)) for r in rows] + ["1|2||4"], 2), path)
        parts = F.split("value", "[|]")
        parsed = log.log_stream(spark, path).select(*[
            F.get(parts, i).try_cast(t).alias(c) for i, (c, t) in enumerate((
                ("uid", "long"), ("mid", "long"), ("score", "double"), ("timestamp", "long")))])
        commits.write_stream(recent.recent_ratings(parsed, 5), out, ckpt).awaitTermination()
        lists = commits.read_committed(spark, out, recent.SCHEMA)
        got = {}
        for r in recent.latest_lists(lists).orderBy("uid", "rk").collect():
            got.setdefault(r.uid, []).append((r.mid, r.score))
        want = {}
        for u, m, s, _ in sorted(sent, key=lambda r: (-r[3], -r[2], r[1])):
            want.setdefault(u, [])
            if len(want[u]) < 5:
                want[u].append((m, s))
        assert got == want
    assert lists.where("uid = 77").count() == 1  # only users with new messages get a list
