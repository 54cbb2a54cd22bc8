"""Queries whose rows, shuffles or tasks must not grow with the square of the input."""

import numpy as np
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelrank.operators import rerank, similarity, tfidf
from reelrank.session import checkpoint_once
from reelrank.sources import tables
from reelrank.streaming import commits, log, recent
from tests.conftest import rows


DOCS = [(1, "Action|Adventure"), (2, "Action"), (3, "Comedy|Drama"), (4, "Action|Adventure"),
        (5, ""), (6, "Drama"), (8, "Comedy|Drama|Drama"), (9, "Adventure|Comedy"), (12, "Drama|")]


@pytest.mark.parametrize("hashed", [False, True])
def test_links_expand_to_the_item_pairs(spark, hashed):
    docs = spark.createDataFrame([*DOCS, (4, "Action|Adventure"), (6, "Comedy|Drama"), (None, "Drama")],
                                 "mid long, genres string")
    links = tfidf.tfidf_item_links(docs, hashed=hashed).collect()
    want = {}
    for r in tfidf.tfidf_item_similarity(docs, hashed=hashed).collect():
        want.setdefault((r.mid, r.sim_mid), []).append(r.sim)
    members = [r for r in links if r.kind == "member"]
    sims = {(r.mid, r.sim_mid): r.sim for r in links if r.kind == "pair"}
    sims |= {(r.sim_mid, r.sim_mid): r.sim for r in members if r.sim is not None}
    got = {}
    for a in members:
        linked = [(b.mid, sims[a.sim_mid, b.sim_mid]) for b in members
                  if (a.sim_mid, b.sim_mid) in sims and None not in (a.mid, b.mid) and a.mid != b.mid]
        assert a.n_links == len(linked)
        for mid, sim in linked:
            got.setdefault((a.mid, mid), []).append(sim)
    assert got.keys() == want.keys() and all(
        sorted(got[p]) == pytest.approx(sorted(want[p])) for p in want)


NAMES = ["hot ring rod", "hot ring rod new", "cold bolt", "blue anvil"]


def _parts(spark, path, copies):
    """A part table whose texts come ``copies`` times each."""
    spark.range(copies * len(NAMES)).selectExpr(
        "id as p_partkey", f"array({str(NAMES)[1:-1]})[int(id % 4)] as p_name",
        "'LARGE' as p_type", "'b' as p_brand", "1 as p_size").write.parquet(f"{path}/part.parquet")


@pytest.mark.parametrize("hashed", [False, True])
def test_copies_do_not_multiply(spark, tmp_path, hashed):
    """Ten times the copies of each text: ten times the members, the same class pairs."""
    sizes = []
    for copies in (3, 30):
        folder = str(tmp_path / str(copies))
        _parts(spark, folder, copies)
        out = tfidf.tfidf_item_links(tables.movies(spark, folder), hashed=hashed)
        kinds = {r["kind"]: r["count"] for r in out.groupBy("kind").count().collect()}
        assert kinds["member"] == copies * len(NAMES)
        sizes.append(kinds.get("pair", 0))
    assert sizes[0] == sizes[1] > 0


@pytest.mark.parametrize("name", ["tfidf_item_sim", "tfidf_hashed_sim", "sim_text_roundtrip"])
def test_similarity_queries_list_every_item_pair(spark, tmp_path, name):
    """Copies of a text are similar to each other and to each copy of a similar text."""
    folder = str(tmp_path)
    _parts(spark, folder, 3)
    out = entry.queries()[name](spark, folder)
    assert out.columns == ["mid", "sim_mid", "sim"]
    got = {(r.mid, r.sim_mid) for r in out.collect()}
    assert len(got) == out.count()
    assert {(i, j) for i in range(12) for j in range(12) if i != j and i % 4 == j % 4} <= got
    assert {(i, j) for i in range(0, 12, 4) for j in range(1, 12, 4)} <= got


def _embedded(spark, path, n):
    """``n`` vectors, ids from 1 that are no multiples of 100."""
    vecs = np.random.default_rng(5).normal(size=(n, 6))
    spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(vecs)],
                          "vec_id long, embedding array<float>").write.parquet(
        f"{path}/embeddings.parquet")
    return vecs.astype(np.float32).astype(float)


def test_top_lists_of_every_vector(spark, tmp_path):
    _embedded(spark, str(tmp_path), 60)
    for name, k in (("cosine_topk", 10), ("product_topk", 20)):
        out = entry.queries()[name](spark, str(tmp_path)).collect()
        assert sorted((r.vec_id, r.rk) for r in out) == [
            (i, rk) for i in range(1, 61) for rk in range(1, k + 1)]


def test_threshold_lists_every_pair(spark, tmp_path):
    vecs = _embedded(spark, str(tmp_path), 60)
    units = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    cos = units @ units.T
    want = {(i + 1, j + 1): cos[i, j] for i in range(60) for j in range(60)
            if i != j and cos[i, j] > 0.3}
    out = entry.queries()["cosine_threshold"](spark, str(tmp_path)).collect()
    got = {(r.vec_id, r.sim_id): r.sim for r in out}
    assert len(out) == len(got) and got == pytest.approx(want, abs=1e-6)


def test_every_user_gets_a_list(spark, tmp_path):
    """Users whose ids are no multiples of 100."""
    spark.range(1, 41).selectExpr(
        "id as o_orderkey", "1 + id % 9 as o_custkey",
        "timestamp'2020-01-01 00:00:00' as o_orderdate", "'1' as o_orderpriority").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.range(160).selectExpr(
        "1 + id % 40 as l_orderkey", "1 + (id * 7) % 23 as l_partkey",
        "cast(id as int) as l_linenumber", "cast(1 + id % 50 as double) as l_quantity"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    out = entry.queries()["als_user_recs"](spark, str(tmp_path)).collect()
    assert sorted(r.uid for r in out) == list(range(1, 10))
    assert all(r.is_factor_product and r.solves_ridge for r in out)


def _copies(spark, n):
    """Items 0..n-1 of three texts, a light rater and one who has rated most of the first text."""
    movies = spark.range(n).selectExpr(
        "id as mid", "case id % 3 when 0 then 'a|b' when 1 then 'a|b|c' else 'd' end as genres")
    movies = movies.union(movies.where("mid < 6"))  # repeated rows
    data = [(1, 0, 5.0, 1), (1, 4, 2.0, 2), (3, 1, 4.0, 1)]
    data += [(2, m, 1.0 + m % 5, m) for m in range(0, n - 30) if m % 3 < 2]
    ratings = spark.createDataFrame(data, "uid long, mid long, score double, ts long")
    return movies, ratings


@pytest.mark.parametrize("bitmaps", [False, True])
def test_only_prefixes_of_copies_are_listed(spark, monkeypatch, bitmaps):
    movies, ratings = _copies(spark, 240)
    item_group, sims = tfidf.tfidf_similarity_groups(movies)
    events, seen = rerank.latest_events(ratings), ratings.select("uid", "mid")
    want = rows(rerank.sim_candidates(events, sims, seen, 20, item_group=item_group))
    listed, lists = [], rerank._lists

    def counted(matrix, groups):
        out = lists(matrix, groups)
        listed.append(out)
        return out

    monkeypatch.setattr(rerank, "_lists", counted)
    prefix = rerank._prefix(sims, item_group, 40)
    assert listed[-1].groupBy("src", "sim").count().agg({"count": "max"}).first()[0] <= 40
    capped = checkpoint_once(rerank.capped_matrix(sims, 40, item_group))
    assert rows(capped.select(*prefix.columns)) == rows(prefix)
    got = rerank.sim_candidates(events, sims, rerank.seen_bitmaps(seen) if bitmaps else seen, 20,
                                capped=capped, item_group=item_group)
    assert rows(got) == want and {r[0] for r in want} == {1, 2, 3}


@pytest.mark.parametrize("exclude_seen", [False, True])
def test_scores_by_group_equal_scores_by_item(spark, exclude_seen):
    movies, ratings = _copies(spark, 90)
    movies = movies.distinct()
    ratings = ratings.unionByName(ratings.where("uid = 3").withColumn("score", F.lit(None).cast("double")))
    item_group, sims = tfidf.tfidf_similarity_groups(movies)
    events = rerank.latest_events(ratings)
    recent = rerank.user_recent_k(ratings, 20)
    cands = rerank.sim_candidates(events, sims, ratings if exclude_seen else None, 20,
                                  item_group=item_group)
    got = rerank.score_candidates(cands, recent, sims, item_group=item_group, unseen=exclude_seen)
    matrix = rerank._lists(sims, item_group).join(
        item_group.select("mid", F.col("grp").alias("src")), "src").select("mid", "sim_mid", "sim")
    want = {(r.uid, r.mid): r.score for r in
            rerank.score_candidates(cands, recent, matrix).collect()}
    got = {(r.uid, r.mid): r.score for r in got.collect()}
    assert got.keys() == want.keys() and len(want) > 20
    assert all(got[k] == (None if want[k] is None else pytest.approx(want[k])) for k in want)


def test_bitmaps_take_no_more_than_their_ratings(spark):
    """Items far apart: 4 KB for each rating once, a long now."""
    seen = spark.range(50).selectExpr("1L as uid", "id * 100000 as mid")
    maps = rerank.seen_bitmaps(seen)
    assert maps.count() == 50 and dict(maps.dtypes)["bits"] == "bigint"


def test_links_are_counted_in_few_groups(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vecs = np.concatenate([np.zeros((2, 8)), np.repeat(rng.normal(size=(3, 8)), 20, axis=0),
                           rng.normal(size=(240, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)],
                               "id long, vec array<double>")
    monkeypatch.setattr(similarity, "PIVOT_ROWS", 10)
    want = {}
    for r in similarity.cosine_pairs(df, threshold=0.3, prune=False).collect():
        want[r.id] = want.get(r.id, 0) + 1
    got = {r.id: r for r in similarity.cosine_links(df, threshold=0.3, chunk_rows=7).collect()}
    assert {i: r.n_links for i, r in got.items() if r.n_links} == want and len(got) == len(vecs)
    assert all(got[i].class_id == (0 if i < 2 else 2 + (i - 2) // 20 * 20 if i < 62 else i)
               for i in got)
    # a vector is shipped once per group, not once per pivot's block
    blocks = similarity.DirectionalBlocks(similarity.unit_vectors(df, "id", "vec"), len(vecs), 8,
                                          0.3, pivot_rows=10)
    most = max(r["n"] for r in blocks.groups.groupBy("blk").agg(F.count("*").alias("n")).collect())
    fanned = max(r["n"] for r in blocks.pairs.groupBy("blk").agg(F.count("*").alias("n")).collect())
    assert most <= 2 * similarity.MIN_GROUPS < fanned


def test_pairs_are_handed_on_in_slabs(spark, monkeypatch):
    """A task gives its pairs a slab of similarities at a time; vectors go to few groups."""
    rng = np.random.default_rng(2)
    vecs = np.concatenate([np.zeros((2, 8)), np.ones((40, 8)), rng.normal(size=(260, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)],
                               "id long, vec array<double>")
    monkeypatch.setattr(similarity, "PIVOT_ROWS", 10)
    want = {(r.id, r.sim_id): r.sim for r in
            similarity.cosine_pairs(df, threshold=0.3, prune=False).collect()}
    out = similarity.cosine_pairs(df, threshold=0.3, chunk_rows=7).collect()
    got = {(r.id, r.sim_id): r.sim for r in out}
    assert len(out) == len(got) and got == pytest.approx(want)
    blocks = similarity.DirectionalBlocks(similarity.unit_vectors(df, "id", "vec"), len(vecs), 8,
                                          0.3, pivot_rows=10)
    task, key = next((t, k) for t, k in enumerate(blocks.tasks) if len(blocks.near[k]) > 2)
    rows_ = blocks.packed.join(blocks.groups.where(f"task = {task}"), "blk").select(
        "task", "blk", "ids", "vecs").toArrow().to_batches()
    slabs = list(similarity._pair_rows_fn(0.3, 7, [blocks.near[k] for k in blocks.tasks])(iter(rows_)))
    most = max(blocks.packed.selectExpr("blk", "length(ids) / 8 as n").groupBy("blk").agg(
        F.sum("n").alias("n")).toPandas()["n"])
    assert len(slabs) > 2 and max(len(x) for x in slabs) <= 7 * most


def test_search_meets_all_rows(spark):
    vecs = np.random.default_rng(3).normal(size=(90, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)],
                               "id long, vec array<double>")
    whole = similarity.cosine_pairs(df, threshold=None, top_k=4)
    some = similarity.cosine_pairs(df, threshold=None, top_k=4, queries="id % 10 = 0", chunk_rows=2)
    cols = ["id", "rk", "sim_id"]
    assert rows(some, *cols) == rows(whole.where("id % 10 = 0"), *cols) and some.count() == 36


def test_scores_held_at_a_time_are_bounded(monkeypatch):
    monkeypatch.setattr(similarity, "SLAB_BYTES", 8 * 100)
    assert similarity._chunk(1024, 50) == 2 and similarity._chunk(1024, 1000) == 1


@pytest.mark.parametrize("groups", [1, 7])
def test_users_share_states(spark, tmp_path, groups):
    """Lists and versions per user don't depend on how many users share a state."""
    path, out, ckpt = (str(tmp_path / x) for x in ("log", "out", "ckpt"))
    rated = [(u, m, float(m % 5), (m * 7) % 11) for u in range(1, 9) for m in range(u * 3)]
    batches = [rated[::2], [r for r in rated[1::2] if r[0] != 4], [(3, 99, 5.0, 99)]]
    for rows_ in batches:
        log.append_messages(spark.createDataFrame(
            [("|".join(map(str, r)),) for r in rows_], "value string").repartition(3), path)
        fields = F.split("value", "[|]")
        parsed = log.log_stream(spark, path).select(*[
            fields[i].cast(t).alias(c) for i, (c, t) in enumerate((
                ("uid", "long"), ("mid", "long"), ("score", "double"), ("timestamp", "long")))])
        commits.write_stream(recent.recent_ratings(parsed, 4, groups=groups), out, ckpt
                             ).awaitTermination()
    lists = commits.read_committed(spark, out, recent.SCHEMA)
    got = {}
    for r in sorted(recent.latest_lists(lists).collect()):
        got.setdefault(r.uid, []).append(r.mid)
    all_rows = [r for b in batches for r in b]
    for u in range(1, 9):
        mine = sorted((r for r in all_rows if r[0] == u), key=lambda r: (-r[3], -r[2], r[1]))[:4]
        assert got[u] == [r[1] for r in mine]
    last = {r.uid: r.v for r in lists.groupBy("uid").agg(F.max("version").alias("v")).collect()}
    assert last == {u: 2 + (u == 3) - (u == 4) for u in range(1, 9)}
