"""Vocabulary trees, retrieval of image pairs, matching in the pairs, tracks."""

import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmill import operators, plans
from sparkmill.operators import retrieval
from sparkmill.sources import table, write_tracks

DATA = "/root/testdata"
SCHEMA = "vec_id long, label int, x array<double>"


def _rows(spark, sf="sf0.001"):
    return operators.descriptors(table(spark, f"{DATA}/{sf}", "embeddings"))


@pytest.fixture(scope="module")
def scenes(spark):
    """60 images of 40 vectors; images 3s, 3s + 1 and 3s + 2 see 12 points of one scene, each a little differently."""
    rng, rows = np.random.default_rng(3), []
    for scene in range(20):
        points = rng.normal(size=(12, 64))
        for image in range(3 * scene, 3 * scene + 3):
            x = np.r_[points + 0.35 * rng.normal(size=points.shape), rng.normal(size=(28, 64))]
            x /= np.linalg.norm(x, axis=1)[:, None]
            rows += [(image * 100 + i, image, v.tolist()) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).checkpoint()


def test_a_tree_finds_the_images_of_a_scene(scenes):
    tree = retrieval.fit_tree(scenes, 6, 3)
    assert [len(c) for c in tree.centres] == [6, 36, 216]
    found = retrieval.image_pairs(retrieval.postings(retrieval.words(scenes, tree)), 4).collect()
    same = [r for r in found if r["la"] // 3 == r["lb"] // 3]
    assert len(found) == 240 and len(same) >= 0.95 * 120
    graph = operators.view_graph(operators.ratio_matches(operators.nearest(scenes, 2, 1), 0.9), 15)
    pairs = [(r["la"], r["lb"]) for r in graph.collect()]
    assert len(pairs) == 60 and all(a // 3 == b // 3 for a, b in pairs)
    spark = scenes.sparkSession
    assert retrieval.pair_recall(graph, spark.createDataFrame(found)).first()["recall"] >= 0.95


def test_a_fit_does_not_depend_on_partitions(spark, scenes):
    first, second = (retrieval.fit_tree(df, 4, 2, 3) for df in (scenes, scenes.repartition(7)))
    assert all(np.array_equal(a, b) for a, b in zip(first.centres, second.centres))
    assert retrieval.fit_tree(scenes.limit(0)).centres == []
    few = retrieval.fit_tree(scenes.where("vec_id in (0, 100)"), 4, 2)
    assert sorted(r["word"] for r in retrieval.words(scenes.where("vec_id in (0, 100)"), few).collect())[0] >= 0


def test_words_are_the_nearest_children(scenes):
    tree = retrieval.fit_tree(scenes, 5, 2, 3)
    for r in retrieval.words(scenes.where("vec_id % 7 = 0"), tree).collect():
        node = 0
        for centres in tree.centres:
            node = node * 5 + int(np.argmax(np.round(centres[node * 5 : node * 5 + 5] @ np.array(r["x"]), 9)))
        assert r["word"] == node


@pytest.mark.parametrize("block", [1 << 11, 7])
def test_scores_against_plain_code(spark, monkeypatch, block):
    monkeypatch.setattr(retrieval, "BLOCK_IMAGES", block)
    rng = np.random.default_rng(5)
    tags = [(int(i), int(w)) for i, w in zip(rng.integers(0, 40, 600), rng.zipf(1.5, 600) % 50)] + [(99, 1000)]
    tagged = spark.createDataFrame([*tags, (None, 3), (5, None)], "label int, word long")
    images, vocabulary = sorted({i for i, _ in tags}), sorted({w for _, w in tags})
    tf = np.zeros((len(images), len(vocabulary)))
    for i, w in tags:
        tf[images.index(i), vocabulary.index(w)] += 1
    weight = tf * np.log(1 + len(images) / (tf > 0).sum(0))
    weight /= np.linalg.norm(weight, axis=1)[:, None]
    score = np.round(weight @ weight.T, 6)
    want = []
    for a, la in enumerate(images):
        order = sorted((b for b in range(len(images)) if b != a), key=lambda b: (-score[a, b], images[b]))
        want += [(la, images[b], score[a, b], r) for r, b in enumerate(order[:4], 1)]
    inverted = retrieval.postings(tagged)
    got = sorted(map(tuple, retrieval.image_pairs(inverted, 4).collect()))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in sorted(want, key=lambda w: (w[0], w[1]))] and np.allclose(sorted(g[2] for g in got), sorted(w[2] for w in want), atol=2e-6)
    asked = spark.createDataFrame([(images[0],), (images[3],)], "image int")
    assert sorted(map(tuple, retrieval.image_pairs(inverted, 4, asked).collect())) == [g for g in got if g[0] in (images[0], images[3])]
    assert retrieval.image_pairs(retrieval.postings(tagged.limit(0))).count() == 0


def test_recall_of_view_graph_pairs(spark):
    r = plans.retrieval_recall(spark, f"{DATA}/sf0.01").first()
    assert r["n_graph"] > 20 and r["recall"] >= 0.9


@pytest.mark.parametrize("rows_of,queries_of", [(1 << 13, 1 << 11), (17, 3)])
def test_matching_in_pairs_is_nearest_restricted_to_them(spark, monkeypatch, rows_of, queries_of):
    rows = _rows(spark)
    pairs = spark.createDataFrame([(0, 3), (3, 0), (7, 1), (2, 2), (4, 77)], "la int, lb int")
    linked = {(0, 3), (3, 0), (1, 7), (7, 1)}
    want = sorted(tuple(r) for r in operators.nearest(rows, 3).collect() if (r["ql"], r["cl"]) in linked)
    monkeypatch.setattr(operators, "CELL_ROWS", rows_of)
    monkeypatch.setattr(operators, "CELL_QUERIES", queries_of)
    assert sorted(map(tuple, operators.nearest_in_pairs(rows, pairs, 3).collect())) == want and want
    assert operators.nearest_in_pairs(rows, pairs.limit(0)).count() == 0 and operators.nearest_in_pairs(rows.limit(0), pairs).count() == 0


def test_a_hot_label_is_spread_over_cells(spark, monkeypatch):
    monkeypatch.setattr(operators, "CELL_ROWS", 100)
    monkeypatch.setattr(operators, "CELL_QUERIES", 50)
    rows = spark.range(12_000).selectExpr("id as vec_id", "cast(if(id % 3 = 0, 0, 1 + id % 40) as int) as label", "array(1D) as x")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 41)], "la int, lb int")
    cells = [r["count"] for r in operators._pair_cells(rows, pairs, rows.where("vec_id % 20 = 0")).groupBy("la", "lb", "i", "j").count().collect()]
    assert len(cells) > 500 and max(cells) <= 2 * statistics.median(cells)


def _components(pairs):
    up = {v: v for p in pairs for v in p}

    def root(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return sorted((v, root(v)) for v in up)


def test_tracks_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(9)
    chain = [(1000 + i, 1001 + i) for i in range(300)]
    star = [(5, 2000 + i) for i in range(200)]
    loops = [(9000, 9000), (9001, 9001), (9001, 9002), (9002, 9001)]
    loose = [tuple(map(int, p)) for p in rng.integers(3000, 3400, (260, 2))]
    for pairs in (chain + star + loops + loose + loose[:9], [(7, 7)], []):
        got = operators.tracks(spark.createDataFrame(pairs, "a long, b long"))
        assert sorted(map(tuple, got.collect())) == _components(pairs)


def test_track_stats_and_files(spark, tmp_path):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (9, 4), (5, 5), (6, 5), (7, 5)], "vec_id long, track_id long")
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 2), (9, 3), (5, 0), (6, 1), (7, 2)], "vec_id long, label int")
    assert sorted(map(tuple, operators.track_stats(members, rows).collect())) == [(2, 1, 0), (3, 2, 1)]
    assert sorted(map(tuple, operators.consistent_tracks(members, rows).collect())) == [(4, 2), (5, 3)]
    write_tracks(members, str(tmp_path / "tracks"), 4)
    back = spark.read.parquet(str(tmp_path / "tracks"))
    assert sorted(map(tuple, back.select("vec_id", "track_id").collect())) == sorted(map(tuple, members.collect()))
    assert all(r["n"] == 1 for r in back.groupBy("track_id").agg(F.countDistinct("bucket").alias("n")).collect())


def test_top_neighbours_break_ties(spark):
    graph = spark.createDataFrame([(0, 1, 5, 0.5), (0, 2, 5, 0.4), (0, 3, 5, 0.4), (1, 2, 9, 0.9)], "la int, lb int, n long, mean_d2 double")
    got = sorted(map(tuple, operators.top_neighbours(graph, 2).collect()))
    assert got == [(0, 2, 5, 0.4, 1), (0, 3, 5, 0.4, 2), (1, 0, 5, 0.5, 2), (1, 2, 9, 0.9, 1), (2, 0, 5, 0.4, 2), (2, 1, 9, 0.9, 1), (3, 0, 5, 0.4, 1)]
