"""The compression classifier: held-out accuracy, calibration, scores against plain code."""

import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from sparkmill.llm import compression, queries
from sparkmill.llm.common import table

DATA = "/root/testdata"


def _auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.fixture(scope="module")
def scores(spark):
    return queries.op12_compression_quality(spark, f"{DATA}/sf0.1").toPandas()


def test_held_out_accuracy(spark, scores):
    labels = table(spark, f"{DATA}/sf0.1", "labels").toPandas()
    assert len(scores) == table(spark, f"{DATA}/sf0.1", "documents").count() and scores["score"].between(0, 1).all()
    assert (scores["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scores["doc_id"]]).all()
    assert (scores["predicted"] == (scores["score"] >= 0.5)).all()
    some = scores[scores["held_out"]].merge(labels, on="doc_id")
    y = some["quality"].to_numpy()
    assert (some["predicted"] == y).mean() > 0.97 and _auc(some["score"].to_numpy(), y) > 0.98
    for part in (some[some["score"] >= 0.5], some[some["score"] < 0.5]):  # calibrated
        assert abs(part["score"].mean() - part["quality"].mean()) < 0.08


def test_labels_of_held_out_rows_play_no_part(spark):
    docs, labels = table(spark, f"{DATA}/sf0.01", "documents"), table(spark, f"{DATA}/sf0.01", "labels")
    other = labels.withColumn("quality", F.when(compression.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: sorted(map(tuple, df.collect()))
    first = key(queries.op12_of(docs, labels))
    assert first == key(queries.op12_of(docs, other))
    assert first == key(queries.op12_of(docs.repartition(5).withColumns({"lang": F.lit(None), "source": F.lit("x")}), labels.repartition(3)))


def test_scores_against_plain_code(spark):
    good, bad = b"the good dictionary of words and more words " * 4, b"### $$$ %%% bad bad bad |||| " * 5
    model = compression.Model(good, bad, [0.0] * 9, [1.0] * 9, [0.5, 2.0, -1.0, 0.25, *[0.1] * 6], 0.3)
    texts = [None, "", "words and more words", "### $$$ bad", "é" * 999, "x" * 300_000]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    got = {r["doc"]["doc_id"]: (r["doc"]["score"], r["score"]) for r in compression.scored(docs, model).collect()}

    def size(t, d):
        return len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(t))

    for i, t in enumerate(texts):
        raw = (t or "").encode()
        g, b, n = size(raw, good), size(raw, bad), len(raw)
        x = [(b - g) / (b + g), np.log((b + g + 1) / (2 * n + 2)), np.log(n + 1)]
        x += [x[i] * x[j] for i in range(3) for j in range(i, 3)]
        assert got[i] == ("own", pytest.approx(1 / (1 + np.exp(-(0.5 + np.dot(model.weights[1:], x))))))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y"), (3, "z" * 200_000, "y")], "doc_id long, text string, prior string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, 7, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    assert {(r["score"], r["predicted"]) for r in queries.op12_of(docs, labels).collect()} == {(1.0, 1)}
    assert {r["score"] for r in queries.op12_of(docs, labels.limit(0)).collect()} == {0.5}
    assert queries.op12_of(docs.limit(0), labels).count() == 0
    small = spark.createDataFrame([(i, f"good words number {i} of many" if i % 2 else f"### {i} $$$") for i in range(60)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    got = queries.op12_of(small, marks).collect()
    assert len(got) == 60 and np.mean([r["predicted"] == r["doc_id"] % 2 for r in got]) > 0.9


def test_copies_only_add_weight(spark):
    docs = spark.createDataFrame([(i, "copy") for i in range(50)] + [(99, "one")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(99, 1)], "doc_id long, quality int")
    sample, prior = compression.labelled_sample(docs, labels)
    assert prior == 1.0 and sorted((r["text"], r["weight"]) for r in sample.collect()) == [("copy", 50.0), ("one", 1.0)]
