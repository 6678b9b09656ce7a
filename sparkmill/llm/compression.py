"""Quality classifier by compression: which of two dictionaries, of good and of bad texts, makes a text smaller.

Fitting takes a bounded sample of labelled rows: about SAMPLE_ROWS of each label, by a hash of the id, and each
distinct text once, weighted by its copies.  A hash of the text deals the sample out: one half
trains a zstandard dictionary per label (SAMPLE_BYTES of texts at most), the other half calibrates, so no text is
scored by a dictionary that holds it.  The evidence is the difference of the two compressed sizes as a part of their sum; how much
it says depends on how far a text compresses at all and on its length, so calibration is a logistic
curve over these three and their products, weighted back to the shares of the labels.

Scoring reads every text once, whole, in the tasks that scan it; the model is two dictionaries and ten numbers.

Edge cases: a null or empty text has no difference and gets the score that the curve gives at length 0; labels other than
0 and 1 are left out, an id labelled both ways counts as both; without texts of both labels in each half every score is the share of
label 1 (0.5 without labels); further columns of any name pass through in the struct `doc`; an empty table gives an empty table.
A dictionary that the library can't train (a handful of texts) is the texts themselves.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, release, sized, slices

#: Labelled rows of each label in the sample, about; bytes of texts that a dictionary is trained on (one text at least).
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 16 << 20
DICTIONARY_BYTES, LEVEL = 110 << 10, 3
#: Pull of the calibration's weights to 0, in rows.
RIDGE = 1.0
_DRAWS = 1 << 30


class Model(NamedTuple):
    good: bytes
    bad: bytes
    mean: list[float]
    scale: list[float]
    weights: list[float]
    prior: float


def _compressors(*dictionaries: bytes):
    out = []
    for d in dictionaries:
        held = zstandard.ZstdCompressionDict(d)
        held.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
    return out


def features(texts: list[bytes | None], good, bad) -> np.ndarray:
    """Per text: the difference of compressed sizes (over 0: smaller with the good dictionary), log of the compressed part, log of length, and their products."""
    sizes = [(len(good.compress(t)), len(bad.compress(t)), len(t)) for t in (t or b"" for t in texts)]
    g, b, n = np.array(sizes, np.float64).reshape(-1, 3).T
    base = np.stack([(b - g) / (b + g), np.log((b + g + 1) / (2 * n + 2)), np.log(n + 1)], 1)
    return np.concatenate([base, *(base[:, i:] * base[:, i : i + 1] for i in range(3))], 1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """(mean, scale, weights) of a logistic curve, by Newton's steps."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    weight = weight * len(x) / weight.sum()
    pull = np.r_[1e-6, np.full(x.shape[1], RIDGE)]
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = _sigmoid(z @ w)
        step = np.linalg.solve((z.T * (weight * p * (1 - p))) @ z + np.diag(pull), z.T @ (weight * (y - p)) - pull * w)
        w += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, w


def _dictionary(table: pa.Table) -> pa.Table:
    texts = [t for _, t in sorted(zip(table.column("h").to_pylist(), table.column("text").cast(pa.binary()).to_pylist()))]
    try:
        made = zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:  # too few
        made = b"\n".join(texts)[-DICTIONARY_BYTES:]
    release()
    return pa.table({"quality": table.column("quality").slice(0, 1), "made": [made]})


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """((materialized) h, text, quality, weight of the sampled distinct texts; the share of label 1 among all labels).

    labels: doc_id, quality of the rows that may be learnt from.
    """
    held = materialize(labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct(), "labels")
    n = {r["quality"]: r["n"] for r in held.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    rate = {q: min(1.0, SAMPLE_ROWS / max(1, n.get(q, 0))) for q in (0, 1)}
    per = lambda f: F.when(F.col("quality") == 1, F.lit(f(rate[1]))).otherwise(F.lit(f(rate[0])))
    drawn = F.pmod(F.xxhash64(F.lit("quality-sample"), "doc_id"), F.lit(_DRAWS)) < per(lambda r: int(r * _DRAWS))
    some = materialize(held.where(drawn).withColumn("weight", per(lambda r: 1 / r)), "labels-sample")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(sized(some, 24), "doc_id")
    # Each distinct text once, before it is sorted or sent to a task: copies only add weight.
    distinct = texts.groupBy(F.sha2("text", 256).alias("h"), "quality").agg(F.min("text").alias("text"), F.sum("weight").alias("weight"))
    return materialize(distinct, "quality-sample"), n.get(1, 0) / sum(n.values()) if n else 0.5


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier of docs (doc_id, text) with labels (doc_id, quality), both of the rows that may be learnt from."""
    sample, prior = labelled_sample(docs, labels)
    trains = F.conv(F.substring("h", 1, 1), 16, 10).cast("int") < 8
    upto = Window.partitionBy("quality").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    train = sample.where(trains).withColumn("before", F.coalesce(F.sum(F.octet_length("text").cast("long")).over(upto), F.lit(0)))
    train = train.where(F.col("before") < SAMPLE_BYTES).select("quality", "h", "text")
    made = {r["quality"]: bytes(r["made"]) for r in train.groupBy("quality").applyInArrow(_dictionary, "quality int, made binary").collect()}
    constant = Model(b"", b"", [], [], [], prior)
    if len(made) < 2:
        return constant
    good, bad = made[1], made[0]

    def measured(batches):
        two = _compressors(good, bad)
        for batch in slices(batches, "text"):
            x = features(batch.column(0).cast(pa.binary()).to_pylist(), *two)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "quality", "weight"])

    # A few numbers for each row of the bounded sample.
    rows = sorted(sample.where(~trains).select("text", "quality", "weight").mapInArrow(measured, "x array<double>, quality int, weight double").collect())
    y = np.array([r["quality"] for r in rows], np.float64)
    if len(set(y)) < 2:
        return constant
    found = calibrate(np.array([r["x"] for r in rows]), y, np.array([r["weight"] for r in rows]))
    return Model(good, bad, *(v.tolist() for v in found), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc (a struct of the other columns of docs), score (0 to 1; higher: label 1 is likelier)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    src = docs.select(F.struct(*(others or [F.lit(None).cast("int").alias("none")])).alias("doc"), F.col("`text`").cast("string").alias("text"))

    def run(batches):
        two = _compressors(model.good, model.bad) if model.weights else None
        mean, scale, w = map(np.array, (model.mean, model.scale, model.weights))
        for batch in slices(batches, "text"):
            p = np.full(batch.num_rows, model.prior)
            if two:
                x = features(batch.column(1).cast(pa.binary()).to_pylist(), *two)
                p = _sigmoid(w[0] + ((x - mean) / scale * w[1:]).sum(1))  # row by row, so batches do not matter
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["doc", "score"])

    return src.mapInArrow(run, T.StructType([src.schema["doc"]]).add("score", "double"))


def held_out(doc_id: str = "doc_id") -> Column:
    """One row in three by the checksum of its id is never learnt from; without an id a row has no label to hold out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
