"""Registered queries over the tables, outside the training-data subpackage.

The reference has no operators; these are the provisional match-graph slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators
from ..operators import ann, crosscheck, retrieval
from ..sources import table


#: Partners that retrieval gives a label.  Labels of the tables are classes of vectors without a common scene, so all but one of the nine others are asked for.
PARTNERS = 8


def descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"))


def descriptor_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.rejects(table(spark, sf_dir, "embeddings"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.nearest(operators.descriptors(table(spark, sf_dir, "embeddings")))


def ratio_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.ratio_matches(nearest(spark, sf_dir))


def view_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.view_graph(ratio_matches(spark, sf_dir))


def mutual_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosscheck.mutual_pairs(operators.descriptors(table(spark, sf_dir, "embeddings")))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.tracks(mutual_matches(spark, sf_dir))


def consistent_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.consistent_tracks(tracks(spark, sf_dir), operators.descriptors(table(spark, sf_dir, "embeddings")))


def approx_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest query through the index of codes."""
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    return ann.approx_nearest(ann.index(rows), rows.where("vec_id % 20 = 0"))


def approx_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: how many of the exact neighbours the index finds, and the part of all pairs that get an exact distance."""
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    indexed, asked = ann.index(rows), rows.where("vec_id % 20 = 0")
    found = ann.recall(operators.nearest(rows), ann.approx_nearest(indexed, asked))
    tried = ann.candidates(indexed, asked).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_candidates"))
    per = rows.groupBy("label").agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % 20 == 0, 1)).alias("n_asked"))
    pairs = per.agg(F.sum("n_asked").alias("asked"), F.sum("n").alias("all"), F.sum(F.col("n_asked") * F.col("n")).alias("own"))
    # Three tables of one row each.
    one = lambda df: df.withColumn("one", F.lit(1))
    out = one(found).join(one(tried), "one").join(one(pairs.select(F.coalesce(F.expr("asked * `all` - own"), F.lit(0)).alias("n_pairs"))), "one")
    return out.select("n_exact", "n_found", "recall", "n_candidates", "n_pairs")


def view_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.top_neighbours(view_graph(spark, sf_dir))


def _cell_words(rows: DataFrame) -> DataFrame:
    return ann.index(rows).select("label", F.col("cell").alias("word"))


def image_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The PARTNERS most alike labels of every label, by the cells of the index as words."""
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    return retrieval.image_pairs(retrieval.postings(_cell_words(rows)), PARTNERS)


def pair_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest query in the retrieved pairs of labels."""
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    return operators.nearest_in_pairs(rows, image_pairs(spark, sf_dir))


def tree_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The PARTNERS most alike labels of every label, by the words of a vocabulary tree."""
    rows = operators.descriptors(table(spark, sf_dir, "embeddings"))
    return retrieval.image_pairs(retrieval.postings(retrieval.words(rows, retrieval.fit_tree(rows))), PARTNERS)


def retrieval_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: how many edges of the view graph the vocabulary tree's pairs have."""
    return retrieval.pair_recall(view_graph(spark, sf_dir), tree_pairs(spark, sf_dir))


def track_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.track_stats(tracks(spark, sf_dir), operators.descriptors(table(spark, sf_dir, "embeddings")))


_ROWS = """rows_ AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(embedding) = 64 AND abs(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) - 1) < 1e-3)"""
_KNN = f"""{_ROWS}, pairs AS (SELECT a.vec_id AS q, a.label AS ql, b.vec_id AS c, b.label AS cl, round(2 - 2 * list_dot_product(a.x, b.x), 6) AS d2
  FROM rows_ a JOIN rows_ b ON a.label <> b.label WHERE a.vec_id % 20 = 0),
 knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, cl ORDER BY d2, c) AS r FROM pairs) WHERE r <= 2)"""
_RATIO = f"""{_KNN}, matches AS (SELECT * EXCLUDE (r) FROM (SELECT *, lead(d2) OVER (PARTITION BY q, cl ORDER BY r) AS d2_next FROM knn) WHERE r = 1 AND d2 < 0.95 * 0.95 * d2_next)"""

_MUTUAL = f"""{_ROWS}, pairs AS (SELECT a.vec_id AS q, a.label AS ql, b.vec_id AS c, b.label AS cl, round(2 - 2 * list_dot_product(a.x, b.x), 6) AS d2
  FROM rows_ a JOIN rows_ b ON a.label <> b.label),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, cl ORDER BY d2, c) AS r FROM pairs) WHERE r = 1),
 mutual AS (SELECT DISTINCT least(x.q, x.c) AS a, greatest(x.q, x.c) AS b, CASE WHEN x.q < x.c THEN x.ql ELSE x.cl END AS la, CASE WHEN x.q < x.c THEN x.cl ELSE x.ql END AS lb, x.d2
  FROM best x JOIN best y ON x.q = y.c AND x.c = y.q)"""
_TRACKS = f"""{_MUTUAL}, e AS (SELECT a, b FROM mutual UNION SELECT b, a FROM mutual), t AS (SELECT a AS v, a AS m FROM e UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.v),
 tracks AS (SELECT v AS vec_id, min(m) AS track_id FROM t GROUP BY v)"""

#: Codes as bit strings, cells by their first bits, and the cells that each query probes.
_ANN = f"""{_KNN}, plane AS (SELECT b, list(CASE WHEN substr(md5('plane-' || b || '-' || d), 1, 1) < '8' THEN 1.0 ELSE -1.0 END ORDER BY d) AS s FROM (SELECT unnest(range({ann.BITS})) AS b), (SELECT unnest(range(64)) AS d) GROUP BY b),
 m AS (SELECT vec_id, label, x, b, list_dot_product(list_transform(x, lambda v: floor(v * {ann.SCALE} + 0.5)), s) AS m FROM rows_, plane),
 coded AS (SELECT vec_id, label, any_value(x) AS x, string_agg(CASE WHEN m >= 0 THEN '1' ELSE '0' END, '' ORDER BY b)::BIT AS code,
  sum(CASE WHEN b < {ann.CELL_BITS} AND m >= 0 THEN 1 << b ELSE 0 END)::INT AS cell, list(m::HUGEINT ORDER BY b) FILTER (b < {ann.CELL_BITS}) AS first FROM m GROUP BY vec_id, label),
 cost AS (SELECT vec_id, c AS cell, list_sum(list_transform(range({ann.CELL_BITS}), lambda b: CASE WHEN ((c >> b) & 1) <> ((coded.cell >> b) & 1) THEN first[b + 1] * first[b + 1] ELSE 0 END)) AS cost
  FROM coded, (SELECT unnest(range({1 << ann.CELL_BITS}))::INT AS c) WHERE vec_id % 20 = 0),
 probed AS (SELECT vec_id, cell FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cost, cell) AS place FROM cost) WHERE place <= {ann.PROBES}),
 tried AS (SELECT a.vec_id AS q, a.label AS ql, b.vec_id AS c, b.label AS cl, round(2 - 2 * list_dot_product(a.x, b.x), 6) AS d2
  FROM probed JOIN coded a USING (vec_id) JOIN coded b ON b.cell = probed.cell AND a.label <> b.label AND bit_count(xor(a.code, b.code)) <= {ann.RADIUS}),
 near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q, cl ORDER BY d2, c) AS r FROM tried) WHERE r <= 2)"""

#: Labels as images, the cells of their vectors as words.
_IMAGES = f"""{_ANN}, tf AS (SELECT label AS image, cell AS word, count(*) AS tf FROM coded GROUP BY 1, 2),
 idf AS (SELECT word, ln(1 + (SELECT count(DISTINCT image) FROM tf) / count(*)) AS idf FROM tf GROUP BY word),
 post AS (SELECT image, word, tf * idf / sqrt(sum((tf * idf) * (tf * idf)) OVER (PARTITION BY image)) AS weight FROM tf JOIN idf USING (word)),
 alike AS (SELECT a.image AS la, b.image AS lb, round(coalesce(sum(x.weight * y.weight), 0), 6) AS score
  FROM (SELECT DISTINCT image FROM tf) a JOIN (SELECT DISTINCT image FROM tf) b ON a.image <> b.image LEFT JOIN post x ON x.image = a.image LEFT JOIN post y ON y.image = b.image AND y.word = x.word GROUP BY 1, 2),
 pairs_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY la ORDER BY score DESC, lb) AS r FROM alike) WHERE r <= {PARTNERS})"""
_VIEW = f"{_RATIO}, view_ AS (SELECT least(ql, cl) AS la, greatest(ql, cl) AS lb, count(*) AS n, round(avg(d2), 4) AS mean_d2 FROM matches GROUP BY 1, 2)"

_REJECTS = """WITH v AS (SELECT embedding IS NULL OR len(embedding) <> list_count(embedding) AS gap, embedding::DOUBLE[] AS x FROM embeddings),
 w AS (SELECT CASE WHEN gap THEN 'null' WHEN len(x) <> 64 THEN 'length' WHEN NOT coalesce(abs(list_dot_product(x, x) - 1) < 1e-3, false) THEN 'norm' END AS why FROM v)
 SELECT count(*) AS n_rows, count(*) FILTER (why = 'null') AS n_null, count(*) FILTER (why = 'length') AS n_length, count(*) FILTER (why = 'norm') AS n_norm FROM w"""


def queries() -> dict:
    return {"approx_nearest": approx_nearest, "approx_recall": approx_recall, "descriptors": descriptors, "descriptor_rejects": descriptor_rejects, "nearest": nearest, "ratio_matches": ratio_matches, "view_graph": view_graph, "view_neighbours": view_neighbours, "image_pairs": image_pairs, "pair_nearest": pair_nearest, "tree_pairs": tree_pairs, "retrieval_recall": retrieval_recall, "track_stats": track_stats, "mutual_matches": mutual_matches, "tracks": tracks, "consistent_tracks": consistent_tracks}


def oracle_sql() -> dict[str, str]:
    return {
        "descriptors": f"WITH {_ROWS} SELECT label, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id FROM rows_ GROUP BY label",
        "approx_nearest": f"WITH {_ANN} SELECT q, ql, c, cl, d2, r::INT AS r FROM near",
        "approx_recall": f"""WITH {_ANN}, hits AS (SELECT count(*) AS n_exact, count(near.q) AS n_found FROM knn LEFT JOIN near USING (q, c))
  SELECT n_exact, n_found, round(n_found / n_exact, 6) AS recall, (SELECT count(*) FROM tried) AS n_candidates, (SELECT count(*) FROM pairs) AS n_pairs FROM hits""",
        "image_pairs": f"WITH {_IMAGES} SELECT la, lb, score, r::INT AS r FROM pairs_",
        "pair_nearest": f"WITH {_IMAGES} SELECT q, ql, c, cl, d2, r::INT AS r FROM knn WHERE EXISTS (SELECT 1 FROM pairs_ p WHERE (p.la, p.lb) IN ((ql, cl), (cl, ql)))",
        "view_neighbours": f"""WITH {_VIEW}, ways AS (SELECT la AS label, lb AS neighbour, n, mean_d2 FROM view_ UNION ALL SELECT lb, la, n, mean_d2 FROM view_)
  SELECT label, neighbour, n, mean_d2, r::INT AS r FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, mean_d2, neighbour) AS r FROM ways) WHERE r <= 3""",
        "track_stats": f"""WITH RECURSIVE {_TRACKS}, per AS (SELECT track_id, count(*) AS length, count(DISTINCT label) AS labels FROM tracks JOIN rows_ USING (vec_id) GROUP BY track_id)
  SELECT length, count(*) AS n_tracks, count(*) FILTER (labels < length) AS n_conflicting FROM per GROUP BY length""",
        "descriptor_rejects": _REJECTS,
        "nearest": f"WITH {_KNN} SELECT q, ql, c, cl, d2, r::INT AS r FROM knn",
        "ratio_matches": f"WITH {_RATIO} SELECT * FROM matches",
        "view_graph": f"WITH {_RATIO} SELECT least(ql, cl) AS la, greatest(ql, cl) AS lb, count(*) AS n, round(avg(d2), 4) AS mean_d2 FROM matches GROUP BY 1, 2",
        "mutual_matches": f"WITH {_MUTUAL} SELECT * FROM mutual",
        "tracks": f"WITH RECURSIVE {_TRACKS} SELECT * FROM tracks",
        "consistent_tracks": f"WITH RECURSIVE {_TRACKS} SELECT track_id, count(*) AS n FROM tracks JOIN rows_ USING (vec_id) GROUP BY track_id HAVING count(*) = count(DISTINCT label)",
    }
