"""Threshold-scaled sketches (DataFrame functions only).

A text's shingles are its runs of five words (the whole sequence if it has fewer); the
sketch keeps every distinct shingle hash in the lowest ``1 / SCALE`` of the hash range.
Whether a hash is kept does not depend on the document, so sketches merge by union, and
intersections estimate containment between very unequal documents without bias.

The fingerprint is the hash of the text, a colon and the sorted kept hashes in hex: equal
texts have equal fingerprints, unequal texts differ even where both sketches are empty.

Edge cases: null counts as empty; an empty text has an empty sketch; a document's likeness
to an equal text is 1, to others the Jaccard estimate (0 where no hash is kept).  Repeated
ids follow each other ordered by text.  Other columns take no part.  An empty table gives no rows; a lone document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized

WIDTH = 5
SCALE = 4


def sketch(text: Column) -> Column:
    """Sorted distinct shingle hashes below the fixed fraction, as array<long>."""
    bound = F.lit((1 << 63) // SCALE * 2 - (1 << 63))  # lowest 1 / SCALE of the signed range
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    spread = lambda ws: F.when(
        F.size(ws) >= WIDTH,
        F.transform(F.sequence(F.lit(0), F.size(ws) - WIDTH), lambda i: F.xxhash64(*(F.get(ws, i + k) for k in range(WIDTH)))),
    ).when(F.size(ws) > 0, F.array(F.xxhash64(F.array_join(ws, " ")))).otherwise(F.array().cast("array<bigint>"))
    # The one-element transform binds the words once for all uses below.
    hashes = F.get(F.transform(F.array(words), spread), 0)
    return F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < bound)))


def fingerprint(text: Column, kept: Column) -> Column:
    return F.concat(F.hex(F.xxhash64(text)), F.lit(":"), F.array_join(F.transform(kept, lambda h: F.hex(h)), ","))


def likeness(a_text: Column, a: Column, b_text: Column, b: Column) -> Column:
    """Jaccard estimate of two sketches; 1 for equal texts."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(a_text == b_text, F.lit(1.0)).when(union > 0, both / union).otherwise(F.lit(0.0))


def containment(a: Column, b: Column) -> Column:
    """Estimated part of a's shingles that b has."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(0.0))


def merged(a: Column, b: Column) -> Column:
    """Sketch of the two texts' shingles together."""
    return F.array_sort(F.array_union(a, b))


def with_next(docs: DataFrame, sketched: bool = False) -> DataFrame:
    """doc_id, text, next_text (and sketch, next_sketch): each document with the next in descending id order (the last with the first).

    The ids alone are range-partitioned, which gives a bin to each of Spark's shuffle partitions;
    a window in each bin pairs neighbours, and each bin also gets the first documents of the bin that follows
    it.  Texts, sketched once, are shuffled once.
    """
    spark = docs.sparkSession
    spot = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))  # null ids come last
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select(spot.alias("spot")).repartitionByRange(most, "spot").groupBy(F.spark_partition_id().alias("at")).agg(F.max("spot").alias("hi"))
    # One row per bin.
    bins = materialize(ranges.select("hi", (F.row_number().over(Window.orderBy("hi")) - 1).alias("bin")), "bins")
    n = bins.count()
    # How many bins end below an id: a binary search in their ends, which a scalar subquery brings to the rows.
    ends = bins.agg(F.sort_array(F.collect_list("hi")).alias("ends")).scalar()
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, n.bit_length())))))
    below = lambda c: F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= n) & (F.get(c["ends"], at + s - 1) < c["spot"]), at + s).otherwise(at))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), *([sketch(text).alias("sketch")] if sketched else []), F.struct(spot.alias("spot"), ends.alias("ends")).alias("__c"))
    rows = rows.withColumn("bin", below(F.col("__c"))).withColumn("__spot", F.col("__c")["spot"]).drop("__c")
    # In descending order a bin's last document is followed by the first of the bin below it.
    guests = bins.select(F.col("hi").alias("__head"), F.pmod(F.col("bin") + 1, F.lit(max(n, 1))).alias("to"))
    placed = rows.join(sized(guests, 64), F.col("__spot") == F.col("__head"), "left")
    here = F.struct(F.col("bin").cast("int").alias("bin"), F.lit(0).alias("guest"))
    there = F.struct(F.col("to").cast("int").alias("bin"), F.lit(1).alias("guest"))
    cols = [c for c in ("doc_id", "text", "sketch") if c in rows.columns]
    placed = placed.select(*cols, F.explode(F.when(F.col("to").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("p")).select(*cols, "p.bin", "p.guest")
    order = Window.partitionBy("bin").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    nexts = [F.lead(c).over(order).alias(f"next_{c}") for c in cols[1:]]
    return placed.select(*cols, "guest", *nexts).where("guest = 0").drop("guest")


def edited_texts(docs: DataFrame, sketched: bool = False) -> DataFrame:
    """with_next's rows with n_chars, edited (the last third of the text replaced by the beginning of the next) and edited_sha256."""
    n, m = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    p = with_next(docs, sketched).withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - m), F.col("next_text").substr(F.lit(1), m)))
    return p.withColumns({"n_chars": n.cast("long"), "edited_sha256": F.sha2("edited", 256)})


def edited_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    p = edited_texts(docs, True).withColumn("edited_sketch", sketch(F.col("edited")))
    return p.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("text"), F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited"), F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("text"), F.col("sketch"), F.col("edited"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("text"), F.col("sketch"), F.col("next_text"), F.col("next_sketch")).alias("near_next"),
    )
