"""Mixing sources to target weights by a low-discrepancy schedule.

Size is words.  Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share
all sizes; a target stops at ``MAX_REPEATS`` times its source's size and the excess is
shared again by weight.  Slot j is the golden-ratio point frac(j * phi), mapped through the
cumulative targets to a source; slots are ranked per source, and the r-th slot of a source
takes the r-th block of ``BLOCK`` words of that source's hash-shuffled documents laid end to
end, over and over.  What a source gives is what its slots draw, no more and no less (but for words past
MAX_REPEATS turns), so it is within a few blocks of its target, and any stretch of slots is mixed as the whole.

Scale: there is a slot per BLOCK words.  Sizes, never texts, are shuffled for the schedule.  Running
sums and ranks are made in (source, bin) and (source, chunk) groups with prefix sums over
the groups, so a hot source is spread over many tasks; the table of sources (one row each) is the
only thing that one task sees whole.

Edge cases: a null or empty text has size 0 and is never taken; a null source is a source of
its own; repeated rows are separate documents; other columns take no part in the schedule; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Words that a slot takes.  Larger blocks make fewer slots and coarser shares.
BLOCK = 64
BINS = 1 << 10
#: Slots of a chunk, chunks of a group of chunks.
CHUNK = 1 << 11
#: Points are multiples of 2**-48; STEP is 2**48 / golden ratio, made odd.
BITS = 48
STEP = 173961102589771
#: Points are looked up in so many cells of the unit interval.
CELLS = 12
WORD = r"[^\x20\x09-\x0D]+"
WORD_SIZE = f"coalesce(regexp_count(text, '{WORD}'), 0)".replace("\\", "\\\\")


def source_key() -> Column:
    """Sources in code-point order, null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("t"))


def targets(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """sizes (skey, size) -> skey, source_size, target, lo, hi (its part of [0, 2**BITS)), slots (of all sources).

    Target is min(3 * size, level * weight) at the level where the targets sum to the total;
    the level is found over one row per source.
    """
    by = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    # Rows below are one per source: the windows without a key see no documents.
    order = Window.orderBy("skey")
    w = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    by = by.withColumn("weight", w.cast("double")).withColumn("cap", (F.col("source_size") * MAX_REPEATS).cast("double"))
    all_rows = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("ratio", "skey").rowsBetween(Window.unboundedPreceding, 0)
    by = by.withColumn("ratio", F.col("cap") / F.col("weight"))
    before_cap, before_w = F.sum("cap").over(upto) - F.col("cap"), F.sum("weight").over(upto) - F.col("weight")
    by = by.withColumn("total", F.sum("source_size").over(all_rows)).withColumn("all_w", F.sum("weight").over(all_rows))
    by = by.withColumn("level", (F.col("total") - before_cap) / (F.col("all_w") - before_w))
    # The first source whose cap lies above the level reached there fixes the level for all after it.
    by = by.withColumn("final", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "skey", "level"))).over(all_rows)["level"])
    by = by.withColumn("target", F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    edge = lambda c: F.floor(F.lit(float(1 << BITS)) * F.coalesce(c / F.col("total"), F.lit(0.0)))
    by = by.withColumn("hi", edge(F.sum("target").over(upto))).withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0).cast("long")))
    # Rounding may leave the last edge short of the whole, or past it.
    last = F.row_number().over(Window.orderBy(F.col("skey").desc())) == 1
    by = by.withColumn("hi", F.when(last & (F.col("total") > 0), F.lit(1 << BITS)).otherwise(F.least("hi", F.lit(1 << BITS))))
    return by.select("skey", "source_size", "target", "lo", "hi", F.ceil(F.col("total") / block).alias("slots"))


def _point(slot: str) -> str:
    """(slot * STEP) mod 2**BITS, in limbs of 14 bits, so that no product leaves 64 bits."""
    limbs = (f"(((({slot} >> {k}) & 16383) * {STEP}L & {(1 << (BITS - k)) - 1}L) << {k})" for k in range(0, BITS, 14))
    return f"(({' + '.join(limbs)}) & {(1 << BITS) - 1}L)"


def _earlier(counts: DataFrame) -> DataFrame:
    """counts (skey, chunk, n) -> skey, chunk, first: the sum of n over earlier chunks, by groups of chunks."""
    counts = counts.withColumn("group", F.expr(f"chunk div {CHUNK}"))
    before = lambda keys, by: Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("skey", "group").agg(F.sum("n").alias("n"))
    groups = groups.select("skey", "group", F.coalesce(F.sum("n").over(before(["skey"], "group")), F.lit(0)).alias("base"))
    inside = counts.withColumn("at", F.coalesce(F.sum("n").over(before(["skey", "group"], "chunk")), F.lit(0)))
    return inside.join(groups, ["skey", "group"]).select("skey", "chunk", (F.col("base") + F.col("at")).alias("first"))


def schedule(spark, plan: DataFrame) -> DataFrame:
    """slot, skey, rank (of the slot in its source): which source each slot draws from."""
    n = int(plan.agg(F.max("slots").alias("n")).first()["n"] or 0)
    slots = spark.range(n).select(F.col("id").alias("slot"), F.expr(_point("id")).alias("u"))
    # Sources and points meet in cells of the interval, so no pair outside a cell is made.
    cells = plan.where("hi > lo").select("skey", "lo", "hi", F.explode(F.sequence(F.expr(f"lo >> {BITS - CELLS}"), F.expr(f"(hi - 1) >> {BITS - CELLS}"))).alias("cell"))
    drawn = slots.withColumn("cell", F.expr(f"u >> {BITS - CELLS}")).join(sized(materialize(cells, "mix-cells"), 64), "cell").where("u >= lo and u < hi")
    drawn = drawn.select("slot", "skey", F.expr(f"slot div {CHUNK}").alias("chunk"))
    first = _earlier(drawn.groupBy("skey", "chunk").agg(F.count("*").alias("n")))
    own = Window.partitionBy("skey", "chunk").orderBy("slot")
    drawn = drawn.withColumn("at", F.row_number().over(own))
    return drawn.join(first, ["skey", "chunk"]).select("slot", "skey", (F.col("first") + F.col("at") - 1).alias("rank"))


def hash_order(key: Column) -> Column:
    """52 bits of an MD5 as a long: the shuffled order of documents."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def laid_out(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """doc_id, skey, size, start: where each document begins in its source's shuffled row of words."""
    key = F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    rows = docs.select("doc_id", source_key().alias("skey"), F.expr(WORD_SIZE).cast("long").alias("size"), hash_order(key).alias("h"))
    rows = rows.withColumn("bin", F.expr(f"h div {(1 << 52) // BINS}L"))
    rows = materialize(rows, "mix-sizes")
    sums = rows.groupBy("skey", "bin").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("skey").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("skey", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("skey", "bin").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return rows.join(first, ["skey", "bin"]).select("doc_id", "skey", "size", (F.col("first") + F.col("start")).alias("start"))


def mix(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document and slot that takes words of it (slot null where none does):
    doc_id, skey, size, start, source_size, target, slots, slot, epoch, word_lo, word_hi."""
    laid = materialize(laid_out(docs), "mix-laid")
    plan = materialize(targets(laid, block), "mix-plan")
    slots = materialize(schedule(docs.sparkSession, plan), "mix-slots")
    drawn = materialize(slots.groupBy("skey").agg(F.count("*").alias("drawn")), "mix-drawn")
    # A source's words end where its slots do.
    ends = plan.join(drawn, "skey", "left").withColumn("stop", F.least(F.coalesce("drawn", F.lit(0)) * block, F.col("source_size") * MAX_REPEATS)).drop("drawn", "lo", "hi")
    rows = laid.join(sized(materialize(ends, "mix-ends"), 64), "skey")
    turns = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1))).alias("epoch")).withColumn("lo", F.col("start") + F.col("epoch") * F.col("source_size"))
    turns = turns.where("lo < stop and size > 0")
    parts = turns.select("*", F.explode(F.expr(f"sequence(lo div {block}, (least(lo + size, stop) - 1) div {block})")).alias("rank"))
    cols = ["doc_id", "skey", "size", "start", "source_size", "target", "slots"]
    taken = parts.join(slots, ["skey", "rank"]).select(
        *cols, "slot", "epoch", F.greatest(F.col("rank") * block - F.col("lo"), F.lit(0)).alias("word_lo"),
        (F.least((F.col("rank") + 1) * block, "stop", F.col("lo") + F.col("size")) - F.col("lo")).alias("word_hi"),
    )
    none = rows.where("size = 0 or start >= stop").select(*cols, F.lit(None).cast("long").alias("slot"), F.lit(None).cast("int").alias("epoch"), F.lit(0).cast("long").alias("word_lo"), F.lit(0).cast("long").alias("word_hi"))
    return taken.unionByName(none)


def taken_words(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_slot, n_pieces: the mix summed per document.

    Documents of no size share a start, so their rows are kept as they are, not merged.
    """
    m = mix(docs, block)
    some = m.where("size > 0").groupBy("doc_id", "skey", "start", "size", "source_size", "target").agg(F.sum(F.col("word_hi") - F.col("word_lo")).alias("taken"), F.min("slot").alias("first_slot"), F.count("slot").alias("n_pieces"))
    zero = F.lit(0).cast("long")
    none = m.where("size = 0").select("*", zero.alias("taken"), F.lit(None).cast("long").alias("first_slot"), zero.alias("n_pieces"))
    cols = ["doc_id", "size", "source_size", "target", "taken", "first_slot", "n_pieces"]
    return some.select(*cols).unionByName(none.select(*cols))


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents as the mix takes them, in the order of their first slots: one row per document and turn, columns unchanged.

    A turn that its source's end cuts short (one document per source at most) keeps the words taken,
    up to the white space before the next one.
    """
    spans = mix(docs, block).where("slot is not null").groupBy("doc_id", "skey", "start", "size", "epoch", "slots").agg(F.max("word_hi").alias("words"), F.min("slot").alias("slot"))
    key = lambda skey, size: F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), size.cast("string"), skey)
    spans = spans.withColumn("key", key(F.col("skey"), F.col("size")))
    # Rows that nothing tells apart but their texts are dealt the turns of one another's places.
    spans = spans.withColumn("turn", F.row_number().over(Window.partitionBy("key", "epoch").orderBy("start")))
    s = spans.select("key", "turn", "words", "slot", "start", "slots")
    size = F.expr(WORD_SIZE).cast("long")
    # The documents' own columns stay in a struct, so that they may have any names.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), key(source_key(), size).alias("key"), size.alias("size"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("doc.text"))))
    # Equal numbers as a difference of 0: the join then needs no other partitioning than the window's.
    out = rows.join(s, "key").where("place - turn = 0")
    pieces = F.regexp_extract_all("doc.text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    some = F.array_join(F.slice(pieces, F.lit(1), F.col("words").cast("int")), "")
    whole = F.col("words") == F.col("size")
    made = {"text": F.when(whole, F.col("doc.text")).otherwise(some)}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(whole, F.col("doc.n_chars")).otherwise(F.char_length(some)).cast(docs.schema["n_chars"].dataType)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    new = F.struct(*((made[c] if c in made else F.col("doc")[c]).alias(c) for c in docs.columns)).alias("doc")
    out = out.select(new, "slot", "start", "slots")
    # Slots are of one size, so equal stretches of them make even partitions.
    out = out.repartitionById(parts, F.expr(f"cast(floor(slot / slots * {parts}) as int)")).sortWithinPartitions("slot", "start")
    return out.select("doc.*")
