"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, compression, huffman, jaccard, licenses, manifest, mix, packing, periodic, quality, repeats, shards, sketch
from .common import table, tokenizer_path
from .oracles import ORACLES


def op1_sections(docs: DataFrame) -> DataFrame:
    """Token counts of sections of 1000 characters; a null or empty text has one empty section.  Other columns take no part."""
    spans = F.expr("transform(sequence(0, greatest(char_length(text), 1) - 1, 1000), x -> struct(cast(x as long) as lo, cast(x + 1000 as long) as hi))")
    return attribution.attribute(docs.select("doc_id", "text", spans.alias("sections")), tokenizer_path("byte_bpe_50k.json"), "sections")


def op1_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_sections(table(spark, sf_dir, "documents"))


def op2_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = huffman.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 2)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op3_drr_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", F.expr("substr(queue, 2)").alias("source"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.stored_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return led.select("*", (~quality.passes("base-1")).alias("base_failed"), quality.passes("strict-1").alias("kept"))


def ledger_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the strict policy rejects, alone and with others, over all documents."""
    return quality.ablation(quality.stored_ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), "strict-1")


def web_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every rule of the library."""
    return quality.ablation(quality.stored_ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), "web-1")


def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited_pairs(table(spark, sf_dir, "documents"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op6 compares, without its sketches: the length of every text and the digest of its edited text."""
    return sketch.edited_texts(table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


def op7_golden_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.taken_words(table(spark, sf_dir, "documents"))


def op8_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = shards.tree(2, 3, 4)
    return shards.assign(table(spark, sf_dir, "documents"), leaves, shards.grown(leaves))


def op10_toccurrence_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(table(spark, sf_dir, "documents"))


def op11_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text: one document in ten (by the checksum of its id) repeats the words from some place on; the others as they are."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.expr("h % 10 = 0"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, null)").cast("int")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int"))
    turns = "flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int)))"
    return rows.select("doc_id", F.expr(f"if(n > 0, array_join(slice(concat(slice(words, 1, a), {turns}), 1, n), ' '), text)").alias("text"))


def op11_of(docs: DataFrame) -> DataFrame:
    found = periodic.runs(op11_texts(docs))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_of(table(spark, sf_dir, "documents"))


def op12_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = compression.fit(docs, labels.where(~compression.held_out()))
    rows = compression.scored(docs.select("doc_id", "text"), model).select("doc.doc_id", "score")
    return rows.select("doc_id", compression.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_of(docs: DataFrame) -> DataFrame:
    """The manifest, and what comes of it where one document in seven (by the checksum of its id) has one more in n_chars."""
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    changed = manifest.leaf([more.get(f, F.col(f)) for f in manifest.FIELDS])
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proofs = manifest.manifest(docs, carry={"tampered": F.when(picked, changed)})
    proofs = proofs.withColumn("folded_root", manifest.folded(F.coalesce("tampered", "leaf")))
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_of(table(spark, sf_dir, "documents"))


def queries() -> dict:
    named = {name: f for name, f in sorted(globals().items()) if name.startswith("op") and name[2].isdigit() and name not in ("op1_sections", "op11_texts", "op11_of", "op12_of", "op13_of")}
    return named | {"ledger_ablation": ledger_ablation, "web_ablation": web_ablation, "edited_texts": edited_texts}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
