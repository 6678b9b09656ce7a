"""A training corpus from the documents table: five stages, each on all that the one before kept.

Every stage is f(spark, docs, sf_dir) -> DataFrame; run() writes each result as Parquet in
the shared folder and reads it back as the next stage's docs.  All stages but the last
return the columns of documents.

Edge cases, in every stage: rows are taken one by one, so null and repeated ids and repeated rows are
rows of their own, except that near copies and suffix dedup go by id (rows that repeat an id are one
document there, and a null id is never a copy and neither loses nor lends bytes).  A null or empty text
fails the first stage's rules, has no shingles and no bytes, is never taken by the mix, and is
its end id alone when packed.  Further columns are carried to the mix and may have any names, those of the
stages' own measurements too.  An empty table passes through all stages and gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmill.llm import jaccard, mix, packing, quality, repeats
from sparkmill.llm.common import materialize, table, tokenizer_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the strict policy rejects go: too few words, repeats, symbols, odd word lengths, shouting."""
    return quality.keep_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked at 0.8 on five-word shingles the least doc_id stays; texts without words stay."""
    return jaccard.one_of_each(docs)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that a document of a smaller id has are cut from the texts, whole characters at a time."""
    return repeats.cleaned(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in the order of the schedule's slots: a document comes once per turn that the mix takes it."""
    return mix.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, the sources in proportion in every window."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 1)


STAGES = [("quality rules", rules), ("near copies", near_copies), ("suffix dedup", repeats_out), ("mix", mixed), ("pack", packed)]

#: Tokens and shingle searches are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
