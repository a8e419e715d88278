"""A training corpus from raw documents: ``run`` applies ``STAGES`` in order.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet to the shared folder and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``; each works on all that
its predecessor kept.

1. quality rules: documents that fail the base rules or diverge from their
   language go;
2. line dedup: later repeats of runs of three lines, or of 20 words in fewer,
   are deleted, and documents of which no line is left go;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing sources to target weights: documents stay, repeat or go, whole, so
   that each source has its target's words to half a document per shard;
5. best-fit packing: the mix as pieces in sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm import jaccard, line_dedup, mixing, packing, quality_rules
from tapeworks.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.write_mix(docs, whole_texts=True)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]

# References are learned from the corpus on the way, and packing is a greedy
# walk: SQL can't express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table: pieces and their places in sequences."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
