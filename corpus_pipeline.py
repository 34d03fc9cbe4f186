"""The corpus pipeline: from documents to packed token sequences, one written table for each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesloom.llm import mixing, near_dup, packing, quality, templates
from salesloom.llm.queries import tokenizer_file
from salesloom.llm.store import ship, staged, table

WIDTH = 5  # words of a shingle in near dedup; query op4 takes two


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines are taken out; documents that fail the base rules or lose too much text go."""
    ship(spark)
    return quality.clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for the first; so do documents that hold nothing else."""
    ship(spark)
    return templates.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near copies stays; rows without doc_id stay."""
    ship(spark)
    found = near_dup.near_duplicates(docs, width=WIDTH)
    gone = found.filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(staged(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that is taken twice has two rows."""
    ship(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack)]

# Sketches, hashed shuffles and the tokenizer have no counterpart in SQL; the tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
