"""A corpus pipeline of five operators: language ID, exact dedup, near dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of docs; columns named like an operator's own come through unchanged. Rows
with a null id or text are kept unless a stage has a reason against them: a text without a letter has no language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pepweave.llm import exact_dedup, jaccard_join, language_id, mixing, packing
from pepweave.llm.common import bounded_batches, in_fold, shielded, stage_table, table, without_ids


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those that language ID can't place (`und`) go."""
    bounded_batches(spark)
    rows, back = shielded(docs, language_id.OWN)
    model = language_id.fit(rows, ~in_fold(F.col("doc_id"), 4, 2))
    found = language_id.predict(rows, model).where(F.col("lang_pred") != language_id.UNKNOWN)
    return found.select(*rows.columns).withColumnsRenamed(back)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (up to A-Z case): the one with the largest id."""
    rows, back = shielded(docs, exact_dedup.OWN)
    return exact_dedup.exact_dedup(rows).where("kept").select(*rows.columns).withColumnsRenamed(back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more: the one with the smallest id."""
    bounded_batches(spark)
    groups = jaccard_join.jaccard_join(docs)
    return without_ids(docs, "doc_id", groups.where("component_id <> doc_id").select(F.col("doc_id").alias("id")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    rows, back = shielded(docs, mixing.OWN)
    return mixing.emit(mixing.mix_to_targets(rows)).select(*rows.columns).withColumnsRenamed(back)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of at most 1024 tokens."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model and a tokenizer are beyond SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
