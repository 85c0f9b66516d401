"""Scan tables kept up to date while search results arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import equal
from ..functions.residues import tier
from ..schemas import SEARCH


def stream_search(spark: SparkSession, path: str, side: str) -> DataFrame:
    """New search files of a folder, as a stream with the branch's schema."""
    return spark.readStream.schema(SEARCH[side]).option("header", True).option("enforceSchema", False).csv(path)


def graded(matches: DataFrame) -> DataFrame:
    """Match flag, edit distance and tier of rows that hold both sides' peptides; stateless, so it runs on streams and tables alike."""
    a, b = F.col("SEQUENCE_database"), F.col("SEQUENCE_denovo")
    distance = F.levenshtein(a, b)
    return matches.withColumns({"unmodified_sequence_match": equal(a, b), "PSA_LEVENSHTEIN": distance.cast("double"), "tier": tier(distance)})


def join_branches(database: DataFrame, denovo: DataFrame, time: str, within: str = "10 minutes") -> DataFrame:
    """Shared scans of two streams that carry an event time; state is dropped once rows are older than the watermark."""
    left = database.withWatermark(time, within).select("RAW_FILE", "SCAN_NUMBER", F.col("SEQUENCE").alias("SEQUENCE_database"), F.col(time).alias("__t1"))
    right = denovo.withWatermark(time, within).select(F.col("RAW_FILE").alias("__raw"), F.col("SCAN_NUMBER").alias("__scan"), F.col("SEQUENCE").alias("SEQUENCE_denovo"), F.col(time).alias("__t2"))
    near = (F.col("__t1") >= F.col("__t2") - F.expr(f"interval {within}")) & (F.col("__t1") <= F.col("__t2") + F.expr(f"interval {within}"))
    joined = left.join(right, (F.col("RAW_FILE") == F.col("__raw")) & (F.col("SCAN_NUMBER") == F.col("__scan")) & near)
    return graded(joined.drop("__raw", "__scan", "__t1", "__t2"))
