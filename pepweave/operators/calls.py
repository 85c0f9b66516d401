"""Accept/reject calls and the lists made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import SCORE_NAMES, call, detection_level, residue_scores
from ..plans.session import staged
from ..schemas import DENOVO_LIST_COLUMNS, LIST_COLUMNS, SIDES


def ranked(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("TP_GOODNESS").desc_nulls_last(), "RAW_FILE", "SCAN_NUMBER", "SpecId")


def with_rank(df: DataFrame) -> DataFrame:
    """df with rank, from 1 in the lists' order: rows are sorted by ranges, places within them are topped up with the counts of the ranges before."""
    rows = staged(ranked(df).withColumn("__at", F.monotonically_increasing_id()), "ranked").withColumn("__range", F.shiftright("__at", 33))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("__range").agg(F.count("*").alias("__n"))  # a row a range
    ranges = ranges.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(ranges), "__range").withColumn("rank", F.col("__before") + place + 1).drop("__at", "__range", "__before")


def detection_counts(scans: DataFrame) -> DataFrame:
    """Matches found by both branches alike, and by either; a shared scan with different peptides counts for each."""
    level = detection_level()
    conflict = (level == "shared") & ~F.col("sequence_match")
    return scans.agg(
        F.count_if((level == "shared") & F.col("sequence_match")).alias("shared"),
        F.count_if((level == "database") | conflict).alias("database"),
        F.count_if((level == "denovo") | conflict).alias("denovo"),
    )


def call_lists(scans: DataFrame, cutoffs: dict[str, float]) -> DataFrame:
    """The lists' columns with CALL and TP_GOODNESS of the row's primary side, which is de novo only where nothing else is."""
    df = scans.withColumns({"DETECTION_LEVEL": detection_level(), "SEQUENCE": F.coalesce("SEQUENCE_denovo", "SEQUENCE_database"), "CASANOVO_AA_SCORE": residue_scores(F.col("AA_SCORE_denovo"))})
    df = df.withColumnsRenamed(SCORE_NAMES).withColumns({f"CALL_{s}": call(F.col(f"ISO_scores_{s}"), F.lit(cutoffs[s])) for s in SIDES})

    def primary(name: str):
        return F.when(F.col("DETECTION_LEVEL") == "denovo", F.col(f"{name}_denovo")).otherwise(F.col(f"{name}_database"))

    return df.select(*LIST_COLUMNS, primary("TP_GOODNESS").alias("TP_GOODNESS"), primary("CALL").alias("CALL"))


def denovo_call_lists(scans: DataFrame, cutoff: float) -> DataFrame:
    """De novo only: the lists' columns with CALL."""
    df = scans.select("SpecId", "RAW_FILE", "SCAN_NUMBER", F.col("ISO_scores_denovo").alias("ISO_scores"), F.col("TP_GOODNESS_denovo").alias("TP_GOODNESS"), F.col("SCORE_denovo").alias("CASANOVO_SCORE"), F.col("SEQUENCE_denovo").alias("SEQUENCE"), residue_scores(F.col("AA_SCORE_denovo")).alias("CASANOVO_AA_SCORE"))
    return df.select(*DENOVO_LIST_COLUMNS, call(F.col("ISO_scores"), F.lit(cutoff)).alias("CALL"))
