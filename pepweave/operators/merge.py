"""Relational merges of a branch and of both branches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import spec_id, suffixed, with_match_flags, with_missing
from ..schemas import KEYS, SIDES
from ..sources.readers import number


def last_scores(scores: DataFrame) -> DataFrame:
    """One score per PSMId: a target's before a decoy's, then the highest of all columns, so that the choice is the same each time."""
    others = [c for c in scores.columns if c not in ("PSMId", "is_target")]
    best = F.max(F.struct("is_target", *(F.col(f"`{c}`") for c in others))).alias("best")  # nulls come last; pre-aggregated before the shuffle
    return scores.groupBy("PSMId").agg(best).select("PSMId", *(F.col(f"best.`{c}`").alias(c) for c in ("is_target", *others))).select(*scores.columns)


def merge_branch(search: DataFrame, features: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Search rows with features and score of the same SpecId; rows of either side stay, and many-to-many pairs do.

    Features of raw files without search results go first. A SpecId missing on both sides is equal to itself."""
    search = search.withColumn("SpecId", spec_id(F.col("RAW_FILE"), F.col("SCAN_NUMBER"), F.col("MODIFIED_SEQUENCE"), F.col("PRECURSOR_CHARGE")))
    if "RAW_FILE" in features.columns:
        names = search.select("RAW_FILE").where("RAW_FILE is not null").distinct()
        features = features.join(names, "RAW_FILE", "left_semi").drop("RAW_FILE")
    if scores is not None:
        one = last_scores(scores).select(F.col("PSMId").alias("__psm"), F.col("score").alias("percolator_score"))
        features = features.join(one, F.col("SpecId") == F.col("__psm"), "left").drop("__psm")
    clash = (set(search.columns) & set(features.columns)) - {"SpecId"}
    if clash:
        raise ValueError(f"both tables have columns {sorted(clash)}")
    right = features.withColumnRenamed("SpecId", "__id")
    out = search.join(right, F.col("SpecId").eqNullSafe(F.col("__id")), "full_outer")
    return out.withColumn("SpecId", F.coalesce("SpecId", "__id")).drop("__id")


def merge_scans(database: DataFrame, denovo: DataFrame) -> DataFrame:
    """Both branches by raw file and scan, null keys equal to each other, all pairs within a scan; _merge says where a row is from."""
    sides = [suffixed(df, s).withColumn(f"__has_{s}", F.lit(True)) for df, s in zip((database, denovo), SIDES, strict=True)]
    right = sides[1].withColumnsRenamed({k: f"__{k}" for k in KEYS})
    # scan numbers first: the join sorts by its first key most of the time, and few rows share one
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in reversed(KEYS)))
    out = sides[0].join(right, on, "full_outer")
    # the right keys stand where there is no left row; a left row's own null keys are equal to the right's anyway
    out = out.withColumns({k: F.coalesce(k, f"__{k}") for k in KEYS}).drop(*(f"__{k}" for k in KEYS))
    where = F.when(F.col("__has_database") & F.col("__has_denovo"), "shared").when(F.col("__has_database"), "database_only").otherwise("denovo_only")
    ids = [c for c in ("SpecId_database", "SpecId_denovo") if c in out.columns]
    out = out.withColumn("_merge", where).drop("__has_database", "__has_denovo")
    return out.withColumn("SpecId", F.coalesce(*ids)) if ids else out.withColumn("SpecId", F.lit(None).cast("string"))


def chimeric_scans(database: DataFrame) -> DataFrame:
    """Keys of scans with more than one database sequence. Two extremes tell whether there are two values, without a distinct count."""
    scan = number(F.col("SCAN_NUMBER"), "long")
    rows = database.select("RAW_FILE", scan.alias("SCAN_NUMBER"), "SEQUENCE").dropna()
    return rows.groupBy(*KEYS).agg(F.min("SEQUENCE").alias("lo"), F.max("SEQUENCE").alias("hi")).where("lo <> hi").select(*KEYS)


def scan_table(database: DataFrame, denovo: DataFrame) -> DataFrame:
    """The scan table: merged branches with chimeric and match flags, and the columns that later stages expect."""
    expected = {f"{c}_{s}": t for c, t in (("SEQUENCE", "string"), ("MODIFIED_SEQUENCE", "string"), ("PRECURSOR_CHARGE", "int")) for s in SIDES}
    merged = with_missing(merge_scans(database, denovo), expected)
    flagged = chimeric_scans(database).withColumn("chimeric", F.lit(True))
    merged = merged.join(flagged, list(KEYS), "left").withColumn("chimeric", F.coalesce("chimeric", F.lit(False)))
    return with_match_flags(merged)
