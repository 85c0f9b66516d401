"""Schemas and column names."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

SIDES = ("database", "denovo")
KEYS = ("RAW_FILE", "SCAN_NUMBER")


def _schema(**fields) -> StructType:
    return StructType([StructField(k, t()) for k, t in fields.items()])


DATABASE_SEARCH = _schema(RAW_FILE=StringType, SCAN_NUMBER=LongType, MODIFIED_SEQUENCE=StringType, PRECURSOR_CHARGE=IntegerType, MASS=DoubleType, SCORE=DoubleType, SEQUENCE=StringType, num_missed_cleavages=IntegerType, REVERSE=BooleanType)
DENOVO_SEARCH = _schema(RAW_FILE=StringType, SCAN_NUMBER=LongType, MODIFIED_SEQUENCE=StringType, PRECURSOR_CHARGE=IntegerType, MASS=DoubleType, SCORE=DoubleType, REVERSE=BooleanType, SEQUENCE=StringType, AA_SCORE=StringType)
SEARCH = {"database": DATABASE_SEARCH, "denovo": DENOVO_SEARCH}
SCORER = StructType([StructField("PSMId", StringType()), *(StructField(c, DoubleType()) for c in ("score", "q-value", "posterior_error_prob"))])

#: Column order of the accept/reject lists and of the divergence summary.
LIST_COLUMNS = ["SpecId", "RAW_FILE", "SCAN_NUMBER", "ISO_scores_database", "ISO_scores_denovo", "TP_GOODNESS_database", "TP_GOODNESS_denovo", "CASANOVO_SCORE", "DATABASE_SCORE", "PERCOLATOR_SCORE_DATABASE", "DETECTION_LEVEL", "SEQUENCE", "CASANOVO_AA_SCORE", "CALL_database", "CALL_denovo"]
DENOVO_LIST_COLUMNS = ["SpecId", "RAW_FILE", "SCAN_NUMBER", "ISO_scores", "TP_GOODNESS", "CASANOVO_SCORE", "SEQUENCE", "CASANOVO_AA_SCORE"]
SUMMARY_COLUMNS = ["comparison", "n_reference", "n_other", "statistic_D", "pvalue", "statistic_location", "cutoff_iso_scores"]
