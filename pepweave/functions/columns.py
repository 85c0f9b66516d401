"""Projections, derived columns and predicates of match tables."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYS, SIDES
from ..sources.readers import number

#: Score columns and their names in the lists.
SCORE_NAMES = {"SCORE_denovo": "CASANOVO_SCORE", "SCORE_database": "DATABASE_SCORE", "percolator_score_database": "PERCOLATOR_SCORE_DATABASE"}
PERCENTILE = 0.7
DENOVO_THRESHOLD = 0.9


class ColumnMismatch(ValueError):
    pass


def drop_columns(df: DataFrame, names: list[str] | str) -> DataFrame:
    """Drop the listed columns; those that are missing are ignored."""
    return df.drop(*(names.split() if isinstance(names, str) else names))


def require_same_columns(database: DataFrame, denovo: DataFrame) -> None:
    """Scorer weights apply by position, so both tables need the same columns in the same order."""
    a, b = database.columns, denovo.columns
    if a != b:
        raise ColumnMismatch(f"feature columns differ; database only: {sorted(set(a) - set(b))}, denovo only: {sorted(set(b) - set(a))}, same order: {sorted(a) == sorted(b) and a == b}")


def spec_id(raw_file: Column, scan: Column, sequence: Column, charge: Column) -> Column:
    """Null if any part is."""
    return F.concat(raw_file, F.lit("-"), scan.cast("long").cast("string"), F.lit("-"), sequence, F.lit("-"), charge.cast("int").cast("string"))


def suffixed(df: DataFrame, side: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{side}" for c in df.columns if c not in keys})


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds columns (name: type) that are missing as null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def equal(a: Column, b: Column) -> Column:
    """Equal and both present; never null."""
    return F.coalesce(a == b, F.lit(False))


def with_match_flags(df: DataFrame) -> DataFrame:
    """Whether both sides have the same residues, modified sequence, charge, and the last two together; false where a column is missing."""

    def same(name: str, make=lambda c: c) -> Column:
        pair = [f"{name}_{s}" for s in SIDES]
        return equal(*(make(F.col(c)) for c in pair)) if set(pair) <= set(df.columns) else F.lit(False)

    modified, charge = same("MODIFIED_SEQUENCE"), same("PRECURSOR_CHARGE", number)
    return df.withColumns({"unmodified_sequence_match": same("SEQUENCE"), "modified_sequence_match": modified, "precursor_charge_match": charge, "sequence_match": modified & charge})


def on_side(side: str) -> Column:
    return F.col("_merge").isin(f"{side}_only", "shared")


def only_on(side: str) -> Column:
    return F.col("_merge") == f"{side}_only"


def trusted_shared() -> Column:
    """Shared target matches that the database scorer likes."""
    return F.coalesce((F.col("_merge") == "shared") & (F.col("Label_database") == 1) & (F.col("percolator_score_database") > 0), F.lit(False))


def trusted_denovo(threshold: float = DENOVO_THRESHOLD) -> Column:
    return F.coalesce(on_side("denovo") & (number(F.col("SCORE_denovo")) >= threshold), F.lit(False))


def denovo_rest(threshold: float = DENOVO_THRESHOLD) -> Column:
    """The side's other rows, those without a score among them."""
    return on_side("denovo") & ~F.coalesce(number(F.col("SCORE_denovo")) >= threshold, F.lit(False))


def detection_level() -> Column:
    return F.regexp_replace("_merge", "_only$", "")


def shared_kind() -> Column:
    """identical, same_residues or different for shared rows; null for others."""
    return F.when(F.col("_merge") == "shared", F.when(F.col("sequence_match"), "identical").when(F.col("unmodified_sequence_match"), "same_residues").otherwise("different"))


def call(score: Column, cutoff: Column | float) -> Column:
    return F.when(score.isNotNull(), F.when(score >= cutoff, "GOOD").otherwise("BAD"))


def residue_scores(c: Column) -> Column:
    """Per-residue scores with commas instead of bars."""
    return F.replace(c, F.lit("|"), F.lit(","))


def features_of(df: DataFrame, side: str, base: tuple[str, ...] = (*KEYS, "_merge", "chimeric")) -> list[str]:
    """Columns of one side, without the tables' own."""
    return [c for c in df.columns if c.endswith(f"_{side}") and c not in base]


def unsuffixed(df: DataFrame, side: str) -> DataFrame:
    names = [c.replace(f"_{side}", "") for c in df.columns]
    twice = sorted(c for c, n in Counter(names).items() if n > 1)
    if twice:
        raise ColumnMismatch(f"columns {twice} would appear twice")
    return df.toDF(*names)


def feature_vector(df: DataFrame, features: list[str], side: str) -> Column:
    """The side's features as an array; null where any is."""
    missing = [f for f in features if f"{f}_{side}" not in df.columns]
    if missing:
        raise ColumnMismatch(f"features {missing} are missing on the {side} side")
    cols = [F.col(f"`{f}_{side}`").cast("double") for f in features]
    whole = F.lit(True)
    for c in cols:
        whole = whole & c.isNotNull() & ~F.isnan(c)
    return F.when(whole, F.array(*cols))
