"""Data behind the quality-control figures."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import on_side
from ..schemas import SIDES
from .calls import detection_counts
from .ecdf import marked, staged

#: Numbers of bins, the scorer's threshold, the hexagonal grid's width.
SCORE_BINS, SCORER_BINS, GRID_POINTS, HEX_WIDTH = 100, 120, 501, 90
SCORER_THRESHOLD = 0.0


def shared_overview(scans: DataFrame) -> DataFrame:
    """Shared scans, shared matches, and the share of shared matches on which both sides agree."""
    rows = scans.where("_merge = 'shared'").agg(F.count("*").alias("shared_scans"), F.count_if(F.col("sequence_match")).alias("shared_psms"))
    return rows.withColumn("agreement", F.when(F.col("shared_scans") > 0, F.col("shared_psms") / F.col("shared_scans")))


def integer_histogram(values: DataFrame, column: str, group: list[str] | None = None) -> DataFrame:
    """Counts of whole numbers; unit-width bins."""
    return values.where(F.col(column).isNotNull()).groupBy(*(group or []), F.round(column).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def levenshtein_histogram(scans: DataFrame) -> DataFrame:
    return integer_histogram(scans, "PSA_LEVENSHTEIN")


def length_density(scans: DataFrame, sides: tuple[str, ...] = SIDES) -> DataFrame:
    """For each side and peptide length the count, the density and the side's median length."""
    cols = [F.struct(F.lit(s).alias("side"), F.when(on_side(s), F.length(f"SEQUENCE_{s}")).alias("length")) for s in sides]
    rows = scans.select(F.explode(F.array(*cols)).alias("r")).select("r.*").where("length is not null")
    totals = rows.groupBy("side").agg(F.count("*").alias("total"), F.median("length").alias("median"))
    return rows.groupBy("side", "length").agg(F.count("*").alias("n")).join(F.broadcast(totals), "side").select("side", "length", "n", (F.col("n") / F.col("total")).alias("density"), "median")


def bin_of(value: Column, low: Column | float, high: Column | float, bins: int) -> Column:
    """0 to bins - 1, the last bin closed; null outside."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    k = F.when(high > low, F.floor((value - low) / (high - low) * bins)).otherwise(F.lit(0))
    return F.when((value >= low) & (value <= high), F.least(k, F.lit(bins - 1)).cast("int"))


def histogram(values: DataFrame, column: str, low, high, bins: int, group: list[str] | None = None) -> DataFrame:
    return values.withColumn("bin", bin_of(F.col(column), low, high, bins)).where("bin is not null").groupBy(*(group or []), "bin").agg(F.count("*").alias("n"))


def score_pairs(scans: DataFrame, side: str) -> DataFrame:
    """(iso, scorer, target) of the side's rows with both scores."""
    label = F.col("Label_database") == 1 if side == "database" and "Label_database" in scans.columns else F.lit(True)
    rows = scans.where(on_side(side)).select(F.col(f"ISO_scores_{side}").alias("iso"), F.col(f"percolator_score_{side}").alias("scorer"), F.coalesce(label, F.lit(False)).alias("target"))
    return rows.where("iso is not null and scorer is not null")


def quadrants(pairs: DataFrame, cutoff: float, threshold: float = SCORER_THRESHOLD) -> DataFrame:
    """Target and decoy counts above and below the cutoff and the scorer's threshold; all four quadrants in a row each."""
    name = F.concat(F.when(F.col("scorer") >= threshold, "top-").otherwise("bottom-"), F.when(F.col("iso") >= cutoff, "right").otherwise("left"))
    return pairs.groupBy(name.alias("quadrant")).agg(F.count_if("target").alias("target"), F.count_if(~F.col("target")).alias("decoy"))


def hexagons(pairs: DataFrame, width: int = HEX_WIDTH, x: str = "iso", y: str = "scorer", layer: str = "target") -> DataFrame:
    """Hexagonal density: for each layer and cell its centre, count and share of the layer. x runs from 0 to 1, y over its range.

    The cells are those of two rectangular lattices, each shifted by half a cell of the other; a point goes to the nearer centre."""
    extent = pairs.agg(F.min(y).alias("lo"), F.max(y).alias("hi"))
    height = int(width / math.sqrt(3))
    u = F.col(x) * width
    v = F.when(F.col("hi") > F.col("lo"), (F.col(y) - F.col("lo")) / (F.col("hi") - F.col("lo")) * height).otherwise(F.lit(0.0))
    rows = pairs.crossJoin(F.broadcast(extent)).withColumns({"u": u, "v": v})  # one row of extents
    rows = rows.withColumns({"i": F.bround("u"), "j": F.bround("v"), "p": F.floor("u"), "q": F.floor("v")})
    near = (F.pow(F.col("u") - F.col("i"), 2) + 3 * F.pow(F.col("v") - F.col("j"), 2)) < (F.pow(F.col("u") - F.col("p") - 0.5, 2) + 3 * F.pow(F.col("v") - F.col("q") - 0.5, 2))
    cx, cy = F.when(near, F.col("i")).otherwise(F.col("p") + 0.5), F.when(near, F.col("j")).otherwise(F.col("q") + 0.5)
    cells = rows.groupBy(F.col(layer).alias("layer"), cx.alias("cx"), cy.alias("cy")).agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    totals = pairs.groupBy(F.col(layer).alias("layer")).agg(F.count("*").alias("total"))
    return cells.join(F.broadcast(totals), "layer").select("layer", (F.col("cx") / width).alias("x"), (F.col("lo") + F.col("cy") / height * (F.col("hi") - F.col("lo"))).alias("y"), "n", (F.col("n") / F.col("total")).alias("weight"))


def ecdf_grid(reference: DataFrame, other: DataFrame, points: int = GRID_POINTS) -> DataFrame:
    """Both functions at evenly spaced points of [0, 1] for each side: side, v, reference, other. Both: side, v."""
    return ecdf_grid_of(marked(reference, other), points)


def ecdf_grid_of(rows: DataFrame, points: int = GRID_POINTS) -> DataFrame:
    """The same from rows (side, v, a, b) of both, which are read once: each counts at the first point that is not below it, and points add up."""
    v, last = F.col("v"), points - 1
    near = F.when(v <= 0, 0).when(v <= 1, F.ceil(v * last)).otherwise(points).cast("long")  # off by a rounding of the product at most
    at = F.when((near > 0) & (v <= (near - 1) / last), near - 1).when((near < points) & (v > near / last), near + 1).otherwise(near)
    counts = staged(rows.groupBy("side", at.alias("at")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "grid")  # at most points + 1 rows a side
    whole, upto = Window.partitionBy("side"), Window.partitionBy("side").orderBy("at")
    counts = counts.withColumns({f"{c}_all": F.sum(c).over(whole) for c in ("a", "b")}).where("a_all > 0 and b_all > 0")
    empty = counts.select("side", "a_all", "b_all").distinct().crossJoin(F.broadcast(rows.sparkSession.range(points).select(F.col("id").alias("at"))))
    both = counts.unionByName(empty.withColumns({c: F.lit(0).cast("long") for c in ("a", "b")}))
    steps = both.groupBy("side", "at", "a_all", "b_all").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    out = steps.withColumns({c: F.sum(c).over(upto) / F.col(f"{c}_all") for c in ("a", "b")}).where(F.col("at") < points)
    return out.select("side", (F.col("at") / last).alias("v"), F.col("a").alias("reference"), F.col("b").alias("other"))


def level_counts(scans: DataFrame) -> DataFrame:
    """detection_counts as rows: level, n."""
    return detection_counts(scans).unpivot([], ["shared", "database", "denovo"], "level", "n")


def all_plots(scans: DataFrame, cutoffs: dict[str, float], reference: DataFrame, other: DataFrame) -> dict[str, DataFrame]:
    """Data of all figures of a two-sided run, by name."""
    plots = {"shared_overview": shared_overview(scans), "levenshtein": levenshtein_histogram(scans), "peptide_length": length_density(scans), "ks_vs_tp": ecdf_grid(reference, other), "psm_overlap": level_counts(scans)}
    for s in SIDES:
        if f"percolator_score_{s}" in scans.columns:
            pairs = score_pairs(scans, s)
            low, high = F.col("lo"), F.col("hi")
            ranged = pairs.crossJoin(F.broadcast(pairs.agg(F.min("scorer").alias("lo"), F.max("scorer").alias("hi"))))
            plots |= {f"score_density_{s}": hexagons(pairs), f"score_quadrants_{s}": quadrants(pairs, cutoffs[s]), f"iso_histogram_{s}": histogram(pairs, "iso", 0.0, 1.0, SCORE_BINS, ["target"]), f"scorer_histogram_{s}": histogram(ranged, "scorer", low, high, SCORER_BINS, ["target"])}
    return plots


def denovo_plots(scans: DataFrame, reference: DataFrame, other: DataFrame) -> dict[str, DataFrame]:
    return {"peptide_length": length_density(scans, ("denovo",)), "ks_vs_tp": ecdf_grid(reference, other)}
