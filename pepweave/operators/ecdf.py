"""Empirical distribution functions and the two-sample Kolmogorov-Smirnov statistic.

Scores are grouped by value; running counts are taken within ranges of values and topped up with the totals of the ranges before,
so no task sees more than a range. Ranges come from approximate quantiles, as many a side as a shuffle has partitions (64 to 512).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.session import staged
from ..schemas import SIDES, SUMMARY_COLUMNS

RANGES = (64, 512)
EXACT_UP_TO = 10_000  # sizes of both samples up to which the p-value is exact


class EmptyPopulation(ValueError):
    pass


def ranged(values: DataFrame, group: str = "side", value: str = "v", ranges: int | None = None) -> DataFrame:
    """Adds __range, which ascends with the value within a group: as many ranges with about as many values each. values is read twice.

    The range is the number of cuts below the value, found by halving: a row looks at 10 of up to 511 cuts."""
    ranges = ranges or min(RANGES[1], max(RANGES[0], int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cuts = F.percentile_approx(value, [k / ranges for k in range(1, ranges)], F.lit(10 * ranges)).alias("__cuts")
    bounds = values.groupBy(group).agg(cuts)  # a row a group
    halves = [1 << k for k in reversed(range(max(1, (ranges - 1).bit_length())))]
    below = F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), lambda at, half: F.when(F.get("__cuts", at + half - 1) < F.col(value), at + half).otherwise(at))
    return values.join(F.broadcast(bounds), group).withColumn("__range", below).drop("__cuts")


def running_counts(values: DataFrame, counts: list[str], group: str = "side", value: str = "v", ranges: int | None = None) -> DataFrame:
    """values: one row for each group and value. Adds <count>_le, the sum of the count over values of the group up to this one, and <count>_all, over all of them.

    The distinct values are written once, as they are read for bounds, totals and sums; what they are made from is not read again."""
    binned = ranged(staged(values, "values"), group, value, ranges)
    totals = binned.groupBy(group, "__range").agg(*(F.sum(c).alias(f"__{c}") for c in counts))
    earlier, whole = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(group)
    sums = (x for c in counts for x in (F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__{c}_before"), F.sum(f"__{c}").over(whole).alias(f"{c}_all")))
    before = totals.select(group, "__range", *sums)
    upto = Window.partitionBy(group, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    out = binned.withColumns({f"{c}_le": F.sum(c).over(upto) for c in counts}).join(F.broadcast(before), [group, "__range"])  # at most `ranges` rows a group
    return out.withColumns({f"{c}_le": F.col(f"{c}_le") + F.col(f"__{c}_before") for c in counts}).drop("__range", *(f"__{c}_before" for c in counts))


def quantile(df: DataFrame, column: str, q: float) -> float | None:
    """The exact quantile with linear interpolation, from running counts of distinct values: no task holds them all. Nulls are left out."""
    values = df.where(F.col(column).isNotNull()).groupBy(F.lit("x").alias("side"), F.col(column).alias("v")).agg(F.count("*").alias("n"))
    values = staged(values, "distinct")
    n = values.agg(F.sum("n")).first()[0]
    if not n:
        return None
    at = (n - 1) * q
    low = math.floor(at)
    steps = running_counts(values, ["n"])
    a, b = steps.agg(*(F.min(F.when(F.col("n_le") > k, F.col("v"))) for k in (low, min(low + 1, n - 1)))).first()
    return a + (b - a) * (at - low)


def goodness(reference: DataFrame, scores: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    """For each distinct group and score, the share of the reference at or below it. Both: group, value; nulls are left out."""
    return goodness_of(marked(reference, scores, group, value), group, value)


def goodness_of(rows: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    """The same from rows with a, which counts in the reference, and b, which counts in the scores."""
    steps = running_counts(counted(rows, group, value), ["a"], group, value).where("b > 0 and a_all > 0")
    return steps.select(group, value, (F.col("a_le") / F.col("a_all")).alias("goodness"))


def marked(reference: DataFrame, other: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    """Rows of both, without nulls: a is 1 for the reference's and b for the others'."""
    both = ((df.select(group, value, F.lit(a).cast("long").alias("a"), F.lit(1 - a).cast("long").alias("b"))) for df, a in ((reference, 1), (other, 0)))
    return next(both).unionByName(next(both)).where(F.col(value).isNotNull())


def marked_scores(df: DataFrame, reference: dict, other: dict, prefix: str = "ISO_scores") -> DataFrame:
    """The same (side, v, a, b) of all sides' scores in a table, which is read once. reference, other: conditions by side; a score may be in neither."""
    held = F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{prefix}_{s}").alias("v"), reference[s].cast("long").alias("a"), other[s].cast("long").alias("b")) for s in reference))
    return df.select(F.explode(held).alias("x")).select("x.*").where("v is not null")


def counted(rows: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    return rows.groupBy(group, value).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def with_goodness(df: DataFrame, reference: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the goodness of a score column against reference (column v); null scores have none."""
    key = F.col(column).alias("v")
    found = goodness(reference.select(F.lit("x").alias("side"), "v"), df.select(F.lit("x").alias("side"), key)).select(F.col("v").alias("__v"), F.col("goodness").alias(name))
    return df.join(found, F.col(column) == F.col("__v"), "left").drop("__v")


def ks_table(reference: DataFrame, other: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    """For each group the statistic, where it is reached, and both sizes."""
    return ks_of(marked(reference, other, group, value), group, value)


def ks_of(rows: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    return ks_of_steps(running_counts(counted(rows, group, value), ["a", "b"], group, value), group, value)


def ks_of_steps(steps: DataFrame, group: str = "side", value: str = "v") -> DataFrame:
    """The same from running counts a_le of the reference and b_le of the others.

    The largest absolute difference of the two functions; of equal ones a positive, then one at a reference value, then the least value."""
    steps = steps.withColumnsRenamed({"a_all": "n_reference", "b_all": "n_other"}).where("(a > 0 or b > 0) and n_reference > 0 and n_other > 0")
    d = F.col("a_le") / F.col("n_reference") - F.col("b_le") / F.col("n_other")
    rank = F.struct(F.abs(d).alias("d"), F.when(d >= 0, 1).otherwise(0).alias("positive"), F.when(F.col("a") > 0, 1).otherwise(0).alias("own"), (-F.col(value)).alias("low"))
    best = steps.groupBy(group, "n_reference", "n_other").agg(F.max(rank).alias("best"))
    return best.select(group, "n_reference", "n_other", F.col("best.d").alias("statistic_D"), (-F.col("best.low")).alias("statistic_location"))


def graded(df: DataFrame, reference: dict, other: dict, prefix: str = "ISO_scores", name: str = "TP_GOODNESS") -> tuple[DataFrame, dict[str, dict]]:
    """df with each side's goodness, and ks_cutoffs of reference and other scores, from one running count of all sides.

    reference, other: conditions by side. df is read twice, once for the counts and once for the rows, so it had better be a table."""
    sides = list(reference)
    steps = staged(running_counts(counted(marked_scores(df, reference, other, prefix)), ["a", "b"]), "steps")
    for s in sides:
        share = F.when(F.col("a_all") > 0, F.col("a_le") / F.col("a_all"))
        own = steps.where(F.col("side") == s).select(F.col("v").alias("__v"), share.alias(f"{name}_{s}"))
        df = df.join(own, F.col(f"{prefix}_{s}") == F.col("__v"), "left").drop("__v")
    return df, cutoffs_of(ks_of_steps(steps), sides)


def ks_pvalue(d: float, n: int, m: int) -> float:
    """Two-sided: exact by counting lattice paths for small samples, else from Kolmogorov's limit."""
    if d <= 0:
        return 1.0
    if max(n, m) <= EXACT_UP_TO:
        inside, log_scale, bound = np.zeros(m + 1), 0.0, d - 1e-12
        j = np.arange(m + 1)
        inside[np.abs(j / m) < bound] = 1.0
        for i in range(1, n + 1):
            ok = np.abs(i / n - j / m) < bound
            if not ok.any():
                return 1.0
            lo, hi = int(ok.argmax()), len(ok) - int(ok[::-1].argmax())
            row = np.zeros(m + 1)
            row[lo:hi] = np.cumsum(inside[lo:hi])
            top = row.max()
            if top == 0:
                return 1.0
            inside, log_scale = row / top, log_scale + math.log(top)
        if inside[m] <= 0:
            return 1.0
        total = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
        return float(min(1.0, max(0.0, -math.expm1(math.log(inside[m]) + log_scale - total))))
    z = math.sqrt(n * m / (n + m)) * d
    if z < 0.2:
        return 1.0
    return float(min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101)))))


def side_scores(df: DataFrame, condition: dict, prefix: str = "ISO_scores") -> DataFrame:
    """(side, v) rows of both sides' non-null scores where the side's condition holds."""
    return marked_scores(df, condition, condition, prefix).where("a > 0").select("side", "v")  # df is read once


def ks_cutoffs(reference: DataFrame, other: DataFrame, names: dict[str, str] | None = None) -> dict[str, dict]:
    """Statistic, p-value and cutoff of each side; the driver gets a row a side. Raises where a population is empty."""
    return cutoffs_of(ks_table(reference, other), names or SIDES)


def cutoffs_of(table: DataFrame, sides=SIDES) -> dict[str, dict]:
    """From a table as of ks_table."""
    rows, out = {r.side: r for r in table.collect()}, {}
    for side in sides:
        if side not in rows:
            raise EmptyPopulation(f"no reference or no other scores on the {side} side")
        r = rows[side]
        out[side] = {"n_reference": r.n_reference, "n_other": r.n_other, "statistic_D": r.statistic_D, "pvalue": ks_pvalue(r.statistic_D, r.n_reference, r.n_other), "statistic_location": r.statistic_location}
    return out


def summary(spark, found: dict[str, dict], comparisons: dict[str, str]) -> DataFrame:
    """A row for each comparison, then one for each cutoff; columns that a row lacks are null."""
    rows = [(comparisons[s], v["n_reference"], v["n_other"], v["statistic_D"], v["pvalue"], v["statistic_location"]) for s, v in found.items()]
    tests = spark.createDataFrame(rows, "comparison string, n_reference long, n_other long, statistic_D double, pvalue double, statistic_location double")
    cuts = spark.createDataFrame([(f"cutoff_{s}", v["statistic_location"]) for s, v in found.items()], "comparison string, cutoff_iso_scores double")
    return tests.unionByName(cuts, allowMissingColumns=True).select(*SUMMARY_COLUMNS)
