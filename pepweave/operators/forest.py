"""Seeded isolation-forest ensembles (M1-M7): training sets, growth, scoring, global rescaling.

Growth is a task for each group of trees over a bounded, hash-chosen sample of the training rows; a tree is a row of packed nodes, which the
driver only puts one after another.
Standardisation and the cut are taken over the whole training set, which executors score.
Scoring is an Arrow function over a broadcast model, whose size is fixed by the ensemble's shape; each distinct vector is scored once.
Vectors are sorted for it: for those that differ in one feature only, all trees are one row of steps along that feature, where each is looked up (Runs).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import PERCENTILE, feature_vector, features_of, on_side, trusted_denovo, trusted_shared, unsuffixed
from ..schemas import KEYS, SIDES
from .ecdf import quantile as exact_quantile
from .ecdf import staged

#: Fixed values of the ensemble's shape.
SMALLEST, DETECTORS, TREES = 256, 8, 100
CONTAMINATION = 1e-9
SOURCES = ("percolator_percentile", "denovo_score")
#: Rows that trees draw from; a training set with more gives a hash-chosen sample of about so many, in which equal rows keep their share.
MAX_ROWS = 1 << 18
EULER = 0.5772156649015329
BLOCK = 8192  # rows that go down a tree at a time: their places and values stay in a core's cache
#: A tree is a row; its nodes are packed one after another as NODE.
TREE = "detector int, tree int, psi int, nodes binary"
#: lower: the child for values up to the threshold, the next node being the other one; leaves lead to themselves, as nothing is above their threshold.
LEAF = -1  # in place of a feature
WORTH = 2000  # nodes that are passed over, when trees are cut down, in the time in which a vector goes down all of them
NODE = np.dtype([("feature", "<i2"), ("lower", "<i4"), ("threshold", "<f8"), ("path", "<f4")])


class TooFewRows(ValueError):
    pass


def training_candidates(scans: DataFrame, source: str = SOURCES[0], threshold: float = 0.9) -> DataFrame:
    """Trusted rows with the columns of the side to learn from: the database side's, or for denovo_score the de novo side's."""
    if source not in SOURCES:
        raise ValueError(f"unknown training source {source!r}; known: {', '.join(SOURCES)}")
    side, rows = ("denovo", trusted_denovo(threshold)) if source == SOURCES[1] else ("database", trusted_shared())
    return scans.where(rows).select(*features_of(scans, side))


def training_set(candidates: DataFrame, source: str = SOURCES[0], quantile: float = PERCENTILE) -> DataFrame:
    """Without side suffixes; for the percentile source only rows strictly above that percentile of the scorer's score."""
    side = "denovo" if source == SOURCES[1] else "database"
    if source == SOURCES[0]:
        score = "percolator_score_database"
        cut = exact_quantile(candidates, score, quantile)
        candidates = candidates.where(F.col(score) > cut) if cut is not None else candidates.limit(0)
    return unsuffixed(candidates, side)


def detector_sizes(rows: int) -> list[int]:
    """Subsample sizes: doubling from the smallest, as long as they are below the number of rows."""
    sizes = []
    while len(sizes) < DETECTORS and SMALLEST << len(sizes) < rows:
        sizes.append(SMALLEST << len(sizes))
    if not sizes:
        raise TooFewRows(f"a forest needs more than {SMALLEST} training rows, there are {rows}")
    return sizes


def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2 * (np.log(m - 1) + EULER) - 2 * (m - 1) / m))


def grow(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One tree as NODE rows, siblings side by side; a leaf's path is its depth plus that of its rows."""
    limit: int = math.ceil(math.log2(max(len(x), 2)))
    paths = average_path(np.arange(len(x) + 1)).tolist()
    nodes: list[tuple[int, int, float, float]] = [(0, 0, math.inf, 0.0)]
    todo = [(x, 0, 0)]
    while todo:
        part, depth, me = todo.pop()
        spread: list[int] = []
        if depth < limit and len(part) > 1:
            low, high = np.minimum.reduce(part), np.maximum.reduce(part)
            spread = (high > low).nonzero()[0].tolist()
        if not spread:
            nodes[me] = (0, me, math.inf, depth + paths[len(part)])
            continue
        f = spread[int(rng.integers(0, len(spread)))]
        t = float(rng.uniform(low[f], high[f]))
        below = part[:, f] <= t
        nodes[me] = (f, len(nodes), t, 0.0)
        todo += [(part.compress(~below, 0), depth + 1, len(nodes) + 1), (part.compress(below, 0), depth + 1, len(nodes))]
        nodes += [(0, 0, math.inf, 0.0)] * 2
    return np.array(nodes, NODE)


@dataclass
class Forest:
    """Nodes of all trees (NODE, with children counted over all), each detector's roots and standardisation; score: higher is more unusual."""

    feature: np.ndarray
    lower: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    roots: list[np.ndarray]  # of each detector's trees
    psi: list[int]
    mean: np.ndarray
    std: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """rows x detectors scores in (0, 1]."""
        out = np.empty((len(x), len(self.psi)))
        ends = np.append(np.sort(np.concatenate(self.roots)), len(self.lower))
        for start in range(0, len(x), BLOCK):
            part = np.ascontiguousarray(x[start : start + BLOCK], float)
            n, flat = len(part), part.reshape(-1)
            base = np.arange(n, dtype=np.intp) * part.shape[1]
            at, place, value, limit, over, path = np.empty(n, np.intp), np.empty(n, np.intp), np.empty(n), np.empty(n), np.empty(n, bool), np.empty(n, np.float32)
            for d, (roots, psi) in enumerate(zip(self.roots, self.psi, strict=True)):
                total = np.zeros(n)
                for root in roots:
                    tree = slice(root, ends[np.searchsorted(ends, root, side="right")])
                    feature, lower, threshold = self.feature[tree].astype(np.intp), self.lower[tree].astype(np.intp) - root, self.threshold[tree]
                    at.fill(0)
                    for _ in range(math.ceil(math.log2(psi))):  # clip: all places are inside, and out is not copied
                        feature.take(at, out=place, mode="clip")
                        place += base
                        flat.take(place, out=value, mode="clip")
                        threshold.take(at, out=limit, mode="clip")
                        np.greater(value, limit, out=over)
                        lower.take(at, out=place, mode="clip")
                        np.add(place, over, out=at)
                    total += self.path[tree].take(at, out=path, mode="clip")
                out[start : start + n, d] = 2.0 ** (-total / len(roots) / float(average_path(psi)))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.combined(self.raw(x))

    def combined(self, raw: np.ndarray) -> np.ndarray:
        return ((raw - self.mean) / self.std).mean(1) if len(raw) else np.zeros(0)

    def order(self, width: int) -> list[int]:
        """Features by the nodes that ask for them, fewest first: those of few values come before those of many."""
        asks = np.bincount(self.feature[~np.isinf(self.threshold)], minlength=width)
        return np.argsort(asks, kind="stable").tolist()

    def trees(self) -> Trees:
        feature = np.where(np.isinf(self.threshold), LEAF, self.feature)
        return Trees(feature, self.lower, self.threshold, self.path, np.concatenate(self.roots), np.repeat(np.arange(len(self.psi)), list(map(len, self.roots))))


@dataclass
class Trees:
    """The nodes of all trees as a Forest has them, but that a leaf's feature is LEAF, and each tree's root and detector."""

    feature: np.ndarray
    lower: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    detector: np.ndarray

    def given(self, f: int, value: float) -> Trees:
        """The trees for vectors with that value of feature f: nodes that ask for it give way to the child that it leads to."""
        kept, lower, ends, level = [], [], 0, self.led(self.roots.copy(), f, value)
        while len(level):
            ends += len(level)
            inner = np.flatnonzero(self.feature[level] != LEAF)
            child = np.zeros(len(level), self.lower.dtype)
            child[inner] = np.arange(ends, ends + 2 * len(inner), 2)
            kept.append(level)
            lower.append(child)
            below = self.lower[level[inner]]
            level = self.led(np.stack([below, below + 1], 1).reshape(-1), f, value)
        every = np.concatenate(kept)
        return Trees(self.feature[every], np.concatenate(lower), self.threshold[every], self.path[every], np.arange(len(self.roots)), self.detector)

    def led(self, at: np.ndarray, f: int, value: float) -> np.ndarray:
        """Nodes in place of at: those below that the value leads to, where at asks for f."""
        on = np.flatnonzero(self.feature[at] == f)
        while len(on):
            here = at[on]
            at[on] = here = self.lower[here] + (value > self.threshold[here])
            on = on[self.feature[here] == f]
        return at

    def steps(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For trees that ask for one feature: each detector's thresholds in order, and its sum of paths for values up to the first, between two, and above the last.

        Paths are multiples of 2^-23, so their sums are exact, and those of walks down the trees."""
        at, of = self.roots, self.detector
        low, high = np.full(len(at), -math.inf), np.full(len(at), math.inf)
        ends, change, whose = [], [], []
        while len(at):  # a leaf holds for values above low and up to high
            leaf = self.feature[at] == LEAF
            path = self.path[at[leaf]].astype(float)
            ends += [low[leaf], high[leaf]]
            change += [path, -path]
            whose += [of[leaf], of[leaf]]
            at, of, low, high = at[~leaf], of[~leaf], low[~leaf], high[~leaf]
            t, below = self.threshold[at], self.lower[at]
            at, of, low, high = np.concatenate([below, below + 1]), np.concatenate([of, of]), np.concatenate([low, t]), np.concatenate([t, high])
        ends, change, whose = np.concatenate(ends), np.concatenate(change), np.concatenate(whose)
        out = []
        for d in range(int(self.detector.max()) + 1):
            mine = np.flatnonzero((whose == d) & (ends < math.inf))
            mine = mine[np.argsort(ends[mine])]
            first = int(np.searchsorted(ends[mine], -math.inf, side="right"))
            out.append((ends[mine[first:]], np.cumsum(change[mine])[first - 1 :]))
        return out


class Runs:
    """A forest's raw scores of vectors that come sorted by the features in its order, batch after batch.

    Vectors that only the last of these features tells apart are looked up in the steps of the trees given the others' values.
    Trees once given values are kept for the next vectors, which often share some. Rows too few for that go down the whole trees."""

    def __init__(self, forest: Forest, width: int):
        self.forest, self.by = forest, forest.order(width)
        #: For the first k features: the last one's place among the thresholds, the trees given all their values, the thresholds of the next.
        self.given = [(-1, whole := forest.trees(), self.marks(whole, 0))]
        self.steps: list[tuple[np.ndarray, np.ndarray]] | None = None

    def marks(self, trees: Trees, k: int) -> np.ndarray:
        """A value's place among them decides all that the trees ask of the k-th feature. The last one's are among the steps."""
        return np.unique(trees.threshold[trees.feature == self.by[k]]) if k < len(self.by) - 1 else np.zeros(0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        """rows x detectors scores in (0, 1], the same as the forest's."""
        out, rest = np.zeros((len(x), len(self.forest.psi))), np.zeros(len(x), bool)
        for start, end in self.left(x, 0, len(x), 0, out):
            rest[start:end] = True
        for d, (roots, psi) in enumerate(zip(self.forest.roots, self.forest.psi, strict=True)):
            out[:, d] = 2.0 ** (-out[:, d] / len(roots) / float(average_path(psi)))
        if rest.any():
            out[rest] = self.forest.raw(x[rest])
        return out

    def left(self, x: np.ndarray, start: int, end: int, k: int, out: np.ndarray) -> Iterator[tuple[int, int]]:
        """Writes the sums of paths of the rows from start to end, which are alike in the first k features; yields those too few for it."""
        _, trees, marks = self.given[k]
        value = x[start:end, self.by[k]]
        if k == len(self.by) - 1:
            if not self.steps and (end - start) * WORTH < len(trees.lower):
                yield start, end
                return
            self.steps = self.steps or trees.steps()
            for d, (thresholds, totals) in enumerate(self.steps):
                out[start:end, d] = totals[np.searchsorted(thresholds, value)]
            return
        place = np.searchsorted(marks, value)
        cuts = (1 + np.flatnonzero(place[1:] != place[:-1])).tolist()
        for a, b in zip([0, *cuts], [*cuts, end - start], strict=True):
            if len(self.given) == k + 1 or self.given[k + 1][0] != place[a]:
                if (b - a) * WORTH < len(trees.lower):
                    yield start + a, start + b
                    continue
                below = trees.given(self.by[k], value[a])
                self.given[k + 1 :] = [(place[a], below, self.marks(below, k + 1))]
                self.steps = None
            yield from self.left(x, start + a, start + b, k + 1, out)


def matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Columns of doubles without nulls as rows x columns."""
    return np.stack([batch[c].to_numpy() for c in names], 1)


def in_order(vectors: DataFrame, names: list[str], forest: Forest) -> DataFrame:
    """Sorted by the features (names) in the forest's order: tasks get ranges of about the same size."""
    spark = vectors.sparkSession
    width = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by = [names[k] for k in forest.order(len(names))]
    return vectors.repartitionByRange(width, *by).sortWithinPartitions(*by)


def fit(train: DataFrame, features: list[str], seed: int = 0, trees: int = TREES, max_rows: int = MAX_ROWS) -> tuple[DataFrame, Forest]:
    """Grow the ensemble; the same rows and seed give the same trees in whatever order rows come. Rows with a null feature are left out."""
    spark = train.sparkSession
    rows = train.select(*(F.col(f"`{f}`").cast("double").alias(f"f{k}") for k, f in enumerate(features))).where(" and ".join(f"f{k} is not null and not isnan(f{k})" for k in range(len(features))))
    width = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = rows.groupBy(*rows.columns).agg(F.count("*").alias("n")).repartition(width)
    distinct = staged(distinct, "training-rows")
    n = distinct.agg(F.sum("n")).first()[0] or 0
    sizes = detector_sizes(n)
    x = sample(distinct, features, seed, min(1.0, max_rows / n))
    shared = spark.sparkContext.broadcast(x)

    def build(batches):
        data = shared.value
        for pdf in batches:
            for k in pdf["id"]:
                detector, tree = divmod(int(k), trees)
                rng = np.random.default_rng([seed, detector, tree])
                psi = min(sizes[detector], len(data))
                nodes = grow(data[rng.choice(len(data), psi, replace=False)], rng)
                yield pd.DataFrame({"detector": [detector], "tree": [tree], "psi": [psi], "nodes": [nodes.tobytes()]})

    jobs = len(sizes) * trees
    nodes = staged(spark.range(0, jobs, 1, min(jobs, 4 * spark.sparkContext.defaultParallelism)).mapInPandas(build, TREE), "trees")
    shared.destroy()
    forest = load(nodes)
    scale(forest, distinct, n)
    return nodes, forest


def sample(distinct: DataFrame, features: list[str], seed: int, share: float) -> np.ndarray:
    """About that share of the training rows, in order. Of n equal rows, n times the share are kept, rounded up or down by a hash."""
    names = [f"f{k}" for k in range(len(features))]
    want, u = F.col("n") * share, F.pmod(F.xxhash64(F.lit(seed), *names), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(want) + (u < want - F.floor(want)).cast("long")
    rows = distinct.select(*names, copies.alias("copies")).where("copies > 0").toPandas()
    x = np.repeat(rows[names].to_numpy(float), rows["copies"].to_numpy(), axis=0)
    return x[np.lexsort(x.T[::-1])]


def scale(forest: Forest, distinct: DataFrame, n: int) -> None:
    """Sets the mean, std and cut of all n training rows. Sums are of whole numbers, so that the order of rows does not change them."""
    shared, kinds = distinct.sparkSession.sparkContext.broadcast(forest), range(len(forest.psi))
    names, columns = [c for c in distinct.columns if c != "n"], [f"raw{d}" for d in kinds]

    def run(batches):
        runs = Runs(shared.value, len(names))
        for batch in batches:
            raw = runs.raw(matrix(batch, names))
            yield pa.RecordBatch.from_arrays([*map(pa.array, np.ascontiguousarray(raw.T)), batch["n"]], [*columns, "n"])

    rows = staged(in_order(distinct, names, forest).mapInArrow(run, ", ".join([*(f"{c} double" for c in columns), "n long"])), "training-scores")
    shared.destroy()  # the driver holds a copy of all nodes for each broadcast

    def mean(of) -> np.ndarray:
        """Of values below 1 (1 counts as the next smaller one), in steps of 2^-60; both halves of their sums fit 2^33 rows."""
        parts = []
        for d in kinds:
            whole = F.least(F.rint(of(F.col(f"raw{d}"), d) * float(1 << 60)).cast("long"), F.lit((1 << 60) - 1))
            parts += [F.sum(F.shiftright(whole, 30) * F.col("n")), F.sum(whole.bitwiseAND((1 << 30) - 1) * F.col("n"))]
        sums = rows.agg(*parts).first()
        return np.array([((high << 30) + low) / (1 << 60) / n for high, low in zip(sums[::2], sums[1::2], strict=True)])

    forest.mean = mean(lambda v, d: v)
    forest.std = np.maximum(np.sqrt(mean(lambda v, d: (v - float(forest.mean[d])) ** 2)), 1e-12)
    scaled = replace(forest, **dict.fromkeys(NODE.names, np.zeros(0)), roots=[])

    # the quantile lies between the k-th and the next of the greatest; k is 2, and one more for each 10^9 rows
    at = (n - 1) * (1 - CONTAMINATION)
    k = n - math.floor(at)

    def greatest(batches):
        for batch in batches:
            s = scaled.combined(matrix(batch, columns))
            yield pa.RecordBatch.from_arrays([batch["n"], pa.array(s)], ["n", "s"]).take(pa.array(np.argsort(-s)[:k]))

    top = rows.mapInArrow(greatest, "n long, s double").orderBy(F.desc("s")).limit(k).collect()
    ends = np.cumsum([r.n for r in top])
    low, high = (top[int(np.searchsorted(ends, m))].s for m in (k, max(k - 1, 1)))
    forest.cut = low + (high - low) * (at - math.floor(at))


def load(nodes: DataFrame) -> Forest:
    """From the table of trees, at most DETECTORS * TREES of them: their bytes one after another."""
    trees = nodes.orderBy("detector", "tree").collect()
    parts = [np.frombuffer(t.nodes, NODE) for t in trees]
    first = np.cumsum([0, *map(len, parts)])
    every = {name: np.concatenate([p[name] for p in parts]) for name in NODE.names}
    for a, b in zip(first, first[1:], strict=False):
        every["lower"][a:b] += a
    detector = np.array([t.detector for t in trees])
    kinds = sorted(set(detector.tolist()))
    psi = {t.detector: t.psi for t in trees}
    return Forest(every["feature"], every["lower"], every["threshold"], every["path"], [first[:-1][detector == d] for d in kinds], [psi[d] for d in kinds], np.zeros(len(kinds)), np.ones(len(kinds)), math.inf)


def save(nodes: DataFrame, forest: Forest, path: str) -> None:
    spark = nodes.sparkSession
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(forest.mean.tolist(), forest.std.tolist(), forest.cut)], "mean array<double>, std array<double>, cut double").write.mode("overwrite").parquet(f"{path}/scale")


def restore(spark: SparkSession, path: str) -> Forest:
    forest = load(spark.read.parquet(f"{path}/nodes"))
    row = spark.read.parquet(f"{path}/scale").first()
    forest.mean, forest.std, forest.cut = np.array(row["mean"]), np.array(row["std"]), row["cut"]
    return forest


def score_vectors(vectors: DataFrame, forest: Forest) -> DataFrame:
    """Adds the score to a table of features, none of them null, which are its columns of doubles."""
    shared, names = vectors.sparkSession.sparkContext.broadcast(forest), [c for c, kind in vectors.dtypes if kind == "double"]

    def run(batches):
        runs = Runs(shared.value, len(names))
        for batch in batches:
            yield batch.append_column("score", pa.array(shared.value.combined(runs.raw(matrix(batch, names)))))

    return in_order(vectors, names, forest).mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in [*vectors.dtypes, ("score", "double")]))


def score_sides(scans: DataFrame, forest: Forest, features: list[str], sides: tuple[str, ...] = SIDES) -> DataFrame:
    """Adds ISO_labels_<side> and raw ISO_scores_<side>, for rows on the side with all features.

    A vector goes through hundreds of trees, so all sides' distinct ones are scored once, written, and joined. scans is read twice, so it had better be a table."""
    vectors = {s: F.when(on_side(s), feature_vector(scans, features, s)) for s in sides}
    names = [f"__f{k}" for k in range(len(features))]
    every = scans.select(F.explode(F.array(*(F.struct(v.alias("v"), *(F.lit(s == t).alias(t) for t in sides)) for s, v in vectors.items()))).alias("x")).where("x.v is not null")
    distinct = every.select(*(F.col("x.v")[k].alias(c) for k, c in enumerate(names)), *(f"x.{s}" for s in sides)).groupBy(*names).agg(*(F.max(s).alias(s) for s in sides))
    scored = staged(score_vectors(distinct, forest), "vector-scores")
    spread = [c for c in KEYS if c in scans.columns] or scans.columns
    for s in sides:
        found = scored.where(s).select(F.xxhash64(*names).alias("__hash"), *names, F.col("score").alias(f"ISO_scores_{s}"))
        own = {f"__own{c}": vectors[s][k] for k, c in enumerate(names)}
        # rows without a vector match nothing; another hash spreads them over the tasks
        scans = scans.withColumns({"__own": F.when(vectors[s].isNotNull(), F.xxhash64(*own.values())).otherwise(F.xxhash64(*spread))} | own)
        # one whole number as the only key is what a join sorts fastest by; that values are equal is asked of the few rows that share it
        same = [(F.col(f"__own{c}") <= F.col(c)) & (F.col(f"__own{c}") >= F.col(c)) for c in names]
        scans = scans.join(found, reduce(lambda a, b: a & b, same, F.col("__own") == F.col("__hash")), "left").drop("__own", "__hash", *own, *names)
        score = F.col(f"ISO_scores_{s}")
        scans = scans.withColumn(f"ISO_labels_{s}", F.when(score.isNotNull(), (score > forest.cut).cast("double")))
    return scans


def inverted(score: Column, low: float | None, high: float | None) -> Column:
    """1 for the most usual row, 0 for the least; 1 for all if they do not differ."""
    if low is None or high is None or high - low <= 0:
        return F.when(score.isNotNull(), F.lit(1.0))
    return 1 - (score - low) / (high - low)


def rescaled(scans: DataFrame, sides: tuple[str, ...] = SIDES) -> DataFrame:
    """All sides' scores on one scale from 0 to 1. Write the scored table first: this reads it twice."""
    cols = [f"ISO_scores_{s}" for s in sides]
    both = [f(c) for c in cols for f in (F.min, F.max)]
    r = scans.agg(*both).first()
    lows, highs = [v for v in r[::2] if v is not None], [v for v in r[1::2] if v is not None]
    low, high = (min(lows), max(highs)) if lows else (None, None)
    return scans.withColumns({c: inverted(F.col(c), low, high) for c in cols})


def weighted_score(features: Column, weights: list[float]) -> Column:
    """Static scoring: weights by position, a last weight beyond the features being the intercept."""
    w = F.array(*map(F.lit, weights))
    pairs = F.zip_with(features, F.slice(w, F.lit(1), F.size(features)), lambda x, y: x * y)
    intercept = F.when(F.size(w) > F.size(features), F.element_at(w, -1)).otherwise(F.lit(0.0))
    return F.aggregate(pairs, F.lit(0.0), lambda t, x: t + x) + intercept
