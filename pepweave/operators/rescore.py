"""Semi-supervised rescoring of matches against decoys (M8): what an external scorer would do, as Spark jobs.

A linear classifier learns to tell confident target matches from decoys: it starts from the single feature that accepts most targets at the
training rate, then takes the accepted targets as positives, decoys as negatives, and is fitted again, some times over. Rows are dealt to folds by
spectrum, and each fold is scored by a classifier that has not seen it; scores of folds are put on one scale, on which 0 is the least accepted
score and -1 the median decoy's. Of a spectrum's matches the best one stays (target-decoy competition), and q-values and error probabilities are
estimated from the decoys above a score.

Classifiers learn from a sample of about MAX_TRAIN rows, chosen by a hash; each fold's is one task. Everything else covers all rows: means and
spreads, scores, thresholds, competition and q-values, which are running counts within ranges of scores and a running minimum over them
from the other end, so that no task holds more than a range.

Defined cases: a missing feature counts as its mean, a constant one has no weight; rows without an id or label are left out; a match is a target if
its label is 1; of equal scores in a spectrum a decoy stays, then the least id; if no target is accepted, the start feature's best tenth of
targets are the positives; without targets or decoys to learn from, scores are 0; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ecdf import ranged, running_counts, staged

MAX_TRAIN = 100_000
FOLDS, ROUNDS = 3, 10
COSTS = (0.1, 1.0, 10.0)  # of a decoy on the wrong side; times RATIOS for a target
RATIOS = (0.3, 1.0, 3.0)
NOT_FEATURES = ("SpecId", "Label", "ScanNr", "ExpMass", "CalcMass", "Peptide", "Proteins", "RAW_FILE")
#: Fixed value: raw file and scan of a spectrum id.
SPECTRUM = r"^(.+?-\d+)-.+-\d+$"


def spectrum(spec_id: Column) -> Column:
    """What competes: matches of the same raw file and scan; an id of another form is alone."""
    found = F.regexp_extract(spec_id, SPECTRUM, 1)
    return F.when(found == "", spec_id).otherwise(found)


# q-values


def q_values(scores: DataFrame, group: str | None = None, extra: int = 1) -> DataFrame:
    """For each distinct score (of each group): targets and decoys at or above it, their rate (decoys + extra over targets, at most 1) and q_value.

    scores: score, is_target and the group. The q-value is the least rate at this score or a lower one.
    """
    key = group or "__all"
    rows = scores if group else scores.withColumn(key, F.lit(0))
    target = F.col("is_target").cast("long")
    counts = rows.where("score is not null").groupBy(key, (-F.col("score")).alias("v")).agg(F.sum(target).alias("t"), F.sum(1 - target).alias("d"))
    rate = F.least(F.lit(1.0), (F.col("d_le") + extra) / F.greatest("t_le", F.lit(1)))
    steps = running_counts(counts, ["t", "d"], key).withColumn("rate", rate)
    steps = ranged(staged(steps, "rates"), key)
    lows = steps.groupBy(key, "__range").agg(F.min("rate").alias("__low"))
    later = Window.partitionBy(key).orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select(key, "__range", F.min("__low").over(later).alias("__later"))
    onward = Window.partitionBy(key, "__range").orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, 0)
    out = steps.withColumn("q_value", F.min("rate").over(onward)).join(F.broadcast(lows), [key, "__range"])
    out = out.withColumns({"q_value": F.least("q_value", F.coalesce("__later", F.lit(1.0))), "score": -F.col("v")})
    return out.select(*([group] if group else []), "score", "t", "d", F.col("t_le").alias("targets"), F.col("d_le").alias("decoys"), "rate", "q_value")


def best_of_spectrum(matches: DataFrame) -> DataFrame:
    """Target-decoy competition: of the matches (SpecId, score, is_target) of a spectrum the best one. Pre-aggregated before it shuffles.

    A column spectrum, where there is one, is what spectrum() says of the ids."""
    rows = matches.where("score is not null and SpecId is not null")
    order = F.struct((-F.col("score")).alias("low"), F.col("is_target"), F.col("SpecId"))  # of equal scores a decoy, then the least id
    key = F.col("spectrum") if "spectrum" in matches.columns else spectrum(F.col("SpecId"))
    best = rows.groupBy(key.alias("__spectrum")).agg(F.min(order).alias("b"))
    return best.select("b.SpecId", (-F.col("b.low")).alias("score"), "b.is_target")


def error_probabilities(steps: DataFrame, bins: int = 256) -> list[tuple[float, float]]:
    """(least score, probability that a target there is wrong) by falling score: decoys over targets within ranges of scores, made monotone."""
    cuts = steps.agg(F.percentile_approx("score", [k / bins for k in range(1, bins)], F.lit(10 * bins))).first()[0]
    if not cuts:
        return []
    cuts = sorted(set(cuts))
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("score")))
    rows = sorted(steps.groupBy(at.alias("bin")).agg(F.sum("t").alias("t"), F.sum("d").alias("d"), F.min("score").alias("low")).collect(), key=lambda r: -r.bin)
    pools: list[list[float]] = []  # targets, decoys, lowest score; rates rise
    for r in rows:
        pools.append([r.t, r.d, r.low])
        while len(pools) > 1 and pools[-2][1] * max(pools[-1][0], 1e-9) >= pools[-1][1] * max(pools[-2][0], 1e-9):
            t, d, low = pools.pop()
            pools[-1] = [pools[-1][0] + t, pools[-1][1] + d, low]
    return [(low, min(1.0, d / t if t else 1.0)) for t, d, low in pools]


# learning, on arrays


def accepted(score: np.ndarray, target: np.ndarray, rate: float) -> np.ndarray:
    """Which targets are at or above the lowest score from which decoys over targets is at most the rate."""
    order = np.argsort(-score, kind="stable")
    s, t = score[order], np.cumsum(target[order])
    d = np.arange(1, len(s) + 1) - t
    last = np.append(s[1:] != s[:-1], True)  # of equal scores
    good = np.nonzero(last & (d <= rate * t) & (t > 0))[0]
    return target & (score >= s[good[-1]]) if len(good) else np.zeros(len(score), bool)


def separate(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights, the last one being the bias, that minimise |w|^2 / 2 and the costs times squared hinge losses, by Newton steps on the rows within the margin."""
    x = np.column_stack([x, np.ones(len(x))])
    w, inside = np.zeros(x.shape[1]), np.ones(len(x), bool)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        a = x[inside] * (2 * cost[inside])[:, None]
        w = np.linalg.solve(ridge + a.T @ x[inside], a.T @ y[inside])
        now = y * (x @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w


def learn(x: np.ndarray, target: np.ndarray, rate: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and bias from standardised features; the fit of each round is the one of a grid of costs that accepts most targets."""
    width = x.shape[1]
    w = np.zeros(width + 1)
    if not target.any() or target.all() or not width:
        return w
    starts = [(int(accepted(sign * x[:, k], target, rate).sum()), -k, sign) for k in range(width) for sign in (1, -1)]
    most, k, sign = max(starts)
    if not most:  # no feature accepts any: the one whose targets lie highest above its decoys
        gaps = x[target].mean(0) - x[~target].mean(0)
        k = -int(np.argmax(np.abs(gaps)))
        sign = 1 if gaps[-k] >= 0 else -1
    w[-k] = sign
    best, best_w = most, w
    for _ in range(rounds):
        score = x @ w[:-1] + w[-1]
        positive = accepted(score, target, rate)
        if not positive.any():
            positive = target & (score >= np.quantile(score[target], 0.9))
        used = positive | ~target
        y, n = np.where(positive, 1.0, -1.0)[used], max(1, int(used.sum()))
        found = []
        for c in COSTS:
            for ratio in RATIOS:
                new = separate(x[used], y, np.where(y > 0, c * ratio, c) * (1000 / n if n > 1000 else 1.0))
                found.append((int(accepted(x @ new[:-1] + new[-1], target, rate).sum()), -c, -ratio, new))
        got, *_, w = max(found, key=lambda f: f[:3])
        if got > best:
            best, best_w = got, w
    return best_w


# the whole


@dataclass
class Rescorer:
    names: list[str]
    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]  # of each fold, for standardised features, the bias last
    seed: int

    def raw(self, k: int) -> list[float]:
        """A fold's weights for features as they are."""
        w = self.weights[k][:-1] / self.spread
        return [*w.tolist(), float(self.weights[k][-1] - w @ self.mean)]

    def fold(self, spectrum: Column) -> Column:
        return _draw(spectrum, self.seed, "fold", len(self.weights)).cast("int")

    def score(self, fold: Column) -> Column:
        """The score of each row by its own fold's weights; a missing feature counts as its mean."""
        values = [F.coalesce(F.col(f"`{n}`").cast("double"), F.lit(float(m))) for n, m in zip(self.names, self.mean, strict=True)]
        out = None
        for k in range(len(self.weights)):
            raw = self.raw(k)
            total = F.lit(raw[-1])
            for v, w in zip(values, raw, strict=False):
                total = total + v * F.lit(w)
            out = F.when(fold == k, total) if out is None else out.when(fold == k, total)
        return out

    def lines(self) -> list[str]:
        """The weights file: a header, weights of standardised and of raw features, for each fold."""
        out = ["# first line contains normalized weights, second line the raw weights"]
        for k, w in enumerate(self.weights):
            out += ["\t".join([*self.names, "m0"]), "\t".join(f"{x:.10g}" for x in w), "\t".join(f"{x:.10g}" for x in self.raw(k))]
        return out


def _draw(spectrum: Column, seed: int, use: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(f"{use}:{seed}"), spectrum), F.lit(n))


def fit(features: DataFrame, rate: float = 0.01, seed: int = 1, max_train: int = MAX_TRAIN, folds: int = FOLDS, rounds: int = ROUNDS) -> Rescorer:
    """features: SpecId, Label (1: target) and numeric features."""
    names = [c for c in features.columns if c not in NOT_FEATURES]
    rows = features.where("SpecId is not null and Label is not null")
    if not names:
        raise ValueError("there is no feature to learn from")
    sums = rows.agg(F.count("*"), *(f(F.col(f"`{n}`").cast("double")) for n in names for f in (F.avg, F.stddev_pop))).first()
    n, mean, spread = sums[0], np.array([v or 0.0 for v in sums[1::2]]), np.array([v or 0.0 for v in sums[2::2]])
    model = Rescorer(names, mean, np.where(spread > 0, spread, np.inf), [np.zeros(len(names) + 1)] * folds, seed)
    if not n:
        model.spread = np.ones(len(names))
        return model
    rows = rows.withColumn("__spectrum", spectrum(F.col("SpecId")))
    chosen = _draw(F.col("__spectrum"), seed, "train", 1 << 30) < int(min(1.0, max_train / n) * (1 << 30))
    sample = rows.where(chosen).select((F.col("Label") == 1).alias("target"), model.fold(F.col("__spectrum")).alias("fold"), F.array(*(F.coalesce((F.col(f"`{c}`").cast("double") - float(m)) / float(s), F.lit(0.0)) for c, m, s in zip(names, model.mean, model.spread, strict=True))).alias("x"))
    models = F.filter(F.array(*map(F.lit, range(folds))), lambda k: k != F.col("fold"))

    def train(part: pd.DataFrame) -> pd.DataFrame:
        x, target = np.stack(part["x"].to_numpy()), part["target"].to_numpy(bool)
        order = np.lexsort([*x.T[::-1], target])  # whatever order rows come in
        return pd.DataFrame({"model": [int(part["model"].iloc[0])], "w": [learn(x[order], target[order], rate, rounds).tolist()]})

    learned = sample.withColumn("model", F.explode(models)).select("model", "target", "x").groupBy("model").applyInPandas(train, "model int, w array<double>")
    for r in learned.collect():
        model.weights[r.model] = np.array(r.w)
    return model


def on_one_scale(scored: DataFrame, rate: float = 0.01) -> DataFrame:
    """SpecId, fold, score, is_target (and spectrum) with the score of each fold such that 0 is its least accepted one and -1 its median decoy's."""
    steps = q_values(scored, "fold")
    ends = steps.groupBy("fold").agg(F.min(F.when(F.col("q_value") <= rate, F.col("score"))).alias("__cut"), F.max("score").alias("__top"))
    decoys = scored.where("not is_target").groupBy("fold").agg(F.percentile_approx("score", 0.5, 10_000).alias("__decoy"))
    ends = ends.join(decoys, "fold", "left").withColumn("__cut", F.coalesce("__cut", "__top"))  # a row a fold
    width = F.col("__cut") - F.col("__decoy")
    out = scored.join(F.broadcast(ends), "fold").withColumn("score", (F.col("score") - F.col("__cut")) / F.when(width > 0, width).otherwise(1.0))
    return out.drop("fold", "__cut", "__top", "__decoy")


def with_q_values(matches: DataFrame) -> DataFrame:
    """Scorer output of matches (SpecId, score, is_target): PSMId, score, q-value, posterior_error_prob and is_target of each spectrum's best match."""
    best = staged(best_of_spectrum(matches), "competed")
    steps = staged(q_values(best), "q-values")
    pools = error_probabilities(steps)
    wrong = F.lit(1.0)
    for low, p in reversed(pools):  # the first pool that reaches down to the score
        wrong = F.when(F.col("score") >= low, p).otherwise(wrong)
    found = best.join(steps.select(F.col("score").alias("__s"), "q_value"), F.col("score") == F.col("__s"))
    return found.select(F.col("SpecId").alias("PSMId"), "score", F.col("q_value").alias("q-value"), wrong.alias("posterior_error_prob"), "is_target")


def rescore(features: DataFrame, test_rate: float = 0.01, train_rate: float = 0.01, seed: int = 1, max_train: int = MAX_TRAIN) -> tuple[DataFrame, Rescorer]:
    """Scorer output for a feature table, and the classifiers."""
    model = fit(features, train_rate, seed, max_train)
    rows = features.where("SpecId is not null and Label is not null")
    rows = rows.withColumn("spectrum", spectrum(F.col("SpecId")))  # once a row: the pattern is dearer than the score
    rows = rows.withColumn("__fold", model.fold(F.col("spectrum")))
    scored = staged(rows.select("SpecId", "spectrum", F.col("__fold").alias("fold"), model.score(F.col("__fold")).alias("score"), (F.col("Label") == 1).alias("is_target")), "fold-scores")
    return with_q_values(on_one_scale(scored, test_rate)), model


def write_weights(spark: SparkSession, model: Rescorer, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(("\n".join(model.lines()) + "\n").encode()))
    out.close()
