"""Semi-supervised rescoring: q-values against brute force, planted matches under control of decoys, and the run without an external scorer."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from pepweave.operators import rescore
from pepweave.plans.pipeline import Pipeline
from pepweave.sources import readers
from tests.test_pipeline import branches, config  # noqa: F401


def q_by_hand(scores, target, extra=1):
    """q-value of each row: the least (decoys + extra) / targets at its score or a lower one."""
    rates = {s: min(1.0, (sum(1 for x, t in zip(scores, target) if x >= s and not t) + extra) / max(1, sum(1 for x, t in zip(scores, target) if x >= s and t))) for s in set(scores)}
    return {s: min(r for x, r in rates.items() if x <= s) for s in rates}


def test_q_values_against_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(k % 3, round(float(rng.normal() + (k % 2)), 1), bool(k % 2)) for k in range(900)] + [(0, None, True)]
    got = rescore.q_values(spark.createDataFrame(rows, "g int, score double, is_target boolean").repartition(5), "g").collect()
    for g in range(3):
        own = [(s, t) for k, s, t in rows if k == g and s is not None]
        want = q_by_hand(*zip(*own))
        assert {r.score: round(r.q_value, 12) for r in got if r.g == g} == {s: round(q, 12) for s, q in want.items()}
    assert rescore.q_values(spark.createDataFrame([], "score double, is_target boolean")).count() == 0


def test_competition_keeps_one_match_of_a_spectrum(spark):
    rows = [("r-1-AK-2", 1.0, True), ("r-1-BK-2", 2.0, True), ("r-2-AK-2", 1.0, True), ("r-2-ZK-2", 1.0, False), ("r-3-BK-2", 1.0, True), ("r-3-AK-2", 1.0, True), ("odd", 0.5, True), (None, 3.0, True), ("r-4-AK-2", None, True)]
    got = rescore.best_of_spectrum(spark.createDataFrame(rows, "SpecId string, score double, is_target boolean")).collect()
    assert {r.SpecId for r in got} == {"r-1-BK-2", "r-2-ZK-2", "r-3-AK-2", "odd"}


@pytest.mark.parametrize("rate", [0.01, 0.1])
def test_accepted_against_brute_force(rate):
    rng = np.random.default_rng(3)
    for _ in range(50):
        target = rng.random(60) < 0.7
        score = np.round(rng.normal(size=60) + 1.5 * target, 1)
        q = q_by_hand(score.tolist(), target.tolist(), 0)
        assert (rescore.accepted(score, target, rate) == (target & np.array([q[s] <= rate for s in score.tolist()]))).all()


def planted(spark, n=9000, seed=1):
    """Spectra of which a third hold a true target; only the sum of two features tells. Others hold a random target or decoy."""
    rng = np.random.default_rng(seed)
    rows, true = [], set()
    for k in range(n):
        real = k % 3 == 0
        label = 1 if real or rng.random() < 0.5 else -1
        x = rng.normal(size=4)
        if real:
            x[0] += 2.2
            x[1] += 2.2
        x[2] = x[0] * 0.3 + x[2]
        if k % 50 == 1:
            x[3] = np.nan
        sid = f"run-{k}-PEPTIDEK-2"
        if real:
            true.add(sid)
        rows.append((sid, label, *(None if np.isnan(v) else float(v) for v in x), 7.0))
    return spark.createDataFrame(rows, "SpecId string, Label int, a double, b double, c double, d double, same double").repartition(4), true


def test_planted_matches_are_found_and_decoys_control_the_rest(spark):
    features, true = planted(spark)
    out, model = rescore.rescore(features)
    rows = {r.PSMId: r for r in out.collect()}
    assert len(rows) == 9000
    good = [r for r in rows.values() if r.is_target and r["q-value"] <= 0.01]
    wrong = sum(r.PSMId not in true for r in good)
    assert wrong <= 0.02 * len(good), (wrong, len(good))
    alone = rescore.q_values(features.select(F.col("a").alias("score"), (F.col("Label") == 1).alias("is_target"))).where("q_value <= 0.01").agg(F.sum("t")).first()[0] or 0
    assert len(good) > 1.3 * alone and len(good) > 0.5 * len(true)
    assert all(r.score >= -0.2 for r in good)  # 0 is the least accepted score of each fold
    by_score = sorted(rows.values(), key=lambda r: -r.score)
    assert all(a["q-value"] <= b["q-value"] and a.posterior_error_prob <= b.posterior_error_prob for a, b in zip(by_score, by_score[1:]))
    again, _ = rescore.rescore(features.repartition(7))
    assert {r.PSMId: round(r.score, 9) for r in again.collect()} == {k: round(r.score, 9) for k, r in rows.items()}


def test_matches_without_signal_are_not_accepted(spark):
    rng = np.random.default_rng(8)
    rows = [(f"r-{k}-AK-2", 1 if k % 2 else -1, *map(float, rng.normal(size=3))) for k in range(3000)]
    out, _ = rescore.rescore(spark.createDataFrame(rows, "SpecId string, Label int, a double, b double, c double"))
    assert out.where("is_target and `q-value` <= 0.01").count() <= 15


def test_small_and_one_sided_tables(spark):
    empty = spark.createDataFrame([], "SpecId string, Label int, a double")
    assert rescore.rescore(empty)[0].count() == 0
    one = spark.createDataFrame([("r-1-AK-2", 1, 0.5), ("r-2-AK-2", 1, None), (None, 1, 1.0), ("r-3-AK-2", None, 1.0)], "SpecId string, Label int, a double")
    assert {r.score for r in rescore.rescore(one)[0].collect()} == {0.0}
    with pytest.raises(ValueError, match="no feature"):
        rescore.fit(empty.drop("a"))


def test_run_without_an_external_scorer(spark, branches, tmp_path):  # noqa: F811
    base, _ = branches
    shutil.copytree(base, tmp_path / "in")
    for f in (tmp_path / "in").glob("*/results/percolator/rescore.percolator*"):
        f.unlink()
    c = config(tmp_path / "in", tmp_path / "out", run_psa=False, run_iforest=False, run_postprocess=False, run_plotting=False)
    merged = Pipeline(spark, c).run().merged
    scores = spark.read.parquet(str(tmp_path / "out/scores/database"))
    assert scores.columns == ["PSMId", "score", "q-value", "posterior_error_prob", "is_target"] and scores.count() > 1500
    assert merged["database"].where("percolator_score is not null").count() == merged["database"].join(scores, F.col("SpecId") == F.col("PSMId")).count() > 1500
    header, norm, raw = readers.parse_weights((tmp_path / "out/weights/rescore.percolator.weights.csv").read_text().splitlines())
    assert header == ["f1", "f2", "f3", "m0"] and len(norm) == len(raw) == 3
    assert merged["denovo"].where("f1 is not null and percolator_score is null").count() == 0  # by the averaged weights
