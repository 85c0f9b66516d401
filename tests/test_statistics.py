"""Distribution functions, cutoffs, forests and figures against plain statements of their definitions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pepweave.operators import ecdf, forest, plotdata


def frame(spark, values, side="x"):
    return spark.createDataFrame([(side, float(v)) for v in values], "side string, v double")


def ks_by_hand(a, b):
    """Over reference values in order, then the others: first largest negative and positive difference, the positive one unless the other is larger."""
    a, b = np.sort(a), np.sort(b)
    every = np.concatenate([a, b])
    d = np.searchsorted(a, every, "right") / len(a) - np.searchsorted(b, every, "right") / len(b)
    low, high = int(np.argmin(d)), int(np.argmax(d))
    return (-d[low], every[low]) if -d[low] > d[high] else (d[high], every[high])


@pytest.mark.parametrize("seed", range(6))
def test_ks(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 8, rng.integers(1, 30)) / 4, rng.integers(0, 9, rng.integers(1, 30)) / 4
    row = ecdf.ks_table(frame(spark, a), frame(spark, b)).first()
    d, at = ks_by_hand(a, b)
    assert (row.statistic_D, row.statistic_location) == (pytest.approx(d), at)
    assert (row.n_reference, row.n_other) == (len(a), len(b))


def test_running_counts_over_many_ranges(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=3000), rng.normal(0.3, size=2000)
    row = ecdf.ks_table(frame(spark, a), frame(spark, b)).first()
    assert (row.statistic_D, row.statistic_location) == (pytest.approx(ks_by_hand(a, b)[0]), ks_by_hand(a, b)[1])


def test_pvalues():
    # two samples of one value each that differ: all of the two orders are as extreme
    assert ecdf.ks_pvalue(1.0, 1, 1) == pytest.approx(1.0)
    assert ecdf.ks_pvalue(1.0, 3, 3) == pytest.approx(2 / math.comb(6, 3))
    assert ecdf.ks_pvalue(0.0, 5, 5) == 1.0
    exact, limit = ecdf.ks_pvalue(0.03, 9000, 9000), 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * 4500 * 0.03**2) for k in range(1, 50))
    assert exact == pytest.approx(limit, rel=0.05)
    assert 0 <= ecdf.ks_pvalue(0.03, 20000, 20000) < 0.01


def test_goodness(spark):
    out = dict(ecdf.goodness(frame(spark, [1, 2, 2, 4]), frame(spark, [0, 1, 2, 3, 9])).select("v", "goodness").collect())
    assert out == {0.0: 0.0, 1.0: 0.25, 2.0: 0.75, 3.0: 0.75, 9.0: 1.0}
    df = spark.createDataFrame([(1, 2.0), (2, None)], "k int, s double")
    assert {r.k: r.g for r in ecdf.with_goodness(df, spark.createDataFrame([(2.0,), (3.0,)], "v double"), "s", "g").collect()} == {1: 0.5, 2: None}


@pytest.mark.parametrize("q", [0.0, 0.3, 0.7, 1.0])
def test_quantile(spark, q):
    for x in (np.random.default_rng(1).normal(size=1001), np.array([3.0]), np.array([1.0, 1.0, 2.0, 2.0])):
        assert ecdf.quantile(frame(spark, x), "v", q) == pytest.approx(np.percentile(x, 100 * q), abs=1e-12)
    assert ecdf.quantile(frame(spark, []), "v", q) is None


def test_empty_populations(spark):
    with pytest.raises(ecdf.EmptyPopulation):
        ecdf.ks_cutoffs(frame(spark, [], "database"), frame(spark, [1.0], "database"), {"database": ""})


def test_forest(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    n1, one = forest.fit(rows, ["a", "b", "c"], seed=4, trees=20)
    n2, two = forest.fit(rows.orderBy(F.rand(3)), ["a", "b", "c"], seed=4, trees=20)
    probe = np.vstack([x[:50], [[8, 8, 8], [-9, 7, 9]]])
    assert np.allclose(one.score(probe), two.score(probe))
    assert one.score(probe)[-2:].min() > one.score(probe)[:-2].max()
    assert one.psi == [256, 512] and len(one.roots[0]) == 20
    with pytest.raises(forest.TooFewRows):
        forest.fit(rows.limit(256), ["a", "b", "c"])


def test_forest_survives_saving(spark, tmp_path):
    x = np.random.default_rng(2).normal(size=(300, 2))
    nodes, model = forest.fit(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double"), ["a", "b"], trees=5)
    forest.save(nodes, model, str(tmp_path / "m"))
    again = forest.restore(spark, str(tmp_path / "m"))
    assert np.array_equal(again.score(x), model.score(x)) and again.cut == model.cut


def test_scores_of_sides(spark):
    x = np.random.default_rng(2).normal(size=(300, 2))
    nodes, model = forest.fit(spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double"), ["a", "b"], trees=5)
    rows = [("shared", 0.0, 0.1, 9.0, 9.0), ("database_only", 0.2, 0.1, None, None), ("denovo_only", None, None, 0.0, None)]
    df = spark.createDataFrame(rows, "_merge string, a_database double, b_database double, a_denovo double, b_denovo double")
    out = forest.rescaled(forest.score_sides(df, model, ["a", "b"]).persist()).collect()
    assert [r.ISO_scores_database is None for r in out] == [False, False, True]
    assert [r.ISO_scores_denovo is None for r in out] == [False, True, True]
    assert out[0].ISO_scores_denovo == 0.0 and out[0].ISO_labels_denovo == 1.0


def test_no_spread_is_all_good(spark):
    df = spark.createDataFrame([(2.0, 2.0), (None, 2.0)], "ISO_scores_database double, ISO_scores_denovo double")
    assert [tuple(r) for r in forest.rescaled(df).collect()] == [(1.0, 1.0), (None, 1.0)]


def test_bins(spark):
    rows = spark.createDataFrame([(0.0,), (0.999,), (1.0,), (0.5,), (1.1,)], "v double")
    assert {r.bin: r.n for r in plotdata.histogram(rows, "v", 0.0, 1.0, 10).collect()} == {0: 1, 9: 2, 5: 1}


def test_hexagons_hold_every_point(spark):
    rng = np.random.default_rng(5)
    pairs = spark.createDataFrame([(float(a), float(b), bool(t)) for a, b, t in zip(rng.random(500), rng.normal(size=500), rng.random(500) < 0.5, strict=True)], "iso double, scorer double, target boolean")
    cells = plotdata.hexagons(pairs).collect()
    assert sum(c.n for c in cells) == 500
    assert sum(c.weight for c in cells if c.layer) == pytest.approx(1)


def skewed(spark):
    """A third of the rows are alike, one row in 20000 is far off."""
    x = np.random.default_rng(6).normal(size=(20000, 2))
    x[:6000] = 0.25, -0.5
    x[-1] = 40, -40
    return x, spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")


def test_forest_sample_keeps_the_share_of_equal_rows(spark, monkeypatch):
    _, rows = skewed(spark)
    drawn, sample = [], forest.sample
    monkeypatch.setattr(forest, "sample", lambda *a: drawn.append(sample(*a)) or drawn[-1])
    for seed in range(3):
        forest.fit(rows, ["a", "b"], seed=seed, trees=1, max_rows=2000)
        x = drawn[-1]
        assert (x == [0.25, -0.5]).all(1).sum() == 600 and len(x) == pytest.approx(2000, abs=200)
    forest.fit(rows, ["a", "b"], trees=1)
    assert len(drawn[-1]) == 20000


def test_forest_scale_is_of_the_whole_training_set(spark):
    x, rows = skewed(spark)
    _, model = forest.fit(rows, ["a", "b"], trees=3, max_rows=2000)
    raw = model.raw(x)
    assert np.allclose(model.mean, raw.mean(0), rtol=1e-9) and np.allclose(model.std, raw.std(0), rtol=1e-9)
    assert model.cut == pytest.approx(np.quantile(model.score(x), 1 - forest.CONTAMINATION), rel=1e-12)
    _, again = forest.fit(rows.repartition(7), ["a", "b"], trees=3, max_rows=2000)
    assert again.cut == model.cut and np.array_equal(again.mean, model.mean) and np.array_equal(again.std, model.std)


def test_forest_scores_each_distinct_vector_once(spark, monkeypatch):
    """Equal rows of either side go through the trees once, and have the scores of their own vectors."""
    x, rows = skewed(spark)
    _, model = forest.fit(rows, ["a", "b"], trees=3, max_rows=2000)
    some = [(i % 3, float(i % 7), float(i % 5) if i % 11 else None) for i in range(2000)]
    df = spark.createDataFrame([(i, ["shared", "database_only", "denovo_only"][k], a, b, b, a) for i, (k, a, b) in enumerate(some)], "id int, _merge string, a_database double, b_database double, a_denovo double, b_denovo double")
    asked, score_vectors = [], forest.score_vectors
    monkeypatch.setattr(forest, "score_vectors", lambda v, m: asked.append(v.count()) or score_vectors(v, m))
    out = forest.score_sides(df, model, ["a", "b"]).orderBy("id").collect()
    assert asked == [len({v for k, a, b in some if b is not None for v in ([(a, b)] if k == 1 else [(b, a)] if k == 2 else [(a, b), (b, a)])})] and len(out) == len(some)
    for r, (k, a, b) in zip(out, some, strict=True):
        for s, here, v in (("database", k != 2, (a, b)), ("denovo", k != 1, (b, a))):
            want = model.score(np.array([v]))[0] if here and b is not None else None
            assert r[f"ISO_scores_{s}"] == want and r[f"ISO_labels_{s}"] == (None if want is None else float(want > model.cut))


def test_forest_runs_are_the_walks_down_the_trees(spark):
    """Sorted vectors have the very scores of the whole trees, though long runs, in pieces or not, never go down them."""
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 3, 20000) / 100, rng.normal(size=20000), rng.integers(0, 9, 20000) / 10, rng.integers(0, 40, 20000)])
    _, model = forest.fit(spark.createDataFrame(x.tolist(), "a double, b double, c double, d double"), list("abcd"), trees=4, max_rows=5000)
    by = model.order(4)
    assert by[0] == 0 and by[-1] == 1
    x[:300, 2], x[300:310, 1], x[:5, 0] = -0.0, np.inf, 1e300
    x = x[np.lexsort(x[:, by[::-1]].T)]
    want, whole, walked = model.raw(x), model.raw, []
    model.raw = lambda rows: walked.append(len(rows)) or whole(rows)
    runs = forest.Runs(model, 4)
    assert np.array_equal(np.concatenate([runs.raw(x[k : k + 3000]) for k in range(0, len(x), 3000)]), want)
    assert sum(walked) < len(x) / 4
    few = rng.permutation(x)[:50]
    assert np.array_equal(forest.Runs(model, 4).raw(few), whole(few)) and np.array_equal(forest.Runs(model, 4).raw(x[:0]), whole(x[:0]))


def test_forest_scores_find_their_rows_whatever_the_sign_of_zero(spark):
    x, rows = skewed(spark)
    _, model = forest.fit(rows, ["a", "b"], trees=3, max_rows=2000)
    df = spark.createDataFrame([(k, "shared", 0.0 * (-1) ** k, 1.0, 1.0, 0.0 * (-1) ** k) for k in range(4)], "id int, _merge string, a_database double, b_database double, a_denovo double, b_denovo double")
    one, two = model.score(np.array([[0.0, 1.0], [1.0, 0.0]]))
    assert {(r.ISO_scores_database, r.ISO_scores_denovo) for r in forest.score_sides(df, model, ["a", "b"]).collect()} == {(one, two)}
