"""What keeps the engine's queries from growing faster than their tables: inputs read once, narrow tables, few steps a row."""

from bisect import bisect_left

import numpy as np
import pytest
from pyspark.sql import functions as F

from pepweave.operators import ecdf, plotdata, rescore, similarity
from pepweave.plans import queries

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ranges_are_found_by_halving(spark):
    values = spark.createDataFrame([("x", float(v)) for v in np.random.default_rng(3).normal(size=3000).round(2)], "side string, v double")
    for ranges in (1, 2, 64, 100, 512):
        out = ecdf.ranged(values, ranges=ranges)
        assert "filter(" not in plan(out)
        cuts = values.agg(F.percentile_approx("v", [k / ranges for k in range(1, ranges)] or [0.5], F.lit(10 * ranges))).first()[0] if ranges > 1 else []
        assert all(r["__range"] == bisect_left(cuts, r.v) for r in out.collect())


def test_both_populations_come_from_one_merge(spark):
    """Two reads of lineitem (matches, and what de novo peptides are made from) and one of orders at most."""
    rows = queries.populations(queries.scans(spark, SMALL))
    assert 2 <= plan(rows).count("Relation [") <= 3


@pytest.mark.parametrize("points", [2, 11, 501])
def test_grid_counts_values_at_and_beside_its_points(spark, points):
    last, edge = points - 1, np.array([k / (points - 1) for k in range(points)])
    a = np.concatenate([edge, np.nextafter(edge, 2), np.nextafter(edge, -1), [-3.0, 7.0, float("inf"), float("-inf")]])
    b = np.random.default_rng(5).random(500)
    frame = lambda x: spark.createDataFrame([("s", float(v)) for v in x] + [("s", None)], "side string, v double")
    out = {round(r.v * last): r for r in plotdata.ecdf_grid(frame(a), frame(b), points).collect()}
    assert len(out) == points
    for k, at in enumerate(edge):
        assert (out[k].v, out[k].reference, out[k].other) == (at, (a <= at).sum() / len(a), (b <= at).sum() / len(b))


def test_lists_write_what_they_show(spark, monkeypatch):
    wrote, staged = [], queries.staged
    monkeypatch.setattr(queries, "staged", lambda df, name: wrote.append(df.columns) or staged(df, name))
    for name, most in (("call_counts", 5), ("ranked_good_list", 8), ("good_list", 13)):
        queries.QUERIES[name](spark, SMALL)
        assert len(wrote.pop()) == most


def test_alignments_have_the_details_asked_for(spark):
    pairs = spark.createDataFrame([("PEPTIDE", "PEPTIDK")] * 20 + [("PEXP", "PEP"), ("PEPTIDE", "PEPTIDE")], "a string, b string")
    out = similarity.align_pairs(pairs, ("first", "events"))
    assert out.columns == ["a", "b", "event", "error", "first", "events"]
    rows = out.collect()
    assert [r.error for r in rows if r.events is None] == ["UnsupportedResidue: unsupported residue(s): X"] and len(rows) == 22
    assert {tuple(r.events[0])[:5] for r in rows if r.events} == {("C-TERM-MISMATCH", 6, "E", "K", 1), ("IDENTICAL", 0, "", "", 0)}


def test_spectra_are_taken_as_given(spark):
    rows = spark.createDataFrame([("r-1-A-2", "s", 1.0, True), ("r-2-A-2", "s", 2.0, True), ("odd", "t", 0.5, False)], "SpecId string, spectrum string, score double, is_target boolean")
    assert {r.SpecId for r in rescore.best_of_spectrum(rows).collect()} == {"r-2-A-2", "odd"}
    assert {r.SpecId for r in rescore.best_of_spectrum(rows.drop("spectrum")).collect()} == {"r-1-A-2", "r-2-A-2", "odd"}
