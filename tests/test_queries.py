"""Every registered query of the engine with a DuckDB form gives DuckDB's rows; the others keep their invariants."""

import pytest

from pepweave.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_duckdb(name, compare):
    compare(QUERIES[name], ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_alignment_rebuilds_both_peptides(spark):
    rows = QUERIES["align_events"](spark, SF).collect()
    assert rows
    for r in rows:
        assert r.error is None
        assert r.first.replace("-", "") == r.a and r.second.replace("-", "") == r.b
        assert len(r.first) == len(r.second) == len(r.marks)


def test_similarity_labels_cover_shared_rows_only(spark):
    rows = {r.PSA: r for r in QUERIES["similarity_labels"](spark, SF).collect()}
    assert rows[None].total_distance is None and rows["PSA - Tier 0 - IDENTICAL"].total_distance == 0
    assert all(r.errors == 0 for r in rows.values())


def test_forest_is_seeded_and_in_range(spark):
    one, two = (sorted(map(tuple, QUERIES["forest_scores"](spark, SF).collect()), key=repr) for _ in range(2))
    assert one == two
    scores = [v for r in one for v in r[5:] if v is not None]
    assert min(scores) == 0 and max(scores) == 1


def test_forest_query_grows_whole_ensembles(spark, monkeypatch):
    from pepweave.operators import forest

    fit, grown = forest.fit, []

    def noted(*args, **options):
        nodes, model = fit(*args, **options)
        grown.extend(map(len, model.roots))
        return nodes, model

    monkeypatch.setattr(forest, "fit", noted)
    QUERIES["forest_scores"](spark, SF)
    assert grown and set(grown) == {forest.TREES}


def test_forest_rows_have_the_ids_of_their_scans(spark):
    found, want = (sorted(map(tuple, QUERIES[q](spark, SF).select("RAW_FILE", "SCAN_NUMBER", "SpecId").collect())) for q in ("forest_scores", "branch_full_outer"))
    assert found == want
