"""Files that can't be read, runs that broke off, and branches side by side."""

import shutil

import pytest
from pyspark.sql import functions as F

from pepweave.operators.calls import with_rank
from pepweave.plans.pipeline import Pipeline
from pepweave.plans.session import side_by_side
from pepweave.sources import readers, sinks
from tests.test_pipeline import DB_HEAD, branches, config, write  # noqa: F401


def test_torn_and_mistyped_files_go_to_the_error_table(spark, branches, tmp_path):  # noqa: F811
    base, _ = branches
    shutil.copytree(base, tmp_path / "in")
    msms = tmp_path / "in/database/msms"
    (msms / "torn +1.rescore").write_text(",".join(DB_HEAD) + "\ntorn +1,1,AAK,2,500.0,0.5,AAK,0,false,x\ntorn +1,2,AA")
    write(msms / "mistyped.rescore", DB_HEAD, [["mistyped", 1, "AAK", 2, 500.0, 0.5, "AAK", 0, "false", "x"], ["mistyped", "two", "AAK", 2, 500.0, 0.5, "AAK", 0, "false", "x"]])
    write(msms / "headless.rescore", ["a", "b"], [[1, 2]])
    (msms / "void.rescore").write_text("")
    shuffled = [DB_HEAD[k] for k in (1, 0, 6, 2, 3, 4, 5, 7, 8)]
    write(msms / "other order.rescore", shuffled, [[7, "other order", "AAK", "AAK", 2, 500.0, 0.5, 0, "false"]])
    with open(tmp_path / "in/denovo/results/percolator/rescore.tab", "a") as f:
        f.write("third-1-AAK-2\t1\t0.5\t0.5\t0.5\nthird-2-AAK-2\t1\tlots\t0.5\t0.5\nthird-3-AAK-2\t1\t0.5\n")
    whole = Pipeline(spark, config(base, tmp_path / "whole", run_psa=False, run_iforest=False, run_postprocess=False, run_plotting=False)).run().merged
    merged = Pipeline(spark, config(tmp_path / "in", tmp_path / "out", run_psa=False, run_iforest=False, run_postprocess=False, run_plotting=False)).run().merged
    errors = {(r.source, r.RAW_FILE, r.reason, int(r.n)) for r in spark.read.option("header", True).csv(str(tmp_path / "out/errors.csv")).collect()}
    assert errors == {
        ("database search", "torn +1", "torn row", 1), ("database search", "mistyped", "mistyped SCAN_NUMBER", 1), ("database search", "headless", "no header", 0), ("database search", "void", "empty file", 0),
        ("denovo features", "third", "mistyped f1", 1), ("denovo features", "third", "torn row", 1),
    }
    names = {r.RAW_FILE for r in merged["database"].select("RAW_FILE").distinct().collect()}
    assert names == {"run-1 a", "run2", "other order", None}
    assert merged["database"].where("RAW_FILE = 'other order'").first().SCAN_NUMBER == 7
    for side in whole:  # the other files' results stand
        ours = merged[side].where("RAW_FILE is null or RAW_FILE <> 'other order'")
        assert ours.exceptAll(whole[side].select(*ours.columns)).count() == 0 and ours.count() == whole[side].count()


def test_a_clean_run_has_an_empty_error_table(spark, branches, tmp_path):  # noqa: F811
    base, _ = branches
    search, errors = readers.read_search_checked(spark, str(base / "database/msms"), "database", lambda df, name: df)
    assert errors.count() == 0 and search.exceptAll(readers.read_search(spark, str(base / "database/msms"), "database")).count() == 0
    nothing, errors = readers.read_search_checked(spark, str(tmp_path / "none"), "database", lambda df, name: df)
    assert nothing.count() == errors.count() == 0


def rows(spark, values):
    return spark.createDataFrame(values, "RAW_FILE string, v long")


def test_raw_files_that_a_broken_run_left_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_raw_file(rows(spark, [("a", 1), ("a", 2), (None, 3)]), path)
    assert {(r.RAW_FILE, r["rows"]) for r in sinks.manifest(spark, path).collect()} == {("a", 2), (None, 1)}
    # a run that broke off: part of b's rows are there, b is not in the manifest
    shutil.copytree(tmp_path / "t/RAW_FILE=a", tmp_path / "t/RAW_FILE=b")
    sinks.write_by_raw_file(rows(spark, [("a", 100), ("b", 7), ("b", 8), (None, 9), ("c", 1)]), path, overwrite=False)
    got = sorted(map(tuple, readers.read_by_raw_file(spark, path).select("RAW_FILE", "v").collect()), key=repr)
    assert got == sorted([("a", 1), ("a", 2), (None, 3), ("b", 7), ("b", 8), ("c", 1)], key=repr)
    assert {(r.RAW_FILE, r["rows"]) for r in sinks.manifest(spark, path).collect()} == {("a", 2), (None, 1), ("b", 2), ("c", 1)}


def test_a_table_without_a_manifest_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, [("a", 1)]).write.partitionBy("RAW_FILE").parquet(path)  # its writer never came to the manifest
    sinks.write_by_raw_file(rows(spark, [("a", 5), ("b", 6)]), path, overwrite=False)
    assert {r.v for r in readers.read_by_raw_file(spark, path).collect()} == {5, 6}
    sinks.write_by_raw_file(rows(spark, [("z", 1)]), path)
    assert {r.RAW_FILE for r in sinks.manifest(spark, path).collect()} == {"z"}


@pytest.mark.parametrize("c,bad", [("5", False), ("2.0", False), ("n/a", False), ("", False), (None, False), ("two", True), ("1,5", True)])
def test_mistyped(spark, c, bad):
    df = spark.createDataFrame([(c,)], "c string")
    assert df.select(readers.mistyped(F.col("c"), "long")).first()[0] is bad


def slow(seconds):
    def run(batches):
        import time

        for pdf in batches:
            time.sleep(seconds)
            yield pdf

    return run


def test_branches_run_side_by_side_in_pools_of_their_own(spark):
    import time

    context, running = spark.sparkContext, {}

    def work(name):
        def run():
            jobs = context.statusTracker().getActiveJobsIds
            started = time.time()
            n = spark.range(0, 2, 1, 2).mapInPandas(slow(2), "id long").count()
            running[name] = (context.getLocalProperty("spark.scheduler.pool"), started, time.time(), callable(jobs))
            return n

        return run

    assert side_by_side(spark, {"one": work("one"), "two": work("two")}) == {"one": 2, "two": 2}
    (pool_a, a, b, _), (pool_b, c, d, _) = running["one"], running["two"]
    assert {pool_a, pool_b} == {"one", "two"} and max(a, c) < min(b, d)  # both were active at once
    assert context.getLocalProperty("spark.scheduler.pool") is None


def test_a_failing_branch_stops_the_other(spark):
    import time

    def fails():
        time.sleep(2)
        raise ValueError("this branch is broken")

    started, stopped = time.time(), []

    def long():
        try:
            return spark.range(0, 4, 1, 4).mapInPandas(slow(60), "id long").count()
        except Exception as e:
            stopped.append(str(e))
            raise

    with pytest.raises(ValueError, match="broken"):
        side_by_side(spark, {"bad": fails, "long": long})
    assert time.time() - started < 40 and stopped and "cancel" in stopped[0].lower()


def test_ranks_are_places_in_the_sorted_list(spark):
    import random

    rng = random.Random(1)
    values = [(rng.choice([None, 0.1, 0.5, 0.9]), rng.choice(["a", "b"]), k % 50, f"id{k}") for k in range(700)]
    df = spark.createDataFrame(values, "TP_GOODNESS double, RAW_FILE string, SCAN_NUMBER long, SpecId string").repartition(6)
    got = [r.SpecId for r in with_rank(df).orderBy("rank").collect()]
    assert got == [v[3] for v in sorted(values, key=lambda v: (v[0] is None, -(v[0] or 0), v[1], v[2], v[3]))]
    assert sorted(r["rank"] for r in with_rank(df).collect()) == list(range(1, 701)) and with_rank(df.limit(0)).count() == 0
