"""Sources, merges and the whole run on a small synthetic fixture with the awkward rows."""

import csv
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pepweave.cli import parse
from pepweave.config import Config, ConfigError
from pepweave.functions import columns as C
from pepweave.operators import merge
from pepweave.plans.pipeline import Pipeline
from pepweave.sources import readers, sinks

FEATURES = ["f1", "f2", "f3"]
DB_HEAD = ["RAW_FILE", "SCAN_NUMBER", "MODIFIED_SEQUENCE", "PRECURSOR_CHARGE", "MASS", "SCORE", "SEQUENCE", "num_missed_cleavages", "REVERSE", "extra"]
DN_HEAD = ["RAW_FILE", "SCAN_NUMBER", "MODIFIED_SEQUENCE", "PRECURSOR_CHARGE", "MASS", "SCORE", "REVERSE", "SEQUENCE", "AA_SCORE"]


def write(path, head, rows, sep=","):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f, delimiter=sep)
        w.writerow(head)
        w.writerows(rows)


@pytest.fixture(scope="module")
def branches(tmp_path_factory):
    """Two raw files (one with dashes and blanks), 900 scans each; features, scores, decoys and awkward rows."""
    base = tmp_path_factory.mktemp("branches")
    rng = np.random.default_rng(1)
    letters = list("ACDEFGHIKLMNPQRSTVWY")
    raws = ["run-1 a", "run2"]
    pins = {"database": [], "denovo": []}
    scores, decoys = [], []
    for raw in raws:
        db, dn = [], []
        for scan in range(900):
            seq = "".join(rng.choice(letters, 9)) + "K"
            other = seq if scan % 2 else seq[:4] + seq[5] + seq[4] + seq[6:]
            if scan % 10 != 3:
                charge = 2
                db.append([raw, scan, seq, charge, 900.5, float(rng.random()), seq, 0, scan % 7 == 0, "x"])
                sid = f"{raw}-{scan}-{seq}-{charge}"
                label = -1 if scan % 7 == 0 else 1
                pins["database"].append([sid, label, *rng.normal(size=3).round(4)])
                (scores if label == 1 else decoys).append([sid, round(float(rng.normal(1, 1)), 4), 0.01, 0.01])
            if scan % 10 != 5:
                dn.append([raw, scan, other, 2, 900.5, "n/a" if scan == 4 else round(float(rng.random()), 3), "false", other, "0.9|0.8"])
                pins["denovo"].append([f"{raw}-{scan}-{other}-2", 1, *(rng.normal(size=3) + (0 if scan % 2 else 1)).round(4)])
        db.append([raw, 1, "AAAAAAK", 3, 500.0, 0.1, "AAAAAAK", 1, "false", "x"])  # a chimeric scan, without features
        write(base / f"database/msms/{raw}.rescore", DB_HEAD, db)
        write(base / f"denovo/msms/{raw}.rescore", DN_HEAD, dn)
    pins["database"] += [["nowhere-1-AAK-2", 1, 0, 0, 0], ["not an id", 1, 0, 0, 0], ["run2-5000-GGGK-2", 1, 0.5, 0.5, 0.5]]
    decoys.append([scores[0][0], -50.0, 0.5, 0.5])  # a target in both files
    for side in pins:
        tab = base / side / "results/percolator"
        write(tab / "rescore.tab", ["SpecId", "Label", *FEATURES], pins[side], "\t")
        head = ["PSMId", "score", "q-value", "posterior_error_prob"]
        write(tab / "rescore.percolator.psms.txt", head, scores if side == "database" else [[p[0], round(float(rng.normal()), 4), 0.01, 0.01] for p in pins["denovo"]], "\t")
    write(base / "database/results/percolator/rescore.percolator.decoy.psms.txt", ["PSMId", "score", "q-value", "posterior_error_prob"], decoys, "\t")
    return base, scores


def config(base, out, **more):
    return Config(outdir=str(out), database_oktoberfest_dir=str(base / "database"), denovo_oktoberfest_dir=str(base / "denovo"), iforest_features=FEATURES, **more)


def test_two_sided_run(spark, branches, tmp_path):
    base, scores = branches
    out = Pipeline(spark, config(base, tmp_path)).run()
    merged = out.merged["database"]
    assert merged.where("SpecId = 'run2-5000-GGGK-2' and SEQUENCE is null").count() == 1  # features without a search row
    assert merged.where("SpecId like 'nowhere%' or SpecId = 'not an id'").count() == 0
    assert merged.where("SEQUENCE = 'AAAAAAK' and Label is null").count() == 2
    assert merged.where(F.col("SpecId") == scores[0][0]).first().percolator_score == pytest.approx(scores[0][1])  # the target's score
    scans = out.scans
    assert {r[0] for r in scans.select("RAW_FILE").distinct().collect() if r[0]} == {"run-1 a", "run2"}
    assert {r._merge for r in scans.select("_merge").distinct().collect()} == {"shared", "database_only", "denovo_only"}
    assert scans.where("chimeric").select("SCAN_NUMBER").distinct().collect()[0][0] == 1
    assert scans.where("_merge <> 'shared' and PSA is not null").count() == 0
    assert scans.where("_merge = 'shared' and PSA is null").count() == 0
    called = out.called
    assert called.where("ISO_scores_denovo < 0 or ISO_scores_denovo > 1 or TP_GOODNESS_denovo < 0 or TP_GOODNESS_denovo > 1").count() == 0
    good, bad = (spark.read.option("header", True).csv(str(tmp_path / f"called/{n}.csv")) for n in ("good", "bad"))
    from pepweave.schemas import LIST_COLUMNS, SUMMARY_COLUMNS

    assert good.columns == bad.columns == LIST_COLUMNS
    primary = F.when(F.col("_merge") == "denovo_only", F.col("ISO_scores_denovo")).otherwise(F.col("ISO_scores_database"))
    assert good.count() + bad.count() == called.where(primary.isNotNull()).count()
    summary = spark.read.option("header", True).csv(str(tmp_path / "called/ks_vs_tp_summary.csv"))
    assert summary.columns == SUMMARY_COLUMNS and summary.count() == 4
    assert (tmp_path / "qc/score_density_database.csv").exists() and (tmp_path / "model/nodes").exists()


def test_later_stages_alone(spark, branches, tmp_path):
    base, _ = branches
    Pipeline(spark, config(base, tmp_path / "a", run_iforest=False, run_postprocess=False, run_plotting=False)).run()
    c = config(base, tmp_path / "a", run_rescoring=False, run_psa=False, grove_forest_dir=str(tmp_path / "a"), iforest_output_dir=str(tmp_path / "b"), run_plotting=False)
    out = Pipeline(spark, c).run()
    assert out.cutoffs.keys() == {"database", "denovo"} and (tmp_path / "b/called/good.csv").exists() and not (tmp_path / "a/scored").exists()


def test_denovo_only(spark, branches, tmp_path):
    base, _ = branches
    c = config(base, tmp_path, denovo_only=True, iforest_training_source="denovo_score", iforest_denovo_score_threshold=0.6)
    out = Pipeline(spark, c).run()
    good = spark.read.option("header", True).csv(str(tmp_path / "called/good.csv"))
    from pepweave.schemas import DENOVO_LIST_COLUMNS

    assert good.columns == DENOVO_LIST_COLUMNS and good.count() > 0 and out.cutoffs.keys() == {"denovo"}


def test_first_raw_files_and_no_overwrite(spark, branches, tmp_path):
    base, _ = branches
    c = config(base, tmp_path, psa_max_raw_files=1, run_iforest=False, run_postprocess=False, run_plotting=False)
    first = Pipeline(spark, c).run().scans
    assert [r[0] for r in first.select("RAW_FILE").distinct().collect()] == ["run-1 a"]
    n = first.count()
    more = Pipeline(spark, config(base, tmp_path, run_iforest=False, run_postprocess=False, run_plotting=False)).run().scans
    assert more.where("RAW_FILE = 'run-1 a'").count() == n and more.where("RAW_FILE = 'run2'").count() > 0


def test_null_keys_meet(spark):
    schema = "RAW_FILE string, SCAN_NUMBER long, SEQUENCE string, SpecId string"
    a = spark.createDataFrame([(None, None, "A", "x"), (None, None, "B", "y"), ("r", 1, "C", "z")], schema)
    b = spark.createDataFrame([(None, None, "D", "w"), ("r", 2, "E", "v")], schema)
    out = merge.merge_scans(a, b)
    assert sorted((r._merge, r.SpecId) for r in out.collect()) == [("database_only", "z"), ("denovo_only", "v"), ("shared", "x"), ("shared", "y")]


def test_clashing_and_differing_columns(spark):
    a = spark.createDataFrame([("r", 1, "A", 2, 0.0)], "RAW_FILE string, SCAN_NUMBER long, MODIFIED_SEQUENCE string, PRECURSOR_CHARGE int, MASS double")
    with pytest.raises(ValueError, match="MASS"):
        merge.merge_branch(a, spark.createDataFrame([("r-1-A-2", 1.0)], "SpecId string, MASS double"))
    with pytest.raises(C.ColumnMismatch):
        C.require_same_columns(a, a.drop("MASS"))
    with pytest.raises(C.ColumnMismatch):
        C.unsuffixed(spark.range(1).select(F.lit(1).alias("x_database"), F.lit(1).alias("x")), "database")
    with pytest.raises(C.ColumnMismatch, match="missing"):
        C.feature_vector(a, ["nope"], "database")


def test_numbers_and_ids(spark):
    rows = spark.createDataFrame([("2.0",), ("x",), (None,), ("NaN",)], "t string")
    assert [tuple(r) for r in rows.select(readers.number(F.col("t")), readers.number(F.col("t"), "int")).collect()] == [(2.0, 2), (None, None), (None, None), (None, None)]
    ids = spark.createDataFrame([("a-b 1-12-PEP[UNIMOD:4]K-2",), ("nothing",)], "i string")
    assert [r[0] for r in ids.select(readers.raw_file_of(F.col("i"))).collect()] == ["a-b 1", None]


def test_weights(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# bins\na\tb\tm0\n1\t2\t3\n10\t20\t30\n\na\tb\tm0\n3\t4\t5\n30\t40\t50\n")
    header, norm, raw = sinks.write_average_weights(spark, str(tmp_path / "w.txt"), str(tmp_path / "out.txt"))
    assert (header, norm, raw) == (["a", "b", "m0"], [2.0, 3.0, 4.0], [20.0, 30.0, 40.0])
    assert (tmp_path / "out.txt").read_text().splitlines()[2] == "2.0000\t3.0000\t4.0000"


def test_static_rescoring(spark, branches, tmp_path):
    """Without scorer output of its own the de novo branch is scored by the database branch's averaged weights."""
    import shutil

    base, _ = branches
    shutil.copytree(base, tmp_path / "in")
    (tmp_path / "in/denovo/results/percolator/rescore.percolator.psms.txt").unlink()
    (tmp_path / "in/database/results/percolator/rescore.percolator.weights.csv").write_text("# bins\nf1\tf2\tf3\tm0\n0\t0\t0\t0\n1\t2\t3\t4\nf1\tf2\tf3\tm0\n0\t0\t0\t0\n3\t2\t1\t0\n")
    c = config(tmp_path / "in", tmp_path / "out", run_psa=False, run_iforest=False, run_postprocess=False, run_plotting=False)
    merged = Pipeline(spark, c).run().merged["denovo"]
    rows = merged.where("f1 is not null").select("f1", "f2", "f3", "percolator_score").collect()
    assert len(rows) > 1000 and all(r.percolator_score == pytest.approx(2 * r.f1 + 2 * r.f2 + 2 * r.f3 + 2) for r in rows)
    assert (tmp_path / "out/weights/rescore.percolator.weights.avg.csv").read_text().splitlines()[3] == "2.0000\t2.0000\t2.0000\t2.0000"
    (tmp_path / "in/database/results/percolator/rescore.percolator.weights.csv").write_text("f1\tm0\n0\t0\n1\t2\n")
    with pytest.raises(ValueError, match="2 weights"):
        Pipeline(spark, c).run()


def test_figures_of_scored_tables_without_calls(spark, branches, tmp_path):
    base, _ = branches
    Pipeline(spark, config(base, tmp_path / "a", run_postprocess=False)).run()
    assert (tmp_path / "a/qc/score_quadrants_database.csv").exists() and not (tmp_path / "a/called").exists()
    alone = config(base, tmp_path / "b", run_rescoring=False, run_psa=False, run_iforest=False, run_postprocess=False)
    with pytest.raises(ConfigError, match="grove_forest_dir"):
        Pipeline(spark, alone).run()
    Pipeline(spark, replace(alone, grove_forest_dir=str(tmp_path / "a"))).run()
    assert (tmp_path / "b/qc/score_quadrants_database.csv").exists()


def test_lists_are_in_order(spark, tmp_path):
    from pepweave.operators.calls import ranked

    rng = np.random.default_rng(0)
    rows = [(None if k % 50 == 0 else float(rng.integers(40)) / 40, f"run{rng.integers(3)}", int(rng.integers(30)), f"s{k}") for k in range(2000)]
    df = spark.createDataFrame(rows, "TP_GOODNESS double, RAW_FILE string, SCAN_NUMBER long, SpecId string").repartition(4)
    want = [r[3] for r in sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), *r[1:]))]
    for single in (False, True):
        path = tmp_path / f"list{single}.csv"
        sinks.write_list(ranked(df), str(path), single)
        parts = sorted(path.glob("part-*.csv"))
        assert [r["SpecId"] for p in parts for r in csv.DictReader(p.open())] == want and (len(parts) == 1 or not single)


def test_empty_tables_and_chosen_columns(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    assert readers.read_parquet(spark, str(tmp_path / "none"), schema=schema).columns == ["a", "b"]
    spark.createDataFrame([(1, "x")], schema).write.parquet(str(tmp_path / "t"))
    chosen = readers.read_parquet(spark, str(tmp_path / "t"), columns=["b"])
    assert chosen.columns == ["b"] and "ReadSchema: struct<b:string>" in chosen._jdf.queryExecution().toString()


def test_streamed_branches_meet(spark, tmp_path):
    """Scans of one name and number meet within the watermark's time; grades are those of tables."""
    from pepweave.streaming import join_branches

    schema = "RAW_FILE string, SCAN_NUMBER long, SEQUENCE string, seen timestamp"
    rows = {"database": [("r", 1, "PEPK", "00:00"), ("r", 2, "PEPR", "00:01"), ("r", 3, "AAAK", "00:00")], "denovo": [("r", 1, "PEPK", "00:05"), ("r", 2, "PPER", "00:02"), ("r", 3, "AAAK", "00:30"), ("s", 1, "PEPK", "00:00")]}
    sides = []
    for side, r in rows.items():
        spark.createDataFrame(r, "RAW_FILE string, SCAN_NUMBER long, SEQUENCE string, t string").withColumn("seen", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "t"))).drop("t").write.parquet(str(tmp_path / side))
        sides.append(spark.readStream.schema(schema).parquet(str(tmp_path / side)))
    q = join_branches(*sides, "seen").writeStream.format("memory").queryName("met").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.SCAN_NUMBER, r.unmodified_sequence_match, r.tier) for r in spark.table("met").collect()) == [(1, True, 0), (2, False, 1)]


def test_configuration(tmp_path):
    c = Config.from_dict({"outdir": "x"}).with_overrides(["iforest_features=[a, b]", "psa_max_raw_files=3", "thermo_exe=a=b"])
    assert c.iforest_features == ["a", "b"] and c.psa_max_raw_files == 3 and c.thermo_exe == "a=b" and c.run_plotting
    c.to_yaml(tmp_path / "c.yaml")
    assert Config.from_yaml(tmp_path / "c.yaml") == c
    for bad in (lambda: Config.from_dict({"nope": 1}), lambda: c.with_overrides(["nope=1"]), lambda: c.with_overrides(["outdir"]), lambda: Config(run_rescoring=False).check(), lambda: Config(denovo_only=True).check(), lambda: Config(denovo_only=True, run_iforest=False).check(), lambda: Config(iforest_training_source="x").check(), lambda: Config().require("iforest_features")):
        with pytest.raises(ConfigError):
            bad()
    assert parse(["run", "--config", "c.yaml", "--set", "a=1", "--set", "b=2"]).overrides == ["a=1", "b=2"]


def test_raw_file_names_stay_text(spark, tmp_path):
    rows = spark.createDataFrame([("001", 1), ("1", 2), (None, 3)], "RAW_FILE string, SCAN_NUMBER long")
    sinks.write_by_raw_file(rows, str(tmp_path / "t"))
    sinks.write_by_raw_file(rows.withColumn("SCAN_NUMBER", F.lit(9).cast("long")).union(spark.createDataFrame([("2", 4)], rows.schema)), str(tmp_path / "t"), overwrite=False)
    out = readers.read_by_raw_file(spark, str(tmp_path / "t"))
    assert {(r.RAW_FILE, r.SCAN_NUMBER) for r in out.collect()} == {("001", 1), ("1", 2), (None, 3), ("2", 4)}


def test_missing_inputs(spark, tmp_path):
    assert readers.read_search(spark, str(tmp_path / "none"), "denovo").count() == 0
    assert readers.read_scores(spark, str(tmp_path / "t.txt"), None).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_parquet(spark, str(tmp_path / "none"))


def test_streamed_grades(spark, tmp_path):
    from pepweave.streaming import graded, stream_search

    write(tmp_path / "in/a.csv", DN_HEAD, [["r", 1, "PEPK", 2, 1.0, 0.5, "false", "PEPK", "1"], ["r", 2, "PEPR", 2, 1.0, 0.5, "false", "PEPR", "1"]])
    rows = stream_search(spark, str(tmp_path / "in"), "denovo").select(F.col("SEQUENCE").alias("SEQUENCE_denovo"), F.lit("PEPK").alias("SEQUENCE_database"))
    q = graded(rows).writeStream.format("memory").queryName("graded").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.SEQUENCE_denovo, r.tier) for r in spark.table("graded").collect()) == [("PEPK", 0), ("PEPR", 1)]
