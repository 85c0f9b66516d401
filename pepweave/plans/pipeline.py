"""The stages in sequence, each lazy up to the table it writes.

A branch folder holds msms/*.rescore, results/percolator/rescore.tab and scorer output beside it. Every stage writes a folder of its own
under the output folder and leaves its inputs alone: merged/<side>, scans, scored (with model), called (with lists and summary), qc.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.columns import denovo_rest, drop_columns, only_on, require_same_columns, suffixed, trusted_denovo, trusted_shared
from ..operators import calls, ecdf, forest, merge, plotdata, rescore, similarity
from ..schemas import SIDES
from ..sources import readers, sinks
from .session import ship, side_by_side, staged


@dataclass
class Outputs:
    merged: dict[str, DataFrame]
    scans: DataFrame | None = None
    scored: DataFrame | None = None
    called: DataFrame | None = None
    cutoffs: dict[str, float] | None = None


class Pipeline:
    def __init__(self, spark: SparkSession, config: Config) -> None:
        config.check()
        self.spark, self.config = ship(spark), config
        self.out = config.outdir.rstrip("/")
        self.sides = ("denovo",) if config.denovo_only else SIDES

    def read_branch(self, side: str) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame]:
        """Search rows, features without the columns to drop, scores (none in de novo only runs), and what could not be read or typed."""
        c, spark = self.config, self.spark
        c.require(f"{side}_oktoberfest_dir")
        folder = getattr(c, f"{side}_oktoberfest_dir").rstrip("/")
        tab = f"{folder}/results/percolator"
        search, errors = readers.read_search_checked(spark, f"{folder}/msms", side, staged)
        features, more = readers.read_features_checked(spark, f"{tab}/rescore.tab", f"{side} features", staged)
        features, errors = drop_columns(features, getattr(c, f"drop_columns_{side}")), errors.unionByName(more)
        decoy = f"{tab}/rescore.percolator.decoy.psms.txt" if side == "database" else None
        found = f"{tab}/rescore.percolator.psms.txt"
        if c.denovo_only:
            scores = None
        elif readers.exists(spark, found):
            scores, more = readers.read_scores_checked(spark, found, decoy, f"{side} scores", staged)
            errors = errors.unionByName(more)
        else:
            scores = self.static_scores(features) if side == "denovo" else self.own_scores(features)
        return search, features, scores, errors

    def own_scores(self, features: DataFrame) -> DataFrame:
        """Where the database branch has no scorer output: its features rescored against decoys; scores and weights are kept under the output folder."""
        c = self.config
        scores, model = rescore.rescore(staged(features, "features"), c.percolator_test_fdr, c.percolator_train_fdr, c.rescoring_seed, c.percolator_subset_max_train)
        scores.write.mode("overwrite").parquet(f"{self.out}/scores/database")
        rescore.write_weights(self.spark, model, f"{self.out}/weights/rescore.percolator.weights.csv")
        return self.spark.read.parquet(f"{self.out}/scores/database")

    def static_scores(self, features: DataFrame) -> DataFrame | None:
        """Where the de novo branch has no scorer output: its features by the database branch's weights, averaged over bins and applied by position."""
        tab = f"{self.config.database_oktoberfest_dir.rstrip('/')}/results/percolator"
        scored = readers.exists(self.spark, f"{tab}/rescore.percolator.psms.txt")
        weights = f"{tab if scored else f'{self.out}/weights'}/rescore.percolator.weights.csv"
        if not readers.exists(self.spark, weights):
            return None
        header, _, raw = sinks.write_average_weights(self.spark, weights, f"{self.out}/weights/rescore.percolator.weights.avg.csv")
        names = [x for x in features.columns if x not in ("SpecId", "Label", "ScanNr", "Peptide", "Proteins", "RAW_FILE")]
        if len(raw) - len(names) not in (0, 1):
            raise ValueError(f"{len(raw)} weights ({', '.join(header)}) for {len(names)} features ({', '.join(names)})")
        values = F.array(*(F.coalesce(F.col(f"`{x}`"), F.lit(0.0)) for x in names))
        return features.select(F.col("SpecId").alias("PSMId"), forest.weighted_score(values, raw).alias("score"), F.lit(True).alias("is_target"))

    def rescoring(self) -> dict[str, DataFrame]:
        """Both branches merged by raw file. Raw files with errors are left out of both, as half of one would look like matches of one side only."""
        parts = {s: self.read_branch(s) for s in self.sides}
        if not self.config.denovo_only:
            require_same_columns(*(parts[s][1] for s in SIDES))
        errors = staged(reduce(DataFrame.unionByName, (parts[s][3] for s in self.sides)), "errors")
        sinks.write_errors(errors, self.out)
        bad = errors.where("RAW_FILE is not null").select("RAW_FILE").distinct()
        any_bad = bool(bad.limit(1).count())

        def write(side: str) -> None:
            search, features, scores, _ = parts[side]
            if any_bad:
                search, features = (df.join(bad, "RAW_FILE", "left_anti") for df in (search, features))
            sinks.write_by_raw_file(merge.merge_branch(search, features, scores), f"{self.out}/merged/{side}")

        side_by_side(self.spark, {s: partial(write, s) for s in self.sides})
        return {s: readers.read_by_raw_file(self.spark, f"{self.out}/merged/{s}") for s in self.sides}

    def psa(self, merged: dict[str, DataFrame]) -> DataFrame:
        path = f"{self.out}/scans"
        if self.config.psa_max_raw_files:
            names = readers.raw_files(*merged.values(), first=self.config.psa_max_raw_files)
            merged = {s: readers.only_raw_files(df, names) for s, df in merged.items()}
        if self.config.denovo_only:
            scans = suffixed(merged["denovo"], "denovo").withColumns({"_merge": F.lit("denovo_only"), "SpecId": F.col("SpecId_denovo"), "sequence_match": F.lit(False), "chimeric": F.lit(False)})
        else:
            scans = similarity.with_similarity(merge.scan_table(merged["database"], merged["denovo"]))
        sinks.write_by_raw_file(scans, path, overwrite=self.config.overwrite_outputs)
        return readers.read_by_raw_file(self.spark, path)

    def iforest(self, scans: DataFrame) -> DataFrame:
        c = self.config
        c.require("iforest_features")
        path = (c.iforest_output_dir or self.out).rstrip("/")
        rows = forest.training_candidates(scans, c.iforest_training_source, c.iforest_denovo_score_threshold)
        nodes, model = forest.fit(forest.training_set(rows, c.iforest_training_source), c.iforest_features, c.iforest_seed)
        forest.save(nodes, model, f"{path}/model")
        raw = f"{path}/scored_raw"
        forest.score_sides(scans, model, c.iforest_features, self.sides).write.mode("overwrite").parquet(raw)
        forest.rescaled(self.spark.read.parquet(raw), self.sides).write.mode("overwrite").parquet(f"{path}/scored")
        return self.spark.read.parquet(f"{path}/scored")

    def conditions(self) -> tuple[dict, dict]:
        """By side, which scores are the reference and which are held against it."""
        if self.config.denovo_only:
            t = self.config.iforest_denovo_score_threshold
            return {"denovo": trusted_denovo(t)}, {"denovo": denovo_rest(t)}
        return dict.fromkeys(SIDES, trusted_shared()), {s: only_on(s) for s in SIDES}

    def populations(self, scored: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Reference and other scores of each side."""
        return tuple(ecdf.side_scores(scored, c) for c in self.conditions())

    def postprocess(self, scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
        missing = [f"ISO_scores_{s}" for s in self.sides if f"ISO_scores_{s}" not in scored.columns]
        if missing:
            raise ValueError(f"score first: columns {missing} are missing")
        scored, found = ecdf.graded(scored, *self.conditions())
        cutoffs = {s: v["statistic_location"] for s, v in found.items()}
        path = f"{(self.config.iforest_output_dir or self.out).rstrip('/')}/called"
        scored.write.mode("overwrite").parquet(f"{path}/scans")
        scored = self.spark.read.parquet(f"{path}/scans")
        names = {"denovo": "trusted_denovo vs rest"} if self.config.denovo_only else {s: f"trusted_shared vs {s}_only" for s in SIDES}
        sinks.write_summary(ecdf.summary(self.spark, found, names), path)
        lists = calls.denovo_call_lists(scored, cutoffs["denovo"]).withColumn("TP", F.col("TP_GOODNESS")) if self.config.denovo_only else calls.call_lists(scored, cutoffs)
        if self.config.denovo_only:
            for call in ("GOOD", "BAD"):
                sinks.write_list(calls.ranked(lists.where(F.col("CALL") == call)).drop("CALL", "TP"), f"{path}/{call.lower()}.csv")
        else:
            sinks.write_calls(lists, path)
        return scored, cutoffs

    def plotting(self, called: DataFrame, cutoffs: dict[str, float] | None = None) -> dict[str, DataFrame]:
        reference, other = self.populations(called)
        if cutoffs is None:
            cutoffs = {s: v["statistic_location"] for s, v in ecdf.ks_cutoffs(reference, other, dict.fromkeys(self.sides, "")).items()}
        plots = plotdata.denovo_plots(called, reference, other) if self.config.denovo_only else plotdata.all_plots(called, cutoffs, reference, other)
        sinks.write_plot_data(plots, f"{self.out}/qc")
        return plots

    def existing(self, *names: str) -> DataFrame:
        """The first table that an earlier run has left."""
        self.config.require("grove_forest_dir")
        base = self.config.grove_forest_dir.rstrip("/")
        for n in names:
            if readers.exists(self.spark, f"{base}/{n}"):
                return readers.read_by_raw_file(self.spark, f"{base}/{n}")
        raise FileNotFoundError(f"none of {', '.join(names)} in {base}")

    def run(self) -> Outputs:
        c, out = self.config, Outputs({})
        if c.run_rescoring:
            out.merged = self.rescoring()
        if c.run_psa:
            out.scans = self.psa(out.merged)
        if c.run_iforest:
            out.scored = self.iforest(out.scans if out.scans is not None else self.existing("scans"))
        if c.run_postprocess:
            out.called, out.cutoffs = self.postprocess(out.scored if out.scored is not None else self.existing("scored", "scans"))
        if c.run_plotting:
            # figures need scores only; cutoffs are found again where no decision stage has run
            known = next((x for x in (out.called, out.scored) if x is not None), None)
            self.plotting(known if known is not None else self.existing("called/scans", "scored"), out.cutoffs)
        return out

