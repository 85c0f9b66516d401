"""Outputs (K1-K12). Stages write new folders; nothing is changed in place, inputs stay."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calls import ranked
from .readers import average_weights, exists, parse_weights, read_by_raw_file


def write_by_raw_file(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """A folder for each raw file. Without overwrite, raw files that are there whole are left alone.

    What is whole stands in a manifest, which is written when the rows are committed and put in place by a rename: folders of raw files that it
    doesn't name, as a run that broke off leaves them, are written anew. Adaptive execution splits a large raw file over tasks, and rows
    without a name likewise, by the advisory partition size."""
    spark = df.sparkSession
    done = None if overwrite else manifest(spark, path)
    if done is None:
        df.hint("rebalance", "RAW_FILE").write.partitionBy("RAW_FILE").mode("overwrite").parquet(path)
        fresh = read_by_raw_file(spark, path)
    else:
        known = done.select(F.col("RAW_FILE").alias("__done"))
        match = F.col("RAW_FILE").eqNullSafe(F.col("__done"))
        rows = df.join(known, match, "left_anti").hint("rebalance", "RAW_FILE")
        rows.write.partitionBy("RAW_FILE").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        fresh = read_by_raw_file(spark, path).join(known, match, "left_anti")
    counts = fresh.groupBy("RAW_FILE").agg(F.count("*").alias("rows"))
    part = f"{path}/{MANIFEST}/{uuid.uuid4().hex}"
    counts.coalesce(1).write.parquet(f"{part}.writing")
    fs, of = _fs(spark, path)
    fs.rename(of(f"{part}.writing"), of(f"{part}.done"))


MANIFEST = "_manifest"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The raw files that a table holds whole, with their rows; None where there is no table with a manifest."""
    if not exists(spark, f"{path}/{MANIFEST}/*.done"):
        return None
    return spark.read.schema("RAW_FILE string, rows long").parquet(f"{path}/{MANIFEST}/*.done").dropDuplicates(["RAW_FILE"])


def _fs(spark: SparkSession, path: str):
    """The path's file system and the class of its paths."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def write_errors(errors: DataFrame, folder: str) -> None:
    """The error table, in one CSV part: a row for each source, raw file and reason."""
    errors.orderBy("source", "RAW_FILE", "reason").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/errors.csv")


def write_list(df: DataFrame, path: str, single: bool = False) -> None:
    """A CSV folder of a ranked list, by goodness from the best, ties by raw file, scan and id; its parts by name are in order.

    single: one part, which one task writes."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_calls(called: DataFrame, folder: str) -> None:
    """good.csv and bad.csv; called: see calls.call_lists."""
    for call in ("GOOD", "BAD"):
        write_list(ranked(called.where(F.col("CALL") == call)).drop("CALL", "TP_GOODNESS"), f"{folder}/{call.lower()}.csv")


def write_summary(summary: DataFrame, folder: str) -> None:
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/ks_vs_tp_summary.csv")


def write_average_weights(spark: SparkSession, path: str, out_path: str, decimals: int = 4) -> tuple[list[str], list[float], list[float]]:
    """Averages of the bins' weights; a small text file either way."""
    header, norm, raw = parse_weights([r.value for r in spark.read.text(path).collect()])
    norm, raw = average_weights(norm), average_weights(raw)
    # fixed values: the file's first line and layout
    lines = ["# Average weights across all bins", "\t".join(header), *("\t".join(f"{x:.{decimals}f}" for x in w) for w in (norm, raw))]
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(("\n".join(lines) + "\n").encode()))
    out.close()
    return header, norm, raw


def log_to(path: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """The package's logger, on standard error and appending to a file."""
    logger = logging.getLogger("pepweave")
    logger.setLevel(level)
    kinds = [logging.StreamHandler(), *([logging.FileHandler(path, mode="a")] if path else [])]
    for h in kinds:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    logger.handlers = kinds
    return logger


def write_plot_data(plots: dict[str, DataFrame], folder: str) -> None:
    """A CSV folder for each figure's data."""
    for name, df in plots.items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
