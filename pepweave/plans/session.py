"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

ROOT = str(Path(__file__).resolve().parents[2])


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df to a folder that driver and executors share (spark.checkpoint.dir; on one machine a local one) and read it back, for what is read more than once."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, or on one machine a local one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pepweave-")
    return f"{base.rstrip('/')}/plans/{name}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, tasks: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Runs the tasks at the same time, each with its jobs in a scheduler pool of its name. When one fails, the jobs of the others are cancelled and its error is raised."""
    context, run = spark.sparkContext, uuid.uuid4().hex

    def one(name: str) -> T:
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(f"{run}-{name}")
        try:
            return tasks[name]()
        finally:
            context.removeJobTag(f"{run}-{name}")
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(len(tasks)) as pool:
        started = {pool.submit(inheritable_thread_target(spark)(one), name): name for name in tasks}
        wait(started, return_when=FIRST_EXCEPTION)
        failed = [f for f in started if f.done() and f.exception()]
        if failed:
            for name in tasks:
                context.cancelJobsWithTag(f"{run}-{name}")
            raise failed[0].exception()
        return {name: f.result() for f, name in started.items()}


def ship(spark: SparkSession) -> SparkSession:
    """Let local Python workers import this package wherever the driver was started; on a cluster it is installed or sent with --py-files."""
    env, known = spark.sparkContext.environment, os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if spark.sparkContext.master.startswith("local[") and ROOT not in known and ROOT not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH")) if x)
    return spark
