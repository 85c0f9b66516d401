"""Helpers that the operators share: table access, shared-folder stage tables, hashing, Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: At most this many keys can each hold a HEAVY_SHARE-th of all rows, so a table of such keys has at most so many rows.
HEAVY_SHARE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a fresh local one where it is unset and all is on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="pepweave-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives the loss of executors, fixes row identities."""
    return _written(df, name)[0]


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _collect_garbage(spark)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def passing_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A stage table that is deleted when its block is left; what the block hands on must not read it any more."""
    held, path = _written(df, name)
    try:
        yield held
    finally:
        _delete(df.sparkSession, path)


_collected = 0.0


def _collect_garbage(spark: SparkSession, every: float = 10.0) -> None:
    """Shuffles of plans that are done go when the driver collects its garbage; a long query would keep all of them until then."""
    global _collected
    if time.monotonic() - _collected > every:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _collected = time.monotonic()


def drop_stage_tables(spark: SparkSession) -> None:
    """Delete all stage tables; only for when no DataFrame that reads them is needed any more."""
    _delete(spark, f"{shared_dir(spark)}/stage")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 1 << 24) -> None:
    """Keep Arrow batches of whole texts small enough for a worker, unless the session already has sizes of its own."""
    for key, default, ours in (("maxRecordsPerBatch", "10000", rows), ("maxBytesPerBatch", "67108864b", size)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key) == default:
            spark.conf.set(key, ours)


#: Functions that forget what a worker remembers between the tasks of a stage.
STAGE_CACHES: list[Callable[[], None]] = []
_stage = None


def enter_stage() -> None:
    """In a worker's first task of another stage than before: what it remembers goes, as workers are kept for all stages."""
    global _stage
    context = TaskContext.get()
    stage = context and context.stageId()
    if stage != _stage:
        _stage = stage
        for forget in STAGE_CACHES:
            forget()
        give_back()


def give_back() -> None:
    """Free memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run: Callable) -> Callable:
    """An Arrow function of which each task ends by giving free memory back to the system: workers are kept for later tasks, which need it elsewhere."""

    def task(batches):
        enter_stage()
        yield from run(batches)
        give_back()

    return task


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges_for(df: DataFrame, each: int = 1 << 27) -> int:
    """Into how many ranges df is cut: the shuffle's width, or more where a range would hold more than so many bytes by the plan's estimate (stored files' sizes)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # an estimate over a join or an unknown source is an upper bound without meaning
    return max(shuffle_width(df.sparkSession), -(-size // each) if size < 1 << 60 else 0)


def in_fold(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes lower()'s fast path, which is the same there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in one array and the n + 1 offsets into it; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges (a, b) whose texts hold at most `most` bytes together, or one longer text alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BUCKET_BITS = 15  # one bitmap value holds 4096 bytes


def bit_count(rows: int, most: int, per_row: int = 16) -> int:
    """A power of two of bits for so many rows, at most `most`."""
    return min(most, max(1 << BUCKET_BITS, 1 << (per_row * rows).bit_length()))


def bit_table(slots: DataFrame, column: str = "slot") -> DataFrame:
    """The set bits as (bucket, bitmap) rows: one row for 32768 bits."""
    return slots.groupBy(F.shiftright(column, BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col(column).bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("bitmap")
    )


def with_bits(rows: DataFrame, slots: list[Column], bits: DataFrame, flag: str = "__maybe") -> DataFrame:
    """Adds whether all the slots' bits are set. bits: a bit_table, whose size is bounded by its number of bits, so it is broadcast."""
    found = F.lit(True)
    for k, slot in enumerate(slots):
        side = bits.select(F.col("bucket").alias(f"__bucket{k}"), F.col("bitmap").alias(f"__bitmap{k}"))
        rows = rows.withColumn(f"__slot{k}", slot)
        rows = rows.join(F.broadcast(side), F.shiftright(f"__slot{k}", BUCKET_BITS) == F.col(f"__bucket{k}"), "left")
        bit = F.col(f"__slot{k}").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))
        byte = F.conv(F.hex(F.substring(F.col(f"__bitmap{k}"), F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
        found = found & F.coalesce(is_set, F.lit(False))
    return rows.withColumn(flag, found).drop(*(f"__{c}{k}" for c in ("bucket", "bitmap", "slot") for k in range(len(slots))))


def without_ids(docs: DataFrame, id_col: str, dropped: DataFrame, max_bits: int = 1 << 28) -> DataFrame:
    """docs without the rows whose id is in dropped (column id); only rows that a bit array of bounded size points at shuffle."""
    dropped = stage_table(dropped.select("id").where("id is not null").distinct(), "dropped")
    n = dropped.count()
    if not n:
        return docs
    bits = bit_count(n, max_bits)
    table_of_bits = stage_table(bit_table(dropped.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("slot"))), "dropped-bits")
    slot = F.pmod(F.xxhash64(F.col(id_col).cast(dropped.schema["id"].dataType)), F.lit(bits))
    rows = with_bits(docs, [slot], table_of_bits)
    straight = rows.where("not __maybe").drop("__maybe")
    rest = rows.where("__maybe").drop("__maybe").join(dropped, F.col(id_col) == F.col("id"), "left_anti")
    return straight.unionByName(rest)


def shielded(docs: DataFrame, own: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named like an operator's own renamed, and how to name them back."""
    back = {f"__kept_{c}": c for c in docs.columns if c in own}
    return docs.withColumnsRenamed({c: k for k, c in back.items()}), back


def sorted_rows(df: DataFrame, keys: list[Column], order: list[Column], name: str) -> DataFrame:
    """A stage table of df with __place, a long that ascends in the order given; no task holds more than a range of it.

    keys: a coarser form of the order that the ranges are cut by; rows alike in it stay together. Places have gaps between ranges: the upper 31
    bits are the range, the lower 33 the place in it.
    """
    ranges = df.repartitionByRange(ranges_for(df), *keys).sortWithinPartitions(*order)
    return stage_table(ranges.withColumn("__place", F.monotonically_increasing_id()), name)


def ranked(df: DataFrame, group: str, order: list[str], name: str, max_broadcast: int = 100_000) -> DataFrame:
    """df with __index (from 0, ascending in the order within each value of group, null being one) and __count (of the group's rows).

    Rows are cut into ranges of (group, order), so a group that holds most rows spreads over all tasks; of each range only the counts
    by group are summed up. That table has at most as many rows as ranges and groups together; it is broadcast up to max_broadcast of them.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    held = sorted_rows(df, keys, keys, name).withColumn("__range", F.shiftright("__place", 33))
    runs = held.groupBy("__range", F.col(group).alias("__run")).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("__run").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"__before": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__count": F.sum("__n").over(Window.partitionBy("__run"))})
    runs = stage_table(runs.withColumnRenamed("__range", "__of").drop("__n"), f"{name}-ranges")
    side = F.broadcast(runs) if runs.count() <= max_broadcast else runs
    rows = held.join(side, (F.col("__range") == F.col("__of")) & F.col(group).eqNullSafe(F.col("__run")))
    return rows.withColumn("__index", F.col("__place") - F.col("__first") + F.col("__before")).drop("__place", "__range", "__of", "__run", "__first", "__before")


def numbered(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """rows with __number, from 1 within rows of equal key (null being a value), in no set order. No group is gathered: tasks number what they hold, counts by task are added up."""
    held = stage_table(rows.withColumn("__place", F.monotonically_increasing_id()), name).withColumn("__task", F.shiftright("__place", 33))
    own = {f"__of_{c}": F.col(c) for c in key}
    tasks = held.groupBy("__task", *key).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*key).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(*(c.alias(k) for k, c in own.items()), F.col("__task").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    match = F.col("__task") == F.col("__of")
    for k, c in own.items():
        match = match & c.eqNullSafe(F.col(k))
    within = F.row_number().over(Window.partitionBy(*key, "__task").orderBy("__place"))
    return held.withColumn("__within", within).join(tasks, match).withColumn("__number", F.col("__within") + F.col("__before")).drop("__place", "__task", "__of", "__before", "__within", *own)
