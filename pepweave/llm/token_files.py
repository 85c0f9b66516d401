"""Token-ID output: tokenise documents, write them as files of rANS segments in ascending id order, and read the files back.

Rows are dealt by ranges of the id, so file group k holds smaller ids than group k + 1; each task encodes its range in order and
cuts it into segments of about SEGMENT tokens, each with its own frequency table (see rans). A segment is a file
<group>-<segment>-<tokens of the group before it>.rans: the task writes it under another name and renames it when it is whole. A task that
is run again makes the same bytes under the same names, so lost executors and retries do no harm. Tasks return a row for each file
(the manifest), which Spark commits; files are read by Spark's binary source, and where a group starts follows from the manifest.

Workers write to file systems that pyarrow knows (local or shared folders, HDFS, object stores); where it does not know that of the
folder, segments are kept as rows of a Parquet dataset, with the same bytes. Decoding is one task per group of segments.

Defined cases: null text is empty, so the document is its end id alone; null ids come first; rows alike are all
written; the order of rows with one id is that of their text hashes; columns other than the two are ignored, whatever their names; a
text of any length is one document, encoded whole; an empty table gives no file and no rows.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rans
from .common import ranges_for, shared_dir, stage_table
from .tokenizing import encoder

SEGMENT = 1 << 20
SEGMENT_SCHEMA = "file int, segment int, start_in_file long, n_docs int, n_tokens long, data binary"


def _store(folder: str):
    """The file system of a qualified folder, and the folder's path there; None if pyarrow knows none."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    try:
        return fs.FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None


def _put(folder: str, name: str, data: bytes) -> None:
    """A whole file or none, whoever else writes the same one."""
    store, base = _store(folder)
    part = f"{base}/_{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(data)
    try:
        store.move(part, f"{base}/{name}")
    except OSError:  # some file systems don't rename over a file: another attempt has written the same bytes
        if store.get_file_info(f"{base}/{name}").size != len(data):
            raise
        store.delete_file(part)


def write_segments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, files: int | None = None, folder: str | None = None) -> DataFrame:
    """The segments (SEGMENT_SCHEMA), lazily; write the result where it shall stay. tokenizer: a path, by default the public byte-level one.

    folder: qualified; tasks write each segment as a file there and return its name as data."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(files or ranges_for(rows), *order).sortWithinPartitions(*order)

    def run(batches):
        enc, end, file = encoder(tokenizer), np.array([end_id], np.uint32), TaskContext.get().partitionId()
        ids, tokens, segment, start, held = [], [], 0, 0, 0

        def cut():
            nonlocal segment, start, held
            lengths, flat = np.array([len(t) for t in tokens], np.uint32), np.concatenate(tokens)
            data = rans.write_segment(ids, lengths, flat)
            if folder:
                name = f"{file:06d}-{segment:06d}-{start:012d}.rans"
                _put(folder, name, data)
                data = name.encode()
            row = (file, segment, start, len(ids), len(flat), data)
            segment, start, held = segment + 1, start + len(flat), 0
            ids.clear(), tokens.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["file", "segment", "start_in_file", "n_docs", "n_tokens", "data"])

        for batch in batches:
            for i, found in zip(batch.column(0).to_pylist(), enc.each(text.as_py() or "" for text in batch.column(1)), strict=True):
                ids.append(i)
                tokens.append(np.concatenate([found, end]))
                held += len(tokens[-1])
                if held >= SEGMENT:
                    yield cut()
        if ids:
            yield cut()

    return rows.mapInArrow(run, SEGMENT_SCHEMA)


def read_documents(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """Decode: per document doc_id, start (tokens of all before it), n_tokens, ids_crc32, and ids if asked for."""
    totals = segments.groupBy("file").agg(F.sum("n_tokens").alias("n"))  # a row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    return _decoded(segments.join(F.broadcast(starts), "file").select((F.col("file_start") + F.col("start_in_file")).alias("start"), "data"), with_ids)


def read_files(folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """read_documents of the files in a folder. manifest: what write_segments gave for it."""
    name = F.element_at(F.split("path", "/"), -1)
    part = F.split(name, "[-.]")
    files = manifest.sparkSession.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.rans").load(folder)
    segments = files.select(part[0].cast("int").alias("file"), part[2].cast("long").alias("start_in_file"), F.col("content").alias("data"))
    totals = manifest.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))  # a row per range of ids, of which there are `files`
    return _decoded(segments.join(F.broadcast(starts), "file").select((F.col("file_start") + F.col("start_in_file")).alias("start"), "data"), with_ids)


def _decoded(rows: DataFrame, with_ids: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for first, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, lengths, flat = rans.read_segment(data.as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                parts = np.split(flat, ends[:-1])
                columns = [pa.array(ids, pa.int64()), pa.array(first + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def write_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, files: int | None = None) -> tuple[str, DataFrame] | None:
    """Write docs as files of a new folder; gives its qualified path and the manifest. None where workers can't write there."""
    spark = docs.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = system.makeQualified(target).toString()
    if _store(folder) is None:
        return None
    system.mkdirs(target)
    return folder, stage_table(write_segments(docs, tokenizer=tokenizer, end_id=end_id, files=files, folder=folder), "token-manifest")


def export_segments(segments: DataFrame, folder: str) -> None:
    """Each segment as a file <file>-<segment>.rans of a folder that the driver can write; streams one at a time."""
    import os

    os.makedirs(folder, exist_ok=True)
    for row in segments.orderBy("file", "segment").toLocalIterator():
        with open(f"{folder}/{row.file:06d}-{row.segment:06d}.rans", "wb") as f:
            f.write(row.data)


def encode_and_read(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Per document doc_id, start, n_tokens, ids_crc32, read back from files in the shared folder."""
    written = write_files(docs, f"{shared_dir(docs.sparkSession)}/stage/token-files-{uuid.uuid4().hex}", tokenizer, end_id)
    if written is None:
        return read_documents(stage_table(write_segments(docs, tokenizer=tokenizer, end_id=end_id), "tokens"))
    return read_files(*written)
