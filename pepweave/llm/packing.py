"""Best-fit packing by large-item matching.

Each document becomes pieces of at most `room` tokens. Piece lengths are whole numbers up to `room`, so the plan is made
on their histogram, at most `room` numbers whatever the input: pieces above a third of the room meet at most twice in a
sequence, so the longest takes the longest partner that fits; then shorter ones, longest first, go where they leave the
least gap. The plan is a list of sequence patterns with multiplicities. Pieces of one length are interchangeable; the
n-th of them takes the n-th place that the plan has for that length. The n-th is found without a sort: the task that
tokenises counts within itself, and prefix sums over (task, length) give the rest.

Defined cases: null text is empty, so the document is its end id alone; rows alike are all packed; a document longer
than the room is cut, its first piece taking the remainder; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, stage_table
from .tokenizing import encoder

ROOM = 1024
END_ID = 2


def plan(histogram: dict[int, int], room: int = ROOM) -> list[tuple[int, list[int]]]:
    """(multiplicity, lengths in one sequence) patterns that hold all pieces of the histogram {length: count}."""
    left = {s: c for s, c in histogram.items() if c}
    bins: dict[int, list[list]] = defaultdict(list)  # gap: [[count, pattern]]
    large = sorted((s for s in left if 3 * s > room), reverse=True)
    for s in large:
        while left[s]:
            mate = next((t for t in large if t <= s and left[t] - (t == s) > 0 and s + t <= room), 0)
            n = min(left[s] // 2, left[s]) if mate == s else min(left[s], left[mate]) if mate else left[s]
            left[s] -= n
            if mate:
                left[mate] -= n
            bins[room - s - mate].append([n, [s, mate] if mate else [s]])
    for s in sorted((s for s in left if 3 * s <= room), reverse=True):
        while (c := left[s]) > 0:
            gap = next((g for g in range(s, room + 1) if bins.get(g)), None)
            if gap is None:
                bins[room].append([-(-c // (room // s)), []])
                continue
            group = bins[gap].pop()
            each = gap // s
            n, rest = divmod(c, each)
            if n >= group[0]:
                n, rest = group[0], 0
            if n:
                bins[gap - each * s].append([n, group[1] + [s] * each])
            if rest:
                bins[gap - rest * s].append([1, group[1] + [s] * rest])
            if group[0] > n + bool(rest):
                bins[gap].append([group[0] - n - bool(rest), group[1]])
            left[s] -= n * each + rest
    return [(n, p) for groups in bins.values() for n, p in groups if p]


def places(patterns: list[tuple[int, list[int]]]) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """For each length: the first rank, sequence and offset of each of its runs of places; and the number of sequences."""
    runs, taken, sequence = defaultdict(list), defaultdict(int), 0
    for n, lengths in patterns:
        offset = 0
        for s in lengths:
            runs[s].append((taken[s], sequence, offset))
            taken[s] += n
            offset += s
        sequence += n
    return {s: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for s, r in runs.items()}, sequence


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, room: int = ROOM) -> DataFrame:
    """Tokenise and cut: doc_id, piece, start, length, ids_crc32, task, nth (of this length in the task)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        enc, end, task, seen = encoder(tokenizer), np.array([end_id], np.uint32), TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
        for batch in batches:
            row, out = [], []
            for k, found in enumerate(enc.each(text.as_py() or "" for text in batch.column(1))):
                ids = np.concatenate([found, end])
                cuts = [0, *range(len(ids) % room or room, len(ids) + 1, room)] if len(ids) > room else [0, len(ids)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    row.append(k)
                    out.append((p, a, b - a, zlib.crc32(ids[a:b]), task, seen[b - a]))
                    seen[b - a] += 1
            if out:
                columns = [batch.column(0).take(pa.array(row)), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return rows.mapInArrow(released(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, room: int = ROOM, max_broadcast: int = 100_000) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The table of prefix sums has a row for each length that a task has; it is broadcast up to max_broadcast of them. Counts are taken
    anew where they are needed: as a stage table they would be a small file for each partition of a shuffle."""
    cut = stage_table(pieces(docs, id_col, text_col, tokenizer, end_id, room), "pieces")
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    totals = counts.groupBy("length").agg(F.sum("n"), F.count("*")).collect()  # at most `room` rows
    where, _ = places(plan({r[0]: r[1] for r in totals}, room))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    if sum(r[2] for r in totals) <= max_broadcast:
        first = F.broadcast(first)
    rows = cut.join(first, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))

    def run(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                ranks, sequences, offsets = where[int(s)]
                at = np.nonzero(length == s)[0]
                k = np.searchsorted(ranks, rank[at], "right") - 1
                sequence[at], offset[at] = sequences[k] + rank[at] - ranks[k], offsets[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
