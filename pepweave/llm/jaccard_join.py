"""N-gram Jaccard self-join: a blocked sparse product of the document by shingle incidence, bounded by set sizes.

Sets of distinct word shingles link where percent * union <= 100 * intersection. The steps:

1. One scan counts shingles in a sketch whose size grows with the text, up to 2^SKETCH_BITS[1] counters (an upper bound of each
   one's frequency, over all documents), and fingerprints each set; documents of one set are one class from here on.
2. A second scan orders each set by (frequency class, hash) and keeps its prefix: two sets that link share a shingle of
   their prefixes. Shingles of one document only are dropped in sorted runs of the shuffled incidence; frequent ones
   are salted, so no run is large.
3. Stars first, in a few turns: each shingle's documents are compared to one of another component. Verified links join
   components, so a group of near copies needs some comparisons for each member, not their square.
4. Then the product proper, of the incidence of components that meet: tasks take blocks of it by shingle, add up overlap counts
   of pairs of documents over their shingles, and leave out pairs where too few shingles follow on either side for the bound that their sizes
   give. Counts of all tasks are added up, pairs below the bound discarded, and the rest verified on whole sets, block by block. No link
   is lost: a pair that this step leaves out is in one component already. Rows of a frequent shingle are cut into bands of size and number of
   shingles that follow; the bound is tested once for two bands, at their loosest corner, and only bands that pass meet, dealt
   over pairs of blocks.

Sets travel only for documents of pairs to be verified: a scan makes them, filtered by a bit array of bounded size.
Links and components stay distributed; the driver sees the sketch and the bit array only. A sketch takes four bytes a counter in a task
and one in the driver and the broadcast: 4 and 1 MB up to about 1 GB of text, 256 and 64 MB at most. A text of any length is
hashed in pieces of about 1 MB; its set takes about 40 bytes a word.

Defined cases: null or empty texts and those without words have no shingle and link with nothing; with fewer words than
the width the whole sequence is the one shingle; a null id is returned with a null component and links with nothing; rows
of one id are one node; rows alike are in one class; of documents that might stand for others the least id does; columns other than
the two are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HEAVY_SHARE, bit_count, bit_table, mix64, passing_table, released, slices, stage_table, text_bytes, with_bits
from .components import connected_components

WIDTH = 5
PERCENT = 80
SLICE = 1 << 20
SKETCH_BITS = (20, 26)  # at least and at most
PER_COUNTER = 1 << 10  # bytes of text
SKETCH_BLOCKS = 64
SKETCH_SALTS = 16  # tasks that first add up a block's counters, each those of some of the tasks that counted
BLOCK = 1024
SMALL = 64  # rows of a block whose pairs are made together with those of others
PAIRS = 1 << 20  # that a task holds at once
FILTER_BITS = 1 << 28
STARS = 4

_M = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _M and of its inverse modulo 2^64, up to n."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = -(-n // 65536) * 65536  # whole steps, so that it seldom grows
        inverse = pow(_M, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers = tuple(np.concatenate([[np.uint64(1)], np.full(size, m, np.uint64)]).cumprod() for m in (_M, inverse))
    return _powers


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, with A-Z lower-cased, and the first word of each text (and the number of words)."""
    b = _LOWER[data]
    solid = ~_SPACE[b]
    first = np.zeros(len(b) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    starts, ends = np.nonzero(start)[0], np.nonzero(last)[0]
    power, inverse = _tables(len(b) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[b] * power[: len(b)], dtype=np.uint64)])
    h = (sums[ends + 1] - sums[starts]) * inverse[starts]
    return mix64(h + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def long_word_hashes(data: np.ndarray) -> np.ndarray:
    """The same of one text of any length: pieces end with a blank after SLICE bytes."""
    found, at = [], 0
    while at < len(data):
        end = at + SLICE
        while end < len(data) and not (blank := _SPACE[data[end : end + SLICE]]).any():
            end += SLICE
        end = min(len(data), end + int(blank.argmax()) if end < len(data) else end)
        found.append(word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(found)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH):
    """The sorted distinct shingle hashes of each text, in turn."""
    for a, b in slices(offsets, SLICE):
        if offsets[b] - offsets[a] > SLICE:
            words = long_word_hashes(data[offsets[a] : offsets[b]])
            bounds = np.array([0, len(words)])
        else:
            words, bounds = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        if len(words) >= width:
            grams = words[: len(words) - width + 1].copy()
            for k in range(1, width):
                grams *= np.uint64(_M)
                grams += words[k : len(words) - width + 1 + k]
            grams = mix64(grams)
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if hi - lo >= width:
                yield np.unique(grams[lo : hi - width + 1])
            elif hi > lo:
                h = int.from_bytes(blake2b(words[lo:hi].tobytes(), digest_size=8).digest(), "little")
                yield np.array([h], np.uint64)
            else:
                yield words[:0]


def least_overlap(a, b, percent: int = PERCENT):
    """The least intersection with which sets of these sizes link."""
    return (percent * (a + b) + 100 + percent - 1) // (100 + percent)


def prefix_length(n, percent: int = PERCENT):
    return n - (percent * n + 99) // 100 + 1


def sketch_bits(text_bytes: int) -> int:
    return min(SKETCH_BITS[1], max(SKETCH_BITS[0], (text_bytes // PER_COUNTER).bit_length()))


def _fingerprints(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """Per row: id, n, fp; and sketch rows (block, counts) with a null fp."""

    def run(batches):
        sketch = np.zeros(1 << bits, np.uint32)
        none = pa.nulls
        for batch in batches:
            sizes, prints, held = [], [], []
            for s in shingle_sets(*text_bytes(batch.column(1)), width):
                sizes.append(len(s))
                prints.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                held.append(s)
            n = len(sizes)
            if n:
                np.add.at(sketch, (np.concatenate(held) & np.uint64(len(sketch) - 1)).astype(np.int64), np.uint32(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), none(n, pa.int32()), none(n, pa.binary())], names=["id", "n", "fp", "block", "counts"])
        blocks = sketch.reshape(sketch_blocks(len(sketch)), -1)
        rows = [(k, zlib.compress(b.tobytes(), 1)) for k, b in enumerate(blocks) if b.any()]
        if rows:
            k, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([none(len(k), pa.int64()), none(len(k), pa.int64()), none(len(k), pa.binary()), pa.array(k, pa.int32()), pa.array(c, pa.binary())], names=["id", "n", "fp", "block", "counts"])

    return docs.mapInArrow(released(run), "id long, n long, fp binary, block int, counts binary")


def _sketch(prints: DataFrame, bits: int) -> np.ndarray:
    """Logarithms of the summed counters, in fifths of a power of two; one byte a counter reaches the driver."""
    def added(kind, finish):
        """Adds up counters (of this kind) of equal blocks, which come one after another."""

        def total(batches):
            block, held = None, None

            def done():
                return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(finish(held).tobytes(), 1)], pa.binary())], names=["block", "counts"])

            for batch in batches:
                for b, c in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    counts = np.frombuffer(zlib.decompress(c.as_py()), kind)
                    if b != block:
                        if held is not None:
                            yield done()
                        block, held = b, np.zeros(len(counts), np.int64)
                    held += counts
            if held is not None:
                yield done()

        return released(total)

    # in two steps, so that a block's counters from very many tasks are not added up by one
    rows = prints.where("block is not null").select("block", "counts", F.pmod(F.spark_partition_id(), F.lit(SKETCH_SALTS)).alias("salt"))
    some = rows.repartition("block", "salt").sortWithinPartitions("block", "salt").select("block", "counts").mapInArrow(added(np.uint32, np.asarray), "block int, counts binary")
    every = some.repartition("block").sortWithinPartitions("block").mapInArrow(added(np.int64, _levels), "block int, counts binary")
    out = np.zeros((sketch_blocks(1 << bits), (1 << bits) // sketch_blocks(1 << bits)), np.uint8)
    for r in every.collect():
        out[r.block] = np.frombuffer(zlib.decompress(r.counts), np.uint8)
    return out.reshape(-1)


def _levels(counts: np.ndarray) -> np.ndarray:
    return (5 * np.log2(counts + 1.0)).astype(np.uint8)


def sketch_blocks(counters: int) -> int:
    """Into how many blocks so many counters are dealt: more of them where there are more."""
    return max(SKETCH_BLOCKS, counters >> 16)


def _incidence(docs: DataFrame, sketch: np.ndarray, hot_from: int, width: int, percent: int) -> DataFrame:
    """The prefix incidence: item, node, size, rest (items of the set that come after), salt (0, or for frequent items one of many)."""
    level, hot_from = docs.sparkSession.sparkContext.broadcast(zlib.compress(sketch.tobytes(), 1)), int(5 * np.log2(hot_from + 1.0))

    def run(batches):
        classes = np.frombuffer(zlib.decompress(level.value), np.uint8)
        mask, seen = np.uint64(len(classes) - 1), set()
        for batch in batches:
            items, nodes, sizes, rests, salts = [], [], [], [], []
            for node, s in zip(batch.column(0).to_pylist(), shingle_sets(*text_bytes(batch.column(1)), width), strict=True):
                if node is None or not len(s):
                    continue
                fp = blake2b(s.tobytes(), digest_size=16).digest()
                if fp in seen:  # the class has been told of by this task
                    continue
                seen.add(fp)
                at = (s & mask).astype(np.int64)
                key = (classes[at] // 5).astype(np.uint64) << np.uint64(58) | s >> np.uint64(6)
                p = prefix_length(len(s), percent)
                best = np.argpartition(key, p - 1)[:p] if p < len(s) else np.arange(len(s))
                best = best[np.argsort(key[best])]
                items.append(s[best].view(np.int64))
                nodes.append(np.full(p, node, np.int64))
                sizes.append(np.full(p, len(s), np.int32))
                rests.append(np.arange(len(s) - 1, len(s) - 1 - p, -1, np.int32))
                salts.append(np.where(classes[at[best]] >= hot_from, 1 + (node * 2654435761 >> 7) % 1021, 0).astype(np.int32))
            if items:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (items, nodes, sizes, rests, salts)], names=["item", "node", "size", "rest", "salt"])

    return docs.mapInArrow(released(run), "item long, node long, size int, rest int, salt int")


def _shared(incidence: DataFrame) -> DataFrame:
    """Without the items of one row; frequent items stay anyway."""
    rows = incidence.repartition("item", "salt").sortWithinPartitions("item", "salt")

    def run(batches):
        pending = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            item, salt = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            same = (item[1:] == item[:-1]) & (salt[1:] == salt[:-1])
            keep = salt > 0
            keep[1:] |= same
            keep[:-1] |= same
            if last == (item[0], salt[0]):
                keep[0] = True
                if pending is not None:
                    yield pending
            pending, last = None, (item[-1], salt[-1])
            if not keep[-1]:
                pending = batch.slice(batch.num_rows - 1).select([0, 1, 2, 3])
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep))

    return rows.mapInArrow(released(run), "item long, node long, size int, rest int")


def _sets(docs: DataFrame, nodes: DataFrame, width: int, max_bits: int = FILTER_BITS) -> DataFrame:
    """node, items (sorted 8-byte hashes) of those nodes, and of few others: a scan that a bit array of bounded size filters before Python."""
    bits = bit_count(nodes.count(), max_bits)

    def slot(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    table_of_bits = stage_table(bit_table(nodes.select(slot("node").alias("slot"))), "node-bits")
    rows = with_bits(docs.where("id is not null"), [slot("id")], table_of_bits).where("__maybe").select("id", "text")

    def run(batches):
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(*text_bytes(batch.column(1)), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "items"])

    return rows.mapInArrow(released(run), "node long, items binary")


def overlaps(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Intersection sizes of pairs of sorted sets: the product of two blocks of incidence rows, restricted to the pairs."""
    rows = [np.frombuffer(x, np.uint64) for x in (*left, *right)]
    pair = np.repeat(np.tile(np.arange(len(left)), 2), [len(r) for r in rows])
    items = np.concatenate(rows)
    order = np.lexsort((items, pair))
    items, pair = items[order], pair[order]
    hit = (items[1:] == items[:-1]) & (pair[1:] == pair[:-1])
    return np.bincount(pair[1:][hit], minlength=len(left))


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of a stage table that link; another scan of docs makes the sets of their nodes."""
    nodes = stage_table(pairs.select("a").union(pairs.select("b")).distinct().toDF("node"), "nodes")

    def run(batches):
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            total = np.cumsum([len(x) + len(y) for x, y in zip(left, right, strict=True)])
            keep = np.zeros(len(left), bool)
            for a, b in slices(np.concatenate([[0], total]), 1 << 24):
                na, nb = (np.array([len(x) // 8 for x in side[a:b]]) for side in (left, right))
                keep[a:b] = overlaps(left[a:b], right[a:b]) >= np.maximum(1, least_overlap(na, nb, percent))
            yield batch.select([0, 1]).filter(pa.array(keep))

    with passing_table(_sets(docs, nodes, width), "sets") as sets:
        rows = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("items").alias("sb")), "b").select("a", "b", "sa", "sb")
        return stage_table(rows.mapInArrow(released(run), "a long, b long"), "links")


def _mixed(rows: DataFrame) -> DataFrame:
    """Only items whose rows are of more than one component, with their number of rows."""
    with passing_table(rows, "incidence") as rows:
        items = rows.groupBy("item").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("nodes")).where("lo <> hi").select("item", "nodes")
        return stage_table(rows.drop("nodes").join(items, "item"), "mixed")


def may_link(size: tuple[str, str], rest: tuple[str, str], percent: int) -> Column:
    """Whether sets of these sizes that share an item with so many others after it may link: at most all before it in either, it, and all after it in either are shared."""
    before = F.least(*(F.col(n).cast("long") - F.col(r) - 1 for n, r in zip(size, rest, strict=True)))
    most = before + 1 + F.least(*rest)
    return (100 * F.least(*size).cast("long") >= percent * F.greatest(*size).cast("long")) & (most * (100 + percent) >= percent * (F.col(size[0]).cast("long") + F.col(size[1])))


def enough(k, large, total, percent: int):
    """Whether an overlap of k in both prefixes can do for sets that add up to total, the larger of size large; of columns or arrays.

    All items that both prefixes of a pair that links share are in k, and the others are in the longer rest, of ceil(percent * large / 100) - 1 items."""
    ceil = percent * large + 99
    return (100 * k + ceil - ceil % 100 - 100) * (100 + percent) >= 100 * percent * total


def _dealt(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """Rows of the incidence with the key of the block that they meet in, and their side there (0 or 1; -1 where all rows of a block meet)."""
    own = ["node", "size", "rest", "component", "left"]
    cold = rows.where(F.col("nodes") <= block).select(F.col("item").alias("key"), F.lit(-1).alias("side"), *own)
    hot = rows.where(F.col("nodes") > block)
    if not hot.limit(1).count():
        return cold
    hot = hot.withColumns({"size": F.col("size").cast("long"), "rest": F.col("rest").cast("long")}).withColumns({"sb": F.floor(F.log("size") / float(np.log(1.05))).cast("int"), "lb": F.floor(F.log("left") / float(np.log(1.25))).cast("int")})
    hot = stage_table(hot.drop("nodes"), "frequent-items")
    bands = hot.groupBy("item", "sb", "lb").agg(F.count("*").alias("n"), F.min("size").alias("s0"), F.max("size").alias("s1"), F.max("left").alias("l"), F.max("rest").alias("r"), F.max(F.col("size") - F.col("rest")).alias("f"))
    bands = stage_table(bands.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "bands")
    other = bands.select("item", *(F.col(c).alias(c + "2") for c in bands.columns if c != "item"))
    near = (100 * F.col("s1") >= percent * F.col("s02")) & (100 * F.col("s12") >= percent * F.col("s0"))
    least = F.col("s0") + F.col("s02")
    shared = (F.least("f", "f2") + F.least("r", "r2")) * (100 + percent) >= percent * least
    ordered = (F.col("sb") < F.col("sb2")) | (F.col("sb") == F.col("sb2")) & (F.col("lb") <= F.col("lb2"))
    met = bands.join(other, "item").where(ordered & near & shared & enough(F.least("l", "l2"), F.greatest("s1", "s12"), least, percent))
    met = stage_table(met.select("item", "sb", "lb", "blocks", "sb2", "lb2", "blocks2"), "band-pairs")
    band, same = ["item", "sb", "lb"], (F.col("sb") == F.col("sb2")) & (F.col("lb") == F.col("lb2"))

    def key(p, q):
        return F.xxhash64("item", "sb", "lb", "sb2", "lb2", p, q).alias("key")

    def at(blocks):
        return F.pmod(F.xxhash64("node"), blocks).cast("int")

    def over(blocks):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    first = hot.join(met.where(~same), band).withColumn("b", at(F.col("blocks"))).withColumn("x", over("blocks2")).select(key("b", "x"), F.lit(0).alias("side"), *own)
    second = hot.withColumnsRenamed({"sb": "sb2", "lb": "lb2"}).join(met.where(~same), ["item", "sb2", "lb2"]).withColumn("b", at(F.col("blocks2"))).withColumn("x", over("blocks")).select(key("x", "b"), F.lit(1).alias("side"), *own)
    inner = hot.join(met.where(same), band).withColumn("b", at(F.col("blocks"))).withColumn("x", over("blocks"))
    inner = inner.select(key(F.least("b", "x"), F.greatest("b", "x")), F.when(F.col("b") == F.col("x"), -1).when(F.col("b") < F.col("x"), 0).otherwise(1).alias("side"), *own)
    return cold.unionByName(first).unionByName(second).unionByName(inner)


def block_pairs(starts: np.ndarray, ends: np.ndarray, step: int = 256):
    """All pairs of places (i < j) of runs of rows that follow each other, some at a time: those of short runs together, those of long ones by rows."""
    sizes = ends - starts
    few = sizes <= SMALL
    i = np.nonzero(np.repeat(few, sizes))[0]
    end = np.repeat(ends[few], sizes[few])
    for d in range(1, SMALL):
        on = i + d < end
        i, end = i[on], end[on]
        if not len(i):
            break
        yield i, i + d
    for a, b in zip(starts[~few].tolist(), ends[~few].tolist(), strict=True):
        for x in range(a, b, step):
            i, j = np.arange(x, min(x + step, b)), np.arange(x, b)
            on = j[None] > i[:, None]
            yield np.broadcast_to(i[:, None], on.shape)[on], np.broadcast_to(j[None], on.shape)[on]


def add_up(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(a, b, count, rest, total, large) of each pair (a, b) once: counts added up, the least rest."""
    a, b, c, r, total, large = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((b, a))
    a, b, c, r, total, large = (x[order] for x in (a, b, c, r, total, large))
    new = np.nonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))[0]
    return a[new], b[new], np.add.reduceat(c, new), np.minimum.reduceat(r, new), total[new], large[new]


def product_pairs(rows: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """rows: item, node, size, rest (items of the set that come after), component, left (of the node's rows from here on), nodes (rows of
    the item). Gives pairs (a, b) of nodes of different components whose overlap may reach the bound of their sizes.

    A pair is counted at the shared items that enough rows follow on both sides; these come first in an order which is the same for all nodes,
    so what it shares beyond the counted items is no more than what follows the last of them on either side."""
    dealt = _dealt(rows, percent, block).repartition("key").sortWithinPartitions("key")
    names = ["a", "b", "c", "r", "total", "large"]

    def run(batches):
        held: list[pa.RecordBatch] = []
        parts, n = [], 0

        def out(x):
            return pa.RecordBatch.from_arrays([pa.array(v) for v in x], names=names)

        def multiply(t: pa.Table):
            key, side, node, size, rest, component, left = (t.column(k).to_numpy().astype(np.int64) for k in range(7))
            cut = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
            for i, j in block_pairs(cut, np.append(cut[1:], len(key))):
                on = (component[i] != component[j]) & ((side[i] < 0) | (side[i] != side[j]))
                i, j = i[on], j[on]
                small, large = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
                most = np.minimum(size[i] - rest[i], size[j] - rest[j]) + np.minimum(rest[i], rest[j])
                k = np.minimum(left[i], left[j])
                on = (100 * small >= percent * large) & (most * (100 + percent) >= percent * (small + large)) & enough(k, large, small + large, percent)
                i, j = i[on], j[on]
                if len(i):
                    yield np.minimum(node[i], node[j]), np.maximum(node[i], node[j]), np.ones(len(i), np.int64), k[on] - 1, (small + large)[on], large[on]

        def full(last: bool):
            """Adds up what the held blocks give; hands out counts when there are many."""
            nonlocal parts, n, held
            if held:
                for x in multiply(pa.Table.from_batches(held)):
                    parts.append(x)
                    n += len(x[0])
                    if n >= PAIRS:
                        parts = [add_up(parts)]
                        n = len(parts[0][0])
                        if n >= PAIRS // 2:
                            yield out(parts[0])
                            parts, n = [], 0
            held = []
            if last and parts:
                yield out(add_up(parts))

        many, key = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            if many >= 1 << 15:
                # the last run may go on
                cut = int((np.nonzero(keys[1:] != keys[:-1])[0] + 1).max(initial=0))
                if cut or key != keys[0]:
                    held.append(batch.slice(0, cut))
                    yield from full(False)
                    batch, many = batch.slice(cut), 0
            held.append(batch)
            many, key = many + batch.num_rows, keys[-1]
        yield from full(True)

    counts = dealt.mapInArrow(released(run), "a long, b long, c long, r long, total long, large long")
    counts = counts.groupBy("a", "b").agg(F.sum("c").alias("c"), F.min("r").alias("r"), F.max("total").alias("total"), F.max("large").alias("large"))
    return counts.where(enough(F.col("c") + F.col("r"), F.col("large"), F.col("total"), percent)).select("a", "b")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Per row (id, n, fp), and (node, component) of nodes that link with others of another set."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    bits = sketch_bits(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    prints = stage_table(_fingerprints(docs, width, bits), "fingerprints")
    rows = prints.where("block is null").select("id", "n", "fp")
    sketch = _sketch(prints, bits)
    hot_from = int(2 * 2 ** (np.median(sketch) / 5)) + max(64, rows.count() // HEAVY_SHARE)
    with passing_table(_shared(_incidence(docs, sketch, hot_from, width, percent)), "shared") as shared:
        # stars: first around each item's node with most shared items for its size, as what others were copied from has, then around random ones
        weight = shared.groupBy("node").agg((F.count("*") / F.max("size")).alias("w"))
        rest = stage_table(shared.join(weight, "node").withColumn("component", F.col("node")), "incidence")
    links, linked = None, None
    for turn in range(STARS):
        order = F.struct(F.when(F.lit(turn) == 0, -F.col("w")).otherwise(0.0), F.xxhash64("node", F.lit(turn)), "node", "size", "rest", "component").alias("o")
        centre = rest.groupBy("item").agg(F.min(order).alias("o")).select("item", F.col("o.node").alias("c"), F.col("o.size").alias("cs"), F.col("o.rest").alias("cr"), F.col("o.component").alias("cc"))
        star = rest.join(centre, "item").where((F.col("component") != F.col("cc")) & may_link(("size", "cs"), ("rest", "cr"), percent))
        star = star.groupBy(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).agg(F.count("*").alias("k"), F.max("size").alias("size"))
        # a star counts only some of a pair's shared items, so this bound is no more than a guess at which are worth a look
        tried = stage_table(star.where(F.col("k") * 40 >= F.col("size")).select("a", "b"), "pairs")
        found = _verified(tried, docs, width, percent)
        n = found.count()
        if n:
            links = found if links is None else links.unionByName(found)
            linked = connected_components(links)
            rest = _mixed(rest.drop("component").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
        if n * 5 < tried.count():
            break

    # the product: items that meet in different components
    # a pair's first shared item, in an order that is the same for all nodes, has all the others after it on both sides
    if "nodes" not in rest.columns:
        rest = _mixed(rest)
    own = Window.partitionBy("node")
    rest = rest.select("item", "node", "size", "rest", "component", "nodes").distinct()
    rest = stage_table(rest.withColumn("left", F.count("*").over(own) - F.row_number().over(own.orderBy("nodes", "item")) + 1), "incidence")
    pairs = stage_table(product_pairs(rest, percent), "product-pairs")
    if pairs.limit(1).count():
        found = _verified(pairs, docs, width, percent)
        links = found if links is None else links.unionByName(found)
        linked = connected_components(links)
    return rows, linked if linked is not None else connected_components(pairs)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Per row: id_col, n_shingles, component_id."""
    rows, linked = jaccard_links(docs, id_col, text_col, width, percent)
    # classes of one set: their least id stands for all; a class also links where any of its ids does
    classes = rows.where("fp is not null and id is not null").groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("size"))
    of_node = rows.where("fp is not null and id is not null").select("fp", "id").join(linked, F.col("id") == F.col("node")).select("fp", "component")
    edges = of_node.join(classes.select("fp", "least"), "fp").select(F.col("least").alias("a"), F.col("component").alias("b"))
    merged = connected_components(edges)
    classes = stage_table(classes.join(merged, F.col("least") == F.col("node"), "left").select("fp", "size", F.coalesce("component", "least").alias("component")), "classes")
    from_size = max(2, -(-rows.count() // HEAVY_SHARE))
    heavy = F.broadcast(classes.where(F.col("size") >= from_size).select("fp", F.col("component").alias("heavy")))  # at most HEAVY_SHARE rows
    out = rows.join(heavy, "fp", "left")
    rest = out.where("heavy is null").join(classes.where(F.col("size") < from_size).select("fp", "component"), "fp", "left")
    both = out.where("heavy is not null").select("id", "n", F.col("heavy").alias("component")).unionByName(rest.select("id", "n", F.coalesce("component", "id").alias("component")))
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))
