"""Removal of byte strings of a given length that occur more than once, by suffix arrays.

Every window of `length` bytes has an anchor: the least-hashing k-gram in it, which depends on nothing but the window, so equal
windows have equal anchors. That splits the corpus into shards without losing a match:

1. A scan counts anchor hashes; those met once are done. A second scan cuts, for each anchor that may be repeated (a bit
   array of bounded size tells; beyond its size a join does), its context: the bytes of all windows that it anchors.
2. Contexts alike are one, by digest: where one occurs twice, all its windows are repeated.
3. Contexts that share an anchor but differ form shards. Each shard gets a suffix array by Larsson-Sadakane refinement (only
   groups not yet sorted are sorted again, by the rank of the suffix h further on, h doubling) and common prefixes by Kasai's
   scan, both vectorised in numpy. Runs of neighbours with common prefixes of at least `length` are repeated windows.
4. Contexts of an anchor with very many are cut and keyed by all that a cut's windows share; a key that has very many still is
   dealt over several shards, and the windows that each finds are merged by binary search in the sorted digests of all shards.

Windows found are mapped back to the documents and their bytes removed.

Defined cases: null text is empty; texts shorter than the length lose nothing; rows alike are documents of their own, so they
remove each other's bytes; overlapping occurrences count; ids may be null or repeated; an empty table gives an empty
result; columns other than the two are ignored, whatever their names. A text of any length is scanned in pieces of PIECE bytes; where its
bytes are cut out, it is in memory whole.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, shuffle_width, slices, stage_table, text_bytes

LENGTH = 200
GRAM = 64  # a power of two, at least 8
PIECE = 1 << 20
SHARD = 1 << 21  # bytes of contexts in a suffix array
FEW = 256  # contexts of an anchor from which they are told apart by more than the anchor
CUT = 34  # windows that a cut of a context has at most
MANY = 512  # contexts of a cut that one block takes
FILTER_BITS = 1 << 28
MOST_TASKS = 100_000
_POSITION = np.uint64((1 << 24) - 1)


def words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a big-endian number; zeros follow the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(n + 8, np.uint64)
    for s in range(8):
        part = padded[s : s + (n + 7 - s) // 8 * 8]
        out[s : s + len(part) : 8] = np.frombuffer(part.tobytes(), ">u8")
    return out[:n]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts in one array of less than 2^24 bytes: keys of the anchors, first and last window that each anchors, and where it is."""
    lengths = np.maximum(0, np.diff(offsets) - length + 1)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.uint64), *np.zeros((3, 0), np.int64)
    h, at = words(data), 8
    while at < gram:
        ahead = np.concatenate([h[at:], np.zeros(at, np.uint64)])
        h = h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29))
        h += ahead * np.uint64(0xC2B2AE3D27D4EB4F) ^ (ahead >> np.uint64(31))
        at *= 2
    h = mix64(h)
    m = h & ~_POSITION | np.arange(len(h), dtype=np.uint64)
    span, have = length - gram + 1, 1
    while have * 2 <= span:
        m = np.minimum(m[: len(m) - have], m[have:])
        have *= 2
    if have < span:
        m = np.minimum(m[: len(m) - (span - have)], m[span - have :])
    window = np.repeat(offsets[:-1] - np.concatenate([[0], lengths.cumsum()[:-1]]), lengths) + np.arange(total)
    x = (m[window] & _POSITION).astype(np.int64)
    new = np.concatenate([[True], x[1:] != x[:-1]])
    first = np.nonzero(new)[0]
    last = np.concatenate([first[1:], [total]]) - 1
    return h[x[first]], window[first], window[last], x[first]


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int, piece: int = PIECE):
    """(row, start in the text, bytes, offsets of their texts): many short texts at once, long ones in overlapping pieces."""
    for a, b in slices(offsets, piece):
        if b == a + 1 and offsets[b] - offsets[a] > piece:
            for s in range(int(offsets[a]), int(offsets[b]), piece):
                end = min(s + piece + length - 1, int(offsets[b]))
                yield a, s - int(offsets[a]), data[s:end], np.array([0, end - s])
        else:
            yield a, 0, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their suffixes' first `depth` bytes or more, ties by position: Larsson-Sadakane refinement from 8-byte groups."""
    n = len(text)
    key = words(text)
    order = np.argsort(key, kind="stable")
    k = key[order]
    head = np.concatenate([[True], k[1:] != k[:-1]])
    starts = np.nonzero(head)[0]
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    single = head & np.append(head[1:], True)
    todo, h = np.nonzero(~single)[0], 8
    while h < depth and len(todo):
        p = order[todo]
        q = p + h
        second = np.where(q < n, rank[np.minimum(q, n - 1)] + 1, 0)
        both = rank[p] * (n + 1) + second
        by = np.argsort(both, kind="stable")
        p, both = p[by], both[by]
        order[todo] = p
        head = np.concatenate([[True], both[1:] != both[:-1]])
        starts = np.nonzero(head)[0]
        rank[p] = np.repeat(todo[starts], np.diff(np.append(starts, len(todo))))
        todo = todo[~(head & np.append(head[1:], True))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, lanes: int = 8192) -> np.ndarray:
    """Kasai's scan: for each place in the order, the common prefix with its predecessor, up to `most`; the text is scanned in lanes at once."""
    n = len(text)
    w = np.concatenate([words(text), np.zeros(most + 8, np.uint64)])
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.empty(n + 1, np.int64)
    place[order], place[n] = np.arange(n), n
    steps = -(-n // min(lanes, max(1, n)))
    lane = np.arange(0, n, steps)
    have, last = np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
    out = np.zeros(n, np.int32)
    for s in range(steps):
        p = lane + s
        live = np.nonzero(p < n)[0]
        p = p[live]
        q = before[p]
        # one byte less is carried on if the last predecessor's next suffix still comes before; it need not where the order is by position
        on = (q >= 0) & (have[live] > 1) & (place[last[live] + 1] < place[p])
        l = np.where(on, have[live] - 1, 0)
        grow = np.nonzero((q >= 0) & (l < most))[0]
        while len(grow):
            d = w[p[grow] + l[grow]] ^ w[q[grow] + l[grow]]
            same = d == 0
            # leading bytes alike, from the number of bits; a float can round only those of over 53 bits, whose first byte differs
            bits = np.where(same, 0, np.frexp((d >> np.uint64(8)).astype(np.float64))[1])
            alike = np.where(same, 8, np.where(d >> np.uint64(8) == 0, 7, np.maximum(56 - bits, 0) // 8))
            l[grow] += alike
            grow = grow[same & (l[grow] < most)]
        l = np.minimum(l, np.minimum(most, n - np.maximum(p, q)))
        out[p] = l
        have[live], last[live] = l, q
    return out[order]


def repeated_windows(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the contexts in sorted order: their contexts, offsets and the number of their class (windows alike)."""
    text = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    begins = sizes.cumsum() - sizes
    order = suffix_array(text, length)
    prefix = common_prefixes(text, order, length)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    offset = np.arange(len(text)) - begins[owner]
    whole = offset + length <= sizes[owner]  # windows that end in their context
    run = (prefix < length).cumsum()
    keep = whole[order]
    return owner[order[keep]], offset[order[keep]], run[keep]


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of successive numbers: first and last of each."""
    cut = np.nonzero(np.diff(offsets) > 1)[0]
    return offsets[np.concatenate([[0], cut + 1])], offsets[np.concatenate([cut, [len(offsets) - 1]])]


def _anchor_counts(docs: DataFrame, length: int, piece: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [anchors(d, o, length)[0] for _, _, d, o in pieces_of(*text_bytes(batch.column(0)), length, piece)]
            if found:
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long")


def _contexts(docs: DataFrame, repeated: DataFrame, length: int, max_bits: int, piece: int) -> DataFrame:
    """Occurrences: id, h, key, lo, size, at (the anchor's place in it), ctx (digest), bytes (at a context's first occurrence in a task)."""
    n = repeated.count()
    by_join = n * 4 > max_bits
    spark = docs.sparkSession
    if by_join:

        def mark(batches):
            for batch in batches:
                for row, at, d, o in pieces_of(*text_bytes(batch.column(2)), length, piece):
                    key, lo, _, _ = anchors(d, o, length)
                    rows = pa.array(row + np.searchsorted(o, lo, "right") - 1)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(key.view(np.int64))], names=["id", "h", "key"])

        marked = docs.select("id", "h", "text").mapInArrow(mark, "id long, h long, key long").join(repeated, "key").groupBy("id", "h").agg(F.collect_set("key").alias("keys"))
        rows = docs.join(marked.withColumnsRenamed({"id": "id2", "h": "h2"}), F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2"))).select("id", "h", "text", "keys")
        shared = None
    else:
        bits = min(max_bits, max(1 << 15, 1 << (16 * n).bit_length()))
        slot = F.col("key").bitwiseAND(F.lit(bits - 1))  # the high bits of a least hash are mostly zeros
        maps = repeated.select(slot.alias("s")).groupBy(F.shiftright("s", 15).alias("k")).agg(F.bitmap_construct_agg(F.col("s").bitwiseAND(F.lit(32767))).alias("m"))
        array = np.zeros((bits >> 15, 4096), np.uint8)
        for r in maps.collect():  # at most max_bits
            array[r.k] = np.frombuffer(r.m, np.uint8)
        shared, mask = spark.sparkContext.broadcast(zlib.compress(array.tobytes(), 1)), np.uint64(bits - 1)
        rows = docs.select("id", "h", "text")

    def run(batches):
        live = None if shared is None else np.frombuffer(zlib.decompress(shared.value), np.uint8)
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for row, at, d, o in pieces_of(*text_bytes(batch.column(2)), length, piece):
                key, lo, hi, x = anchors(d, o, length)
                if live is not None:
                    s = (key & mask).astype(np.int64)
                    pick = np.nonzero(live[s >> 3] >> (s & 7).astype(np.uint8) & 1)[0]
                    texts = np.searchsorted(o, lo[pick], "right") - 1
                else:
                    texts = np.searchsorted(o, lo, "right") - 1
                    known = {int(t): set(batch.column(3)[row + int(t)].as_py()) for t in np.unique(texts)}
                    pick = np.array([i for i, t in enumerate(texts.tolist()) if int(key.view(np.int64)[i]) in known[t]], np.int64)
                    texts = texts[pick]
                raw = d.tobytes()
                for i, t, a, b, c_at in zip(pick.tolist(), texts.tolist(), lo[pick].tolist(), hi[pick].tolist(), (x - lo)[pick].tolist(), strict=True):
                    c = raw[a : b + length]
                    digest = hashlib.blake2b(c, digest_size=16).digest()
                    new = digest not in seen
                    if new:
                        seen.add(digest)
                    out.append((row + t, key[i], a - o[t] + at, len(c), c_at, digest, c if new else None))
            if out:
                at_row, keys, los, sizes, places, digests, texts = zip(*out, strict=True)
                at_row = pa.array(at_row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at_row), batch.column(1).take(at_row), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(los, np.int64)), pa.array(np.array(sizes, np.int64)), pa.array(np.array(places, np.int64)), pa.array(digests, pa.binary()), pa.array(texts, pa.binary())],
                    names=["id", "h", "key", "lo", "size", "at", "ctx", "bytes"],
                )

    return rows.mapInArrow(run, "id long, h long, key long, lo long, size long, at long, ctx binary, bytes binary")


def _refined(contexts: DataFrame, length: int) -> DataFrame:
    """Contexts of anchors that very many have, cut by how far their windows start before the anchor, with keys of all the bytes that a cut's windows share.

    Windows alike are in cuts of one key, and a line that many documents share, shorter than a window, no longer joins them."""
    rows = contexts.select("key", "ctx", "at", "bytes")

    def run(batches):
        for batch in batches:
            out = []
            for key, ctx, at, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                last = len(raw) - length
                for part in range(max(0, at - last) // CUT, at // CUT + 1):
                    top = at - part * CUT
                    a, b = max(0, top - CUT + 1), min(last, top)
                    if a <= b:
                        core = raw[top : top - CUT + 1 + length]
                        h = hashlib.blake2b(core, digest_size=8, key=key.to_bytes(8, "little", signed=True) + bytes([part])).digest()
                        out.append((int.from_bytes(h, "little", signed=True), ctx, a, raw[a : b + length]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["key", "ctx", "base", "bytes"])

    return rows.mapInArrow(run, "key long, ctx binary, base long, bytes binary")


def _parted(contexts: DataFrame, many: int) -> DataFrame:
    """Contexts (key, ctx, base, bytes) of keys with several, dealt over blocks where a key has more than `many`."""
    keys = contexts.groupBy("key").agg(F.min("ctx").alias("lo"), F.max("ctx").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    keys = keys.select("key", F.ceil(F.col("n") / many).cast("int").alias("blocks"))
    return contexts.join(keys, "key").withColumn("block", F.pmod(F.xxhash64("ctx"), "blocks").cast("int"))


def _shards(contexts: DataFrame, length: int, total: int) -> DataFrame:
    """contexts: key, block, blocks, ctx, base (where bytes start in the context), bytes. Gives ctx, first, last (repeated windows) and, of split anchors, digests of windows with ctx and offset (or none) to be merged."""
    # a task for each shard's worth of bytes: what a task costs goes by them, and partitions that are given by number are not put together
    tasks = min(MOST_TASKS, max(shuffle_width(contexts.sparkSession), -(-total // SHARD)))
    rows = contexts.repartition(tasks, "key", "block").sortWithinPartitions("key", "block", "ctx").select("key", "block", "blocks", "ctx", "base", "bytes")

    def solve(group: list[tuple]):
        """group: whole runs of (key, block), each context once: (split, ctx, bytes, base)."""
        owner, offset, run = repeated_windows([g[2] for g in group], length)
        if not len(owner):
            return
        inverse = run - run.min()
        alike = np.bincount(inverse)[inverse]
        hit = alike > 1
        names, first, last = [], [], []
        order = np.lexsort((offset[hit], owner[hit]))
        own, off = owner[hit][order], offset[hit][order]
        for c in np.unique(own):
            a, b = _spans(off[np.searchsorted(own, c) : np.searchsorted(own, c, "right")])
            names += [group[c][1]] * len(a)
            first += (a + group[c][3]).tolist()
            last += (b + group[c][3]).tolist()
        digests, members, places = [None] * len(names), [None] * len(names), [None] * len(names)
        split = np.array([g[0] for g in group])
        if split.any():
            head = np.concatenate([[True], inverse[1:] != inverse[:-1]])
            for k in np.nonzero(split[owner] & head)[0]:
                c, o = int(owner[k]), int(offset[k])
                digests.append(hashlib.blake2b(group[c][2][o : o + length], digest_size=16).digest())
                members.append(group[c][1] if alike[k] == 1 else None)
                places.append(o + group[c][3])
            more = len(digests) - len(names)
            names, first, last = names + [None] * more, first + [None] * more, last + [None] * more
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((names, first, last, digests, members, places), kinds, strict=True)], names=["ctx", "first", "last", "digest", "member", "place"])

    def run(batches):
        group, held, key, ctx = [], 0, None, None
        for batch in batches:
            for k, block, blocks, c, base, raw in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if (k, block) != key:
                    if held >= SHARD:
                        yield from solve(group)
                        group, held = [], 0
                    key, ctx = (k, block), None
                if c != ctx:
                    ctx = c
                    group.append((blocks > 1, c, raw, base))
                    held += len(raw)
        if group:
            yield from solve(group)

    return rows.mapInArrow(run, "ctx binary, first long, last long, digest binary, member binary, place long")


def _merged(found: DataFrame) -> DataFrame:
    """Across shards of one anchor: windows whose digest other shards have too, as ctx, first, last."""
    rows = found.where("digest is not null").select("digest", "member", "place").repartition("digest").sortWithinPartitions("digest")

    def run(batches):
        pending, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column(0)
            digest = np.array(raw.to_pylist(), "V16").view(">u8").reshape(-1, 2).astype(np.uint64)
            digest = np.rec.fromarrays([digest[:, 0], digest[:, 1]])  # in order
            lo, hi = np.searchsorted(digest, digest, "left"), np.searchsorted(digest, digest, "right")
            many = hi - lo > 1
            if last == raw[0].as_py():  # the run goes on from the batch before
                many |= lo == 0
                if pending is not None:
                    yield pending
            last, pending = raw[-1].as_py(), None if many[-1] else kept(b.slice(b.num_rows - 1))
            yield kept(b.filter(pa.array(many)))

    def kept(b: pa.RecordBatch) -> pa.RecordBatch:
        b = b.filter(pa.compute.is_valid(b.column(1)))
        return pa.RecordBatch.from_arrays([b.column(1), b.column(2), b.column(2)], names=["ctx", "first", "last"])

    return rows.mapInArrow(run, "ctx binary, first long, last long")


def _size(contexts: DataFrame) -> int:
    return contexts.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0


def repeated_spans(docs: DataFrame, length: int = LENGTH, max_bits: int = FILTER_BITS, many: int = MANY, few_from: int = FEW, piece: int = PIECE) -> DataFrame:
    """docs: id, h, text. Gives id, h, lo, hi: first and last start of windows of the text that occur elsewhere."""
    counts = _anchor_counts(docs, length, piece).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    repeated = stage_table(counts, "anchors")
    seen = stage_table(_contexts(docs, repeated, length, max_bits, piece), "contexts")

    classes = stage_table(seen.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.max("size").alias("size"), F.count("bytes").alias("copies")), "context-classes")
    keys = classes.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("copies").alias("rows")).where("kinds > 1")
    mixed = stage_table(seen.where("bytes is not null").join(keys.select("key", "rows"), "key").select("key", "ctx", "at", "bytes", "rows"), "mixed-contexts")
    few = mixed.where(F.col("rows") <= few_from).select("key", "ctx", F.lit(0).cast("long").alias("base"), "bytes", F.lit(1).alias("blocks"), F.lit(0).alias("block"))
    parts, total = few, _size(mixed.where(F.col("rows") <= few_from))
    if mixed.where(F.col("rows") > few_from).limit(1).count():
        cuts = stage_table(_refined(mixed.where(F.col("rows") > few_from), length), "cuts")
        parts, total = few.unionByName(_parted(cuts, many)), total + _size(cuts)
    found = stage_table(_shards(parts, length, total), "windows")

    whole = classes.where("n > 1").select("ctx", F.lit(0).cast("long").alias("first"), (F.col("size") - length).alias("last"))
    windows = whole.unionByName(found.where("ctx is not null").select("ctx", "first", "last"))
    if found.where("digest is not null").limit(1).count():
        windows = windows.unionByName(_merged(found))
    windows = stage_table(windows.groupBy("ctx").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "context-runs")
    hits = seen.select("id", "h", "ctx", "lo").join(windows, "ctx").select("id", "h", "lo", F.explode("runs").alias("r"))
    return hits.select("id", "h", (F.col("lo") + F.col("r.first")).alias("lo"), (F.col("lo") + F.col("r.last")).alias("hi"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, max_bits: int = FILTER_BITS, many: int = MANY, few_from: int = FEW, piece: int = PIECE) -> DataFrame:
    """Per row: id_col, n_bytes, removed (array of start, end in bytes), kept (the remaining bytes)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    spans = repeated_spans(docs, length, max_bits, many, few_from, piece).groupBy(F.col("id").alias("id2"), F.col("h").alias("h2")).agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    rows = docs.join(spans, F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")), "left").select("id", "text", "runs")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, runs in zip(batch.column(1), batch.column(2), strict=True):
                raw, out, parts, at = text.as_py().encode(), [], [], 0
                for r in sorted((r["lo"], r["hi"] + length) for r in runs.as_py() or ()):
                    if out and r[0] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], r[1])
                    else:
                        out.append(list(r))
                for a, b in out:
                    parts.append(raw[at:a])
                    at = b
                parts.append(raw[at:])
                sizes.append(len(raw))
                removed.append([{"start": a, "end": b} for a, b in out])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], names=["id", "n_bytes", "removed", "kept"])

    return rows.mapInArrow(run, "id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary").withColumnRenamed("id", id_col)
