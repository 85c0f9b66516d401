"""Static range asymmetric numeral system over token ids, vectorised over blocks, lanes and checkpoints in numpy.

A segment is one self-contained file: a header, ids and lengths of its documents, one frequency table that all its blocks
share, then the blocks. A block holds up to BLOCK tokens, dealt in turn to LANES interleaved coders that share one word
stream. Every INTERVAL tokens there is a checkpoint (lane states and place in the stream), so that all intervals of all
blocks decode in parallel, or one alone. Header and blocks carry checksums.

    header   magic, documents, tokens, scale bits, symbols, blocks, crc of the directory
    directory  doc ids, null flags, doc lengths, symbols, frequencies, block table (tokens, words, crc)
    blocks   checkpoints (stream places, lane states), words
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"PWRANS01"
HEADER = struct.Struct("<8sQQIIII")
SCALE_BITS = 18
LANES = 32
BLOCK = 1 << 16
INTERVAL = 1 << 14
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63); 32 bits leave or enter at a time
_32 = np.uint64(32)
_MASK32 = np.uint64(0xFFFFFFFF)


class CorruptSegment(ValueError):
    pass


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2^bits."""
    whole = 1 << bits
    f = np.maximum(1, counts * whole // counts.sum())
    over = int(f.sum()) - whole
    for k in np.argsort(-f, kind="stable"):
        if over <= 0:
            f[k] -= over
            break
        step = min(over, int(f[k]) - 1)
        f[k] -= step
        over -= step
    return f


def _encode_blocks(sym: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """sym: blocks x steps x LANES ranks. For each block the checkpoints' places and states, and the words."""
    nb, steps, lanes = sym.shape
    per = INTERVAL // LANES
    x = np.full((nb, lanes), LOW, np.uint64)
    out = np.zeros((steps, nb, lanes), np.uint32)
    left = np.zeros((steps, nb, lanes), bool)
    states = np.zeros(((steps + per - 1) // per, nb, lanes), np.uint64)
    top = np.uint64(63 - SCALE_BITS)
    for s in range(steps - 1, -1, -1):
        f, c = freq[sym[:, s]], cum[sym[:, s]]
        full = x >= (f << top)
        left[s] = full
        out[s] = x & _MASK32
        x = np.where(full, x >> _32, x)
        q = x // f
        x = (q << np.uint64(SCALE_BITS)) + (x - q * f) + c
        if s % per == 0:
            states[s // per] = x
    counts = left.sum(2)
    places = np.concatenate([np.zeros((1, nb), np.int64), counts.cumsum(0)])[: steps : per]
    return [(places[:, b].astype(np.uint32), states[:, b], out[:, b][left[:, b]]) for b in range(nb)]


def write_segment(doc_ids: list[int | None], lengths: np.ndarray, tokens: np.ndarray) -> bytes:
    ids = np.array([0 if i is None else i for i in doc_ids], np.int64)
    nulls = np.array([i is None for i in doc_ids], np.uint8)
    counts = np.bincount(tokens)
    symbols = np.nonzero(counts)[0]
    to_rank = np.zeros(len(counts), np.int32)
    to_rank[symbols] = np.arange(len(symbols))
    rank, counts = to_rank[tokens], counts[symbols]
    freq = scaled(counts.astype(np.int64)) if len(counts) else np.zeros(0, np.int64)
    f64, c64 = freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64)
    n, whole = len(tokens), len(tokens) // BLOCK
    coded = _encode_blocks(rank[: whole * BLOCK].reshape(whole, BLOCK // LANES, LANES), f64, c64) if whole else []
    if n % BLOCK:
        rest = rank[whole * BLOCK :]
        steps = -(-len(rest) // LANES)
        pad = np.full(steps * LANES, counts.argmax(), np.int32)
        pad[: len(rest)] = rest
        coded += _encode_blocks(pad.reshape(1, steps, LANES), f64, c64)
    bodies = [p.tobytes() + s.tobytes() + w.tobytes() for p, s, w in coded]
    rows = [(min(BLOCK, n - k * BLOCK), len(w), zlib.crc32(body)) for k, ((_, _, w), body) in enumerate(zip(coded, bodies, strict=True))]
    directory = b"".join([ids.tobytes(), nulls.tobytes(), lengths.astype("<u4").tobytes(), symbols.astype("<u4").tobytes(), freq.astype("<u4").tobytes(), np.array(rows, "<u4").reshape(-1, 3).tobytes()])
    return HEADER.pack(MAGIC, len(ids), n, SCALE_BITS, len(symbols), len(rows), zlib.crc32(directory)) + directory + b"".join(bodies)


def _decode_rows(x: np.ndarray, place: np.ndarray, words: np.ndarray, steps: int, symbol: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> np.ndarray:
    """All rows (intervals) at once, for the same number of steps: rows x (steps * LANES) ranks."""
    out = np.zeros((len(x), steps, LANES), np.uint16 if len(freq) <= 1 << 16 else np.uint32)
    mask, bits = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS)
    place = place.astype(np.int64)
    for s in range(steps):
        slot = x & mask
        sym = symbol[slot]
        out[:, s] = sym
        x = freq[sym] * (x >> bits) + slot - cum[sym]
        need = x < LOW
        rank = need.cumsum(1)
        r, l = np.nonzero(need)
        x[r, l] = (x[r, l] << _32) | words[place[r] + rank[r, l] - 1]
        place += rank[:, -1]
    return out.reshape(len(x), -1)


def _directory(data: bytes):
    """ids, null flags, lengths, symbols, frequencies, block table, number of tokens, and where the blocks start."""
    magic, docs, n, bits, n_symbols, blocks, crc = HEADER.unpack_from(data)
    at = HEADER.size
    size = docs * 13 + n_symbols * 8 + blocks * 12
    if magic != MAGIC or bits != SCALE_BITS or zlib.crc32(data[at : at + size]) != crc:
        raise CorruptSegment("bad header")
    parts = []
    for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", n_symbols), ("<u4", n_symbols), ("<u4", blocks * 3)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    return *parts[:5], parts[5].reshape(-1, 3), n, at


def _block(data: bytes, k: int, row, at: int):
    """Checkpoints' places and states, words and end of block k, which starts at `at`."""
    count, n_words, want = (int(v) for v in row)
    steps = -(-count // LANES)
    marks = -(-steps // (INTERVAL // LANES))
    end = at + marks * (4 + 8 * LANES) + 4 * n_words
    if zlib.crc32(data[at:end]) != want:
        raise CorruptSegment(f"bad block {k}")
    places = np.frombuffer(data, "<u4", marks, at)
    states = np.frombuffer(data, "<u8", marks * LANES, at + places.nbytes).reshape(marks, LANES)
    return steps, places, states, np.frombuffer(data, "<u4", n_words, end - 4 * n_words), end


def _symbol_table(freq: np.ndarray):
    return np.repeat(np.arange(len(freq), dtype=np.uint32), freq), freq.astype(np.uint64), (np.cumsum(freq, dtype=np.int64) - freq).astype(np.uint64)


def read_interval(data: bytes, k: int) -> np.ndarray:
    """Tokens k * INTERVAL and on of a segment, up to INTERVAL of them, decoded alone; only the header and the block they are in are read."""
    _, _, _, symbols, freq, table, n, at = _directory(data)
    if not 0 <= k * INTERVAL < n:
        raise IndexError(k)
    block, mark = divmod(k, BLOCK // INTERVAL)
    marks = -(-(-(-table[:block, 0].astype(np.int64) // LANES)) // (INTERVAL // LANES))
    at += int((marks * (4 + 8 * LANES) + 4 * table[:block, 1].astype(np.int64)).sum())
    steps, places, states, words, _ = _block(data, block, table[block], at)
    per = INTERVAL // LANES
    ranks = _decode_rows(states[mark : mark + 1].copy(), places[mark : mark + 1], words.astype(np.uint64), min(per, steps - mark * per), *_symbol_table(freq))
    return symbols[ranks[0]][: n - k * INTERVAL]


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all tokens; raises CorruptSegment if a checksum does not hold."""
    ids, nulls, lengths, symbols, freq, table, n, at = _directory(data)
    rows: dict[int, list] = {}  # by number of steps
    streams, base, per = [], 0, INTERVAL // LANES
    for k, row in enumerate(table):
        steps, places, states, words, at = _block(data, k, row, at)
        streams.append(words)
        for m in range(len(places)):
            rows.setdefault(min(per, steps - m * per), []).append((k * BLOCK + m * INTERVAL, states[m], base + int(places[m])))
        base += len(words)
    words = np.concatenate(streams).astype(np.uint64) if streams else np.zeros(0, np.uint64)
    out, tables = np.zeros(n + INTERVAL, np.uint32), _symbol_table(freq)
    for steps, group in rows.items():
        ranks = _decode_rows(np.array([g[1] for g in group], np.uint64), np.array([g[2] for g in group]), words, steps, *tables)
        for (to, _, _), r in zip(group, ranks, strict=True):
            out[to : to + len(r)] = symbols[r][: len(out) - to]
    return [None if z else int(i) for i, z in zip(ids, nulls, strict=True)], lengths, out[:n]
