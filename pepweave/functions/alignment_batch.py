"""The block-move alignment of many pairs at once: pairs of equal lengths share a grid, and each cell is a step of arrays over all of them.

The moves, their gains and their order are those of alignment.align, which remains for pairs with other letters than the residues, for
lengths of which there are few pairs, and for sequences that are very long.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .alignment import GAP, ISO_GAIN, ISO_LENGTH_PENALTY, ISO_MAX, ISO_TOLERANCE, MATCH, MISMATCH, SHUFFLE_GAIN, SHUFFLE_MAX, Alignment, align, event_name, events
from .residues import RESIDUE_MASS, residue_mass

PAIRS, CELLS = 4096, 1 << 24  # most pairs at a time, and most cells of theirs
FEW = 16  # pairs below which arrays don't pay
KNOWN = frozenset(RESIDUE_MASS)

#: Moves by number: mark, residues taken of either sequence; of equal totals the first in this order wins.
MOVES = [(ord("|"), 1, 1), (ord("."), 1, 1), (ord("-"), 1, 0), (ord("-"), 0, 1)]
MOVES += [(ord("x"), s, s) for s in range(2, SHUFFLE_MAX + 1)] + [(ord("="), p, q) for p in range(1, ISO_MAX + 1) for q in range(1, ISO_MAX + 1)]
_MARK, _P, _Q = (np.array(x, np.int64) for x in zip(*MOVES, strict=True))


@lru_cache(1)
def _masses() -> dict[int, np.ndarray]:
    """Masses of blocks of one and two residues by their letters' codes."""
    out = {1: np.full(32, np.nan), 2: np.full(1024, np.nan)}  # nan is near to nothing
    for x in KNOWN:
        out[1][ord(x) - 64] = residue_mass(x)
        for y in KNOWN:
            out[2][(ord(x) - 64) * 32 + ord(y) - 64] = residue_mass(x + y)
    return out


#: Powers that letters add up by: sums of up to SHUFFLE_MAX letters are equal if and only if the letters are, in whatever order.
_POWERS = np.zeros(32, np.int64)
_POWERS[[ord(c) - 64 for c in sorted(KNOWN)]] = (SHUFFLE_MAX + 1) ** np.arange(len(KNOWN), dtype=np.int64)


def _codes(letters: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By size, of the windows that end at each place (a row, of all pairs): their letters in a number, as they are and in whatever order. Places before the first window have -1."""
    letters = np.ascontiguousarray(letters.T)
    width, n = letters.shape
    sums = np.concatenate([np.zeros((1, n), np.int64), np.cumsum(_POWERS[letters], axis=0)])
    out, last = {}, np.zeros((width + 1, n), np.int32)
    for size in range(1, max(SHUFFLE_MAX, ISO_MAX) + 1):
        plain, ordered = np.full((width + 1, n), -1, np.int32), np.full((width + 1, n), -1, np.int64)
        plain[size:] = last[size - 1 : -1] * np.int32(32) + letters[size - 1 :]
        ordered[size:] = sums[size:] - sums[:-size] if width >= size else 0
        out[size], last = (plain, ordered), plain
    return out


def align_alike(a: list[str], b: list[str]) -> list[Alignment]:
    """Alignments of pairs that all have the same two lengths, residues only."""
    x, y = (np.frombuffer("".join(s).encode(), np.uint8).reshape(len(s), -1).astype(np.int32) - 64 for s in (a, b))
    pairs, n, m = len(a), x.shape[1], y.shape[1]
    wx, wy = _codes(x), _codes(y)
    masses = _masses()
    mx, my = ({s: masses[s][np.maximum(w[s][0], 0)] for s in range(1, ISO_MAX + 1)} for w in (wx, wy))

    # near masses are looked for in single precision, with some room, and looked at again in double
    lx, ly = ({s: v.astype(np.float32) for s, v in z.items()} for z in (mx, my))
    room = np.float32(ISO_TOLERANCE * 1.1)

    total = np.empty((n + 1, m + 1, pairs), np.int16)  # all totals are whole, and small by CELLS
    gain, miss, gap = (np.int16(v) for v in (MATCH - MISMATCH, MISMATCH, GAP))
    step = np.empty((n + 1, m + 1, pairs), np.uint8)
    total[0] = (np.arange(m + 1) * int(GAP))[:, None]
    step[0], step[1:, 0] = 3, 2
    for i in range(1, n + 1):
        total[i, 0] = i * int(GAP)
        for j in range(1, m + 1):
            same = wx[1][0][i] == wy[1][0][j]
            best, move = total[i, j], step[i, j]
            np.multiply(same.view(np.int8), gain, out=best)
            best += total[i - 1, j - 1]
            best += miss
            np.logical_not(same, out=move.view(bool))
            for k, value in ((2, total[i - 1, j] + gap), (3, total[i, j - 1] + gap)):
                move[value > best] = k
                np.maximum(best, value, out=best)
            for k in range(4, len(MOVES)):
                mark, p, q = MOVES[k]
                if i < p or j < q:
                    continue
                if mark == ord("x"):
                    at = ((wx[p][1][i] == wy[q][1][j]) & (wx[p][0][i] != wy[q][0][j])).nonzero()[0]
                    value = total[i - p, j - q].take(at) + np.int16(SHUFFLE_GAIN * p)
                else:
                    near = np.abs(lx[p][i] - ly[q][j]) <= room
                    at = (near & (wx[p][1][i] != wy[q][1][j]) if p == q else near).nonzero()[0]
                    off = np.abs(mx[p][i].take(at) - my[q][j].take(at))
                    if len(at) and not (inside := off <= ISO_TOLERANCE).all():
                        at, off = at[inside], off[inside]
                    value = np.rint(total[i - p, j - q].take(at) + (ISO_GAIN * max(p, q) * (1 - off / ISO_TOLERANCE) - ISO_LENGTH_PENALTY * abs(p - q)))
                if len(at):
                    over = value > best.take(at)
                    at = at[over]
                    best[at], move[at] = value[over], k

    # back from the last cell of all pairs together; columns are filled from the right
    width = n + m
    rows = np.full((3, pairs, width + SHUFFLE_MAX), ord("-"), np.uint8)
    every, i, j, at = np.arange(pairs), np.full(pairs, n), np.full(pairs, m), np.full(pairs, width)
    while True:
        open_ = every[(i > 0) | (j > 0)]
        if not len(open_):
            break
        k = step[i[open_], j[open_], open_]
        p, q, mark = _P[k], _Q[k], _MARK[k]
        size = np.maximum(p, q)
        at[open_] -= size
        for c in range(int(size.max())):
            for row, letters, end, taken in ((0, x, i, p), (1, y, j, q)):
                own = c < taken
                who = open_[own]
                rows[row, who, at[who] + c] = letters[who, end[who] - taken[own] + c] + 64
            has = c < size
            who = open_[has]
            rows[2, who, at[who] + c] = mark[has]
        i[open_] -= p
        j[open_] -= q
    first, second, marks = (rows[k, :, :width].tobytes().decode() for k in range(3))
    starts = (every * width + at).tolist()
    scores = total[n, m].astype(float).tolist()
    return [Alignment(first[s:e], second[s:e], marks[s:e], v) for s, e, v in zip(starts, range(width, (pairs + 1) * width, width), scores, strict=True)]


def align_stream(pairs: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, Alignment | Exception]]:
    """Alignments of all pairs, in another order: they wait until there are enough of their lengths. An exception is its pair's result."""
    waiting: dict[tuple[int, int], list[tuple[str, str]]] = defaultdict(list)

    def one(a, b):
        try:
            return a, b, align(a, b)
        except Exception as e:  # a pair's failure is its result
            return a, b, e

    def together(held):
        if len(held) < FEW:
            return [one(a, b) for a, b in held]
        a, b = map(list, zip(*held, strict=True))
        return list(zip(a, b, align_alike(a, b), strict=True))

    for a, b in pairs:
        if not a or not b or not KNOWN.issuperset(a) or not KNOWN.issuperset(b) or FEW * (len(a) + 1) * (len(b) + 1) > CELLS:
            yield one(a, b)
            continue
        key = len(a), len(b)
        waiting[key].append((a, b))
        if len(waiting[key]) >= min(PAIRS, CELLS // ((key[0] + 1) * (key[1] + 1))):
            yield from together(waiting.pop(key))
    for held in waiting.values():
        yield from together(held)


def kinds(found: Alignment) -> str:
    """Its marks, with + for a residue that the first sequence lacks: all that events depend on but their letters."""
    if "-" not in found.marks:
        return found.marks
    return "".join(["+" if m == "-" == c else m for m, c in zip(found.marks, found.first, strict=True)])


@lru_cache(1 << 16)
def places(kinds: str) -> tuple[str, tuple[tuple[str, int, int], ...]]:
    """The name of all events of alignments of these kinds, and of each one its name, start and length."""
    what = events(Alignment("".join("-" if c == "+" else "." for c in kinds), "", kinds.replace("+", "-"), 0.0))
    return event_name(what), tuple((e.event, e.pos, e.k) for e in what)


def name_of(found: Alignment) -> str:
    return places(kinds(found))[0]
