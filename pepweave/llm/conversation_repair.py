"""Repair of conversations' structure by lazy weighted determinisation.

A conversation is well formed if its roles' initials read `(s?(ua)+)?`. Edits keep a row, give it another role, delete it or insert an empty one, at
fixed costs; the cheapest are found by a weighted automaton of four states, read as a deterministic one: the vector of the costs of reaching
each state, less its least entry, is a state of its own. Few vectors occur, so what a row makes of one is computed when it is first met and then
looked up (Determinised.moves). A scan over that table gives the cost; a trace backwards along arcs that are tight, so along cheapest ways only, leaves
the states from which the end is reached at that cost, and reading those forwards with the least letter first gives the audit.

Rows are put in order by ranges of (conversation, turn), so that a long conversation spreads over tasks; repeated rows are found by an aggregation on
digests. One task reads a conversation's rows in order, of which it holds 14 bytes each and no text: no more than the audit, which is one value, and the
digest, a chain over the whole, call for. Texts meet their rows' edits in a second sorted pass that streams.

Defined cases: a null role or text is one blank; null turns come first and don't count as gaps; a null conversation id is a conversation; rows
of one turn are in order of role and text; rows alike throughout are duplicates of the first; an empty role has no initial, so keeping it changes
nothing; roles are told apart by their first character; a conversation without rows has zeros and empty texts; texts of any length are
hashed in pieces; other columns don't come through, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sorted_rows, stage_table

KEEP, REROLE, DELETE, INSERT, LATE = 0, 2, 3, 2, 1  # costs; LATE: of a truncated row that stays
BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
INITIALS = "sua"
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: State of the automaton -> initial -> state: 0 before anything, 1 after s, 2 after u, 3 after a. The first and the last accept.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ACCEPT = (0, 3)
#: The only state that an inserted or renamed row leads to, as neither can be s; and its initial.
OTHER = tuple(next((t, c) for c, t in n.items() if c != "s") for n in NEXT)
FAR = 1 << 40

FAULTS = ("", "blank", "duplicate", "truncated")
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _row_arcs(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of the ways to treat a row, in order of the edits' letters."""
    yield "D", DELETE, state
    if fault not in (1, 2):
        late = LATE if fault == 3 else 0
        t = NEXT[state].get(initial) if initial else state
        if t is not None:
            yield "K", KEEP + late, t
        yield "R", REROLE + late, OTHER[state][0]


class Determinised:
    """The deterministic automaton as far as it has been met. A row is a code: its initial and its fault."""

    def __init__(self) -> None:
        self.codes: dict[tuple[str, int], int] = {}
        self.rows: list[tuple[str, int]] = []
        self.ids: dict[tuple[int, ...], int] = {}
        self.vectors: list[tuple[int, ...]] = []
        self.moves: dict[tuple[int, int], tuple[int, int]] = {}
        self.tight: dict[tuple[int, int, int], int] = {}
        self.ways: dict[tuple[int, int, int, int], tuple[str, str, int]] = {}
        self.start, _ = self._named([0, FAR, FAR, FAR])

    def code(self, initial: str, fault: int) -> int:
        key = (initial if initial in INITIALS else "?", fault)  # the empty initial is in any text
        if key not in self.codes:
            self.codes[key] = len(self.rows)
            self.rows.append(key)
        return self.codes[key]

    def _named(self, costs: list[int]) -> tuple[int, int]:
        """The vector's id, inserted rows taken into account, and its least entry."""
        for _ in range(2):
            for s, (t, _) in enumerate(OTHER):
                costs[t] = min(costs[t], costs[s] + INSERT)
        least = min(costs)
        vector = tuple(min(c - least, FAR) for c in costs)
        if vector not in self.ids:
            self.ids[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.ids[vector], least

    def move(self, vector: int, code: int) -> tuple[int, int]:
        """The next vector's id and what all its entries cost more."""
        if (vector, code) not in self.moves:
            costs = [FAR] * 4
            for s, c in enumerate(self.vectors[vector]):
                for _, more, t in _row_arcs(s, *self.rows[code]):
                    costs[t] = min(costs[t], c + more)
            self.moves[vector, code] = self._named(costs)
        return self.moves[vector, code]

    def _before_inserts(self, vector: int, good: int) -> int:
        """good (a bit for each state) and the states that tight inserts lead there from."""
        costs = self.vectors[vector]
        for _ in range(2):
            for s, (t, _) in enumerate(OTHER):
                if good >> t & 1 and costs[s] < FAR and costs[s] + INSERT == costs[t]:
                    good |= 1 << s
        return good

    def ends(self, vector: int) -> tuple[int, int]:
        """The least cost at the end, and the states on the ways to it."""
        least = min(self.vectors[vector][s] for s in ACCEPT)
        return least, self._before_inserts(vector, sum(1 << s for s in ACCEPT if self.vectors[vector][s] == least))

    def back(self, vector: int, code: int, good: int) -> int:
        """The states before a row from which tight arcs lead to good ones behind it."""
        key = (vector, code, good)
        if key not in self.tight:
            costs, (after, more) = self.vectors[vector], self.move(vector, code)
            behind = self.vectors[after]
            found = sum(1 << s for s, c in enumerate(costs) if c < FAR and any(good >> t & 1 and c + x == behind[t] + more for _, x, t in _row_arcs(s, *self.rows[code])))
            self.tight[key] = self._before_inserts(vector, found)
        return self.tight[key]

    def way(self, vector: int, code: int, good: int, state: int) -> tuple[str, str, int]:
        """From a good state: the initials inserted before the row, the row's edit and the state behind it. code -1: the end."""
        key = (vector, code, good, state)
        if key not in self.ways:
            costs, lead = self.vectors[vector], ""
            here = good if code < 0 else self.back(vector, code, good)
            while True:
                if code < 0:
                    edits = [("", state)] if state in ACCEPT and costs[state] == self.ends(vector)[0] else []
                else:
                    after, more = self.move(vector, code)
                    edits = [(e, t) for e, x, t in _row_arcs(state, *self.rows[code]) if good >> t & 1 and costs[state] + x == self.vectors[after][t] + more]
                t, initial = OTHER[state]
                insert = here >> t & 1 and costs[state] + INSERT == costs[t]
                if edits and (edits[0][0] < "I" or not insert):
                    break
                lead, state = lead + initial, t
            self.ways[key] = (lead, *edits[0])
        return self.ways[key]

    def repair(self, codes: bytearray) -> tuple[int, list[str], Iterator[tuple[str, str, str]]]:
        """A conversation's cost, its audit in pieces, and for each row its lead, its edit and the initial that it is given; then the end's lead."""
        vectors, cost = array("i", [self.start]), 0
        for c in codes:
            after, more = self.move(vectors[-1], c)
            vectors.append(after)
            cost += more
        least, good = self.ends(vectors[-1])
        masks = bytearray(len(vectors))
        masks[-1] = good
        for i in range(len(codes) - 1, -1, -1):
            masks[i] = self.back(vectors[i], codes[i], masks[i + 1])

        def ways() -> Iterator[tuple[str, str, str]]:
            state = 0
            for i, c in enumerate(codes):
                lead, edit, after = self.way(vectors[i], c, masks[i + 1], state)
                before = state
                for _ in lead:
                    before = OTHER[before][0]
                yield lead, edit, OTHER[before][1] if edit == "R" else ""
                state = after
            yield self.way(vectors[-1], -1, masks[-1], state)[0], "", ""

        return cost + least, ["I" * len(lead) + edit for lead, edit, _ in ways()], ways()


def ordered(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A stage table of conv, turn, role, text with __place: rows of a conversation by turn, role and text."""
    blank = F.lit(" ")
    rows = rows.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, blank).alias("role"), F.coalesce(text_col, blank).alias("text"))
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role")]
    return sorted_rows(rows, [*keys, F.substring("text", 1, 64).asc()], [*keys, F.col("text").asc()], "conversation-rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv, __place, turn, initial and fault (a place in FAULTS) of ordered rows: of several faults of a row the first counts."""
    body = F.rtrim("text", F.lit(BLANKS))
    own = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    rows = rows.select(
        "conv", "__place", "turn", F.substring("role", 1, 1).alias("initial"), (body == "").alias("__blank"),
        (~F.substring(body, -1, 1).isin(*ENDS)).alias("__open"), F.unhex(F.sha2(own, 256)).alias("__own"),
    )
    seen = rows.groupBy("conv", "__own").agg(F.min("__place").alias("__first"), F.count("*").alias("__n")).where("__n > 1")
    seen = seen.select(F.col("conv").alias("__conv"), F.col("__own").alias("__as"), "__first")
    rows = rows.join(seen, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("__own") == F.col("__as")), "left")
    fault = F.when(F.col("__blank"), 1).when(F.col("__place") > F.col("__first"), 2).when(F.col("__open"), 3).otherwise(0)
    return rows.select("conv", "__place", "turn", "initial", fault.alias("fault"))


def edits(rows: DataFrame) -> DataFrame:
    """A stage table of ordered rows' edits: conv, __place, edit, role (if another), lead and tail (initials of rows inserted before and, at the end, after).

    A row with place -1 for each conversation has SUMMARY and the audit instead.
    """
    conv = rows.schema["conv"].dataType
    fields = [("conv", conv), ("__place", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("lead", T.StringType()), ("tail", T.StringType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields + [(n, T.LongType()) for n in SUMMARY] + [("audit", T.StringType())]])
    dealt = faults(rows).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "__place")

    def run(batches):
        automaton, width = Determinised(), len(schema)

        def table(lines: list[tuple]) -> pa.RecordBatch:
            columns = zip(*(line + (None,) * (width - len(line)) for line in lines), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        def closed(conv, codes, places, turns, counts) -> Iterator[tuple]:
            cost, audit, ways = automaton.repair(codes)
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            yield (conv, -1, None, None, None, None, gaps, *counts, cost, "".join(audit))
            last = None
            for k, (lead, edit, initial) in enumerate(ways):
                if k == len(places):
                    yield (*last[:5], lead or None)
                    return
                if last:
                    yield last
                last = (conv, places[k], edit, ROLES.get(initial), lead or None)

        now, lines, types = None, [], None
        for batch in batches:
            if types is None:
                types = [batch.schema.types[0], pa.int64(), *[pa.string()] * 4, *[pa.int64()] * len(SUMMARY), pa.string()]
            for conv, place, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now[0]:
                    if now:
                        for line in closed(*now):
                            lines.append(line)
                            if len(lines) >= 5000:
                                yield table(lines)
                                lines = []
                    now, before = (conv, bytearray(), array("q"), [0, 0, 0], [0, 0, 0, 0]), None
                _, codes, places, turns, counts = now
                codes.append(automaton.code(initial, fault))
                places.append(place)
                if turn is not None:
                    turns[:] = [turns[0], turn, turns[2] + (turn != turns[1])] if turns[2] else [turn, turn, 1]
                if fault:
                    counts[fault - 1] += 1
                counts[3] += before is not None and before + initial not in LEGAL
                before = initial
        if now:
            lines += closed(*now)
        for a in range(0, len(lines), 5000):
            yield table(lines[a : a + 5000])

    return stage_table(dealt.mapInArrow(run, schema), "conversation-edits")


def _joined(rows: DataFrame, found: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Of each conversation in order: itself, its summary, and each row's edit before the row."""
    both = found.withColumn("kind", F.lit(1)).unionByName(rows.select("conv", "__place", "role", "text", F.lit(2).alias("kind")), True)
    if originals is not None:
        both = both.unionByName(originals.select(F.col("conv"), F.lit(-2).cast("long").alias("__place"), F.lit(0).alias("kind")), True)
    return both.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "__place", "kind")


def _lines(edit: dict, role: str, text: str) -> list[tuple[str, str, str]]:
    """(edit, role, text) of what becomes of a row and of the rows inserted around it."""
    out = [("I", ROLES[c], "") for c in edit["lead"] or ""]
    if edit["edit"] != "D":
        out.append((edit["edit"], edit["role"] or role, text))
    return out + [("I", ROLES[c], "") for c in edit["tail"] or ""]


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations' rows: conv, __place and part (their order), edit, role, text."""
    schema = T.StructType([rows.schema["conv"], T.StructField("__place", T.LongType()), T.StructField("part", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])

    def run(batches):
        edit = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    edit = row
                else:
                    out += [{"conv": row["conv"], "__place": row["__place"], "part": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(_lines(edit, row["role"], row["text"]))]
            fields = [batch.schema.field("conv"), ("__place", pa.int64()), ("part", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(fields))

    columns = ("conv", "__place", "kind", "edit", "role", "text", "lead", "tail")
    return _joined(rows, found.where("__place >= 0")).select(*columns).mapInArrow(run, schema)


def summaries(rows: DataFrame, found: DataFrame, originals: DataFrame) -> DataFrame:
    """conv, SUMMARY, audit and repaired_sha256 of each of originals' conversations, whether it has rows or not."""
    schema = T.StructType([rows.schema["conv"], *(T.StructField(n, T.LongType()) for n in SUMMARY), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        now, digest, first, edit, names = None, None, True, None, schema.names
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if now:
                        out.append(now | {"repaired_sha256": digest.hexdigest()})
                    now, digest, first = {"conv": row["conv"], "audit": ""} | dict.fromkeys(SUMMARY, 0), hashlib.sha256(), True
                elif row["__place"] == -1:
                    now |= {k: row[k] for k in (*SUMMARY, "audit")}
                elif row["kind"] == 1:
                    edit = row
                else:
                    for _, role, text in _lines(edit, row["role"], row["text"]):
                        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                        first = False
            fields = pa.schema([batch.schema.field("conv"), *((n, pa.int64()) for n in SUMMARY), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(out, fields)
        if now:
            yield pa.RecordBatch.from_pylist([now | {"repaired_sha256": digest.hexdigest()}], fields)

    return _joined(rows, found, originals).mapInArrow(run, schema)


def repair(rows: DataFrame, originals: DataFrame | None = None, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation of originals (rows, if not given): its id, SUMMARY, the audit of its cheapest repair and repaired_sha256."""
    ids = (rows if originals is None else originals).select(F.col(id_col).alias("conv")).distinct()
    held = ordered(rows, id_col, turn_col, role_col, text_col)
    return summaries(held, edits(held), ids).withColumnRenamed("conv", id_col)
