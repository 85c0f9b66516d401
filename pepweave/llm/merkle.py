"""A Merkle manifest of a data set, built by superblock reduction.

Each row is a leaf. The leaves of a group (a language) ascend by id and are numbered without gathering them (common.ranked). They are dealt
into buckets of FANOUT^LEVELS consecutive ones, so that a bucket holds at most 4096 however large its group is, and applyInPandas collapses up
to LEVELS levels of the tree in each. The buckets' roots are the leaves of the next reduction, which is the same function again; the proofs of a
bucket's leaves are followed by that of its root. The groups' roots, in order of the group, are reduced likewise to one root.

A proof is two arrays, one entry for each level: a node's place in its run of at most FANOUT, and the others' digests. It is folded by
built-in functions. Upper proofs are some 250 bytes a level; they are broadcast for at most MAX_BROADCAST buckets or groups and joined by
shuffle beyond, with the same result. A row's text is hashed where it is read, and only digests shuffle.

Defined cases: a null value is hashed as `-`; a null group is a group of its own and comes first; null ids come first; rows alike in id
are in order of their digests, and rows alike throughout have a leaf each with proofs of their own; a group of one row has its leaf
as its root, and a single group its root as that of all, with nothing to prove; an empty table gives an empty result; a text of any length is one leaf; other
columns are not part of a leaf and don't come through, but for those that carry names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ranked, stage_table

FANOUT = 8
LEVELS = 4  # of the tree that one task collapses in a bucket
MAX_BROADCAST = 20_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as a leaf takes it in: its length in bytes and itself, or - for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """The digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def node(digests: list[bytes]) -> bytes:
    """The digest of a run of digests, which are hashed as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_above(count: int, most: int) -> int:
    """Levels until one node is left of so many, at most so many of them."""
    n = 0
    while count > 1 and n < most:
        count, n = -(-count // FANOUT), n + 1
    return n


def collapse(digests: list[bytes], levels: int) -> tuple[bytes, list[list[int]], list[list[bytes]]]:
    """The digest that so many levels make of a bucket's consecutive nodes, and of each node its places and the others of its runs."""
    places, others = [[] for _ in digests], [[] for _ in digests]
    now, width = list(digests), 1  # of leaves under one node
    for _ in range(levels):
        runs = [now[a : a + FANOUT] for a in range(0, len(now), FANOUT)]
        for r, run in enumerate(runs):
            for p in range(len(run)):
                rest = b"".join(run[:p] + run[p + 1 :])
                at = (r * FANOUT + p) * width
                for i in range(at, min(at + width, len(digests))):
                    places[i].append(p)
                    others[i].append(rest)
        now, width = [node(run) for run in runs], width * FANOUT
    return now[0], places, others


def prove(nodes: DataFrame, levels: int = LEVELS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """nodes: group, index (from 0, gapless), count (of the group), digest and any others. Adds places, others and top, the group's root."""
    size = FANOUT**levels
    bucket = F.floor(F.col("index") / F.lit(size)).cast("long")
    schema = T.StructType([*nodes.schema.fields, T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("others", T.ArrayType(T.BinaryType())), T.StructField("top", T.BinaryType())])

    def reduce(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index").drop(columns="__bucket")
        top, places, others = collapse([bytes(d) for d in rows["digest"]], levels_above(int(rows["count"].iloc[0]), levels))
        return rows.assign(places=places, others=others, top=[top] * len(rows))

    lower = stage_table(nodes.withColumn("__bucket", bucket).groupBy("group", "__bucket").applyInPandas(reduce, schema), "merkle-proofs")
    tops = lower.where(F.col("index") % size == 0).select("group", bucket.alias("index"), F.ceil(F.col("count") / F.lit(size)).cast("long").alias("count"), F.col("top").alias("digest"))
    if not tops.where("count > 1").limit(1).count():
        return lower
    upper = stage_table(prove(tops, levels, max_broadcast), "merkle-upper")
    upper = upper.select(F.col("group").alias("__g"), F.col("index").alias("__b"), F.col("places").alias("__p"), F.col("others").alias("__o"), F.col("top").alias("__t"))
    side = F.broadcast(upper) if upper.count() <= max_broadcast else upper
    both = lower.join(side, F.col("group").eqNullSafe(F.col("__g")) & (bucket == F.col("__b")))
    both = both.withColumns({"places": F.concat("places", "__p"), "others": F.concat("others", "__o"), "top": F.col("__t")})
    return both.drop("__g", "__b", "__p", "__o", "__t")


def folded(digest: Column, places: Column, others: Column) -> Column:
    """The root that a leaf and its proof lead to, as hexadecimal text."""

    def step(now: Column, level: Column) -> Column:
        rest, at = F.lower(F.hex(level["others"])), level["places"] * 64
        return F.sha2(F.concat(F.substr(rest, F.lit(1), at), now, F.substr(rest, at + 1)).cast("binary"), 256)

    return F.aggregate(F.arrays_zip(places.alias("places"), others.alias("others")), F.lower(F.hex(digest)), step)


def proof_digest(others: Column) -> Column:
    """The digest of a proof's digests, level by level and left to right."""
    return F.sha2(F.lower(F.array_join(F.transform(others, lambda x: F.hex(x)), "")).cast("binary"), 256)


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS, levels: int = LEVELS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, group, leaf, subroot, root (32 bytes each), places and others (the proof) and what carry names."""
    extra = dict(carry or {})
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("group"), leaf([F.col(c) for c in columns]).alias("digest"), *(c.alias(f"__with_{k}") for k, c in extra.items()))
    rows = ranked(rows, "group", ["id", "digest"], "merkle-leaves").withColumnsRenamed({"__index": "index", "__count": "count"})
    leaves = prove(rows, levels, max_broadcast)

    groups = leaves.where("index = 0").select(F.col("group").alias("name"), F.col("top").alias("digest"), F.lit(0).alias("group"))
    groups = ranked(groups, "group", ["name"], "merkle-groups").withColumnsRenamed({"__index": "index", "__count": "count"})
    groups = stage_table(prove(groups, levels, max_broadcast), "merkle-root")
    groups = groups.select(F.col("name").alias("__n"), F.col("places").alias("__p"), F.col("others").alias("__o"), F.col("top").alias("__t"))
    side = F.broadcast(groups) if groups.count() <= max_broadcast else groups
    out = leaves.join(side, F.col("group").eqNullSafe(F.col("__n")))
    return out.select(
        F.col("id").alias(id_col), "group", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.col("__t").alias("root"),
        F.concat("places", "__p").alias("places"), F.concat("others", "__o").alias("others"), *(F.col(f"__with_{k}").alias(k) for k in extra),
    )
