"""Mixing sources to target weights, in DataFrame functions only.

Words are summed per source (pre-aggregated map-side), targets are found by water filling, and each document is emitted
floor(rate) times, plus one more with probability equal to the fraction, decided by a hash of its id and text. The rate table has
one row per source; it is broadcast if it has at most max_broadcast rows, else joined by shuffle, where adaptive
execution splits a hot source. Sources are ranked by ranges, so that no task needs all of them.

Defined cases: null text has size 0; a null source is a source of its own, ranked last; a null id is hashed as an
empty text; rows alike in id, text and source are numbered, and each draws for itself, so many rows without an id come near their target too;
if all sizes are 0 all targets are 0 and nothing is emitted; an empty table gives an empty result; columns named like the outputs are replaced, other
columns come through; a text of any length is one row, whose words are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, ranked, stage_table

CEILING = 3  # a target stops at so many times its source's size
SEED = "mix-17:"
OWN = ("size", "source_size", "target", "copies")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the parts, as text, and the seed only; nulls count as empty."""
    named = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    h = F.md5(F.concat(F.lit(seed), named).cast("binary"))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, ceiling: int = CEILING) -> DataFrame:
    """(__source, source_size) to the same with target: weights 1, 2, 3 repeating by source share the sum, none above ceiling times its size.

    The level L solves sum(min(weight * L, ceiling * size)) = sum(size): from the level of all, sources that it would fill beyond their ceiling
    are taken as full and the level of the rest, which is higher, is found, until no more are full. Each round sums up the table.
    """
    sizes = sizes.withColumns({"__all": F.lit(0), "__none": F.col("__source").isNull()})
    rows = ranked(sizes, "__all", ["__none", "__source"], "source-ranks")
    full_at = F.col("source_size") * F.lit(float(ceiling)) / F.col("w")
    rows = stage_table(rows.select("__source", "source_size", (F.col("__index") % 3 + 1).alias("w")).withColumn("full_at", full_at), "source-sizes")
    total, weight = rows.agg(F.sum("source_size"), F.sum("w")).first()
    level, full = (total / weight if weight else 0.0), 0
    while True:
        size, w, n = rows.where(F.col("full_at") < F.lit(level)).agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0)), F.count("*")).first()
        if n == full or w == weight:
            break
        level, full = (total - ceiling * size) / (weight - w), n
    return rows.select("__source", "source_size", F.least(F.col("w") * F.lit(float(level)), F.col("source_size") * F.lit(float(ceiling))).alias("target"))


def mix_to_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_broadcast: int = 100_000) -> DataFrame:
    """All rows and columns of docs with size, source_size, target and copies (how often the mix emits the row)."""
    docs = docs.drop(*(c for c in OWN if c not in (id_col, text_col, source_col)))
    sizes = docs.groupBy(F.col(source_col).alias("__source")).agg(F.sum(words(F.col(text_col))).alias("source_size"))
    rates = stage_table(targets(sizes), "rates")
    side = F.broadcast(rates) if rates.count() <= max_broadcast else rates
    rows = _told_apart(docs, id_col, text_col, source_col, max_broadcast)
    rows = rows.join(side, F.col(source_col).eqNullSafe(F.col("__source")), "left").drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    drawn = uniform(F.col(id_col), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")), F.col("__number"))
    rows = rows.withColumn("size", words(F.col(text_col))).withColumn("copies", (whole + F.when(drawn < rate - whole, 1).otherwise(0)).cast("int"))
    return rows.drop("__number")


def _told_apart(docs: DataFrame, id_col: str, text_col: str, source_col: str, max_broadcast: int) -> DataFrame:
    """docs with __number, which counts rows alike in id, text and source from 1, so that each draws for itself. Only hashes shuffle, and then the rows that have their like."""
    rows = docs.withColumn("__key", F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col, source_col))))
    repeated = stage_table(rows.groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1").select(F.col("__key").alias("__again")), "mixing-repeated")
    n = repeated.count()
    if not n:
        return rows.withColumn("__number", F.lit(1).cast("long")).drop("__key")
    side = F.broadcast(repeated) if n <= max_broadcast else repeated
    match = F.col("__key") == F.col("__again")
    alike = numbered(rows.join(side, match, "left_semi"), [source_col, id_col, text_col], "mixing-alike")
    return rows.join(side, match, "left_anti").withColumn("__number", F.lit(1).cast("long")).unionByName(alike.select(*rows.columns, F.col("__number").cast("long"))).drop("__key")


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as copies says, without the operator's columns."""
    n = F.col("copies")
    out = mixed.where(n > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), n)))
    return out.drop("__copy", *OWN)
