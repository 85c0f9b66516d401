"""Exact deduplication with a two-pass Bloom filter, in DataFrame functions only.

Pass 1 hashes every row into two slots of a bit array and keeps the bits that were hit more than once. Pass 2 tests each
row against that array: a row with a bit that only it hits is unique and passes straight through; only the others
(copies, and a few false positives) shuffle, by digest. The array is sized from the row count up to max_bits, so
its broadcast is bounded (32 MB); beyond that more unique rows shuffle, with the same result.

Groups that hold a 1/HEAVY_SHARE part of all rows are at most HEAVY_SHARE, so they are broadcast and their rows don't
shuffle; no other group is large enough to weigh on one task. The group table is pre-aggregated map-side.

Defined cases: null text is the empty text; a null id ranks below all others; of rows alike in id and text one stays, with its own values in other columns;
an empty table gives an empty result; columns named like the outputs are replaced; texts of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HEAVY_SHARE, ascii_lower, bit_count, bit_table, numbered, stage_table, with_bits

OWN = ("keep_id", "group_size", "kept", "text_sha256")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


def _slots(sha: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(sha, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def repeated_bits(prints: DataFrame, bits: int) -> DataFrame:
    """Pass 1: the bits hit at least twice, as (bucket, bitmap) rows, at most bits / 32768 of them."""
    hits = prints.select(F.explode(F.array(*_slots(F.col("__sha"), bits))).alias("slot"))
    return bit_table(hits.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1"))


def _maybe_repeated(rows: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Pass 2: adds the flag __maybe."""
    return with_bits(rows, _slots(F.col("__sha"), bits), bitmaps)


def _fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return stage_table(docs.select(F.col(id_col).alias("__id"), digest(F.col(text_col)).alias("__sha")), "fingerprints")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """All rows and columns of docs with keep_id, group_size, kept, text_sha256; texts equal up to A-Z case form a group and its largest id stays."""
    docs = docs.drop(*(c for c in OWN if c not in (id_col, text_col)))
    return _marked(docs.withColumn("__sha", digest(F.col(text_col))), _fingerprints(docs, id_col, text_col), id_col, max_bits)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """The same without columns of docs but the id: texts are read and hashed once, and rows of some 50 bytes go through the filter."""
    prints = _fingerprints(docs, id_col, text_col)
    return _marked(prints.select(F.col("__id").alias(id_col), "__sha"), prints, id_col, max_bits)


def _marked(ids: DataFrame, prints: DataFrame, id_col: str, max_bits: int) -> DataFrame:
    """ids (id_col, __sha and others) with OWN; prints: __id and __sha of the same rows."""
    n = prints.count()
    bits = bit_count(n, max_bits)
    bitmaps = stage_table(repeated_bits(prints, bits), "repeated-bits")

    # copies of one id inside a group are told apart by count: all of them but one go
    groups = (
        _maybe_repeated(prints, bitmaps, bits).where("__maybe").groupBy("__sha", "__id").agg(F.count("*").alias("c"))
        .groupBy("__sha").agg(F.sum("c").alias("__size"), F.max(F.struct(F.col("__id").alias("id"), F.col("c"))).alias("top"))
        .select("__sha", "__size", F.col("top.id").alias("__keep"), (F.col("top.c") > 1).alias("__tie"))
    )
    groups = stage_table(groups.where("__size > 1"), "groups")
    heavy_from = max(2, -(-n // HEAVY_SHARE))

    rows = _maybe_repeated(ids, bitmaps, bits)
    none = {"__size": F.lit(1).cast("long"), "__keep": F.col(id_col), "__tie": F.lit(False)}
    straight = rows.where("not __maybe").withColumns(none)
    heavy = F.broadcast(groups.where(F.col("__size") >= heavy_from))
    maybe = rows.where("__maybe").join(heavy, "__sha", "left")
    rest = maybe.where("__size is null").drop("__size", "__keep", "__tie").join(groups.where(F.col("__size") < heavy_from), "__sha", "left")
    rest = rest.withColumns({"__keep": F.when(F.col("__size").isNull(), F.col(id_col)).otherwise(F.col("__keep")), "__size": F.coalesce("__size", F.lit(1).cast("long")), "__tie": F.coalesce("__tie", F.lit(False))})
    found = straight.unionByName(maybe.where("__size is not null")).unionByName(rest)
    out = found.withColumn("kept", F.col(id_col).eqNullSafe(F.col("__keep")))
    out = _one_of_ties(out) if groups.where("__tie").limit(1).count() else out
    named = {"keep_id": F.col("__keep"), "group_size": F.col("__size"), "text_sha256": F.lower(F.hex("__sha"))}
    return out.withColumns(named).drop("__sha", "__size", "__keep", "__maybe", "__tie")


def _one_of_ties(rows: DataFrame) -> DataFrame:
    """Where the row that stays has twins alike in id and text, one of them stays: one whose columns have the least hash."""
    tie = F.col("kept") & F.col("__tie")
    twins = rows.where(tie).withColumn("__hash", F.xxhash64(*(c for c, t in rows.dtypes if "map<" not in t)))
    least = twins.groupBy("__sha").agg(F.min("__hash").alias("__least"))
    least = least.select(F.col("__sha").alias("__of"), F.col("__least"))
    twins = twins.join(least, F.col("__sha") == F.col("__of")).withColumn("__first", F.col("__hash") == F.col("__least")).drop("__of", "__least", "__hash")
    twins = numbered(twins, ["__sha", "__first"], "twins").withColumn("kept", F.col("__first") & (F.col("__number") == 1))
    return rows.where(~tie).unionByName(twins.select(*rows.columns))
