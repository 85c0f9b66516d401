"""Classification of shared rows by how their two peptides differ (Q17-Q19).

Tier, distance, mass and flags are expressions; only the alignment runs in Python, once for each distinct pair of peptides, and
on arrays over many pairs of equal lengths at a time.
"""

from __future__ import annotations

from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import residues
from ..functions.alignment import Alignment, label_of
from ..functions.alignment_batch import align_stream, kinds, name_of, places
from ..functions.columns import shared_kind

PAIR = "SEQUENCE_database", "SEQUENCE_denovo"
EVENT = "struct<event: string, pos: int, seq1: string, seq2: string, k: int, description: string>"
NAMED = {"a": "string", "b": "string", "event": "string", "error": "string"}
DETAILS = {"change_summary": "string", "first": "string", "marks": "string", "second": "string", "score": "double", "events": f"array<{EVENT}>"}
ARROW = {"string": pa.string(), "double": pa.float64()}
ROWS = 10_000


def event_columns(found: list[Alignment | Exception]) -> tuple[pa.Array, pa.Array]:
    """Of each alignment its events and their summary, column by column; where they are and what they are called is remembered by the alignment's marks."""
    ends, summaries = [0], []
    names, starts, ones, twos, sizes, texts = [], [], [], [], [], []
    for f in found:
        if isinstance(f, Exception):
            ends.append(len(names))
            summaries.append(None)
            continue
        first, second, before = f.first, f.second, len(texts)
        for name, start, k in places(kinds(f))[1]:
            one, two = first[start : start + k].replace("-", ""), second[start : start + k].replace("-", "")
            names.append(name)
            starts.append(start)
            ones.append(one)
            twos.append(two)
            sizes.append(k)
            texts.append(f"{name}({one}->{two})@{start + 1}" if k else "")
        ends.append(len(names))
        summaries.append("+".join(filter(None, texts[before:])))
    fields = {"event": pa.array(names, pa.string()), "pos": pa.array(starts, pa.int32()), "seq1": pa.array(ones, pa.string()), "seq2": pa.array(twos, pa.string()), "k": pa.array(sizes, pa.int32()), "description": pa.array(texts, pa.string())}
    failed = pa.array([isinstance(f, Exception) for f in found], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)), mask=failed), pa.array(summaries, pa.string())


def align_pairs(pairs: DataFrame, details: bool | tuple[str, ...] = True) -> DataFrame:
    """pairs: a, b. Adds the name of the events that separate them, or an error text where a pair fails; with details, all or those named, the alignment and its events too."""
    more = tuple(DETAILS) if details is True else details or ()
    schema = NAMED | {c: DETAILS[c] for c in more}

    def table(rows: list[tuple[str, str, Alignment | Exception]]) -> pa.RecordBatch:
        a, b, found = map(list, zip(*rows, strict=True))
        good = [None if isinstance(f, Exception) else f for f in found]
        out = {"a": a, "b": b, "event": [f and name_of(f) for f in good], "error": [None if g else f"{type(f).__name__}: {f}" for f, g in zip(found, good, strict=True)]}
        out |= {c: [f and getattr(f, c) for f in good] for c in more if c in Alignment._fields}
        columns = {c: pa.array(v, ARROW[schema[c]]) for c, v in out.items()}
        if {"events", "change_summary"} & set(more):
            columns["events"], columns["change_summary"] = event_columns(found)
        return pa.RecordBatch.from_arrays([columns[c] for c in schema], list(schema))

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)

        for some in batched(align_stream(rows()), ROWS):
            yield table(some)

    return pairs.select("a", "b").mapInArrow(run, ", ".join(f"{c} {t}" for c, t in schema.items()))


def with_pair_measures(df: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Adds levenshtein, tier, mass1, mass2, isobaric and anagram of two columns."""
    df = df.withColumns({"levenshtein": F.levenshtein(F.col(a), F.col(b)), "mass1": residues.mass(F.col(a)), "mass2": residues.mass(F.col(b)), "anagram": residues.anagram(F.col(a), F.col(b))})
    return df.withColumns({"tier": residues.tier(F.col("levenshtein")), "isobaric": residues.isobaric(F.col("mass1"), F.col("mass2"))})


def label(tier: Column, isobaric: Column, event: Column, identical: Column) -> Column:
    graded = F.concat(F.lit("PSA - Tier "), tier.cast("string"), F.when(isobaric, " - ISOBARIC - ").otherwise(" - NONISOBARIC - "), event)
    return F.when(identical, label_of(0, True, "", True)).otherwise(graded)


def classify_pairs(pairs: DataFrame, details: bool | tuple[str, ...] = True) -> DataFrame:
    """Distinct (a, b) with measures, alignment (with details, all or those named) and label."""
    out = with_pair_measures(align_pairs(pairs.select("a", "b").distinct(), details))
    return out.withColumn("label", F.when(F.col("error").isNull(), label(F.col("tier"), F.col("isobaric"), F.col("event"), F.col("a") == F.col("b"))))


def with_similarity(scans: DataFrame) -> DataFrame:
    """Adds PSA, PSA_LEVENSHTEIN and PSA_ERROR to the scan table; null off shared rows.

    A missing sequence on a shared row is an error of that row, as no pair can be formed."""
    kind = shared_kind()
    a, b = (F.col(c) for c in PAIR)
    pairs = classify_pairs(scans.where((kind == "different") & a.isNotNull() & b.isNotNull()).select(a.alias("a"), b.alias("b")), details=False)
    pairs = pairs.select(F.col("a").alias("__a"), F.col("b").alias("__b"), F.col("label").alias("__label"), F.col("levenshtein").alias("__distance"), F.col("error").alias("__error"))
    out = scans.withColumn("__kind", kind).join(pairs, (F.col("__kind") == "different") & (a == F.col("__a")) & (b == F.col("__b")), "left")
    k = F.col("__kind")
    lost = (k == "different") & F.col("__a").isNull()
    failed = F.col("__error").isNotNull() | lost
    psa = F.when(k == "identical", "PSA - Tier 0 - IDENTICAL").when(k == "same_residues", "PSA - Tier 0 - IDENTICAL_UNMODIFIED").when(failed, "PSA_ERROR").when(k == "different", F.col("__label"))
    distance = F.when(k.isin("identical", "same_residues"), F.lit(0.0)).when((k == "different") & ~failed, F.col("__distance").cast("double"))
    error = F.when(lost, "ValueError: both sequences are needed").otherwise(F.col("__error"))
    return out.withColumns({"PSA": psa, "PSA_LEVENSHTEIN": distance, "PSA_ERROR": error}).drop("__kind", "__a", "__b", "__label", "__distance", "__error")
