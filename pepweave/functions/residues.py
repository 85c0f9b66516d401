"""Scalar peptide functions as column expressions: mass, edit-distance tier, isobaric and anagram flags (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Published monoisotopic residue masses in Dalton; cysteine unmodified.
RESIDUE_MASS = {
    "A": 71.037114,
    "R": 156.101111,
    "N": 114.042927,
    "D": 115.026943,
    "C": 103.009185,
    "E": 129.042593,
    "Q": 128.058578,
    "G": 57.021464,
    "H": 137.058912,
    "I": 113.084064,
    "L": 113.084064,
    "K": 128.094963,
    "M": 131.040485,
    "F": 147.068414,
    "P": 97.052764,
    "S": 87.032028,
    "T": 101.047679,
    "W": 186.079313,
    "Y": 163.063329,
    "V": 99.068414,
}
#: The same in millionths, by letter.
MICRO = {k: round(v * 1_000_000) for k, v in RESIDUE_MASS.items()}
#: A distance below the bound has the tier; larger ones the last tier.
TIER_BOUNDS = ((1, 0), (4, 1), (7, 2), (10, 3), (13, 4))
LAST_TIER = 5
PPM = 5e-6


class UnsupportedResidue(ValueError):
    pass


def residue_mass(sequence: str) -> float:
    """Sum of residue masses, without water, to four decimals."""
    unknown = sorted(set(sequence) - RESIDUE_MASS.keys())
    if unknown:
        raise UnsupportedResidue(f"unsupported residue(s): {', '.join(unknown)}")
    return round(sum(map(RESIDUE_MASS.__getitem__, sequence)), 4)


def _letters(sequence: Column) -> Column:
    return F.filter(F.split(sequence, ""), lambda c: c != "")


def mass(sequence: Column) -> Column:
    """residue_mass as an expression, summed in millionths; null where a residue is unsupported."""
    table = F.array(*(F.lit(MICRO.get(chr(c))).cast("long") for c in range(ord("A"), ord("Z") + 1)))
    total = F.aggregate(_letters(sequence), F.lit(0).cast("long"), lambda t, c: t + F.get(table, F.ascii(c) - ord("A")))
    return F.floor((total + 50) / 100).cast("double") / 10_000.0


def unsupported(sequence: Column) -> Column:
    """The residues that have no mass, sorted."""
    return F.array_sort(F.array_distinct(F.array_except(_letters(sequence), F.array(*map(F.lit, RESIDUE_MASS)))))


def tier(distance: Column) -> Column:
    found = F.when(distance.isNull(), F.lit(None).cast("int"))
    for bound, t in TIER_BOUNDS:
        found = found.when(distance < bound, t)
    return found.otherwise(LAST_TIER)


def tier_of(distance: int) -> int:
    return next((t for bound, t in TIER_BOUNDS if distance < bound), LAST_TIER)


def isobaric(mass1: Column, mass2: Column, ppm: float = PPM) -> Column:
    return F.abs(mass1 - mass2) <= F.lit(ppm) * F.greatest(F.abs(mass1), F.abs(mass2), F.lit(1.0))


def anagram(a: Column, b: Column) -> Column:
    return (F.length(a) == F.length(b)) & (F.sort_array(_letters(a)) == F.sort_array(_letters(b)))
