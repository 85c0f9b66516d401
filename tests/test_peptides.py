"""Alignment, events and labels of peptide pairs, and the expressions beside them."""

import pytest
from pyspark.sql import functions as F

from pepweave.functions import residues
from pepweave.functions.alignment import PeptideAligner, align, compare, levenshtein
from pepweave.operators.similarity import with_similarity

#: Published pairs and what must come of them.
GOLDEN = [
    ("PEPTIDAEPGRWHKFEK", "PEPIATDEPGRHWFKEK", "SHUFFLE+SHUFFLE", "SHUFFLE(TIDA->IATD)@4+SHUFFLE(WHKF->HWFK)@12", "|||xxxx||||xxxx||"),
    ("AKDEITFGHKMPQ", "ADKEITFGHMKPQ", "SWAP+SWAP", "SWAP(KD->DK)@2+SWAP(KM->MK)@10", "|xx||||||xx||"),
    ("PEPTIDEK", "PEPIDTEK", "SHUFFLE", "SHUFFLE(TID->IDT)@4", "|||xxx||"),
    ("PEPTIDEK", "PEPIDTEIK", "SHUFFLE+INSERTION", "SHUFFLE(TID->IDT)@4+INSERTION(->I)@8", "|||xxx|-|"),
    ("PEPTIKEK", "PEPTIGAEK", "INSERTION+SUBSTITUTION", "INSERTION(->G)@6+SUBSTITUTION(K->A)@7", "|||||-.||"),
    ("PEPTGGEK", "PEPTNEK", "ISOBARIC-SUBSTITUTION", "ISOBARIC-SUBSTITUTION(GG->N)@5", "||||==||"),
    ("PEPTIDEK", "PEPTQDEK", "SUBSTITUTION", "SUBSTITUTION(I->Q)@5", "||||.|||"),
    ("PEPTIDEK", "AEPTIDEK", "N-TERM-MISMATCH", "N-TERM-MISMATCH(P->A)@1", ".|||||||"),
    ("PEPTIDEK", "PEPTIDER", "C-TERM-MISMATCH", "C-TERM-MISMATCH(K->R)@8", "|||||||."),
    ("PEPTIDEKAR", "AEPTIDEKAK", "N-TERM-MISMATCH+C-TERM-MISMATCH", "N-TERM-MISMATCH(P->A)@1+C-TERM-MISMATCH(R->K)@10", ".||||||||."),
    ("PEPTIDEK", "AAPTIDEA", "SUBSTITUTION+SUBSTITUTION", "SUBSTITUTION(PE->AA)@1+SUBSTITUTION(K->A)@8", "..|||||."),
    ("HTVGELLMADR", "TFAHTESHLSK", "SUBSTITUTION", "SUBSTITUTION(HTVGELLMADR->TFAHTESHLSK)@1", "..........."),
    ("PEPTIDEK", "PEPTVDEK", "SUBSTITUTION", "SUBSTITUTION(I->V)@5", "||||.|||"),
    ("PEPTIDEK", "PEPTIEK", "DELETION", "DELETION(D->)@6", "|||||-||"),
    ("PEPTIDEK", "PEPTIDEK", "IDENTICAL", "", "||||||||"),
    ("PEPTLDEK", "PEPTIDEK", "ISOBARIC-SUBSTITUTION", "ISOBARIC-SUBSTITUTION(L->I)@5", "||||=|||"),
    ("", "AK", "INSERTION", "INSERTION(->AK)@1", "--"),
]


@pytest.mark.parametrize("a,b,event,summary,marks", GOLDEN)
def test_events(a, b, event, summary, marks):
    found = compare(a, b)
    assert (found.event, found.change_summary, found.alignment.marks) == (event, summary, marks)
    assert found.levenshtein == levenshtein(b, a)


def test_more_than_two_events():
    assert compare("PEPTIDEK", "KEDITPEP").event == "MULTIEVENT"


def test_labels_and_text():
    assert compare("PEPTIDEK", "PEPTIDEK").label == "PSA - Tier 0 - IDENTICAL"
    assert compare("PEPTIDEK", "PEPTQDEK").label == "PSA - Tier 1 - NONISOBARIC - SUBSTITUTION"
    assert "||||.|||" in compare("PEPTIDEK", "PEPTQDEK").to_text()


def test_an_aligner_can_be_used_again():
    p = PeptideAligner()
    distances = []
    for a, b in (("PEPTIDEK", "PEPTIEDK"), ("AKDEITFGHKMPQ", "ADKEITFGHMKPQ"), ("PEPTIDEK", "PEPTIDEK")):
        p.set_sequences(a, b).tier_assignment()
        distances.append(p.result.levenshtein)
    assert distances == [2, 4, 0]
    with pytest.raises(ValueError):
        p.set_sequences(None, "AK")
    with pytest.raises(residues.UnsupportedResidue, match="1, Z"):
        residues.residue_mass("AZ1K")


@pytest.mark.parametrize("distance,tier", [(0, 0), (1, 1), (3, 1), (4, 2), (6, 2), (7, 3), (9, 3), (10, 4), (12, 4), (13, 5), (40, 5)])
def test_tiers(spark, distance, tier):
    assert residues.tier_of(distance) == tier
    assert spark.range(1).select(residues.tier(F.lit(distance))).first()[0] == tier


def test_expressions(spark):
    rows = spark.createDataFrame([("PEPTGGEK", "PEPTNEK"), ("PEPTIDEK", "PEPITDEK"), ("AZ", "AK"), (None, "AK"), ("", "")], "a string, b string")
    out = rows.select(residues.mass(F.col("a")).alias("m"), residues.isobaric(residues.mass(F.col("a")), residues.mass(F.col("b"))).alias("i"), residues.anagram(F.col("a"), F.col("b")).alias("n"), residues.unsupported(F.col("a")).alias("u")).collect()
    assert out[0].m == pytest.approx(residues.residue_mass("PEPTGGEK"), abs=1e-3) and out[0].i and not out[0].n
    assert out[1].i and out[1].n
    assert out[2].m is None and out[2].u == ["Z"] and out[3].m is None and out[4].m == 0


def test_dispatch(spark):
    schema = "_merge string, SEQUENCE_database string, SEQUENCE_denovo string, MODIFIED_SEQUENCE_database string, MODIFIED_SEQUENCE_denovo string, PRECURSOR_CHARGE_database int, PRECURSOR_CHARGE_denovo int"
    rows = [
        ("shared", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", 2, 2),
        ("shared", "PEPTMDEK", "PEPTMDEK", "PEPTM[UNIMOD:35]DEK", "PEPTMDEK", 2, 2),
        ("shared", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", 2, 3),
        ("shared", "PEPTIDEK", "PEPTIEDK", "PEPTIDEK", "PEPTIEDK", 2, 2),
        ("shared", "PEPTIDEK", "PEPZ", "PEPTIDEK", "PEPZ", 2, 2),
        ("shared", "PEPTIDEK", None, "PEPTIDEK", None, 2, 2),
        ("database_only", "PEPTIDEK", None, "PEPTIDEK", None, 2, 2),
        ("denovo_only", None, "PEPTIDEK", None, "PEPTIDEK", 2, 2),
    ]
    from pepweave.functions.columns import with_match_flags

    out = with_similarity(with_match_flags(spark.createDataFrame(rows, schema))).collect()
    by = {(r._merge, r.SEQUENCE_database, r.SEQUENCE_denovo, r.MODIFIED_SEQUENCE_database, r.PRECURSOR_CHARGE_denovo): r for r in out}
    assert len(out) == len(rows) == len(by)
    get = lambda *k: (by[k].PSA, by[k].PSA_LEVENSHTEIN)
    assert get("shared", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", 2) == ("PSA - Tier 0 - IDENTICAL", 0)
    assert get("shared", "PEPTMDEK", "PEPTMDEK", "PEPTM[UNIMOD:35]DEK", 2) == ("PSA - Tier 0 - IDENTICAL_UNMODIFIED", 0)
    assert get("shared", "PEPTIDEK", "PEPTIDEK", "PEPTIDEK", 3) == ("PSA - Tier 0 - IDENTICAL_UNMODIFIED", 0)
    assert get("shared", "PEPTIDEK", "PEPTIEDK", "PEPTIDEK", 2) == ("PSA - Tier 1 - ISOBARIC - SWAP", 2)
    bad = by["shared", "PEPTIDEK", "PEPZ", "PEPTIDEK", 2]
    assert bad.PSA == "PSA_ERROR" and bad.PSA_LEVENSHTEIN is None and bad.PSA_ERROR.startswith("UnsupportedResidue")
    assert by["shared", "PEPTIDEK", None, "PEPTIDEK", 2].PSA == "PSA_ERROR"
    assert get("database_only", "PEPTIDEK", None, "PEPTIDEK", 2) == get("denovo_only", None, "PEPTIDEK", None, 2) == (None, None)


def test_alignment_invariants():
    import random

    rng = random.Random(3)
    for _ in range(150):
        a = "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(rng.randint(0, 14)))
        b = "".join(rng.choice(list(a) or ["A"]) if rng.random() < 0.2 else c for c in a)
        found = align(a, b)
        assert found.first.replace("-", "") == a and found.second.replace("-", "") == b
        assert found.score >= align(a, b).marks.count("|") * 2 - 2 * (len(a) + len(b))
