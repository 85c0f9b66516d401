"""The batched alignment against the one of single pairs, and the object form against the columns."""

import random

import pytest

from pepweave.functions import alignment as A
from pepweave.functions import alignment_batch as B
from pepweave.operators import similarity

LETTERS = "ACDEFGHIKLMNPQRSTVWY"
ALIKE = {"N": "GG", "Q": "AG", "I": "L", "L": "I", "W": "DA", "K": "Q"}


def changed(rng, a):
    a = list(a)
    for _ in range(rng.randrange(4)):
        if not a:
            break
        k, how = rng.randrange(len(a)), rng.random()
        if how < 0.3:
            a[k] = rng.choice(LETTERS)
        elif how < 0.5:
            del a[k]
        elif how < 0.6:
            a.insert(k, rng.choice(LETTERS))
        elif how < 0.8:
            part = a[k : k + 4]
            rng.shuffle(part)
            a[k : k + 4] = part
        elif a[k] in ALIKE:
            a[k : k + 1] = ALIKE[a[k]]
    return "".join(a)


def random_pairs(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(rng.randrange(1, 14)))
    return sorted({(a, changed(rng, a) if rng.random() < 0.8 else word()) for a in (word() for _ in range(n))})


@pytest.mark.parametrize("most", [4096, 100])
def test_batches_align_like_single_pairs(monkeypatch, most):
    monkeypatch.setattr(B, "PAIRS", most)
    pairs = random_pairs(1, 12_000)
    got = {(a, b): found for a, b, found in B.align_stream(iter(pairs))}
    assert len(got) == len(pairs) > 10_000
    for (a, b), found in got.items():
        assert found == A.align(a, b), (a, b)
        assert B.name_of(found) == A.event_name(A.events(found))


def test_pairs_that_fail_and_odd_lengths():
    pairs = [("PEXP", "PEP"), ("", "A"), ("A", ""), ("pep", "PEP"), ("P" * 1100, "P" * 1000)] + [("PEPTIDE", "PEPTIDK")] * 40
    got = list(B.align_stream(iter(pairs)))
    assert sum(isinstance(f, A.Alignment) and f == A.align(a, b) for a, b, f in got) == 43
    assert sorted(str(f) for *_, f in got if isinstance(f, Exception)) == ["unsupported residue(s): X", "unsupported residue(s): p"]


def test_columns_and_objects_agree(spark):
    pairs = random_pairs(2, 300) + [("PEPTIDE", "PEPTIDE")]
    rows = {(r.a, r.b): r for r in similarity.classify_pairs(spark.createDataFrame(pairs, "a string, b string")).collect()}
    names = {(r.a, r.b): (r.event, r.label) for r in similarity.classify_pairs(spark.createDataFrame(pairs, "a string, b string"), details=False).collect()}
    for a, b in pairs:
        c, r = A.compare(a, b), rows[a, b]
        assert (c.levenshtein, c.tier, c.isobaric, c.anagram, c.mass1, c.mass2) == (r.levenshtein, r.tier, r.isobaric, r.anagram, r.mass1, r.mass2)
        assert (c.event, c.label, c.change_summary, c.alignment.first, c.alignment.marks, c.alignment.second, c.alignment.score) == (r.event, r.label, r.change_summary, r.first, r.marks, r.second, r.score)
        assert [vars(e) for e in c.events] == [e.asDict() for e in r.events] and names[a, b] == (c.event, c.label)
        aligner = A.PeptideAligner(a, b)
        assert aligner.tier_assignment() == c.tier and aligner.classify().label == c.label
