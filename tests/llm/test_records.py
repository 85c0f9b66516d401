"""Personal data, conversation repair and Merkle manifests against brute force; rows that only numbering tells apart."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pepweave.llm import conversation_repair, exact_dedup, merkle, mixing, personal_data
from pepweave.llm.common import numbered, ranked
from pepweave.llm.queries import QUERIES, damaged

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("pii", "candidates", "group", "digest", "index", "count", "leaf", "root", "places", "conv", "audit", "kind", "__place", "id")


def clashing(df):
    return df.withColumns({c: F.lit("theirs") for c in CLASHES if c not in df.columns})


# ranks and numbers


def test_ranked_and_numbered(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "a", "a", None]), rng.randrange(40)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    for most in (100_000, 0):
        got = ranked(df, "g", ["v"], "t", most).collect()
        for g in ("a", "b", None):
            own = sorted((r["__index"], r.v, r["__count"]) for r in got if r.g == g)
            assert [x[0] for x in own] == list(range(len(own)))
            assert [x[1] for x in own] == sorted(v for x, v in rows if x == g)
            assert {x[2] for x in own} == {len(own)}
    seen = collections.defaultdict(list)
    for r in numbered(df, ["g", "v"], "t").collect():
        seen[r.g, r.v].append(r["__number"])
    assert sum(map(len, seen.values())) == 500 and all(sorted(n) == list(range(1, len(n) + 1)) for n in seen.values())


def test_mixing_rows_without_id_come_near_their_target(spark):
    rows = [(None, f"w{k % 300} x y", None, "a", 0) for k in range(3000)] + [(k, "one two three four " * 20, None, "b", 0) for k in range(900)] + [(7, "same row", None, "c", 0)] * 3000
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = collections.defaultdict(lambda: [0, 0.0])
    decided = []
    for r in mixing.mix_to_targets(df).collect():
        got[r.source][0] += r.size * r.copies
        got[r.source][1] = r.target
        decided.append((r.doc_id, r.text, r.copies))
    assert all(abs(taken - target) < 0.06 * target for taken, target in got.values()), got
    again = [(r.doc_id, r.text, r.copies) for r in mixing.mix_to_targets(df.repartition(3), max_broadcast=0).collect()]
    assert collections.Counter(decided) == collections.Counter(again)


@pytest.mark.parametrize("seed", range(4))
def test_mixing_targets_against_water_filling(spark, seed):
    rng = random.Random(seed)
    sizes = [(f"s{k:02}", rng.choice([0, 1, 5, 60, 1000, 40_000])) for k in range(rng.randrange(1, 30))] + [(None, 17)]
    got = {r["__source"]: r.target for r in mixing.targets(spark.createDataFrame(sizes, "__source string, source_size long")).collect()}
    ceiling, weight = {s: 3 * n for s, n in sizes}, {s: k % 3 + 1 for k, (s, _) in enumerate(sizes)}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(weight[s] * mid, ceiling[s]) for s in weight) < sum(n for _, n in sizes) else (low, mid)
    assert all(abs(got[s] - min(weight[s] * high, ceiling[s])) < 1e-3 for s in weight)


def test_exact_dedup_keeps_twins_own_values(spark):
    rows = [(1, "x", "a"), (1, "x", "b"), (1, "x", "b"), (0, "X", "c"), (None, "y", "d"), (None, "y", "e"), (2, "z", "f")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string, other string").repartition(4)).collect()
    assert sorted(map(str, rows)) == sorted(str((r.doc_id, r.text, r.other)) for r in got)
    kept = collections.Counter((r.text.lower(), r.kept) for r in got)
    assert kept == {("x", True): 1, ("x", False): 3, ("y", True): 1, ("y", False): 1, ("z", True): 1}


# Merkle manifest


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row):
    doc_id, text, lang, source, n = row
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text))


def tree_by_hand(leaves):
    """The root and each leaf's runs: (siblings before, after) a level."""
    proofs, at, now = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(now) > 1:
        for i, a in enumerate(at):
            run = now[a // 8 * 8 : a // 8 * 8 + 8]
            proofs[i].append(("".join(run[: a % 8]), "".join(run[a % 8 + 1 :])))
        now, at = [H(now[k : k + 8]) for k in range(0, len(now), 8)], [a // 8 for a in at]
    return now[0], proofs


def manifest_by_hand(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0] is not None, r[0] or 0, leaf_by_hand(r), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = [tree_by_hand([x[2] for x in sorted(by[lang], key=lambda x: x[:3])]) for lang in langs]
    root, upper = tree_by_hand([t[0] for t in trees])
    return [(r[0], leaf, top, root, p + up) for lang, (top, proofs), up in zip(langs, trees, upper) for (_, _, leaf, r), p in zip(sorted(by[lang], key=lambda x: x[:3]), proofs)]


def document_rows(n, langs, seed=0):
    rng = random.Random(seed)
    rows = [(k, f"Text {k} é" * rng.randrange(4), rng.choice(langs), rng.choice(["a", "b", None]), rng.choice([None, k])) for k in range(n)]
    return rows + [(None, None, None, None, None), (None, None, None, None, None), (5, "again", langs[0], "a", 1), (5, "again", langs[0], "a", 1), (n, "x" * 3_000_000, langs[0], "", 0)]


@pytest.mark.parametrize("levels,broadcast,n,langs", [(4, 20_000, 700, ["en", "de", None]), (1, 0, 300, ["en"] * 9 + ["z"]), (2, 0, 150, [f"l{k}é" for k in range(30)]), (1, 20_000, 60, ["one"])])
def test_merkle_against_brute_force(spark, levels, broadcast, n, langs):
    rows = document_rows(n, langs)
    out = merkle.manifest(clashing(spark.createDataFrame(rows, DOCS)).repartition(5), levels=levels, max_broadcast=broadcast)
    out = out.withColumns({"folded": merkle.folded(F.col("leaf"), F.col("places"), F.col("others")), "proof": merkle.proof_digest(F.col("others"))})
    out = out.select("doc_id", *(F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")), "proof", "folded").collect()
    want = [(i, leaf, top, root, H(a + b for a, b in p), root) for i, leaf, top, root, p in manifest_by_hand(rows)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in out)


def test_merkle_small_tables(spark):
    assert merkle.manifest(spark.createDataFrame([], DOCS)).count() == 0
    row = (1, "only", "en", "a", 4)
    (r,) = merkle.manifest(spark.createDataFrame([row], DOCS)).collect()
    assert bytes(r.leaf).hex() == leaf_by_hand(row) and r.leaf == r.subroot == r.root and r.places == [] and r.others == []


def test_merkle_query_finds_what_was_altered(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op13_merkle_manifest"](spark, sf).collect():
        altered = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and re.search("[A-Z]", texts[r.doc_id] or "") is not None
        assert r.verified == (not altered) == (r.folded_root == r.root)


# conversations


def fault_list(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cheapest rest of every row and state, with at most three inserts in a row; (cost, audit, roles and texts)."""
    faults, goal = fault_list(rows), {"": 0, "s": 1, "u": 2, "a": 3}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    best = {}
    for i in range(len(rows), -1, -1):
        for spare in range(4):
            for s in goal.values():
                options = [(0, "", ())] if i == len(rows) and s in (0, 3) else []
                moves = [("I", 2, i, step.get((s, c)), (name, "")) for c, name in (("u", "user"), ("a", "assistant"))] if spare else []
                if i < len(rows):
                    role, text = rows[i]
                    moves.append(("D", 3, i + 1, s, None))
                    if faults[i] not in ("blank", "duplicate"):
                        late = faults[i] == "truncated"
                        moves.append(("K", late, i + 1, step.get((s, role[0])) if role else s, (role, text)))
                        moves += [("R", 2 + late, i + 1, step.get((s, c)), (name, text)) for c, name in (("u", "user"), ("a", "assistant"))]
                for e, c, j, t, line in moves:
                    rest = best.get((j, spare - 1 if j == i else 3, t))
                    if t is not None and rest:
                        options.append((c + rest[0], e + rest[1], ((line,) if line else ()) + rest[2]))
                if options:
                    best[i, spare, s] = min(options, key=lambda x: x[:2])
    return best[0, 3, 0]


def summary_by_hand(rows):
    """rows: (turn, role, text) in order."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r or "", t or "") for _, r, t in rows]
    faults = collections.Counter(fault_list(pairs))
    cost, audit, lines = plain_repair(pairs)
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(n)]:
        for t in range(rng.randrange(0, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, rng.choice([t, t, t, None, t + 1]), role, rng.choice(["Hi.", "Yes", "No!", "", " \t", "Hi.", f"turn {t}?", "Ü.", None])))
    return rows


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", range(3))
def test_conversations_against_brute_force(spark, seed):
    rows = conversations(seed, 120)
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(5)
    ids = df.select("conv_id").unionByName(spark.createDataFrame([(-1,), (-1,)], "conv_id long"))
    got = {r.conv_id: tuple(r[c] for c in SUMMARY) for r in conversation_repair.repair(df, ids).collect()}
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: summary_by_hand(sorted(by[c], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2].encode()))) for c in {*by, -1}}
    assert got == want


def test_repaired_rows_are_well_formed(spark):
    held = conversation_repair.ordered(spark.createDataFrame(conversations(9, 80), "conv_id long, turn long, role string, text string"))
    lines = conversation_repair.repaired(held, conversation_repair.edits(held)).orderBy("conv", "__place", "part").collect()
    by = collections.defaultdict(str)
    for r in lines:
        by[r.conv] += r.role[:1]
        assert r.edit in "KRI" and (r.edit != "I" or r.text == "")
    assert len(by) > 40 and all(re.fullmatch("(s?(ua)+)?", x) for x in by.values())


def test_long_conversation_and_long_texts(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"Line {t}{rng.choice('.!?,')}") for t in range(6000)] + [(2, 0, "user", "x" * 2_000_000 + "."), (2, 1, "assistant", "y")]
    (two, one) = conversation_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy(F.desc("conv_id")).collect()
    assert tuple(two[c] for c in SUMMARY) == summary_by_hand([r[1:] for r in rows if r[0] == 2])
    assert tuple(one[c] for c in SUMMARY) == summary_by_hand([r[1:] for r in rows if r[0] == 1])


def test_conversations_empty_table(spark):
    assert conversation_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_damage(spark):
    rows = conversations(4, 300)
    want = collections.Counter()
    for conv, turn, role, text in rows:
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        want[conv, turn, "user" if f == 4 else role, text] += (f != 0) + (f == 3)
    got = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert collections.Counter(map(tuple, got)) == +want


# personal data

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_by_hand(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)] + [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19 and sum(sum(divmod(d * (1 + k % 2), 10)) for k, d in enumerate(digits[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [(a, b, personal_data.KINDS[k]) for a, k, b in sorted(out)]


def test_base_spans_against_the_plain_patterns(spark):
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1234567890.@+- ()_é:41") for _ in range(rng.randrange(60)))
        assert personal_data.spans(text)[0] == base_by_hand(text), text
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text or "" for r in rows}
    for r in QUERIES["op11_personal_data"](spark, "/root/testdata/sf0.001").collect():
        base = base_by_hand(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for *_, k in base) for x in personal_data.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("auto_")] == [f"{k}:{a}:{b}" for a, b, k in base]
        assert len(r.scores.split(",")) == len(r.spans.split(","))


@pytest.mark.parametrize("text", ["1" * 400_000, "a." * 200_000, "1." * 200_000, "+1 " * 100_000, "a@" * 50_000, " (at) a" * 30_000, ":a" * 200_000, " at b dot" * 50_000, "0" * 5 + " " * 300_000])
def test_long_texts_take_linear_time(text):
    personal_data.find(text)


def test_votes_are_aggregated_by_plain_em():
    """Patterns with counts give what rows one by one give, and hidden classes are found again."""
    rng = np.random.default_rng(5)
    hidden = rng.random(3000) < 0.4
    right = np.array([0.9, 0.8, 0.85, 0.6, 0.75, 0.7, 0.65])
    votes = np.where(rng.random((3000, 7)) < right, ~hidden[:, None], hidden[:, None]).astype(int)
    votes[rng.random((3000, 7)) < 0.2] = 2
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    q, tables, prior = personal_data.aggregate(patterns, counts.astype(float))
    each, same, _ = personal_data.aggregate(votes, np.ones(3000))
    assert np.allclose(tables, same, atol=1e-6)
    by = {tuple(p): x for p, x in zip(patterns.tolist(), q)}
    assert np.allclose([by[tuple(v)] for v in votes.tolist()], each, atol=1e-6)
    assert ((each > 0.5) == hidden).mean() > 0.92 and abs(prior - 0.4) < 0.05
    assert tables[0, 1, 0] > tables[3, 1, 0]  # the better labeler is found to be that


def test_hidden_formats_are_found_and_decoys_left(spark):
    rng, rows, planted, decoys = random.Random(4), [], {}, set()
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for k in range(600):
        words = " ".join(rng.choice(["the", "report", "on", "rain", "was", "long"]) for _ in range(30))
        kind = k % 6
        if kind == 0:
            own = f"{rng.choice(['ana', 'bo.li', 'kim_p'])}{k} [at] host{k % 9} [dot] {rng.choice(['com', 'org'])}"
            text = f"{words} contact {own} soon"
        elif kind == 1:
            own = f"({digits(3)}) {digits(3)}-{digits(4)}"
            text = f"{words} call {own} today"
        elif kind == 2:
            own = f"2001:db8::{k:x}:{k % 7}"
            text = f"{words} server {own} up"
        elif kind == 3:
            own = None
            text = f"{words} order 4{digits(14)}0x{digits(5)} and version {rng.randrange(300, 900)}.{k}.1.2 out"
            decoys.add(k)
        else:
            own = None
            text = f"{words} mail me{k}@site.org or phone +1 (212) 555-{digits(4)} please"
        rows.append((k, text, None, None, 0))
        if own:
            planted[k] = (text.index(own), text.index(own) + len(own))
    got = {r.doc_id: r for r in personal_data.detect(spark.createDataFrame(rows, DOCS).repartition(3), keep=("text",)).collect()}
    found = sum(any((s["start"], s["end"]) == at for s in got[k].pii) for k, at in planted.items())
    assert found >= 0.9 * len(planted)
    assert sum(any(s["kind"].startswith("auto") for s in got[k].pii) for k in decoys) <= 0.02 * len(decoys)


def test_personal_data_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", None, None, 0), (3, "é a.b@c.de 10.0.0.1", None, None, 0), (3, "é a.b@c.de 10.0.0.1", None, None, 0), (None, "x@y.z", None, None, 0), (4, "word " * 300_000 + "q@r.st", None, None, 0)]
    df = clashing(spark.createDataFrame(rows, DOCS))
    got = personal_data.detect(df, keep=("text", "root")).collect()
    assert sorted((str(r.doc_id), len(r.pii), r.root) for r in got) == sorted([("1", 0, "theirs"), ("2", 0, "theirs"), ("3", 2, "theirs"), ("3", 2, "theirs"), ("None", 1, "theirs"), ("4", 1, "theirs")])
    assert personal_data.detect(spark.createDataFrame([], DOCS)).count() == 0
    hidden = personal_data.redact(personal_data.detect(df, keep=("text",))).where("doc_id = 3 or doc_id = 1").collect()
    assert sorted({str(r.text) for r in hidden}) == ["None", "é [EMAIL] [IP]"]
