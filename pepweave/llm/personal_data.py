"""Personal data by aggregated weak supervision: email and IP addresses, card and phone numbers.

Base matches are exact: per kind leftmost and non-overlapping, those that fail their check dropped and not tried again. They always stay. Further
candidates are written otherwise (name [at] host [dot] org, IPv6, national phone numbers) or failed a check; they may overlap no base match, nor each
other. On every candidate of either sort LABELERS vote, for or against or not at all: patterns and checks, gazetteers (top-level domains and mail
hosts, card issuers, calling codes, special networks) and context (words before it, its edges, other personal data nearby).

For each kind expectation-maximisation finds how reliable each labeler is, abstaining included, from how often each pattern of votes occurs among
all candidates of all documents (at most 3 ** 7 patterns reach the driver). A span classifier, a logistic regression on votes, the word
before and the span's shape, is trained on the posteriors of a bounded sample (MAX_ROWS a kind, in expectation, chosen by a hash) and
scores every candidate; those beyond base that reach THRESHOLD are added, named auto_<kind>.

Texts are read once, whole, in time linear in their length, and nothing of them shuffles: candidates are kept beside their row, and only pattern
counts are summed up.

Defined cases: a null text is empty and has no spans; rows alike get the same spans; positions are code points, ends exclusive; a kind without
candidates is not learned; an empty table gives an empty result; columns named candidates or pii are replaced, others come through;
of spans that start alike the kinds go in the order of KINDS.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "check", "gazetteer", "context", "edges", "shape", "company")
MAX_ROWS = 4000
THRESHOLD = 0.9
NEAR = 40  # characters before a candidate that context is
COMPANY = 200  # characters within which other personal data count

# base patterns, in forms that take linear time
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# other ways to write them
HOST = r"[A-Za-z0-9-]{1,63}"
HIDDEN_AT = re.compile(rf"\x20?[\[({{<]\x20?(?:at|AT|@)\x20?[\])}}>]\x20?({HOST}(?:(?:\.|\x20?[\[({{<]\x20?(?:dot|DOT|\.)\x20?[\])}}>]\x20?){HOST}){{1,8}})")
SPOKEN_AT = re.compile(rf"\x20(?:at|AT)\x20({HOST}(?:\x20(?:dot|DOT)\x20{HOST}){{1,8}})")
BARE_AT = re.compile(rf"@{HOST}")
SIX = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}|(?:[0-9A-Fa-f]{1,4}:){1,7}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?)(?![0-9A-Za-z:])")
NATIONAL = re.compile(r"(?<![0-9A-Za-z+._/-])(?:\(0?[0-9]{2,4}\)\x20?|0[0-9]{2,4}[\x20./-]|[0-9]{3}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z_/-]|[.\x20-][0-9])")
BLANK = re.compile(r"[^0-9]")

# fixed values: gazetteers
DOMAINS = frozenset("com org net edu gov mil int info biz io co ai app dev me tv eu uk us ca au nz ie in cn jp kr br mx ar cl es fr de at ch it nl be lu pt pl cz sk hu ro bg gr tr se no dk fi ru ua za".split())
HOSTS = frozenset("gmail googlemail yahoo hotmail outlook live icloud aol gmx web proton protonmail mail posteo orange free laposte wanadoo t-online telefonica terra example".split())
CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 354 358 359 370 371 372 380 385 386 420 421".split())
#: First digits of an issuer's cards and how many digits they have.
ISSUERS = (("4", (13, 16, 19)), ("51", (16,)), ("52", (16,)), ("53", (16,)), ("54", (16,)), ("55", (16,)), ("2", (16,)), ("34", (15,)), ("37", (15,)), ("6011", (16,)), ("65", (16,)), ("36", (14,)), ("38", (14,)), ("35", (16,)))
WORDS = {
    "email": "email e-mail mail mailto contact write kontakt correo courriel contacto adresse",
    "ip": "ip ipv4 ipv6 host server address login from adresse serveur servidor",
    "card": "card visa mastercard amex credit debit payment karte carte tarjeta kreditkarte",
    "phone": "phone tel telephone mobile cell call fax whatsapp telefon handy téléphone appelez teléfono móvil llame",
}
AGAINST = "order invoice isbn issn sku id no nr version release ticket ref serial part build total bestellung rechnung commande facture pedido factura".split()
NOTED = {k: re.compile(rf"(?<![\w])(?:{'|'.join(map(re.escape, v.split()))})(?![\w])") for k, v in WORDS.items()}
OTHERWISE = re.compile(rf"(?<![\w])(?:{'|'.join(AGAINST)})(?![\w])")
LAST_WORD = re.compile(r"([^\W\d_]{1,16})\W*\Z")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def small(part: str) -> bool:
    """Whether a number is at most 255."""
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def _emails(text: str) -> Iterator[tuple[int, int, bool]]:
    end, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in LOCAL:
            a -= 1
        if a < at:
            m = DOMAIN.match(text, at) or BARE_AT.match(text, at)
            if m:
                good = m.re is DOMAIN
                yield a, m.end(), good
                end = m.end() if good else end
        at = text.find("@", max(at + 1, end))


def _addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in DOTTED.finditer(text):
        parts, a = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            b = a + sum(map(len, four)) + 3
            yield a, b, all(map(small, four))
            a = b + 1


def _cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 13:
            digits = BLANK.sub("", m[0])
            if 13 <= len(digits) <= 19:
                yield m.start(), m.end(), len(digits) >= 14 and luhn(digits)


def _phones(text: str) -> Iterator[tuple[int, int, bool]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            n = len(BLANK.sub("", m[0]))
            if 7 <= n <= 18:
                yield m.start(), m.end(), 10 <= n <= 15


FINDERS = dict(zip(KINDS, (_emails, _addresses, _cards, _phones), strict=True))


def _others(text: str) -> Iterator[tuple[int, int, str]]:
    """Candidates in other forms than the base patterns'."""
    for pattern in (HIDDEN_AT, SPOKEN_AT):
        if pattern is HIDDEN_AT or " dot " in text or " DOT " in text:
            for m in pattern.finditer(text):
                a = m.start()
                while a > max(0, m.start() - 64) and text[a - 1] in LOCAL:
                    a -= 1
                if a < m.start():
                    yield a, m.end(), "email"
    if text.count(":") > 1:
        yield from ((m.start(), m.end(), "ip") for m in SIX.finditer(text) if m[0].count(":") > 1)
    yield from ((m.start(), m.end(), "phone") for m in NATIONAL.finditer(text))


def spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, bool]]]:
    """(start, end, kind) of base matches, by start and kind; and of the other candidates, with whether they failed a check."""
    base, rest = [], []
    for kind, find in FINDERS.items():
        for a, b, good in find(text):
            base.append((a, b, kind)) if good else rest.append((a, b, kind, True))
    rest += [(a, b, kind, False) for a, b, kind in _others(text)]
    base.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    if not rest:
        return base, []
    # of those that overlap, base comes first, then what starts first
    taken, at, last, free = sorted((a, b) for a, b, _ in base), 0, 0, []
    for x in sorted(rest, key=lambda x: (x[0], KINDS.index(x[2]), x[3], x[1])):
        while at < len(taken) and taken[at][0] < x[1]:
            last, at = max(last, taken[at][1]), at + 1
        if last <= x[0]:
            free.append(x)
            last = x[1]
    return base, free


def _gazetteer(kind: str, own: str) -> str:
    if kind == "email":
        labels = re.split(r"[^A-Za-z0-9-]+", own.lower())
        return "1" if labels[-1] in DOMAINS or not HOSTS.isdisjoint(labels[1:]) else "0"
    if kind == "ip":
        if ":" in own:
            return "-"
        first = own.split(".")[0].lstrip("0")
        return "0" if not first or len(first) > 3 or int(first) >= 240 or own in ("127.0.0.1", "1.2.3.4") else "1"
    digits = BLANK.sub("", own)
    if kind == "card":
        return "1" if any(digits.startswith(p) and len(digits) in n for p, n in ISSUERS) else "0"
    if own[0] != "+":
        return "-"
    return "1" if any(digits[:k] in CODES for k in (1, 2, 3)) else "0"


def _check(kind: str, own: str) -> str:
    digits = BLANK.sub("", own)
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9-]+", own)[-1]
        return "1" if last.isalpha() and len(last) > 1 and own[0] not in "." and len(re.findall(r"\.|dot|DOT", own)) else "0"
    if kind == "ip":
        return "1" if ":" in own or all(map(small, own.split("."))) else "0"
    if kind == "card":
        return "1" if len(digits) >= 14 and luhn(digits) else "0"
    return "1" if 9 <= len(digits) <= 15 else "0"


def _shape(kind: str, own: str) -> str:
    digits = BLANK.sub("", own)
    if kind == "email":
        return "1" if any(c.isalpha() for c in own[: max(1, len(own) // 3)]) else "0"
    if len(set(digits)) <= 2 or digits in "01234567890123456789":
        return "0"
    if kind == "card":
        return "1" if re.fullmatch(r"[0-9]{4}([\x20-][0-9]{2,6}){2,4}", own) else "-"
    if kind == "phone":
        return "1" if re.search(r"[0-9)][\x20./-][0-9]", own) else "-"
    return "-"


def candidate(text: str, a: int, b: int, kind: str, failed: bool | None, nearby: bool) -> dict:
    """A candidate with its votes (1 for, 0 against, - abstains, in order of LABELERS). failed: None for a base match."""
    own, before = text[a:b], text[max(0, a - NEAR) : a]
    low = before.lower()
    context = "1" if NOTED[kind].search(low) else "0" if OTHERWISE.search(low) else "-"
    glued = (a > 0 and (text[a - 1].isalnum() or text[a - 1] in "_=/")) or (b < len(text) and (text[b].isalnum() or text[b] in "_=/"))
    form = "-" if failed is False else "0" if failed else "1"
    votes = form + _check(kind, own) + _gazetteer(kind, own) + context + ("0" if glued else "1") + _shape(kind, own) + ("1" if nearby else "-")
    word = LAST_WORD.search(low)
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", own))[:24]
    return {"kind": kind, "start": a, "end": b, "base": failed is None, "votes": votes, "clues": [f"w:{word[1]}" if word else "w:", f"s:{shape}", f"n:{min(40, b - a)}"]}


def find(text: str) -> list[dict]:
    """All candidates of a text, by start and kind."""
    base, rest = spans(text)
    found = sorted([(*x, None) for x in base] + rest, key=lambda x: (x[0], KINDS.index(x[2]), x[3] is not None))
    if not found:
        return []
    out, last = [], -COMPANY  # the end of the base match before
    ahead = [a for a, *_, failed in found if failed is None]
    k = 0
    for a, b, kind, failed in found:
        while k < len(ahead) and ahead[k] <= a:
            k += 1
        nearby = a - last < COMPANY or (k < len(ahead) and ahead[k] - b < COMPANY)
        out.append(candidate(text, a, b, kind, failed, nearby))
        if failed is None:
            last = max(last, b)
    return out


FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType()), T.StructField("votes", T.StringType()), T.StructField("clues", T.ArrayType(T.StringType()))]))
FOUND_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string()), ("clues", pa.list_(pa.string()))]))
PII = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
PII_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of docs with candidates."""
    docs = docs.drop(*(c for c in ["candidates"] if c != text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = pa.array([find(x.as_py() or "") for x in batch.column(at)], FOUND_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "candidates"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("candidates", FOUND)]))


#: First guess of how a labeler votes (for, against, abstains) on what is personal data; on what is not, for and against change places.
USUAL = np.array([0.55, 0.15, 0.3])
SURE = 5.0, 0.02  # the guess is worth so many candidates and this share of all


def aggregate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over distinct patterns of votes (0 for, 1 against, 2 abstains), each with its count.

    Returns the posterior of each pattern, the tables (labelers x 2 classes x 3 votes; class 1 is personal data) and the prior.
    """
    n = votes.shape[1]
    first = np.stack([np.tile(USUAL[[1, 0, 2]], (n, 1)), np.tile(USUAL, (n, 1))], 1)
    tables, prior, q = first, 0.5, np.zeros(len(votes))
    sure = SURE[0] + SURE[1] * counts.sum()
    for _ in range(rounds):
        logit = math.log(prior / (1 - prior)) + np.log(tables[np.arange(n), 1, votes] / tables[np.arange(n), 0, votes]).sum(1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done, q = np.abs(new - q).max() < 1e-6, new
        if done:
            break
        prior = float((q @ counts + sure / 2) / (counts.sum() + sure))
        weight = np.stack([(1 - q) * counts, q * counts])
        tables = np.stack([[[(w * (votes[:, k] == v)).sum() for v in range(3)] for w in weight] for k in range(n)]) + sure * first
        tables /= tables.sum(2, keepdims=True)
    return q, tables, prior


def features(votes: str, clues: list[str]) -> list[str]:
    return [f"{k}{v}" for k, v in enumerate(votes)] + clues


def logistic(rows: list[list[str]], target: np.ndarray, least: int = 3, ridge: float = 1.0) -> dict[str, float]:
    """Weights of features (those that at least so many rows have, and a bias under the empty name) by Newton's method."""
    counts: dict[str, int] = {}
    for r in rows:
        for f in r:
            counts[f] = counts.get(f, 0) + 1
    names = sorted(f for f, c in counts.items() if c >= least)[:2000]
    index = {f: k for k, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for k, r in enumerate(rows):
        x[k, [index[f] for f in r if f in index]] = 1
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + np.diag(penalty), x.T @ (p - target) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip([*names, ""], w.tolist(), strict=True))


@dataclass
class Model:
    weights: dict[str, dict[str, float]]
    reliability: dict[str, np.ndarray]

    def score(self, kind: str, votes: str, clues: list[str]) -> float:
        w = self.weights[kind]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, w[""] + sum(w.get(f, 0.0) for f in features(votes, clues))))))


def fit(found: DataFrame, id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """found: a table with candidates, better a stage table, as it is read twice."""
    each = found.select(F.col(id_col).cast("string").alias("id"), F.explode("candidates").alias("c")).select("id", "c.*")
    patterns = each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()
    model, posterior, totals = Model({}, {}), {}, {}
    for kind in KINDS:
        own = sorted((r.votes, r.n) for r in patterns if r.kind == kind)
        if own:
            counts = np.array([n for _, n in own], float)
            q, model.reliability[kind], _ = aggregate(np.array([["10-".index(v) for v in votes] for votes, _ in own]), counts)
            posterior[kind], totals[kind] = dict(zip([v for v, _ in own], q.tolist(), strict=True)), counts.sum()
    if not totals:
        return model
    share = F.create_map(*(F.lit(x) for k, n in totals.items() for x in (k, float(min(1.0, max_rows / n)))))
    draw = F.pmod(F.xxhash64(F.lit("pii"), F.coalesce("id", F.lit("")), "start", "kind"), F.lit(1 << 20)) / float(1 << 20)
    sample = sorted((r.kind, r.votes, tuple(r.clues)) for r in each.where(draw < share[F.col("kind")]).select("kind", "votes", "clues").collect())
    for kind in totals:
        rows = [(votes, clues) for k, votes, clues in sample if k == kind]
        model.weights[kind] = logistic([features(v, list(c)) for v, c in rows], np.array([posterior[kind][v] for v, _ in rows]))
    return model


def label(found: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of found, but candidates, with pii: array of (kind, start, end, score), by start and kind; learned kinds are named auto_<kind>."""
    columns = [c for c in found.columns if c not in ("candidates", "pii")]

    def kept(rows: list[dict]) -> list[dict]:
        out = []
        for c in rows:
            score = model.score(c["kind"], c["votes"], c["clues"])
            if c["base"] or score >= threshold:
                out.append({"kind": c["kind"] if c["base"] else f"auto_{c['kind']}", "start": c["start"], "end": c["end"], "score": score})
        return out

    def run(batches):
        for batch in batches:
            pii = pa.array([kept(x) for x in batch.column(len(columns)).to_pylist()], PII_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pii], names=[*columns, "pii"])

    rows = found.select(*columns, "candidates")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("pii", PII)]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, the columns of keep and pii of all rows of docs, learned from these rows."""
    found = stage_table(candidates(docs, text_col).select(id_col, *(c for c in keep if c != id_col), "candidates"), "pii-candidates")
    return label(found, fit(found, id_col))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs (with pii) with each span's text replaced by its kind in brackets; of spans that overlap, the first one counts. Null stays null."""
    at, of = docs.columns.index(text_col), docs.columns.index("pii")

    def hidden(text: str | None, rows: list[dict] | None) -> str | None:
        out, end = [], 0
        for s in rows or ():
            if s["start"] >= end:
                out += [text[end : s["start"]], f"[{s['kind'].removeprefix('auto_').upper()}]"]
            end = max(end, s["end"])
        return text if not out else "".join(out) + text[end:]

    def run(batches):
        for batch in batches:
            texts = [hidden(t, p) for t, p in zip(batch.column(at).to_pylist(), batch.column(of).to_pylist(), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, the list of all, and their scores in the same order."""

    def joined(rows):
        return F.concat_ws(",", F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(*KINDS))
    scores = F.concat_ws(",", F.transform("pii", lambda s: F.format_number(s["score"], 3)))
    return found.select(id_col, *map(count, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), scores.alias("scores"))
