"""Toxicity by weak supervision.

Voters: public insult lists, lexicon and word-prefix patterns, shouting and insult-address patterns; they vote toxic or abstain. A
generative model with a hidden class estimates by EM how each voter behaves in either class, abstaining included; voters that agree
more than the class explains (correlated ones) share their evidence. It starts from votes alone, as if all voters were independent
and behaved as USUAL, with a PRIOR share of toxic rows. A logistic regression on lexicon features, fitted to the posterior
labels with both classes weighing the same, scores all texts.

Given labels do one thing: they tell which words and prefixes are worth a voter (ENTRIES of them are looked at, VOTING make voters; both must be in
LEAST_ROWS rows and reach VOTER_STRENGTH, whatever the sample's size). They are no voter, no start and no target; the classifier weighs FEATURES words and prefixes found by posteriors.

The sample (max_rows labelled rows at most of either label in expectation, chosen by a hash of the id) is the only thing
learned from where there are labels; executors find the words and prefixes that tell its rows apart, and the driver gets each row's few of them. Scoring reads every whole text once and shuffles nothing.

Defined cases: a null or empty text has no feature and gets the prior's score; without labelled rows of both kinds
all voters but the public lists abstain; without any labelled row the public lists and the patterns vote on an unlabelled
sample, and as their words seldom meet in a text, the model's first guess of how they behave stays; that sample has about 2 * max_rows rows that have an id; labels other than 0 and 1 don't count; labels that repeat for a row count once (the highest); a null id joins no label
and counts as the empty text in folds; an empty table gives an empty result; columns named like the outputs are replaced; texts of
any length are scored whole, one at a time; entries of equal strength go by their name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_fold, stage_table

MAX_ROWS = 3000
PREFIXES = (3, 4, 5, 6, 7, 8)
HEAD = min(PREFIXES)
DENSE = 200  # an entry is dense if it is one word of so many
THRESHOLD = 0.7
ENTRIES, VOTING, FEATURES = 3000, 600, 800  # most words and prefixes that are counted in the sample, that voters share, that the classifier weighs
LEAST_ROWS = 3  # of the sample that an entry must be in, in toxic or in clean ones, to be looked at
VOTER_STRENGTH, FEATURE_STRENGTH = 10.0, 12.0  # twice the log-likelihood ratio from which an entry makes a voter, or is weighed: by chance one in 600 or 2000 reaches it
PRIOR = 0.1  # first guess of the share of toxic rows
USUAL, SURE = (0.02, 0.3), 5  # first guess of the shares of clean and toxic rows that a voter votes in, later worth as much as so many rows
WORD = re.compile(r"\w+")
#: Common insults, a voter a language.
LISTS = {
    "en": "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb fool jerk bastard bitch asshole shit fuck",
    "de": "idiot dumm trottel arschloch abschaum dreck scheisse scheiße hurensohn widerlich versager wichser",
    "fr": "idiot imbécile crétin stupide connard salaud ordure merde pourriture dégoûtant pathétique con",
    "es": "idiota imbécil estúpido basura asqueroso patético payaso mierda cabrón gilipollas escoria puta",
}
ADDRESS = re.compile(r"\b(?:you|du|tu|vous|eres)\b\W+(?:\w+\W+){0,3}?(?:" + "|".join(sorted({w for x in LISTS.values() for w in x.split()})) + r")\b")
SHOUT = re.compile(r"[!?]{2,}")


def levels(name: str, count: int, words: int) -> list[str]:
    """The features of one entry that occurs count times among so many words."""
    out = [name]
    if count >= 2:
        out.append(name + "#2")
        if count >= 3:
            out.append(name + "#3")
        if count * DENSE >= words:
            out.append(name + "%")
    return out


def counted(words: Counter[str], known: set[str] | None = None, heads: set[str] | None = None) -> set[str]:
    """Features of a text's words: words (=w) and prefixes (k:w), how often and how densely they occur. known: only such entries; heads: first letters that they have."""
    n, entries = sum(words.values()), Counter()
    for w, c in words.items():
        if heads is not None and w[:HEAD] not in heads:
            continue
        for e in ("=" + w, *(f"{k}:{w[:k]}" for k in PREFIXES if len(w) > k)):
            if known is None or e in known:
                entries[e] += c
    return {x for e, c in entries.items() for x in levels(e, c, n)}


def features(text: str | None) -> set[str]:
    return counted(Counter(WORD.findall((text or "").lower())))


def entry(feature: str) -> str:
    """The word or prefix that a feature is about."""
    return feature.removesuffix("#2").removesuffix("#3").removesuffix("%")


class FeatureSets:
    """Sets of features kept as text and made one at a time, as thousands of sets would fill the driver."""

    def __init__(self, rows: list[str]) -> None:
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __iter__(self):
        return (set(r.split(" ")) - {""} for r in self.rows)

    def where(self, keep) -> FeatureSets:
        return FeatureSets([r for r, k in zip(self.rows, keep, strict=True) if k])


def strength(a: np.ndarray, b: np.ndarray, n: float, m: float) -> np.ndarray:
    """Log-likelihood ratio of a feature in a of n rows and b of m rows."""

    def part(x, total, p):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(total * p, 1e-9)), 0)

    p = (a + b) / (n + m)
    return 2 * (part(a, n, p) + part(b, m, p) + part(n - a, n, 1 - p) + part(m - b, m, 1 - p))


def lexicon(rows: FeatureSets, toxic: np.ndarray, least: float, most: int) -> dict[str, float]:
    """Features that are significantly more frequent in toxic rows, or in clean ones, with signed strength."""
    ct, cc = Counter(), Counter()
    for f, t in zip(rows, toxic, strict=True):
        (ct if t else cc).update(f)
    n, m = float(toxic.sum()), float(len(toxic) - toxic.sum())
    if not n or not m:
        return {}
    names = [f for f, c in ct.items() if c >= LEAST_ROWS] + [f for f, c in cc.items() if f not in ct and c >= LEAST_ROWS]
    a, b = np.array([ct[f] for f in names], float), np.array([cc[f] for f in names], float)
    s = strength(a, b, n, m) * np.where(a / n >= b / m, 1, -1)
    order = np.argsort(-np.abs(s), kind="stable")
    return {names[k]: float(s[k]) for k in order[:most] if abs(s[k]) >= least}


class Voters:
    """Votes of 1 (toxic) or 0 (abstains)."""

    def __init__(self, found: dict[str, float], groups: int = 6, listed: int = 1) -> None:
        """found: entries with their strength; groups, listed: voters that a kind of entries and that a public list is dealt to."""
        up = [f for f, s in found.items() if s > 0]
        kinds = {"words": [f for f in up if f[0] == "="], **{f"prefix{k}": [f for f in up if f.startswith(f"{k}:")] for k in PREFIXES}}
        self.sets = {f"list-{k}-{g}": {"=" + w for w in v.split()[g::listed]} for k, v in LISTS.items() for g in range(listed)}
        self.sets |= {f"{k}-{g}": set(v[g::groups]) for k, v in kinds.items() for g in range(groups) if v[g::groups]}
        self.any = set().union(*self.sets.values()) if self.sets else set()
        self.names = [*self.sets, "address", "shout"]

    def vote(self, f: set[str], address: bool, shout: bool) -> list[int]:
        hit = [int(not s.isdisjoint(f)) for s in self.sets.values()]
        return [*hit, int(address), int(shout)]


def guess(votes: np.ndarray) -> np.ndarray:
    """P(toxic) of each row if all voters were independent and voted as USUAL tells."""
    clean, toxic = USUAL
    ratio = votes * math.log(toxic / clean) + (1 - votes) * math.log((1 - toxic) / (1 - clean))
    return 1 / (1 + np.exp(-np.clip(ratio.sum(1) + math.log(PRIOR / (1 - PRIOR)), -30, 30)))


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """EM for P(class | votes) with each voter's table of votes by class; start: first guess of P(toxic).

    Returns the posterior, the tables (voters x 2 classes x 2 votes), and each voter's share of its evidence: 1 / (1 + the sum
    of its squared within-class correlations with others), re-estimated as the classes get clear."""
    q, n = start.astype(float), votes.shape[1]
    share, tables = np.ones(n), np.zeros((n, 2, 2))
    for _ in range(rounds):
        prior = min(max(q.mean(), 1e-3), 1 - 1e-3)
        for c, w in enumerate((1 - q, q)):
            for v in (0, 1):
                tables[:, c, v] = ((votes == v) * w[:, None]).sum(0) + SURE * (USUAL[c] if v else 1 - USUAL[c])
        tables /= tables.sum(2, keepdims=True)
        centred = votes - ((1 - q)[:, None] * tables[:, 0, 1] + q[:, None] * tables[:, 1, 1])
        covariance = centred.T @ centred / len(votes)
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
        correlation = covariance / spread[:, None] / spread
        share = 1 / (1 + np.maximum((correlation**2).sum(1) - 1, 0))
        ratio = np.log(tables[:, 1] / tables[:, 0])
        logit = math.log(prior / (1 - prior)) + (ratio[np.arange(n)[None], votes] * share).sum(1)
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - q).max() < 1e-4:
            break
        q = new
    return q, tables, share


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, f: set[str]) -> float:
        w = self.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(w[x] for x in w.keys() & f)))))


def linear(rows: FeatureSets, target: np.ndarray, names: list[str], penalty: float = 1.0) -> Model:
    """Logistic regression on presence of the named features, to soft targets, classes weighing the same, by damped Newton steps in the features' space."""
    index = {f: k for k, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1), np.float32)
    x[:, -1] = 1
    for r, f in enumerate(rows):
        x[r, [index[g] for g in index.keys() & f]] = 1
    weigh = 1 + (((1 - target).sum() + 0.5) / (target.sum() + 0.5) - 1) * target
    w, ridge = np.zeros(len(names) + 1), np.full(len(names) + 1, penalty)
    ridge[-1] = 1e-3
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -30, 30).astype(float)))
        h = (x * (weigh * (p * (1 - p) + 1e-4)).astype(np.float32)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, x.T @ (weigh * (p - target)).astype(np.float32) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return Model(dict(zip(names, w[:-1].tolist(), strict=True)), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """learn: which rows of docs may be learned from. labels: id_col and label_col."""
    tagged = labels.where(F.col(label_col).cast("int").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    ids = docs.where(learn & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"))
    counts = {r[0]: r[1] for r in ids.join(tagged, "__id").groupBy("toxic").count().collect()}
    if not counts:
        return _unlabelled(docs.where(learn & F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.lit(0).alias("toxic"), F.col(text_col).alias("text")), 2 * max_rows)
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, max_rows / n))))
    chosen = tagged.where(F.pmod(F.xxhash64(F.lit("toxic"), F.col("__id").cast("string")), F.lit(1 << 20)) / float(1 << 20) < share[F.col("toxic")])
    some = docs.where(learn).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # chosen is bounded by 2 * max_rows and the ids that learn excludes
    rows = some.join(F.broadcast(chosen) if 4 * max_rows >= chosen.count() else chosen, "__id")
    rows = stage_table(rows.select(F.col("__id").cast("string").alias("id"), "toxic", "text"), "toxicity-sample")
    known = _entries(rows, counts)

    sample = _votable(rows, known)
    found = FeatureSets([r.found for r in sample])
    given = np.array([r.toxic for r in sample])
    # labels tell which entries make voters; how far these can be trusted is estimated without a look at labels
    voters = Voters(lexicon(found, given, VOTER_STRENGTH, VOTING))
    votes = np.array([voters.vote(f, r.address, r.shout) for f, r in zip(found, sample, strict=True)])
    q, _, _ = label_model(votes, guess(votes))
    names = list(lexicon(found, q > 0.5, FEATURE_STRENGTH, FEATURES))
    names += sorted((voters.any & set().union(*found)) - set(names))
    return linear(found, q, names)


def _votable(rows: DataFrame, known: set[str]) -> list:
    """The sample's rows (id, toxic, text) with their features among the known entries and the patterns' hits, in order."""

    def extract(batches):
        heads = heads_of(known)
        for batch in batches:
            out = []
            for text in batch.column(2).to_pylist():
                low = (text or "").lower()
                out.append((" ".join(sorted(counted(Counter(WORD.findall(low)), known, heads))), bool(ADDRESS.search(low)), len(SHOUT.findall(low)) >= 5))
            found, address, shout = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(address, pa.bool_()), pa.array(shout, pa.bool_())], names=["id", "toxic", "found", "address", "shout"])

    return sorted(rows.mapInArrow(extract, "id string, toxic int, found string, address boolean, shout boolean").collect())


def _unlabelled(rows: DataFrame, most: int) -> Model:
    """From the votes of the public lists and the patterns only."""
    n = rows.count()
    if not n:
        return Model({}, -2.0)
    listed = {"=" + w for x in LISTS.values() for w in x.split()}
    sample = _votable(rows.where(F.pmod(F.xxhash64(F.lit("toxic"), "id"), F.lit(1 << 20)) / float(1 << 20) < min(1.0, most / n)), listed)
    if not sample:
        return Model({}, -2.0)
    found = FeatureSets([r.found for r in sample])
    voters = Voters({}, listed=4)  # words of one list that agree are what there is to learn from
    votes = np.array([voters.vote(f, r.address, r.shout) for f, r in zip(found, sample, strict=True)])
    q = guess(votes)
    heard = voters.any & set().union(*found)
    model = linear(found, q, sorted(heard), 0.1)  # few rows have any
    # a listed word that the sample lacks counts as those that it has
    usual = float(np.mean(list(model.weights.values()))) if heard else 2 * math.log(0.95 / 0.05)
    model.weights |= dict.fromkeys(sorted(voters.any - heard), usual)
    return model


def heads_of(known: set[str]) -> set[str]:
    return {(e[1:] if e[0] == "=" else e[2:])[:HEAD] for e in known}


def _entries(rows: DataFrame, labels: dict[int, int], most: int = ENTRIES) -> set[str]:
    """The words and prefixes whose presence differs most between the sample's toxic and clean rows, and the public lists."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for t, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = set(WORD.findall((text or "").lower()))
                into = toxic if t else clean
                into.update("=" + w for w in words)
                for k in PREFIXES:
                    into.update({f"{k}:{w[:k]}" for w in words if len(w) > k})
        names = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([clean[x] for x in names], pa.int64())], names=["entry", "a", "b"])

    n, m = (rows.where(F.coalesce("toxic", F.lit(0)) == t).count() for t in (1, 0))
    listed = {"=" + w for x in LISTS.values() for w in x.split()}
    if not n or not m:
        return listed
    both = rows.mapInArrow(count, "entry string, a long, b long").groupBy("entry").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where((F.col("a") >= LEAST_ROWS) | (F.col("b") >= LEAST_ROWS))

    def part(x, total, p):
        return F.when(x > 0, x * F.log(x / (total * p))).otherwise(0.0)

    a, b, p = F.col("a"), F.col("b"), (F.col("a") + F.col("b")) / float(n + m)
    llr = part(a, n, p) + part(b, m, p) + part(n - a, n, 1 - p) + part(m - b, m, 1 - p)
    top = both.select("entry", llr.alias("llr")).orderBy(F.desc("llr"), "entry").limit(most)
    return listed | {r[0] for r in top.select("entry").collect()}


def predict(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of docs with score and predicted."""
    from pyspark.sql import types as T

    own = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    docs = docs.drop(*(f.name for f in own if f.name != text_col))
    at = docs.columns.index(text_col)
    known = {entry(f) for f in model.weights}
    heads = heads_of(known)

    def score(text: str | None) -> float:
        return model.score(counted(Counter(WORD.findall((text or "").lower())), known, heads))

    def run(batches):
        for batch in batches:
            s = np.array([score(x.as_py()) for x in batch.column(at)], float)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*batch.schema.names, *(f.name for f in own)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *own]))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: tuple[int, int] = (3, 1), max_rows: int = MAX_ROWS) -> DataFrame:
    """Learn outside the held-out fold (modulus, remainder), score all: id, held_out, score, predicted."""
    held_out = in_fold(F.col(id_col), *folds)
    model = fit(docs, labels, ~held_out, id_col, text_col, label_col, max_rows)
    return predict(docs.select(id_col, held_out.alias("held_out"), text_col), model, text_col).drop(text_col)
