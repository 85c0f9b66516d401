"""Secret scanning: base patterns, plus formats learned by grammar inference.

Base matches are exact: per kind leftmost and non-overlapping, those that are too short dropped. For the rest, labelled credentials (base
matches of a bounded sample of documents, and generated examples of public formats) are read into a prefix tree per kind, whose
states merge where their outgoing frequencies are compatible by Hoeffding's bound. The resulting probabilistic automaton
gives the likelihood of a format; every token of MIN_LENGTH or more characters that overlaps no base match is scored
against a background of ordinary tokens, and added where one kind's gain per character reaches the level that nearly all of
that kind's labelled credentials reach; where several do, the kind that passes its level by most counts, and of kinds alike in that the last by
name. The background counts how often a symbol follows another in all words of all documents.

Whole texts are scanned, in one pass with no shuffle and time in proportion to a text's length. Only the bounded sample of credentials and the table of pairs of symbols,
which has at most SYMBOLS rows squared, reach the driver. Credentials are learned from and tokens scored at whatever length; a
prefix tree takes about 450 bytes for each character of the sample while it is merged. However few credentials of a kind there are, they make its
automaton: of one or two it knows little more than these, and no ordinary token comes near its level. Tokens are scored from MIN_LENGTH characters on, parts
joined by dots being one token; shorter ones, in which too few bits tell a credential from a word, count only where a base pattern names them.

Defined cases: null text is empty and has no spans; rows alike get the same spans; positions are code points, ends
exclusive; a document may be of any length; a column named secrets is replaced, other columns come through; an empty table gives an
empty result and only the public formats are learned from it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage_table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter match holds no longer one
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")  # parts joined by dots are one token
MIN_LENGTH = 12

SAMPLE_DOCS = 20_000
MAX_EXAMPLES = 400
LITERAL = 4  # so many first characters are told apart; later ones by class only
OTHER = 128  # of the background, beside ASCII: any other character that is no digit, small or capital letter; no credential has one
SYMBOLS = OTHER + 1
PIECE = 1 << 20  # characters of which pairs are counted at a time


def base_matches(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, the credential) by start and kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


@lru_cache(1 << 12)
def symbol(c: str) -> str:
    return "d" if c.isdigit() else "h" if c in "abcdef" else "l" if c.islower() else "U" if c.isupper() else c


def symbols(word: str) -> list[str]:
    return [*("'" + c for c in word[:LITERAL]), *map(symbol, word[LITERAL:])]


class Automaton:
    """A deterministic probabilistic automaton inferred from words by merging compatible states of their prefix tree."""

    def __init__(self, words: list[str], alpha: float = 0.05) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.ends, self.visits = [0], [0]
        for w in sorted(words):
            s = 0
            self.visits[0] += 1
            for c in symbols(w):
                self.count[s][c] = self.count[s].get(c, 0) + 1
                if c not in self.next[s]:
                    self.next[s][c] = len(self.next)
                    self.next.append({}), self.count.append({}), self.ends.append(0), self.visits.append(0)
                s = self.next[s][c]
                self.visits[s] += 1
            self.ends[s] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        red = [0]
        while True:
            blue = [(s, c, t) for s in red for c, t in sorted(self.next[s].items()) if t not in red]
            if not blue:
                break
            s, c, t = max(blue, key=lambda x: self.visits[x[2]])
            mate = next((r for r in red if self._like(r, t)), None)
            if mate is None:
                red.append(t)
            else:
                self.next[s][c] = mate
                self._fold(mate, t)
        self.states = red
        names = {s: k for k, s in enumerate(red)}
        self.moves = []
        for s in red:
            total = self.visits[s] + 0.05 * (len(self.count[s]) + 1)
            self.moves.append({c: (math.log2((n + 0.05) / total), names[self.next[s][c]]) for c, n in self.count[s].items()})
        self.stops = [math.log2((self.ends[s] + 0.05) / (self.visits[s] + 0.05 * (len(self.count[s]) + 1))) for s in red]
        del self.next, self.count, self.ends, self.visits

    def _like(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            most = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            ca, cb = self.count[a], self.count[b]
            if abs(self.ends[a] / n - self.ends[b] / m) > most or any(abs(ca.get(c, 0) / n - cb.get(c, 0) / m) > most for c in ca.keys() | cb.keys()):
                return False
            if m >= 8:  # smaller states tell nothing
                stack += [(self.next[a][c], self.next[b][c]) for c in cb.keys() & ca.keys() if self.next[a][c] != a or self.visits[self.next[b][c]] >= 8]
        return True

    def _fold(self, a: int, b: int) -> None:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def bits(self, word: list[str]) -> float:
        """log2 of the likelihood of a word's symbols; one that a state does not know costs 12 bits and stays in it."""
        s, total = 0, 0.0
        for c in word:
            step, s = self.moves[s].get(c, (-12.0, s))
            total += step
        return total + self.stops[s]


@dataclass
class Formats:
    automata: dict[str, Automaton]
    levels: dict[str, float]
    background: dict[tuple[str, str], float]

    def usual(self, word: str) -> float:
        """log2 of the word's likelihood as an ordinary token."""
        s, background = [*map(symbol, word)], self.background
        total = sum(background.get(p, -9.0) for p in zip(s, s[1:], strict=False))
        return total - math.log2(60) * min(LITERAL, len(s))  # the literal characters' choice within their class

    def gain(self, kind: str, word: str) -> float:
        """Bits per character by which the kind's automaton predicts the word better than ordinary tokens do."""
        return (self.automata[kind].bits(symbols(word)) - self.usual(word)) / len(word)

    def best(self, word: str) -> tuple[str, float] | None:
        s, usual = symbols(word), self.usual(word)
        found = [(g - self.levels[k], k, g) for k, a in self.automata.items() if (g := (a.bits(s) - usual) / len(word)) >= self.levels[k]]
        return max(found)[1:] if found else None

    def likeliest(self, word: str) -> tuple[str, float]:
        """The format that a credential is likest, whether it reaches its level or not, and its gain."""
        gain, kind = max((self.gain(k, word), k) for k in self.automata)
        return kind, gain


def free_tokens(text: str, taken: list[tuple[int, int]], least: int = MIN_LENGTH):
    """Tokens of at least so many characters that overlap none of the spans taken, which are in order of their starts; both are walked through once."""
    at, last = 0, 0
    for m in TOKEN.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            last = max(last, taken[at][1])
            at += 1
        if m.end() - m.start() >= least and last <= m.start():
            yield m


def public_examples(seed: int = 5, each: int = 120) -> dict[str, list[str]]:
    """Generated credentials of well-known formats."""
    rng = np.random.default_rng(seed)
    digits, lower, upper = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shapes = {"github": ("ghp_", digits + lower + upper, 36), "slack": ("xoxb-", digits + lower + upper, 40), "stripe": ("sk_live_", digits + lower + upper, 24), "google": ("AIza", digits + lower + upper + "_-", 35), "access": ("AKIA", digits + upper, 16), "hex": ("", digits + "abcdef", 40)}
    return {k: [head + "".join(rng.choice(list(letters), n)) for _ in range(each)] for k, (head, letters, n) in shapes.items()}


@cache
def symbol_table() -> np.ndarray:
    """Of each code point, the code of its symbol; that of a blank for all white space."""
    chars = map(chr, range(0x110000))
    return np.array([32 if c.isspace() else ord(x) if (x := symbol(c)) < "\x80" else OTHER for c in chars], np.uint8)


def text_pairs(texts: list[str | None]) -> np.ndarray:
    """SYMBOLS x SYMBOLS: how often a symbol follows another within words of whole texts."""
    counts, kinds = np.zeros(SYMBOLS * SYMBOLS, np.int64), symbol_table()
    for text in texts:
        text = text or ""
        for a in range(0, len(text), PIECE):
            # a piece takes the last character of the one before along
            codes = kinds[np.frombuffer(text[max(a - 1, 0) : a + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
            counts += np.bincount(codes[:-1].astype(np.int32) * SYMBOLS + codes[1:], minlength=len(counts))
    counts = counts.reshape(SYMBOLS, SYMBOLS)
    counts[32], counts[:, 32] = 0, 0
    return counts


def symbol_pairs(ordinary: Counter[str]) -> Counter[tuple[str, str]]:
    """How often a symbol follows another within ordinary tokens."""
    pairs = Counter()
    for w, n in ordinary.items():
        s = [symbol(c) for c in w]
        for p in zip(s, s[1:], strict=False):
            pairs[p] += n
    return pairs


def infer(examples: dict[str, list[str]], ordinary: Counter[str]) -> Formats:
    """Automata, acceptance levels and background from labelled credentials and ordinary tokens."""
    return inferred(examples, symbol_pairs(ordinary))


def inferred(examples: dict[str, list[str]], pairs: Counter[tuple[str, str]]) -> Formats:
    """The same with the background's counts of pairs of symbols."""
    first = Counter()
    for (a, _), n in pairs.items():
        first[a] += n
    background = {p: math.log2((n + 0.5) / (first[p[0]] + 20)) for p, n in pairs.items()}
    formats = Formats({k: Automaton(v) for k, v in sorted(examples.items()) if v}, {}, background)
    for k in formats.automata:
        gains = sorted(formats.gain(k, w) for w in examples[k])
        formats.levels[k] = max(0.5, gains[len(gains) // 50])  # all but 2 in 100
    return formats


def learn_formats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, max_examples: int = MAX_EXAMPLES) -> Formats:
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(F.lit("secret"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(1 << 20)) / float(1 << 20) < share

    def find(batches):
        pairs = np.zeros((SYMBOLS, SYMBOLS), np.int64)
        for batch in batches:
            texts, rows = batch.column(0).to_pylist(), set()
            for text, learn in zip(texts, batch.column(1).to_pylist(), strict=True):
                if learn:
                    rows.update((k, w) for _, _, k, w in base_matches(text or ""))
            pairs += text_pairs(texts)
            yield found([(k, w, 1) for k, w in rows])
        yield found([("", f"{a} {b}", pairs[a, b]) for a, b in zip(*np.nonzero(pairs), strict=True)])

    def found(out):
        kind, word, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["kind", "word", "n"])

    rows = docs.select(text_col, chosen.alias("learn")).mapInArrow(find, "kind string, word string, n long")
    rows = stage_table(rows.groupBy("kind", "word").agg(F.sum("n").alias("n")), "secret-examples")
    examples = public_examples()
    for k in KINDS:
        # any max_examples of them: the least by a hash
        got = [r[0] for r in rows.where(F.col("kind") == k).orderBy(F.xxhash64("word"), "word").limit(max_examples).select("word").collect()]
        examples.setdefault(k, []).extend(got)
    pairs = Counter({tuple(chr(int(x)) for x in r[0].split(" ")): r[1] for r in rows.where("kind = ''").select("word", "n").collect()})
    return inferred(examples, pairs)


def _remembered(score, most: int = 64):
    """A function of a token that remembers its results for frequent short ones."""
    held = lru_cache(1 << 15)(score)
    return lambda word: held(word) if len(word) <= most else score(word)


def scan(docs: DataFrame, formats: Formats, text_col: str = "text", least: int = MIN_LENGTH) -> DataFrame:
    """All rows and columns of docs with secrets: array of (kind, start, end, score, format), by start and kind; learned kinds are named auto_<kind>.

    format and score: the learned format that a span is likest and how many bits a character that gains, for base spans too."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("format", T.StringType())])
    own = T.StructField("secrets", T.ArrayType(span))
    docs = docs.drop(*(c for c in ["secrets"] if c != text_col))
    at = docs.columns.index(text_col)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("format", pa.string())]))

    def spans(text: str, best, likeliest) -> list[dict]:
        base = base_matches(text)
        found = [{"kind": k, "start": s, "end": e, "score": g, "format": f} for s, e, k, w in base for f, g in [likeliest(w)]]
        for m in free_tokens(text, [(s, e) for s, e, _, _ in base], least):
            if b := best(m[0]):
                found.append({"kind": f"auto_{b[0]}", "start": m.start(), "end": m.end(), "score": b[1], "format": b[0]})
        order = {k: i for i, k in enumerate(KINDS)}
        return sorted(found, key=lambda x: (x["start"], order.get(x["kind"], len(KINDS)), x["kind"]))

    def run(batches):
        best, likeliest = _remembered(formats.best), _remembered(formats.likeliest)
        for batch in batches:
            found = pa.array([spans(x.as_py() or "", best, likeliest) for x in batch.column(at)], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "secrets"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, own]))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by base kind, the digest of the base spans, the list of all, and of each its likeliest format and score."""

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("secrets", lambda s: s["kind"].isin(*KINDS))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    formats = F.concat_ws(",", F.transform("secrets", lambda s: s["format"]))
    scores = F.concat_ws(",", F.transform("secrets", lambda s: F.format_number(s["score"], 3)))
    return found.select(id_col, *map(count, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"), formats.alias("formats"), scores.alias("scores"))
