"""Language identification by error-correcting output codes.

Each language has a codeword of bits; one linear classifier a bit, on relative frequencies of hashed byte 3-grams, predicts
it. Decoding adds up each codeword's logistic losses, weighted by how well the bits predicted left-out rows, and takes
the least; where the runner-up is near, the row is flagged as ambiguous.

The classifiers are fitted on a sample of labelled rows of about max_rows (a documented bound, equal shares a language,
chosen by a hash of the id); executors turn texts into counts, so the driver gets max_rows vectors whatever the input.
Prediction reads every whole text once, in bounded slices, with no shuffle.

Defined cases: a text that is null, empty or without a letter gives `und` with score 0; without any labelled row all
texts do; with one language every text with a letter is that one; a null lang is not learned from; a null id counts as
the empty text in folds; columns named like the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_fold, released, slices, text_bytes

DIM_BITS = 12
MAX_ROWS = 1600
SLICE = 1 << 20
UNKNOWN = "und"
OWN = ("lang_pred", "score", "ambiguous")
LETTER = regex.compile(r"\p{L}")

_FOLD = np.full(256, 32, np.uint8)  # letters of ASCII in lower case, other bytes of UTF-8 as they are, the rest a blank
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def hashed(data: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """The hashed 3-gram that starts at each byte; the text, or each of those that end there, ends in blanks."""
    b = np.concatenate([_FOLD[data], np.full(2, 32, np.uint8)]).astype(np.uint32)
    gram = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    if ends is not None:
        # the last but one first: before a text of one byte, that is the last of another
        two, one = ends[ends >= 2] - 2, ends[ends >= 1] - 1
        gram[two] = b[two] | b[two + 1] << np.uint32(8) | np.uint32(32 << 16)
        gram[one] = b[one] | np.uint32(32 << 8 | 32 << 16)
    return (gram * np.uint32(2654435761) >> np.uint32(32 - DIM_BITS)).astype(np.int32)


def with_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum((_FOLD[data] != 32) & (data < 128))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for k in np.nonzero(~found & (offsets[1:] > offsets[:-1]))[0]:
        found[k] = bool(LETTER.search(data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")))
    return found


def codewords(classes: int) -> np.ndarray:
    """classes x bits of +1 and -1: all splits of up to 7 classes, else random ones far from each other."""
    if classes <= 7:
        n = (1 << max(classes - 1, 0)) - 1
        code = np.array([[-1 if k == 0 or not (b + 1) >> (k - 1) & 1 else 1 for b in range(n)] for k in range(classes)], np.float64)
        return code.reshape(classes, n)
    rng, bits, best = np.random.default_rng(7), int(np.ceil(10 * np.log2(classes))), None
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (classes, bits))
        apart = ((bits - code @ code.T) / 2 + bits * np.eye(classes)).min()
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


@dataclass
class Model:
    classes: list[str]
    code: np.ndarray  # classes x bits
    weights: np.ndarray  # bits x dimensions
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """rows x bits to the best class, its share of exp(-loss), and by how much that is above the next."""
        loss = np.stack([(np.logaddexp(0, -margins * word) * self.trust).sum(1) for word in self.code], 1)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        top = -np.sort(-p, 1)
        return p.argmax(1), top[:, 0], top[:, 0] - (top[:, 1] if len(self.classes) > 1 else 0)


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> Model:
    """learn: which rows may be learned from."""
    rows = docs.where(learn & F.col(lang_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.zeros((0, 0)), np.zeros((0, 1 << DIM_BITS), np.float32), np.zeros(0), np.zeros(0))
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, max_rows / len(counts) / n))))
    chosen = F.pmod(F.xxhash64(F.lit("lang"), "id"), F.lit(1 << 20)) / float(1 << 20) < share[F.col("lang")]

    def count(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            keep, vectors = np.nonzero(with_letter(data, offsets))[0], []
            for k in keep:
                vectors.append(np.bincount(hashed(data[offsets[k] : offsets[k + 1]]), minlength=1 << DIM_BITS).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(2).take(pa.array(keep)), pa.array(vectors, pa.binary())], names=["id", "lang", "counts"])

    sample = sorted(rows.where(chosen).mapInArrow(released(count), "id string, lang string, counts binary").collect())
    classes = sorted({r.lang for r in sample})
    code = codewords(len(classes))
    if not code.size:
        return Model(classes, code, np.zeros((0, 1 << DIM_BITS), np.float32), np.zeros(0), np.zeros(0))
    y = code[[classes.index(r.lang) for r in sample]]
    x = np.empty((len(sample), 1 << DIM_BITS), np.float32)
    for k in range(len(sample)):
        x[k] = np.frombuffer(sample[k].counts, np.float32)
        sample[k] = None
    # one copy of the matrix: the driver has little room
    x /= x.sum(1, keepdims=True)
    scale = 1 / np.sqrt(x.mean(0) + 1e-5)
    x *= scale
    mean = x.mean(0)
    x -= mean
    gram = (x @ x.T).astype(np.float64)
    gram[np.diag_indices(len(x))] += 0.02 * np.trace(gram) / len(x) + 1e-9
    inverse = np.linalg.inv(gram)
    del gram
    centre = y.mean(0)
    alpha = inverse @ (y - centre)
    left_out = y - alpha / np.diag(inverse)[:, None]  # margins of each row by a fit without it
    del inverse
    slope, shift, trust = np.ones(y.shape[1]), np.zeros(y.shape[1]), np.ones(y.shape[1])
    for b in range(y.shape[1]):
        slope[b], shift[b] = _calibrated(left_out[:, b], y[:, b])
        hit = (left_out[:, b] * slope[b] + shift[b]) * y[:, b] > 0
        trust[b] = max(0.05, hit[y[:, b] > 0].mean() + hit[y[:, b] < 0].mean() - 1)
    w = x.T @ alpha.astype(np.float32)
    return Model(classes, code, np.ascontiguousarray((w * scale[:, None] * slope).T.astype(np.float32)), (centre - mean @ w) * slope + shift, trust / trust.mean())


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of y on the margin, with a prior that keeps them finite."""
    a, b = 2.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = p - (y > 0)
        v = np.maximum(p * (1 - p), 1e-6)
        grad = np.array([g @ margin + 0.05 * (a - 2), g.sum() + 0.05 * b])
        hess = np.array([[v @ margin**2 + 0.05, v @ margin], [v @ margin, v.sum() + 0.05]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return max(a, 0.1), b


def predict(docs: DataFrame, model: Model, text_col: str = "text", ambiguous_below: float = 0.2) -> DataFrame:
    """All rows and columns of docs with lang_pred, score and ambiguous."""
    own = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    docs = docs.drop(*(f.name for f in own if f.name != text_col))
    at, classes = docs.columns.index(text_col), np.array([*model.classes, UNKNOWN], object)

    def run(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            n = len(offsets) - 1
            best, score, gap = np.full(n, len(model.classes)), np.zeros(n), np.zeros(n)
            live = with_letter(data, offsets) if model.classes else np.zeros(n, bool)
            for a, b in slices(offsets, SLICE):
                rows = a + np.nonzero(live[a:b])[0]
                if not len(rows):
                    continue
                base = offsets[a]
                grams = hashed(data[base : offsets[b]], offsets[a + 1 : b + 1] - base)
                sums = np.zeros((len(rows), len(model.bias)))
                for bit, w in enumerate(model.weights):
                    total = np.concatenate([[0.0], np.cumsum(w[grams], dtype=np.float64)])
                    sums[:, bit] = total[offsets[rows + 1] - base] - total[offsets[rows] - base]
                best[rows], score[rows], gap[rows] = model.decode(sums / (offsets[rows + 1] - offsets[rows])[:, None] + model.bias)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes[best], pa.string()), pa.array(score), pa.array(live & (gap < ambiguous_below))], names=[*batch.schema.names, *(f.name for f in own)])

    return docs.mapInArrow(released(run), T.StructType([*docs.schema.fields, *own]))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: tuple[int, int] = (4, 2), max_rows: int = MAX_ROWS) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold (modulus, remainder), predict all: id, held_out, lang_pred, score, ambiguous."""
    held_out = in_fold(F.col(id_col), *folds)
    model = fit(docs, ~held_out, id_col, text_col, lang_col, max_rows)
    return predict(docs.select(id_col, held_out.alias("held_out"), text_col), model, text_col).drop(text_col)
