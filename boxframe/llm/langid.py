"""Language identification by error-correcting output codes.

Every language has a codeword. One binary classifier per bit reads hashed character n-grams (1 to 3) of the
whole text and predicts that bit. A text's language is the one whose codeword has the least loss, bits being
weighted by how well they did on validation texts. Where the runner-up is close, the row is flagged.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
DIMENSIONS = 1 << 13
#: Labelled texts of each language that the classifiers are fitted on, at most.
PER_LANGUAGE = 400
#: Languages up to which all codewords' columns are used; beyond, the best of some random codes.
EXHAUSTIVE = 5
#: Share of the probability that the runner-up must reach for a row to be flagged.
CLOSE = 0.25


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Code point to lower-case letter, 0 for others; the first 65,536."""
    out = np.zeros(1 << 16, np.uint32)
    for c in range(1 << 16):
        letter = chr(c)
        if letter.isalpha():
            low = letter.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letters(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _folding()
    if len(codes) and int(codes.max()) >= 1 << 16:
        # Beyond the first plane, letters are looked up one by one.
        high = np.array([c if c < (1 << 16) or chr(c).isalpha() else 0 for c in codes.tolist()], np.uint32)
        return np.where(high < 1 << 16, table[np.minimum(high, (1 << 16) - 1)], high)
    return table[codes]


def features(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray | None:
    """Square roots of n-gram shares, of length 1; None for a text without a letter."""
    if not text:
        return None
    found = letters(text)
    if not found.any():
        return None
    # Runs of other characters count as one gap, and so do the ends of the text.
    found = np.concatenate([[0], found, [0]]).astype(np.uint32)
    gap = found == 0
    found = found[~(gap & np.concatenate([[False], gap[:-1]]))]
    shift = np.uint32(32 - int(dimensions).bit_length() + 1)
    counts = np.zeros(dimensions, np.int64)
    value = np.zeros(len(found), np.uint32)
    with np.errstate(over="ignore"):
        for n in (1, 2, 3):
            if len(found) < n:
                break
            value = value[: len(found) - n + 1] * np.uint32(0x01000193) + found[n - 1 :] + np.uint32(n)
            counts += np.bincount((value * np.uint32(0x9E3779B1)) >> shift, minlength=dimensions)
    out = np.sqrt(counts, dtype=np.float32)
    return out / np.sqrt(np.float32(counts.sum()))


def codewords(languages: int, seed: int = 0) -> np.ndarray:
    """A row of -1 and 1 per language. Columns split the languages, each in another way."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= EXHAUSTIVE:
        columns = [c for c in itertools.product((1, -1), repeat=languages) if c[0] == 1 and -1 in c]
        return np.array(columns, float).T
    rng, bits = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(languages)))
    # As many splits as there are, at most; a split and its opposite are one.
    bits = min(bits, 2 ** (languages - 1) - 1)
    best, distance = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (languages, 2 * bits))
        code = np.unique((code * code[0])[:, np.abs(code.sum(0)) < languages], axis=1)
        code = code[:, rng.permutation(code.shape[1])[:bits]]
        apart = (code.shape[1] - code @ code.T) / 2 + np.eye(languages) * 1e9
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: Trust in each bit, from validation texts.
    trust: np.ndarray
    #: Sharpness of the probabilities, from validation texts.
    scale: float = 1.0

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Loss of each language for each row: the logistic loss of its bits, weighted."""
        margins = x @ self.weights + self.bias
        agree = margins[:, None, :] * self.codes[None]
        return (np.logaddexp(0, -agree) * self.trust).sum(2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = -self.scale * self.losses(x)
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit(x: np.ndarray, labels: list[str], seed: int = 0, steps: int = 300, rate: float = 0.5) -> Model:
    """Logistic classifiers for all bits at once, by gradient descent with momentum.

    Every language has the same total weight. A fifth of the texts is set aside to weigh the bits.
    """
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    codes = codewords(len(languages), seed)
    if len(languages) < 2:
        return Model(languages, codes, np.zeros((x.shape[1], 1), np.float32), np.ones(1), np.ones(1))
    aside = np.random.default_rng(seed).random(len(y)) < 0.2
    train = ~aside if len(set(y[~aside])) == len(languages) else np.ones(len(y), bool)
    share = np.bincount(y[train], minlength=len(languages))
    weight = (1 / share[y[train]] / len(languages)).astype(np.float32)[:, None]
    target, inputs = codes[y[train]].astype(np.float32), x[train].astype(np.float32)
    # Adam: features differ much in frequency.
    w, b = np.zeros((x.shape[1], codes.shape[1]), np.float32), np.zeros(codes.shape[1], np.float32)
    first, second = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        push = -target * weight / (1 + np.exp(np.clip(target * (inputs @ w + b), -30, 30)))
        grads = [inputs.T @ push + 1e-6 * w, push.sum(0)]
        for p, g, m, v in zip((w, b), grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    check = aside if aside.any() else train
    right = (np.sign(x[check] @ w + b) == codes[y[check]]).mean(0)
    right = np.clip(right, 0.5, 1 - 1 / (2 + check.sum()))
    trust = np.log(right / (1 - right)) + 1e-3
    model = Model(languages, codes, w, b, trust / trust.sum())
    model.scale = sharpness(model.losses(x[check]), y[check])
    return model


def sharpness(losses: np.ndarray, wanted: np.ndarray) -> float:
    """Factor of the losses that makes the right languages likeliest.

    One text more is taken for wrong than is, so that the factor stays finite where all are right.
    """
    chance, best, least = 1 / (2 + len(wanted)), 1.0, np.inf
    for scale in np.geomspace(0.1, 1000, 81):
        z = -scale * losses
        z = z - z.max(1, keepdims=True)
        likely = np.exp(z[np.arange(len(z)), wanted]) / np.exp(z).sum(1)
        cost = -((1 - chance) * np.log(np.maximum(likely, 1e-300)) + chance * np.log(np.maximum(1 - likely, 1e-300))).mean()
        if cost < least:
            best, least = float(scale), cost
    return best


def _featured(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, rows = [], []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            whole = text.as_py()
            # A slice besides the whole text shows the classifiers what little text looks like.
            some = whole[len(whole) // 3 :][:80]
            for part in (whole, some):
                vector = features(part, dimensions)
                if vector is not None:
                    labels.append(label)
                    rows.append(vector.astype("<f4").tobytes())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(rows, pa.binary())], names=["lang", "vector"])


def train(
    docs: DataFrame,
    usable: Column,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    dimensions: int = DIMENSIONS,
    seed: int = 0,
) -> Model:
    """Fit on at most ``per_language`` labelled texts of each language among the ``usable`` rows.

    Those with the least hash of their ID are taken, so the sample is the same on every run. The bound
    holds what comes to the driver: the languages and, for each, ``per_language`` vectors of whole texts
    and as many of slices. Of a large language a share of the hashes is looked at, three times what is
    needed, so that tasks pass on few texts however many of them there are.
    """
    rows = docs.filter(usable).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`")).alias("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = rows.filter("lang is not null and text is not null")
    share = F.lit(1.0)
    for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect():
        share = F.when(F.col("lang") == r.lang, min(1.0, 3 * per_language / r.n)).otherwise(share)
    some = rows.filter(F.pmod("h", F.lit(1 << 40)) <= share * float(1 << 40))
    # Spark keeps only the first rows of each language in every task before it shuffles them.
    sample = some.withColumn("place", place).filter(F.col("place") <= per_language)
    got = sample.select("lang", "text").mapInArrow(lambda b: _featured(b, dimensions), "lang string, vector binary").collect()
    got.sort(key=lambda r: (r.lang, r.vector))
    if not got:
        return Model([], np.ones((0, 1)), np.zeros((dimensions, 1), np.float32), np.zeros(1), np.ones(1))
    return fit(np.stack([np.frombuffer(r.vector, "<f4") for r in got]), [r.lang for r in got], seed)


def _predicted(batches: Iterator[pa.RecordBatch], model: Model, dimensions: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            vectors = [features(x.as_py(), dimensions) for x in part.column(1)]
            known = [i for i, v in enumerate(vectors) if v is not None and model.languages]
            names, scores, close = [UNKNOWN] * len(vectors), [0.0] * len(vectors), [True] * len(vectors)
            if known:
                chances = model.probabilities(np.stack([vectors[i] for i in known]))
                order = np.sort(chances, 1)
                for row, i in enumerate(known):
                    names[i] = model.languages[int(chances[row].argmax())]
                    scores[i] = float(order[row, -1])
                    close[i] = len(model.languages) > 1 and bool(order[row, -2] >= CLOSE)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(close)], names=["row", "lang_pred", "score", "ambiguous"]
            )


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """``row`` (a struct of ``carry``, all columns by default), ``lang_pred``, ``score``, ``ambiguous``.

    Only the text is read. A null text or one without a letter gets ``und``, score 0 and the flag. Equal
    texts get equal results; an empty table gives no rows. Columns stay inside ``row``, so names can't clash.
    """
    from pyspark.sql import types as T

    kept = docs.columns if carry is None else carry
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    shape = T.StructType([packed.schema["row"], *T._parse_datatype_string("lang_pred string, score double, ambiguous boolean").fields])
    return packed.mapInArrow(lambda b: _predicted(b, model, dimensions), shape)
