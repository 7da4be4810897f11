"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams of one to three letters.  Document frequencies are counted over
every training document; the regression is fitted on a bounded sample of them (about `per_language`
texts of each of the `most_languages` most frequent languages, by hash of id and text), with follow-the-regularised-leader and an elastic net (per
coordinate steps, l1 sparsity, l2 shrinkage), then calibrated with a temperature on the sample's last
fifth, which the fit doesn't see.

Cases: a null text, or one without a letter, is `und` with score 0, as is every text when nothing can
be learned (no training rows).  Ties go to the language first in order.  Whole texts are read however
long.  Repeated rows are predicted one by one.  Rows with null lang are predicted, never learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, sum_blobs

BITS = 15
UND = "und"
LETTER = regex.compile(r"\p{L}")
_ASCII = np.array([32 if not chr(i).isalpha() else i for i in range(128)], np.uint32)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the text's character n-grams and how often each occurs."""
    a = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(a < 128, _ASCII[np.minimum(a, 127)], a)
    a = a[np.concatenate([[True], (a[1:] != 32) | (a[:-1] != 32)])]
    two = a[:-1] * np.uint32(0x9E3779B1) + a[1:]
    three = two[:-1] * np.uint32(0x85EBCA6B) + a[2:]
    mixed = np.concatenate([a, two ^ np.uint32(0x5BD1E995), three])
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount(mixed >> np.uint32(32 - BITS), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of unit length."""
    v = (1 + np.log(counts)) * idf[at]
    return v / max(np.sqrt(v @ v), 1e-12)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows, n_classes: int, alpha=0.5, beta=1.0, l1=0.02, l2=0.01, epochs=2, seed=7) -> np.ndarray:
    """rows: (indices, values, class).  Weights and, in the last row, biases."""
    z = np.zeros(((1 << BITS) + 1, n_classes))
    n = np.zeros_like(z)
    rng = np.random.default_rng(seed)

    def weights(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        w[np.abs(z) <= l1] = 0
        return w

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v, y = rows[i]
            at, v = np.append(at, 1 << BITS), np.append(v, 1.0)
            w = weights(z[at], n[at])
            p = softmax(v @ w)
            p[y] -= 1
            g = np.outer(v, p)
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    return weights(z, n)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    if not len(y):
        return 1.0
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    low, high, r = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return UND, 0.0
        at, counts = grams(text)
        p = softmax((weighted(at, counts, self.idf) @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Over every row of the column text, each bucket's number of texts; and the number of texts."""

    def count(batches):
        df = np.zeros((1 << BITS) + 1)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[grams(text)[0]] += 1
                df[-1] += 1
        yield pa.RecordBatch.from_pydict({"blob": pa.array([df.tobytes()], pa.binary())})

    total = sum_blobs(texts.select("text").mapInArrow(count, "blob binary"))
    return (total[:-1], int(total[-1])) if total is not None else (np.zeros(1 << BITS), 0)


def train(training: DataFrame, per_language: int = 1000, most_languages: int = 500) -> Model:
    """training: columns doc_id, text and lang.  Of more than most_languages values of lang the most frequent are learned."""
    usable = training.select("doc_id", "text", "lang").filter("lang is not null and text is not null").filter(F.col("text").rlike(r"\p{L}"))
    by_lang = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    languages = sorted(by_lang)
    if not languages:
        return Model([], np.ones(1 << BITS), np.zeros(((1 << BITS) + 1, 1)), 1.0)
    df, n = document_frequencies(usable)
    idf = np.log((1 + n) / (1 + df)) + 1
    rate = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / by_lang[k]))])
    unit = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    number = {k: i for i, k in enumerate(languages)}

    def featurise(batches):
        for batch in batches:
            found = [grams(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column(1), "at": pa.array([a.astype(np.uint16).tobytes() for a, _ in found], pa.binary()),
                "counts": pa.array([c.astype(np.float32).tobytes() for _, c in found], pa.binary()),
            })

    sample = usable.filter(unit < rate[F.col("lang")]).select("text", "lang").mapInArrow(featurise, "lang string, at binary, counts binary").collect()
    rows = []
    for lang, at, counts in sorted(map(tuple, sample)):
        at = np.frombuffer(at, np.uint16).astype(np.int64)
        rows.append((at, weighted(at, np.frombuffer(counts, np.float32), idf), number[lang]))
    last = [r for i, r in enumerate(rows) if i % 5 == 4] or rows
    weights = fit_ftrl([r for i, r in enumerate(rows) if i % 5 != 4] or rows, len(languages))
    logits = np.array([v @ weights[at] + weights[-1] for at, v, _ in last]).reshape(-1, len(languages))
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), fit_temperature(logits, np.array([y for *_, y in last], int)))


def identify(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns of keep, then the language and its probability under the given names.  docs has a column text."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        own = shipped.value
        for batch in batches:
            found = [own.predict(t) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return docs.select(*keep, F.col("text").alias("_text_")).mapInArrow(predict, schema)


def folds(docs: DataFrame, modulus: int = 3) -> DataFrame:
    """doc_id, text, lang and held_out."""
    return docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), modulus).alias("held_out"))
