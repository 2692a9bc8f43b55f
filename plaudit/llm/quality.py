"""Quality by random indexing: word vectors from contexts, pooled per document, and a small network.

Every word has a sparse index vector of a few +1 and -1, drawn from a hash of the word. A word's
vector is the sum of the index vectors of its neighbours over all documents. Words share
hashed rows, so that the table has a fixed size at any vocabulary; sums are
whole numbers, so that they don't depend on order. A document is the mean of its words'
unit vectors; a network of two layers, in numpy, scores it, and a temperature fitted on
labelled documents that it hasn't seen calibrates its probabilities.

Defined results: null and empty texts have the zero vector and get the network's answer to
it; whole texts of any length are read; without labels of both classes every
score is the share of good labels (0.0 without labels).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.common import blocks, per_text, remainder
from plaudit.llm.learning import labelled

ROWS = 1 << 14  # hashed rows of the word table
SIZE = 64  # dimensions of a vector
MARKS = 4  # entries of an index vector that are not 0
REACH = 2  # neighbours on each side
HIDDEN = 32
SAMPLE = 8000  # labelled documents of each class that are learned from, at most (about)
BLOCK_CHARS = 1 << 20
MEMO_ENTRIES = 400_000
WORD = re.compile(r"\w+|[^\w\s]+")


class Rows(dict):
    """Word -> hashed row, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        row = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=4).digest(), "little") % ROWS
        if len(self) < MEMO_ENTRIES:
            self[word] = row
        return row


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each hashed row's index vector."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((ROWS, SIZE)), axis=1)[:, :MARKS]
    return places, rng.choice([-1, 1], (ROWS, MARKS))


def tokenised(texts: list[str], rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all words, and how many words each text has."""
    words = [WORD.findall(text) for text in texts]
    flat = [word for one in words for word in one]
    return (
        np.fromiter(map(rows.__getitem__, flat), np.int64, len(flat)),
        np.fromiter(map(len, words), np.int64, len(words)),
    )


def context_sums(docs: DataFrame) -> np.ndarray:
    """The word table over all documents: partial sums per task, added up by row."""
    names = [f"v{i}" for i in range(SIZE)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, (places, signs) = Rows(), index_vectors()
        sums = np.zeros(ROWS * SIZE)
        for batch in batches:
            texts = [t for t in batch.iloc[:, 0] if isinstance(t, str)]
            for start, end in blocks(texts, BLOCK_CHARS):
                words, sizes = tokenised(texts[start:end], rows)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                for step in range(1, REACH + 1):
                    same = owner[step:] == owner[:-step]
                    left, right = words[:-step][same], words[step:][same]
                    for word, other in ((left, right), (right, left)):
                        for k in range(MARKS):
                            at = word * SIZE + places[other, k]
                            sums += np.bincount(at, signs[other, k], ROWS * SIZE)
        table = sums.astype(np.int64).reshape(ROWS, SIZE)
        used = np.flatnonzero(table.any(axis=1))
        yield pd.DataFrame(table[used], columns=names).assign(row=used)

    partial = docs.select("text").mapInPandas(run, ", ".join([f"{n} bigint" for n in names] + ["row bigint"]))
    total = partial.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    table = np.zeros((ROWS, SIZE))
    found = total.toPandas()  # at most ROWS rows
    table[found["row"].to_numpy(np.int64)] = found[names].to_numpy(float)
    return table


def unit_vectors(table: np.ndarray) -> np.ndarray:
    table = np.sign(table) * np.sqrt(np.abs(table))
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray, rows: Rows) -> np.ndarray:
    """The mean of the words' vectors of each text, and the logarithm of their number."""
    out = np.zeros((len(texts), SIZE + 1))
    for start, end in blocks(texts, BLOCK_CHARS // 8):
        words, sizes = tokenised(texts[start:end], rows)
        ends = np.cumsum(sizes)
        for i, (size, last) in enumerate(zip(sizes, ends), start):
            if size:
                counts = np.bincount(words[last - size : last], minlength=1)
                at = np.flatnonzero(counts)
                out[i, :SIZE] = counts[at] @ vectors[at] / size
                out[i, SIZE] = np.log1p(size) / 10
    return out


class Network:
    """Two layers (tanh, logistic), trained by Adam in numpy; a temperature calibrates its logits."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, calibration: np.ndarray, epochs: int = 60):
        rng = np.random.default_rng(11)
        train = ~calibration
        self.mean, self.scale = x[train].mean(0), x[train].std(0) + 1e-6
        z, t, weight = (x[train] - self.mean) / self.scale, y[train], weights[train] / weights[train].mean()
        shapes = ((z.shape[1], HIDDEN), (HIDDEN,), (HIDDEN, 1), (1,))
        self.w = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) == 2 else np.zeros(s) for s in shapes]
        first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for at in range(0, len(z), 128):
                rows = order[at : at + 128]
                hidden = np.tanh(z[rows] @ self.w[0] + self.w[1])
                p = 1 / (1 + np.exp(-np.clip((hidden @ self.w[2] + self.w[3])[:, 0], -30, 30)))
                out = (weight[rows] * (p - t[rows]) / len(rows))[:, None]
                back = out @ self.w[2].T * (1 - hidden**2)
                step += 1
                for k, g in enumerate((z[rows].T @ back, back.sum(0), hidden.T @ out, out.sum(0))):
                    if k in (0, 2):
                        g = g + 1e-4 * self.w[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.w[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        logits, t = self.logits(x[calibration]), y[calibration]
        temperatures = np.geomspace(0.25, 8, 60)
        loss = [(weights[calibration] * np.logaddexp(0, np.where(t == 1, -logits, logits) / k)).sum() for k in temperatures]
        self.temperature = float(temperatures[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w[0] + self.w[1])
        return (hidden @ self.w[2] + self.w[3])[:, 0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def fit_and_score(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """(doc_id, score) for every document, learned from a bounded sample of labels that aren't held out."""
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(unit_vectors(context_sums(docs)))  # ROWS * SIZE floats
    sample = labelled(labels, "quality", remainder("doc_id", 4) != 2, per_class, "quality")
    seen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id")

    def prepare_features():
        rows = Rows()
        return lambda ids, texts: {"doc_id": ids, "x": list(pooled(texts, vectors.value, rows))}

    kind = dict(docs.dtypes)["doc_id"]
    x = per_text(seen, f"doc_id {kind}, x array<double>", prepare_features).dropDuplicates(["doc_id"])
    rows = x.join(F.broadcast(sample), "doc_id").withColumn("c", remainder("doc_id", 97) % 4 == 0)
    rows = sorted(rows.select("doc_id", "x", "y", "weight", "c").collect())
    y = np.array([r.y for r in rows])
    calibration = np.array([r.c for r in rows], bool)
    weights = np.array([r.weight for r in rows], float)
    constant = float((y * weights).sum() / weights.sum()) if len(y) else 0.0
    both = len(y) and min(len(set(y[calibration])), len(set(y[~calibration]))) == 2
    network = Network(np.array([r.x for r in rows]), y, weights, calibration) if both else None

    def prepare():
        memo = Rows()

        def work(ids, texts):
            scores = network(pooled(texts, vectors.value, memo)) if network else np.full(len(texts), constant)
            return {"doc_id": ids, "score": scores}

        return work

    return per_text(docs, f"doc_id {kind}, score double", prepare)
