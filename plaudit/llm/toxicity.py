"""Toxicity by compression distance.

A zstandard dictionary is trained on windows of ordinary text, another on passages of toxic
text: the runs of words, of any length, that toxic documents use significantly more often. Each window of a text is
compressed with the ordinary one, and with the ordinary one followed by the toxic one; the bytes that the
second saves are the window's gain. Shares of windows above gain thresholds and means of the highest gains
are calibrated to a probability on labelled documents that neither dictionary has seen.

Whole windows of toxic documents don't serve: most of them is ordinary text, which fills the dictionary
(README has the figures).

Defined results: null and empty texts are scored as one empty window; whole texts of any length are scored;
without labels of both classes every score is the share of toxic labels (0.0 without labels).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from plaudit.llm.common import per_text, remainder
from plaudit.llm.learning import Logistic, labelled

WINDOW = 48
LEVEL = 3
#: Bytes of a dictionary, at most. The toxic one takes a multiple of its different words' bytes: one that repeats
#: them more often tells less, as matches lie further back.
DICTIONARY_BYTES = 108 << 10
WORD_ROOM = 2
#: Windows that a dictionary is trained on, at most, drawn evenly from those of the sample.
DICTIONARY_WINDOWS = 40_000
#: Labelled documents of each class that are learned from, at most (about), and bytes of the longest of them.
SAMPLE = 5000
SAMPLE_TEXT_BYTES = 1 << 16
#: A word counts as toxic if twice its log-likelihood ratio is so many times the logarithm of the
#: vocabulary; the one that calibrates best is taken.
SIGNIFICANT = (1.5, 2.5, 4.0, 6.0)
ODD = (np.uint64(2654435761), np.uint64(2246822519), np.uint64(3266489917))
WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x40]+")


def windows(text: str) -> list[bytes]:
    data = text.encode().lower()
    return [data[i : i + WINDOW] for i in range(0, max(len(data), 1), WINDOW)]


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary; too few samples to train on serve as its content."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" "


def without_copies(texts: list[str]) -> list[str]:
    """Texts that share none of three minimum hashes of five words with an earlier one.

    A group of copies would make every word of its text look typical of its class.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for text in texts:
        words = WORDS.findall(text.encode().lower())
        shingles = [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
        hashes = np.array([zlib.crc32(s) for s in shingles], np.uint64)
        marks = {(k, int(((hashes * odd) % np.uint64(2**32 - 5)).min())) for k, odd in enumerate(ODD)}
        if not marks & seen:
            kept.append(text)
        seen |= marks
    return kept


def drawn(samples: list[bytes], rng: np.random.Generator) -> list[bytes]:
    return [samples[i] for i in rng.permutation(len(samples))[:DICTIONARY_WINDOWS]]


def word_ratios(toxic: list[str], ordinary: list[str]) -> dict[bytes, float]:
    """Words in more toxic than ordinary documents: twice the log-likelihood ratio over the logarithm of the vocabulary."""
    counts = []
    for texts in (toxic, ordinary):
        seen: Counter = Counter()
        for text in texts:
            seen.update(set(WORDS.findall(text.encode().lower())))
        counts.append(seen)
    n, m = len(toxic), len(ordinary)
    found, share = {}, n / (n + m)
    for word, hits in counts[0].items():
        other = counts[1][word]
        expected = (hits + other) * share
        if hits > expected:
            rest = other * np.log(other / (hits + other - expected)) if other else 0
            found[word] = 2 * (hits * np.log(hits / expected) + rest) / np.log(len(counts[0]) + 1)
    return found


def passages(texts: list[str], marked: set[bytes]) -> list[bytes]:
    """The runs of ``marked`` words in the texts, each with what stands before, between and behind its words."""
    found = []
    for text in texts:
        data = text.encode().lower()
        start = end = None
        for word in WORDS.finditer(data):
            if word[0] in marked:
                start, end = word.start() if start is None else start, word.end()
            elif start is not None:
                found.append(data[max(0, start - 1) : end + 1])
                start = None
        if start is not None:
            found.append(data[max(0, start - 1) : end + 1])
    return found


class Model:
    """Two dictionaries and the calibration of their gains."""

    def __init__(self, texts: list[str], y: np.ndarray, weights: np.ndarray, calibration: np.ndarray):
        """``calibration`` marks the documents that only calibrate."""
        self.base = self.toxic = b" "
        self.calibrated, self.constant = None, float((y * weights).sum() / weights.sum()) if len(y) else 0.0
        parts = [[t for t, k, c in zip(texts, y, calibration) if k == kind and not c] for kind in (1, 0)]
        if not all(parts) or len(set(y[calibration])) < 2:
            return
        toxic, ordinary = map(without_copies, parts)
        rng = np.random.default_rng(0)
        self.base = trained(drawn([w for text in ordinary for w in windows(text)], rng), DICTIONARY_BYTES)
        ratios = word_ratios(toxic, ordinary)
        held = [t for t, c in zip(texts, calibration) if c]
        best = None
        for significant in SIGNIFICANT:
            marked = {word for word, ratio in ratios.items() if ratio > significant}
            samples = passages(toxic, marked)
            if not samples and best:
                break
            size = WORD_ROOM * sum(len(word) + 2 for word in marked) or DICTIONARY_BYTES
            samples = drawn(samples or [w for text in toxic for w in windows(text)], rng)
            extra = trained(samples, min(size, DICTIONARY_BYTES))
            self.toxic = self.base + extra
            self.__dict__.pop("pair", None)
            fitted = Logistic(self.features(held), y[calibration], weights[calibration])
            if best is None or fitted.loss < best[0].loss:
                best = fitted, self.toxic
        self.calibrated, self.toxic = best
        self.__dict__.pop("pair", None)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "pair"}

    def compressors(self):
        if "pair" not in self.__dict__:
            options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            dictionaries = [zstandard.ZstdCompressionDict(d) for d in (self.base, self.toxic)]
            self.pair = [zstandard.ZstdCompressor(dict_data=d, **options).compress for d in dictionaries]
        return self.pair

    def features(self, texts: list[str]) -> np.ndarray:
        plain, toxic = self.compressors()
        rows = []
        for text in texts:
            pieces = windows(text)
            gains = np.fromiter((len(plain(w)) - len(toxic(w)) for w in pieces), np.int64, len(pieces))
            high = np.sort(gains)[::-1]
            n = len(gains)
            rows.append(
                [gains.mean(), high[: max(1, n // 5)].mean(), high[: max(1, n // 20)].mean(), high[0]]
                + [(gains >= k).mean() for k in (1, 2, 3, 4, 5)]
                + [np.log1p((gains >= 3).sum()), np.log1p(n)]
            )
        return np.array(rows)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.calibrated is None or not texts:
            return np.full(len(texts), self.constant)
        return self.calibrated(self.features(texts))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model:
    """Learn from a bounded sample of the labelled documents that are not held out.

    At most about 2 * ``per_class`` texts of at most 64 KB each reach the driver.
    """
    sample = labelled(labels, "toxic", remainder("doc_id", 5) != 0, per_class, "toxicity")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(
        F.octet_length("text") <= SAMPLE_TEXT_BYTES
    )
    rows = texts.join(F.broadcast(sample), "doc_id").withColumn("c", remainder("doc_id", 97) % 3 == 0)
    rows = sorted(rows.select("doc_id", "text", "y", "weight", "c").dropDuplicates(["doc_id"]).collect())
    y, weights, c = (np.array([r[k] for r in rows], kind) for k, kind in (("y", int), ("weight", float), ("c", bool)))
    return Model([r.text for r in rows], y, weights, c)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every document."""

    def prepare():
        return lambda ids, texts: {"doc_id": ids, "score": model.scores(texts)}

    return per_text(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, score double", prepare)


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The documents that score below ``limit``; rows keep all their columns."""

    @F.pandas_udf(DoubleType())
    def scored(texts):
        import pandas as pd

        return pd.Series(model.scores([t if isinstance(t, str) else "" for t in texts]))

    return docs.filter(scored(F.col("text")) < limit)
