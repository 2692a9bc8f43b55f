"""Quality rules: counting rules, and how far a text's histograms lie from those of its language.

Two histograms of each text are compared with references by the Jensen-Shannon distance (base 2, 0 to 1):
its characters by class, and its words among the language's common words, with one bin for all others.

*References* (:func:`references`) come from all documents that pass the counting rules. A language has one if
it holds at least one in ``LANGUAGES`` of all words, and ``LEAST_WORDS`` of them; so there are at most ``LANGUAGES``
references, whatever the corpus. Its common words are its ``COMMON`` most frequent ones (stripped of what is no
letter at both ends, lower-cased; ties by word).

*Verdict*: a text fails if a distance exceeds its bound. A histogram of n draws lies off its source by chance, by about
(bins in use - 1) / (8 n ln 2) of squared distance, so that much is taken off, and a histogram is judged only from
``LEAST_CHARS`` characters or ``LEAST_TEXT_WORDS`` words. A text that is far from its own language's reference
fails only if it is far from every other's too, as languages are often mislabelled. A text without a
language (null or empty) is compared with all and adds to none; one whose language has no reference is not judged.

Defined results: null and empty texts have no words and fail the counting rules (fewer than 20 words); repeated rows
give repeated results; without any reference only the counting rules decide; whole texts of any length are read.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plaudit.llm.common import BLOCK_CHARS, blocks, written

#: Classes of characters, by Unicode category (fixed values).
CLASSES = ("lower", "upper", "other letter", "mark", "digit", "space", "line end", "sentence mark", "punctuation", "symbol", "control")
SENTENCE_MARKS = ".,;:!?'\"-"
SYMBOLS = "#*$%&|<>"
#: Words in a window whose repetition counts.
WINDOW = 8
#: Counting rules: words at least, and percent of words in repeated windows at most.
FEWEST_WORDS, MOST_REPEATED = 20, 30
LANGUAGES, LEAST_WORDS, COMMON = 1000, 5000, 64
LEAST_CHARS, LEAST_TEXT_WORDS = 200, 50
#: Bounds on the distances, after the part that chance explains.
CLASS_BOUND, WORD_BOUND = 0.25, 0.35
#: Entries of a task's word counts that are kept before they are handed on.
HELD_WORDS = 300_000


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The class of every code point; ``CLASSES`` in order."""
    by_category = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Nd": 4, "Nl": 4, "No": 4, "Zs": 5}
    by_letter = {"M": 3, "Z": 6, "P": 8, "S": 9, "C": 10}
    categories = [unicodedata.category(chr(code)) for code in range(0x110000)]
    table = np.array([by_category.get(c, by_letter.get(c[0], 2)) for c in categories], np.uint8)
    table[[0x09, 0x0B, 0x0C]] = 5
    table[[0x0A, 0x0D]] = 6
    table[[ord(c) for c in SENTENCE_MARKS]] = 7
    return table


class Words:
    """The words of a block of texts as numbers, with the text that each belongs to."""

    def __init__(self, texts: list[str]) -> None:
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        # bytes.split() cuts at the ASCII white space alone.
        rows = [np.fromiter(map(numbers.__getitem__, text.encode().split()), np.int64) for text in texts]
        self.counts = np.array([len(row) for row in rows], np.int64)
        self.ids = np.concatenate([*rows, np.zeros(0, np.int64)])
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        self.distinct = list(numbers)

    def repeated(self) -> np.ndarray:
        """Per text, the words in windows that it holds at least twice.

        Windows get exact numbers by doubling: two words, two such pairs, two of those.
        """
        key = self.ids + len(self.distinct) * self.text  # windows of different texts differ
        span = 1
        while span < WINDOW and len(key) > span:
            number = np.unique(key, return_inverse=True)[1]
            key = (number[:-span] << 32) | number[span:]
            span *= 2
        n = len(self.ids) - WINDOW + 1
        if n <= 0:
            return np.zeros(len(self.counts), np.int64)
        inside = np.flatnonzero(self.text[:n] == self.text[WINDOW - 1 :])
        _, number, times = np.unique(key[inside], return_inverse=True, return_counts=True)
        starts = inside[times[number] > 1]
        edges = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return np.bincount(self.text[np.cumsum(edges[:-1]) > 0], minlength=len(self.counts))


def bare(word: bytes) -> str:
    """A word without what is no letter at its ends, lower-cased; the empty string if nothing stays."""
    text = word.decode()
    if text.isalpha():
        return text.lower()
    letters = [i for i, char in enumerate(text) if char.isalpha()]
    return text[letters[0] : letters[-1] + 1].lower() if letters else ""


def classes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: characters by class, characters in words, and symbols."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    by_class = np.bincount(text * len(CLASSES) + class_table()[codes], minlength=len(texts) * len(CLASSES))
    in_words = ~((codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D)))
    marks = np.zeros(128, bool)
    marks[[ord(c) for c in SYMBOLS]] = True
    symbols = marks[np.minimum(codes, 127)] & (codes < 127)
    return (
        by_class.reshape(len(texts), len(CLASSES)),
        np.bincount(text[in_words], minlength=len(texts)), np.bincount(text[symbols], minlength=len(texts)),
    )


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    return len(lines) - len(set(lines))


def base_failed(n_words: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    return (n_words < FEWEST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)


REFERENCE = "lang string, classes array<bigint>, words array<string>, word_counts array<bigint>, n_words bigint"


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, classes, words, word_counts, n_words): one row per language with enough words; at most ``LANGUAGES`` rows."""
    schema = "lang string, word string, n bigint"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words and, under names that no word has (" 0" is class 0, " all" all words), characters by class."""
        held: dict[tuple[str, str], int] = defaultdict(int)

        def handed_on() -> pa.RecordBatch:
            columns = [[key[0] for key in held], [key[1] for key in held], list(held.values())]
            out = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, types)], schema=types)
            held.clear()
            return out

        for batch in batches:
            texts, langs = ([v or "" for v in batch.column(i).to_pylist()] for i in range(2))
            for start, end in blocks(texts, BLOCK_CHARS):
                part, names = texts[start:end], langs[start:end]
                words, by_class = Words(part), classes_of(part)[0]
                good = ~base_failed(words.counts, words.repeated())
                spelled = [bare(word) for word in words.distinct]
                for name in set(names) - {""}:
                    of = np.array([n == name for n in names]) & good
                    counts = np.bincount(words.ids[of[words.text]], minlength=len(spelled))
                    for i in np.flatnonzero(counts):
                        held[name, spelled[i]] += int(counts[i])
                    held[name, " all"] += int(counts.sum())
                    for k, n in enumerate(by_class[of].sum(axis=0)):
                        held[name, f" {k}"] += int(n)
                if len(held) > HELD_WORDS:
                    yield handed_on()
        yield handed_on()

    counted = written(
        docs.select(text, lang).mapInArrow(count, schema).filter("n > 0").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "rules-words",
    )
    sizes = counted.filter("word = ' all'").select("lang", F.col("n").alias("n_words"))
    total = sizes.agg(F.sum("n_words").alias("total"))
    large = sizes.join(F.broadcast(total), (F.col("n_words") >= LEAST_WORDS) & (F.col("n_words") * LANGUAGES >= F.col("total")))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (
        counted.filter(~F.startswith("word", F.lit(" ")) & (F.col("word") != "")).withColumn("place", F.row_number().over(most))
        .filter(F.col("place") <= COMMON)  # each task keeps its own best before the shuffle
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("w"))
    )
    classes = counted.groupBy("lang").agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("word") == f" {k}", F.col("n"))), F.lit(0)) for k in range(len(CLASSES))]).alias("classes")
    )
    return written(
        large.join(common, "lang").join(classes, "lang").select(
            "lang", "classes", F.col("w.word").alias("words"), F.col("w.n").alias("word_counts"), "n_words"
        ),
        "rules-references",
    )


def distances(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row's histogram to the reference, less what chance explains."""
    n = counts.sum(axis=1)
    p, q = counts / np.maximum(n, 1)[:, None], reference / reference.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=1) for x in (p, np.broadcast_to(q, p.shape))]
    chance = ((m > 0).sum(axis=1) - 1) / (8 * np.log(2) * np.maximum(n, 1))
    return np.sqrt(np.clip((parts[0] + parts[1]) / 2 - chance, 0.0, 1.0))


class Judge:
    """Compares blocks of texts with the references."""

    def __init__(self, rows: list) -> None:
        self.classes = {r["lang"]: np.array(r["classes"], float) for r in rows}
        self.places = {r["lang"]: {word: i for i, word in enumerate(r["words"])} for r in rows}
        self.words = {
            r["lang"]: np.array([*r["word_counts"], max(r["n_words"] - sum(r["word_counts"]), 0)], float) for r in rows
        }

    def measured(self, lang: str, chosen: np.ndarray, by_class: np.ndarray, words: Words, spelled: list[str]) -> np.ndarray:
        """(class distance, word distance) of the chosen texts to a language's reference; 0 where the text is too short."""
        bins = len(self.words[lang])
        bin_of = np.array([self.places[lang].get(word, bins - 1) for word in spelled], np.int64)
        place = np.full(len(by_class), -1)
        place[chosen] = np.arange(len(chosen))
        inside = place[words.text] >= 0
        used = np.bincount(place[words.text[inside]] * bins + bin_of[words.ids[inside]], minlength=len(chosen) * bins)
        out = np.stack([distances(by_class[chosen], self.classes[lang]), distances(used.reshape(-1, bins), self.words[lang])], axis=1)
        out[by_class[chosen].sum(axis=1) < LEAST_CHARS, 0] = 0.0
        out[words.counts[chosen] < LEAST_TEXT_WORDS, 1] = 0.0
        return out

    def nearest(self, langs: list[str | None], by_class: np.ndarray, words: Words) -> np.ndarray:
        """(class distance, word distance) of each text to its own language, or to the nearest if that is far; 0 if not judged."""
        spelled = [bare(word) for word in words.distinct]
        out = np.zeros((len(langs), 2))
        name = np.array([lang or "" for lang in langs], object)
        for lang in set(name) & set(self.classes):
            of = np.flatnonzero(name == lang)
            out[of] = self.measured(lang, of, by_class, words, spelled)
        out[name == ""] = 1.0  # to be compared with all
        far = np.flatnonzero((out > (CLASS_BOUND, WORD_BOUND)).any(axis=1))
        if not self.classes:
            return np.zeros_like(out)
        for lang in self.classes if len(far) else ():
            other = self.measured(lang, far, by_class, words, spelled)
            nearer = (other / (CLASS_BOUND, WORD_BOUND)).max(axis=1) < (out[far] / (CLASS_BOUND, WORD_BOUND)).max(axis=1)
            out[far[nearer]] = other[nearer]
        return out


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
    "class_distance double, word_distance double, kept boolean"
)


def judged(docs: DataFrame, refs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, the measures, both distances, kept) for every document, with references by :func:`references`."""
    rows = [row.asDict() for row in refs.collect()]  # at most LANGUAGES of COMMON words each
    schema = f"`{doc_id}` {dict(docs.dtypes)[doc_id]}, {MEASURES}"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(rows)
        for batch in batches:
            texts, langs = [v or "" for v in batch.column(1).to_pylist()], batch.column(2).to_pylist()
            for start, end in blocks(texts, BLOCK_CHARS):
                part = texts[start:end]
                words = Words(part)
                by_class, word_chars, symbols = classes_of(part)
                repeated = words.repeated()
                failed = base_failed(words.counts, repeated)
                far = judge.nearest(langs[start:end], by_class, words)
                kept = ~failed & (far <= (CLASS_BOUND, WORD_BOUND)).all(axis=1)
                lines = [repeated_lines(t) for t in part]
                columns = [words.counts, word_chars, symbols, lines, repeated, failed, far[:, 0], far[:, 1], kept]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), *[pa.array(v, f.type) for v, f in zip(columns, list(types)[1:])]],
                    schema=types,
                )

    return docs.select(doc_id, text, lang).mapInArrow(run, schema)
