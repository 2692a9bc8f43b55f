"""Spelling variants: words that differ by one letter, found in a trie over their letter counts.

*Words* are counted in blocks of texts and added up. *Near words* differ by exactly one inserted, deleted or
replaced code point. Letters are dealt into ``GROUPS`` groups of about equal use; a word's vector counts its
letters by group. An insertion gives one group a surplus of one, a deletion a deficit of one, a replacement one of
each, or none within a group. So a depth-first search down the trie of vectors, group by group, with
a budget of one surplus and one deficit reaches every near word, and few others; those in the reached leaves are verified.

*In pieces*: the trie is cut at one depth into subtries, keyed by the counts of the first groups. The search of the
upper levels is a table: each word goes to the subtries that its budget reaches, with what is left of it. The depth is the
least at which no subtrie holds more than ``SUBTRIE`` words, or all groups. A leaf that holds more than that
is dealt in blocks by hash, and a search visits each block. Each pair is looked for once, from its longer word, or from its first in
order if both are as long.

*Forms*: a word's form is its most frequent near word (ties: the first in code-point order) if that occurs at least
twice as often. Frequencies at least double along forms, so they have no cycle; roots are found by pointer jumping.

Defined results: null and empty texts have no words; a null id is the empty text in the hash; repeated rows count
each; long texts are read whole; empty tables give no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plaudit.llm.common import written
from plaudit.llm.units import per_unit

#: A run of letters (fixed value).
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run in a document loses a letter if this divides its hash (fixed value).
DROP_EVERY = 97
LEAST_LETTERS, LEAST_TIMES, MORE = 5, 3, 2
#: Levels of the trie, and words of a subtrie that are searched together.
GROUPS, SUBTRIE = 12, 8192
#: Distinct words of a task that are held before they are handed on.
HELD_WORDS = 300_000
#: Searches that a unit of work holds, that go down a subtrie together, and code points that are compared together.
SEARCHES, TOGETHER, CELLS = 1 << 16, 4096, 1 << 21


def lowered(text: str) -> str:
    """The text with A-Z alone lower-cased."""
    return text.encode().lower().decode()


def with_drop(run: str, start: int) -> str:
    """The run, or the run without one letter if its hash says so; ``start`` is the CRC-32 of what precedes it."""
    h = zlib.crc32(run.encode(), start)
    if h % DROP_EVERY:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LETTERS`` letters that occur at least ``LEAST_TIMES`` times."""
    schema = "word string, n bigint"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def handed_on(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), types[0].type), pa.array(list(held.values()), types[1].type)], schema=types)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for run, n in Counter(RUN.findall(lowered(body or ""))).items():
                    if len(run) >= LEAST_LETTERS:
                        word = with_drop(run, start)
                        if len(word) >= LEAST_LETTERS:
                            held[word] += n
                if len(held) > HELD_WORDS:
                    yield handed_on(held)
                    held = Counter()
        yield handed_on(held)

    return docs.select(doc_id, text).mapInArrow(count, schema).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def group_of(letters: dict[str, int], groups: int = GROUPS) -> dict[str, int]:
    """Letters dealt into groups of about equal use: the most used first, each to the group used least so far."""
    used, dealt = [0] * groups, {}
    for letter, n in sorted(letters.items(), key=lambda item: (-item[1], item[0])):
        least = used.index(min(used))
        dealt[letter] = least
        used[least] += n
    return dealt


def reach(depth: int) -> list[tuple[list[int], int, int]]:
    """The searches of the upper levels: changes of the first ``depth`` counts, and the surplus and deficit that they spend."""
    found = [([0] * depth, 0, 0)]
    for up in range(depth):
        found.append(([int(i == up) for i in range(depth)], 1, 0))
    for down in range(depth):
        found.append(([-int(i == down) for i in range(depth)], 0, 1))
        found += [([int(i == up) - int(i == down) for i in range(depth)], 1, 1) for up in range(depth) if up != down]
    return found


class Trie:
    """The vectors of a subtrie's words, level by level: a node is a range of sorted rows that agree up to its level."""

    def __init__(self, words: np.ndarray, vectors: np.ndarray) -> None:
        order = np.lexsort(vectors.T[::-1]) if vectors.shape[1] else np.arange(len(words))
        self.words, sorted_vectors = words[order], vectors[order]
        self.levels: list[np.ndarray] = []
        starts = np.zeros(1, np.int64)
        for column in sorted_vectors.T:
            new = np.append(True, column[1:] != column[:-1])
            new[starts] = True
            children = np.flatnonzero(new)
            # A child's key holds its node and its count; keys ascend like the rows.
            self.levels.append((np.searchsorted(starts, children, "right") - 1 << 32) + column[children])
            starts = children
        self.starts, self.ends = starts, np.append(starts[1:], len(words))

    def search(self, vectors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(search, word) for the words of every leaf within each search's budget; all searches go down together.

        Leaves that leave more of the deficit than of the surplus hold longer words, which look for this one themselves.
        """
        who, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        for level, keys in enumerate(self.levels):
            found = []
            for change, able in ((-1, deficit > 0), (0, np.full(len(who), True)), (1, surplus > 0)):
                w = who[able]
                count = vectors[w, level] + change
                key = (node[able] << 32) + count
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = (keys[at] == key) & (count >= 0)
                found.append((w[hit], at[hit], surplus[able][hit] - (change > 0), deficit[able][hit] - (change < 0)))
            who, node, surplus, deficit = (np.concatenate(part) for part in zip(*found))
        useful = surplus >= deficit
        who, node = who[useful], node[useful]
        sizes = self.ends[node] - self.starts[node]
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(who, sizes), self.words[np.repeat(self.starts[node], sizes) + inside]


def letters_of(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, zeros behind them."""
    lengths = np.array([len(word) for word in words], np.int64)
    rows = np.zeros((len(words), width), np.uint32)
    rows[np.arange(width) < lengths[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return rows


def one_apart(a: np.ndarray, b: np.ndarray, equally_long: np.ndarray) -> np.ndarray:
    """Whether rows of ``b`` are those of ``a`` with one code point replaced, or deleted where they aren't equally long."""
    differs = a != b
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])
    places = np.arange(a.shape[1])
    replaced = differs.sum(axis=1) == 1
    shifted = np.concatenate([a[:, 1:], np.zeros((len(a), 1), a.dtype)], axis=1)
    deleted = ~((shifted != b) & (places >= first[:, None])).any(axis=1)
    return np.where(equally_long, replaced, deleted)


def near_pairs(words: list[str], own: np.ndarray, vectors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (word, near word) that a unit's searches find; its rows are words of the subtrie (``own``) or searches of it."""
    inside, asking = np.flatnonzero(own), np.flatnonzero(~own)
    if not len(inside) or not len(asking):
        return
    trie = Trie(inside, vectors[inside])
    lengths = np.array([len(word) for word in words], np.int64)
    rank = np.unique(np.array(words, object), return_inverse=True)[1]
    for start in range(0, len(asking), TOGETHER):
        ask = asking[start : start + TOGETHER]
        who, b = trie.search(vectors[ask], surplus[ask], deficit[ask])
        a = ask[who]
        fits = (lengths[a] == lengths[b] + 1) | ((lengths[a] == lengths[b]) & (rank[a] < rank[b]))
        a, b = a[fits], b[fits]
        order = np.argsort(-lengths[a], kind="stable")
        a, b, at = a[order], b[order], 0
        while at < len(a):  # the longest first, so many at a time as fit into a bounded matrix
            width = int(lengths[a[at]])
            x, y = (side[at : at + max(1, CELLS // width)] for side in (a, b))
            at += len(x)
            near = one_apart(
                letters_of([words[i] for i in x], width), letters_of([words[i] for i in y], width), lengths[x] == lengths[y]
            )
            yield x[near], y[near]


def _group_counts(word: str, dealt: dict[str, int]) -> list[Column]:
    """How many letters of each group a word has."""
    of = ["".join(letter for letter, g in dealt.items() if g == group) for group in range(GROUPS)]
    return [(F.length(word) - F.length(F.translate(word, letters, ""))).cast("int") if letters else F.lit(0) for letters in of]


def _depth(vectors: DataFrame) -> int:
    """The least depth at which no subtrie holds more than ``SUBTRIE`` words; all groups if none does."""
    prefixes = F.array(*[F.struct(F.lit(d).alias("depth"), F.slice("vector", 1, d).alias("prefix")) for d in range(1, GROUPS + 1)])
    largest = (
        vectors.groupBy("vector").agg(F.count(F.lit(1)).alias("n")).select("n", F.inline(prefixes))
        .groupBy("depth", "prefix").agg(F.sum("n").alias("n")).groupBy("depth").agg(F.max("n").alias("n"))
    )
    return min((row.depth for row in largest.collect() if row.n <= SUBTRIE), default=GROUPS)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all near words of every word of (word, n), in both directions."""
    # One row per letter: the alphabet is that of RUN.
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    dealt = group_of({row.letter: row.n for row in letters.collect() if row.letter})
    vectors = written(words.select("word", "n", F.array(*_group_counts("word", dealt)).alias("vector")), "spelling-vectors")
    depth = _depth(vectors)
    prefix = F.slice("vector", 1, depth)
    nodes = written(vectors.groupBy(prefix.alias("node")).agg(F.count(F.lit(1)).alias("size")), "spelling-nodes")
    moves = F.array(*[
        F.struct(F.array(*map(F.lit, change)).alias("change"), F.lit(1 - up).alias("surplus"), F.lit(1 - down).alias("deficit"))
        for change, up, down in reach(depth)
    ])
    # Which subtries the words of a subtrie search, and with what budget: subtries only, however many words they hold.
    links = nodes.select("node", "size", F.inline(moves)).select(
        "node", "size", F.zip_with("node", "change", lambda count, by: count + by).alias("target"), "surplus", "deficit"
    ).join(nodes.select(F.col("node").alias("target"), F.col("size").alias("words")), "target")
    asked = links.groupBy("target").agg(F.sum("size").alias("searches"), F.first("words").alias("words")).select(
        "target", F.ceil(F.col("words") / SUBTRIE).cast("int").alias("word_blocks"), F.ceil(F.col("searches") / SEARCHES).cast("int").alias("ask_blocks")
    )
    links = written(links.drop("size", "words").join(asked, "target"), "spelling-links")
    rest = [F.get("vector", F.lit(level)).alias(f"v{level}") for level in range(depth, GROUPS)]

    def block(blocks: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    unit = F.xxhash64("target", "word_block", "ask_block").alias("unit")
    placed = vectors.withColumn("target", prefix).join(asked, "target")
    inside = placed.withColumn("word_block", block("word_blocks")).withColumn("ask_block", every("ask_blocks")).select(
        unit, "word", "n", F.lit(True).alias("own"), F.lit(0).alias("surplus"), F.lit(0).alias("deficit"), *rest
    )
    asking = (
        vectors.withColumn("node", prefix).join(links, "node")
        .withColumn("ask_block", block("ask_blocks")).withColumn("word_block", every("word_blocks"))
        .select(unit, "word", "n", F.lit(False).alias("own"), "surplus", "deficit", *rest)
    )
    names = [f"v{level}" for level in range(depth, GROUPS)]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        words, n = rows["word"].tolist(), rows["n"].to_numpy()
        vectors = rows[names].to_numpy(np.int64).reshape(len(rows), -1)
        none = np.zeros(0, np.int64)
        pairs = [(none, none), *near_pairs(words, rows["own"].to_numpy(), vectors, rows["surplus"].to_numpy(), rows["deficit"].to_numpy())]
        a, b = map(np.concatenate, zip(*pairs))
        word = np.array(words, object)
        return pd.DataFrame({"word": word[np.append(a, b)], "near": word[np.append(b, a)], "near_n": n[np.append(b, a)]})

    return per_unit(inside.unionByName(asking), work, "word string, near string, near_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the end of each word's forms, by pointers that jump twice as far each round."""
    ends = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not ends.filter("moved").isEmpty():
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = written(
            ends.join(further, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
    return ends.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents."""
    words = written(word_counts(docs, doc_id, text), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("by"), F.col("near"))).alias("best")
    )
    fits = -F.col("best.by") >= MORE * F.col("n")
    grouped = written(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.by")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(grouped.filter(F.col("form").isNotNull()))
    return grouped.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
