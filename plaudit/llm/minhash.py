"""Near-duplicate texts by fast similarity sketching, banding and exact verification.

Sketching: in round i every shingle of a text is hashed to a bin and a value of that round; an empty or larger
bin takes it. Values of later rounds are larger, so a bin keeps its first round. From round t on,
all shingles go to bin i - t, so after 2 t rounds every bin is filled, also for a single
shingle; texts of many shingles are done after the first. Two texts agree in a bin with
probability equal to their Jaccard similarity, concentrated as if bins were independent.

Banding: texts that agree in all bins of a band are candidates. At similarity 0.75 two
texts share none of 40 bands of 5 bins with probability 2e-5. The bins' low bytes estimate the
similarity of a candidate pair before texts are fetched: below 0.6 of 200 bins, 4.9
standard errors under 0.75, a pair is let go.

Verification: each bucket's texts are first compared with its smallest, exactly, on the
full sets of shingles. Of a bucket whose texts are then not all in one component, the
pairs across components follow, in blocks of bounded size.

Defined results: texts without words have no shingles and link with nothing; texts of fewer
than five words have one shingle, the whole sequence; copies (the same words) form a class
and are linked; rows without an id get no component and are not kept; rows that share an id share their component, which all their
texts take part in (texts without words stay alone). Classes are numbered and compared by
their numbers, as an id may stand for several of them.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.common import per_text, written
from plaudit.llm.components import components
from plaudit.llm.units import cut, per_unit, with_totals
from plaudit.sizing import is_small, lookup_join

SHINGLE = 5
PERCENT = 75
BANDS, DEEP = 40, 5
BINS = BANDS * DEEP
LEAST_ESTIMATE = 0.6
MEMO_ENTRIES = 400_000
#: Texts of a bucket that are compared with each other in one task.
BUCKET_BLOCK = 1024
EMPTY = np.uint64(2**64 - 1)


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


SHINGLE_ODD = odd_numbers(SHINGLE, 1)
BAND_ODD = odd_numbers(DEEP, 2)
ROUND_ODD = odd_numbers(2 * BINS, 3)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < MEMO_ENTRIES:
            self[word] = value
        return value


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lowered; bytes.split cuts at exactly the ASCII white space that is meant."""
    return text.encode().lower().split()


def shingle_hashes(words: list[list[bytes]], memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, repeats included, and how many each text has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(
        map(memo.__getitem__, [w for one in words for w in one]), np.uint64, int(sizes.sum())
    )
    ends = np.cumsum(sizes)
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    first = np.repeat(ends - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    length = np.repeat(np.minimum(sizes, SHINGLE), counts)
    padded = np.append(flat, np.zeros(SHINGLE, np.uint64))
    total = length.astype(np.uint64)
    for k, odd in enumerate(SHINGLE_ODD):
        total += np.where(length > k, padded[first + k] * odd, np.uint64(0))
    return mixed(total), counts


def sketches(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bins of every text; texts without shingles keep empty bins."""
    bins = np.full((len(counts), BINS), EMPTY, np.uint64)
    flat = bins.reshape(-1)
    owner = np.repeat(np.arange(len(counts)), counts)
    for i in range(2 * BINS):
        if not len(hashes):
            break
        drawn = mixed(hashes * ROUND_ODD[i] + np.uint64(i))
        value = (np.uint64(i) << np.uint64(32)) | (drawn & np.uint64(0xFFFFFFFF))
        place = ((drawn >> np.uint64(32)) % np.uint64(BINS)).astype(np.int64) if i < BINS else i - BINS
        np.minimum.at(flat, owner * BINS + place, value)
        unfilled = (bins == EMPTY).any(axis=1)[owner]
        if not unfilled.all():
            hashes, owner = hashes[unfilled], owner[unfilled]
    return bins


def text_key(text: str) -> int:
    """What the function xxhash64 of Spark SQL gives for the text."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, text_key, content, bands, marks) of every document."""

    def prepare():
        memo = WordHashes()

        def work(ids, texts):
            out = {doc_id: ids, "n_shingles": [], "text_key": [], "content": [], "bands": [], "marks": []}
            words = [words_of(text) for text in texts]
            hashes, counts = shingle_hashes(words, memo)
            bins = sketches(hashes, counts)
            bands = np.zeros((len(words), BANDS), np.uint64)
            for k, odd in enumerate(BAND_ODD):
                bands += bins[:, k::DEEP] * odd
            bands = mixed(bands + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            marks = (bins & np.uint64(0xFF)).astype(np.uint8)
            at = np.cumsum(counts)
            for i, (count, last) in enumerate(zip(counts.tolist(), at.tolist())):
                out["n_shingles"].append(len(np.unique(hashes[last - count : last])))
                out["text_key"].append(text_key(texts[i]))
                out["content"].append(hashlib.blake2b(b" ".join(words[i]), digest_size=16).digest())
                out["bands"].append(bands[i])
                out["marks"].append(marks[i].tobytes())
            return out

        return work

    schema = f"{doc_id} bigint, n_shingles bigint, text_key bigint, content binary, bands array<bigint>, marks binary"
    return per_text(docs, schema, prepare, doc_id, text)


def shingle_set(text: str) -> set[bytes]:
    words = words_of(text)
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def similar(a: set[bytes], b: set[bytes]) -> bool:
    common = len(a & b)
    return common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common)


def likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree well enough to fetch the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                one, other = (
                    np.frombuffer(b"".join(batch[c]), np.uint8).reshape(-1, BINS) for c in ("marks_a", "marks_b")
                )
                yield batch.loc[(one == other).mean(axis=1) >= LEAST_ESTIMATE, ["a", "b"]]

    for side in ("a", "b"):
        pairs = pairs.join(marks.select(F.col("node").alias(side), F.col("marks").alias(f"marks_{side}")), side)
    return pairs.select("a", "b", "marks_a", "marks_b").mapInPandas(run, "a bigint, b bigint")


def verified(pairs: DataFrame, sketch: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """The pairs (a, b) whose full sets of shingles are similar enough.

    Only texts that occur in a pair are read again; pairs of one text lie together, so that its set is built once a task.
    """
    pairs = written(pairs.distinct(), f"{label}-pairs")
    held = texts_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")), sketch, docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: OrderedDict[int, set[bytes]] = OrderedDict()
        for batch in batches:
            good = []
            for a, b, text_a, text_b in batch.itertuples(index=False):
                if a not in sets:
                    sets[a] = shingle_set(text_a)
                    if len(sets) > 8:
                        sets.popitem(last=False)
                good.append(similar(sets[a], shingle_set(text_b)))
            yield batch.loc[good, ["a", "b"]]

    for side in ("b", "a"):
        pairs = pairs.join(held.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}")), side)
    found = pairs.select("a", "b", "text_a", "text_b").mapInPandas(run, "a bigint, b bigint")
    return written(found, f"{label}-links")


def texts_of(nodes: DataFrame, sketch: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the classes listed; a list of checked size is sent to the texts, a longer one joined."""
    wanted = nodes.distinct().join(sketch, "node").select("node", F.col("doc_id").alias("_id"), "text_key")
    wanted = F.broadcast(wanted) if is_small(wanted) else wanted
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("text_key"))
    return docs.join(wanted, same).select("node", "text").dropDuplicates(["node"])


def candidates(unit: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a unit its later partners: another component, this band first, a likely sketch."""
    ids, block = unit["node"].to_numpy(), unit["block"].to_numpy()
    component = unit["component"].to_numpy()
    marks = np.frombuffer(b"".join(unit["marks"]), np.uint8).reshape(-1, BINS)
    bands = np.stack(unit["bands"].to_numpy())
    at = np.flatnonzero(bands[0] == unit["band"].iloc[0])[0]
    crosses = bool(unit["crosses"].iloc[0])
    for i in range(len(ids)):
        rest = np.flatnonzero((component != component[i]) & (ids > ids[i]))
        if crosses:
            rest = rest[block[rest] != block[i]]
        rest = rest[~(bands[rest, :at] == bands[i, :at]).any(axis=1)]
        rest = rest[(marks[rest] == marks[i]).mean(axis=1) >= LEAST_ESTIMATE]
        if len(rest):
            yield i, rest


def across(members: DataFrame, sketch: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """Links (a, b) between the components that meet in a bucket, enough to join all that are linked.

    ``members`` are (band, node, component, size of the bucket). Buckets of more than
    ``BUCKET_BLOCK`` texts are cut into blocks, and each pair of blocks is a unit of work, so
    that no task holds more than two blocks. Sketches first say which rows have a partner at all; only
    these take their texts to the unit, where partners are compared. Pairs are not written out: a unit yields
    the links of a spanning forest.
    """
    columns = ["unit", "band", "block", "crosses", "node", "component", "bands", "marks"]
    units = cut(members, "band", "node", "size", BUCKET_BLOCK).join(sketch.select("node", "bands", "marks"), "node").select(*columns)

    def likely_rows(unit: pd.DataFrame) -> pd.DataFrame:
        keep = np.zeros(len(unit), bool)
        for i, rest in candidates(unit):
            keep[i] = keep[rest] = True
        return unit.loc[keep, columns]

    found = written(
        per_unit(
            units, likely_rows,
            "unit bigint, band bigint, block int, crosses boolean, node bigint, component bigint, "
            "bands array<bigint>, marks binary",
        ),
        f"{label}-likely",
    )

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        ids, memo = unit["node"].to_numpy(), WordHashes()
        sets = [np.unique(shingle_hashes([words_of(text)], memo)[0]) for text in unit["text"]]
        root: dict[int, int] = {c: c for c in unit["component"].tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                c = root[c]
            return c

        links = []
        component = unit["component"].tolist()
        for i, rest in candidates(unit):
            for j in rest.tolist():
                a, b = find(component[i]), find(component[j])
                small, large = sorted((len(sets[i]), len(sets[j])))
                if a == b or 100 * small < PERCENT * large:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= PERCENT * (small + large - common) and similar(
                    shingle_set(unit["text"].iloc[i]), shingle_set(unit["text"].iloc[j])
                ):
                    links.append((ids[i], ids[j]))
                    root[max(a, b)] = min(a, b)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    with_texts = found.join(texts_of(found.select("node"), sketch, docs), "node").select(*columns, "text")
    return written(per_unit(with_texts, compare, "a bigint, b bigint"), f"{label}-links")


def shared_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of an id that stands for several texts."""
    repeated = rows.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    held = rows.join(repeated, "doc_id", "left_semi").select("doc_id", "content").distinct()
    held = held.join(classes.select("content", "node"), "content").select("doc_id", "node")
    hubs = held.groupBy("doc_id").agg(F.min("node").alias("a"))
    return held.join(hubs, "doc_id").filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = written(sketched(docs), "near-sketches")
    worded = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = written(
        worded.groupBy("content").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    sketch = written(
        rows.join(classes, ["content", "doc_id"]).select("node", "doc_id", "text_key", "bands", "marks").dropDuplicates(["node"]),
        "near-distinct",
    )
    banded = sketch.select("node", F.explode("bands").alias("band"))
    sized = with_totals(
        banded, "band", "node", [F.min("node").alias("center"), F.count(F.lit(1)).alias("size")],
        [F.min("center").alias("center"), F.sum("size").alias("size")], "size > 1",
    )
    members = written(sized, "near-members")
    stars = members.filter("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = verified(likely(stars, sketch), sketch, docs, "near-stars").unionByName(
        written(shared_ids(worded, classes), "near-ids")
    )
    found = components(links, "near-stars")
    # Buckets of three and more that are not yet one component: pairs other than with the center.
    rest = (
        members.filter("size > 2 and node <> center")
        .join(found.withColumnRenamed("id", "node"), "node", "left")
        .select("band", "node", F.coalesce("component", "node").alias("component"), "size")
    )
    mixed_buckets = with_totals(
        rest, "band", "node", [F.min("component").alias("least"), F.max("component").alias("most")],
        [F.min("least").alias("least"), F.max("most").alias("most")], "least <> most",
    ).drop("least", "most")
    more = across(mixed_buckets, sketch, docs, "near-rest")
    if not more.isEmpty():
        found = components(links.union(more), "near-all")
    ids = found.join(classes.select(F.col("node").alias("id"), "doc_id"), "id")
    smallest = written(ids.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-smallest")
    linked = lookup_join(found, smallest, "component", "id", is_small(smallest), "inner")
    named = classes.join(linked.withColumnRenamed("id", "node"), "node", "left").select(
        "content", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    apart = rows.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return worded.join(named, "content").select("doc_id", "n_shingles", "component_id").unionByName(apart)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document of each group with the smallest id, once; rows without an id stay."""
    keep = groups(docs).filter("doc_id = component_id").select("doc_id").distinct()
    first = docs.filter("doc_id is not null").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.filter("doc_id is null"))
