"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation is learned that balances the bits of unit vectors: from a random start, codes
are the signs of the rotated vectors and the rotation is the best one (by singular values) from
vectors to codes, in turns. Several rotations give several codes. Each code is cut into substrings, one
Hamming table for each; vectors that share a substring's bucket and are close over all
bits are candidates, reranked with the original vectors. The length of a substring grows with
the logarithm of the table, so that buckets stay small. The number of tables and the radius are measured
on pairs planted at the limit around the sample, after the mean is subtracted: of the half with the widest
angles at least 0.995 share a bucket. The closer vectors lie to a common direction, the more tables that takes.

Copies (equal label and vector) form a class of which one stands for all, with its number.
Buckets are compared in units of bounded size, and a pair of several buckets counts in its first
table only, so that pairs are never written out: a unit yields the number of links of its
vectors and the edges of a spanning forest.

Defined results: null labels, null or zero vectors, vectors with null or non-finite components and
vectors link with those of their own length only; repeated rows count once; rows without an id get no component.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from plaudit.llm.common import written
from plaudit.llm.components import components
from plaudit.llm.units import cut, pairs_of_units, per_units
from plaudit.llm.vectors import as_matrix, lengths, sample, unit_rows, usable

LIMIT = 0.93
SAMPLE_ROWS = 8_000
MISSED = 0.005
#: Pairs planted at the limit in each direction, at least, and the share of them that the layout must serve.
PAIRS = 4_000
HARDEST = 0.5
#: What an entry of a table costs, in comparisons of two codes.
ENTRY_COST = 12
#: Candidates are within so many standard deviations above the bits that differ at the limit, of so many bits at most.
DEVIATIONS = 5
CODE_BITS = 512
BUCKET_BLOCK = 1024


def rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """The rotation that brings centred vectors closest to their own signs."""
    start = np.random.default_rng(seed).normal(size=(x.shape[1], x.shape[1]))
    turn = np.linalg.qr(start)[0]
    for _ in range(rounds):
        codes = np.where(x @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(x.T @ codes)
        turn = u @ v
    return turn


def at_limit(x: np.ndarray, limit: float, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at the limit, one half turned in a random direction, the other towards another row.

    Every row has as many; there are at least ``PAIRS`` of each half.
    """
    rng = np.random.default_rng(seed)
    first = np.tile(x, (-(-PAIRS // len(x)), 1))
    towards = np.concatenate([rng.normal(size=first.shape), first[rng.permutation(len(first))]])
    first = np.concatenate([first, first])
    towards = towards - (towards * first).sum(axis=1, keepdims=True) * first
    length = np.sqrt((towards * towards).sum(axis=1, keepdims=True))
    towards = np.where(length > 1e-9, towards / np.maximum(length, 1e-9), 0.0)  # a copy stays in its place
    return first, unit_rows(limit * first + math.sqrt(1 - limit * limit) * towards)


class Quantiser:
    """Mean, rotations and the layout of the tables.

    The layout is measured on pairs at the limit, planted around the rows of the sample: the closer the
    vectors lie to the mean, the wider is the angle of a pair once the mean is subtracted. Of the pairs of each half the
    ``HARDEST`` share, with the widest angles, must meet in a table but for ``MISSED`` of them. The length of
    substrings is the cheapest one for those pairs; length 0 compares all vectors with each other.
    """

    def __init__(self, x: np.ndarray, total: int, limit: float = LIMIT):
        self.mean, self.turns = x.mean(axis=0), []
        first, second = (side - self.mean for side in at_limit(x, limit))
        norms = np.sqrt((first * first).sum(axis=1) * (second * second).sum(axis=1))
        cosine = (first * second).sum(axis=1) / np.maximum(norms, 1e-12)
        half = len(first) // 2
        hard = np.concatenate([
            start + np.argsort(cosine[start : start + half], kind="stable")[: math.ceil(half * HARDEST)] for start in (0, half)
        ])
        first, second = first[hard], second[hard]
        same = 1 - np.arccos(np.clip(cosine[hard], -1, 1)) / math.pi  # a bit agrees
        same = float(np.quantile(same, 0.05))

        def wanted(bits: int) -> float:
            """The number of tables in which such a pair meets."""
            met = same**bits
            return 1 if met > 1 - MISSED else math.log(MISSED) / math.log1p(-met) if met > 1e-12 else math.inf

        self.bits = min(
            range(min(x.shape[1], 62) + 1), key=lambda bits: wanted(bits) * (ENTRY_COST + total / 2**bits)
        )
        centred = x - self.mean
        self.tables = self.fitted(centred, first, second, wanted(self.bits)) if self.bits else 1
        while not self.tables:
            self.bits -= 1
            self.tables = self.fitted(centred, first, second, wanted(self.bits)) if self.bits else 1
        if not self.turns:
            self.turns.append(rotation(centred, 0))
        self.used = x.shape[1] // self.bits * self.bits if self.bits else x.shape[1]
        self.turns = self.turns[: -(-max(self.tables * self.bits, 1) // self.used)]
        self.code_bits = min(self.tables * self.bits or self.used, CODE_BITS)
        apart = np.split(self._bits(first) ^ self._bits(second), 2)
        apart = [part[:, : self.code_bits].sum(axis=1) for part in apart]
        self.radius = max(max(math.ceil(n.mean() + DEVIATIONS * n.std()), int(n.max())) for n in apart)

    def fitted(self, centred: np.ndarray, first: np.ndarray, second: np.ndarray, wanted: float) -> int:
        """How many tables let enough of the pairs meet, at least ``wanted``; 0 if four times as many do not."""
        per_code, open_, most = centred.shape[1] // self.bits, np.ones(len(first), bool), math.ceil(4 * wanted) + 8
        for table in range(most):
            turn, place = divmod(table, per_code)
            if turn == len(self.turns):
                self.turns.append(rotation(centred, turn))
            columns = self.turns[turn][:, place * self.bits : (place + 1) * self.bits]
            open_[open_] = ((first[open_] @ columns >= 0) != (second[open_] @ columns >= 0)).any(axis=1)
            if table + 1 >= wanted and all(part.mean() <= MISSED for part in np.split(open_, 2)):
                return table + 1
        return 0

    def _bits(self, centred: np.ndarray) -> np.ndarray:
        bits = np.concatenate([centred @ turn[:, : self.used] >= 0 for turn in self.turns], axis=1)
        return bits[:, : self.tables * self.bits or self.used]

    def signs(self, x: np.ndarray) -> np.ndarray:
        """Bits of all codes, cut to those that the tables use."""
        return self._bits(x - self.mean)

    def keys(self, bits: np.ndarray) -> np.ndarray:
        """The substring of each table as a number."""
        weights = np.int64(1) << np.arange(self.bits, dtype=np.int64)
        return bits[:, : self.tables * self.bits].reshape(len(bits), self.tables, self.bits) @ weights


def linked(rows: DataFrame, limit: float = LIMIT) -> tuple[DataFrame, DataFrame] | None:
    """Distinct vectors (id, label, embedding, copies) -> ((id, links), spanning edges (a, b))."""
    total = rows.count()
    drawn = sample(rows, "id", "embedding", total, SAMPLE_ROWS)
    if len(drawn) < 2:
        return None
    model = rows.sparkSession.sparkContext.broadcast(Quantiser(drawn, total, limit))

    def code(batches):
        quantiser = model.value
        for batch in batches:
            if len(batch):
                bits = quantiser.signs(unit_rows(as_matrix(batch["embedding"])))
                packed = np.packbits(bits[:, : quantiser.code_bits], axis=1)
                yield pd.DataFrame({
                    "id": batch["id"], "label": batch["label"], "code": [p.tobytes() for p in packed],
                    "keys": list(quantiser.keys(bits)),
                })

    coded = written(
        rows.select("id", "label", "embedding").mapInPandas(
            code, f"id bigint, label {dict(rows.dtypes)['label']}, code binary, keys array<bigint>"
        ),
        "itq-codes",
    )
    entries = coded.select("id", "label", "code", F.posexplode("keys").alias("place", "key")).select(
        "id", "code", "place", F.xxhash64("label", "place", "key").alias("bucket")
    )
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    units = cut(entries.join(sizes, "bucket"), "bucket", "id", "size", BUCKET_BLOCK)

    def near(units: pd.DataFrame) -> pd.DataFrame:
        """Rows that have a row of their unit within the radius."""
        codes = np.frombuffer(b"".join(units["code"]), np.uint8).reshape(len(units), -1)
        keep = np.zeros(len(units), bool)
        for a, b in pairs_of_units(units):
            close = np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1) <= model.value.radius
            keep[a[close]] = keep[b[close]] = True
        return units.loc[keep, ["unit", "place", "block", "crosses", "id"]]

    found = per_units(
        units.select("unit", "place", "block", "crosses", "id", "code"), near,
        "unit bigint, place int, block int, crosses boolean, id bigint",
    )
    # Only the rows with a near one in a bucket take their vectors there.
    vectors = rows.select("id", "embedding", "copies").join(coded.select("id", "keys"), "id")
    ranked = written(found, "itq-near").join(vectors, "id")

    def rerank(units: pd.DataFrame) -> pd.DataFrame:
        """Links of each row within its unit, and a row that it hangs together with."""
        ids, copies, place = (units[name].to_numpy() for name in ("id", "copies", "place"))
        x, keys = unit_rows(as_matrix(units["embedding"])), np.stack(units["keys"].to_numpy())
        earlier = np.arange(keys.shape[1]) < place[:, None]
        links, root = np.zeros(len(ids), np.int64), list(range(len(ids)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for a, b in pairs_of_units(units):
            close = (x[a] * x[b]).sum(axis=1) >= limit
            a, b = a[close], b[close]
            # A pair counts in the first table that it shares.
            first = ~((keys[a] == keys[b]) & earlier[a]).any(axis=1)
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for i, j in zip(a.tolist(), b.tolist()):
                i, j = find(i), find(j)
                root[max(i, j)] = min(i, j)
        out = pd.DataFrame({"id": ids, "links": links, "root": ids[[find(i) for i in range(len(ids))]]})
        return out[(links > 0) | (out["id"] != out["root"])]

    pairs = written(
        per_units(
            ranked.select("unit", "place", "block", "crosses", "id", "embedding", "copies", "keys"), rerank,
            "id bigint, links bigint, root bigint",
        ),
        "itq-links",
    )
    return pairs.groupBy("id").agg(F.sum("links").alias("links")), pairs.filter("id <> root").select(
        F.col("id").alias("a"), F.col("root").alias("b")
    )


def near_embeddings(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", limit: float = LIMIT
) -> DataFrame:
    """(vec_id, n_links, component_id) of every row."""
    every = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("embedding"))
    rows = usable(every.filter(F.col("label").isNotNull() & F.col("vec_id").isNotNull())).distinct()
    classes = written(
        rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")),
        "itq-classes",
    )
    results = [linked(classes.filter(F.size("embedding") == n), limit) for n in lengths(classes)]
    results = [result for result in results if result is not None]
    if not results:
        links = classes.select("id", F.lit(0).cast("bigint").alias("links")).limit(0)
        found = classes.select("id", F.col("id").alias("component")).limit(0)
    else:
        links, edges = (reduce(DataFrame.union, side) for side in zip(*results))
        found = components(edges, "itq")
    named = (
        classes.join(links, "id", "left").join(found, "id", "left").select(
            "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    return every.join(named, ["label", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
