"""Nearest neighbours from a forest of random-projection trees.

Trees are fitted on a bounded sample: a node projects on the difference of two random members and splits
at the median; they are as deep as leaves of some 256 rows need, as far as the sample reaches. All rows are then sent to their leaf in every tree. A query walks all trees
with one priority queue: the node with the largest margin comes next, whichever tree it
is in, until the leaves taken hold a share of the index (a row counts in every tree) and besides that
a number of rows for every tree. As no tree holds a row twice, the leaves then hold more different rows than neighbours are asked
for, or all; tables of up to about 76 rows are searched whole. Leaf and queries meet in
units of bounded size, where cosines are computed exactly from the original vectors.

The share that a recall needs depends on the data and is measured: for rows of the sample, with their exact neighbours
there, the rows that the queue takes before it meets each neighbour. Of one, two, four and so on trees, those with
the smallest share serve. As one tree taken whole is a scan of all rows, no search compares more rows than a scan; on vectors
without any structure it ends near one. In a larger table neighbours are nearer than in its sample, so the share is ample there.

Defined results: vectors that are null, zero or hold null or non-finite components take
no part; vectors are compared with those of their own length, each length with an index of its own; equal scores go to the smaller id; repeated rows count once; with fewer
candidates than asked for, all are returned; rows without an id take no part.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from plaudit.llm.common import written
from plaudit.llm.units import per_unit
from plaudit.llm.vectors import as_matrix, lengths, sample, unit_rows, usable

TREES = 8
#: Rows of a leaf, about, where the sample holds at least 4 of them.
LEAF_ROWS, LEAF_SAMPLE = 256, 4
#: The recall asked for on the sample, and how many of its rows are searched for it.
RECALL, MEASURED = 0.95, 400
#: Rows that a search takes from every tree besides, the query and ``k`` rows at least.
ROWS_PER_TREE = 64
SAMPLE_ROWS = 20_000
ROWS_BLOCK, QUERIES_BLOCK = 4096, 1024
#: Neighbours that a task holds to combine those of its units.
HELD_ROWS = 200_000
#: Vectors whose projections on all nodes are held at a time.
PROJECTED = 256


class Forest:
    """Complete binary trees, as arrays: the children of node i are 2i + 1 and 2i + 2."""

    def __init__(self, x: np.ndarray, trees: int, depth: int):
        self.depth, self.inner = depth, 2**depth - 1
        rng = np.random.default_rng(5)
        self.normals = np.zeros((trees, self.inner, x.shape[1]))
        self.splits = np.zeros((trees, self.inner))
        for tree in range(trees):
            members: list = [np.arange(len(x))] + [None] * (2 * self.inner)
            for node in range(self.inner):
                here = members[node]
                normal = x[rng.choice(here)] - x[rng.choice(here)] if len(here) > 1 else np.zeros(x.shape[1])
                if not normal.any():
                    normal = rng.normal(size=x.shape[1])
                normal /= np.sqrt((normal * normal).sum())
                at = x[here] @ normal
                split = float(np.median(at)) if len(here) else 0.0
                self.normals[tree, node], self.splits[tree, node] = normal, split
                members[2 * node + 1], members[2 * node + 2] = here[at < split], here[at >= split]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree."""
        node = np.zeros((len(x), len(self.normals)), np.int64)
        for at in range(0, len(x), PROJECTED):
            part = node[at : at + PROJECTED]
            margins = self.margins(x[at : at + PROJECTED])
            for _ in range(self.depth):
                part[:] = 2 * part + 1 + (np.take_along_axis(margins, part[:, :, None], 2)[:, :, 0] >= 0)
        return node - self.inner + np.arange(len(self.normals)) * (self.inner + 1)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(vector, tree, node): how far each vector lies from each split."""
        flat = self.normals.reshape(-1, x.shape[1])
        return (x @ flat.T).reshape(len(x), *self.splits.shape) - self.splits

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """(vector, tree, leaf): the largest margin on the way to each leaf, by which the queue takes them."""
        margins = self.margins(x)
        bound = np.full((*margins.shape[:2], 1), -np.inf)
        for level in range(self.depth):
            here = margins[:, :, 2**level - 1 : 2 ** (level + 1) - 1]
            bound = np.stack([np.maximum(bound, here), np.maximum(bound, -here)], 3).reshape(*margins.shape[:2], -1)
        return bound

    def first(self, trees: int) -> Forest:
        """The same without all but the first trees."""
        fewer = copy.copy(self)
        fewer.normals, fewer.splits = self.normals[:trees], self.splits[:trees]
        return fewer

    def visits(self, x: np.ndarray, sizes: dict[int, int], wanted: float) -> list[list[int]]:
        """For every query the leaves to search, over all trees, until they hold ``wanted`` rows."""
        out = []
        for margin in (m for at in range(0, len(x), PROJECTED) for m in self.margins(x[at : at + PROJECTED])):
            queue = [(-math.inf, tree, 0) for tree in range(len(self.normals))]
            taken, held = [], 0
            while queue and held < wanted:
                bound, tree, node = heapq.heappop(queue)
                if node >= self.inner:
                    leaf = tree * (self.inner + 1) + node - self.inner
                    if leaf in sizes:
                        taken.append(leaf)
                        held += sizes[leaf]
                    continue
                m = margin[tree, node]
                heapq.heappush(queue, (max(bound, m), tree, 2 * node + 1))
                heapq.heappush(queue, (max(bound, -m), tree, 2 * node + 2))
            out.append(taken)
        return out


def cheapest(x: np.ndarray, trees: int, depth: int, k: int, recall: float = RECALL) -> tuple[Forest, float]:
    """Of 1, 2, 4, .. ``trees`` trees on the rows of ``x`` those that meet ``recall`` of the ``k`` nearest with the
    smallest share of rows, and that share."""
    forest, k = Forest(x, trees, depth), min(k, len(x) - 1)
    if k < 1:
        return forest.first(1), 1.0
    queries = np.random.default_rng(6).permutation(len(x))[:MEASURED]
    own = forest.leaves(x) - np.arange(trees) * (forest.inner + 1)
    sizes = np.stack([np.bincount(own[:, tree], minlength=forest.inner + 1) for tree in range(trees)])
    counts = [2**i for i in range(trees.bit_length())]
    taken: dict[int, list] = {n: [] for n in counts}
    for at in range(0, len(queries), PROJECTED):
        part = queries[at : at + PROJECTED]
        score = x[part] @ x.T
        score[np.arange(len(part)), part] = -np.inf
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        for bound, rows in zip(forest.bounds(x[part]), near):
            met = np.take_along_axis(bound, own[rows].T, 1)  # (tree, neighbour)
            for n in counts:
                order = np.argsort(bound[:n], axis=None)
                place = np.searchsorted(bound[:n].reshape(-1)[order], met[:n].min(axis=0), side="right") - 1
                taken[n].append(np.cumsum(sizes[:n].reshape(-1)[order])[place])
    shares = {n: float(np.quantile(np.concatenate(rows), recall)) / len(x) for n, rows in taken.items()}
    best = min(counts, key=lambda n: (shares[n], n))
    return forest.first(best), shares[best]


def nearest(
    df: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding", trees: int = TREES,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row that ``is_query``.

    Vectors of each length have a forest of their own, of at most ``trees`` trees.
    """
    rows = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = usable(rows.filter(F.col("vec_id").isNotNull())).distinct()
    found = [_nearest(rows.filter(F.size("embedding") == n), is_query, k, trees, recall) for n in lengths(rows)]
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    return reduce(DataFrame.union, found) if found else df.sparkSession.createDataFrame([], empty)


def best_of(found: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The ``k`` best of every query over many units, of about ``HELD_ROWS`` neighbours at a time."""

    def best(frames: list[pd.DataFrame]) -> pd.DataFrame:
        every = pd.concat(frames).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return every.drop_duplicates(["query_id", "vec_id"]).groupby("query_id").head(k)

    held, n = [], 0
    for frame in found:
        if len(frame):
            held.append(frame)
            n += len(frame)
        if n > HELD_ROWS:
            held = [best(held)]
            n = len(held[0])
            if n > HELD_ROWS // 2:
                yield held[0]
                held, n = [], 0
    if held:
        yield best(held)


def _nearest(rows: DataFrame, is_query, k: int, trees: int, recall: float) -> DataFrame:
    """The same for vectors of one length."""
    context, total = rows.sparkSession.sparkContext, rows.count()
    drawn = sample(rows, "vec_id", "embedding", total, SAMPLE_ROWS)
    if not len(drawn):  # few rows, and none drawn: any of them shapes the trees
        drawn = unit_rows(as_matrix([rows.select("embedding").first()[0]]))
    kind = dict(rows.dtypes)["embedding"]
    depth = math.log2(min(total / LEAF_ROWS, len(drawn) / LEAF_SAMPLE))
    fitted, share = cheapest(drawn, trees, max(1, round(depth)), k, recall)
    trees, forest = len(fitted.normals), context.broadcast(fitted)

    def index(batches):
        for batch in batches:
            if len(batch):
                leaves = forest.value.leaves(unit_rows(as_matrix(batch["embedding"])))
                yield batch.assign(leaves=list(leaves))

    indexed = written(
        rows.mapInPandas(index, f"vec_id bigint, embedding {kind}, leaves array<bigint>")
        .select("vec_id", "embedding", F.explode("leaves").alias("leaf")),
        "forest-index",
    )
    # One number per leaf of the forest: trees times a quarter of the sample at most.
    sizes = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}

    wanted = share * total + trees * max(ROWS_PER_TREE, k + 1)

    def search(batches):
        for batch in batches:
            if len(batch):
                found = forest.value.visits(unit_rows(as_matrix(batch["embedding"])), sizes, wanted)
                yield batch.assign(leaves=found)

    visits = written(
        rows.filter(is_query(F.col("vec_id"))).mapInPandas(
            search, f"vec_id bigint, embedding {kind}, leaves array<bigint>"
        ).select("vec_id", "embedding", F.explode("leaves").alias("leaf")),
        "forest-visits",
    )
    parts = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES_BLOCK).cast("int").alias("query_parts"))
    parts = parts.join(
        indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / ROWS_BLOCK).cast("int").alias("row_parts")), "leaf"
    )
    parts = F.broadcast(parts)  # as many rows as leaves

    def spread(side: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        """Each row into one of the blocks of its side, copied for every block of the other side."""
        dealt = side.join(parts, "leaf").withColumn("_own", F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int"))
        dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        places = ("_other", "_own") if query else ("_own", "_other")
        return dealt.select(F.xxhash64("leaf", *places).alias("unit"), F.lit(query).alias("query"), "vec_id", "embedding")

    both = spread(indexed, "row_parts", "query_parts", False).union(spread(visits, "query_parts", "row_parts", True))

    def compare(unit: pd.DataFrame) -> pd.DataFrame:
        query = unit["query"].to_numpy()
        x, ids = as_matrix(unit["embedding"]), unit["vec_id"].to_numpy()
        norms = np.sqrt((x * x).sum(axis=1))
        rows, row_ids, row_norms = x[~query], ids[~query], norms[~query]
        out = []
        if len(rows):
            close = (x[query] @ rows.T) / norms[query][:, None] / row_norms
            for q, own, norm, near in zip(x[query], ids[query], norms[query], close):
                near[row_ids == own] = -np.inf
                at = np.flatnonzero(near > -np.inf)
                if len(at) > k:  # all that may be among the k nearest, whatever the order of summing
                    at = at[near[at] >= np.partition(near[at], len(at) - k)[len(at) - k] - 1e-9]
                exact = (rows[at] * q).sum(axis=1) / (norm * row_norms[at])
                best = np.lexsort((row_ids[at], -exact))[:k]
                out += zip([own] * len(best), row_ids[at][best].tolist(), exact[best].tolist())
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    schema = "query_id bigint, vec_id bigint, score double"
    found = per_unit(both, compare, schema, gather=lambda units: best_of(units, k))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
