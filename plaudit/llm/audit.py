"""Filter interaction audit: what every order of the filters removes at every step, and each filter's Shapley share.

A document's failures are a set of filters, so documents only count by (part, set of failed filters). The filters
already applied are a state of the subset lattice; applying one more is an edge. An edge removes the documents that
fail its filter and none of the state's. Orders are paths from the empty to the full state, so

- *forward* counts the orders that reach a state and *backward* those that leave it, each summed over the lattice's edges;
- a filter's Shapley sum is its edges' removals, each times forward (of its start) times backward (of its end);
- a step of an order reads its numbers from its edge.

Whatever the number of documents, a part is a row for each set of failures, 32 for five filters.

Identical texts are found by the SHA-256 of the text. Copies meet as counts: they are added up in each task before they
move, so a group of copies that holds a third of all rows reaches its task as a few rows.

Defined results: a null text is the empty text; a part that is null is the empty string; a row without an id
is no copy of another and makes none; repeated rows count each, none as a copy of its twin; labels of an id given
several times hold if one of them does; rows without labels are neither good nor toxic; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plaudit.llm.common import WORD, written
from plaudit.sources.readers import in_memory

#: More filters would give more orders than a plan should carry.
MOST_FILTERS = 6


def text_filters(text: Column) -> dict[str, Column]:
    """The filters by the text alone: whether it fails each."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


class Lattice:
    """The states and edges of a set of filters, and the number of orders through them."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names = tuple(names)
        if not 0 < len(self.names) <= MOST_FILTERS:
            raise ValueError(f"from 1 to {MOST_FILTERS} filters, not {len(self.names)}")
        self.full = (1 << len(self.names)) - 1
        #: Edges as (state, place of the filter that is applied next).
        self.edges = [(s, f) for s in range(self.full + 1) for f in range(len(self.names)) if not s >> f & 1]
        self.forward = [1] + [0] * self.full
        self.backward = [0] * self.full + [1]
        for state, f in self.edges:  # states come before those that hold them
            self.forward[state | 1 << f] += self.forward[state]
        for state, f in reversed(self.edges):
            self.backward[state] += self.backward[state | 1 << f]

    def orders_through(self, state: int, f: int) -> int:
        return self.forward[state] * self.backward[state | 1 << f]

    def edge_rows(self) -> list[tuple[int, int, int, bool, bool]]:
        """(mask, state, filter, taken, alone): the sets of failures that reach an edge's start, whether it removes them, and them only."""
        return [
            (mask, state, f, bool(mask >> f & 1), mask == 1 << f)
            for state, f in self.edges
            for mask in range(self.full + 1)
            if not mask & state
        ]

    def step_rows(self, orders: Iterable[Sequence[str]] | None = None) -> list[tuple[str, int, int, int]]:
        """(filter_order, step, state, filter) of the orders, by default of all."""
        rows = []
        for order in orders or permutations(self.names):
            state = 0
            for step, name in enumerate(order, 1):
                f = self.names.index(name)
                rows.append(("".join(order), step, state, f))
                state |= 1 << f
        return rows


def failure_counts(
    docs: DataFrame, labels: DataFrame, filters: Callable[[Column], dict[str, Column]] = text_filters, copies: bool = True,
    doc_id: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of filters that they fail, copies of smaller ids as the last if wanted."""
    failing = filters(F.col("_text")).values()
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(failing)]
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"),
        whole.alias("_text"),
    )
    rows = rows.select(
        "_id", "_part", F.unhex(F.sha2("_text", 256)).alias("_same"), sum(bits[1:], bits[0]).cast("int").alias("_mask")
    )
    # Rows without an id are spread by their text; those with one meet their labels.
    key = F.coalesce(F.col("_id").cast("string"), F.concat(F.lit("text "), F.hex("_same")))
    marks = (
        labels.filter(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).cast("string").alias("_key"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    )
    same = rows.withColumn("_key", key).groupBy("_key", "_id", "_same", "_part", "_mask").agg(F.count(F.lit(1)).alias("n"))
    marked = same.join(marks, "_key", "left").select(
        "_id", "_same", "_part", "_mask", "n",
        (F.col("n") * F.coalesce("_good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("_toxic", F.lit(0))).alias("toxic"),
    )
    sums = [F.sum(name).alias(name) for name in ("n", "good", "toxic")]
    if not copies:
        return marked.groupBy(F.col("_part").alias("part"), F.col("_mask").alias("mask")).agg(*sums)
    # The first id of each text and part with its counts; the smallest over the parts has no copy before it.
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "n", "good", "toxic"))).alias("first")
    nameless = [F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col(name))), F.lit(0)).alias(f"no_id_{name}") for name in ("n", "good", "toxic")]
    by_part = marked.groupBy("_same", "_part", "_mask").agg(*sums, first, *nameless)
    texts = by_part.groupBy("_same").agg(
        F.min("first._id").alias("_least"), F.collect_list(F.struct("_part", "_mask", "n", "good", "toxic", "first", "no_id_n", "no_id_good", "no_id_toxic")).alias("_parts")
    )  # one entry per part that holds the text
    entry = texts.select("_least", F.inline("_parts"))
    is_first = F.col("first._id") == F.col("_least")
    originals = [
        (F.col(f"no_id_{name}") + F.when(is_first, F.col(f"first.{name}")).otherwise(F.lit(0))).alias(f"o_{name}")
        for name in ("n", "good", "toxic")
    ]
    bit = 1 << len(bits)
    split = entry.select("_part", "_mask", "n", "good", "toxic", *originals).select(
        F.col("_part").alias("part"),
        F.inline(F.array(
            F.struct(F.col("_mask").alias("mask"), *[F.col(f"o_{name}").alias(name) for name in ("n", "good", "toxic")]),
            F.struct((F.col("_mask") + bit).alias("mask"), *[(F.col(name) - F.col(f"o_{name}")).alias(name) for name in ("n", "good", "toxic")]),
        )),
    )
    return split.groupBy("part", "mask").agg(*sums)


def steps(spark: SparkSession, counts: DataFrame, lattice: Lattice, orders: Iterable[Sequence[str]] | None = None) -> DataFrame:
    """One row per part, order and step from :func:`failure_counts`; tables of the lattice (405 and 600 rows for five filters) are broadcast."""
    names = lattice.names
    edges = in_memory(spark, lattice.edge_rows(), "mask int, state int, filter int, taken boolean, alone boolean")
    weights = in_memory(
        spark, [(s, f, lattice.orders_through(s, f)) for s, f in lattice.edges], "state int, filter int, orders bigint"
    )
    # All edges are there for each part, also where nothing reaches them.
    parts = counts.groupBy("part").agg(F.sum("n").alias("_n"))
    every = parts.select("part", F.inline(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter")) for s, f in lattice.edges])))
    taken = F.col("taken")

    def total(value: Column, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, value)), F.lit(0))

    met = counts.join(F.broadcast(edges), "mask").groupBy("part", "state", "filter").agg(
        total(F.col("n"), ~taken).alias("kept"), total(F.col("n"), taken).alias("removed"),
        total(F.col("good"), taken).alias("good_lost"), total(F.col("toxic"), taken).alias("toxic_lost"),
        total(F.col("n"), F.col("alone")).alias("unique_fails"),
    )
    numbers = ("kept", "removed", "good_lost", "toxic_lost", "unique_fails")
    edge = every.join(met, ["part", "state", "filter"], "left").select(
        "part", "state", "filter", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in numbers]
    )
    # Per filter: all that fail it are the removals of its first edge.
    by_filter = edge.join(F.broadcast(weights), ["state", "filter"]).groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.col("orders")).alias("shapley"),
        F.max(F.when(F.col("state") == 0, F.col("removed"))).alias("failing"),
    )
    order_steps = in_memory(spark, lattice.step_rows(orders), "filter_order string, step int, state int, filter int")
    return (
        edge.join(by_filter, ["part", "filter"])
        .join(F.broadcast(order_steps), ["state", "filter"])
        .select(
            "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
            "unique_fails", "good_lost", "toxic_lost", "shapley",
        )
    )


def audit(docs: DataFrame, labels: DataFrame, orders: Iterable[Sequence[str]] | None = None) -> DataFrame:
    """The five filters over documents: the four by text and E, a copy of a document with a smaller id."""
    counts = written(failure_counts(docs, labels), "audit")
    return steps(docs.sparkSession, counts, Lattice("ABCDE"), orders)
