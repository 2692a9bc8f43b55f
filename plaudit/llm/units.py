"""Bounded units of work for comparing the rows of a bucket with each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Tasks over which the rows of one bucket are dealt before its size is known.
SALTS = 32


def with_totals(rows: DataFrame, bucket: str, row: str, first: list[Column], total: list[Column], keep: str) -> DataFrame:
    """``rows`` with aggregates of their bucket, of buckets for which ``keep`` holds.

    ``first`` aggregates the rows of a cell (bucket, salt of ``row``), ``total`` the cells of a bucket. Totals
    go back to the bucket's cells and from there to the rows, so that no task holds more than a cell of a hot bucket,
    and a bucket of a few rows has no more cells than rows.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(row), F.lit(SALTS)))
    cells = salted.groupBy(bucket, "_salt").agg(*first)
    totals = cells.groupBy(bucket).agg(*total).filter(keep)
    places = cells.select(bucket, "_salt").join(totals, bucket)
    return salted.join(places, [bucket, "_salt"]).drop("_salt")


def cut(members: DataFrame, bucket: str, row: str, size: str, limit: int) -> DataFrame:
    """Adds (unit, block, crosses): every two rows of a bucket meet in one unit of at most two blocks.

    A bucket of at most ``limit`` rows is one unit. A larger one is cut into blocks by a hash of ``row``,
    and each pair of blocks (a block with itself too) is a unit; rows are copied once per block. Of a
    unit that ``crosses``, only the pairs from different blocks are its own.
    """
    blocks = F.ceil(F.col(size) / limit).cast("int")
    block = F.pmod(F.xxhash64(row), blocks).cast("int")
    dealt = members.withColumn("block", block).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    unit = F.xxhash64(bucket, F.least("block", "_other"), F.greatest("block", "_other"))
    return dealt.withColumn("unit", unit).withColumn("crosses", F.col("block") != F.col("_other")).drop("_other")


def whole_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches sorted by unit, cut so that no unit is in two of them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = int(np.searchsorted(batch["unit"].to_numpy(), batch["unit"].iloc[-1]))
        if held and held[0]["unit"].iloc[-1] != batch["unit"].iloc[-1]:
            yield pd.concat([*held, batch.iloc[:last]], ignore_index=True)
            held = []
        elif not held and last:
            yield batch.iloc[:last].reset_index(drop=True)
        held.append(batch.iloc[last:] if not held else batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def sorted_units(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("unit").sortWithinPartitions("unit", *order)


def per_units(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on many whole units at a time: for units of a few rows each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(work, whole_units(batches))

    return sorted_units(df).mapInPandas(run, schema)


def per_unit(
    df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, *order: str,
    gather: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] = iter,
) -> DataFrame:
    """``work`` on the rows of one unit at a time; ``gather`` may combine the results of a task's units."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for units in whole_units(batches):
            starts = np.flatnonzero(np.append(True, np.diff(units["unit"].to_numpy()) != 0))
            for start, end in zip(starts, [*starts[1:], len(units)]):
                yield work(units.iloc[start:end].reset_index(drop=True))

    return sorted_units(df, *order).mapInPandas(lambda batches: gather(run(batches)), schema)


def pairs_of_units(units: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (places) of the same unit that are the unit's own, in steps of equal distance."""
    unit, block = units["unit"].to_numpy(), units["block"].to_numpy()
    crosses = units["crosses"].to_numpy()
    left, step = np.arange(len(units)), 1
    while len(left):
        left = left[left + step < len(units)]
        left = left[unit[left] == unit[left + step]]
        right = left + step
        own = ~crosses[left] | (block[left] != block[right])
        if len(left):
            yield left[own], right[own]
        step += 1
