"""Size checks that decide between physical strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SPREAD_BYTES_PER_CORE = 64 << 20
BROADCAST_MAX_ROWS = 200_000
#: Bytes of the scans below a plan that one part of it stands for, where parts are held in memory or sorted.
PART_BYTES = 8 << 20


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimised plan; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def scan_bytes(df: DataFrame) -> int:
    """The size of all scans below a plan, whatever is joined above them; runs no job. Rows of unknown size, as those of an RDD, count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < unknown)


def parts_of(df: DataFrame, part_bytes: int = PART_BYTES) -> int:
    return max(1, -(-scan_bytes(df) // part_bytes))


def dealt(df: DataFrame, *keys: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows dealt by key into parts whose number grows with the input, not their size: for what a task holds of its part."""
    return df.repartition(max(parts_of(df, part_bytes), df.sparkSession.sparkContext.defaultParallelism), *keys)


def leaves_cores_idle(df: DataFrame) -> bool:
    """Whether a scan has less than a full split for each core, and fewer files than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return plan_bytes(df) < cores * SPREAD_BYTES_PER_CORE and len(df.inputFiles()) < cores


def rounds(df: DataFrame, at_least: int = 4) -> int:
    """Into how many rounds to cut a table so that each gives every core about one split."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(at_least, -(-plan_bytes(df) // (cores * SPREAD_BYTES_PER_CORE)))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when the input is too small to split by itself.

    A Parquet file splits no finer than its row groups, so a few small files
    would keep one core busy and leave the others idle. Input that already holds a
    full split per core is returned as it is: on a large table nothing moves. Apply
    it to a scan; behind a join the size estimate says little.
    """
    if not leaves_cores_idle(df):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    salt_by: str,
    small: bool,
    how: str = "left",
    salts: int = 32,
) -> DataFrame:
    """Join ``rows`` with a lookup table on ``key``, safe for hot keys.

    A table found ``small`` (see :func:`is_small`) is broadcast, so the rows stay where
    they are. A larger one is copied once per salt and both sides shuffle on (key,
    salt): a key that holds a third of all rows is then shared by ``salts`` tasks.
    """
    if small:
        return rows.join(F.broadcast(table), key, how)
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
        .join(salted, [key, "_salt"], how)
        .drop("_salt")
    )
