"""What the operators share: tables, per-text scoring, held-out rows, written intermediate tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plaudit.session import work_dir

#: A word: a run of anything but ASCII white space (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of texts that are worked on together.
BLOCK_CHARS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    folder = work_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def per_text(
    df: DataFrame, schema: str, prepare: Callable[[], Callable[[list, list[str]], dict]], id_col: str = "doc_id",
    text_col: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document, computed from its whole text; null texts count as empty.

    ``prepare`` runs once per task and returns a function from (ids, texts) to the columns of ``schema``, in order.
    It gets a bounded block of texts at a time, so that results of a batch of long texts don't pile up.
    """

    types = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, end in blocks(texts, block_chars):
                out = work(batch.column(0).slice(start, end - start), texts[start:end])
                columns = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for f, v in zip(types, out.values())]
                yield pa.RecordBatch.from_arrays(columns, schema=types)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def uniform(*parts: Column, seed: str) -> Column:
    """A number in [0, 1) from a hash of the seed and the parts: the same in every run."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def blocks(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` characters together (a longer text stands alone)."""
    start = held = 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)
