"""Connected components of a graph in tables: smallest labels spread and jump, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plaudit.llm.common import written


def components(links: DataFrame, label: str) -> DataFrame:
    """Links (a, b) -> (id, component): for every linked id the smallest id that it reaches.

    Each round takes the smallest label of the neighbours and then that label's own label, so
    that long chains halve. Rounds are written to the shared folder, which keeps the lineage short.
    """
    both = written(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), f"{label}-links"
    )
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select(
            "id", F.least("id", "b").alias("component"), F.lit(True).alias("changed")
        ),
        f"{label}-labels",
    )
    while not labels.filter("changed").isEmpty():
        near = (
            both.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        )
        spread = labels.join(near, "id").select(
            "id", F.least("component", "near").alias("next"), F.col("component").alias("old")
        )
        roots = labels.select(F.col("id").alias("next"), F.col("component").alias("further"))
        labels = written(
            spread.join(roots, "next").select(
                "id", F.least("next", "further").alias("component"),
                (F.least("next", "further") < F.col("old")).alias("changed"),
            ),
            f"{label}-labels",
        )
    return labels.select("id", "component")
