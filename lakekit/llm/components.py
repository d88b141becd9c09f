"""Connected components of a link table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.common import few, release, staged


def connected(links: DataFrame, rows: int | None = None) -> DataFrame:
    """id, component (the smallest id reachable) for every id in ``links`` (columns a, b: long).

    Each round takes the smallest label among neighbours and then the label's label, so
    labels travel twice as far each time.  A node with very many links is a hot join key on
    one side only, which Spark splits; sums of a node's links are pre-aggregated.  Every
    round is written to the shared folder, and the one before deleted.  ``rows``: how many
    links there are at most, roughly, if that is known.
    """
    both = links.where(F.col("a") != F.col("b")).select("a", "b")
    both = both.union(both.select(F.col("b"), F.col("a"))).distinct()
    both = staged(both if rows is None else few(both, 2 * rows), "links")
    size = both.count()
    labels = staged(few(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select("id", F.least("id", "low").alias("component")), size), "labels")
    while True:
        far = labels.select(F.col("id").alias("b"), F.col("component").alias("theirs"))
        nearest = both.join(far, "b").groupBy(F.col("a").alias("id")).agg(F.min("theirs").alias("theirs"))
        lower = labels.join(nearest, "id").select("id", F.col("component").alias("was"), F.least("component", "theirs").alias("now"))
        jump = labels.select(F.col("id").alias("now"), F.col("component").alias("then"))
        moved = staged(few(lower.join(jump, "now", "left").select("id", "was", F.least("now", F.coalesce("then", "now")).alias("component")), size), "labels")
        release(labels)
        labels = moved
        if moved.where("was <> component").isEmpty():
            release(both)
            return moved.select("id", "component")
