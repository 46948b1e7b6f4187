"""Connected components of a link table, by joins and grouped minima; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import shared_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back, which ends its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of a link (a, b): the smallest v that links reach, v itself included.

    Each round takes the smallest label among neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of the longest chain.
    """
    both = stored(links.select(F.col("a").alias("v"), F.col("b").alias("w"))
                  .union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy("v").agg(F.least("v", F.min("w")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("label").alias("near"))
        best = labels.join(near, "v").select("v", F.least("label", "near").alias("best"), "label")
        target = labels.select(F.col("v").alias("best"), F.col("label").alias("further"))
        found = stored(best.join(target, "best").select(
            "v", F.least("best", "further").alias("label"), F.col("label").alias("was")), "labels")
        labels = found.select("v", "label")
        if not found.filter("label < was").limit(1).count():
            return labels
