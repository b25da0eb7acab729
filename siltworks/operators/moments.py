"""Summaries that are added up batch by batch instead of being computed anew.

A partial summary holds, per key, count, sum, sum of squared deviations from its own average, least and
greatest value. Partial summaries of disjoint rows merge into that of all rows: to the squared
deviations come those of each part's average from the common one, so that nothing is lost to
cancellation as with sums of squares. Each batch keeps its partial summary under its own number, so
that a batch which is repeated replaces itself.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import steady_round
from ..sinks.tables import replace_partitions, replace_table

PARTS = ["n", "total", "deviations", "least", "greatest"]
BATCH = "batch"


def partial_moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys`` and ``PARTS`` of the values that are not NULL; a key without any has a count of 0."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(x).alias("n"), F.sum(x).alias("total"), (F.var_pop(x) * F.count(x)).alias("deviations"),
                                 F.min(x).alias("least"), F.max(x).alias("greatest"))


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from any number of partial summaries; one shuffle, in any order of the parts."""
    everything = Window.partitionBy(*keys)
    centre = F.sum("total").over(everything) / F.nullif(F.sum("n").over(everything), F.lit(0))
    apart = F.col("total") / F.nullif("n", F.lit(0)) - F.col("_centre")
    spread = parts.withColumn("_centre", centre).withColumn("_spread", F.col("deviations") + F.col("n") * apart * apart)
    return spread.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("_spread").alias("deviations"),
                                     F.min("least").alias("least"), F.max("greatest").alias("greatest"))


def summary_of(moments: DataFrame, keys: Sequence[str], prefix: str = "daily", count_name: str = "reading_count",
               digits: int = 4) -> DataFrame:
    """The columns of :func:`siltworks.operators.summarize.spread_summary` from merged moments."""
    several = F.nullif(F.col("n") - 1, F.lit(0))
    stats = {"avg": F.col("total") / F.nullif("n", F.lit(0)), "max": F.col("greatest"), "min": F.col("least"),
             "stddev": F.when(F.col("n") > 1, F.sqrt(F.col("deviations") / several))}
    return moments.select(*keys, *[steady_round(column, digits).alias(f"{prefix}_{name}") for name, column in stats.items()],
                          F.col("n").alias(count_name))


class Moments:
    """A table of partial summaries, a partition per batch."""

    def __init__(self, table: str, keys: Sequence[str], value: str):
        self.table, self.keys, self.value = table, list(keys), value

    def add(self, rows: DataFrame, batch: int) -> None:
        """Enter a batch of rows, or enter it again."""
        replace_partitions(partial_moments(rows, self.keys, self.value).withColumn(BATCH, F.lit(batch).cast("bigint")), self.table, [BATCH])

    def summary(self, spark, **names) -> DataFrame:
        """The summary of all batches; reads partial summaries only."""
        return summary_of(merge_moments(spark.table(self.table), self.keys), self.keys, **names)

    def compact(self, spark, upto: int) -> None:
        """Merge the batches up to ``upto``, which will not be repeated any more, into that one. The table
        is pointed to its new version in one step, so that no batch ever counts twice."""
        parts = spark.table(self.table)
        merged = merge_moments(parts.where(F.col(BATCH) <= upto), self.keys).withColumn(BATCH, F.lit(upto).cast("bigint"))
        replace_table(merged.unionByName(parts.where(F.col(BATCH) > upto)), self.table, [BATCH])
