"""Histograms as mergeable aggregates: partial counts are added up before the shuffle, which carries a row a bin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bin_index(x: Column, bins: int, low: float, high: float) -> Column:
    """0 below low, 1 to bins within, bins + 1 from high up; null for null and NaN.

    One built-in that names x once: pushed-down filters on the bin then repeat a costly x once and not in every branch.
    """
    return F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(bins))


def _binned(df: DataFrame, index: Column, *aggregates: Column, **columns: Column) -> DataFrame:
    """bin and aggregates of each filled bin.

    The bin comes back as an aggregate of its own, since a filter on the grouping key would be pushed below the
    aggregation and work the index out again there, with all that it is made of.
    """
    at = df.select(F.coalesce(index, F.lit(-1)).alias("key"), *(c.alias(n) for n, c in columns.items()))
    return at.groupBy("key").agg(F.max("key").alias("bin"), *aggregates).where("bin >= 0").drop("key")


def histogram(df: DataFrame, x: Column, bins: int, low: float, high: float, dense: bool = True) -> DataFrame:
    """bin, low_edge, high_edge, n: every bin with underflow (0) and overflow (bins + 1), or the filled ones only."""
    counts = _binned(df, bin_index(x.cast("double"), bins, low, high), F.count(F.lit(1)).alias("n"))
    if dense:
        every = df.sparkSession.range(0, bins + 2, numPartitions=1).select(F.col("id").alias("bin"))
        counts = every.join(F.broadcast(counts), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))  # bins + 2 rows
    width = (high - low) / bins
    low_edge = F.when(F.col("bin") > 0, low + width * (F.col("bin") - 1))
    high_edge = F.when(F.col("bin") <= bins, low + width * F.col("bin"))
    return counts.select("bin", low_edge.alias("low_edge"), high_edge.alias("high_edge"), "n")


def profile(df: DataFrame, x: Column, y: Column, bins: int, low: float, high: float) -> DataFrame:
    """bin, n, mean, spread (population standard deviation) of y in each filled bin of x."""
    figures = F.count("y").alias("n"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("spread")
    return _binned(df, bin_index(x.cast("double"), bins, low, high), *figures, y=y.cast("double"))


def merged(*histograms: DataFrame) -> DataFrame:
    """The sum of histograms over the same bins."""
    out = histograms[0]
    for h in histograms[1:]:
        out = out.unionByName(h)
    return out.groupBy("bin", "low_edge", "high_edge").agg(F.sum("n").alias("n"))
