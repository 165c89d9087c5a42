"""Joins that Spark has no operator for: as-of and range joins on equi-join plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], slot: Callable[[Column], Column] | None = None) -> DataFrame:
    """left with values of the last row of right, of the same key, at or before left_time; null where there is none.

    One union and one sorted window over the key, instead of a theta join: rows are linear in both inputs. Among
    right rows of one time the greatest by values stands; a null key has no match. slot, a function that never falls
    as time grows (an hour, a day), splits hot keys: windows are then a key's slot, and one row a slot carries what
    came before it.
    """
    kind = right.select(F.struct(*values)).schema[0].dataType
    own = left.select("*", F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_v"))
    other = right.where(F.col(key).isNotNull()).select(F.col(key), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.struct(*values).alias("_v"))
    both = own.unionByName(other, allowMissingColumns=True).withColumn("_slot", slot(F.col("_t")) if slot else F.lit(0))
    w = Window.partitionBy(key, "_slot").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_found", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    if slot:
        last = F.max(F.when(F.col("_side") == 0, F.struct("_t", "_v")))
        earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        slots = both.groupBy(F.col(key).alias("_key"), F.col("_slot").alias("_at")).agg(last.alias("_last"))
        slots = slots.select("_key", "_at", F.last("_last", ignorenulls=True).over(earlier)["_v"].alias("_carried"))
        found = found.join(slots, F.col(key).eqNullSafe(F.col("_key")) & F.col("_slot").eqNullSafe(F.col("_at")), "left").withColumn("_found", F.coalesce("_found", "_carried"))
    return found.select(*left.columns, *(F.col("_found")[v].alias(v) for v in values))


def range_join(points: DataFrame, ranges: DataFrame, point: Column, low: Column, high: Column, width: float) -> DataFrame:
    """Pairs of a point and a range with low <= point < high, by an equi-join on cells of the given width.

    A range stands in each cell it touches, so a point meets it in one cell alone; a width near the usual length of a range
    keeps both copies and false candidates few.
    """
    cells = F.sequence(F.floor(low / width), F.floor(high / width))
    spread = ranges.withColumns({"_low": low, "_high": high}).where("_low < _high").withColumn("_cell", F.explode(cells))
    placed = points.withColumns({"_point": point, "_at": F.floor(point / width)})
    met = placed.join(spread, (F.col("_at") == F.col("_cell")) & (F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
    return met.drop("_low", "_high", "_cell", "_point", "_at")


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int) -> DataFrame:
    """Inner equi-join in which each key's left rows are spread over salts tasks, and the right rows copied to each."""
    many = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(copies, [key, "_salt"]).drop("_salt")
