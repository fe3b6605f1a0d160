"""As-of joins by union and window: one shuffle on the keys, one sort, no pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, take: Sequence[str], tolerance_days: int | None = None, allow_equal: bool = True, forward: bool = False) -> DataFrame:
    """Left rows with `take` of the last right row at or before (forward: first at or after) their time.

    right has one row per key and time. tolerance_days voids older matches, counted from right_on. `{right_on}` comes back as
    `matched_{right_on}`. Several rows of left may share a time.
    """
    payload = F.struct(F.col(right_on).alias("_t"), *take)
    kind = right.select(payload.alias("p")).schema["p"].dataType
    l = left.select(*by, F.col(left_on).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(kind).alias("_p"))
    r = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), payload.alias("_p"))
    time = F.col("_at").desc() if forward else F.col("_at").asc()
    # of equal times, the right side comes first if it may match
    side = F.col("_side").asc() if allow_equal else F.col("_side").desc()
    w = Window.partitionBy(*by).orderBy(time, side).rowsBetween(Window.unboundedPreceding, 0)
    out = l.unionByName(r).withColumn("_m", F.last("_p", ignorenulls=True).over(w)).where("_side = 1")
    if tolerance_days is not None:
        gap = F.abs(F.datediff(F.col("_at"), F.col("_m._t")))
        out = out.withColumn("_m", F.when(gap <= tolerance_days, F.col("_m")))
    return out.select("_row.*", F.col("_m._t").alias(f"matched_{right_on}"), *[F.col(f"_m.{c}").alias(c) for c in take])
