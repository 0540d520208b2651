"""Sliding minima and maxima whose cost does not grow with the length of the range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sliding_extremes(
    rows: DataFrame, keys: Sequence[str], day: str, range_days: int, least: Mapping[str, Column], most: Mapping[str, Column]
) -> DataFrame:
    """(*keys, ``day``, *outputs): minima (``least``) and maxima (``most``) of the rows of a key from
    ``range_days`` calendar days before a row's day up to it; NULL values are passed over.

    ``rows`` has one row per key and day. Days are cut into blocks as long as the range, so a range
    is the beginning of its block and an end of the block before. The first comes from one running
    window over the block; for the second each row asks, on the first day of its range, a running window
    from the block's end. Both windows only grow, so a row costs one comparison each, whatever the
    range; a task orders two blocks' rows at a time. One exchange by key serves all steps.
    """
    keys = list(keys)
    block = F.floor(F.col("_day") / (range_days + 1))
    values = [*least.items(), *most.items()]
    data = rows.select(*keys, F.unix_date(F.col(day)).alias("_day"), *[v.alias(f"_{n}") for n, v in values])
    data = data.repartition(*keys).withColumn("_block", block)
    # A question stands on the first day of the range; rows of that day come before it.
    asked = data.select(
        *keys, (F.col("_day") - range_days).alias("_day"), *[F.lit(None).cast(data.schema[f"_{n}"].dataType).alias(f"_{n}") for n, _ in values],
        (F.col("_block") - 1).alias("_block"), F.lit(1).alias("_asks"),
    )
    both = data.withColumn("_asks", F.lit(0)).unionByName(asked)
    onward = W.partitionBy(*keys, "_block").orderBy("_day", "_asks").rowsBetween(W.unboundedPreceding, 0)
    back = W.partitionBy(*keys, "_block").orderBy(F.col("_day").desc(), "_asks").rowsBetween(W.unboundedPreceding, 0)

    def extreme(name: str, window: object) -> Column:
        return (F.min if name in least else F.max)(f"_{name}").over(window)

    part = both.select(
        *keys,
        F.when(F.col("_asks") == 1, F.col("_day") + range_days).otherwise(F.col("_day")).alias("_day"),
        *[F.when(F.col("_asks") == 1, extreme(n, back)).otherwise(extreme(n, onward)).alias(n) for n, _ in values],
    )
    meet = [(F.min if n in least else F.max)(n).alias(n) for n, _ in values]
    return part.groupBy(*keys, "_day").agg(*meet).select(*keys, F.date_from_unix_date("_day").alias(day), *[n for n, _ in values])
