"""Ratio of each value to the baseline of its group, such as the speedup over the smallest cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ratio_to_baseline(
    df: DataFrame,
    value: str,
    order: str,
    by: tuple[str, ...] = (),
    name: str = "ratio",
    *,
    inverse: bool = False,
) -> DataFrame:
    """Adds ``value / baseline``, where the baseline is the group's value at its lowest ``order``.

    ``inverse`` gives ``baseline / value``, as for a speedup. Among equal lowest orders the lower value is the
    baseline. The baselines are aggregated and joined back rather than taken in a window, so a group that holds
    a large share of the rows is split like any skewed join side.
    """
    lowest = F.when(F.col(order).isNotNull(), F.struct(F.col(order), F.col(value)))
    baselines = df.groupBy(*by).agg(F.min(lowest)[value].alias("_baseline"))
    if by:
        baselines = baselines.select(*(F.col(key).alias(f"_{key}") for key in by), "_baseline")
        same_group = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in by]
        joined = df.join(baselines, same_group, "left").drop(*(f"_{key}" for key in by))
    else:
        joined = df.withColumn("_baseline", baselines.scalar())
    top, bottom = (
        (F.col("_baseline"), F.col(value)) if inverse else (F.col(value), F.col("_baseline"))
    )
    return joined.withColumn(name, F.try_divide(top, bottom)).drop("_baseline")
