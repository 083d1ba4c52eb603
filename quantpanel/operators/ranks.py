"""Ranks inside groups of any size.

A window ordered inside a group brings the whole group into one task. That is fine while
groups are small, but a date of a wide panel may hold a large part of all rows. Above
`window_rows` the rank is taken from a range-partitioned sort instead, where the partition
bounds include the tie-break, so neither a large group nor a run of equal values ends up in
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise, split_rows
from quantpanel.operators.grid import day_table

WINDOW_ROWS = 1_000_000
_OFFSET_MASK = (1 << 33) - 1


def largest_group(df: DataFrame, keys: list[str]) -> int:
    return group_sizes(df, keys)[0]


def group_sizes(df: DataFrame, keys: list[str]) -> tuple[int, int]:
    """Rows of the largest group and of all groups."""
    most, total = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
    return most or 0, total or 0


def rank_in_group(
    df: DataFrame,
    keys: list[str],
    order: list,
    name: str = "rank",
    group_rows: int | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Add the 0-based ordinal rank by `order` (columns that make a total order).

    `group_rows` is an upper bound on the group size if the caller knows one; otherwise one
    counting job finds it.
    """
    rows = 0
    if group_rows is None:
        group_rows, rows = group_sizes(df, keys)
    if group_rows <= window_rows:
        df = split_rows(df, rows, *keys)
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, (F.row_number().over(window) - 1).cast("long"))

    ordered = materialise(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", 33)
    local = F.col("_id").bitwiseAND(F.lit(_OFFSET_MASK))
    tagged = ordered.withColumn("_part", part).withColumn("_local", local).drop("_id")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy(*keys, "_part")
        .agg(F.min("_local").alias("_start"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    return (
        tagged.join(starts, [*keys, "_part"])
        .withColumn(name, F.col("_before") + F.col("_local") - F.col("_start"))
        .drop("_part", "_local", "_start", "_before")
    )


def scaled_rank(df: DataFrame, keys: list[str], order: list, name: str, **kwargs) -> DataFrame:
    """Ordinal rank divided by (group size - 1); 0 for groups of one."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    ranked = rank_in_group(df, keys, order, "_rank", **kwargs).join(day_table(sizes, keys), keys)
    scaled = F.when(F.col("_n") > 1, F.col("_rank") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return ranked.withColumn(name, scaled).drop("_rank", "_n")


def average_rank(
    df: DataFrame, keys: list[str], value: str, tie: list[str], name: str, **kwargs
) -> DataFrame:
    """1-based rank where equal values share the mean of their positions."""
    ranked = rank_in_group(df, keys, [F.col(value), *tie], "_rank", **kwargs)
    ties = ranked.groupBy(*keys, value).agg((F.avg("_rank") + 1).alias(name))
    return ranked.drop("_rank").join(ties, [*keys, value])
