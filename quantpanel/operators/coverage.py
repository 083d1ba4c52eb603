"""Missingness flags and days that lack too much of the universe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.columns import null_count, ratio

MIN_COVERAGE = 0.8


def missing_flags(features: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One boolean per feature group: any of its columns is null."""
    return features.withColumns(
        {f"missing_{name}": null_count(columns) > 0 for name, columns in groups.items()}
    )


def day_coverage(features: DataFrame, core: list[str], minimum: float = MIN_COVERAGE) -> DataFrame:
    """Per date: share of universe members with all core features, and whether it suffices."""
    members = features.agg(F.countDistinct("ticker")).scalar()
    complete = F.count(F.when(null_count(core) == 0, 1))
    share = ratio(complete.cast("double"), members.cast("double"))
    return features.groupBy("asof_date").agg(complete.alias("n_complete"), share.alias("coverage")).withColumn(
        "accepted", F.col("coverage") >= minimum
    )
