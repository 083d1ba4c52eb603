"""Data-quality audits as long tables (section, check, status, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.config import ACTIVE_WEIGHT
from quantpanel.operators.splits import FOLD_PATTERN
from quantpanel.operators.stats import group_median

SUM_TOLERANCE = 1e-6
NEGATIVE_TOLERANCE = -1e-8


def _facts(df: DataFrame, section: str, checks: dict[str, tuple[Column, str | None]]) -> DataFrame:
    """Turn one row of values into check rows.

    Each entry is (value, status if the value is not 0); entries without a status are
    informational.
    """
    rows = []
    for name, (value, failure) in checks.items():
        number = value.cast("double")
        status = F.lit("INFO") if failure is None else F.when(number == 0, "PASS").otherwise(failure)
        rows.append(F.struct(F.lit(name).alias("check"), status.alias("status"), number.alias("value")))
    return df.select(F.lit(section).alias("section"), F.explode(F.array(*rows)).alias("_c")).select(
        "section", "_c.check", "_c.status", "_c.value"
    )


def price_audit(prices: DataFrame) -> DataFrame:
    """Rows, tickers, date range, duplicate keys and missing adjusted closes.

    Counted from one row per (date, ticker), then from one row per ticker, so no step brings
    a large group together.
    """
    per_key = prices.groupBy("date", "ticker").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("adj_close").isNull(), 1)).alias("n_null")
    )
    per_ticker = per_key.groupBy("ticker").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.count(F.when(F.col("n") > 1, 1)).alias("n_dup"),
        F.min("date").alias("lo"),
        F.max("date").alias("hi"),
    )
    total = per_ticker.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("tickers"),
        F.unix_date(F.min("lo")).alias("first_day"),
        F.unix_date(F.max("hi")).alias("last_day"),
        F.sum("n_dup").alias("dup"),
        F.sum("n_null").alias("nulls"),
    )
    return _facts(
        total,
        "prices",
        {
            "rows": (F.col("rows"), None),
            "tickers": (F.col("tickers"), None),
            "first_date": (F.col("first_day"), None),
            "last_date": (F.col("last_day"), None),
            "duplicate_keys": (F.col("dup"), "FAIL"),
            "null_adj_close": (F.col("nulls"), "WARN"),
        },
    )


def block_coverage(blocks: dict[str, DataFrame | None]) -> DataFrame:
    """(block, n_rows, n_columns, first_date, last_date) per feature table that exists."""
    out = []
    for name, block in blocks.items():
        if block is None:
            continue
        day = "asof_date" if "asof_date" in block.columns else "date"
        out.append(
            block.agg(
                F.count("*").alias("n_rows"), F.min(day).alias("first_date"), F.max(day).alias("last_date")
            ).select(
                F.lit(name).alias("block"),
                "n_rows",
                F.lit(len(block.columns)).cast("long").alias("n_columns"),
                "first_date",
                "last_date",
            )
        )
    return reduce(lambda a, b: a.unionByName(b), out)


def missingness(features: DataFrame) -> DataFrame:
    """(column, nulls, share): null count of every column, from a single pass."""
    names = features.columns
    counts = features.agg(
        F.count("*").alias("_rows"),
        *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in names],
    )
    long = counts.unpivot("_rows", names, "column", "nulls")
    share = F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows")).otherwise(0.0)
    return long.select("column", "nulls", share.alias("share"))


def top_missing(features: DataFrame, n: int = 10) -> DataFrame:
    """The n columns with most nulls (a report of the worst, so a limit by definition)."""
    return missingness(features).filter(F.col("nulls") > 0).orderBy(F.desc("nulls"), "column").limit(n)


def total_missing(features: DataFrame) -> DataFrame:
    """Percentage of null cells of the table."""
    per_column = missingness(features)
    return per_column.agg((F.avg("share") * 100).alias("missing_percent"))


def label_audit(weights: DataFrame, labels: DataFrame, cash: str = "CASH") -> DataFrame:
    """Checks of label weights (date, ticker, soft, hard) and of the confidence per date."""
    keys = ["date", "horizon_h"]
    per_date = weights.groupBy(*keys).agg(
        F.sum("hard").alias("hard_sum"),
        F.sum("soft").alias("soft_sum"),
        F.min(F.least("hard", "soft")).alias("lowest"),
        F.count(F.when(F.col("soft") > ACTIVE_WEIGHT, 1)).cast("double").alias("active"),
        F.max("soft").alias("largest"),
        F.sum(F.when(F.col("ticker") == cash, F.col("soft")).otherwise(0.0)).alias("cash"),
    )
    off = (F.abs(F.col("hard_sum") - 1) > SUM_TOLERANCE) | (
        F.abs(F.col("soft_sum") - 1) > SUM_TOLERANCE
    )
    medians = group_median(per_date.withColumn("_k", F.lit(1)), ["_k"], "active", "_median_active")
    confidence = group_median(
        labels.withColumn("_k", F.lit(1)), ["_k"], "teacher_confidence", "_median_conf"
    )
    table = (
        per_date.agg(
            F.lit(1).alias("_k"),
            F.count("*").alias("rows"),
            F.count(F.when(off, 1)).alias("off"),
            F.count(F.when(F.col("lowest") < NEGATIVE_TOLERANCE, 1)).alias("negative"),
            F.avg("active").alias("active"),
            F.avg("largest").alias("largest"),
            F.avg("cash").alias("cash"),
        )
        .join(medians, "_k")
        .join(confidence, "_k")
        .join(
            labels.agg(
                F.lit(1).alias("_k"),
                F.avg("teacher_confidence").alias("c_mean"),
                F.min("teacher_confidence").alias("c_min"),
                F.max("teacher_confidence").alias("c_max"),
            ),
            "_k",
        )
    )
    return _facts(
        table,
        "labels",
        {
            "rows": (F.col("rows"), None),
            "sum_violations": (F.col("off"), "FAIL"),
            "negative_vectors": (F.col("negative"), "FAIL"),
            "confidence_mean": (F.col("c_mean"), None),
            "confidence_median": (F.col("_median_conf"), None),
            "confidence_min": (F.col("c_min"), None),
            "confidence_max": (F.col("c_max"), None),
            "active_mean": (F.col("active"), None),
            "active_median": (F.col("_median_active"), None),
            "max_weight_mean": (F.col("largest"), None),
            "cash_weight_mean": (F.col("cash"), None),
        },
    )


def candidate_audit(candidates: DataFrame) -> DataFrame:
    """Per candidate type: rows, wins (rank 0), mean and median objective."""
    medians = group_median(candidates, ["cand_type"], "objective_total", "median_objective")
    return (
        candidates.groupBy("cand_type")
        .agg(
            F.count("*").alias("n_candidates"),
            F.count(F.when(F.col("rank") == 0, 1)).alias("n_wins"),
            F.avg("objective_total").alias("mean_objective"),
        )
        .join(medians, "cand_type")
    )


def split_audit(splits: DataFrame) -> DataFrame:
    """Static and walk-forward intervals with the fold id and length in days."""
    fold = F.regexp_extract("split_name", FOLD_PATTERN, 1)
    return splits.select(
        F.when(fold == "", "static").otherwise("walkforward").alias("kind"),
        F.when(fold == "", F.col("split_name")).otherwise(fold).alias("fold"),
        "split_name",
        "start_date",
        "end_date",
        (F.datediff("end_date", "start_date") + 1).cast("long").alias("n_calendar_days"),
    )


def leakage_audit(
    known: DataFrame,
    weights: DataFrame,
    ranked: DataFrame,
    labels: DataFrame,
    universe: DataFrame,
    vintages: DataFrame | None = None,
) -> DataFrame:
    """Number of violations per point-in-time and label rule.

    `known`: joined facts with their own time `known_ts` and the `cutoff` they were used at.
    `vintages`: joined series values with their `vintage_date` and the same `cutoff`.
    """
    caps = universe.select("ticker", "weight_cap")
    late = known.agg(F.count(F.when(F.col("known_ts") > F.col("cutoff"), 1)).alias("v"))
    over = weights.join(caps, "ticker").agg(
        F.count(F.when(F.col("hard") > F.col("weight_cap") + SUM_TOLERANCE, 1)).alias("v")
    )
    higher = ranked.select(
        "date", "horizon_h", (F.col("rank") + 1).alias("rank"), F.col("objective_total").alias("_better")
    )
    unsorted = ranked.join(higher, ["date", "horizon_h", "rank"]).agg(
        F.count(F.when(F.col("objective_total") > F.col("_better"), 1)).alias("v")
    )
    negative = labels.agg(F.count(F.when(F.col("teacher_confidence") < 0, 1)).alias("v"))
    named = {
        "fact_after_cutoff": late,
        "weight_above_cap": over,
        "unsorted_top_k": unsorted,
        "negative_confidence": negative,
    }
    if vintages is not None:
        revised = F.col("vintage_date") > F.to_date("cutoff")
        named["vintage_after_cutoff"] = vintages.agg(F.count(F.when(revised, 1)).alias("v"))
    return reduce(
        lambda a, b: a.unionByName(b),
        [_facts(df, "leakage", {name: (F.col("v"), "FAIL")}) for name, df in named.items()],
    )
