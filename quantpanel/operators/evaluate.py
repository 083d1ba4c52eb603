"""Prediction quality, baseline signals, robustness scenarios, drift and attribution."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantpanel.config import BUILTIN_PROFILES, ExecutionConfig, StrategyProfile
from quantpanel.functions.columns import ratio
from quantpanel.operators import portfolios
from quantpanel.operators.grid import day_table
from quantpanel.operators.ranks import average_rank, rank_in_group
from quantpanel.operators.returns import vol20_pop
from quantpanel.operators.stats import group_median

EPS = 1e-8


# --- prediction metrics ---------------------------------------------------------------
def _clipped(name: str):
    return F.least(F.greatest(F.col(name), F.lit(EPS)), F.lit(1.0))


def daily_prediction_errors(rows: DataFrame) -> DataFrame:
    """Per date: KL divergence and cross-entropy of (pred, target), absolute and square error."""
    p, q = _clipped("target"), _clipped("pred")
    gap = F.col("pred") - F.col("target")
    return rows.groupBy("date").agg(
        F.sum(p * F.ln(p / q)).alias("kl"),
        (-F.sum(F.col("target") * F.ln(q))).alias("cross_entropy"),
        F.sum(F.abs(gap)).alias("abs_error"),
        F.sum(gap * gap).alias("sq_error"),
        F.count("*").alias("n"),
    )


def weight_changes(rows: DataFrame, column: str = "pred") -> DataFrame:
    """Day-to-day change per ticker; null on its first day."""
    window = Window.partitionBy("ticker").orderBy("date")
    return rows.withColumn("change", F.col(column) - F.lag(column).over(window))


def daily_change(rows: DataFrame, column: str = "pred") -> DataFrame:
    """Per date: L1 change and squared change of a weight column."""
    changes = weight_changes(rows, column).filter(F.col("change").isNotNull())
    return changes.groupBy("date").agg(
        F.sum(F.abs("change")).alias("l1_change"),
        F.sum(F.pow("change", 2)).alias("change_penalty"),
    )


def prediction_metrics(rows: DataFrame) -> DataFrame:
    """One row: KL, MAE, RMSE over all cells, and mean day-to-day L1 change of predictions."""
    errors = daily_prediction_errors(rows).agg(
        F.avg("kl").alias("kl_divergence"),
        (F.sum("abs_error") / F.sum("n")).alias("mae"),
        F.sqrt(F.sum("sq_error") / F.sum("n")).alias("rmse"),
        F.lit(1).alias("_k"),
    )
    stable = daily_change(rows).agg(
        F.coalesce(F.avg("l1_change"), F.lit(0.0)).alias("weight_stability"), F.lit(1).alias("_k")
    )
    return errors.join(stable, "_k").drop("_k")


def weighted_average(rows: DataFrame, value: str, weight: str, name: str) -> DataFrame:
    total = F.sum(F.col(value) * F.col(weight))
    return rows.agg(ratio(total, F.sum(weight)).alias(name))


def ordering_correlation(rows: DataFrame, left: str, right: str, keys: list[str]) -> DataFrame:
    """Spearman correlation per key: Pearson correlation of the average ranks."""
    known = rows.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    ranked = average_rank(known, keys, left, ["ticker"], "_a")
    ranked = average_rank(ranked, keys, right, ["ticker"], "_b")
    spread = F.stddev_pop("_a") * F.stddev_pop("_b")
    return ranked.groupBy(*keys).agg(ratio(F.covar_pop("_a", "_b"), spread).alias("spearman"))


# --- baselines and scenarios ----------------------------------------------------------
BASELINES = (
    "equal_weight", "previous_hold", "inverse_volatility", "min_variance", "teacher_replay",
)


def baseline_signals(
    scaffold: DataFrame,
    returns: DataFrame,
    hard: DataFrame,
    vol: DataFrame | None = None,
    names: tuple[str, ...] = BASELINES,
) -> DataFrame:
    """Signals of the rule-based strategies under one path id each."""
    vol = vol20_pop(scaffold) if vol is None else vol
    build = {
        "equal_weight": lambda: portfolios.equal_weight(scaffold),
        "previous_hold": lambda: portfolios.previous_hold(returns),
        "inverse_volatility": lambda: portfolios.inverse_volatility(scaffold, vol),
        "min_variance": lambda: portfolios.minimum_variance(returns),
        "teacher_replay": lambda: portfolios.teacher_replay(scaffold, hard),
    }
    out = None
    for name in names:
        rows = build[name]().select(F.lit(name).alias("path_id"), "date", "ticker", "w")
        out = rows if out is None else out.unionByName(rows)
    return out


_SCENARIO = "scenario string, band double, alpha double, cost_scale double"


def cost_scenarios(
    spark: SparkSession,
    scales: tuple[float, ...] = (0.5, 1.0, 2.0),
    cfg: ExecutionConfig = ExecutionConfig(),
) -> DataFrame:
    """Commission, spread and impact times each scale, always from the same base."""
    rows = [
        (f"cost_{s}x", cfg.rebalance_band, cfg.partial_rebalance_alpha, s) for s in scales
    ]
    return spark.createDataFrame(rows, _SCENARIO)


def sensitivity_scenarios(
    spark: SparkSession,
    bands: tuple[float, ...] = (0.01, 0.02, 0.05, 0.10),
    alphas: tuple[float, ...] = (0.25, 0.50, 0.75, 1.0),
    cfg: ExecutionConfig = ExecutionConfig(),
) -> DataFrame:
    rows = [(f"band_{b}", b, cfg.partial_rebalance_alpha, 1.0) for b in bands]
    rows += [(f"alpha_{a}", cfg.rebalance_band, a, 1.0) for a in alphas]
    return spark.createDataFrame(rows, _SCENARIO)


def profile_table(spark: SparkSession, custom: tuple[StrategyProfile, ...] = ()) -> DataFrame:
    """Strategy profiles as rows; a custom profile replaces the built-in of the same name."""
    profiles = {p.name: p for p in (*BUILTIN_PROFILES, *custom)}
    numbers = [f.name for f in fields(StrategyProfile) if f.name != "name"]
    rows = [(p.name, *[float(getattr(p, n)) for n in numbers]) for p in profiles.values()]
    return spark.createDataFrame(rows, "name string, " + ", ".join(f"{n} double" for n in numbers))


def profile_scenarios(spark: SparkSession, custom: tuple[StrategyProfile, ...] = ()) -> DataFrame:
    return profile_table(spark, custom).select(
        F.col("name").alias("scenario"),
        F.col("rebalance_band").alias("band"),
        F.col("partial_rebalance_alpha").alias("alpha"),
        F.lit(1.0).alias("cost_scale"),
    )


def regime_days(vix: DataFrame) -> DataFrame:
    """(date, regime): at or above the median volatility index, or below it.

    A regime with fewer than five days is left out.
    """
    middle = group_median(vix.withColumn("_k", F.lit(1)), ["_k"], "vix").select("median").scalar()
    named = vix.filter(F.col("vix").isNotNull()).select(
        "date", F.when(F.col("vix") >= middle, "high_vix").otherwise("low_vix").alias("regime")
    )
    large = named.groupBy("regime").count().filter(F.col("count") >= 5).select("regime")
    return named.join(large, "regime", "left_semi")


def regime_signals(signals: DataFrame, vix: DataFrame) -> DataFrame:
    """One path per signal path and regime, over the days of that regime only."""
    return _relabelled(signals.join(day_table(regime_days(vix)), "date"), "regime")


def half_signals(signals: DataFrame) -> DataFrame:
    """First and second half of the days of each path."""
    days = signals.select("path_id", "date").distinct()
    ordered = Window.partitionBy("path_id").orderBy("date")
    whole = Window.partitionBy("path_id")
    half = F.when(
        F.row_number().over(ordered) <= F.floor(F.count("*").over(whole) / 2), "first_half"
    ).otherwise("second_half")
    return _relabelled(signals.join(days.withColumn("half", half), ["path_id", "date"]), "half")


def _relabelled(signals: DataFrame, label: str) -> DataFrame:
    path = F.concat_ws("|", "path_id", label)
    return signals.withColumn("path_id", path).drop(label)


def regime_attribution(daily: DataFrame, vix: DataFrame) -> DataFrame:
    """Mean and total net return of full paths by regime of the day."""
    rows = daily.join(day_table(regime_days(vix)), "date")
    return rows.groupBy("path_id", "regime").agg(
        F.count("*").alias("n_days"),
        F.avg("net").alias("mean_net"),
        F.sum("net").alias("total_net"),
        F.avg("turnover").alias("avg_turnover"),
    )


# --- drift and attribution ------------------------------------------------------------
def feature_drift(tagged: DataFrame, features: list[str], base: str = "train") -> DataFrame:
    """Shift of mean and deviation of every feature against the base split."""
    long = tagged.select("split_name", *features).unpivot(
        "split_name", features, "feature", "value"
    )
    moments = long.groupBy("split_name", "feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.avg(F.col("value").isNull().cast("double")).alias("null_share"),
    )
    origin = moments.filter(F.col("split_name") == base).select(
        "feature", F.col("mean").alias("_m"), F.col("std").alias("_s")
    )
    spread = F.when(F.col("_s") >= 1e-12, F.col("_s"))
    return (
        moments.filter(F.col("split_name") != base)
        .join(origin, "feature")
        .select(
            "split_name",
            "feature",
            "mean",
            "std",
            "null_share",
            ratio(F.col("mean") - F.col("_m"), spread).alias("mean_shift"),
            ratio(F.col("std"), spread).alias("std_ratio"),
        )
    )


def asset_attribution(weights: DataFrame) -> DataFrame:
    """Average weight and share of turnover per path and ticker."""
    per_asset = weights.groupBy("path_id", "ticker").agg(
        F.avg("w").alias("avg_weight"),
        F.sum(F.abs(F.col("w") - F.col("live"))).alias("traded_weight"),
    )
    totals = per_asset.groupBy("path_id").agg(F.sum("traded_weight").alias("_total"))
    return per_asset.join(totals, "path_id").select(
        "path_id",
        "ticker",
        "avg_weight",
        "traded_weight",
        ratio(F.col("traded_weight"), F.col("_total")).alias("turnover_share"),
    )


# --- ranking quality of a candidate scorer --------------------------------------------
def top_share_recall(scored: DataFrame, group: list[str], tie: str) -> DataFrame:
    """Per group: share of the true best fifth (at least one) found in the predicted one."""
    sizes = scored.groupBy(*group).agg(
        F.greatest(F.lit(1), F.floor(F.count("*") / 5)).alias("k")
    )
    ranked = rank_in_group(scored, group, [F.desc("truth"), F.col(tie)], "_t")
    ranked = rank_in_group(ranked, group, [F.desc("pred"), F.col(tie)], "_p").join(sizes, group)
    both = F.count(F.when((F.col("_t") < F.col("k")) & (F.col("_p") < F.col("k")), 1))
    return ranked.groupBy(*group).agg((both / F.max("k")).alias("recall"))


BLOCK = 10_000


def kendall_tau(scored: DataFrame, group: list[str], tie: str, block: int = BLOCK) -> DataFrame:
    """Kendall's tau-b of (pred, truth) per group without forming pairs.

    With rows numbered by pred (ties by truth) and by truth (ties by the first number), the
    discordant pairs are the inversions between the two numberings. They are counted bit by
    bit: at bit b, among rows that agree on the higher bits, each row with bit 0 counts the
    rows before it with bit 1. That takes log(n) copies of the rows, and running counts are
    made per block of positions first, so no task needs a whole group.
    """
    ranked = rank_in_group(scored, group, ["pred", "truth", tie], "_x")
    ranked = rank_in_group(ranked, group, ["truth", "_x"], "_y")
    sizes = scored.groupBy(*group).agg(F.count("*").alias("_n"))
    bits = F.ceil(F.log2(F.greatest(F.col("_n"), F.lit(2)))).cast("int")
    rows = ranked.join(sizes, group).select(
        *group, "_x", "_y", F.explode(F.sequence(F.lit(0), bits - 1)).alias("_bit")
    )
    rows = rows.select(
        *group,
        "_x",
        "_bit",
        F.floor(F.col("_x") / block).alias("_block"),
        F.expr("shiftright(_y, _bit + 1)").alias("_prefix"),
        F.expr("shiftright(_y, _bit) & 1").alias("_one"),
    )
    node = [*group, "_bit", "_prefix"]
    earlier = Window.partitionBy(*node).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*node, "_block").agg(F.sum("_one").alias("_ones"))
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_ones").over(earlier), F.lit(0)))
    inside = (
        Window.partitionBy(*node, "_block").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = rows.withColumn("_in", F.coalesce(F.sum("_one").over(inside), F.lit(0))).join(
        blocks.drop("_ones"), [*node, "_block"]
    )
    discordant = counted.groupBy(*group).agg(
        F.sum(F.when(F.col("_one") == 0, F.col("_in") + F.col("_before")).otherwise(0)).alias("_d")
    )

    def ties(columns: list[str], name: str) -> DataFrame:
        runs = scored.groupBy(*group, *columns).agg(F.count("*").cast("double").alias("_t"))
        return runs.groupBy(*group).agg(F.sum(F.col("_t") * (F.col("_t") - 1) / 2).alias(name))

    table = (
        sizes.join(discordant, group)
        .join(ties(["pred"], "_tx"), group)
        .join(ties(["truth"], "_ty"), group)
        .join(ties(["pred", "truth"], "_txy"), group)
    )
    pairs = F.col("_n").cast("double") * (F.col("_n") - 1) / 2
    agreeing = pairs - F.col("_tx") - F.col("_ty") + F.col("_txy") - 2 * F.col("_d")
    scale = F.sqrt((pairs - F.col("_tx")) * (pairs - F.col("_ty")))
    return table.select(*group, ratio(agreeing, scale).alias("kendall"))


def ranking_metrics(scored: DataFrame, group: list[str], tie: str) -> DataFrame:
    """One row: global Spearman, mean per-group Kendall, mean per-group top-fifth recall.

    `scored`: group columns, `tie` (a row id), pred, truth.
    """
    everything = scored.withColumn("_k", F.lit(1)).withColumnRenamed(tie, "ticker")
    spearman = ordering_correlation(everything, "pred", "truth", ["_k"])
    kendall = kendall_tau(scored, group, tie).agg(
        F.avg("kendall").alias("kendall"), F.lit(1).alias("_k")
    )
    recall = top_share_recall(scored, group, tie).agg(
        F.avg("recall").alias("top_k_recall"), F.lit(1).alias("_k")
    )
    return spearman.join(kendall, "_k").join(recall, "_k").drop("_k")
