"""Teacher labels: candidate scores against forward returns, ranks, soft targets.

All dates are scored at once, given a table of the weights held before each date. Scoring
joins the non-zero candidate weights with one row per (date, ticker) that carries the whole
forward return vector, and sums it position by position: rows are never multiplied by the
horizon, and the sums combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import (
    CASH_ADV,
    DEFAULT_ADV,
    TRADING_DAYS_PER_YEAR,
    CandidateConfig,
    CostConfig,
    ObjectiveConfig,
)
from quantpanel.functions.columns import array_sum, by_ticker, trade_cost_bps
from quantpanel.operators.grid import day_table
from quantpanel.operators.portfolios import normalise

CAND = ["date", "cand_id"]
SCORE = ["date", "horizon_h", "cand_id"]


def forward_returns(returns: DataFrame, horizon: int) -> DataFrame:
    """(date, ticker, fwd): the next `horizon` returns (fewer at the end of the calendar)."""
    ahead = by_ticker(order="day_idx").rowsBetween(1, horizon)
    return returns.select(
        "date", "day_idx", "ticker", F.collect_list("ret").over(ahead).alias("fwd")
    )


def _mean(vector: Column) -> Column:
    return array_sum(vector) / F.size(vector)


def score_candidates(
    candidates: DataFrame,
    returns: DataFrame,
    previous: DataFrame,
    adv: DataFrame | None = None,
    rf: DataFrame | None = None,
    horizons: tuple[int, ...] = (20,),
    objective: ObjectiveConfig = ObjectiveConfig(),
    cost: CostConfig = CostConfig(),
) -> DataFrame:
    """Scores keyed by (date, horizon_h, cand_id); only dates with a full forward window.

    `candidates`: (date, cand_id, cand_type, ticker, w), zero weights may be left out.
    `previous`: (date, ticker, w) for the whole universe. `rf`: (date, rf) daily rate.
    """
    longest = max(horizons)
    assets = forward_returns(returns, longest).join(
        previous.select("date", "ticker", F.col("w").alias("prev")), ["date", "ticker"]
    )
    if adv is None:
        assets = assets.withColumn("adv", F.lit(DEFAULT_ADV))
    else:
        assets = assets.join(adv.select("date", "ticker", "adv"), ["date", "ticker"], "left")
        assets = assets.withColumn("adv", F.coalesce("adv", F.lit(CASH_ADV)))

    # A candidate trades every asset it does not hold down to 0. That part is the same for
    # all candidates of a date, so it is summed once and corrected by the held assets.
    exit_cost = trade_cost_bps(F.col("prev"), F.col("adv"), cost)
    base = assets.groupBy("date").agg(
        F.sum("prev").alias("_exit_turnover"), F.sum(exit_cost).alias("_exit_cost")
    )
    held = candidates.filter(F.col("w") != 0).join(assets, ["date", "ticker"])
    delta = F.abs(F.col("w") - F.col("prev"))
    sums = held.groupBy(*CAND, "cand_type").agg(
        F.max(F.size("fwd")).alias("_n_fwd"),
        F.sum(delta - F.col("prev")).alias("_turnover"),
        F.sum(trade_cost_bps(delta, F.col("adv"), cost) - exit_cost).alias("_cost"),
        F.sum(F.pow("w", 2)).alias("concentration_hhi"),
        *[F.sum(F.col("w") * F.get("fwd", k)).alias(f"_p{k}") for k in range(longest)],
    )
    daily = F.array(*[f"_p{k}" for k in range(longest)])
    full = [F.when(F.col("_n_fwd") >= h, F.lit(h)) for h in horizons]
    rows = (
        sums.withColumn("_daily", daily)
        .withColumn("horizon_h", F.explode(F.array_compact(F.array(*full))))
        .withColumn("_port", F.slice("_daily", 1, F.col("horizon_h")))
        .join(day_table(base), "date")
    )
    if rf is None:
        rows = rows.withColumn("_rf", F.lit(0.0))
    else:
        rows = rows.join(forward_rate(rf, horizons), ["date", "horizon_h"])
    rows = rows.withColumn("_mean", _mean(F.col("_port")))
    spread = F.transform("_port", lambda x: F.pow(x - F.col("_mean"), 2))
    rows = rows.withColumn("_std", F.sqrt(_mean(spread)))
    year = float(TRADING_DAYS_PER_YEAR)
    rows = rows.withColumns(
        {
            "objective_sharpe": (F.col("_mean") - F.col("_rf"))
            / (F.col("_std") + objective.epsilon),
            "objective_return": F.col("_mean") * year,
            "objective_vol": F.col("_std") * F.sqrt(F.lit(year)),
            "turnover": 0.5 * (F.col("_exit_turnover") + F.col("_turnover")),
            "est_cost": F.col("_exit_cost") + F.col("_cost"),
        }
    )
    total = (
        F.col("objective_sharpe")
        - objective.lambda_turnover * F.col("turnover")
        - objective.lambda_cost * F.col("est_cost") / 10000
        - objective.lambda_concentration * F.col("concentration_hhi")
    )
    return rows.select(
        *SCORE,
        "cand_type",
        total.alias("objective_total"),
        "objective_sharpe",
        "objective_return",
        "objective_vol",
        "turnover",
        "est_cost",
        "concentration_hhi",
    )


def forward_rate(rf: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Mean risk-free return of the next h days, for every horizon (date-level table)."""
    ordered = Window.orderBy("date")
    parts = [
        rf.select(
            "date",
            F.lit(h).alias("horizon_h"),
            F.avg("rf").over(ordered.rowsBetween(1, h)).alias("_rf"),
        )
        for h in horizons
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ranked_candidates(scores: DataFrame, keep: int) -> DataFrame:
    """The best `keep` candidates of each date and horizon with rank and rank_pct.

    Spark applies the limit before the shuffle as well, so only `keep` rows per date and task
    travel to the ranking task.
    """
    keys = ["date", "horizon_h"]
    best = Window.partitionBy(*keys).orderBy(F.desc("objective_total"), "cand_id")
    top = scores.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= keep)
    counts = scores.groupBy(*keys).agg(F.count("*").alias("num_candidates"))
    return (
        top.join(counts, keys)
        .withColumn("rank", (F.col("_rn") - 1).cast("long"))
        .withColumn("rank_pct", F.col("rank") / F.col("num_candidates"))
        .drop("_rn")
    )


def candidate_records(ranked: DataFrame, merge_types: bool = False) -> DataFrame:
    """Record table; `merge_types` files perturbations under `random`."""
    kind = F.col("cand_type")
    if merge_types:
        kind = F.when(kind == "perturbation", "random").otherwise(kind)
    label = F.concat_ws("_", F.col("date").cast("string"), F.col("cand_id").cast("string"))
    return ranked.withColumns({"cand_type": kind, "candidate_id": label})


def softmax_weights(
    scores: DataFrame,
    temperature: float,
    keys: list[str],
    score: str = "score",
    mask: str | None = None,
) -> DataFrame:
    """Max-shifted softmax of `score / temperature` per key as column `w`.

    Masked rows get 0; if every term vanishes the available rows share the weight equally.
    """
    available = F.lit(1.0) if mask is None else F.col(mask).cast("double")
    rows = scores.withColumn("_m", available).withColumn(
        "_s", F.when(F.col("_m") > 0, F.col(score) / max(temperature, 1e-10))
    )
    tops = rows.groupBy(*keys).agg(F.max("_s").alias("_top"))
    rows = rows.join(day_table(tops, keys), keys).withColumn(
        "_e", F.coalesce(F.exp(F.col("_s") - F.col("_top")) * F.col("_m"), F.lit(0.0))
    )
    totals = rows.groupBy(*keys).agg(F.sum("_e").alias("_total"), F.sum("_m").alias("_open"))
    weight = (
        F.when(F.col("_total") > 0, F.try_divide("_e", "_total"))
        .when(F.col("_open") > 0, F.try_divide("_m", "_open"))
        .otherwise(0.0)
    )
    return rows.join(day_table(totals, keys), keys).withColumn("w", weight).drop(
        "_m", "_s", "_top", "_e", "_total", "_open"
    )


def blend_probabilities(ranked: DataFrame, k: int, temperature: float) -> DataFrame:
    """Softmax share of each of the best k candidates (k rows per group)."""
    group = Window.partitionBy("date", "horizon_h")
    top = ranked.filter(F.col("rank") < k)
    scaled = F.col("objective_total") / max(temperature, 1e-10)
    shifted = F.exp(scaled - F.max(scaled).over(group))
    return top.withColumn("_e", shifted).withColumn("p", F.col("_e") / F.sum("_e").over(group))


def distill(
    ranked: DataFrame, candidates: DataFrame, cfg: CandidateConfig = CandidateConfig()
) -> tuple[DataFrame, DataFrame]:
    """Soft and hard targets (date, horizon_h, ticker, soft, hard) and one label row per date."""
    keys = ["date", "horizon_h"]
    shares = blend_probabilities(ranked, cfg.top_k, cfg.distillation_temperature)
    held = candidates.select("date", "cand_id", "ticker", "w").join(
        shares.select("date", "horizon_h", "cand_id", "rank", "p"), CAND
    )
    weights = held.groupBy(*keys, "ticker").agg(
        F.greatest(F.sum(F.col("p") * F.col("w")), F.lit(0.0)).alias("soft"),
        F.sum(F.when(F.col("rank") == 0, F.col("w")).otherwise(0.0)).alias("hard"),
    )
    weights = normalise(weights, keys, "soft")
    best = F.max("objective_total")
    labels = shares.groupBy(*keys).agg(
        (best - F.min("objective_total")).alias("teacher_confidence"),
        best.alias("best_objective"),
        F.avg("objective_total").alias("topk_mean_objective"),
        F.max("num_candidates").alias("num_candidates"),
    )
    return weights, labels


def label_tables(
    ranked: DataFrame,
    candidates: DataFrame,
    previous: DataFrame,
    calendar: DataFrame,
    cfg: CandidateConfig = CandidateConfig(),
) -> tuple[DataFrame, DataFrame]:
    """Label weights for the whole universe and label rows with their prediction date."""
    weights, labels = distill(ranked, candidates, cfg)
    keys = ["date", "horizon_h"]
    scaffold = labels.select(*keys).join(
        previous.select("date", "ticker", F.col("w").alias("prev_live")), "date"
    )
    table = scaffold.join(weights, [*keys, "ticker"], "left")
    table = table.withColumns(
        {c: F.coalesce(c, F.lit(0.0)) for c in ("soft", "hard")}
    )
    # The hard target of the previous label date; the first date uses the weights held.
    window = Window.partitionBy("horizon_h", "ticker").orderBy("date")
    table = table.withColumn(
        "prev_target", F.coalesce(F.lag("hard").over(window), F.col("prev_live"))
    )
    nexts = calendar.select("date", F.col("next_date").alias("prediction_date"))
    return table, labels.join(nexts, "date")
