"""Jobs that fit scorers and evaluate them: holdout, walk-forward, benchmark, prediction."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.config import CostConfig, ExecutionConfig, ScorerConfig, StrategyProfile
from quantpanel.functions.storage import materialise
from quantpanel.operators import dataset as ds
from quantpanel.operators import evaluate as ev
from quantpanel.operators import portfolios
from quantpanel.operators import scorers as sc
from quantpanel.operators import splits as sp
from quantpanel.operators.backtest import backtest_banded, single_scenario
from quantpanel.operators.metrics import fold_aggregate, leaderboard, portfolio_metrics


def evaluate_holdout(
    scorer: sc.Scorer,
    dataset: DataFrame,
    returns: DataFrame,
    execution: ExecutionConfig = ExecutionConfig(),
    cost: CostConfig = CostConfig(),
) -> DataFrame:
    """(metric, value): net and gross portfolio metrics and prediction metrics on test rows."""
    test = materialise(scorer.weights(dataset.filter(F.col("split_name") == "test")))
    signals = test.select(
        F.lit("model").alias("path_id"), F.col("prediction_date").alias("date"), "ticker", "w"
    )
    daily = materialise(backtest_banded(signals, returns, cfg=cost, execution=execution)[0])
    paired = test.select(
        F.col("asof_date").alias("date"), "ticker", F.col("w").alias("pred"),
        F.col("target_weight").alias("target"),
    )
    blocks = {
        "net": portfolio_metrics(daily).drop("path_id"),
        "gross": portfolio_metrics(daily, net=False).drop("path_id"),
        "prediction": ev.prediction_metrics(paired),
    }
    out = None
    for name, row in blocks.items():
        doubles = row.select(*[F.col(c).cast("double").alias(c) for c in row.columns], F.lit(name).alias("_b"))
        long = doubles.unpivot("_b", row.columns, "metric", "value").select(
            F.concat_ws("_", "_b", "metric").alias("metric"), "value"
        )
        out = long if out is None else out.unionByName(long)
    return out


def evaluate_walkforward(
    features: DataFrame,
    labels: DataFrame,
    folds: DataFrame,
    universe: DataFrame,
    calendar: DataFrame,
    n_assets: int,
    returns: DataFrame,
    cfg: ScorerConfig,
    execution: ExecutionConfig = ExecutionConfig(),
) -> DataFrame:
    """Refit per fold, then one backtest job over all folds.

    One row per fold, plus the rows `mean`, `std`, `min` and `max` over the folds. The loop
    runs over folds (a handful), each of which is a distributed fit.
    """
    named = sp.with_fold(folds)
    signals = None
    for row in named.select("fold").distinct().orderBy("fold").collect():
        fold = row["fold"]
        own = named.filter(F.col("fold") == fold).select(
            F.col("role").alias("split_name"), "start_date", "end_date"
        )
        data, _ = ds.prepare_dataset(features, labels, own, universe, calendar, n_assets)
        data = materialise(data)
        scorer = sc.fit_scorer(data, ds.feature_columns(features), cfg)
        rows = sc.model_signals(scorer, data.filter(F.col("split_name") == "test"), fold)
        signals = rows if signals is None else signals.unionByName(rows)
    daily, _ = backtest_banded(signals, returns, execution=execution)
    metrics = materialise(portfolio_metrics(daily))
    names = [c for c in metrics.columns if c != "path_id"]
    per_fold = metrics.select(
        "path_id", *[F.col(c).cast("double").alias(c) for c in names]
    ).unpivot("path_id", names, "metric", "value")
    kinds = ["mean", "std", "min", "max"]
    overall = fold_aggregate(metrics, names).unpivot("metric", kinds, "path_id", "value")
    return per_fold.unionByName(overall.select("path_id", "metric", "value"))


def utility_predictions(
    utility: DataFrame, splits: DataFrame, shared: list[str], n_assets: int, cfg: ScorerConfig
) -> DataFrame:
    """Fit the candidate scorer on train rows and predict all split rows."""
    tagged = materialise(sp.assign_split(utility, splits))
    return sc.fit_utility(tagged, shared, n_assets, cfg).predictions(tagged)


def utility_signals(
    utility: DataFrame,
    candidates: DataFrame,
    splits: DataFrame,
    shared: list[str],
    n_assets: int,
    days: DataFrame,
    cfg: ScorerConfig,
    path: str = "utility_rerank",
) -> DataFrame:
    """The candidate with the best predicted objective of each day, as signals.

    `days`: (date, prediction_date). Days without candidates are left out of the path.
    """
    scored = utility_predictions(utility, splits, shared, n_assets, cfg)
    rows = scored.filter(F.col("split_name") == "test").select(
        F.col("asof_date").alias("date"), "cand_id", "rank", "pred"
    )
    best = sc.best_predicted(rows).select("date", "cand_id").join(days, "date")
    held = best.join(candidates.select("date", "cand_id", "ticker", "w"), ["date", "cand_id"])
    return held.select(
        F.lit(path).alias("path_id"), F.col("prediction_date").alias("date"), "ticker", "w"
    )


def benchmark(
    dataset: DataFrame,
    features: list[str],
    scaffold: DataFrame,
    returns: DataFrame,
    hard: DataFrame,
    variants: dict[str, tuple[ScorerConfig, StrategyProfile]],
    extra: DataFrame | None = None,
    execution: ExecutionConfig = ExecutionConfig(),
) -> DataFrame:
    """Baselines and learned variants on the test days, backtested as paths of one job.

    Signals formed on a date are executed on its prediction date. A variant takes its softmax
    temperature, band and partial-trade share from its profile; variants that share the rest
    share one fit. `extra` holds further signals, traded like the baselines.
    """
    test = dataset.filter(F.col("split_name") == "test")
    days = test.select(F.col("asof_date").alias("date"), "prediction_date").distinct()
    base = ev.baseline_signals(
        scaffold, returns, hard, names=tuple(n for n in ev.BASELINES if n != "previous_hold")
    )
    signals = base.join(days, "date").select(
        "path_id", F.col("prediction_date").alias("date"), "ticker", "w"
    )
    # Buy and hold starts with equal weights on the first test day.
    executed = returns.join(
        days.select(F.col("prediction_date").alias("date")), "date", "left_semi"
    )
    hold = portfolios.previous_hold(executed).withColumn("path_id", F.lit("previous_hold"))
    signals = signals.unionByName(hold.select("path_id", "date", "ticker", "w"))
    if extra is not None:
        signals = signals.unionByName(extra)
    signals = single_scenario(signals, execution)
    models: dict[ScorerConfig, object] = {}
    for name, (cfg, profile) in variants.items():
        key = replace(cfg, temperature=1.0)
        if key not in models:
            models[key] = sc.fit_scorer(dataset, features, cfg).model
        own = replace(cfg, temperature=profile.inference_temperature)
        scorer = sc.Scorer(models[key], tuple(features), own)
        rules = ExecutionConfig(profile.rebalance_band, profile.partial_rebalance_alpha)
        signals = signals.unionByName(
            single_scenario(sc.model_signals(scorer, test, name), rules)
        )
    daily, _ = backtest_banded(materialise(signals), returns)
    return leaderboard(portfolio_metrics(daily))


def predict_dates(
    features: DataFrame,
    labels: DataFrame,
    splits: DataFrame,
    universe: DataFrame,
    calendar: DataFrame,
    n_assets: int,
    cfg: ScorerConfig,
    split: str = "test",
    path: str | None = None,
) -> DataFrame:
    """Weights for all dates of a split at once, as if the portfolio were equally weighted.

    Features are filled with the train medians and scaled with the train moments. With `path`,
    the fitted scorer is stored there first, and the stored one predicts.
    """
    data, scaling = ds.prepare_dataset(features, labels, splits, universe, calendar, n_assets)
    scorer = sc.fit_scorer(materialise(data), ds.feature_columns(features), cfg)
    if path is not None:
        sc.save_scorer(scorer, path, scaling)
        scorer, scaling = sc.load_scorer(features.sparkSession, path)
    wanted = sp.assign_split(features, splits).filter(F.col("split_name") == split)
    return predict_rows(scorer, scaling, wanted, n_assets)


def predict_rows(
    scorer: sc.Scorer, scaling: ds.Scaling, wanted: DataFrame, n_assets: int
) -> DataFrame:
    """Weights of a fitted or loaded scorer for feature rows, with equal-weight context."""
    equal = F.lit(1.0 / n_assets)
    context = wanted.withColumns(
        {"prev_live_weight": equal, "prev_target_weight": equal, "delta_from_prev_target": F.lit(0.0)}
    )
    weights = scorer.weights(scaling.apply(context))
    return weights.withColumnRenamed("asof_date", "date")
