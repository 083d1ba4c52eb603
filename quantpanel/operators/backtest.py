"""Backtests of weight signals: rebalance band, partial trading, drift, costs.

Signals are (path_id, date, ticker, w); returns are (date, ticker, ret). A member that a date
leaves out has weight 0 there: the members of a path are all its tickers. Moves below zero are
cut off at zero; where the weights add up to nothing, after a trade or after a day's
returns, they are kept as they are.

* `backtest_full` (always trade, all the way) has a closed form and is purely relational.
* `backtest_banded` depends on its own past through the trade decision. Paths of a bounded
  number of rows run as one group each, all paths in parallel. Larger paths are split by
  ticker: given, for each day, whether it trades, what the moved weights add up to and by how much
  the portfolio grows, every ticker evolves on its own. That schedule is refined until it
  repeats itself. Each pass fixes at least one more day, so it ends, and the result is the same as
  the day-by-day one at every size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import DEFAULT_ADV, CostConfig, ExecutionConfig
from quantpanel.functions.columns import clip, spread_bps
from quantpanel.functions.storage import materialise, spread
from quantpanel.operators.grid import day_table

PATH_DAY = ["path_id", "date"]
MAX_PATH_ROWS = 1_000_000
TICKERS_PER_BLOCK = 256


# --- single steps ---------------------------------------------------------------------
def execute(
    targets: DataFrame, live: DataFrame, keys: list[str], cfg: ExecutionConfig = ExecutionConfig()
) -> DataFrame:
    """(keys, ticker, live, w, traded): move `alpha` of the way unless inside the band."""
    old = live.select(*keys, "ticker", F.col("w").alias("live"))
    rows = targets.select(*keys, "ticker", F.col("w").alias("_target")).join(old, [*keys, "ticker"])
    gap = F.col("_target") - F.col("live")
    rows = rows.withColumn(
        "_moved", clip(F.col("live") + cfg.partial_rebalance_alpha * gap, lower=0.0)
    )
    totals = rows.groupBy(*keys).agg(
        (0.5 * F.sum(F.abs(gap))).alias("_l1"), F.sum("_moved").alias("_total")
    )
    traded = F.col("_l1") >= cfg.rebalance_band
    moved = F.when(F.col("_total") > 0, F.try_divide("_moved", "_total")).otherwise(F.col("_moved"))
    return rows.join(day_table(totals, keys), keys).select(
        *keys,
        "ticker",
        "live",
        F.when(traded, moved).otherwise(F.col("live")).alias("w"),
        traded.alias("traded"),
    )


def drift(weights: DataFrame, returns: DataFrame, keys: list[str]) -> DataFrame:
    """Weights after one period of returns; unchanged where the total is not positive."""
    on = [c for c in (*keys, "ticker") if c in returns.columns]
    rows = weights.join(returns.select(*on, "ret"), on)
    grown = rows.withColumn("_g", F.col("w") * (1 + F.col("ret")))
    totals = grown.groupBy(*keys).agg(F.sum("_g").alias("_total"))
    after = F.when(F.col("_total") > 0, F.try_divide("_g", "_total")).otherwise(F.col("w"))
    return grown.join(day_table(totals, keys), keys).withColumn("w", after).drop("_g", "_total", "ret")


# --- accounting -----------------------------------------------------------------------
def _scaled_cost(delta: Column, adv: Column, scale: Column, cfg: CostConfig) -> Column:
    """Trading cost in bps with commission, spread and impact scaled; regulatory fee is not."""
    notional = delta * F.lit(cfg.portfolio_value)
    impact = cfg.impact_coeff * F.sqrt(notional / F.greatest(adv, F.lit(cfg.adv_floor)))
    scaled = scale * (F.lit(cfg.commission_bps) + spread_bps(adv, cfg) + impact)
    return delta * (scaled + cfg.regulatory_bps)


def daily_accounts(weights: DataFrame, adv: DataFrame | None, cfg: CostConfig) -> DataFrame:
    """One row per path and day from (path_id, date, ticker, live, w, ret, traded, ...)."""
    if adv is None:
        rows = weights.withColumn("adv", F.lit(DEFAULT_ADV))
    else:
        rows = weights.join(adv.select("date", "ticker", "adv"), ["date", "ticker"], "left")
        rows = rows.withColumn("adv", F.coalesce("adv", F.lit(DEFAULT_ADV)))
    scale = F.col("cost_scale") if "cost_scale" in weights.columns else F.lit(1.0)
    delta = F.abs(F.col("w") - F.col("live"))
    cost = F.when(F.col("traded"), _scaled_cost(delta, F.col("adv"), scale, cfg)).otherwise(0.0)
    cash = F.sum(F.when(F.col("ticker") == "CASH", F.col("w")).otherwise(0.0))
    daily = rows.groupBy(*PATH_DAY).agg(
        F.sum(F.col("w") * F.col("ret")).alias("gross"),
        (0.5 * F.sum(delta)).alias("turnover"),
        F.sum(cost).alias("cost_bps"),
        F.bool_or("traded").alias("traded"),
        F.count(F.when(F.col("w") > 0.01, 1)).alias("n_active"),
        cash.alias("cash_weight"),
        F.sum(F.pow("w", 2)).alias("hhi"),
    )
    return daily.withColumn("net", F.col("gross") - F.col("cost_bps") / 10000)


def complete_signals(signals: DataFrame) -> DataFrame:
    """Every ticker of a path on every date of it, with weight 0 where a date leaves it out.

    Further columns (band, alpha, cost_scale) hold for a path as a whole.
    """
    # days of a path hold the same tickers if their number and the digests of their names agree
    name = F.xxhash64("ticker")
    days = signals.groupBy(*PATH_DAY).agg(
        F.count("*").alias("_n"), F.bit_xor(name).alias("_x"), F.sum(F.pmod(name, F.lit(1 << 31))).alias("_s")
    )
    apart = [F.min(c) != F.max(c) for c in ("_n", "_x", "_s")]
    if days.groupBy("path_id").agg((apart[0] | apart[1] | apart[2]).alias("_apart")).filter("_apart").isEmpty():
        return signals
    fixed = [c for c in signals.columns if c not in (*PATH_DAY, "ticker", "w")]
    days = signals.groupBy(*PATH_DAY).agg(*[F.first(c).alias(c) for c in fixed] or [F.count("*").alias("_n")])
    names = signals.select("path_id", "ticker").distinct()
    grid = days.join(names, "path_id").select(*PATH_DAY, "ticker", *fixed)
    known = signals.select(*PATH_DAY, "ticker", "w")
    return grid.join(known, [*PATH_DAY, "ticker"], "left").withColumn("w", F.coalesce("w", F.lit(0.0)))


def _with_returns(signals: DataFrame, returns: DataFrame) -> DataFrame:
    rows = complete_signals(signals).join(returns.select("date", "ticker", "ret"), ["date", "ticker"], "left")
    return rows.withColumn("ret", F.coalesce("ret", F.lit(0.0)))


# --- always trade, all the way --------------------------------------------------------
def full_weights(signals: DataFrame, returns: DataFrame) -> DataFrame:
    """Weights before (`live`) and after (`w`) trading when every day trades fully.

    The weights held before a trade are yesterday's target after yesterday's drift.
    """
    rows = _with_returns(signals, returns).withColumn("_g", F.col("w") * (1 + F.col("ret")))
    totals = rows.groupBy(*PATH_DAY).agg(F.sum("_g").alias("_total"), F.count("*").alias("_n"))
    days = Window.partitionBy("path_id").orderBy("date")
    totals = totals.withColumn("_last_total", F.lag("_total").over(days)).drop("_total")
    own = Window.partitionBy("path_id", "ticker").orderBy("date")
    rows = rows.withColumn("_last_g", F.lag("_g").over(own)).withColumn(
        "_last_w", F.lag("w").over(own)
    )
    drifted = F.when(
        F.col("_last_total") > 0, F.try_divide("_last_g", "_last_total")
    ).otherwise(F.col("_last_w"))
    return rows.join(totals, PATH_DAY).select(
        *PATH_DAY,
        "ticker",
        F.coalesce(drifted, 1 / F.col("_n")).alias("live"),
        "w",
        "ret",
        F.lit(True).alias("traded"),
    )


def backtest_full(
    signals: DataFrame,
    returns: DataFrame,
    adv: DataFrame | None = None,
    cfg: CostConfig = CostConfig(),
) -> tuple[DataFrame, DataFrame]:
    """(daily, weights) for band 0 and full trading."""
    weights = full_weights(signals, returns)
    return daily_accounts(weights, adv, cfg), weights


# --- band and partial trading ---------------------------------------------------------
def scenario_signals(signals: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One path per (signal path, scenario).

    `scenarios`: (scenario, band, alpha, cost_scale) and optionally `base_path` to restrict a
    scenario to one signal path. The scenarios of a path are attached as an array, so signal
    rows are repeated by a generator rather than a product of two tables.
    """
    columns = ["scenario", "band", "alpha", "cost_scale"]
    packed = F.sort_array(F.collect_list(F.struct(*columns)))
    if "base_path" in scenarios.columns:
        lookup = scenarios.groupBy(F.col("base_path").alias("path_id")).agg(packed.alias("_s"))
        rows = signals.join(lookup, "path_id")
    else:
        rows = signals.withColumn("_s", scenarios.agg(packed).scalar())
    rows = rows.withColumn("_s", F.explode("_s"))
    path = F.when(
        F.col("_s.scenario") == "", F.col("path_id")
    ).otherwise(F.concat_ws("|", F.col("path_id"), F.col("_s.scenario")))
    return rows.select(
        path.alias("path_id"),
        "date",
        "ticker",
        "w",
        F.col("_s.band").alias("band"),
        F.col("_s.alpha").alias("alpha"),
        F.col("_s.cost_scale").alias("cost_scale"),
    )


def single_scenario(df: DataFrame, cfg: ExecutionConfig = ExecutionConfig()) -> DataFrame:
    return df.withColumns(
        {
            "band": F.lit(cfg.rebalance_band),
            "alpha": F.lit(cfg.partial_rebalance_alpha),
            "cost_scale": F.lit(1.0),
        }
    )


_WEIGHT_SCHEMA = (
    "path_id string, date date, ticker string, live double, w double, ret double, "
    "cost_scale double, traded boolean"
)


def _rectangle(rows: pd.DataFrame) -> tuple[pd.DataFrame, int, int]:
    """Rows sorted by day then ticker, with the number of days and tickers."""
    ordered = rows.sort_values(["date", "ticker"], kind="stable")
    days, names = ordered["date"].nunique(), ordered["ticker"].nunique()
    if days * names != len(ordered):
        raise ValueError("a path must hold every ticker on every date")
    return ordered, days, names


def trade_and_drift(
    held: np.ndarray, target: np.ndarray, growth: np.ndarray, band: float, alpha: float
) -> tuple[bool, np.ndarray, np.ndarray]:
    """One day of a path: whether it trades, the weights after that, and those after the day's growth."""
    gap = target - held
    traded = 0.5 * np.abs(gap).sum() >= band
    if traded:
        held = np.maximum(held + alpha * gap, 0.0)
        total = held.sum()
        held = held / total if total > 0 else held
    grown = held * growth
    total = grown.sum()
    return traded, held, grown / total if total > 0 else held


def _run_path(rows: pd.DataFrame) -> pd.DataFrame:
    ordered, days, names = _rectangle(rows)
    target = ordered["w"].to_numpy().reshape(days, names)
    growth = 1.0 + ordered["ret"].to_numpy().reshape(days, names)
    band, alpha = ordered["band"].iloc[0], ordered["alpha"].iloc[0]
    before, after = np.empty((days, names)), np.empty((days, names))
    traded = np.zeros(days, dtype=bool)
    held = np.full(names, 1.0 / names)
    for day in range(days):
        before[day] = held
        traded[day], after[day], held = trade_and_drift(held, target[day], growth[day], band, alpha)
    out = ordered[["path_id", "date", "ticker", "ret", "cost_scale"]].copy()
    out["live"] = before.ravel()
    out["w"] = after.ravel()
    out["traded"] = np.repeat(traded, names)
    return out[["path_id", "date", "ticker", "live", "w", "ret", "cost_scale", "traded"]]


def _grouped_weights(rows: DataFrame) -> DataFrame:
    return spread(rows, "path_id").groupBy("path_id").applyInPandas(_run_path, _WEIGHT_SCHEMA)


_PARTIAL_SCHEMA = (
    "path_id string, date date, gap double, moved double, grown_trade double, grown_hold double"
)


def _block_recurrence(rows: pd.DataFrame):
    """Evolution of a block of tickers under a given schedule.

    Per day: whether it trades, the sum of the moved weights and the sum after the returns; a
    sum that is not positive divides nothing, and a day that ends with nothing keeps its weights.
    """
    ordered, days, names = _rectangle(rows)
    target = ordered["w"].to_numpy().reshape(days, names)
    growth = 1.0 + ordered["ret"].to_numpy().reshape(days, names)
    first = ordered.iloc[::names]
    alpha = ordered["alpha"].iloc[0]
    traded, total, scale = (first[c].to_numpy() for c in ("traded", "growth", "scale"))
    before, moved = np.empty((days, names)), np.empty((days, names))
    held = np.full(names, 1.0 / ordered["n_assets"].iloc[0])
    for day in range(days):
        before[day] = held
        moved[day] = np.maximum(held + alpha * (target[day] - held), 0.0)
        kept = held
        if traded[day]:
            kept = moved[day] / scale[day] if scale[day] > 0 else moved[day]
        held = kept * growth[day] / total[day] if total[day] > 0 else kept
    return ordered, target, growth, before, moved, traded, scale


def _block_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ordered, target, growth, before, moved, _, _ = _block_recurrence(rows)
    names = target.shape[1]
    return pd.DataFrame(
        {
            "path_id": ordered["path_id"].iloc[0],
            "date": ordered["date"].to_numpy()[::names],
            "gap": np.abs(target - before).sum(axis=1),
            "moved": moved.sum(axis=1),
            "grown_trade": (moved * growth).sum(axis=1),
            "grown_hold": (before * growth).sum(axis=1),
        }
    )


def _block_weights(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    ordered, target, _, before, moved, traded, scale = _block_recurrence(rows)
    divisor = np.where(scale > 0, scale, 1.0)[:, None]
    out = ordered[["path_id", "date", "ticker", "ret", "cost_scale", "traded"]].copy()
    out["live"] = before.ravel()
    out["w"] = np.where(traded[:, None], moved / divisor, before).ravel()
    return out[["path_id", "date", "ticker", "live", "w", "ret", "cost_scale", "traded"]]


def _split_weights(rows: DataFrame, tolerance: float = 1e-14) -> DataFrame:
    """Banded weights of paths of any size, split by ticker (see the module text)."""
    per_day = materialise(
        rows.groupBy(*PATH_DAY).agg(
            F.count("*").alias("n_assets"),
            F.sum(F.greatest("w", F.lit(0.0))).alias("scale"),
            F.first("band").alias("_band"),
            F.avg(1 + F.col("ret")).alias("growth"),
        )
    )
    largest = per_day.agg(F.max("n_assets")).first()[0] or 1
    blocks = max(1, -(-largest // TICKERS_PER_BLOCK))
    block = F.pmod(F.xxhash64("ticker"), F.lit(blocks))
    rows = materialise(rows.withColumn("_block", block))
    schedule = per_day.select(*PATH_DAY, F.lit(True).alias("traded"), "growth", "scale")
    fixed = per_day.select(*PATH_DAY, "n_assets", "_band")

    def tagged(plan: DataFrame) -> DataFrame:
        table = fixed.drop("_band").join(plan, PATH_DAY)
        return rows.join(table, PATH_DAY).groupBy("path_id", "_block")

    days = rows.select("date").distinct().count()
    for _ in range(days + 1):
        sums = (
            tagged(schedule)
            .applyInPandas(_block_sums, _PARTIAL_SCHEMA)
            .groupBy(*PATH_DAY)
            .agg(*[F.sum(c).alias(c) for c in ("gap", "moved", "grown_trade", "grown_hold")])
        )
        trades = 0.5 * F.col("gap") >= F.col("_band")
        grown = F.when(F.col("moved") > 0, F.col("grown_trade") / F.col("moved")).otherwise(F.col("grown_trade"))
        update = materialise(
            sums.join(fixed, PATH_DAY).select(
                *PATH_DAY,
                trades.alias("traded"),
                F.when(trades, grown).otherwise(F.col("grown_hold")).alias("growth"),
                F.col("moved").alias("scale"),
            )
        )
        old = schedule.select(
            *PATH_DAY, F.col("traded").alias("_t"), F.col("growth").alias("_g"), F.col("scale").alias("_s")
        )
        differs = lambda new, was: F.abs(F.col(new) - F.col(was)) > tolerance * F.abs(new)
        changed = (
            update.join(old, PATH_DAY)
            .filter((F.col("traded") != F.col("_t")) | differs("growth", "_g") | (F.col("traded") & differs("scale", "_s")))
            .limit(1)
            .count()
        )
        schedule = update
        if changed == 0:
            break
    return tagged(schedule).applyInPandas(_block_weights, _WEIGHT_SCHEMA)


def banded_weights(
    signals: DataFrame, returns: DataFrame, max_path_rows: int = MAX_PATH_ROWS
) -> DataFrame:
    """Weights before and after trading for signals with band, alpha and cost_scale."""
    rows = _with_returns(signals, returns)
    largest = signals.groupBy("path_id").count().agg(F.max("count")).first()[0] or 0
    if largest <= max_path_rows:
        return _grouped_weights(rows)
    return _split_weights(rows)


def backtest_banded(
    signals: DataFrame,
    returns: DataFrame,
    adv: DataFrame | None = None,
    cfg: CostConfig = CostConfig(),
    execution: ExecutionConfig = ExecutionConfig(),
    max_path_rows: int = MAX_PATH_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(daily, weights). Signals without band, alpha, cost_scale use `execution`."""
    if "band" not in signals.columns:
        signals = single_scenario(signals, execution)
    weights = banded_weights(signals, returns, max_path_rows)
    return daily_accounts(weights, adv, cfg), weights
