"""Per-asset rolling features.

All windows of one table share the specification `partition by ticker order by date`, so
Spark plans a single exchange and a single sort for the whole feature set. Lags are windows of Spark;
statistics of many rows come from `rolling`, and the families below read its columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.config import FeatureConfig
from quantpanel.functions.columns import (
    annualise,
    by_ticker,
    clip,
    null_count,
    ratio,
)
from quantpanel.operators.grid import day_table
from quantpanel.operators.rolling import Wanted, rolled, rolling

STATE_COLUMNS = ("prev_live_weight", "prev_target_weight", "delta_from_prev_target")


def change(value: str, rows: int) -> Column:
    return ratio(F.col(value), F.lag(value, rows).over(by_ticker())) - 1


def returns_rowlag(prices: DataFrame) -> DataFrame:
    """Simple and log return to the previous row of the ticker (spans gaps)."""
    growth = ratio(F.col("adj_close"), F.lag("adj_close", 1).over(by_ticker()))
    return prices.withColumn("_growth", growth).select(
        *prices.columns,
        (F.col("_growth") - 1).alias("simple_ret"),
        F.when(F.col("_growth") > 0, F.ln("_growth")).alias("log_ret"),
    )


def with_daily(prices: DataFrame) -> DataFrame:
    """Inputs of the rolling features: returns, negative returns, daily illiquidity.

    A missing return counts as 0 in `neg_ret`, so downside volatility fills its window one
    row earlier than volatility does.
    """
    rets = returns_rowlag(prices)
    extra = {
        "neg_ret": F.when(F.col("log_ret") < 0, F.col("log_ret")).otherwise(F.lit(0.0)),
    }
    if "dollar_volume" in prices.columns:
        extra["amihud_daily"] = ratio(
            F.abs("simple_ret"), clip(F.col("dollar_volume"), lower=1.0)
        )
    return rets.withColumns(extra)


def return_features(cfg: FeatureConfig) -> dict[str, Column]:
    return {f"ret_{w}": change("adj_close", w) for w in cfg.return_windows}


def vol_rolling(cfg: FeatureConfig) -> list[Wanted]:
    return [("std", w, "log_ret") for w in cfg.vol_windows]


def vol_features(cfg: FeatureConfig) -> dict[str, Column]:
    return {f"vol_{w}": annualise(rolled("std", w, "log_ret")) for w in cfg.vol_windows}


def downvol_rolling(cfg: FeatureConfig) -> list[Wanted]:
    return [("std", w, "neg_ret") for w in cfg.downvol_windows]


def downvol_features(cfg: FeatureConfig) -> dict[str, Column]:
    return {f"downvol_{w}": annualise(rolled("std", w, "neg_ret")) for w in cfg.downvol_windows}


def drawdown_rolling(cfg: FeatureConfig) -> list[Wanted]:
    return [("max", w, "adj_close") for w in cfg.dd_windows]


def drawdown_features(cfg: FeatureConfig) -> dict[str, Column]:
    price = F.col("adj_close")
    return {f"dd_{w}": ratio(price, rolled("max", w, "adj_close")) - 1 for w in cfg.dd_windows}


def momentum_features(cfg: FeatureConfig) -> dict[str, Column]:
    out = {f"mom_{w}": change("adj_close", w) for w in cfg.mom_windows}
    out["rev_5"] = -change("adj_close", 5)
    return out


def liquidity_rolling(cfg: FeatureConfig) -> list[Wanted]:
    return [("mean", w, "dollar_volume") for w in cfg.liquidity_windows]


def liquidity_features(cfg: FeatureConfig) -> dict[str, Column]:
    return {f"dollar_vol_{w}": rolled("mean", w, "dollar_volume") for w in cfg.liquidity_windows}


AMIHUD_ROLLING: list[Wanted] = [("mean", 20, "amihud_daily")]


def amihud_feature() -> dict[str, Column]:
    return {"amihud_20": rolled(*AMIHUD_ROLLING[0])}


ZSCORE_ROLLING: list[Wanted] = [(kind, 20, c) for c in ("volume", "dollar_volume") for kind in ("mean", "std")]


def zscore_features() -> dict[str, Column]:
    def zscore(name: str) -> Column:
        centred = F.col(name) - rolled("mean", 20, name)
        return centred / clip(rolled("std", 20, name), lower=1.0)

    return {"volume_zscore_20": zscore("volume"), "dollar_vol_zscore_20": zscore("dollar_volume")}


def asset_features(prices: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """All per-asset features keyed by (asof_date, ticker).

    `missing_feature_count` covers the computed features; the three portfolio-state columns
    are placeholders that a label run fills, and are counted in
    `missing_feature_count_with_state`.
    """
    lagged = return_features(cfg)
    shifted = momentum_features(cfg)
    features = {
        **{name: F.col(name) for name in lagged},
        **vol_features(cfg),
        **downvol_features(cfg),
        **drawdown_features(cfg),
        **{name: F.col(name) for name in shifted},
        **liquidity_features(cfg),
        **amihud_feature(),
        **zscore_features(),
    }
    wanted = [
        *vol_rolling(cfg),
        *downvol_rolling(cfg),
        *drawdown_rolling(cfg),
        *liquidity_rolling(cfg),
        *AMIHUD_ROLLING,
        *ZSCORE_ROLLING,
    ]
    needed = ["date", "ticker", "adj_close", "volume", "dollar_volume"]
    daily = with_daily(prices.select(*needed)).withColumns(lagged | shifted)
    table = rolling(daily, list(dict.fromkeys(wanted))).select(
        F.col("date").alias("asof_date"),
        "ticker",
        *[column.alias(name) for name, column in features.items()],
        *[F.lit(None).cast("double").alias(name) for name in STATE_COLUMNS],
    )
    missing = null_count(list(features))
    return table.withColumns(
        {
            "missing_feature_count": missing,
            "missing_feature_count_with_state": missing + len(STATE_COLUMNS),
        }
    )


def equal_weight_return(panel: DataFrame, ret: str = "simple_ret") -> DataFrame:
    """Cross-sectional mean return per date, nulls skipped."""
    return panel.groupBy("date").agg(F.avg(ret).alias("eqw_ret"))


def market_beta_corr(prices: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Beta, correlation and residual volatility against the equal-weight market.

    Every window pairs the asset's returns with the market returns of the same dates.
    """
    rets = returns_rowlag(prices.select("date", "ticker", "adj_close"))
    rows = rets.join(day_table(equal_weight_return(rets)), "date")
    # Only dates on which the asset itself has a return enter its market moments.
    rows = rows.select(
        "date", "ticker", F.col("simple_ret").alias("own"),
        F.when(F.col("simple_ret").isNotNull(), F.col("eqw_ret")).alias("paired"),
    )
    wanted = [("cov", w, "own", "paired") for w in (*cfg.beta_windows, *cfg.corr_windows, 60)]
    wanted += [("var", w, "paired") for w in cfg.beta_windows] + [("var", 60, "own")]
    wanted += [("std", w, c) for w in (*cfg.corr_windows, 60) for c in ("own", "paired")]
    rows = rolling(rows, list(dict.fromkeys(wanted)))

    def corr(w: int) -> Column:
        return ratio(rolled("cov", w, "own", "paired"), rolled("std", w, "own") * rolled("std", w, "paired"))

    out = {}
    for w in cfg.beta_windows:
        floor = F.greatest(rolled("var", w, "paired"), F.lit(1e-10))
        out[f"beta_eqw_{w}"] = rolled("cov", w, "own", "paired") / floor
    for w in cfg.corr_windows:
        out[f"corr_eqw_{w}"] = corr(w)
    residual = (1 - F.pow(corr(60), 2)) * rolled("var", 60, "own")
    out["idio_vol_60"] = annualise(F.sqrt(F.greatest(residual, F.lit(0.0))))
    out["idio_vol_60"] = F.when(residual.isNotNull(), out["idio_vol_60"])
    return rows.select(
        F.col("date").alias("asof_date"), "ticker", *[c.alias(n) for n, c in out.items()]
    )
