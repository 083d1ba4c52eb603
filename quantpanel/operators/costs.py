"""Trading cost of moving from one weight table to another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.config import DEFAULT_ADV, CostConfig
from quantpanel.functions.columns import spread_bps, trade_cost_bps


def spread_lookup(adv: DataFrame, cfg: CostConfig = CostConfig()) -> DataFrame:
    return adv.withColumn("spread_bps", spread_bps(F.col("adv"), cfg))


def asset_costs(
    targets: DataFrame,
    previous: DataFrame,
    adv: DataFrame | None,
    keys: list[str],
    cfg: CostConfig = CostConfig(),
) -> DataFrame:
    """(keys, ticker, delta, cost_bps): what each asset's trade from `previous` to `targets` costs.

    Both tables hold (keys, ticker, w); a ticker missing on one side has weight 0 there.
    `adv` is keyed by (date, ticker) with `date` among the keys.
    """
    old = previous.select(*keys, "ticker", F.col("w").alias("_old"))
    rows = targets.select(*keys, "ticker", F.col("w").alias("_new"))
    rows = rows.join(old, [*keys, "ticker"], "full")
    if adv is not None:
        rows = rows.join(adv.select("date", "ticker", "adv"), ["date", "ticker"], "left")
    else:
        rows = rows.withColumn("adv", F.lit(None).cast("double"))
    delta = F.abs(F.coalesce("_new", F.lit(0.0)) - F.coalesce("_old", F.lit(0.0)))
    liquid = F.coalesce("adv", F.lit(DEFAULT_ADV))
    return rows.select(
        *keys, "ticker", delta.alias("delta"), trade_cost_bps(delta, liquid, cfg).alias("cost_bps")
    )


def trading_cost(
    targets: DataFrame,
    previous: DataFrame,
    adv: DataFrame | None,
    keys: list[str],
    cfg: CostConfig = CostConfig(),
) -> DataFrame:
    """(keys, cost_bps, turnover): the totals of `asset_costs`."""
    return asset_costs(targets, previous, adv, keys, cfg).groupBy(*keys).agg(
        F.sum("cost_bps").alias("cost_bps"), (0.5 * F.sum("delta")).alias("turnover")
    )
