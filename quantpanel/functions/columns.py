"""Small column expressions. All stay inside the JVM and are safe with ANSI mode on."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from quantpanel.config import TRADING_DAYS_PER_YEAR, CostConfig


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null instead of an error on a zero denominator."""
    return F.try_divide(numerator, denominator)


def clip(value: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Clamp to [lower, upper]; null stays null (greatest/least alone would drop it)."""
    out = value
    if lower is not None:
        out = F.greatest(out, F.lit(float(lower)))
    if upper is not None:
        out = F.least(out, F.lit(float(upper)))
    return F.when(value.isNotNull(), out)


def finite_or_zero(value: Column) -> Column:
    """Null, NaN and infinities become 0."""
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(bad, F.lit(0.0)).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def annualise(value: Column) -> Column:
    return value * F.sqrt(F.lit(float(TRADING_DAYS_PER_YEAR)))


def by_ticker(*extra: str, order: str = "date") -> WindowSpec:
    """Time order inside a ticker.

    A panel holds one row per (date, ticker), so a partition never exceeds the number of
    calendar days however large the table is.
    """
    return Window.partitionBy(*extra, "ticker").orderBy(order)


def trailing(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(-(rows - 1), 0)


def when_full(window: WindowSpec, rows: int, value: Column, result: Column) -> Column:
    """`result` only where the trailing window holds `rows` non-null values."""
    return F.when(F.count(value).over(trailing(window, rows)) == rows, result)


def rolling_std(window: WindowSpec, rows: int, value: Column) -> Column:
    return when_full(window, rows, value, F.stddev_samp(value).over(trailing(window, rows)))


def rolling_mean(window: WindowSpec, rows: int, value: Column) -> Column:
    return when_full(window, rows, value, F.avg(value).over(trailing(window, rows)))


def rolling_max(window: WindowSpec, rows: int, value: Column) -> Column:
    return when_full(window, rows, value, F.max(value).over(trailing(window, rows)))


def null_count(columns: list[str]) -> Column:
    """Number of nulls among the given columns of a row."""
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns], F.lit(0))


def spread_bps(adv: Column, cost: CostConfig) -> Column:
    """Step lookup on half-open buckets [min, max)."""
    out = F.lit(float(cost.default_spread_bps))
    for bucket in reversed(cost.buckets):
        inside = (adv >= bucket.adv_min) & (adv < bucket.adv_max)
        out = F.when(inside, F.lit(float(bucket.spread_bps))).otherwise(out)
    return out


def trade_cost_bps(delta: Column, adv: Column, cost: CostConfig) -> Column:
    """Cost in bps contributed by a weight change `delta` (>= 0) of one asset."""
    notional = delta * F.lit(cost.portfolio_value)
    impact = F.lit(cost.impact_coeff) * F.sqrt(notional / F.greatest(adv, F.lit(cost.adv_floor)))
    fixed = F.lit(cost.commission_bps + cost.regulatory_bps)
    return delta * (fixed + spread_bps(adv, cost) + impact)


def parse_weights(raw: Column) -> Column:
    return F.from_json(raw, "array<double>")


def fit_weights(vector: Column, n_assets: int) -> Column:
    """Pad with zeros or cut to the universe size; a missing vector means equal weight."""
    padded = F.slice(F.concat(vector, F.array_repeat(F.lit(0.0), n_assets)), 1, n_assets)
    return F.coalesce(padded, F.array_repeat(F.lit(1.0 / max(n_assets, 1)), n_assets))


def array_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def dot(left: Column, right: Column) -> Column:
    return array_sum(F.zip_with(left, right, lambda a, b: a * b))
