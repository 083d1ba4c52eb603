"""Deterministic weight tables on the type panel, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import UniverseConfig
from quantpanel.functions.storage import materialise
from quantpanel.operators.grid import calendar_of
from quantpanel.operators.portfolios import normalise
from quantpanel.operators.returns import adv20, returns_filled, returns_gap_zero
from quantpanel.registry.base import P1, grid
from quantpanel.sources import panels
from quantpanel.sources.universe import universe_members

N_CANDIDATES = 20


class LabelInputs:
    """Returns, universe, candidates and previous weights of the type panel.

    Each table is a stage output: it is stored when first used and read back afterwards, as
    between the steps of a real label run.
    """

    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def prices(self) -> DataFrame:
        return materialise(panels.prices_by_type(self.spark, self.sf_dir))

    @cached_property
    def returns(self) -> DataFrame:
        return materialise(returns_gap_zero(self.prices))

    @cached_property
    def filled(self) -> DataFrame:
        return materialise(returns_filled(self.prices))

    @cached_property
    def universe(self) -> DataFrame:
        return materialise(universe_members(self.prices, UniverseConfig()))

    @property
    def indexed(self) -> DataFrame:
        return self.returns.join(self.universe.select("ticker", "asset_idx"), "ticker")

    @cached_property
    def calendar(self) -> DataFrame:
        return materialise(calendar_of(self.prices))

    @cached_property
    def adv(self) -> DataFrame:
        return materialise(adv20(self.prices))

    @cached_property
    def candidates(self) -> DataFrame:
        return materialise(fixture_candidates(self.indexed, N_CANDIDATES))

    @cached_property
    def previous(self) -> DataFrame:
        return materialise(fixture_previous(self.indexed))

    def signals(self, n: int = 3) -> DataFrame:
        """The first n candidates as strategies."""
        return materialise(
            fixture_candidates(self.indexed, n).select(
                F.concat(F.lit("c"), F.col("cand_id").cast("string")).alias("path_id"),
                "date",
                "ticker",
                "w",
            )
        )


def fixture_candidates(indexed: DataFrame, n: int) -> DataFrame:
    """w_i proportional to 1 + (7 asset_idx + 13 cand_id + 3 day_idx) mod 23."""
    rows = indexed.select(
        "date",
        "day_idx",
        "ticker",
        "asset_idx",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("cand_id"),
    )
    raw = 1 + (7 * F.col("asset_idx") + 13 * F.col("cand_id") + 3 * F.col("day_idx")) % 23
    rows = rows.withColumn("w", raw.cast("double"))
    return normalise(rows, ["date", "cand_id"]).select(
        "date", "day_idx", "cand_id", F.lit("deterministic").alias("cand_type"), "ticker", "w"
    )


def fixture_previous(indexed: DataFrame) -> DataFrame:
    """Candidate 0 of the previous day; equal weight on the first."""
    sizes = indexed.groupBy("date").agg(F.count("*").alias("_n"))
    window = Window.partitionBy("ticker").orderBy("date")
    rows = fixture_candidates(indexed, 1).withColumn("_w", F.lag("w").over(window))
    return rows.join(sizes, "date").select(
        "date", "ticker", F.coalesce("_w", 1 / F.col("_n")).alias("w")
    )


BASE = f"""{P1}, {grid('p1')},
names AS (SELECT DISTINCT ticker FROM p1 UNION SELECT 'CASH'),
uni AS (SELECT ticker, row_number() OVER (ORDER BY ticker = 'CASH', ticker) - 1 AS asset_idx FROM names),
gz AS MATERIALIZED (SELECT g.date, g.day_idx, g.ticker,
    coalesce(adj_close / lag(adj_close) OVER (PARTITION BY g.ticker ORDER BY g.day_idx) - 1, 0.0) AS ret FROM grid0 g
  UNION ALL SELECT date, day_idx, 'CASH', 0.0 FROM cal),
gf AS MATERIALIZED (SELECT date, day_idx, ticker,
    coalesce(filled / lag(filled) OVER (PARTITION BY ticker ORDER BY day_idx) - 1, 0.0) AS ret FROM grid
  UNION ALL SELECT date, day_idx, 'CASH', 0.0 FROM cal),
adv AS MATERIALIZED (SELECT date, day_idx, ticker, avg(coalesce(dollar_volume, 0)) OVER (PARTITION BY ticker ORDER BY day_idx
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS adv FROM grid0
  UNION ALL SELECT date, day_idx, 'CASH', 1e12 FROM cal)"""


# One Gauss-Jordan step per asset; the matrices are positive definite, so no pivot search is needed.
MIN_VARIANCE = """px AS (SELECT g.date, g.day_idx, u.asset_idx + 1 AS i, ret FROM gf g JOIN uni u USING (ticker)),
  cv AS (SELECT a.date, a.i, b.i AS j, CASE WHEN a.day_idx >= 1 THEN covar_samp(CASE WHEN a.day_idx >= 1 THEN a.ret END, b.ret)
      OVER (PARTITION BY a.i, b.i ORDER BY a.day_idx ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) END AS c
    FROM px a JOIN px b ON a.day_idx = b.day_idx),
  mat AS MATERIALIZED (SELECT date, list(line ORDER BY i) AS a, count(*) AS n FROM (
    SELECT date, i, list_append(list(coalesce(CASE WHEN isfinite(c) THEN c END, 0) + CASE WHEN i = j THEN 1e-6 ELSE 0 END ORDER BY j), 1.0) AS line FROM cv GROUP BY 1, 2) GROUP BY 1),
  gauss AS (SELECT date, n, 1 AS k, a FROM mat UNION ALL
    SELECT date, n, k + 1, list_transform(range(1, n + 1), lambda i: list_transform(range(1, n + 2),
      lambda j: CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END)) FROM gauss WHERE k <= n),
  solved AS (SELECT date, unnest(range(1, n + 1)) AS i, unnest(list_transform(a, lambda x: greatest(x[n + 1], 0))) AS w FROM gauss WHERE k = n + 1)"""


def cand_sql(n: int, name: str = "cand") -> str:
    return f"""{name} AS MATERIALIZED (SELECT date, day_idx, cand_id, ticker,
    x / sum(x) OVER (PARTITION BY date, cand_id) AS w FROM (
      SELECT g.date, g.day_idx, c AS cand_id, g.ticker,
        CAST(1 + (7*asset_idx + 13*c + 3*g.day_idx) % 23 AS DOUBLE) AS x
      FROM gz g JOIN uni u ON u.ticker = g.ticker CROSS JOIN range({n}) t(c)))"""


PREV = """prev AS (SELECT date, ticker, coalesce(lag(w) OVER (PARTITION BY ticker ORDER BY date),
  1.0 / (SELECT count(*) FROM uni)) AS w FROM cand WHERE cand_id = 0)"""


def spread_sql(adv: str) -> str:
    return f"""(CASE WHEN {adv} >= 0 AND {adv} < 1e6 THEN 10.0 WHEN {adv} >= 1e6 AND {adv} < 1e7 THEN 5.0
      WHEN {adv} >= 1e7 AND {adv} < 1e20 THEN 2.0 ELSE 2.0 END)"""


def cost_sql(delta: str, adv: str, scale: str = "1.0") -> str:
    return f"""({delta} * {scale} * ({spread_sql(adv)} + 10.0 * sqrt({delta} * 1e6 / greatest({adv}, 1e5))))"""


LABEL_CTE = f"{BASE}, {cand_sql(N_CANDIDATES)}, {PREV}"
SCORES = f"""port AS (SELECT c.date, c.day_idx, c.cand_id, g.day_idx - c.day_idx AS k, sum(c.w * g.ret) AS p
    FROM cand c JOIN gz g ON g.ticker = c.ticker AND g.day_idx BETWEEN c.day_idx + 1 AND c.day_idx + 60
    GROUP BY 1, 2, 3, 4),
  hz AS (SELECT unnest([5, 20, 60]) AS horizon_h),
  perf AS (SELECT date, cand_id, horizon_h, avg(p) AS m, stddev_pop(p) AS s FROM port
    JOIN hz ON k <= horizon_h AND day_idx + horizon_h < (SELECT count(*) FROM cal) GROUP BY 1, 2, 3),
  trade AS (SELECT c.date, c.cand_id, 0.5 * sum(abs(c.w - p.w)) AS turnover,
    sum({cost_sql('abs(c.w - p.w)', 'a.adv')}) AS est_cost, sum(c.w * c.w) AS concentration_hhi
    FROM cand c JOIN prev p ON p.date = c.date AND p.ticker = c.ticker
    JOIN adv a ON a.date = c.date AND a.ticker = c.ticker GROUP BY 1, 2),
  score AS (SELECT date, horizon_h, cand_id, m / (s + 1e-8) AS objective_sharpe, m * 252 AS objective_return,
    s * sqrt(252.0) AS objective_vol, turnover, est_cost, concentration_hhi,
    m / (s + 1e-8) - 0.2 * turnover - est_cost / 10000 AS objective_total
    FROM perf JOIN trade USING (date, cand_id)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY date, horizon_h ORDER BY objective_total DESC, cand_id) - 1 AS rank,
    count(*) OVER (PARTITION BY date, horizon_h) AS num_candidates FROM score),
  topk AS (SELECT *, exp(objective_total / 0.1 - max(objective_total / 0.1) OVER (PARTITION BY date, horizon_h)) AS e
    FROM ranked WHERE rank < 5),
  blend AS (SELECT *, e / sum(e) OVER (PARTITION BY date, horizon_h) AS p FROM topk)"""
