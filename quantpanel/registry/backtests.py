"""Split, backtest, metric and robustness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantpanel.config import BUILTIN_PROFILES, ExecutionConfig, SplitConfig
from quantpanel.operators import backtest as bt
from quantpanel.operators import evaluate as ev
from quantpanel.operators import metrics as mt
from quantpanel.operators import splits
from quantpanel.operators.grid import calendar_of
from quantpanel.registry.base import P2, cal, query, r, rounded
from quantpanel.registry.features import p2
from quantpanel.registry.fixtures import MIN_VARIANCE, BASE, LabelInputs, cand_sql, cost_sql
from quantpanel.sources import panels

# Shorter walk-forward windows than the default so that the panel holds several folds.
WALK = SplitConfig(walkforward_train_years=2, purge_days=60)


def _static_sql(n_train: str, n_val: str, purge: int) -> str:
    return f"""n AS (SELECT count(*) AS n FROM cal),
  i AS (SELECT n, CAST(floor(n*{n_train}) AS BIGINT)-1 AS te,
    least(CAST(floor(n*{n_train}) AS BIGINT)-1+CAST(floor(n*{n_val}) AS BIGINT), n-1) AS ve FROM n),
  idx AS (SELECT 'train' AS split_name, 0 AS s, te AS e, least(te+{purge}, n-1) AS p FROM i
    UNION ALL SELECT 'val', te+{purge}+1, ve, least(ve+{purge}, n-1) FROM i WHERE te+{purge}+1 < n
    UNION ALL SELECT 'test', ve+{purge}+1, n-1, n-1 FROM i WHERE te+{purge}+1 < n AND ve+{purge}+1 < n),
  splits AS MATERIALIZED (SELECT split_name, a.date AS start_date, b.date AS end_date, b.date AS purge_start, c.date AS purge_end
    FROM idx JOIN cal a ON a.day_idx = s JOIN cal b ON b.day_idx = e JOIN cal c ON c.day_idx = p WHERE s <= e)"""


STATIC = _static_sql("0.70", "0.15", 120)
WALK_SQL = """n AS (SELECT count(*) AS n FROM cal),
  folds AS (SELECT k, k*252 AS o, n FROM n, range(1000) t(k) WHERE k*252 + 504+60+252+60+252 <= n),
  idx AS (SELECT 'walkforward_' || lpad(CAST(k AS VARCHAR), 2, '0') || '_train' AS split_name, o AS s, o+503 AS e, n FROM folds
    UNION ALL SELECT 'walkforward_' || lpad(CAST(k AS VARCHAR), 2, '0') || '_val', o+564, o+815, n FROM folds
    UNION ALL SELECT 'walkforward_' || lpad(CAST(k AS VARCHAR), 2, '0') || '_test', o+876, o+1127, n FROM folds),
  splits AS MATERIALIZED (SELECT split_name, a.date AS start_date, b.date AS end_date, b.date AS purge_start, c.date AS purge_end
    FROM idx JOIN cal a ON a.day_idx = s JOIN cal b ON b.day_idx = e JOIN cal c ON c.day_idx = least(e+60, n-1))"""


@query("S01_static_splits", f"WITH {P2}, {cal('p2')}, {STATIC} SELECT * FROM splits")
def _s01(spark, sf):
    return splits.static_splits(calendar_of(p2(spark, sf)))


@query("S02_walkforward_splits", f"WITH {P2}, {cal('p2')}, {WALK_SQL} SELECT * FROM splits")
def _s02(spark, sf):
    return splits.walkforward_splits(calendar_of(p2(spark, sf)), WALK)


@query(
    "S03_split_interval_rows",
    f"""WITH {P2}, {cal('p2')}, {STATIC} SELECT p2.date, ticker, {r('adj_close', 'adj_close')} FROM p2
      WHERE p2.date BETWEEN (SELECT start_date FROM splits WHERE split_name = 'test')
        AND (SELECT end_date FROM splits WHERE split_name = 'test')""",
)
def _s03(spark, sf):
    prices = p2(spark, sf)
    start, end = splits.split_interval(splits.static_splits(calendar_of(prices)), "test")
    rows = prices.filter(F.col("date").between(start, end))
    return rounded(rows.select("date", "ticker", "adj_close"))


@query(
    "S04_fold_rows",
    f"""WITH {P2}, {cal('p2')}, {WALK_SQL} SELECT regexp_extract(split_name, '^(walkforward_\\d+)_(.*)$', 1) AS fold,
      regexp_extract(split_name, '^(walkforward_\\d+)_(.*)$', 2) AS role, ticker, count(*) AS n_rows,
      min(date) AS first_date, max(date) AS last_date
    FROM p2 JOIN splits ON p2.date BETWEEN start_date AND end_date GROUP BY 1, 2, 3""",
)
def _s04(spark, sf):
    prices = p2(spark, sf)
    folds = splits.with_fold(splits.walkforward_splits(calendar_of(prices), WALK))
    names = folds.select("split_name", "fold", "role")
    tagged = splits.assign_split(prices.select("date", "ticker"), folds, "date").join(names, "split_name")
    return tagged.groupBy("fold", "role", "ticker").agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


# --- one-step rules -------------------------------------------------------------------
STEP = f"{BASE}, {cand_sql(2)}, a AS (SELECT * FROM cand WHERE cand_id = 0), b AS (SELECT * FROM cand WHERE cand_id = 1)"
EXEC = ExecutionConfig(rebalance_band=0.2, partial_rebalance_alpha=0.5)


def _pair(inputs):
    rows = inputs.signals(2)
    return (
        rows.filter(F.col("path_id") == "c0").drop("path_id"),
        rows.filter(F.col("path_id") == "c1").drop("path_id"),
    )


@query(
    "P01_execution_rule",
    f"""WITH {STEP}, j AS (SELECT a.date, a.ticker, a.w AS live, b.w AS t,
      0.5 * sum(abs(b.w - a.w)) OVER (PARTITION BY a.date) AS l1, greatest(a.w + 0.5 * (b.w - a.w), 0) AS m
      FROM a JOIN b ON a.date = b.date AND a.ticker = b.ticker)
    SELECT date, ticker, {r('live', 'live')}, {r('CASE WHEN l1 >= 0.2 THEN m / sum(m) OVER (PARTITION BY date) ELSE live END', 'w')},
      l1 >= 0.2 AS traded FROM j""",
)
def _p01(spark, sf):
    live, target = _pair(LabelInputs(spark, sf))
    return rounded(bt.execute(target, live, ["date"], EXEC))


@query(
    "P02_drift",
    f"""WITH {STEP} SELECT a.date, a.ticker, {r('w * (1 + ret) / sum(w * (1 + ret)) OVER (PARTITION BY a.date)', 'w')}
      FROM a JOIN gz USING (date, ticker)""",
)
def _p02(spark, sf):
    inputs = LabelInputs(spark, sf)
    weights, _ = _pair(inputs)
    return rounded(bt.drift(weights, inputs.returns, ["date"]).select("date", "ticker", "w"))


# --- full rebalancing -----------------------------------------------------------------
FULL = f"""{BASE}, {cand_sql(3)}, sig AS (SELECT 'c' || cand_id AS path_id, date, day_idx, ticker, w FROM cand),
  gr AS (SELECT s.*, ret, w * (1 + ret) AS g FROM sig s JOIN gf USING (date, ticker)),
  dr AS (SELECT *, g / sum(g) OVER (PARTITION BY path_id, date) AS d FROM gr),
  ex AS (SELECT path_id, date, ticker, w, ret, coalesce(lag(d) OVER (PARTITION BY path_id, ticker ORDER BY date),
    1.0 / count(*) OVER (PARTITION BY path_id, date)) AS live FROM dr)"""


def daily_sql(weights: str = "ex", name: str = "daily", traded: str = "true", scale: str = "1.0") -> str:
    return f"""{name} AS (SELECT path_id, date, sum(w * ret) AS gross, 0.5 * sum(abs(w - live)) AS turnover,
    CASE WHEN bool_or({traded}) THEN sum({cost_sql('abs(w - live)', 'CAST(1e8 AS DOUBLE)', scale)}) ELSE 0 END AS cost_bps,
    bool_or({traded}) AS traded, count(*) FILTER (w > 0.01) AS n_active,
    sum(CASE WHEN ticker = 'CASH' THEN w ELSE 0 END) AS cash_weight, sum(w * w) AS hhi FROM {weights} GROUP BY 1, 2),
  {name}_net AS (SELECT *, gross - cost_bps / 10000 AS net FROM {name})"""


_DAILY = ("gross", "turnover", "cost_bps", "cash_weight", "hhi", "net")
DAILY_SELECT = ", ".join(r(c, c) for c in _DAILY) + ", traded, n_active"


@query("P03_backtest_full", f"WITH {FULL}, {daily_sql()} SELECT path_id, date, {DAILY_SELECT} FROM daily_net")
def _p03(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(bt.backtest_full(inputs.signals(3), inputs.filled)[0])


@query(
    "P03_backtest_full_weights",
    f"WITH {FULL} SELECT path_id, date, ticker, {r('live', 'live')}, {r('w', 'w')} FROM ex",
)
def _p03w(spark, sf):
    inputs = LabelInputs(spark, sf)
    weights = bt.backtest_full(inputs.signals(3), inputs.filled)[1]
    return rounded(weights.select("path_id", "date", "ticker", "live", "w"))


# --- band and partial trading: a recursive query carries the live weights ---------------
def banded_sql(paths: str, name: str = "run") -> str:
    """`paths`: (path_id, day_idx, band, alpha, t DOUBLE[], g DOUBLE[]) with g = 1 + return."""
    return f"""st AS (SELECT *, len(t) AS n FROM {paths}),
  {name} AS (
    SELECT path_id, day_idx, live, w, l1 >= band AS traded,
      list_transform(list_zip(w, g), lambda x: x[1] * x[2]) AS grown FROM (
      SELECT *, CASE WHEN l1 >= band THEN list_transform(m, lambda x: x / list_sum(m)) ELSE live END AS w FROM (
        SELECT *, 0.5 * list_sum(list_transform(list_zip(t, live), lambda x: abs(x[1] - x[2]))) AS l1,
          list_transform(list_zip(t, live), lambda x: greatest(x[2] + alpha * (x[1] - x[2]), 0)) AS m FROM (
          SELECT *, list_transform(t, lambda x: 1.0 / n) AS live FROM st WHERE day_idx = 0)))
    UNION ALL
    SELECT path_id, day_idx, live, w, l1 >= band,
      list_transform(list_zip(w, g), lambda x: x[1] * x[2]) FROM (
      SELECT *, CASE WHEN l1 >= band THEN list_transform(m, lambda x: x / list_sum(m)) ELSE live END AS w FROM (
        SELECT *, 0.5 * list_sum(list_transform(list_zip(t, live), lambda x: abs(x[1] - x[2]))) AS l1,
          list_transform(list_zip(t, live), lambda x: greatest(x[2] + alpha * (x[1] - x[2]), 0)) AS m FROM (
          SELECT s.*, list_transform(r.grown, lambda x: x / list_sum(r.grown)) AS live
          FROM {name} r JOIN st s ON s.path_id = r.path_id AND s.day_idx = r.day_idx + 1))))"""


def scenario_paths_sql(scenarios: str, n: int = 3) -> str:
    """Paths of the first n candidates under each row of `scenarios`
    (scenario, band, alpha, cost_scale)."""
    return f"""{BASE}, {cand_sql(n)}, scen(scenario, band, alpha, cost_scale) AS (VALUES {scenarios}),
  vec AS (SELECT cand_id, day_idx, list(w ORDER BY asset_idx) AS t, list(1 + ret ORDER BY asset_idx) AS g
    FROM cand JOIN gf USING (date, day_idx, ticker) JOIN uni USING (ticker) GROUP BY 1, 2),
  paths AS (SELECT 'c' || cand_id || CASE WHEN scenario = '' THEN '' ELSE '|' || scenario END AS path_id,
    day_idx, band::DOUBLE AS band, alpha::DOUBLE AS alpha, cost_scale::DOUBLE AS cost_scale, t, g FROM vec CROSS JOIN scen)"""


BANDED_DAILY = f"""longw AS (SELECT r.path_id, r.day_idx, traded, unnest(live) AS live, unnest(w) AS w, unnest(g) - 1 AS ret,
    unnest(range(len(w))) AS asset_idx, cost_scale FROM run r JOIN paths p USING (path_id, day_idx)),
  ex AS (SELECT path_id, date, u.ticker, live, w, ret, traded, cost_scale FROM longw JOIN cal USING (day_idx) JOIN uni u USING (asset_idx)),
  {daily_sql(traded='traded', scale='cost_scale')}"""


def banded_query_sql(scenarios: str, select: str, n: int = 3, tail: str = "") -> str:
    return f"WITH RECURSIVE {scenario_paths_sql(scenarios, n)}, {banded_sql('paths')}, {BANDED_DAILY}{tail} {select}"


@query(
    "P04_backtest_banded",
    banded_query_sql("('', 0.1, 0.5, 1.0)", f"SELECT path_id, date, {DAILY_SELECT} FROM daily_net"),
)
def _p04(spark, sf):
    inputs = LabelInputs(spark, sf)
    rules = ExecutionConfig(0.1, 0.5)
    return rounded(bt.backtest_banded(inputs.signals(3), inputs.filled, execution=rules)[0])


METRIC_SQL = """cum AS (SELECT *, exp(sum(ln(1 + {x})) OVER (PARTITION BY path_id ORDER BY date)) AS c FROM {daily}),
  dd AS (SELECT *, c / max(c) OVER (PARTITION BY path_id ORDER BY date) - 1 AS draw FROM cum),
  sums AS (SELECT path_id, count(*) AS n_days, arg_max(c, date) AS cumr, stddev_pop({x}) AS sd, avg({x}) AS mu,
    sqrt(avg(least({x}, 0) * least({x}, 0))) AS down, min(draw) AS max_drawdown, avg(turnover) AS avg_turnover,
    avg(n_active) AS avg_active, avg(cash_weight) AS avg_cash, avg(hhi) AS hhi, count(*) FILTER (traded) AS n_trades
    FROM dd GROUP BY 1),
  metrics AS (SELECT *, cumr ** (1 / (n_days / 252.0)) - 1 AS cagr, sd * sqrt(252.0) AS ann_vol,
    mu / greatest(sd, 1e-10) * sqrt(252.0) AS sharpe, mu / greatest(down, 1e-10) * sqrt(252.0) AS sortino,
    (cumr ** (1 / (n_days / 252.0)) - 1) / greatest(abs(max_drawdown), 1e-10) AS calmar, cumr - 1 AS total_return FROM sums)"""
_METRIC_DOUBLES = [m for m in mt.METRICS if m not in ("n_trades", "n_days")]
METRIC_SELECT = ", ".join(r(m, m) for m in _METRIC_DOUBLES) + ", n_trades, n_days"


def metric_sql(daily: str = "daily_net", column: str = "net") -> str:
    return METRIC_SQL.format(daily=daily, x=column)


@query(
    "P05_portfolio_metrics",
    f"WITH {FULL}, {daily_sql()}, {metric_sql()} SELECT path_id, {METRIC_SELECT} FROM metrics",
)
def _p05(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(mt.portfolio_metrics(bt.backtest_full(inputs.signals(3), inputs.filled)[0]))


@query(
    "P05_portfolio_metrics_gross",
    f"WITH {FULL}, {daily_sql()}, {metric_sql(column='gross')} SELECT path_id, {METRIC_SELECT} FROM metrics",
)
def _p05g(spark, sf):
    inputs = LabelInputs(spark, sf)
    daily = bt.backtest_full(inputs.signals(3), inputs.filled)[0]
    return rounded(mt.portfolio_metrics(daily, net=False))


RULE_PATHS = f"""{BASE}, {cand_sql(2)}, vl AS (SELECT date, ticker, CASE WHEN day_idx >= 20 THEN stddev_pop(ret) OVER (PARTITION BY ticker
    ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252.0) END AS v FROM gz),
  hold AS (SELECT date, ticker, coalesce(exp(sum(ln(1 + ret)) OVER (PARTITION BY ticker ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1.0) AS g FROM gf),
  sig AS (SELECT 'equal_weight' AS path_id, date, ticker, 1.0 / count(*) OVER (PARTITION BY date) AS w FROM gz
    UNION ALL SELECT 'previous_hold', date, ticker, g / sum(g) OVER (PARTITION BY date) FROM hold
    UNION ALL SELECT 'inverse_volatility', date, ticker, i / sum(i) OVER (PARTITION BY date) FROM
      (SELECT date, ticker, 1.0 / greatest(coalesce(v, 1.0), 1e-8) AS i FROM vl)
    UNION ALL SELECT 'teacher_replay', date, ticker, w FROM cand WHERE cand_id = 1),
  paths AS (SELECT path_id, day_idx, 0.005::DOUBLE AS band, 0.5::DOUBLE AS alpha, 1.0::DOUBLE AS cost_scale,
    list(w ORDER BY asset_idx) AS t, list(1 + ret ORDER BY asset_idx) AS g
    FROM sig JOIN gf USING (date, ticker) JOIN uni USING (ticker) GROUP BY 1, 2)"""
ALL_PATHS = RULE_PATHS.replace("  sig AS (", f"""  {MIN_VARIANCE},
  sig AS (SELECT 'min_variance' AS path_id, date, ticker, w / sum(w) OVER (PARTITION BY date) AS w
    FROM solved JOIN uni ON uni.asset_idx + 1 = i UNION ALL """)


@query(
    "P06_baseline_suite",
    f"""WITH RECURSIVE {ALL_PATHS}, {banded_sql('paths')}, {BANDED_DAILY}, {metric_sql()}
    SELECT path_id, {METRIC_SELECT} FROM metrics""",
)
def _p06(spark, sf):
    inputs = LabelInputs(spark, sf)
    hard = inputs.candidates.filter(F.col("cand_id") == 1)
    signals = ev.baseline_signals(inputs.returns, inputs.filled, hard)
    return rounded(mt.portfolio_metrics(bt.backtest_banded(signals, inputs.filled)[0]))


@query(
    "P06_rule_baselines",
    f"""WITH RECURSIVE {RULE_PATHS}, {banded_sql('paths')}, {BANDED_DAILY}, {metric_sql()}
    SELECT path_id, {METRIC_SELECT} FROM metrics""",
)
def _p06_rules(spark, sf):
    """The baselines without the minimum-variance portfolio."""
    inputs = LabelInputs(spark, sf)
    hard = inputs.candidates.filter(F.col("cand_id") == 1)
    names = tuple(n for n in ev.BASELINES if n != "min_variance")
    signals = ev.baseline_signals(inputs.returns, inputs.filled, hard, names=names)
    return rounded(mt.portfolio_metrics(bt.backtest_banded(signals, inputs.filled)[0]))


def _banded_metrics(inputs, scenarios, signals=None):
    signals = inputs.signals(3) if signals is None else signals
    paths = bt.scenario_signals(signals, scenarios)
    return rounded(mt.portfolio_metrics(bt.backtest_banded(paths, inputs.filled)[0]))


_METRICS_FROM = f"SELECT path_id, {METRIC_SELECT} FROM metrics"


def robust_sql(scenarios: str) -> str:
    return banded_query_sql(scenarios, _METRICS_FROM, tail=f", {metric_sql()}")


COST_ROWS = "('cost_0.5x', 0.005, 0.5, 0.5), ('cost_1.0x', 0.005, 0.5, 1.0), ('cost_2.0x', 0.005, 0.5, 2.0)"


@query("V05_cost_stress", robust_sql(COST_ROWS))
def _v05(spark, sf):
    inputs = LabelInputs(spark, sf)
    return _banded_metrics(inputs, ev.cost_scenarios(spark))


SENS_ROWS = ", ".join(
    [f"('band_{b}', {b}, 0.5, 1.0)" for b in (0.01, 0.02, 0.05, 0.1)]
    + [f"('alpha_{a}', 0.005, {a}, 1.0)" for a in (0.25, 0.5, 0.75, 1.0)]
)


@query("V08_sensitivity", robust_sql(SENS_ROWS))
def _v08(spark, sf):
    inputs = LabelInputs(spark, sf)
    return _banded_metrics(inputs, ev.sensitivity_scenarios(spark))


PROFILE_ROWS = ", ".join(
    f"('{p.name}', {p.rebalance_band}, {p.partial_rebalance_alpha}, 1.0)" for p in BUILTIN_PROFILES
)


@query("L20_strategy_profiles", robust_sql(PROFILE_ROWS))
def _l20(spark, sf):
    inputs = LabelInputs(spark, sf)
    return _banded_metrics(inputs, ev.profile_scenarios(spark))


def _subset_sql(labels: str) -> str:
    """Banded paths over a labelled subset of the days, glued together; labels CTE: sub(day_idx, name)."""
    return f"""WITH RECURSIVE {BASE}, {cand_sql(3)}, {labels},
  ren AS (SELECT name, day_idx, row_number() OVER (PARTITION BY name ORDER BY day_idx) - 1 AS k,
    count(*) OVER (PARTITION BY name) AS n_sub FROM sub),
  vec AS (SELECT cand_id, day_idx, list(w ORDER BY asset_idx) AS t, list(1 + ret ORDER BY asset_idx) AS g
    FROM cand JOIN gf USING (date, day_idx, ticker) JOIN uni USING (ticker) GROUP BY 1, 2),
  paths AS (SELECT 'c' || cand_id || '|' || name AS path_id, k AS day_idx, vec.day_idx AS real_idx,
    0.005::DOUBLE AS band, 0.5::DOUBLE AS alpha, 1.0::DOUBLE AS cost_scale, t, g FROM vec JOIN ren USING (day_idx) WHERE n_sub >= 5),
  {banded_sql('paths')},
  longw AS (SELECT r.path_id, real_idx AS day_idx, traded, unnest(live) AS live, unnest(w) AS w, unnest(g) - 1 AS ret,
    unnest(range(len(w))) AS asset_idx, cost_scale FROM run r JOIN paths p USING (path_id, day_idx)),
  ex AS (SELECT path_id, date, u.ticker, live, w, ret, traded, cost_scale FROM longw JOIN cal USING (day_idx) JOIN uni u USING (asset_idx)),
  {daily_sql(traded='traded', scale='cost_scale')}, {metric_sql()} {_METRICS_FROM}"""


_REGIME = """vx AS (SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice)/9973 AS vix FROM orders
    WHERE o_orderpriority = '5-LOW' GROUP BY 1),
  vd AS (SELECT day_idx, vix FROM cal JOIN vx USING (date)),
  sub AS (SELECT day_idx, CASE WHEN vix >= (SELECT median(vix) FROM vd) THEN 'high_vix' ELSE 'low_vix' END AS name FROM vd)"""


@query("V06_vix_regimes", _subset_sql(_REGIME))
def _v06(spark, sf):
    inputs = LabelInputs(spark, sf)
    vix = panels.vix_series(spark, sf).select("date", F.col("value").alias("vix"))
    vix = vix.join(inputs.calendar.select("date"), "date", "left_semi")
    signals = ev.regime_signals(inputs.signals(3), vix)
    return rounded(mt.portfolio_metrics(bt.backtest_banded(signals, inputs.filled)[0]))


@query(
    "V07_half_split",
    _subset_sql(
        "sub AS (SELECT day_idx, CASE WHEN day_idx < n_days // 2 THEN 'first_half' ELSE 'second_half' END AS name FROM cal)"
    ),
)
def _v07(spark, sf):
    inputs = LabelInputs(spark, sf)
    signals = ev.half_signals(inputs.signals(3))
    return rounded(mt.portfolio_metrics(bt.backtest_banded(signals, inputs.filled)[0]))


_ROLL = "OVER (PARTITION BY path_id ORDER BY date ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


@query(
    "V09_report_series",
    f"""WITH {FULL}, {daily_sql()}, cum AS (SELECT *, exp(sum(ln(1 + net)) OVER (PARTITION BY path_id ORDER BY date)) AS c FROM daily_net)
    SELECT path_id, date, {r('c - 1', 'cumulative_return')},
      {r('c / max(c) OVER (PARTITION BY path_id ORDER BY date) - 1', 'drawdown')}, {r('turnover', 'turnover')},
      {r(f'CASE WHEN count(*) {_ROLL} = 60 THEN avg(net) {_ROLL} / greatest(stddev_pop(net) {_ROLL}, 1e-10) * sqrt(252.0) END', 'rolling_sharpe_60')}
    FROM cum""",
)
def _v09(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(mt.report_series(bt.backtest_full(inputs.signals(3), inputs.filled)[0]))


FOLD_METRICS = ("sharpe", "cagr", "max_drawdown", "avg_turnover", "total_return")


@query(
    "D11_fold_aggregate",
    f"""WITH {FULL}, {daily_sql()}, {metric_sql()}, u AS (UNPIVOT (SELECT path_id, {', '.join(FOLD_METRICS)} FROM metrics)
      ON {', '.join(FOLD_METRICS)} INTO NAME metric VALUE v)
    SELECT metric, {r('avg(v)', 'mean')}, {r('stddev_pop(v)', 'std')}, {r('min(v)', 'min')}, {r('max(v)', 'max')} FROM u GROUP BY 1""",
)
def _d11(spark, sf):
    inputs = LabelInputs(spark, sf)
    table = mt.portfolio_metrics(bt.backtest_full(inputs.signals(3), inputs.filled)[0])
    return rounded(mt.fold_aggregate(table, list(FOLD_METRICS)))


@query(
    "G06_leaderboard",
    f"""WITH {FULL}, {daily_sql()}, {metric_sql()} SELECT path_id,
      {', '.join(r(c, c) for c in ('sharpe', 'cagr', 'max_drawdown', 'avg_turnover', 'total_return'))} FROM metrics""",
)
def _g06(spark, sf):
    inputs = LabelInputs(spark, sf)
    table = mt.portfolio_metrics(bt.backtest_full(inputs.signals(3), inputs.filled)[0])
    return rounded(mt.leaderboard(table))
