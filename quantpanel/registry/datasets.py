"""Dataset, scorer, prediction and evaluation queries on the type panel."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F

from quantpanel.config import BUILTIN_PROFILES, ScorerConfig
from quantpanel.functions.storage import materialise, stage_folder
from quantpanel.operators import asset_features as af
from quantpanel.operators import backtest as bt
from quantpanel.operators import dataset as ds
from quantpanel.operators import evaluate as ev
from quantpanel.operators import market_features as mf
from quantpanel.operators import scorers as sc
from quantpanel.operators import splits as sp
from quantpanel.operators import teacher
from quantpanel.operators.candidates import weight_vectors
from quantpanel.operators.cross_features import universe_return
from quantpanel.operators.ranks import scaled_rank
from quantpanel.plans import research
from quantpanel.registry.backtests import FULL, STATIC, WALK, daily_sql
from quantpanel.registry.base import MACRO, query, r, rounded
from quantpanel.registry.features import ALL_SQL, SPECIAL
from quantpanel.registry.fixtures import LABEL_CTE, SCORES, LabelInputs
from quantpanel.registry.market import FAC_COLS, FACTORS, VIX, VIX_COLS, VIX_FEATURES
from quantpanel.sources import panels

FEATURES = tuple(ALL_SQL)
STATE = ds.STATE_FEATURES
SHARED = (*VIX_COLS, "eqw_universe_ret")
NAMES = (*FEATURES, *SHARED, *STATE)


class DatasetInputs(LabelInputs):
    """Label vectors made from the fixture candidates, and the feature tables around them."""

    @cached_property
    def n_assets(self) -> int:
        return self.universe.count()

    @cached_property
    def labels(self):
        """One JSON-vector label row per date: hard = candidate 1, soft = candidate 2.

        Every fourth date lacks its prediction date, every fifth its hard target.
        """
        wide = (
            self.candidates.filter(F.col("cand_id").isin(1, 2))
            .groupBy("date", "day_idx", "ticker")
            .agg(
                F.sum(F.when(F.col("cand_id") == 1, F.col("w"))).alias("hard"),
                F.sum(F.when(F.col("cand_id") == 2, F.col("w"))).alias("soft"),
            )
            .join(self.previous.select("date", "ticker", F.col("w").alias("live")), ["date", "ticker"])
        )
        names = {
            "live": "prev_live_weights_json",
            "hard": "hard_target_weights_json",
            "soft": "soft_target_weights_json",
        }
        rows = ds.weights_to_json(wide, self.universe, ["date", "day_idx"], names)
        days = self.calendar.select("date", "next_date")
        hard = F.col("hard_target_weights_json")
        return materialise(
            rows.join(days, "date").select(
                F.col("date").alias("asof_date"),
                F.when(F.col("day_idx") % 4 != 0, F.col("next_date")).alias("prediction_date"),
                names["live"],
                F.when(F.col("day_idx") % 5 != 0, hard).alias("hard_target_weights_json"),
                names["soft"],
                (0.05 + F.col("day_idx") % 7 * 0.5).alias("teacher_confidence"),
            )
        )

    @cached_property
    def market(self):
        return materialise(mf.vix_features(panels.vix_series(self.spark, self.sf_dir)).drop("series_id"))

    @cached_property
    def cross(self):
        return materialise(universe_return(self.prices))

    @cached_property
    def features(self):
        asset = af.asset_features(self.prices)
        state = ds.state_features(self.labels, self.universe, self.n_assets)
        return materialise(ds.feature_table(asset, state, self.universe, self.market, self.cross))

    @cached_property
    def splits(self):
        return materialise(sp.static_splits(self.calendar))

    @cached_property
    def prepared(self):
        data, _ = ds.prepare_dataset(
            self.features, self.labels, self.splits, self.universe, self.calendar, self.n_assets
        )
        return materialise(data)


LAB = f"""{LABEL_CTE}, lab AS MATERIALIZED (SELECT c1.date AS asof_date, c1.day_idx, c1.ticker, p.w AS live,
    CASE WHEN c1.day_idx % 5 <> 0 THEN c1.w END AS hard, c2.w AS soft,
    CASE WHEN c1.day_idx % 4 <> 0 THEN next_date END AS prediction_date, next_date,
    0.05 + c1.day_idx % 7 * 0.5 AS confidence
  FROM cand c1 JOIN cand c2 ON c2.date = c1.date AND c2.ticker = c1.ticker AND c2.cand_id = 2
  JOIN prev p ON p.date = c1.date AND p.ticker = c1.ticker JOIN cal ON cal.date = c1.date WHERE c1.cand_id = 1),
  state AS (SELECT asof_date, ticker, live AS prev_live_weight,
    coalesce(last_value(hard IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY asof_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      1.0 / (SELECT count(*) FROM uni)) AS prev_target_weight FROM lab),
  statef AS (SELECT *, prev_live_weight - prev_target_weight AS delta_from_prev_target FROM state)"""


# The index is a mean of cents divided by a constant: more digits keep it off rounding ties.
DIGITS = {**SPECIAL, **{c: 9 for c in VIX_COLS}}


def _cols(names, digits=6):
    return ", ".join(r(n, n, DIGITS.get(n, digits)) for n in names)


@query("T01_state_features", f"WITH {LAB} SELECT asof_date, ticker, {_cols(STATE)} FROM statef")
def _t01(spark, sf):
    inputs = DatasetInputs(spark, sf)
    return rounded(ds.state_features(inputs.labels, inputs.universe, inputs.n_assets))


FEATURE_TABLE = f"""{LAB}, {MACRO}, {VIX}, {VIX_FEATURES},
  daily AS (SELECT *, CASE WHEN log_ret < 0 THEN log_ret ELSE 0.0 END AS neg_ret,
    abs(simple_ret) / greatest(dollar_volume, 1.0) AS amihud FROM rets),
  feats AS (SELECT date AS asof_date, ticker, {', '.join(f'{e} AS {n}' for n, e in ALL_SQL.items())} FROM daily),
  eqw AS (SELECT date AS asof_date, avg(simple_ret) AS eqw_universe_ret FROM rets GROUP BY 1),
  ft AS (SELECT c.date AS asof_date, u.ticker, u.asset_idx, f.* EXCLUDE (asof_date, ticker), v.* EXCLUDE (asof_date),
      e.eqw_universe_ret, s.* EXCLUDE (asof_date, ticker)
    FROM cal c CROSS JOIN uni u LEFT JOIN feats f ON f.asof_date = c.date AND f.ticker = u.ticker
    LEFT JOIN vixf v ON v.asof_date = c.date LEFT JOIN eqw e ON e.asof_date = c.date
    LEFT JOIN statef s ON s.asof_date = c.date AND s.ticker = u.ticker)"""
_MISSING = " + ".join(f"CAST({n} IS NULL AS BIGINT)" for n in NAMES)


@query(
    "T02_feature_table",
    f"WITH {FEATURE_TABLE} SELECT asof_date, ticker, asset_idx, {_cols(NAMES)}, {_MISSING} AS missing_feature_count FROM ft",
)
def _t02(spark, sf):
    return rounded(DatasetInputs(spark, sf).features, **DIGITS)


TARGETS = f"""{LAB}, tg AS (SELECT asof_date, ticker, prediction_date, next_date, confidence, soft AS target_weight,
  ln(greatest(soft, 1e-8) / (1.0 / (SELECT count(*) FROM uni))) AS target_score FROM lab)"""


@query(
    "T03_target_table",
    f"WITH {TARGETS} SELECT asof_date, ticker, prediction_date, {_cols(('confidence', 'target_weight', 'target_score'))} FROM tg",
)
def _t03(spark, sf):
    inputs = DatasetInputs(spark, sf)
    return rounded(ds.target_table(inputs.labels, inputs.universe, inputs.n_assets))


@query(
    "T03_target_table_raw",
    f"WITH {TARGETS} SELECT asof_date, ticker, {r('target_weight', 'target_score')} FROM tg",
)
def _t03_raw(spark, sf):
    inputs = DatasetInputs(spark, sf)
    table = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets, "raw_weight")
    return rounded(table.select("asof_date", "ticker", "target_score"))


@query(
    "T04_prediction_dates",
    f"""WITH {TARGETS} SELECT asof_date, ticker, coalesce(prediction_date, next_date) AS prediction_date
    FROM tg WHERE coalesce(prediction_date, next_date) IS NOT NULL""",
)
def _t04(spark, sf):
    inputs = DatasetInputs(spark, sf)
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    rows = ds.resolve_prediction_dates(targets, inputs.calendar)
    return rows.select("asof_date", "ticker", "prediction_date")


PREPARED = f"""{FEATURE_TABLE}, {STATIC},
  tg AS (SELECT asof_date, ticker, coalesce(prediction_date, next_date) AS prediction_date, confidence, soft AS target_weight,
    ln(greatest(soft, 1e-8) / (1.0 / (SELECT count(*) FROM uni))) AS target_score FROM lab),
  tagged AS (SELECT ft.*, prediction_date, confidence, target_weight, target_score, split_name FROM ft
    JOIN tg USING (asof_date, ticker) JOIN splits ON asof_date BETWEEN start_date AND end_date WHERE prediction_date IS NOT NULL)"""


@query(
    "T05_split_assignment",
    f"WITH {PREPARED} SELECT split_name, asof_date, ticker FROM tagged",
)
def _t05(spark, sf):
    inputs = DatasetInputs(spark, sf)
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    merged = ds.merge_targets(inputs.features.select("asof_date", "ticker"), targets, inputs.calendar)
    return sp.assign_split(merged, inputs.splits).select("split_name", "asof_date", "ticker")


_MED = ", ".join(f"coalesce(median({n}), 0.0) AS md_{n}" for n in NAMES)
_FILL = ", ".join(f"coalesce({n}, md_{n}) AS {n}" for n in NAMES)
_STAT = ", ".join(f"avg({n}) AS mu_{n}, stddev_pop({n}) AS sd_{n}" for n in NAMES)
SCALED = f"""{PREPARED}, med AS (SELECT {_MED} FROM tagged WHERE split_name = 'train'),
  filled AS (SELECT asof_date, ticker, split_name, prediction_date, confidence, target_weight, target_score, {_FILL} FROM tagged, med),
  stat AS (SELECT {_STAT} FROM filled WHERE split_name = 'train')"""
_Z = ", ".join(
    r(f"({n} - mu_{n}) / CASE WHEN sd_{n} < 1e-8 THEN 1.0 ELSE sd_{n} END", n) for n in NAMES
)


@query(
    "T06_impute_and_scale",
    f"""WITH {SCALED} SELECT split_name, asof_date, ticker, {_Z},
      {r('greatest(least(confidence, 10.0), 0.1)', 'sample_weight')} FROM filled, stat""",
)
def _t06(spark, sf):
    rows = DatasetInputs(spark, sf).prepared
    return rounded(rows.select("split_name", "asof_date", "ticker", *NAMES, "sample_weight"))


@query(
    "T07_prepared_dataset",
    f"""WITH {SCALED} SELECT split_name, count(*) AS n_rows, count(DISTINCT asof_date) AS n_dates,
      min(asof_date) AS first_date, max(prediction_date) AS last_prediction,
      {r('avg(target_score)', 'mean_target')}, {r('avg(greatest(least(confidence, 10.0), 0.1))', 'mean_weight')},
      {', '.join(r(f'avg(({n} - mu_{n}) / CASE WHEN sd_{n} < 1e-8 THEN 1.0 ELSE sd_{n} END)', n) for n in NAMES)}
    FROM filled, stat GROUP BY 1""",
)
def _t07(spark, sf):
    rows = DatasetInputs(spark, sf).prepared
    return rounded(
        rows.groupBy("split_name").agg(
            F.count("*").alias("n_rows"),
            F.countDistinct("asof_date").alias("n_dates"),
            F.min("asof_date").alias("first_date"),
            F.max("prediction_date").alias("last_prediction"),
            F.avg("target_score").alias("mean_target"),
            F.avg("sample_weight").alias("mean_weight"),
            *[F.avg(n).alias(n) for n in NAMES],
        )
    )


# --- candidate-level dataset ----------------------------------------------------------
class UtilityInputs(DatasetInputs):
    @cached_property
    def scored(self):
        scores = teacher.score_candidates(
            self.candidates, self.returns, self.previous, self.adv, horizons=(20,)
        )
        return materialise(teacher.ranked_candidates(scores, 10))

    @cached_property
    def utility(self):
        """Kept candidates with shared features, weight vector and shape columns."""
        wanted = self.scored.select("date", "cand_id")
        held = self.candidates.join(wanted, ["date", "cand_id"])
        vectors = weight_vectors(held, self.universe, ["date", "cand_id"])
        rows = self.scored.join(vectors, ["date", "cand_id"]).withColumnRenamed("date", "asof_date")
        factors = mf.factor_features(panels.factor_table(self.spark, self.sf_dir))
        shared = ds.shared_features(self.market, factors)
        return materialise(ds.utility_dataset(rows, shared))


UTIL_SHARED = (*VIX_COLS, *FAC_COLS)
UTILITY = f"""{LABEL_CTE}, {SCORES}, {MACRO}, {VIX}, {VIX_FEATURES}, {FACTORS},
  shared AS (SELECT * FROM vixf FULL JOIN fac USING (asof_date)),
  shape AS (SELECT date, cand_id, max(CASE WHEN ticker = 'CASH' THEN w END) AS candidate_cash_weight,
    max(w) AS candidate_max_weight, count(*) FILTER (w > 0.01) AS candidate_active_positions FROM cand GROUP BY 1, 2),
  util AS (SELECT k.date AS asof_date, cand_id, rank, objective_total, turnover, est_cost, concentration_hhi,
    {', '.join(f'coalesce({n}, 0.0) AS {n}' for n in UTIL_SHARED)},
    candidate_cash_weight, candidate_max_weight, candidate_active_positions::DOUBLE AS candidate_active_positions
    FROM ranked k JOIN shape USING (date, cand_id) LEFT JOIN shared s ON s.asof_date = k.date WHERE horizon_h = 20 AND rank < 10)"""
_UTIL = ("objective_total", "turnover", "est_cost", "concentration_hhi", *UTIL_SHARED,
         "candidate_cash_weight", "candidate_max_weight", "candidate_active_positions")


@query("T08_utility_dataset", f"WITH {UTILITY} SELECT asof_date, cand_id, rank, {_cols(_UTIL)} FROM util")
def _t08(spark, sf):
    rows = UtilityInputs(spark, sf).utility
    return rounded(rows.select("asof_date", "cand_id", "rank", *_UTIL), **DIGITS)


# --- scorers --------------------------------------------------------------------------
LINEAR = ScorerConfig(kind="linear")
SMALL_TREES = ScorerConfig(max_depth=3, max_iter=12, learning_rate=0.1, patience=4)
RANK_TREES = ScorerConfig(kind="rank_gbm", max_depth=3, max_iter=12, learning_rate=0.1, patience=4)


def _weights(spark, sf, cfg):
    rows = DatasetInputs(spark, sf).prepared
    scorer = sc.fit_scorer(rows, list(NAMES), cfg)
    test = rows.filter(F.col("split_name") == "test")
    return rounded(scorer.weights(test).select("asof_date", "prediction_date", "ticker", "score", "w"))


def _ridge_sql(penalty: float = 0.01) -> str:
    """`beta`: coefficients of the weighted normal equations, the free intercept last."""
    names = [*(f"z_{n}" for n in NAMES), "1.0"]
    n = len(names)
    lines = []
    for i, a in enumerate(names):
        own = [f"sum(sw * {a} * {b})" + (f" + {penalty}" if i == j and j < n - 1 else "") for j, b in enumerate(names)]
        lines.append(f"[{', '.join([*own, f'sum(sw * {a} * target_score)'])}]")
    scaled = ", ".join(
        f"({c} - mu_{c}) / CASE WHEN sd_{c} < 1e-8 THEN 1.0 ELSE sd_{c} END AS z_{c}" for c in NAMES
    )
    return f"""{SCALED}, zs AS MATERIALIZED (SELECT asof_date, prediction_date, ticker, split_name, target_score,
    greatest(least(confidence, 10.0), 0.1) AS sw, {scaled} FROM filled, stat),
  gauss AS (SELECT 1 AS k, [{', '.join(lines)}] AS a FROM zs WHERE split_name = 'train' UNION ALL
    SELECT k + 1, list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 2}),
      lambda j: CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END)) FROM gauss WHERE k <= {n}),
  beta AS MATERIALIZED (SELECT list_transform(a, lambda x: x[{n + 1}]) AS b FROM gauss WHERE k = {n + 1})"""


_SCORE_SQL = f"list_dot_product([{', '.join(f'z_{n}' for n in NAMES)}, 1.0], b)"


@query(
    "M01_ridge_scorer",
    f"""WITH RECURSIVE {_ridge_sql()}, sc AS (SELECT asof_date, prediction_date, ticker, {_SCORE_SQL} AS score FROM zs, beta WHERE split_name = 'test'),
    e AS (SELECT *, exp((score - max(score) OVER (PARTITION BY asof_date)) / {LINEAR.temperature}) AS e FROM sc)
    SELECT asof_date, prediction_date, ticker, {r('score', 'score', 2)}, {r('e / sum(e) OVER (PARTITION BY asof_date)', 'w', 2)} FROM e""",
)
def _m01(spark, sf):
    return rounded(_weights(spark, sf, LINEAR), 2)  # the solvers agree to about seven digits


PENALTIES = (0.01, 1.0)


def _ridge_folds_sql() -> str:
    """`beta`: coefficients per walk-forward fold and penalty, by elimination."""
    names = [*(f"z_{n}" for n in NAMES), "1.0"]
    n = len(names)
    lines = []
    for i, a in enumerate(names):
        own = [f"sum(sw * {a} * {b})" + (" + penalty" if i == j and j < n - 1 else "") for j, b in enumerate(names)]
        lines.append(f"[{', '.join([*own, f'sum(sw * {a} * target_score)'])}]")
    one = _ridge_sql().split("gauss AS (")[0]
    return f"""{one}
  spans AS (SELECT 'walkforward_' || lpad(k::VARCHAR, 2, '0') AS fold, a.date AS s, b.date AS e FROM range(1000) t(k)
    JOIN cal a ON a.day_idx = k * 252 JOIN cal b ON b.day_idx = k * 252 + 503
    WHERE k * 252 + 504 + 60 + 252 + 60 + 252 <= (SELECT count(*) FROM cal)),
  gauss AS (SELECT fold, penalty, 1 AS k, [{', '.join(lines)}] AS a FROM zs JOIN spans ON asof_date BETWEEN s AND e,
    (SELECT unnest([{', '.join(map(str, PENALTIES))}])::DOUBLE AS penalty) GROUP BY fold, penalty UNION ALL
    SELECT fold, penalty, k + 1, list_transform(range(1, {n + 1}), lambda i: list_transform(range(1, {n + 2}),
      lambda j: CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END)) FROM gauss WHERE k <= {n}),
  beta AS (SELECT fold, penalty, list_transform(a, lambda x: x[{n + 1}]) AS b FROM gauss WHERE k = {n + 1})"""


@query(
    "M01_ridge_folds",
    f"""WITH RECURSIVE {_ridge_folds_sql()} SELECT fold, penalty, unnest([{', '.join(f"'{n}'" for n in NAMES)}, 'intercept']) AS feature,
      {r(f'unnest(b[:{len(NAMES) + 1}])', 'coefficient', 4)} FROM beta""",
)
def _m01_folds(spark, sf):
    """The scorers of all walk-forward folds and penalties from one job over the rows."""
    inputs = DatasetInputs(spark, sf)
    folds = sp.with_fold(sp.walkforward_splits(inputs.calendar, WALK)).filter("role = 'train'")
    rows = sp.assign_split(inputs.prepared.drop("split_name"), folds).join(folds.select("split_name", "fold"), "split_name")
    models = sc.fit_ridges(rows.withColumn("label", F.col("target_score")), list(NAMES), list(PENALTIES), ["fold"])
    table = [
        (fold, penalty, name, value)
        for (fold, penalty), model in models.items()
        for name, value in zip((*NAMES, "intercept"), (*model.weights, model.intercept))
    ]
    return rounded(spark.createDataFrame(table, "fold string, penalty double, feature string, coefficient double"), 4)


@query("M02_gbm_scorer")
def _m02(spark, sf):
    return _weights(spark, sf, SMALL_TREES)


@query("M03_rank_gbm_scorer")
def _m03(spark, sf):
    return _weights(spark, sf, RANK_TREES)


@query(
    "E18_cross_sectional_rank",
    f"""WITH {TARGETS} SELECT asof_date, t.ticker, {r('''CASE WHEN count(*) OVER (PARTITION BY asof_date) > 1 THEN
      (row_number() OVER (PARTITION BY asof_date ORDER BY target_score, asset_idx) - 1) / (count(*) OVER (PARTITION BY asof_date) - 1) ELSE 0.0 END''', 'rank_target')}
    FROM tg t JOIN uni u USING (ticker)""",
)
def _e18(spark, sf):
    inputs = DatasetInputs(spark, sf)
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    rows = targets.join(inputs.universe.select("ticker", "asset_idx"), "ticker")
    ranked = scaled_rank(rows, ["asof_date"], ["target_score", "asset_idx"], "rank_target")
    return rounded(ranked.select("asof_date", "ticker", "rank_target"))


@query(
    "M04_softmax_weights",
    f"""WITH {TARGETS}, s AS (SELECT asof_date, ticker, target_score / 0.3 AS s,
      CASE WHEN ticker = 'CASH' AND day(asof_date) % 2 = 0 THEN 0 ELSE 1 END AS m FROM tg),
    e AS (SELECT *, CASE WHEN m > 0 THEN exp(s - max(CASE WHEN m > 0 THEN s END) OVER (PARTITION BY asof_date)) ELSE 0 END AS e FROM s)
    SELECT asof_date, ticker, {r('e / sum(e) OVER (PARTITION BY asof_date)', 'w')} FROM e""",
)
def _m04(spark, sf):
    inputs = DatasetInputs(spark, sf)
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    closed = (F.col("ticker") == "CASH") & (F.dayofmonth("asof_date") % 2 == 0)
    rows = targets.withColumn("open", F.when(closed, 0).otherwise(1))
    out = teacher.softmax_weights(rows, 0.3, ["asof_date"], score="target_score", mask="open")
    return rounded(out.select("asof_date", "ticker", "w"))


@query("M05_feature_importance")
def _m05(spark, sf):
    rows = DatasetInputs(spark, sf).prepared
    linear = sc.feature_importance(sc.fit_scorer(rows, list(NAMES), LINEAR), spark)
    trees = sc.feature_importance(sc.fit_scorer(rows, list(NAMES), SMALL_TREES), spark)
    named = linear.withColumnRenamed("importance", "linear")
    return rounded(named.join(trees.withColumnRenamed("importance", "gbm"), "feature"))


@query(
    "G05_top_features",
    f"""WITH RECURSIVE {_ridge_sql()}, f AS (SELECT unnest([{', '.join(f"'{n}'" for n in NAMES)}]) AS feature, unnest(b[:{len(NAMES)}]) AS c FROM beta)
    SELECT feature, {r('abs(c)', 'importance', 5)} FROM f ORDER BY abs(c) DESC, feature LIMIT 20""",
)
def _g05(spark, sf):
    rows = DatasetInputs(spark, sf).prepared
    scorer = sc.fit_scorer(rows, list(NAMES), LINEAR)
    return rounded(sc.top_features(sc.feature_importance(scorer, spark), 20), 5)


@query("M06_utility_scorer")
def _m06(spark, sf):
    inputs = UtilityInputs(spark, sf)
    scored = research.utility_predictions(
        inputs.utility, inputs.splits, list(UTIL_SHARED), inputs.n_assets, SMALL_TREES
    )
    return rounded(scored.select("asof_date", "cand_id", "rank", "split_name", "objective_total", "pred"))


@query(
    "M07_utility_rerank",
    f"""WITH {UTILITY}, b AS (SELECT asof_date AS date, arg_max(cand_id, (-turnover, -rank)) AS cand_id FROM util GROUP BY 1)
    SELECT b.date, b.cand_id, ticker, {r('w', 'w')} FROM b JOIN cand USING (date, cand_id)""",
)
def _m07(spark, sf):
    """Reranking given predictions; here the prediction is minus the turnover."""
    inputs = UtilityInputs(spark, sf)
    best = sc.best_predicted(inputs.scored.withColumn("pred", -F.col("turnover")))
    picked = best.select("date", "cand_id").join(inputs.candidates, ["date", "cand_id"])
    return rounded(picked.select("date", "cand_id", "ticker", "w"))


@query(
    "M08_ranking_metrics",
    f"""WITH {UTILITY}, s AS (SELECT asof_date AS date, cand_id, objective_total AS truth, round(turnover, 2) AS pred FROM util),
    a AS (SELECT *, rank() OVER (ORDER BY pred) + (count(*) OVER (PARTITION BY pred) - 1) / 2.0 AS rp,
      rank() OVER (ORDER BY truth) + (count(*) OVER (PARTITION BY truth) - 1) / 2.0 AS rt FROM s),
    pairs AS (SELECT x.date, sum(sign(x.pred - y.pred) * sign(x.truth - y.truth)) AS c,
      count(*) FILTER (x.pred <> y.pred) AS np, count(*) FILTER (x.truth <> y.truth) AS nt
      FROM s x JOIN s y ON x.date = y.date AND x.cand_id < y.cand_id GROUP BY 1),
    k AS (SELECT avg(c / sqrt(np * nt)) AS kendall FROM pairs WHERE np * nt > 0),
    o AS (SELECT date, row_number() OVER (PARTITION BY date ORDER BY truth DESC, cand_id) AS a,
      row_number() OVER (PARTITION BY date ORDER BY pred DESC, cand_id) AS b, count(*) OVER (PARTITION BY date) AS n FROM s),
    q AS (SELECT date, count(*) FILTER (a <= greatest(1, n // 5) AND b <= greatest(1, n // 5)) / max(greatest(1, n // 5)) AS recall FROM o GROUP BY 1)
    SELECT {r('(SELECT corr(rp, rt) FROM a)', 'spearman')}, {r('(SELECT kendall FROM k)', 'kendall')},
      {r('(SELECT avg(recall) FROM q)', 'top_k_recall')}""",
)
def _m08(spark, sf):
    rows = UtilityInputs(spark, sf).scored.select(
        "date", "cand_id", F.col("objective_total").alias("truth"), F.round("turnover", 2).alias("pred")
    )
    return rounded(ev.ranking_metrics(rows, ["date"], "cand_id"))


@query("M09_select_by_sharpe")
def _m09(spark, sf):
    inputs = DatasetInputs(spark, sf)
    grid = sc.parameter_grid(LINEAR, ridge=(0.01, 1.0), temperature=(0.3, 1.0, 3.0))
    table, _ = sc.select_by_sharpe(inputs.prepared, list(NAMES), inputs.filled, grid)
    return rounded(table)


SIGNAL = f"""{TARGETS}, s AS (SELECT asof_date AS date, ticker, exp(target_score / 0.3) / sum(exp(target_score / 0.3)) OVER (PARTITION BY asof_date) AS w FROM tg)"""


def _softmax_targets(inputs):
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    rows = teacher.softmax_weights(targets, 0.3, ["asof_date"], score="target_score")
    return rows.withColumnRenamed("asof_date", "date")


@query(
    "M10_prediction_summary",
    f"""WITH {SIGNAL}, k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY w DESC, ticker) AS rn FROM s)
    SELECT date, {r('sum(w)', 'total_weight')}, count(*) FILTER (w > 0.01) AS n_active, {r('sum(w * w)', 'hhi')},
      {r('sum(w) FILTER (rn <= 3)', 'top_weight')} FROM k GROUP BY 1""",
)
def _m10(spark, sf):
    return rounded(sc.prediction_summary(_softmax_targets(DatasetInputs(spark, sf)), 3))


def _context_sql() -> str:
    """Scaled features of the test dates with an equally weighted portfolio as context."""
    equal = "1.0 / (SELECT count(*) FROM uni)"
    given = {"prev_live_weight": equal, "prev_target_weight": equal, "delta_from_prev_target": "0.0"}
    columns = ", ".join(
        f"({given.get(n, f'coalesce({n}, md_{n})')} - mu_{n}) / CASE WHEN sd_{n} < 1e-8 THEN 1.0 ELSE sd_{n} END AS z_{n}"
        for n in NAMES
    )
    return f"""ctx AS (SELECT asof_date, ticker, {columns} FROM ft JOIN splits ON asof_date BETWEEN start_date AND end_date, med, stat
    WHERE split_name = 'test')"""


_BATCH_SQL = f"""WITH RECURSIVE {_ridge_sql()}, {_context_sql()}, sc AS (SELECT asof_date AS date, ticker, {_SCORE_SQL} AS score FROM ctx, beta),
    e AS (SELECT *, exp((score - max(score) OVER (PARTITION BY date)) / {LINEAR.temperature}) AS e FROM sc)
    SELECT date, ticker, {r('e / sum(e) OVER (PARTITION BY date)', 'w', 2)} FROM e"""


@query("M10_stored_scorer", _BATCH_SQL)
def _m10_stored(spark, sf):
    """As M10_batch_prediction, through a scorer that was stored and loaded."""
    inputs = DatasetInputs(spark, sf)
    weights = research.predict_dates(
        inputs.features, inputs.labels, inputs.splits, inputs.universe, inputs.calendar,
        inputs.n_assets, LINEAR, path=f"{stage_folder(spark)}/scorer-{uuid.uuid4().hex}",
    )
    return rounded(weights.select("date", "ticker", "w"), 2)


@query("M10_batch_prediction", _BATCH_SQL)
def _m10_model(spark, sf):
    """Fit on the train rows, predict every test date with equal-weight portfolio context."""
    inputs = DatasetInputs(spark, sf)
    weights = research.predict_dates(
        inputs.features, inputs.labels, inputs.splits, inputs.universe, inputs.calendar,
        inputs.n_assets, LINEAR,
    )
    return rounded(weights.select("date", "ticker", "w"), 2)


# --- prediction quality ---------------------------------------------------------------
PAIRED = f"{LABEL_CTE}, pr AS (SELECT c1.date, c1.ticker, c1.w AS pred, c2.w AS target FROM cand c1 JOIN cand c2 ON c2.date = c1.date AND c2.ticker = c1.ticker AND c2.cand_id = 2 WHERE c1.cand_id = 1)"
_Q = "greatest(least(pred, 1.0), 1e-8)"
_P = "greatest(least(target, 1.0), 1e-8)"


def _paired(inputs):
    wide = inputs.candidates.filter(F.col("cand_id").isin(1, 2))
    return wide.groupBy("date", "ticker").agg(
        F.sum(F.when(F.col("cand_id") == 1, F.col("w"))).alias("pred"),
        F.sum(F.when(F.col("cand_id") == 2, F.col("w"))).alias("target"),
    )


@query(
    "V01_prediction_metrics",
    f"""WITH {PAIRED}, d AS (SELECT date, sum({_P} * ln({_P} / {_Q})) AS kl FROM pr GROUP BY 1),
    c AS (SELECT date, abs(pred - lag(pred) OVER (PARTITION BY ticker ORDER BY date)) AS ch FROM pr),
    l AS (SELECT date, sum(ch) AS l1 FROM c WHERE ch IS NOT NULL GROUP BY 1)
    SELECT {r('(SELECT avg(kl) FROM d)', 'kl_divergence')}, {r('avg(abs(pred - target))', 'mae')},
      {r('sqrt(avg((pred - target) * (pred - target)))', 'rmse')}, {r('(SELECT avg(l1) FROM l)', 'weight_stability')} FROM pr""",
)
def _v01(spark, sf):
    return rounded(ev.prediction_metrics(_paired(LabelInputs(spark, sf))))


@query(
    "V02_entropy_and_change",
    f"""WITH {PAIRED}, c AS (SELECT date, pred, target, pred - lag(pred) OVER (PARTITION BY ticker ORDER BY date) AS ch FROM pr)
    SELECT date, {r(f'-sum(target * ln({_Q}))', 'cross_entropy')}, {r('coalesce(sum(ch * ch), 0.0)', 'change_penalty')} FROM c GROUP BY 1""",
)
def _v02(spark, sf):
    rows = _paired(LabelInputs(spark, sf))
    errors = ev.daily_prediction_errors(rows).select("date", "cross_entropy")
    changes = ev.daily_change(rows).select("date", "change_penalty")
    return rounded(errors.join(changes, "date", "left").fillna(0.0, ["change_penalty"]))


@query("V03_holdout_evaluation")
def _v03(spark, sf):
    inputs = DatasetInputs(spark, sf)
    scorer = sc.fit_scorer(inputs.prepared, list(NAMES), LINEAR)
    return rounded(research.evaluate_holdout(scorer, inputs.prepared, inputs.filled))


@query("V04_walkforward_evaluation")
def _v04(spark, sf):
    inputs = DatasetInputs(spark, sf)
    folds = sp.walkforward_splits(inputs.calendar, WALK)
    metrics = research.evaluate_walkforward(
        inputs.features, inputs.labels, folds, inputs.universe, inputs.calendar, inputs.n_assets,
        inputs.filled, LINEAR,
    )
    return rounded(metrics)


@query("P07_benchmark_table")
def _p07(spark, sf):
    """Five baselines, five learned variants and the candidate rerank."""
    inputs = UtilityInputs(spark, sf)
    profiles = {p.name: p for p in BUILTIN_PROFILES}
    variants = {
        "gbm_neutral": (SMALL_TREES, profiles["neutral"]),
        "gbm_aggressive": (SMALL_TREES, profiles["aggressive"]),
        "gbm_conservative": (SMALL_TREES, profiles["conservative"]),
        "rank_gbm_neutral": (RANK_TREES, profiles["neutral"]),
        "linear_neutral": (LINEAR, profiles["neutral"]),
    }
    days = inputs.prepared.filter(F.col("split_name") == "test").select(
        F.col("asof_date").alias("date"), "prediction_date"
    ).distinct()
    rerank = research.utility_signals(
        inputs.utility, inputs.candidates, inputs.splits, list(UTIL_SHARED), inputs.n_assets,
        days, SMALL_TREES,
    )
    hard = inputs.candidates.filter(F.col("cand_id") == 1)
    table = research.benchmark(
        inputs.prepared, list(NAMES), inputs.returns, inputs.filled, hard, variants, rerank
    )
    return rounded(table)


# --- drift and attribution ------------------------------------------------------------
_LONG_SQL = " UNION ALL ".join(
    f"SELECT split_name, '{n}' AS feature, {n} AS v FROM tagged" for n in FEATURES
)


@query(
    "V10_feature_drift",
    f"""WITH {PREPARED}, l AS ({_LONG_SQL}),
    m AS (SELECT split_name, feature, avg(v) AS mean, stddev_pop(v) AS std, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS null_share FROM l GROUP BY 1, 2)
    SELECT m.split_name, m.feature, {r('m.mean', 'mean')}, {r('m.std', 'std')}, {r('m.null_share', 'null_share')},
      {r('(m.mean - b.mean) / b.std', 'mean_shift')}, {r('m.std / b.std', 'std_ratio')}
    FROM m JOIN m b ON b.feature = m.feature AND b.split_name = 'train' WHERE m.split_name <> 'train'""",
)
def _v10(spark, sf):
    inputs = DatasetInputs(spark, sf)
    targets = ds.target_table(inputs.labels, inputs.universe, inputs.n_assets)
    tagged = sp.assign_split(ds.merge_targets(inputs.features, targets, inputs.calendar), inputs.splits)
    return rounded(ev.feature_drift(tagged, list(FEATURES)))


@query(
    "V10_asset_attribution",
    f"""WITH {FULL}, t AS (SELECT path_id, ticker, avg(w) AS avg_weight, sum(abs(w - live)) AS traded_weight FROM ex GROUP BY 1, 2)
    SELECT path_id, ticker, {r('avg_weight', 'avg_weight')}, {r('traded_weight', 'traded_weight')},
      {r('traded_weight / sum(traded_weight) OVER (PARTITION BY path_id)', 'turnover_share')} FROM t""",
)
def _v10_assets(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(ev.asset_attribution(bt.backtest_full(inputs.signals(3), inputs.filled)[1]))


@query(
    "V10_regime_attribution",
    f"""WITH {FULL}, {daily_sql()}, {MACRO}, vd AS (SELECT date, value AS vix FROM macro JOIN cal USING (date) WHERE series_id = '5-LOW'),
    g AS (SELECT date, CASE WHEN vix >= (SELECT median(vix) FROM vd) THEN 'high_vix' ELSE 'low_vix' END AS regime FROM vd)
    SELECT path_id, regime, count(*) AS n_days, {r('avg(net)', 'mean_net', 9)}, {r('sum(net)', 'total_net')}, {r('avg(turnover)', 'avg_turnover')}
    FROM daily_net JOIN g USING (date) GROUP BY 1, 2""",
)
def _v10_regimes(spark, sf):
    inputs = LabelInputs(spark, sf)
    vix = panels.vix_series(spark, sf).select("date", F.col("value").alias("vix"))
    vix = vix.join(inputs.calendar.select("date"), "date", "left_semi")
    daily = bt.backtest_full(inputs.signals(3), inputs.filled)[0]
    return rounded(ev.regime_attribution(daily, vix), mean_net=9)


@query(
    "V10_order_correlation",
    f"""WITH {PAIRED}, k AS (SELECT date, rank() OVER (PARTITION BY date ORDER BY pred) + (count(*) OVER (PARTITION BY date, pred) - 1) / 2.0 AS a,
      rank() OVER (PARTITION BY date ORDER BY target) + (count(*) OVER (PARTITION BY date, target) - 1) / 2.0 AS b FROM pr)
    SELECT date, {r('covar_pop(a, b) / nullif(stddev_pop(a) * stddev_pop(b), 0)', 'spearman')} FROM k GROUP BY 1""",
)
def _v10_order(spark, sf):
    rows = _paired(LabelInputs(spark, sf))
    return rounded(ev.ordering_correlation(rows, "pred", "target", ["date"]))
