"""Portfolio, cost, candidate and label queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantpanel.config import CandidateConfig, UniverseConfig
from quantpanel.functions import counters
from quantpanel.functions.storage import materialise
from quantpanel.operators import candidates as cd
from quantpanel.operators import costs, portfolios, returns, teacher
from quantpanel.plans.labels import teacher_labels
from quantpanel.registry.base import MACRO, P2, grid, query, r, rounded
from quantpanel.registry.features import p2, stored_p2
from quantpanel.registry.fixtures import (
    MIN_VARIANCE,
    BASE,
    LABEL_CTE,
    SCORES,
    LabelInputs,
    cost_sql,
    spread_sql,
)
from quantpanel.sources import panels

HORIZONS = (5, 20, 60)


def _grid_sql(body: str) -> str:
    return f"WITH {P2}, {grid('p2')} {body}"


_LAG = "lag({c}) OVER (PARTITION BY ticker ORDER BY day_idx)"


@query(
    "L01_returns_gap_zero",
    _grid_sql(
        f"""SELECT date, day_idx, ticker,
        {r('coalesce(adj_close / ' + _LAG.format(c='adj_close') + ' - 1, 0.0)', 'ret')} FROM grid0
        UNION ALL SELECT date, day_idx, 'CASH', 0.0 FROM cal"""
    ),
)
def _l01(spark, sf):
    return rounded(returns.returns_gap_zero(stored_p2(spark, sf, "adj_close")))


@query(
    "L02_returns_filled",
    _grid_sql(
        f"""SELECT date, day_idx, ticker,
        {r('coalesce(filled / ' + _LAG.format(c='filled') + ' - 1, 0.0)', 'ret')} FROM grid
        UNION ALL SELECT date, day_idx, 'CASH', 0.0 FROM cal"""
    ),
)
def _l02(spark, sf):
    return rounded(returns.returns_filled(stored_p2(spark, sf, "adj_close")))


LOG_ADV = """ln(1 + avg(coalesce(dollar_volume, 0)) OVER (PARTITION BY ticker
  ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


@query(
    "L03_adv20",
    _grid_sql(
        f"""SELECT date, day_idx, ticker, {r(LOG_ADV, 'log_adv')} FROM grid0
        UNION ALL SELECT date, day_idx, 'CASH', {r('ln(1 + 1e12)')} FROM cal"""
    ),
)
def _l03(spark, sf):
    rows = returns.adv20(stored_p2(spark, sf, "dollar_volume"))
    return rounded(rows.select("date", "day_idx", "ticker", F.ln(1 + F.col("adv")).alias("log_adv")))


@query(
    "L04_vol20_pop",
    _grid_sql(
        f""", g AS (SELECT date, day_idx, ticker,
        coalesce(adj_close / {_LAG.format(c='adj_close')} - 1, 0.0) AS ret FROM grid0)
        SELECT date, day_idx, ticker, {r('''CASE WHEN day_idx >= 20 THEN stddev_pop(ret) OVER (PARTITION BY ticker
        ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252.0) END''', 'vol')} FROM g"""
    ),
)
def _l04(spark, sf):
    return rounded(returns.vol20_pop(returns.returns_gap_zero(stored_p2(spark, sf, "adj_close"), cash=False)))


@query(
    "L05_equal_weight",
    _grid_sql(
        f"""SELECT date, ticker, {r('1.0 / count(*) OVER (PARTITION BY date)', 'w')} FROM (
        SELECT date, ticker FROM grid0 UNION ALL SELECT date, 'CASH' FROM cal)"""
    ),
)
def _l05(spark, sf):
    return rounded(portfolios.equal_weight(returns.returns_gap_zero(stored_p2(spark, sf, "adj_close"))))


@query(
    "L06_cash_only",
    _grid_sql(
        """SELECT date, ticker, CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.0 END::DOUBLE AS w FROM (
        SELECT date, ticker FROM grid0 UNION ALL SELECT date, 'CASH' FROM cal)"""
    ),
)
def _l06(spark, sf):
    return rounded(portfolios.cash_only(returns.returns_gap_zero(stored_p2(spark, sf, "adj_close"))))


@query(
    "L07_inverse_volatility",
    _grid_sql(
        f""", g AS (SELECT date, day_idx, ticker,
        coalesce(adj_close / {_LAG.format(c='adj_close')} - 1, 0.0) AS ret FROM grid0),
        v AS (SELECT date, ticker, 1.0 / greatest(coalesce(CASE WHEN day_idx >= 20 THEN stddev_pop(ret) OVER (
          PARTITION BY ticker ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252.0) END, 1.0), 1e-8) AS i FROM g)
        SELECT date, ticker, {r('i / sum(i) OVER (PARTITION BY date)', 'w')} FROM v"""
    ),
)
def _l07(spark, sf):
    daily = returns.returns_gap_zero(stored_p2(spark, sf, "adj_close"), cash=False)
    return rounded(portfolios.inverse_volatility(returns.vol20_pop(daily)))


@query("L08_minimum_variance")
def _l08(spark, sf):
    daily = materialise(returns.returns_filled(stored_p2(spark, sf, "adj_close")))
    return rounded(portfolios.minimum_variance(daily))


@query(
    "L08_minimum_variance_types",
    f"""WITH RECURSIVE {BASE}, {MIN_VARIANCE} SELECT date, ticker, {r('w / sum(w) OVER (PARTITION BY date)', 'w')}
      FROM solved JOIN uni ON uni.asset_idx + 1 = i""",
)
def _l08_types(spark, sf):
    return rounded(portfolios.minimum_variance(LabelInputs(spark, sf).filled))


@query(
    "L09_previous_hold",
    f"""WITH {BASE}, c AS (SELECT date, ticker, coalesce(exp(sum(ln(1 + ret)) OVER (PARTITION BY ticker ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 1.0) AS g FROM gf)
    SELECT date, ticker, {r('g / sum(g) OVER (PARTITION BY date)', 'w')} FROM c""",
)
def _l09(spark, sf):
    return rounded(portfolios.previous_hold(LabelInputs(spark, sf).filled))


def _sparse_labels(inputs):
    """Hard labels on the days with a volatility value only, so that the replay has to carry them."""
    days = panels.vix_series(inputs.spark, inputs.sf_dir).select("date")
    rows = inputs.candidates.filter(F.col("cand_id") == 1).join(days, "date", "left_semi")
    return rows.select("date", "ticker", "w")


@query(
    "L10_teacher_replay",
    f"""WITH {LABEL_CTE}, {MACRO}, l AS (SELECT date, ticker, w FROM cand
        WHERE cand_id = 1 AND date IN (SELECT date FROM macro WHERE series_id = '5-LOW')),
      s AS (SELECT g.date, g.ticker, l.w FROM gz g LEFT JOIN l USING (date, ticker))
    SELECT date, ticker, {r('''coalesce(last_value(w IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0 / count(*) OVER (PARTITION BY date))''', 'w')} FROM s""",
)
def _l10(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(portfolios.teacher_replay(inputs.returns, _sparse_labels(inputs)))


SEARCH = CandidateConfig()
SEED = 42


def _n_assets(inputs) -> int:
    return inputs.universe.count()


def _shape(candidates, n_assets: int):
    """Concentration, largest weight and cash weight of each candidate (cash is the last member)."""
    w = F.col("held.w")
    cash = F.filter("held", lambda e: e["asset_idx"] == n_assets - 1)
    return candidates.withColumns(
        {
            "hhi": F.reduce(w, F.lit(0.0), lambda total, x: total + x * x),
            "top": F.array_max(w),
            "cash": F.coalesce(F.get(cash, 0)["w"], F.lit(0.0)),
        }
    )


def _mean_shape(rows, *keys):
    means = (F.avg(c).alias(f"mean_{c}") for c in ("hhi", "top", "cash"))
    return rounded(rows.groupBy(*keys).agg(F.count("*").alias("n"), *means))


_MEAN_SHAPE = ", ".join(["count(*) AS n", *(r(f"avg({c})", f"mean_{c}") for c in ("hhi", "top", "cash"))])
_DAY = "(date - DATE '1970-01-01')"


def _draws_sql(attempts: int = 8) -> str:
    """Normalised gamma draws of all candidates; every member is drawn, as there are few."""
    mix = SEARCH.dirichlet_alpha_mix
    per_alpha = SEARCH.dirichlet_candidates_per_day // len(mix)
    shape = " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(mix))
    drawn = f"SELECT date, {_DAY} AS day, number FROM cal, range({per_alpha * len(mix)}) t(number)"
    placed = f"""SELECT *, CASE number // {per_alpha} {shape} END AS alpha
      FROM ({counters.key_sql(drawn, [str(SEED), 'day', 'number'], 'own')}), (SELECT asset_idx + 1 AS place FROM uni)"""
    rows = counters.uniform_sql(counters.absorbed_sql(placed, "own", "place", "draw"), "draw", 0, "u")
    rows = f"SELECT *, CASE WHEN alpha < 1 THEN alpha + 1 ELSE alpha END - 1.0 / 3 AS d, NULL::DOUBLE AS g FROM ({rows})"
    first = None
    for attempt in range(1, attempts + 1):
        rows = counters.normal_sql(rows, "draw", 2 * attempt, "x", "g IS NULL")
        rows = counters.uniform_sql(rows, "draw", 4 * attempt + 2, "y", "g IS NULL")
        rows = f"SELECT *, pow(1 + x / sqrt(9 * d), 3) AS v FROM ({rows})"
        rows = f"""SELECT * EXCLUDE (x, y, v, g), CASE WHEN g IS NOT NULL THEN g
          WHEN v > 0 AND ln(y) < x * x / 2 + d * (1 - v + ln(CASE WHEN v > 0 THEN v END)) THEN d * v END AS g FROM ({rows})"""
        if attempt == 1:  # few rows need a further attempt
            first, rows = f"SELECT * FROM ({rows}) WHERE g IS NOT NULL", f"SELECT * FROM ({rows}) WHERE g IS NULL"
    rows = f"{first} UNION ALL {rows}"
    return f"""draws AS (SELECT date, alpha, number, asset_idx, g * CASE WHEN alpha < 1 THEN pow(u, 1 / alpha) ELSE 1 END AS g
      FROM (SELECT *, place - 1 AS asset_idx FROM ({rows}))),
    shape AS (SELECT date, alpha, sum(g * g) / pow(sum(g), 2) AS hhi, max(g) / sum(g) AS top,
      max(CASE WHEN asset_idx = (SELECT max(asset_idx) FROM uni) THEN g END) / sum(g) AS cash FROM draws GROUP BY date, alpha, number)"""


@query(
    "L11_random_candidates",
    f"WITH {BASE}, {_draws_sql()} SELECT date, alpha, {_MEAN_SHAPE} FROM shape GROUP BY ALL",
)
def _l11(spark, sf):
    """All draws of the default search, summed up by day and concentration."""
    inputs = LabelInputs(spark, sf)
    n_assets = _n_assets(inputs)
    drawn = cd.random_candidates(inputs.calendar.select("date"), n_assets, SEARCH, SEED)
    mix = SEARCH.dirichlet_alpha_mix
    per_alpha = SEARCH.dirichlet_candidates_per_day // len(mix)
    number = F.floor((F.col("cand_id") - cd.RANDOM_OFFSET) / per_alpha) + 1
    alpha = F.element_at(F.array(*map(F.lit, mix)), number.cast("int"))
    return _mean_shape(_shape(drawn, n_assets).withColumn("alpha", alpha), "date", "alpha")


def _perturbed(inputs):
    seeds = cd.held_weights(
        inputs.candidates.filter(F.col("cand_id") < SEARCH.perturbation_seeds), inputs.universe, ["date", "cand_id"]
    )
    return cd.perturbed_candidates(seeds, SEARCH, SEED)


def _seed_of(cand_id):
    return F.floor((cand_id - cd.PERTURBED_OFFSET) / SEARCH.local_perturbations_per_seed)


def _perturbed_sql() -> str:
    rows = f"""SELECT date, day_idx, {_DAY} AS day, cand_id AS seed_id, ticker, asset_idx, w, k
      FROM cand JOIN uni USING (ticker), range({SEARCH.local_perturbations_per_seed}) t(k) WHERE cand_id < {SEARCH.perturbation_seeds}"""
    rows = counters.key_sql(rows, [str(SEED), "day", "seed_id", "k", "asset_idx"], "own")
    rows = counters.normal_sql(rows, "own", 0, "z")
    return f"""noisy AS (SELECT date, day_idx, seed_id, seed_id * {SEARCH.local_perturbations_per_seed} + k AS cand_id, ticker,
      w + {SEARCH.perturbation_std} * z AS w FROM ({rows}))"""


_SHAPE_SQL = "sum(w * w) AS hhi, max(w) AS top, max(CASE WHEN ticker = 'CASH' THEN w END) AS cash"


@query(
    "L12_perturbed_candidates",
    f"""WITH {LABEL_CTE}, {_perturbed_sql()}, s AS (SELECT date, seed_id, {_SHAPE_SQL} FROM noisy GROUP BY date, seed_id, cand_id)
    SELECT date, seed_id, {_MEAN_SHAPE} FROM s GROUP BY ALL""",
)
def _l12(spark, sf):
    """All perturbations of the default search, summed up by day and seed."""
    inputs = LabelInputs(spark, sf)
    rows = _shape(_perturbed(inputs), _n_assets(inputs)).withColumn("seed_id", _seed_of(F.col("cand_id")))
    return _mean_shape(rows, "date", "seed_id")


def _projection_ctes(source: str, result: str, rounds: int = 10) -> str:
    """The capped projection of the weights of `source`, one subquery per round."""
    part = "(PARTITION BY date, cand_id)"
    keys = "date, day_idx, cand_id, ticker, asset_idx, cap"
    steps = [f"""w0 AS (SELECT date, day_idx, cand_id, ticker, asset_idx, CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.25 END AS cap, greatest(w, 0) AS w
      FROM {source} JOIN uni USING (ticker))"""]
    for k in range(rounds):
        steps.append(
            f"""a{k} AS (SELECT *, sum(greatest(w - cap, 0)) OVER {part} AS over, least(w, cap) AS c FROM w{k}),
            b{k} AS (SELECT *, count(*) FILTER (c < cap - 1e-10) OVER {part} AS free FROM a{k}),
            w{k + 1} AS (SELECT {keys}, CASE WHEN over < 1e-10 THEN w WHEN free = 0 THEN c
              WHEN c < cap - 1e-10 THEN c + over / free ELSE c END AS w FROM b{k})"""
        )
    steps.append(f"n AS (SELECT *, least(w / sum(w) OVER {part}, cap) AS v FROM w{rounds})")
    steps.append(f"{result} AS (SELECT {keys}, v / sum(v) OVER {part} AS w FROM n)")
    return ", ".join(steps)


@query(
    "L13_project_weights",
    f"WITH {LABEL_CTE}, {_projection_ctes('cand', 'projected')} SELECT date, cand_id, asset_idx, {r('w', 'w')} FROM projected",
)
def _l13_fixture(spark, sf):
    inputs = LabelInputs(spark, sf)
    rows = cd.held_weights(inputs.candidates, inputs.universe, ["date", "cand_id", "cand_type"])
    projected = cd.project_weights(rows, inputs.universe)
    return rounded(projected.select("date", "cand_id", F.inline("held").alias("asset_idx", "w")))


@query(
    "L13_project_perturbed",
    f"""WITH {LABEL_CTE}, {_perturbed_sql()}, {_projection_ctes('noisy', 'projected')},
    s AS (SELECT date, cand_id // {SEARCH.local_perturbations_per_seed} AS seed_id, {_SHAPE_SQL} FROM projected GROUP BY date, cand_id)
    SELECT date, seed_id, {_MEAN_SHAPE} FROM s GROUP BY ALL""",
)
def _l13(spark, sf):
    inputs = LabelInputs(spark, sf)
    projected = cd.project_weights(_perturbed(inputs), inputs.universe)
    rows = _shape(projected, _n_assets(inputs)).withColumn("seed_id", _seed_of(F.col("cand_id")))
    return _mean_shape(rows, "date", "seed_id")


@query(
    "L14_trading_cost",
    f"""WITH {LABEL_CTE} SELECT c.date, c.cand_id, {r('sum(' + cost_sql('abs(c.w - p.w)', 'a.adv') + ')', 'cost_bps')},
      {r('0.5 * sum(abs(c.w - p.w))', 'turnover')} FROM cand c
      JOIN prev p ON p.date = c.date AND p.ticker = c.ticker
      JOIN adv a ON a.date = c.date AND a.ticker = c.ticker GROUP BY 1, 2""",
)
def _l14(spark, sf):
    inputs = LabelInputs(spark, sf)
    ids = inputs.candidates.select("date", "cand_id").distinct()
    previous = inputs.previous.join(ids, "date")
    keys = ["date", "cand_id"]
    return rounded(costs.trading_cost(inputs.candidates, previous, inputs.adv, keys))


@query(
    "L14_asset_costs",
    f"""WITH {LABEL_CTE} SELECT c.date, c.cand_id, c.ticker, {r('abs(c.w - p.w)', 'delta')},
      {r(cost_sql('abs(c.w - p.w)', 'a.adv'), 'cost_bps')} FROM cand c
      JOIN prev p ON p.date = c.date AND p.ticker = c.ticker
      JOIN adv a ON a.date = c.date AND a.ticker = c.ticker""",
)
def _l14_assets(spark, sf):
    inputs = LabelInputs(spark, sf)
    ids = inputs.candidates.select("date", "cand_id").distinct()
    previous = inputs.previous.join(ids, "date")
    return rounded(costs.asset_costs(inputs.candidates, previous, inputs.adv, ["date", "cand_id"]))


@query(
    "H05_spread_lookup",
    _grid_sql(
        f"""SELECT date, ticker, {spread_sql('dollar_volume')}::DOUBLE AS spread_bps FROM p2"""
    ),
)
def _h05(spark, sf):
    rows = p2(spark, sf).select("date", "ticker", F.col("dollar_volume").alias("adv"))
    return costs.spread_lookup(rows).select("date", "ticker", "spread_bps")


def _scores(inputs):
    return teacher.score_candidates(
        inputs.candidates, inputs.returns, inputs.previous, inputs.adv, horizons=HORIZONS
    )


_SCORE_COLUMNS = (
    "objective_total", "objective_sharpe", "objective_return", "objective_vol", "turnover",
    "est_cost", "concentration_hhi",
)
_SCORE_SELECT = ", ".join(r(c, c) for c in _SCORE_COLUMNS)


@query(
    "L15_score_candidates",
    f"WITH {LABEL_CTE}, {SCORES} SELECT date, horizon_h::BIGINT AS horizon_h, cand_id, {_SCORE_SELECT} FROM score",
)
def _l15(spark, sf):
    return rounded(_scores(LabelInputs(spark, sf)).drop("cand_type"))


@query(
    "L16_candidate_records",
    f"""WITH {LABEL_CTE}, {SCORES} SELECT date, horizon_h::BIGINT AS horizon_h, cand_id, rank, num_candidates,
      {r('rank / num_candidates', 'rank_pct')}, 'deterministic' AS cand_type,
      strftime(date, '%Y-%m-%d') || '_' || cand_id AS candidate_id, {_SCORE_SELECT} FROM ranked WHERE rank < 10""",
)
def _l16(spark, sf):
    ranked = teacher.ranked_candidates(_scores(LabelInputs(spark, sf)), 10)
    return rounded(teacher.candidate_records(ranked))


def _ranked(inputs):
    return materialise(teacher.ranked_candidates(_scores(inputs), 10))


@query(
    "L17_distill_targets",
    f"""WITH {LABEL_CTE}, {SCORES}, s AS (SELECT b.date, horizon_h, ticker, sum(p * w) AS soft,
      sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) GROUP BY 1, 2, 3)
    SELECT date, horizon_h::BIGINT AS horizon_h, ticker, {r('soft / sum(soft) OVER (PARTITION BY date, horizon_h)', 'soft')},
      {r('hard', 'hard')} FROM s""",
)
def _l17(spark, sf):
    inputs = LabelInputs(spark, sf)
    return rounded(teacher.distill(_ranked(inputs), inputs.candidates)[0])


@query(
    "L18_label_records",
    f"""WITH {LABEL_CTE}, {SCORES} SELECT date, horizon_h::BIGINT AS horizon_h,
      {r('max(objective_total) - min(objective_total)', 'teacher_confidence')},
      {r('max(objective_total)', 'best_objective')}, {r('avg(objective_total)', 'topk_mean_objective')},
      max(num_candidates) AS num_candidates, any_value(next_date) AS prediction_date
    FROM topk JOIN cal USING (date) GROUP BY 1, 2""",
)
def _l18(spark, sf):
    inputs = LabelInputs(spark, sf)
    _, labels = teacher.label_tables(
        _ranked(inputs), inputs.candidates, inputs.previous, inputs.calendar
    )
    return rounded(labels)


@query(
    "L18_label_weights",
    f"""WITH {LABEL_CTE}, {SCORES}, d AS (SELECT DISTINCT date, horizon_h FROM blend),
      s AS (SELECT b.date, horizon_h, ticker, sum(p * w) AS soft,
        sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) GROUP BY 1, 2, 3),
      n AS (SELECT d.date, d.horizon_h, p.ticker, p.w AS prev_live, coalesce(s.soft, 0) AS soft, coalesce(s.hard, 0) AS hard
        FROM d JOIN prev p USING (date) LEFT JOIN s USING (date, horizon_h, ticker))
    SELECT date, horizon_h::BIGINT AS horizon_h, ticker, {r('prev_live', 'prev_live')}, {r('soft', 'soft')}, {r('hard', 'hard')},
      {r('coalesce(lag(hard) OVER (PARTITION BY horizon_h, ticker ORDER BY date), prev_live)', 'prev_target')} FROM n""",
)
def _l18w(spark, sf):
    inputs = LabelInputs(spark, sf)
    weights, _ = teacher.label_tables(
        _ranked(inputs), inputs.candidates, inputs.previous, inputs.calendar
    )
    return rounded(weights)


SMALL_SEARCH = CandidateConfig(dirichlet_candidates_per_day=40, local_perturbations_per_seed=8)


@query("L19_teacher_labels")
def _l19(spark, sf):
    inputs = LabelInputs(spark, sf)
    result = teacher_labels(inputs.prices, search=SMALL_SEARCH, passes=None)
    return rounded(result.weights)


RULES = CandidateConfig(
    dirichlet_candidates_per_day=0,
    local_perturbations_per_seed=0,
    deterministic=("equal_weight", "cash_only", "inverse_vol"),
)
RULE_CANDIDATES = f"""vl AS (SELECT date, ticker, CASE WHEN day_idx >= 20 THEN stddev_pop(ret) OVER (PARTITION BY ticker
    ORDER BY day_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) * sqrt(252.0) END AS v FROM gz),
  raw AS (SELECT date, day_idx, 0 AS cand_id, ticker, 1.0 AS x FROM gz
    UNION ALL SELECT date, day_idx, 1, ticker, CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.0 END FROM gz
    UNION ALL SELECT date, day_idx, 2, ticker, 1.0 / greatest(coalesce(v, 1.0), 1e-8) FROM gz JOIN vl USING (date, ticker)),
  rules AS (SELECT date, day_idx, cand_id, ticker, x / sum(x) OVER (PARTITION BY date, cand_id) AS w FROM raw),
  {_projection_ctes('rules', 'cand')},
  prev AS (SELECT date, ticker, w FROM rules WHERE cand_id = 0)"""


@query(
    "L19_teacher_labels_rules",
    f"""WITH {BASE}, {RULE_CANDIDATES}, {SCORES}, s AS (SELECT b.date, ticker, sum(p * w) AS soft,
      sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) WHERE horizon_h = 20 GROUP BY 1, 2)
    SELECT date, ticker, {r('soft', 'soft')}, {r('hard', 'hard')} FROM s""",
)
def _l19_rules(spark, sf):
    """The whole label run with rule-based candidates only, in one pass."""
    prices = materialise(panels.prices_by_type(spark, sf))
    result = teacher_labels(prices, search=RULES, universe_cfg=UniverseConfig(min_history_rows=1))
    return rounded(result.weights.select("date", "ticker", "soft", "hard"))
