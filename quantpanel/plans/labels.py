"""Label run: prices to teacher labels for all dates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.config import (
    CandidateConfig,
    CostConfig,
    ExecutionConfig,
    ObjectiveConfig,
    UniverseConfig,
)
from quantpanel.functions.storage import materialise
from quantpanel.operators import portfolios, teacher
from quantpanel.operators.backtest import backtest_banded
from quantpanel.operators.candidates import all_candidates, explode_candidates
from quantpanel.operators.grid import calendar_of
from quantpanel.operators.returns import adv20, returns_gap_zero, vol20_pop
from quantpanel.operators.teacher_walk import walk_labels
from quantpanel.sources.universe import universe_members, with_min_history


STABLE = 1e-9  # weights that differ by less are the same


@dataclass
class TeacherResult:
    weights: DataFrame  # (date, horizon_h, ticker, prev_live, prev_target, soft, hard)
    labels: DataFrame  # one row per date and horizon
    records: DataFrame  # the kept candidates
    changed_share: float | None  # share of dates whose winner changed in the last pass
    unstable_dates: int | None = None  # dates whose weights before the trade still moved


def live_weights(
    hard: DataFrame, returns: DataFrame, calendar: DataFrame, execution: ExecutionConfig
) -> DataFrame:
    """Weights held before each label date when the hard targets are traded in order.

    A target set on day t earns the returns of the next day, so returns are shifted back.
    """
    days = calendar.select(F.col("next_date").alias("_next"), "date").filter("_next is not null")
    ahead = returns.select(F.col("date").alias("_next"), "ticker", "ret").join(days, "_next")
    signals = hard.select(F.lit("teacher").alias("path_id"), "date", "ticker", F.col("hard").alias("w"))
    _, weights = backtest_banded(
        signals, ahead.select("date", "ticker", "ret"), execution=execution
    )
    return weights.select("date", "ticker", F.col("live").alias("w"))


def teacher_labels(
    prices: DataFrame,
    previous: DataFrame | None = None,
    passes: int | None = 0,
    horizons: tuple[int, ...] = (20,),
    search: CandidateConfig = CandidateConfig(),
    objective: ObjectiveConfig = ObjectiveConfig(),
    cost: CostConfig = CostConfig(),
    execution: ExecutionConfig = ExecutionConfig(),
    universe_cfg: UniverseConfig = UniverseConfig(),
    seed: int = 42,
    rf: DataFrame | None = None,
) -> TeacherResult:
    """Score, rank and distil every date in parallel.

    The weights held before a date depend on the choices of all dates before it. Instead of
    walking the dates, a run takes them from `previous` (equal weight if not given) and each
    further pass derives them from the labels of the pass before. Pass k is exact for the
    first k + 1 label dates; `changed_share` tells how much the last pass still moved. With
    `passes=None` passes follow until the weights before every date repeat (`STABLE`), which is
    what walking the dates gives. They begin with the weights of such a walk (`teacher_walk.py`), so
    one pass usually confirms them; `changed_share` then compares its winners with those of the walk.
    `rf`: (date, rf) daily risk-free rate (0 if not given).
    """
    kept = with_min_history(prices, universe_cfg.min_history_rows)
    calendar = materialise(calendar_of(kept))
    returns = materialise(returns_gap_zero(kept))
    universe = materialise(universe_members(kept, universe_cfg))
    n_assets = universe.count()
    adv = materialise(adv20(kept))
    vol = vol20_pop(returns)
    equal = portfolios.equal_weight(returns)
    fixed = {
        "equal_weight": equal,
        "cash_only": portfolios.cash_only(returns),
        "inverse_vol": portfolios.inverse_volatility(returns, vol),
        "min_variance": portfolios.minimum_variance(returns),
    }
    fixed = {n: materialise(fixed[n]) for n in search.deterministic if n in fixed}
    dates = calendar.select("date")
    held = previous if previous is not None else equal
    target = held
    winners, changed, unstable = None, None, None
    if passes is None:
        walked = walk_labels(
            fixed, dates, returns, universe, n_assets, equal, adv, rf, horizons[0], search, objective, cost, execution, seed
        )
        if walked is not None:
            states, winners = walked
            held = materialise(_complete(states.select("date", "ticker", F.col("live").alias("w")), equal))
            target = materialise(_complete(states.select("date", "ticker", F.col("target").alias("w")), equal))
    last_pass = passes if passes is not None else dates.count()
    for number in range(last_pass + 1):
        state = {"prev_live": held, "prev_target": target}
        pool = all_candidates({**state, **fixed}, dates, universe, n_assets, search, seed)
        pool = materialise(pool)
        long = explode_candidates(pool, universe)
        scores = teacher.score_candidates(
            long, returns, held, adv, rf, horizons=horizons, objective=objective, cost=cost
        )
        ranked = materialise(teacher.ranked_candidates(scores, 2 * search.top_k))
        weights, labels = teacher.label_tables(ranked, long, held, calendar, search)
        best = ranked.filter(F.col("rank") == 0).select("date", "horizon_h", "cand_id")
        if winners is not None:
            old = winners.withColumnRenamed("cand_id", "_old")
            moved = best.join(old, ["date", "horizon_h"]).agg(
                F.avg((F.col("cand_id") != F.col("_old")).cast("double"))
            )
            changed = moved.first()[0]
        winners = best
        if number < last_pass:
            primary = materialise(weights.filter(F.col("horizon_h") == horizons[0]))
            held_new = live_weights(primary, returns, calendar, execution)
            target_new = primary.select("date", "ticker", F.col("prev_target").alias("w"))
            held_before, held = held, materialise(_complete(held_new, equal))
            target = materialise(_complete(target_new, equal))
            if passes is None:
                unstable = _moved_dates(held_before, held)
                if unstable == 0:
                    break
    return TeacherResult(weights, labels, teacher.candidate_records(ranked), changed, unstable)


def _moved_dates(before: DataFrame, after: DataFrame) -> int:
    old = before.select("date", "ticker", F.col("w").alias("_old"))
    moved = after.join(old, ["date", "ticker"]).filter(F.abs(F.col("w") - F.col("_old")) > STABLE)
    return moved.select("date").distinct().count()


def _complete(weights: DataFrame, fallback: DataFrame) -> DataFrame:
    """Weights where known, the fallback on other dates."""
    known = weights.select("date", "ticker", F.col("w").alias("_w"))
    return fallback.join(known, ["date", "ticker"], "left").select(
        "date", "ticker", F.coalesce("_w", "w").alias("w")
    )
