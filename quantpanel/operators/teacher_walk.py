"""The walk of a label run over its dates, in blocks of days.

What is held before a date depends on the choices of all dates before it. Most candidates don't:
they are drawn and projected for all dates at once. What is left to a walk is, date by date, to add the
candidates made of the weights held and of the last target, to score all of them, and to trade towards
the best. A task walks a block of consecutive dates, whose candidates are of bounded size, from the weights
held before the first one; blocks hand on nothing but the weights after their last date. The first
pass walks all blocks from equal weights, each further pass those whose start has changed by then.
Block k is right after pass k, or earlier where walks from different starts meet, and blocks whose start
is right already are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quantpanel.config import CASH_ADV, CandidateConfig, CostConfig, ExecutionConfig, ObjectiveConfig
from quantpanel.functions import counters
from quantpanel.functions.columns import spread_bps
from quantpanel.functions.storage import materialise
from quantpanel.operators.backtest import trade_and_drift
from quantpanel.operators.candidates import PERTURBED_OFFSET, all_candidates, capped_weights, day_numbers
from quantpanel.operators.grid import day_table
from quantpanel.operators.teacher import forward_rate, forward_returns

OWN = ("prev_live", "prev_target")  # candidates that depend on what is held
DAYS_PER_BLOCK = 128
BLOCK_ENTRIES = 8_000_000  # candidate weights and forward returns of a block
SAME = 1e-12  # starts that differ by less are the same
_WALKED = (
    "date date, block int, cand_id long, assets array<int>, live array<double>, target array<double>, "
    "end_live array<double>, end_target array<double>"
)


def days_per_block(n_assets: int, horizon: int, search: CandidateConfig, wanted: int = DAYS_PER_BLOCK) -> int:
    """Days of a block; 0 if a single date is too large for one row."""
    noisy = min(search.perturbation_seeds, len(search.deterministic)) * search.local_perturbations_per_seed
    drawn = search.dirichlet_candidates_per_day * min(search.sparse_k_assets, n_assets)
    entries = drawn + (len(search.deterministic) + noisy + horizon) * n_assets
    return min(wanted, BLOCK_ENTRIES // max(1, entries))


def _own_numbers(search: CandidateConfig) -> list[int]:
    return [number for number, name in enumerate(search.deterministic) if name in OWN]


def independent(pool: DataFrame, search: CandidateConfig) -> DataFrame:
    """Candidates that don't depend on what is held before their date."""
    noisy_of = F.floor((F.col("cand_id") - PERTURBED_OFFSET) / max(1, search.local_perturbations_per_seed))
    own = F.lit(False)
    for number in _own_numbers(search):
        own = own | (F.col("cand_id") == number) | ((F.col("cand_id") >= PERTURBED_OFFSET) & (noisy_of == number))
    return pool.filter(~own)


def walk_days(
    pool: DataFrame,
    returns: DataFrame,
    universe: DataFrame,
    adv: DataFrame,
    rf: DataFrame | None,
    horizon: int,
    cost: CostConfig,
    size: int,
) -> DataFrame:
    """One row per date with a full forward window: its assets and its independent candidates."""
    rows = forward_returns(returns, horizon).filter(F.size("fwd") == horizon)
    rows = rows.join(adv.select("date", "ticker", "adv"), ["date", "ticker"], "left")
    rows = rows.withColumn("adv", F.coalesce("adv", F.lit(CASH_ADV)))
    fixed = F.lit(cost.commission_bps + cost.regulatory_bps) + spread_bps(F.col("adv"), cost)
    impact = F.lit(cost.impact_coeff) * F.sqrt(cost.portfolio_value / F.greatest("adv", F.lit(cost.adv_floor)))
    entry = F.struct(
        "asset_idx", F.col("weight_cap").alias("cap"), fixed.alias("fixed"), impact.alias("impact"), "fwd"
    )
    members = universe.select("ticker", "asset_idx", "weight_cap")
    assets = rows.join(members, "ticker").groupBy("date").agg(F.sort_array(F.collect_list(entry)).alias("assets"))
    chosen = pool.groupBy("date").agg(F.sort_array(F.collect_list(F.struct("cand_id", "held", "rest"))).alias("pool"))
    days = assets.join(chosen, "date")
    if rf is None:
        days = days.withColumn("rf", F.lit(0.0))
    else:
        days = days.join(forward_rate(rf, (horizon,)).select("date", F.col("_rf").alias("rf")), "date")
    absent = members.join(returns.select("ticker").distinct(), "ticker", "left_anti")
    absent = absent.groupBy("weight_cap").agg(F.count("*").cast("double").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct(F.col("weight_cap").alias("cap"), "n")))
    days = materialise(days.withColumn("absent", materialise(absent.agg(listed.alias("v"))).scalar()))
    # one row per calendar day, so the window without a key is short
    numbers = days.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("number"))
    block = F.floor(F.col("number") / size).cast("int")
    return days.join(day_table(numbers), "date").withColumns(
        {"block": block, "first": F.col("number") % size == 0, "last": (F.col("number") + 1) % size == 0}
    )


# --- one date -------------------------------------------------------------------------
def _columns(rows: pa.StructArray) -> list[np.ndarray]:
    return [x.to_numpy(zero_copy_only=False) for x in rows.flatten()]


def _entries(lists: pa.ListArray) -> list[np.ndarray]:
    """Fields of a column of struct lists behind each other, and the row of each."""
    at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return [*_columns(lists.flatten()), at]


def _placed(held: pa.ListArray, rest: pa.ListArray, asset: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """Weights of sparse candidates on the assets of a date (ascending); other members have no place."""
    out = np.zeros((len(held), len(asset)))
    for shared, w, row in zip(*_entries(rest)):
        if w != 0:
            out[row, cap == shared] = w
    member, w, at = _entries(held)
    place = np.searchsorted(asset, member).clip(max=len(asset) - 1)
    known = asset[place] == member
    out[at[known], place[known]] = w[known]
    return out


def _projected(rows: np.ndarray, cap: np.ndarray, other_cap: np.ndarray, other_n: np.ndarray) -> np.ndarray:
    n, width = len(rows), len(cap) + len(other_cap)
    level = capped_weights(
        np.hstack([rows, np.zeros((n, len(other_cap)))]).ravel(),
        np.tile(np.concatenate([cap, other_cap]), n),
        np.tile(np.concatenate([np.ones(len(cap)), other_n]), n),
        np.repeat(np.arange(n), width),
        n,
    )
    return level.reshape(n, width)[:, : len(cap)]


def _walker(
    search: CandidateConfig, objective: ObjectiveConfig, execution: ExecutionConfig, seed: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    own = [(number, OWN.index(search.deterministic[number])) for number in _own_numbers(search)]
    each = search.local_perturbations_per_seed
    noisy = [(number, i) for i, (number, _) in enumerate(own) if number < search.perturbation_seeds]
    schema = to_arrow_schema(StructType.fromDDL(_WALKED))

    def own_candidates(day: int, asset: np.ndarray, held: np.ndarray, target: np.ndarray, caps: tuple):
        """Ids and weights of the candidates made of what is held, and of their perturbations."""
        seeds = _projected(np.array([(held, target)[which] for _, which in own]), *caps)
        if not noisy or not each:
            return np.array([number for number, _ in own]), seeds
        numbers = np.repeat([number for number, _ in noisy], each)
        k = np.tile(np.arange(each), len(noisy))
        keys = counters.key(seed, np.full(len(k), day), numbers, k)
        noise = counters.normal(counters.absorbed(keys[:, None], asset[None, :].astype(np.int64)), 0)
        moved = seeds[np.repeat([i for _, i in noisy], each)] + search.perturbation_std * noise
        ids = np.concatenate([[number for number, _ in own], numbers * each + k + PERTURBED_OFFSET])
        return ids, np.vstack([seeds, _projected(moved, *caps)])

    def best(ids, w, held, fixed, impact, ahead, rf) -> int:
        daily = w @ ahead
        mean = daily.mean(axis=1)
        std = np.sqrt(((daily - mean[:, None]) ** 2).mean(axis=1))
        delta = np.abs(w - held)
        cost_bps = (delta * (fixed + impact * np.sqrt(delta))).sum(axis=1)
        total = (
            (mean - rf) / (std + objective.epsilon)
            - objective.lambda_turnover * 0.5 * delta.sum(axis=1)
            - objective.lambda_cost * cost_bps / 10000
            - objective.lambda_concentration * (w * w).sum(axis=1)
        )
        total = np.where((w != 0).any(axis=1), total, -np.inf)
        return int(np.lexsort((ids, -total))[0])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = target = None
        for batch in batches:
            out: dict[str, list] = {name: [] for name in schema.names}
            for i, day in enumerate(day_numbers(batch.column("date"))):
                rows = batch.column("assets")[i].values
                asset, cap, fixed, impact = _columns(rows)[:4]
                ahead = rows.flatten()[4].flatten().to_numpy().reshape(len(asset), -1)
                caps = (cap, *_columns(batch.column("absent")[i].values))
                if batch.column("first")[i].as_py():
                    held, target = (batch.column(c)[i].values.to_numpy() for c in ("start_live", "start_target"))
                ids, members, rest = batch.column("pool")[i].values.flatten()
                ids, w = ids.to_numpy(), _placed(members, rest, asset, cap)
                if own:
                    own_ids, own_w = own_candidates(day, asset, held, target, caps)
                    ids, w = np.concatenate([ids, own_ids]), np.vstack([w, own_w])
                rf = batch.column("rf")[i].as_py()
                top = best(ids, w, held, fixed, impact, ahead, np.nan if rf is None else rf)
                last = batch.column("last")[i].as_py()
                out["cand_id"].append(int(ids[top]))
                out["assets"].append(asset)
                out["live"].append(held)
                out["target"].append(target)
                target = w[top]
                _, _, held = trade_and_drift(
                    held, target, 1.0 + ahead[:, 0], execution.rebalance_band, execution.partial_rebalance_alpha
                )
                out["end_live"].append(held if last else None)
                out["end_target"].append(target if last else None)
            out["date"], out["block"] = batch.column("date"), batch.column("block")
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip((out[f.name] for f in schema), schema)],
                schema=schema,
            )

    return walk


# --- all dates ------------------------------------------------------------------------
def _apart(left: str, right: str) -> Column:
    return F.exists(F.zip_with(left, right, lambda a, b: F.abs(a - b) > SAME), lambda x: x)


def walk_labels(
    portfolios: dict[str, DataFrame],
    dates: DataFrame,
    returns: DataFrame,
    universe: DataFrame,
    n_assets: int,
    equal: DataFrame,
    adv: DataFrame,
    rf: DataFrame | None = None,
    horizon: int = 20,
    search: CandidateConfig = CandidateConfig(),
    objective: ObjectiveConfig = ObjectiveConfig(),
    cost: CostConfig = CostConfig(),
    execution: ExecutionConfig = ExecutionConfig(),
    seed: int = 42,
    block_days: int = DAYS_PER_BLOCK,
) -> tuple[DataFrame, DataFrame] | None:
    """(date, ticker, live, target) before each label date, and (date, horizon_h, cand_id) of the choices.

    `portfolios`: those that don't depend on what is held. None if there is no date to label, or if
    one date is too large for a row.
    """
    size = days_per_block(n_assets, horizon, search, block_days)
    if size == 0:
        return None
    any_state = dict.fromkeys(OWN, equal)
    pool = independent(all_candidates({**any_state, **portfolios}, dates, universe, n_assets, search, seed), search)
    days = materialise(walk_days(pool, returns, universe, adv, rf, horizon, cost, size))
    even = F.transform("assets", lambda a: F.lit(1.0) / F.size("assets"))
    starts = materialise(days.filter("first").select("block", even.alias("start_live"), even.alias("start_target")))
    blocks = starts.count()
    if blocks == 0:
        return None
    walk = _walker(search, objective, execution, seed)
    todo, passes = starts, []
    for number in range(blocks):
        rows = days.join(todo, "block").repartitionById(blocks, F.col("block")).sortWithinPartitions("number")
        walked = materialise(rows.mapInArrow(walk, _WALKED).withColumn("_pass", F.lit(number)))
        passes.append(walked)
        ends = walked.filter("end_live is not null").select(
            (F.col("block") + 1).alias("block"), F.col("end_live").alias("_live"), F.col("end_target").alias("_target")
        )
        known = ends.join(starts, "block")
        moved = known.filter(_apart("_live", "start_live") | _apart("_target", "start_target"))
        todo = materialise(moved.select("block", F.col("_live").alias("start_live"), F.col("_target").alias("start_target")))
        if todo.isEmpty():
            break
        starts = materialise(starts.join(todo, "block", "left_anti").unionByName(todo))
    every = reduce(DataFrame.unionByName, passes)
    newest = every.groupBy("block").agg(F.max("_pass").alias("_pass"))
    final = materialise(every.join(newest, ["block", "_pass"], "left_semi"))
    entries = F.explode(F.arrays_zip(F.col("assets").alias("asset_idx"), "live", "target")).alias("e")
    states = final.select("date", entries).select("date", "e.*").join(universe.select("asset_idx", "ticker"), "asset_idx")
    choices = final.select("date", F.lit(horizon).alias("horizon_h"), "cand_id")
    return states.select("date", "ticker", "live", "target"), choices
