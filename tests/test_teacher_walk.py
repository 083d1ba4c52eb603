from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantpanel.config import CandidateConfig, UniverseConfig
from quantpanel.operators import teacher_walk
from quantpanel.plans import labels
from tests.helpers import business_days, matrix_of, price_frame, price_matrix

SEARCH = CandidateConfig(
    dirichlet_candidates_per_day=12, local_perturbations_per_seed=2, sparse_k_assets=3, perturbation_seeds=2,
    deterministic=("equal_weight", "prev_live", "prev_target"),
)


@pytest.fixture
def replays(monkeypatch):
    """Walks in blocks of two days; counts the passes that derive the weights held anew."""
    calls, replay = [], labels.live_weights

    def counted(*args):
        calls.append(1)
        return replay(*args)

    monkeypatch.setattr(labels, "live_weights", counted)
    monkeypatch.setattr(labels, "walk_labels", partial(teacher_walk.walk_labels, block_days=2))
    return calls


def run(frame, passes, **settings):
    cfg = UniverseConfig(min_history_rows=5, max_single_name_weight=0.4)
    return labels.teacher_labels(frame, passes=passes, search=SEARCH, universe_cfg=cfg, **settings)


def test_one_pass_confirms_the_walk(spark, replays):
    """A pass from the weights of the walk gives them again; further passes from equal weights come to them date by date."""
    frame = price_frame(spark, price_matrix(10, 3, seed=9))
    result = run(frame, None, horizons=(5,))
    assert len(replays) == 1
    assert result.unstable_dates == 0 and result.changed_share == 0.0
    exact = run(frame, 2, horizons=(5,)).weights.persist()
    got = result.weights.persist()
    for name in ("prev_live", "prev_target", "hard", "soft"):
        want = matrix_of(exact, name)
        assert want.shape == (5, 4)
        np.testing.assert_allclose(matrix_of(got, name)[:3], want[:3], atol=1e-12)


def test_walk_with_members_without_prices_a_rate_and_two_horizons(spark, replays):
    """A member without a price takes part in draws and caps, never in a portfolio; a date without a rate is left out."""
    frame = price_frame(spark, price_matrix(13, 3, seed=4))
    silent = frame.filter("ticker = 'T001'").withColumns({"ticker": F.lit("T0015"), "adj_close": F.lit(None).cast("double")})
    when = business_days(13)
    rate = spark.createDataFrame([(d, 0.0001 * i) for i, d in enumerate(when) if i != 4], "date date, rf double")
    result = run(frame.unionByName(silent), None, horizons=(4, 6), rf=rate)
    assert len(replays) == 1
    assert result.unstable_dates == 0 and result.changed_share == 0.0
    rows = result.weights.filter("horizon_h = 4").select("date", "ticker").collect()
    assert {r["date"] for r in rows} == {d for i, d in enumerate(when[:9]) if i != 4}
    assert {r["ticker"] for r in rows} == {"T000", "T001", "T002", "CASH"}


def test_blocks_are_bounded_by_their_candidates():
    assert teacher_walk.days_per_block(7, 20, SEARCH) == teacher_walk.DAYS_PER_BLOCK
    wide = [teacher_walk.days_per_block(n, 20, CandidateConfig()) for n in (151, 1000, 20_000)]
    assert teacher_walk.DAYS_PER_BLOCK > wide[0] > wide[1] > wide[2] == 0
