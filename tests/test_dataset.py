import datetime as dt

import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from quantpanel.config import ScorerConfig, SplitConfig
from quantpanel.operators import dataset as ds
from quantpanel.operators import scorers as sc
from quantpanel.operators import splits as sp
from quantpanel.operators.grid import calendar_of
from quantpanel.sources.universe import universe_order
from tests.helpers import business_days

NAMES = ["AAA", "BBB"]
DAYS = [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)]


@pytest.fixture(scope="module")
def universe(spark):
    return universe_order(spark.createDataFrame([(n,) for n in NAMES], "ticker string")).persist()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [
            (DAYS[0], None, "[0.2, 0.3, 0.5]", "[0.6, 0.4, 0.0]", "[0.5, 0.3, 0.2]", 0.5),
            (DAYS[1], DAYS[2], "[0.1, 0.1, 0.8]", None, "[0.25, 0.25, 0.5]", 20.0),
            (DAYS[2], None, None, "[1.0]", "[0.2, 0.2, 0.6, 9.0]", 0.01),
        ],
        "asof_date date, prediction_date date, prev_live_weights_json string, hard_target_weights_json string, "
        "soft_target_weights_json string, teacher_confidence double",
    )


def test_state_features(labels, universe):
    rows = ds.state_features(labels, universe, 3).toPandas()
    got = rows.pivot(index="asof_date", columns="ticker")
    live = got["prev_live_weight"][["AAA", "BBB", "CASH"]].to_numpy()
    target = got["prev_target_weight"][["AAA", "BBB", "CASH"]].to_numpy()
    np.testing.assert_allclose(live, [[0.2, 0.3, 0.5], [0.1, 0.1, 0.8], [1 / 3] * 3])
    # Equal weight first, then the hard target before; a missing one keeps the older.
    np.testing.assert_allclose(target, [[1 / 3] * 3, [0.6, 0.4, 0.0], [0.6, 0.4, 0.0]])


def test_targets(labels, universe):
    rows = ds.target_table(labels, universe, 3).filter(F.col("asof_date") == DAYS[0]).collect()
    score = {r["ticker"]: r["target_score"] for r in rows}
    assert score["AAA"] == pytest.approx(np.log(0.50 / (1 / 3)))
    raw = ds.target_table(labels, universe, 3, "raw_weight").filter("ticker = 'CASH'")
    assert sorted(r["target_score"] for r in raw.collect()) == pytest.approx([0.2, 0.5, 0.6])
    with pytest.raises(ValueError):
        ds.target_table(labels, universe, 3, "other")


def test_prediction_dates_resolve_or_drop(spark, labels, universe):
    days = spark.createDataFrame([(d,) for d in DAYS], "date date")
    rows = ds.resolve_prediction_dates(ds.target_table(labels, universe, 3), calendar_of(days))
    got = {r["asof_date"]: r["prediction_date"] for r in rows.collect()}
    assert got == {DAYS[0]: DAYS[1], DAYS[1]: DAYS[2]}


def test_feature_table_is_dense(spark, labels, universe):
    asset = spark.createDataFrame([(DAYS[0], "AAA", 0.01), (DAYS[1], "BBB", 0.02)], "asof_date date, ticker string, ret_1 double")
    market = spark.createDataFrame([(DAYS[0], 15.0)], "asof_date date, vix double")
    state = ds.state_features(labels, universe, 3)
    rows = ds.feature_table(asset, state, universe, market)
    assert rows.count() == 6
    row = rows.filter("ticker = 'AAA'").orderBy("asof_date").collect()
    assert row[0]["missing_feature_count"] == 0
    assert row[1]["missing_feature_count"] == 2  # no own row, no market row


def test_vectors_round_trip(spark, universe):
    rows = spark.createDataFrame([(DAYS[0], "CASH", 0.5), (DAYS[0], "BBB", 0.3), (DAYS[0], "AAA", 0.2)], "asof_date date, ticker string, w double")
    text = ds.weights_to_json(rows, universe, ["asof_date"], {"w": "weights_json"})
    assert text.first()["weights_json"] == "[0.2,0.3,0.5]"
    back = ds.explode_vectors(text, universe, ["asof_date"], {"w": ds.vector_column("weights_json", 3)})
    assert {r["ticker"]: r["w"] for r in back.collect()} == {"AAA": 0.2, "BBB": 0.3, "CASH": 0.5}


@pytest.mark.parametrize("n,purge", [(1000, 120), (300, 30), (100, 40), (10, 20)])
def test_static_splits(spark, n, purge):
    days = business_days(n)
    calendar = calendar_of(spark.createDataFrame([(d,) for d in days], "date date"))
    cfg = SplitConfig(purge_days=purge)
    rows = {r["split_name"]: r for r in sp.static_splits(calendar, cfg).collect()}
    train_end = int(n * 0.7) - 1
    val_end = min(train_end + int(n * 0.15), n - 1)
    want = {"train": (0, train_end)}
    if train_end + purge + 1 < n:
        if train_end + purge + 1 <= val_end:
            want["val"] = (train_end + purge + 1, val_end)
        if val_end + purge + 1 < n:
            want["test"] = (val_end + purge + 1, n - 1)
    assert {k: (days.index(r["start_date"]), days.index(r["end_date"])) for k, r in rows.items()} == want


def test_walkforward_folds(spark):
    cfg = SplitConfig(walkforward_train_years=1, purge_days=10)
    days = business_days(252 * 3 + 20 + 252 + 7)
    folds = sp.with_fold(sp.walkforward_splits(calendar_of(spark.createDataFrame([(d,) for d in days], "date date")), cfg))
    rows = folds.orderBy("fold", "start_date").collect()
    assert [(r["fold"], r["role"]) for r in rows] == [
        (f"walkforward_{k:02d}", role) for k in range(2) for role in ("train", "val", "test")
    ]
    assert days.index(rows[3]["start_date"]) == 252
    with pytest.raises(ValueError):
        sp.split_interval(folds, "walkforward_09_train")


def model_rows(spark, n_days=30, n_assets=4):
    rng = np.random.default_rng(0)
    rows = []
    for i, day in enumerate(business_days(n_days)):
        part = "train" if i < 18 else "val" if i < 24 else "test"
        for j in range(n_assets):
            x = rng.normal(size=2)
            rows.append((day, f"T{j}", j, part, float(x[0]), float(x[1]), float(x @ [0.7, -0.2] + 0.1 * rng.normal()), float(rng.uniform(0.1, 2))))
    return spark.createDataFrame(
        rows, "asof_date date, ticker string, asset_idx int, split_name string, a double, b double, target_score double, sample_weight double"
    )


def test_ridge_equals_normal_equations(spark):
    data = model_rows(spark)
    scorer = sc.fit_scorer(data, ["a", "b"], ScorerConfig(kind="linear", ridge=0.5))
    train = data.filter("split_name = 'train'").toPandas()
    x = np.column_stack([train["a"], train["b"], np.ones(len(train))])
    w = train["sample_weight"].to_numpy()[:, None]
    want = np.linalg.solve(x.T @ (w * x) + np.diag([0.5, 0.5, 0.0]), x.T @ (w[:, 0] * train["target_score"]))
    np.testing.assert_allclose(scorer.model.coefficients, want[:2], atol=1e-9)
    assert scorer.model.intercept == pytest.approx(want[2], abs=1e-9)


def test_ridges_of_all_folds_from_one_table(spark):
    data = model_rows(spark).withColumn("label", F.col("target_score"))
    folds = data.withColumn("fold", F.when(F.col("split_name") == "val", "x"))
    fits = sc.fit_ridges(folds, ["a", "b"], [0.01, 2.0], ["fold"])
    assert set(fits) == {("x", 0.01), ("x", 2.0), (None, 0.01), (None, 2.0)}
    for (fold, penalty), model in fits.items():
        own = folds.filter(F.col("fold").eqNullSafe(F.lit(fold))).withColumn("split_name", F.lit("train"))
        alone = sc.fit_scorer(own, ["a", "b"], ScorerConfig(kind="linear", ridge=penalty)).model
        np.testing.assert_allclose(model.coefficients, alone.coefficients, atol=1e-9)
        rows = own.toPandas()
        x = np.column_stack([rows["a"], rows["b"], np.ones(len(rows))])
        w = rows["sample_weight"].to_numpy()[:, None]
        want = np.linalg.solve(x.T @ (w * x) + np.diag([penalty, penalty, 0.0]), x.T @ (w[:, 0] * rows["label"]))
        np.testing.assert_allclose([*model.coefficients, model.intercept], want, atol=1e-9)


def test_best_round_with_patience():
    assert sc.best_round([3, 2, 2, 1, 5, 6], 2) == (4, True)
    assert sc.best_round([3, 2, 2, 2, 1], 2) == (2, True)
    assert sc.best_round([3, 2, 1], 2) == (3, False)
    assert sc.best_round([1, 1], 5) == (1, False)


def test_trees_stop_at_the_least_absolute_error(spark):
    """Staged errors by hand, and the round that a walk over them finds."""
    noise = F.pmod(F.xxhash64("ticker", "asof_date"), F.lit(1000)) / 400
    data = model_rows(spark).withColumn("target_score", F.col("target_score") + noise)
    cfg = ScorerConfig(max_iter=12, max_depth=4, learning_rate=0.9, patience=3)
    model = sc.fit_scorer(data, ["a", "b"], cfg).model
    full = sc._boost(
        sc.assemble(data.filter("split_name = 'train'"), ("a", "b")).withColumnRenamed("target_score", "label"), cfg, 12, "sample_weight"
    )
    val = data.filter("split_name = 'val'").toPandas()
    x, w = val[["a", "b"]].to_numpy(), val["sample_weight"].to_numpy()
    staged, errors, at_round = np.zeros(len(x)), [], []
    for tree, share in zip(full.trees, full.treeWeights):
        staged = staged + share * np.array([tree.predict(DenseVector(v)) for v in x])
        errors.append(float(np.average(np.abs(staged - val["target_score"]), weights=w)))
        at_round.append(staged)
    rounds, _ = sc.best_round(errors, 3)
    assert rounds == model.getNumTrees and rounds < 12
    np.testing.assert_allclose([model.predict(DenseVector(v)) for v in x], at_round[rounds - 1], atol=1e-9)
    without = data.filter("split_name = 'train'")
    assert sc.fit_scorer(without, ["a", "b"], ScorerConfig(max_iter=4, max_depth=2)).model.getNumTrees == 4


def utility_rows(spark, n_assets):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        held = {int(j): float(rng.uniform(0.1, 1)) for j in rng.choice(7, 3, replace=False)}
        weights = [held.get(j, 0.0) for j in range(7)] + [0.0] * (n_assets - 7)
        objective = held.get(0, 0.0) - held.get(3, 0.0)
        rows.append(("train" if i < 40 else "val", float(i % 5), objective, weights, *[0.1] * 6))
    names = ", ".join(f"{c} double" for c in sc.UTILITY_SHAPE)
    return spark.createDataFrame(rows, f"split_name string, state double, objective_total double, weights array<double>, {names}")


def test_held_vectors_do_not_grow_with_the_universe(spark):
    cfg = ScorerConfig(max_iter=6, max_depth=3, patience=6)
    predicted = []
    for n_assets in (7, 5000):
        rows = utility_rows(spark, n_assets)
        vectors = [r.features for r in sc.utility_features(rows, ["state"], n_assets).select("features").collect()]
        assert all(v.size == 7 + n_assets for v in vectors)
        assert max(len(v.indices) if n_assets > 7 else 0 for v in vectors) <= 10
        scorer = sc.fit_utility(rows, ["state"], n_assets, cfg)
        predicted.append(sorted(r.pred for r in scorer.predictions(rows).collect()))
    assert predicted[0] == pytest.approx(predicted[1])
    held = rows.withColumn("held", F.expr("filter(transform(weights, (w, i) -> struct(i as asset_idx, w as w)), e -> e.w > 0)")).drop("weights")
    assert sorted(r.pred for r in scorer.predictions(held.withColumn("weights", F.lit(None).cast("array<double>"))).collect()) == pytest.approx(predicted[1])


def test_stored_utility_scorer(spark, tmp_path):
    rows = utility_rows(spark, 9)
    scorer = sc.fit_utility(rows, ["state"], 9, ScorerConfig(max_iter=3, max_depth=2))
    sc.save_scorer(scorer, str(tmp_path / "utility"))
    loaded, scaling = sc.load_scorer(spark, str(tmp_path / "utility"))
    assert (loaded.features, loaded.n_assets, loaded.cfg, scaling) == (scorer.features, 9, scorer.cfg, None)
    assert [r.pred for r in loaded.predictions(rows).collect()] == [r.pred for r in scorer.predictions(rows).collect()]


@pytest.mark.parametrize("kind", ["linear", "gbm", "rank_gbm"])
def test_scorers_put_weights_on_the_simplex(spark, kind):
    data = model_rows(spark)
    scorer = sc.fit_scorer(data, ["a", "b"], ScorerConfig(kind=kind, max_iter=3, max_depth=2))
    weights = scorer.weights(data.filter("split_name = 'test'"))
    sums = weights.groupBy("asof_date").agg(F.sum("w").alias("s"), F.min("w").alias("lo")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 and r["lo"] >= 0 for r in sums)
    importance = sc.feature_importance(scorer, spark).collect()
    assert {r["feature"] for r in importance} == {"a", "b"}


def test_unknown_scorer(spark):
    with pytest.raises(ValueError):
        sc.fit_scorer(model_rows(spark), ["a"], ScorerConfig(kind="other"))


def test_scaling_uses_train_rows_only(spark):
    rows = spark.createDataFrame(
        [("train", 1.0, None), ("train", 3.0, None), ("train", None, None), ("test", 100.0, 5.0)],
        "split_name string, a double, b double",
    )
    scaling = ds.fit_scaling(rows.filter("split_name = 'train'"), ["a", "b"])
    assert scaling.medians == {"a": 2.0, "b": 0.0}
    assert scaling.means["a"] == pytest.approx(2.0)
    assert scaling.stds["a"] == pytest.approx(np.std([1.0, 3.0, 2.0])) and scaling.stds["b"] == 1.0


@pytest.mark.parametrize("kind", ["linear", "gbm"])
def test_stored_scorer_predicts_the_same(spark, tmp_path, kind):
    data = model_rows(spark)
    scorer = sc.fit_scorer(data, ["a", "b"], ScorerConfig(kind=kind, max_iter=3, max_depth=2))
    scaling = ds.Scaling({"a": 1.0, "b": 0.5}, {"a": 0.0, "b": 0.1}, {"a": 1.0, "b": 2.0})
    sc.save_scorer(scorer, str(tmp_path / "scorer"), scaling)
    loaded, again = sc.load_scorer(spark, str(tmp_path / "scorer"))
    assert (loaded.features, loaded.cfg, again) == (scorer.features, scorer.cfg, scaling)
    old, new = (sorted(r.score for r in x.scores(data).collect()) for x in (scorer, loaded))
    assert old == new
