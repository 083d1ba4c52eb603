"""Per-asset scorers on Spark ML and what is read from them."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from quantpanel.config import CostConfig, ExecutionConfig, ScorerConfig
from quantpanel.functions.storage import materialise
from quantpanel.operators.backtest import backtest_banded
from quantpanel.operators.dataset import Scaling
from quantpanel.operators.metrics import portfolio_metrics
from quantpanel.operators.ranks import scaled_rank
from quantpanel.operators.teacher import softmax_weights


@dataclass(frozen=True)
class Scorer:
    """A fitted model with the features it was trained on."""

    model: object
    features: tuple[str, ...]
    cfg: ScorerConfig

    def scores(self, dataset: DataFrame) -> DataFrame:
        if isinstance(self.model, RidgeModel):
            return dataset.withColumn("score", self.model.score(self.features))
        ready = assemble(dataset, self.features)
        return self.model.transform(ready).withColumnRenamed("prediction", "score").drop("features")

    def weights(self, dataset: DataFrame, mask: str | None = None) -> DataFrame:
        """Softmax of the scores within each date."""
        scored = self.scores(dataset)
        return softmax_weights(scored, self.cfg.temperature, ["asof_date"], mask=mask)


def save_scorer(scorer: Scorer | UtilityScorer, path: str, scaling: Scaling | None = None) -> None:
    """Store the model, its features and parameters, and the scaling of its inputs.

    `path` is a folder in storage that all later runs reach; an existing one is replaced.
    """
    spec = {
        "kind": type(scorer).__name__,
        "n_assets": getattr(scorer, "n_assets", None),
        "ridge": asdict(scorer.model) if isinstance(scorer.model, RidgeModel) else None,
        "features": list(scorer.features),
        "cfg": asdict(scorer.cfg),
        "scaling": None if scaling is None else asdict(scaling),
    }
    if spec["ridge"] is None:
        scorer.model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    rows = spark.createDataFrame([(json.dumps(spec),)], "spec string").coalesce(1)
    rows.write.mode("overwrite").text(f"{path}/spec")


def load_scorer(spark: SparkSession, path: str) -> tuple[Scorer | UtilityScorer, Scaling | None]:
    """What `save_scorer` stored."""
    spec = json.loads(spark.read.text(f"{path}/spec").first()[0])
    if spec["ridge"] is None:
        model = GBTRegressionModel.load(f"{path}/model")
    else:
        model = RidgeModel(tuple(spec["ridge"]["weights"]), spec["ridge"]["intercept"])
    scaling = None if spec["scaling"] is None else Scaling(**spec["scaling"])
    features, cfg = tuple(spec["features"]), ScorerConfig(**spec["cfg"])
    if spec["kind"] == "UtilityScorer":
        return UtilityScorer(model, features, spec["n_assets"], cfg), scaling
    return Scorer(model, features, cfg), scaling


def assemble(dataset: DataFrame, features: tuple[str, ...]) -> DataFrame:
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return vector.transform(dataset)


@dataclass(frozen=True)
class RidgeModel:
    """A linear score; predicted as one expression over the feature columns."""

    weights: tuple[float, ...]
    intercept: float

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(self.weights)

    def score(self, features: tuple[str, ...]) -> Column:
        terms = (F.col(name).cast("double") * weight for name, weight in zip(features, self.weights))
        return sum(terms, F.lit(self.intercept))


def ridge_sums(rows: DataFrame, features: list[str], keys: list[str] = ()) -> DataFrame:
    """``*keys, cell, total``: the weighted products of all features, the constant 1 and the label.

    Cells number the (p + 1) x (p + 2) matrix row by row. Each task adds up its own rows per key, so that
    little more than one matrix per task is sent, and one job serves all keys.
    """
    width = len(features) + 1
    names = [*keys, "total"]
    typed = rows.select(
        *keys, *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)),
        F.col("label").cast("double").alias("label"), F.col("sample_weight").cast("double").alias("weight"),
    )
    schema = StructType([*(typed.schema[k] for k in keys), StructField("total", ArrayType(DoubleType()))])
    target = to_arrow_schema(schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            x = [batch.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(width - 1)]
            x = np.column_stack([*x, np.ones(batch.num_rows), batch.column("label").to_numpy(zero_copy_only=False)])
            weighted = x[:, :width] * batch.column("weight").to_numpy(zero_copy_only=False)[:, None]
            group = list(zip(*(batch.column(k).to_pylist() for k in keys))) if keys else [()] * batch.num_rows
            order: dict[tuple, list[int]] = {}
            for i, key in enumerate(group):
                order.setdefault(key, []).append(i)
            for key, at in order.items():
                held[key] = held.get(key, 0.0) + weighted[at].T @ x[at]
        if held:
            columns = [*zip(*held), [m.ravel() for m in held.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, target)], schema=target)

    partial = typed.mapInArrow(add, schema)
    cells = partial.select(*keys, F.posexplode("total").alias("cell", "total"))
    return cells.groupBy(*keys, "cell").agg(F.sum("total").alias("total"))


def fit_ridges(
    rows: DataFrame, features: list[str], penalties: list[float], keys: list[str] = ()
) -> dict[tuple, RidgeModel]:
    """Weighted least squares with an L2 penalty and a free intercept, per key and penalty.

    ``rows`` has the features without nulls, ``label`` and ``sample_weight``. All matrices come from one job over
    the rows; the p x p systems are solved on the driver. The result is keyed by ``(*key, penalty)``.
    """
    width = len(features) + 1
    matrices: dict[tuple, np.ndarray] = {}
    for row in ridge_sums(rows, features, keys).collect():  # (p + 1)(p + 2) numbers per key
        key = tuple(row[k] for k in keys)
        matrices.setdefault(key, np.zeros(width * (width + 1)))[row["cell"]] = row["total"]
    models = {}
    for key, cells in matrices.items():
        both = cells.reshape(width, width + 1)
        for penalty in penalties:
            ridge = np.diag([max(penalty, 1e-6)] * (width - 1) + [0.0])
            found = np.linalg.solve(both[:, :width] + ridge, both[:, width])
            models[(*key, penalty)] = RidgeModel(tuple(found[:-1].tolist()), float(found[-1]))
    return models


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """Number of rounds up to the least error, and whether `patience` rounds without a better one followed."""
    best = 0
    for number, error in enumerate(errors):
        if error < errors[best]:
            best = number
        elif number - best >= patience:
            return best + 1, True
    return best + 1, False


def _fit_trees(rows: DataFrame, cfg: ScorerConfig, weight: str | None = "sample_weight"):
    """Boosted trees, cut to the round with the least mean absolute error on the validation rows.

    The error of every round comes from one pass over the validation rows with the staged trees. A fit
    with more rounds starts with the same trees, so rounds are doubled until `patience` of them bring no
    better error, and the fit ends at the best one.
    """
    rows = materialise(rows)
    train, val = rows.where(~F.col("is_validation")), rows.where("is_validation")
    if val.isEmpty():
        return _boost(train, cfg, cfg.max_iter, weight)
    rounds = min(cfg.max_iter, 2 * cfg.patience)
    while True:
        model = _boost(train, cfg, rounds, weight)
        best, stopped = best_round(model.evaluateEachIteration(val, "absolute"), cfg.patience)
        if stopped or rounds == cfg.max_iter:
            return model if best == rounds else _boost(train, cfg, best, weight)
        rounds = min(2 * rounds, cfg.max_iter)


def _boost(train: DataFrame, cfg: ScorerConfig, rounds: int, weight: str | None):
    model = GBTRegressor(maxIter=rounds, maxDepth=cfg.max_depth, stepSize=cfg.learning_rate, seed=cfg.seed)
    return (model if weight is None else model.setWeightCol(weight)).fit(train)


def fit_scorer(dataset: DataFrame, features: list[str], cfg: ScorerConfig = ScorerConfig()) -> Scorer:
    """Fit `gbm`, `rank_gbm` or `linear` on the train rows (trees stop early on val rows)."""
    used = dataset.filter(F.col("split_name").isin("train", "val"))
    label = "target_score"
    if cfg.kind == "rank_gbm":
        used = scaled_rank(used, ["asof_date"], ["target_score", "asset_idx"], "_rank_target")
        label = "_rank_target"
    elif cfg.kind not in ("gbm", "linear"):
        raise ValueError(f"unknown scorer kind '{cfg.kind}'")
    if cfg.kind == "linear":
        train = used.filter(F.col("split_name") == "train").withColumn("label", F.col(label))
        model = fit_ridges(train, features, [cfg.ridge])[(cfg.ridge,)]
        return Scorer(model, tuple(features), cfg)
    rows = assemble(used, tuple(features)).select(
        "features",
        F.col(label).alias("label"),
        "sample_weight",
        (F.col("split_name") == "val").alias("is_validation"),
    )
    return Scorer(_fit_trees(rows, cfg), tuple(features), cfg)


def weighted_squared_error(scored: DataFrame) -> DataFrame:
    """Weighted mean squared error of scores against targets."""
    w = F.greatest("sample_weight", F.lit(1e-8))
    gap = F.col("score") - F.col("target_score")
    return scored.agg((F.sum(w * gap * gap) / F.sum(w)).alias("weighted_mse"))


def feature_importance(scorer: Scorer, spark) -> DataFrame:
    """(feature, importance): tree gain, or size of the coefficient."""
    model = scorer.model
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients)
    rows = [(name, float(value)) for name, value in zip(scorer.features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def model_signals(scorer: Scorer, rows: DataFrame, path: str) -> DataFrame:
    """Predicted weights as signals on the day they are executed."""
    return scorer.weights(rows).select(
        F.lit(path).alias("path_id"), F.col("prediction_date").alias("date"), "ticker", "w"
    )


def parameter_grid(base: ScorerConfig, **values) -> list[ScorerConfig]:
    names = list(values)
    return [replace(base, **dict(zip(names, combo))) for combo in product(*values.values())]


def select_by_sharpe(
    dataset: DataFrame,
    features: list[str],
    returns: DataFrame,
    grid: list[ScorerConfig],
    execution: ExecutionConfig = ExecutionConfig(),
    cost: CostConfig = CostConfig(),
) -> tuple[DataFrame, dict[str, Scorer]]:
    """Fit every configuration on the train rows, compare net Sharpe on the validation rows.

    Temperature does not affect the fit, so configurations that differ only in it share one
    model. All validation backtests run as paths of a single job.
    """
    fitted: dict[ScorerConfig, object] = {}
    signals, scorers = None, {}
    held_out = dataset.filter(F.col("split_name") == "val")
    for number, cfg in enumerate(grid):
        key = replace(cfg, temperature=1.0)
        if key not in fitted:
            fitted[key] = fit_scorer(dataset, features, cfg).model
        scorer = Scorer(fitted[key], tuple(features), cfg)
        name = f"trial_{number:03d}"
        scorers[name] = scorer
        rows = model_signals(scorer, held_out, name)
        signals = rows if signals is None else signals.unionByName(rows)
    daily, _ = backtest_banded(signals, returns, cfg=cost, execution=execution)
    return portfolio_metrics(daily).select("path_id", "sharpe"), scorers


# --- candidate-level scorer -----------------------------------------------------------
UTILITY_SHAPE = (
    "turnover", "est_cost", "concentration_hhi", "candidate_cash_weight",
    "candidate_max_weight", "candidate_active_positions",
)


@dataclass(frozen=True)
class UtilityScorer:
    """A model of a candidate's objective, with its state features and the number of assets."""

    model: object
    features: tuple[str, ...]
    n_assets: int
    cfg: ScorerConfig

    def predictions(self, rows: DataFrame) -> DataFrame:
        ready = utility_features(rows, list(self.features), self.n_assets)
        return self.model.transform(ready).withColumnRenamed("prediction", "pred").drop("features")


def held_vector(entries: Column, n_assets: int) -> Column:
    """Sparse ML vector of ``array<struct<asset_idx, w>>``; entries beyond the universe don't count.

    Its size follows the held entries, not the number of assets. Zero and missing weights take no
    place, and weights of one asset are expected once.
    """
    inside = F.filter(
        entries, lambda e: (e["asset_idx"] >= 0) & (e["asset_idx"] < n_assets) & (e["w"] != 0)
    )
    ordered = F.array_sort(F.transform(inside, lambda e: F.struct(e["asset_idx"].cast("int").alias("i"), e["w"].alias("w"))))
    return F.udf(_sparse, VectorUDT(), useArrow=True)(F.lit(n_assets), ordered)


def _sparse(size: int, entries) -> SparseVector:
    return SparseVector(size, [e["i"] for e in entries], [e["w"] for e in entries])


def utility_features(rows: DataFrame, shared: list[str], n_assets: int) -> DataFrame:
    """State features followed by the candidate's held weights, as one sparse vector column."""
    entries = F.transform(
        F.coalesce("weights", F.array().cast("array<double>")),
        lambda w, i: F.struct(i.alias("asset_idx"), F.coalesce(w, F.lit(0.0)).alias("w")),
    )
    held = F.col("held") if "held" in rows.columns else entries
    ready = assemble(rows.withColumn("_w", held_vector(held, n_assets)), (*shared, *UTILITY_SHAPE, "_w"))
    return ready.drop("_w")


def fit_utility(
    rows: DataFrame, shared: list[str], n_assets: int, cfg: ScorerConfig = ScorerConfig()
) -> UtilityScorer:
    """Trees from state and held weights to the candidate's objective; val rows stop the training."""
    used = utility_features(rows.filter(F.col("split_name").isin("train", "val")), shared, n_assets)
    ready = used.select(
        "features",
        F.col("objective_total").alias("label"),
        (F.col("split_name") == "val").alias("is_validation"),
    )
    return UtilityScorer(_fit_trees(ready, cfg, weight=None), tuple(shared), n_assets, cfg)


def best_predicted(scored: DataFrame, pred: str = "pred") -> DataFrame:
    """The candidate with the highest prediction per date (lowest rank on ties)."""
    rest = [c for c in scored.columns if c != "date"]
    order = F.struct(F.col(pred), -F.col("rank"))
    return (
        scored.groupBy("date")
        .agg(F.max_by(F.struct(*rest), order).alias("_best"))
        .select("date", "_best.*")
    )


# --- predictions for given dates ------------------------------------------------------
def prediction_summary(weights: DataFrame, top: int = 10) -> DataFrame:
    """Per date: weight of the largest holdings, number above 1%, concentration."""
    best = Window.partitionBy("date").orderBy(F.desc("w"), "ticker")
    largest = (
        weights.withColumn("_rn", F.row_number().over(best))
        .filter(F.col("_rn") <= top)
        .groupBy("date")
        .agg(F.sum("w").alias("top_weight"))
    )
    totals = weights.groupBy("date").agg(
        F.sum("w").alias("total_weight"),
        F.count(F.when(F.col("w") > 0.01, 1)).alias("n_active"),
        F.sum(F.pow("w", 2)).alias("hhi"),
    )
    return totals.join(largest, "date")


def top_holdings(weights: DataFrame, n: int) -> DataFrame:
    """The n largest holdings of each date."""
    best = Window.partitionBy("date").orderBy(F.desc("w"), "ticker")
    return weights.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= n)
