"""Model-ready dataset: state features, joined features, targets, splits, scaling.

Stays one DataFrame from end to end; only the fitted medians, means and deviations (one
number per feature) come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.config import ACTIVE_WEIGHT
from quantpanel.functions.columns import clip, fit_weights, null_count, parse_weights
from quantpanel.functions.storage import materialise
from quantpanel.operators.grid import day_table
from quantpanel.operators.market_features import outer_join_blocks
from quantpanel.operators.splits import assign_split
from quantpanel.operators.stats import column_summaries

KEYS = ["asof_date", "ticker"]
STATE_FEATURES = ("prev_live_weight", "prev_target_weight", "delta_from_prev_target")
NOT_FEATURES = {
    "asof_date", "ticker", "prediction_date", "split_name", "confidence", "target_score",
    "target_weight", "missing_feature_count", "missing_feature_count_with_state", "asset_idx",
}


# --- vectors in label tables ----------------------------------------------------------
def weights_to_json(rows: DataFrame, universe: DataFrame, keys: list[str], columns: dict) -> DataFrame:
    """Long weights to one JSON vector column per entry of {column: output name}.

    A vector has one element per universe member, which is what the file format asks for.
    """
    indexed = rows.join(universe.select("ticker", "asset_idx"), "ticker")
    packed = F.sort_array(F.collect_list(F.struct("asset_idx", *columns)))
    grouped = indexed.groupBy(*keys).agg(packed.alias("_v"))
    return grouped.select(
        *keys,
        *[F.to_json(F.col(f"_v.{c}")).alias(name) for c, name in columns.items()],
    )


def vector_column(name: str, n_assets: int) -> Column:
    return fit_weights(parse_weights(F.col(name)), n_assets)


def explode_vectors(rows: DataFrame, universe: DataFrame, keys: list[str], vectors: dict) -> DataFrame:
    """Array columns {output name: array column} to one row per universe member."""
    zipped = F.arrays_zip(*[c.alias(n) for n, c in vectors.items()])
    long = rows.select(*keys, F.posexplode(zipped).alias("asset_idx", "_e"))
    members = universe.select("ticker", "asset_idx")
    return long.join(members, "asset_idx").select(
        *keys, "ticker", "asset_idx", *[F.col(f"_e.{n}").alias(n) for n in vectors]
    )


# --- tables ---------------------------------------------------------------------------
def state_features(labels: DataFrame, universe: DataFrame, n_assets: int) -> DataFrame:
    """Previous live and target weight per (asof_date, ticker) from label vectors.

    The previous target is the recorded one, else the hard target of the label before, else
    equal weight.
    """
    unknown = F.array_repeat(F.lit(None).cast("double"), n_assets)

    def recorded(name: str) -> Column:
        if name not in labels.columns:
            return unknown
        return F.when(F.col(name).isNotNull(), vector_column(name, n_assets)).otherwise(unknown)

    long = explode_vectors(
        labels,
        universe,
        ["asof_date"],
        {
            "prev_live_weight": vector_column("prev_live_weights_json", n_assets),
            "_hard": recorded("hard_target_weights_json"),
            "_known": recorded("prev_target_weights_json"),
        },
    )
    # One row per date and ticker: a window is as long as the label calendar.
    before = (
        Window.partitionBy("ticker").orderBy("asof_date").rowsBetween(Window.unboundedPreceding, -1)
    )
    target = F.coalesce(
        "_known", F.last("_hard", ignorenulls=True).over(before), F.lit(1.0 / max(n_assets, 1))
    )
    return long.withColumn("prev_target_weight", target).select(
        *KEYS,
        "prev_live_weight",
        "prev_target_weight",
        (F.col("prev_live_weight") - F.col("prev_target_weight")).alias("delta_from_prev_target"),
    )


def scaffold(dates: DataFrame, universe: DataFrame) -> DataFrame:
    """Every universe member on every date, by repeating members over the list of dates."""
    days = dates.select("asof_date").distinct().agg(F.sort_array(F.collect_list("asof_date")))
    return universe.select("ticker", "asset_idx", F.explode(days.scalar()).alias("asof_date"))


def feature_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in NOT_FEATURES]


def feature_table(
    asset: DataFrame,
    state: DataFrame,
    universe: DataFrame,
    market: DataFrame | None = None,
    cross: DataFrame | None = None,
) -> DataFrame:
    base = asset.drop(*STATE_FEATURES, "missing_feature_count", "missing_feature_count_with_state")
    table = scaffold(base, universe).join(base, KEYS, "left")
    for shared in (market, cross):
        if shared is not None:
            table = table.join(day_table(shared, "asof_date"), "asof_date", "left")
    table = table.join(state, KEYS, "left")
    return table.withColumn("missing_feature_count", null_count(feature_columns(table)))


def target_table(
    labels: DataFrame, universe: DataFrame, n_assets: int, mode: str = "log_relative"
) -> DataFrame:
    """Soft target per member: raw weight, or the log of its ratio to equal weight."""
    if mode not in ("log_relative", "raw_weight"):
        raise ValueError(f"unknown target mode '{mode}'")
    confidence = (
        F.col("teacher_confidence") if "teacher_confidence" in labels.columns else F.lit(1.0)
    )
    prediction = (
        F.col("prediction_date")
        if "prediction_date" in labels.columns
        else F.lit(None).cast("date")
    )
    rows = labels.select(
        "asof_date",
        prediction.alias("prediction_date"),
        confidence.alias("confidence"),
        vector_column("soft_target_weights_json", n_assets).alias("_soft"),
    )
    keys = ["asof_date", "prediction_date", "confidence"]
    long = explode_vectors(rows, universe, keys, {"target_weight": F.col("_soft")})
    score = F.col("target_weight")
    if mode == "log_relative":
        score = F.ln(F.greatest(score, F.lit(1e-8)) * float(max(n_assets, 1)))
    return long.withColumn("target_score", score).drop("asset_idx")


def resolve_prediction_dates(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Fill a missing prediction date with the next calendar day; drop what stays open."""
    nexts = calendar.select(F.col("date").alias("asof_date"), F.col("next_date").alias("_next"))
    return (
        rows.join(day_table(nexts, "asof_date"), "asof_date", "left")
        .withColumn("prediction_date", F.coalesce("prediction_date", "_next"))
        .drop("_next")
        .filter(F.col("prediction_date").isNotNull())
    )


@dataclass(frozen=True)
class Scaling:
    """Fitted on the training rows; one entry per feature."""

    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]

    def apply(self, table: DataFrame) -> DataFrame:
        return table.withColumns(
            {
                c: (F.coalesce(c, F.lit(self.medians[c])) - self.means[c]) / self.stds[c]
                for c in self.medians
            }
        )


def fit_scaling(train: DataFrame, features: list[str]) -> Scaling:
    """Medians for missing values, then mean and population deviation (1 if below 1e-8)."""
    total = train.count()
    medians, means, stds = {}, {}, {}
    for c, seen in column_summaries(train, features).items():
        # moments of the filled column follow from those of its values
        share = seen.count / total if total else 0.0
        mean = share * seen.mean + (1 - share) * seen.median
        spread = share * (seen.std**2 + (seen.mean - mean) ** 2) + (1 - share) * (seen.median - mean) ** 2
        medians[c], means[c] = seen.median, mean
        stds[c] = spread**0.5 if spread**0.5 >= 1e-8 else 1.0
    return Scaling(medians, means, stds)


def scale_rows(table: DataFrame, scaling: Scaling) -> DataFrame:
    return scaling.apply(table).withColumn(
        "sample_weight", clip(F.col("confidence"), 0.1, 10.0)
    )


def merge_targets(features: DataFrame, targets: DataFrame, calendar: DataFrame) -> DataFrame:
    return resolve_prediction_dates(features.join(targets, KEYS), calendar)


def prepare_dataset(
    features: DataFrame,
    labels: DataFrame,
    splits: DataFrame,
    universe: DataFrame,
    calendar: DataFrame,
    n_assets: int,
    target_mode: str = "log_relative",
) -> tuple[DataFrame, Scaling]:
    """Rows tagged train / val / test with scaled features, target and sample weight."""
    targets = target_table(labels, universe, n_assets, target_mode)
    # Stored because fitting reads it several times and the joins above it are the costly part.
    tagged = materialise(assign_split(merge_targets(features, targets, calendar), splits))
    names = feature_columns(features)
    scaling = fit_scaling(tagged.filter(F.col("split_name") == "train"), names)
    return scale_rows(tagged, scaling), scaling


# --- candidate-level dataset ----------------------------------------------------------
def shared_features(market: DataFrame | None, cross: DataFrame | None) -> DataFrame | None:
    return outer_join_blocks([b for b in (market, cross) if b is not None])


def utility_dataset(candidates: DataFrame, shared: DataFrame) -> DataFrame:
    """Candidate rows with shared features and shape of the weight vector; null counts as 0.

    `candidates`: (asof_date, candidate_id, weights array, objective_total, turnover, est_cost,
    concentration_hhi, ...).
    """
    names = [c for c in shared.columns if c != "asof_date"]
    rows = candidates.join(day_table(shared, "asof_date"), "asof_date", "left")
    zero = {
        c: F.coalesce(c, F.lit(0.0)) for c in (*names, "turnover", "est_cost", "concentration_hhi")
    }
    shape = {
        "candidate_cash_weight": F.coalesce(F.try_element_at("weights", F.lit(-1)), F.lit(0.0)),
        "candidate_max_weight": F.coalesce(F.array_max("weights"), F.lit(0.0)),
        "candidate_active_positions": F.size(
            F.filter("weights", lambda w: w > ACTIVE_WEIGHT)
        ).cast("double"),
    }
    return rows.withColumns({**zero, **shape})
