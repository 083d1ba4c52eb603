"""Parameters of the operators.

Every number below is a fixed value: results depend on it, so the defaults are part of the
contract of the operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

TRADING_DAYS_PER_YEAR = 252
CASH = "CASH"
CASH_ADV = 1e12
DEFAULT_ADV = 1e8
ACTIVE_WEIGHT = 0.01


@dataclass(frozen=True)
class FeatureConfig:
    return_windows: tuple[int, ...] = (1, 5, 20, 60, 120)
    vol_windows: tuple[int, ...] = (5, 20, 60, 120)
    downvol_windows: tuple[int, ...] = (20, 60)
    dd_windows: tuple[int, ...] = (20, 60, 120)
    mom_windows: tuple[int, ...] = (20, 60, 120)
    beta_windows: tuple[int, ...] = (60, 120)
    corr_windows: tuple[int, ...] = (20, 60)
    liquidity_windows: tuple[int, ...] = (20, 60)
    cross_windows: tuple[int, ...] = (20, 60)
    pca_components: int = 3


@dataclass(frozen=True)
class UniverseConfig:
    include_cash: bool = True
    cash_ticker: str = CASH
    max_single_name_weight: float = 0.25
    min_history_rows: int = 252


@dataclass(frozen=True)
class ExecutionConfig:
    rebalance_band: float = 0.005
    partial_rebalance_alpha: float = 0.50


@dataclass(frozen=True)
class CandidateConfig:
    dirichlet_candidates_per_day: int = 5000
    dirichlet_alpha_mix: tuple[float, ...] = (0.05, 0.20, 1.0, 5.0)
    sparse_k_assets: int = 30
    local_perturbations_per_seed: int = 100
    perturbation_std: float = 0.02
    perturbation_seeds: int = 5
    top_k: int = 5
    distillation_temperature: float = 0.10
    deterministic: tuple[str, ...] = (
        "prev_live",
        "prev_target",
        "equal_weight",
        "cash_only",
        "inverse_vol",
        "min_variance",
    )


@dataclass(frozen=True)
class ObjectiveConfig:
    lambda_turnover: float = 0.20
    lambda_cost: float = 1.0
    lambda_concentration: float = 0.0
    epsilon: float = 1e-8


@dataclass(frozen=True)
class LiquidityBucket:
    adv_min: float
    adv_max: float
    spread_bps: float


@dataclass(frozen=True)
class CostConfig:
    commission_bps: float = 0.0
    regulatory_bps: float = 0.0
    default_spread_bps: float = 2.0
    adv_floor: float = 100_000.0
    impact_coeff: float = 10.0
    portfolio_value: float = 1_000_000.0
    buckets: tuple[LiquidityBucket, ...] = (
        LiquidityBucket(0.0, 1_000_000.0, 10.0),
        LiquidityBucket(1_000_000.0, 10_000_000.0, 5.0),
        LiquidityBucket(10_000_000.0, 1e20, 2.0),
    )


@dataclass(frozen=True)
class SplitConfig:
    train_frac: float = 0.70
    val_frac: float = 0.15
    test_frac: float = 0.15
    walkforward_train_years: int = 5
    walkforward_val_years: int = 1
    walkforward_test_years: int = 1
    purge_days: int = 120

    def __post_init__(self) -> None:
        total = self.train_frac + self.val_frac + self.test_frac
        if abs(total - 1.0) > 1e-6:
            raise ValueError(f"split fractions must sum to 1, got {total}")


@dataclass(frozen=True)
class ScorerConfig:
    kind: str = "gbm"
    learning_rate: float = 0.03
    max_depth: int = 6
    max_iter: int = 500
    temperature: float = 0.30
    ridge: float = 0.01
    patience: int = 50
    seed: int = 42


@dataclass(frozen=True)
class StrategyProfile:
    name: str
    lambda_turnover: float
    lambda_cost: float
    lambda_concentration: float
    distillation_temperature: float
    inference_temperature: float
    rebalance_band: float
    partial_rebalance_alpha: float


BUILTIN_PROFILES: tuple[StrategyProfile, ...] = (
    StrategyProfile("aggressive", 0.05, 0.30, 0.0, 0.05, 0.20, 0.0025, 0.75),
    StrategyProfile("neutral", 0.20, 1.0, 0.0, 0.10, 0.30, 0.005, 0.50),
    StrategyProfile("conservative", 0.50, 2.0, 0.30, 0.15, 0.40, 0.02, 0.25),
)


@dataclass(frozen=True)
class TeacherConfig:
    candidates: CandidateConfig = field(default_factory=CandidateConfig)
    objective: ObjectiveConfig = field(default_factory=ObjectiveConfig)
    cost: CostConfig = field(default_factory=CostConfig)
    execution: ExecutionConfig = field(default_factory=ExecutionConfig)
    horizons: tuple[int, ...] = (20,)
