"""All registered queries."""

from quantpanel.registry import (  # noqa: F401
    audits,
    backtests,
    datasets,
    features,
    labels,
    market,
    primitives,
)
from quantpanel.registry.base import QUERIES, SQL  # noqa: F401
