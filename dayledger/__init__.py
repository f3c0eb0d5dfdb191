"""Daily order data on Spark: quality gate, versioned rows, day loads, marts, metrics."""

from dayledger.horizons import Deadlines, Horizons
from dayledger.plans.marts import Marts
from dayledger.session import tune

__all__ = ["Deadlines", "Horizons", "Marts", "tune"]
