"""All bound queries; importing a plan module registers its queries."""

from millrace.plans import (  # noqa: F401
    counting,
    joining,
    learning,
    ordering,
    scalars,
    scans,
    selection,
    stateful,
    summaries,
    vectors,
)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
