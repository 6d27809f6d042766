"""All registered queries."""

from riskframe.plans import encoding, fidelity, models, profiles, rules, samples, scores, stability, streams  # noqa: F401
from riskframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
