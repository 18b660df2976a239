"""All registered queries; importing a module here registers what it holds."""

from weirflow.plans import analytics, checks, domains, landing, reads, resources, scalars, segments, shapes  # noqa: F401
from weirflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
