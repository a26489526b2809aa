"""The library's operators and reports on the test tables, each with its SQL twin."""

from clearwell.workloads import batches, files, landings, reports, routing, transforms, upkeep  # noqa: F401
from clearwell.workloads.registry import REGISTRY

__all__ = ["REGISTRY"]
