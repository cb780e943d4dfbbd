"""Every operator as a query over the driver's tables."""

from fleetlake.queries import checks, files, layers, partials, serving, windows  # noqa: F401
from fleetlake.queries.registry import QUERIES

__all__ = ["QUERIES"]
