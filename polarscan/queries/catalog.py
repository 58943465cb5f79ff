"""All registered queries."""

from . import aggregates, joins, lookups, scalars, streams, volumes, windows  # noqa: F401
from .registry import BUILDERS, ORACLES

__all__ = ["BUILDERS", "ORACLES"]
