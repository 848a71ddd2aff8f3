"""Registered queries: importing this package fills the registry."""

from learnlake.queries import admin, io, learning, warehouse  # noqa: F401
from learnlake.queries.registry import ORACLES, QUERIES  # noqa: F401
