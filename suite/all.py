"""All queries and their checking SQL."""

from . import configuration, key_checks, numbers, profiles, results, row_checks, streams, replays  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
