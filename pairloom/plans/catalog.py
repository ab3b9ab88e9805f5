"""All registered queries."""

from .registry import ORACLES, QUERIES
from . import split_queries  # noqa: F401
from . import token_queries  # noqa: F401
from . import run_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
