"""Imports every module that registers queries."""

from . import league_queries, relational, scalars, texts  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
