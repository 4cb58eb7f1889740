"""Registered queries and their oracle SQL, keyed by the same names."""

from .oracle import ORACLE
from .queries import ANALYSES, QUERIES

__all__ = ["ANALYSES", "ORACLE", "QUERIES"]
