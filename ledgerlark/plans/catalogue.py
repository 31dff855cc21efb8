"""Importing the query modules registers their queries."""

from ledgerlark.plans import modelling, panel, passengers, transactions, vectors  # noqa: F401
from ledgerlark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
