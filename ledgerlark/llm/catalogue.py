"""Importing the operator modules registers their queries."""

from ledgerlark.llm import alignment, chat, divergence, licenses, nearest, packing, pieces, pii, pitman, quality, repeats, secrets, simhash  # noqa: F401
from ledgerlark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
