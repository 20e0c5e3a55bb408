"""Operators for preparing training data, and their registered queries."""

from chainlake.llm.queries import ORACLES, QUERIES  # noqa: F401
