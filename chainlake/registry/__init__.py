"""Registered queries and the SQL that checks them."""

from chainlake.registry import (  # noqa: F401
    dash_q, graph_q, import_q, money_q, rows_q, serve_q, stream_q,
)
from chainlake.registry.base import ORACLES, QUERIES  # noqa: F401
