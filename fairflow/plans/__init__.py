"""Registered queries: each operator over the given tables, with the same query as DuckDB SQL.

Modules register themselves on import; ``QUERIES`` and ``ORACLES`` hold the result.
"""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import debias, demand, disparity, fair, learning, scalars, spatial, tables  # noqa: F401,E402
