"""The registered queries: each library operator and query on the given tables, beside plain SQL.

A module registers functions of (spark, folder of Parquet tables); ``sql`` is the same question for
an independent SQL engine.
"""

from __future__ import annotations

from tidemark.suite import collections, flights, movement, operators, rental  # noqa: F401
from tidemark.suite.registry import QUERIES, SQL  # noqa: F401
