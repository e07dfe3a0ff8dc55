"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

# The day and moment every registered query treats as the present.
AS_OF = dt.date(2001, 8, 2)
# A day of the last month that has orders throughout.
MONTH_DAY = dt.date(2001, 7, 15)
NOW = dt.datetime(2001, 8, 2)
# Orders up to this moment form the first load; later ones arrive afterwards.
CUT = dt.datetime(2001, 1, 1)

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is its SQL, absent where SQL cannot say it."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return keep
