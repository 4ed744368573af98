"""Join helpers: dimension joins and anti joins.

Building a frame starts no Spark job and leaves nothing in the cache. A
dimension whose size has a bound in its meaning (one row per calendar day, per
nation) may be broadcast with ``bounded=True``; any other is joined without a
hint, so AQE decides from the sizes it has measured at run time and splits a
skewed partition of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left", bounded: bool = False) -> DataFrame:
    """Fact-to-dimension join; ``bounded``: the dimension's meaning bounds its
    size whatever the fact's."""
    return fact.join(F.broadcast(dim) if bounded else dim, on, how)


def orphans(child: DataFrame, parent: DataFrame, on) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent`` (left anti)."""
    keys = [on] if isinstance(on, str) else list(on)
    return child.join(parent.select(*keys), keys, "left_anti")
