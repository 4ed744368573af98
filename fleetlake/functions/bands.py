"""Congestion band classification expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_BANDS, Bands


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band_sql(c: Column | str) -> Column:
    """Warehouse CASE: >=30 Fluido, >=15 Moderado, ELSE Congestionado.

    NaN compares greater than every number in Spark, so a NaN speed is
    Fluido here; NULL falls through to Congestionado.
    """
    s = _col(c)
    return (F.when(s >= 30, F.lit("Fluido"))
            .when(s >= 15, F.lit("Moderado"))
            .otherwise(F.lit("Congestionado")))


def band_table(c: Column | str, bands: Bands = DEFAULT_BANDS) -> Column:
    """Half-open table lookup: first band with lo <= x < hi, else unknown."""
    s = _col(c)
    expr = None
    for name, lo, hi in bands.table:
        cond = (s >= lo) & (s < hi) & ~F.isnan(s)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(bands.unknown))


def congestion_band(c: Column | str, bands: Bands = DEFAULT_BANDS) -> Column:
    return band_sql(c) if bands.mode == "sql" else band_table(c, bands)
