"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column | str, digits: int, precision: int = 38, scale: int = 6) -> Column:
    """Round half away from zero on the decimal text of a double.

    ``round(double)`` rounds the exact binary value (39.895 -> 39.89), while
    warehouse engines round the printed decimal (39.895 -> 39.90). Casting to
    ``decimal(precision, scale)`` first fixes the decimal text, so the result
    is the same in every engine that follows this rule.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast(f"decimal({precision},{scale})"), digits).cast("double")


def round_half_even(c: Column | str, digits: int) -> Column:
    """Python's ``round(x, digits)``: half-even on the exact binary value, so
    0.25 -> 0.2 (a true tie) but 0.35 -> 0.3 (its double lies below the tie).

    ``x * 10**digits`` is taken as an error-free product ``p + e``: x is split
    at 26 bits, and the scale has at most 26, so both partial products are
    exact. ``rint(p)`` is wrong only where p is a tie that the exact product
    is not (then the sign of e decides), or where e alone is a tie beside an
    odd p. From ``p`` = 2**53 on a double has no such digit and stays as it is,
    like NaN and the infinities.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be 0 to 7: the scale must fit into 26 bits")
    x = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def product(v: Column) -> Column:
        head = v * 134217729.0 - (v * 134217729.0 - v)
        p = v * scale
        return F.struct(v.alias("x"), p.alias("p"), ((head * scale - p) + (v - head) * scale).alias("e"))

    def decide(t: Column) -> Column:
        p, near = t["p"], F.rint(t["p"])
        off, e, odd = p - near, t["e"], near % 2 != 0
        fixed = (F.when(((off == 0.5) & (e > 0)) | ((off == 0) & (e == 0.5) & odd), near + 1.0)
                 .when(((off == -0.5) & (e < 0)) | ((off == 0) & (e == -0.5) & odd), near - 1.0).otherwise(near))
        plain = t["x"].isNull() | F.isnan(p) | (F.abs(p) >= float(2 ** 53))
        return F.when(plain, t["x"]).otherwise(fixed / scale)

    return let(let(x.cast("double"), product), decide)


def try_double(c: Column | str) -> Column:
    """Text or number to double; NULL when it does not parse."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part / whole * 100`` rounded half up; NULL when ``whole`` is 0."""
    return round_half_up(F.when(whole != 0, part * 100.0 / whole), digits)
