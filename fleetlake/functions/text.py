"""Text normalisation expressions (route names, ids, keys)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

from ..config import DEFAULT_ROUTES, RouteMap


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_route(c: Column | str, routes: RouteMap = DEFAULT_ROUTES) -> Column:
    """Canonical route name.

    ``case`` mode (warehouse): CASE upper(raw) WHEN <canonical> THEN ... ELSE
    upper(raw) END; NULL stays NULL. ``map`` mode (local): dictionary lookup
    on the raw text, else upper(raw).
    """
    raw = _col(c)
    up = F.upper(raw)
    if routes.mode == "case":
        expr = None
        for canon in dict.fromkeys(v for v in routes.mapping.values()):
            cond = up == F.lit(canon.upper())
            expr = F.when(cond, F.lit(canon)) if expr is None else expr.when(cond, F.lit(canon))
        return up if expr is None else expr.otherwise(up)
    lookup = F.create_map(*[F.lit(x) for kv in routes.mapping.items() for x in kv])
    return F.coalesce(F.element_at(lookup, raw), up)


def clean_id(c: Column | str) -> Column:
    """trim + upper, as the live path does for bus ids and routes."""
    return F.upper(F.trim(_col(c)))


def minute_bucket(c: Column | str) -> Column:
    """Timestamp truncated to the minute."""
    return F.date_trunc("minute", _col(c))


def composite_key(*cols: Column | str) -> Column:
    """CONCAT of text casts without separator; NULL if any part is NULL.

    Kept for fidelity with the warehouse profile. It can collide ("1"+"23"
    vs "12"+"3") and the double-to-text form differs between engines, so the
    library itself counts distinct rows with ``struct`` keys instead.
    """
    return F.concat(*[_col(c).cast("string") for c in cols])


def rejection_text(reason: Column) -> Column:
    """The activity log's text of a rejection: the stage that refused the
    event (missing ids and numbers that do not parse fail normalisation, the
    range checks are validation) and its reason."""
    stage = F.when(reason.isin(C.REASON_REQUIRED, C.REASON_NUMERIC), C.STAGE_NORMALISE).otherwise(C.STAGE_VALIDATE)
    return F.concat(stage, F.lit(": "), reason)
