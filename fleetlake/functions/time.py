"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday_name(c: Column | str) -> Column:
    """English full weekday name (Monday...), not the 3-letter ``dayname``."""
    return F.date_format(_col(c), "EEEE")


def with_date_parts(df: DataFrame, ts: str = "Timestamp", date: str = "Fecha",
                    hour: str = "Hora", weekday: str = "DiaSemana") -> DataFrame:
    """Add date, hour (bigint) and weekday name columns."""
    t = F.col(ts)
    return df.select("*", F.to_date(t).alias(date), F.hour(t).cast("long").alias(hour),
                     weekday_name(t).alias(weekday))


def calendar_parts(c: Column | str) -> list[Column]:
    """year, month, day as bigint columns named anio/mes/dia."""
    t = _col(c)
    return [F.year(t).cast("long").alias("anio"), F.month(t).cast("long").alias("mes"),
            F.dayofmonth(t).cast("long").alias("dia")]


def parse_ts(c: Column | str, fmt: str | None = TS_FORMAT) -> Column:
    """Text to timestamp; NULL when the text does not match ``fmt``."""
    col = _col(c)
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def parse_iso_utc(c: Column | str) -> Column:
    """ISO-8601 text with a ``Z`` or offset suffix to a timestamp."""
    return F.to_timestamp(_col(c))
