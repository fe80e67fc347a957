"""Date expressions (FN-09..11, FN-14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydromart.functions.codes import ColumnOrName, _col


def sunday_week(d: ColumnOrName) -> Column:
    """FN-09: week number 0..53, weeks start on Sunday; days before the first Sunday are week 0."""
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def calendar_parts(d: ColumnOrName) -> dict[str, Column]:
    """FN-09: the calendar attributes of ``dim_date`` (``dayofweek``: 1 = Sunday)."""
    d = _col(d)
    return {
        "annee": F.year(d),
        "trimestre": F.quarter(d),
        "mois": F.month(d),
        "semaine": sunday_week(d),
        "jour": F.dayofmonth(d),
        "jour_semaine": F.dayofweek(d),
    }


def day_gap(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """FN-10: whole days from ``earlier`` to ``later``."""
    return F.datediff(_col(later), _col(earlier))


def as_date(value) -> Column:
    """A literal date column from a ``date`` / ISO string / Column (FN-11 parameters)."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.current_date()
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, str):
        value = dt.date.fromisoformat(value[:10])
    return F.lit(value)


def as_timestamp(value) -> Column:
    if isinstance(value, Column):
        return value
    if value is None:
        return F.current_timestamp()
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    return F.lit(value).cast("timestamp")


def sentinel_date(ts: ColumnOrName, floor: str = "1900-01-01") -> Column:
    """FN-14: a timestamp before ``floor`` is a sentinel and becomes NULL; otherwise its date."""
    # ts < floor 00:00  <=>  date(ts) < floor, for zoned and zone-less timestamps alike
    day = F.to_date(_col(ts))
    return F.when(day < F.lit(floor).cast("date"), F.lit(None).cast("date")).otherwise(day)
