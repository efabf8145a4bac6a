"""Column builders shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = Column | str | date | datetime | None


def moment(as_of: AsOf = None) -> Column:
    """The evaluation time as a timestamp; defaults to the query's start."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def today(as_of: AsOf = None) -> Column:
    return F.to_date(moment(as_of))


def days_ago(n: int, as_of: AsOf = None) -> Column:
    """Midnight ``n`` days before the evaluation day, as a timestamp literal the scan can use."""
    return F.date_sub(today(as_of), n).cast("timestamp")


def ago(interval: str, as_of: AsOf = None) -> Column:
    """``ago("24 hours")``: the evaluation time minus an interval."""
    return moment(as_of) - F.expr(f"INTERVAL {interval}")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def band(value: Column, cuts: Sequence[tuple[float, str]], otherwise: str, strict: bool = False) -> Column:
    """Label of the first cut the value reaches (``>=``, or ``>`` when strict)."""
    out: Any = F
    for cut, label in cuts:
        out = out.when(value > cut if strict else value >= cut, label)
    return out.otherwise(otherwise)


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den where den is positive, else the default."""
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def is_night(ts: Column) -> Column:
    hour = F.hour(ts)
    return (hour < 6) | (hour > 22)


def day_of_week(ts: Column, convention: str = "spark") -> Column:
    """spark: 1=Sunday..7; postgres: 0=Sunday..6; python: 0=Monday..6."""
    if convention == "spark":
        return F.dayofweek(ts)
    if convention == "postgres":
        return F.dayofweek(ts) - 1
    if convention == "python":
        return F.weekday(ts)
    raise ValueError(f"unknown day-of-week convention: {convention}")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def business_hours(ts: Column, first: int = 9, last: int = 18) -> Column:
    return F.hour(ts).between(first, last)


def divergence_pct(expected: Column, got: Column) -> Column:
    """0 for 0/0, 100 for anything against 0, else |expected - got| / |expected| * 100."""
    expected, got = expected.cast("double"), got.cast("double")
    return (
        F.when((expected == 0) & (got == 0), F.lit(0.0))
        .when(expected == 0, F.lit(100.0))
        .otherwise(F.abs(expected - got) / F.abs(expected) * 100.0)
    )


def count_map(name: str, total: str) -> Column:
    """Aggregate of already grouped (name, total) rows into one map ordered by name."""
    return F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(name), F.col(total)))))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))
