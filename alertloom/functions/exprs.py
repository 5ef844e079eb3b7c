"""Column expressions with the exact semantics the reports need. All run inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from alertloom import schemas as S


def severity_band(level: Column) -> Column:
    """Severity name of a rule level; an unknown level falls into the lowest band."""
    (name, floor), *rest = S.SEVERITY_FLOORS
    band = F.when(level >= floor, name)
    for name, floor in rest:
        band = band.when(level >= floor, name)
    return band.otherwise(S.DEFAULT_SEVERITY)


def severity_rank(severity: Column) -> Column:
    """1 for the most severe band; unknown names sort last."""
    rank = F.when(severity == S.SEVERITY_ORDER[0], 1)
    for i, name in enumerate(S.SEVERITY_ORDER[1:-1], start=2):
        rank = rank.when(severity == name, i)
    return rank.otherwise(len(S.SEVERITY_ORDER))


def sla_minutes(severity: Column, sla: Mapping[str, float] = S.SLA_MINUTES) -> Column:
    """Allowed minutes to open an alert of this severity."""
    branches = [(severity == name, F.lit(v)) for name, v in sla.items() if name != S.DEFAULT_SEVERITY]
    head = F.when(*branches[0])
    chained = reduce(lambda acc, b: acc.when(*b), branches[1:], head)
    return chained.otherwise(F.lit(sla[S.DEFAULT_SEVERITY]))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column, decimals: int = 1) -> Column:
    """Rounded percentage. Multiplies before dividing, in double, never in decimal."""
    return F.round(ratio(F.lit(100.0) * numerator, denominator), decimals)


def instant(ts: Column) -> Column:
    """Zone-less and zoned timestamps on one time line (session zone is UTC)."""
    return ts.cast("timestamp")


def seconds_between(start: Column, end: Column) -> Column:
    """Number of whole-second boundaries crossed from `start` to `end`."""
    return F.unix_seconds(instant(end)) - F.unix_seconds(instant(start))


def minutes(total_seconds: Column, rows: Column, decimals: int = 1) -> Column:
    """Mean minutes from an exact integer sum of seconds."""
    return F.round(ratio(total_seconds, rows) / F.lit(60.0), decimals)


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(ts) + F.lit(1)).cast("bigint")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", instant(ts))


def week_start(ts: Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", instant(ts)).cast("date")


def is_external(ip: Column, internal_prefix: str = S.INTERNAL_PREFIX) -> Column:
    """True for addresses outside the internal prefix; NULL addresses are not external."""
    return ip.isNotNull() & ~ip.startswith(internal_prefix)


def in_maintenance(
    weekday: Column, hour: Column, windows: Iterable[tuple[int, int, int]] = S.MAINTENANCE_WINDOWS
) -> Column:
    """1 inside any (weekday, first hour, last hour) window, else 0."""
    inside = [(weekday == d) & hour.between(a, b) for d, a, b in windows]
    return reduce(lambda x, y: x | y, inside, F.lit(False)).cast("int")


def tactic_column(tactic: str) -> str:
    """Feature column name of a tactic."""
    return "tactic_" + tactic.lower().replace(" ", "_")
