"""Epoch-millisecond time as integer columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def epoch_ms(ts: Column) -> Column:
    """Timestamps, with or without a zone (read as UTC), to epoch ms; null stays null."""
    return F.unix_millis(ts.cast("timestamp"))


def ceil_grid(t: Column, start: int, grid: int) -> Column:
    """The first instant of the grid start, start + grid, ... at or after t: the label of a right-closed bin (T - grid, T]."""
    offset = t - F.lit(start)
    return (F.lit(start) + offset + F.pmod(-offset, F.lit(grid))).cast("long")


def last_grid_instant(start: int, end: int, grid: int) -> int:
    """The last grid instant before end."""
    return start + (end - start - 1) // grid * grid


def purge_days(horizon_s: Column) -> Column:
    """Days to purge for a label horizon: none for none, else at least one."""
    return F.when(horizon_s <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.ceil(horizon_s / 86_400))).cast("int")


def coerce_ms(text: Column) -> Column:
    """Any of epoch ms, a decimal number (cut towards zero) or an ISO time (naive: UTC) as text; else null."""
    number = text.try_cast("double")
    whole = F.when(~F.isnan(number) & (F.abs(number) < 9e18), number.try_cast("long"))
    return F.coalesce(text.try_cast("long"), whole, F.unix_millis(text.try_cast("timestamp")))


def receive_time(text: Column) -> Column:
    """Struct (ms, reason) of a recorded receive time as text: reason is null, or INVALID_LOCAL_RECEIVE_TS_ and NONE, BOOL, NON_INT
    (no time at all) or NEGATIVE. ISO times and decimal numbers are times (see ``coerce_ms``)."""
    ms = coerce_ms(text)
    name = "INVALID_LOCAL_RECEIVE_TS_"
    reason = (
        F.when(text.isNull() | F.lower(F.trim(text)).isin("null", "nat"), name + "NONE").when(F.lower(F.trim(text)).isin("true", "false"), name + "BOOL").when(ms.isNull(), name + "NON_INT")
        .when(ms < 0, name + "NEGATIVE")
    )
    return F.struct(F.when(reason.isNull(), ms).alias("ms"), reason.alias("reason"))
