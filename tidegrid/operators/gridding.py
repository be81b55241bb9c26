"""Irregular readings onto a regular grid (problem 7).

A reading holds from its time until the next one of its source: the readings become a step function of validity
intervals. The intervals are intersected with grid cells; each cell gets the time-weighted average of what holds in it,
the fraction of it covered by readings that are not too old, and how many readings fall into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.neighbours import with_adjacent

DAY_MS = 86_400_000


def usable_readings(df: DataFrame, *, series: str, id_col: str, time_ms, key_col: str = "instrument_key", value_col: str = "mark_price") -> DataFrame:
    """(series, instrument_key, t, id, value) of readings with a key, a time and a finite value above zero."""
    out = df.select(
        F.lit(series).alias("series"),
        F.col(key_col).alias("instrument_key"),
        time_ms.alias("t"),
        F.col(id_col).alias("id"),
        F.col(value_col).alias("value"),
    )
    finite = (F.col("value") > 0) & (F.col("value") < float("inf")) & ~F.isnan("value")
    return out.where(F.col("instrument_key").isNotNull() & F.col("t").isNotNull() & finite)


def regular_grid(readings: DataFrame, *, step_ms: int = 30_000, hold_ms: int = 60_000, chunk_ms: int = 3_600_000) -> DataFrame:
    """The regular series: series, instrument_key, step_start_ms, n_readings, value, coverage, filled.

    For each series, instrument and UTC day the steps from that of the first to that of the last usable reading. value:
    average over the step weighted by time (what held before is carried into it); coverage: fraction of the step in
    which the reading that holds is at most hold_ms old; filled: the step has no reading of its own. step_ms must divide
    a day. Of readings at the same millisecond the one with the greatest id holds (nulls least), each counts in
    n_readings. Empty input: no rows.
    """
    if DAY_MS % step_ms or DAY_MS % chunk_ms:
        raise ValueError("step and chunk must divide a day")
    once = readings.groupBy("series", "instrument_key", "t").agg(
        F.max_by("value", F.struct(F.coalesce("id", F.lit(-(2**63))), F.col("value"))).alias("value"), F.count(F.lit(1)).alias("n")
    )
    once = once.withColumn("day", F.floor(F.col("t") / DAY_MS)).withColumn("chunk", F.floor(F.col("t") / chunk_ms))
    keys = ["series", "instrument_key", "day"]
    steps = with_adjacent(once, keys, "chunk", ["t"], "t", following="until")
    first_cell, step = F.floor(F.col("t") / step_ms), F.lit(step_ms)
    steps = steps.withColumn("until", F.coalesce("until", (first_cell + 1) * step))
    cells = steps.select(
        "series", "instrument_key", "t", "value", "n", "until",
        F.explode(F.sequence(first_cell, F.greatest(first_cell, F.floor((F.col("until") - 1) / step_ms)))).alias("cell"),
    )
    start, end = F.greatest("t", F.col("cell") * step), F.least("until", (F.col("cell") + 1) * step)
    fresh = F.greatest(F.least(end, F.col("t") + hold_ms) - start, F.lit(0))
    out = cells.groupBy("series", "instrument_key", "cell").agg(
        F.sum(F.when(first_cell == F.col("cell"), F.col("n")).otherwise(0)).alias("n_readings"),
        F.sum(F.col("value") * (end - start)).alias("area"),
        F.sum(end - start).alias("held"),
        F.sum(fresh).alias("fresh"),
    )
    return out.select(
        "series",
        "instrument_key",
        (F.col("cell") * step).cast("long").alias("step_start_ms"),
        "n_readings",
        (F.col("area") / F.col("held")).alias("value"),
        (F.col("fresh") / step).alias("coverage"),
        (F.col("n_readings") == 0).alias("filled"),
    )


def empty_steps(grid: DataFrame) -> DataFrame:
    """(series, instrument_key, step_start_ms) of the steps that had to be filled."""
    return grid.where("filled").select("series", "instrument_key", "step_start_ms")
