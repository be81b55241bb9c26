"""Evidence-based coverage: an observation at t covers [t, t + tolerance); what is left of a window are its gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.neighbours import chunk_of, with_adjacent


def coverage_gaps(observations: DataFrame, windows: DataFrame | tuple[int, int], *, key: str | None = None, time_ms: Column, tolerance_ms: int, chunk_ms: int = 3_600_000) -> DataFrame:
    """(key, start_ms, end_ms, duration_ms, kind) of each key in windows (key, window_start_ms, window_end_ms; one a key), or,
    without a key, of the one window (start, end).

    kind: LEADING (starts with the window), INTERIOR, TRAILING (ends with it), ABSENT (no evidence at all). An observation
    before the window still covers the tolerance after it: a gap behind it is INTERIOR, or TRAILING if it never ends.
    Touching intervals merge. Null keys and times are no evidence.
    """
    seen = observations.where(time_ms.isNotNull())
    keys = [] if key is None else [key]
    if key is None:
        bounds = [F.lit(t).cast("long").alias(n) for t, n in zip(windows, ("window_start_ms", "window_end_ms"))]
        seen = seen.select(time_ms.alias("t"), *bounds)
    else:
        seen = seen.where(F.col(key).isNotNull()).select(key, time_ms.alias("t")).join(windows, key)
    seen = seen.where((F.col("t") > F.col("window_start_ms") - tolerance_ms) & (F.col("t") < F.col("window_end_ms"))).distinct()
    seen = seen.withColumn("_c", chunk_of(F.col("t"), chunk_ms))
    near = with_adjacent(seen, keys, "_c", ["t"], "t", prev="before", following="after")
    covered = F.col("t") + tolerance_ms
    until = F.coalesce("after", "window_end_ms")
    gap = lambda holds, start, end, kind: F.when(holds, F.struct(start.alias("start_ms"), end.alias("end_ms"), kind.alias("kind")))
    behind = gap(covered < until, covered, until, F.when(F.col("after").isNull(), "TRAILING").otherwise("INTERIOR"))
    ahead = gap(F.col("before").isNull() & (F.col("t") > F.col("window_start_ms")), F.col("window_start_ms"), F.col("t"), F.lit("LEADING"))
    found = near.select(*keys, F.explode(F.array_compact(F.array(behind, ahead))).alias("g")).select(*keys, "g.*")
    if key is None:
        absent = seen.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(*bounds)
    else:
        absent = windows.join(seen.select(key).distinct(), key, "left_anti")
    absent = absent.select(*keys, F.col("window_start_ms").alias("start_ms"), F.col("window_end_ms").alias("end_ms"), F.lit("ABSENT").alias("kind"))
    every = found.unionByName(absent)
    return every.select(*keys, "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), "kind")


def coverage_report(observations: DataFrame, windows: DataFrame, *, key: str, time_ms: Column, tolerance_ms: int) -> DataFrame:
    """One row per key of windows: covered_ms, missing_ms, coverage_pct, status, gap_count, longest_gap_ms, leading_ms,
    interior_ms, trailing_ms, observation_count, duplicate_count, first_ms, last_ms."""
    gaps = coverage_gaps(observations, windows, key=key, time_ms=time_ms, tolerance_ms=tolerance_ms)
    part = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("duration_ms")).otherwise(0))
    lost = gaps.groupBy(key).agg(
        F.sum("duration_ms").alias("missing_ms"), F.count(F.lit(1)).alias("gap_count"), F.max("duration_ms").alias("longest_gap_ms"),
        part("LEADING").alias("leading_ms"), part("INTERIOR").alias("interior_ms"), part("TRAILING").alias("trailing_ms"),
    )
    inside = observations.where(time_ms.isNotNull()).select(key, time_ms.alias("t")).join(windows, key).where("t >= window_start_ms and t < window_end_ms")
    counts = inside.groupBy(key, "t").agg(F.count(F.lit(1)).alias("c")).groupBy(key).agg(
        F.count(F.lit(1)).alias("observation_count"), (F.sum("c") - F.count(F.lit(1))).alias("duplicate_count"), F.min("t").alias("first_ms"), F.max("t").alias("last_ms")
    )
    out = windows.join(lost, key, "left").join(counts, key, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    span = F.col("window_end_ms") - F.col("window_start_ms")
    missing = zero("missing_ms")
    status = F.when(missing == 0, "COMPLETE").when(missing == span, "ABSENT").otherwise("PARTIAL")
    return out.select(
        key, (span - missing).alias("covered_ms"), missing.alias("missing_ms"), ((span - missing) * 100 / span).alias("coverage_pct"), status.alias("status"),
        *[zero(c).alias(c) for c in ("gap_count", "longest_gap_ms", "leading_ms", "interior_ms", "trailing_ms", "observation_count", "duplicate_count")],
        "first_ms", "last_ms",
    )
