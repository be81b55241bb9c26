"""Pairing of records by nearest time (problem 3).

Each distinct time of the right side serves the times nearer to it than to its neighbours: an interval bounded by the
midpoints to both, and by the tolerance. The intervals of an entity don't overlap, so a left row lies in at most one.
Intervals are indexed by the slots of time they touch (two at most), and the range join is an equi-join on entity and
slot with the interval's bounds as a condition: a hot entity is spread over its slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.neighbours import chunk_of, with_adjacent


def entity_name(column: Column) -> Column:
    """Keys that differ in letter case or surrounding blanks name the same entity."""
    return F.lower(F.regexp_replace(column, r"^[\s ]+|[\s ]+$", ""))


def nearest_pairs(
    left: DataFrame, right: DataFrame, *, left_id: str, left_key: Column, left_ms: Column, right_id: str, right_key: Column, right_ms: Column,
    tolerance_ms: int = 5_000, chunk_ms: int = 3_600_000,
) -> DataFrame:
    """(left_id, right_id, distance_ms): for each left row with key and time the nearest right row of its entity.

    The distance is at most tolerance_ms, inclusive. Ties: the earlier right time, then the lower right id (a null id last).
    Left rows without a partner are absent; repeated left rows each have a row; a right row may serve several. Rows with a
    null key or time take no part; other columns, whatever their names, are not read. Empty tables: no rows.
    """
    width = 2 * tolerance_ms + 1
    times = right.select(right_key.alias("_e"), right_ms.alias("_t"), F.col(right_id).alias("_r")).where(F.col("_e").isNotNull() & F.col("_t").isNotNull())
    times = times.groupBy("_e", "_t").agg(F.min("_r").alias("_r")).withColumn("_c", chunk_of(F.col("_t"), chunk_ms))
    near = with_adjacent(times, ["_e"], "_c", ["_t"], "_t", prev="_p", following="_n")
    low = F.greatest(F.col("_t") - tolerance_ms, F.coalesce(F.floor((F.col("_p") + F.col("_t")) / 2) + 1, F.col("_t") - tolerance_ms))
    high = F.least(F.col("_t") + tolerance_ms, F.coalesce(F.floor((F.col("_t") + F.col("_n")) / 2), F.col("_t") + tolerance_ms))
    spans = near.select("_e", "_t", "_r", low.cast("long").alias("_low"), high.cast("long").alias("_high"))
    index = spans.withColumn("_s", F.explode(F.sequence(chunk_of(F.col("_low"), width), chunk_of(F.col("_high"), width))))
    rows = left.select(F.col(left_id).alias("_l"), left_key.alias("_e"), left_ms.alias("_at")).where(F.col("_e").isNotNull() & F.col("_at").isNotNull())
    rows = rows.withColumn("_s", chunk_of(F.col("_at"), width))
    met = rows.join(index, ["_e", "_s"]).where((F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high")))
    return met.select(F.col("_l").alias(left_id), F.col("_r").alias(right_id), F.abs(F.col("_at") - F.col("_t")).alias("distance_ms"))
