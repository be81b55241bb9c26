"""As-of joins, snapshots of the latest row per key, and interval overlap, without ordering a whole key in one task."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.neighbours import chunk_of


@dataclass
class Side:
    """A right side of ``asof_joins``: its rows, time, columns to bring, the order among rows of one time, and the age allowed."""

    rows: DataFrame
    time_ms: Column
    cols: list[str]
    time_name: str = "matched_ms"
    seq: list[str] = field(default_factory=list)
    tolerance_ms: int | None = None


def asof_joins(left: DataFrame, sides: list[Side], *, left_ms: Column, on: list[str] = (), chunk_ms: int = 3_600_000) -> DataFrame:
    """left with, of each side, the columns of its last row at or before left's time (same ``on`` values), and that row's time.

    All sides share one union, one shuffle by key and chunk of time, and one window; what a chunk inherits from those before
    it is carried over a table with one row a chunk, read from the same shuffle. Inclusive on both ends: equal times match, an
    age of exactly tolerance_ms matches. Of a side's rows at one time the greatest in ``seq`` counts. Whole rows are matched,
    their null cells stay null. Left rows with a null time or key match nothing but stay. Names of the sides' columns
    replace none of left's or each other's: clashes raise an error.
    """
    names = [*left.columns, *[c for s in sides for c in (s.time_name, *s.cols)]]
    if clash := {c for c in names if names.count(c) > 1}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = [f"_k{i}" for i in range(len(on))]
    of = [F.col(c).alias(k) for c, k in zip(on, keys)]
    both = left.select(*of, left_ms.alias("_t"), F.struct(*left.columns).alias("_l"), F.lit(len(sides)).alias("_side"))
    for i, s in enumerate(sides):
        order = F.struct(*[F.col(c).alias(f"s{j}") for j, c in enumerate(s.seq)]) if s.seq else F.lit(0)
        row = F.struct(s.time_ms.alias(s.time_name), *[F.col(c) for c in s.cols])
        r = s.rows.select(*of, s.time_ms.alias("_t"), order.alias(f"_o{i}"), row.alias(f"_r{i}"), F.lit(i).alias("_side")).where("_t is not null")
        for k in keys:
            r = r.where(F.col(k).isNotNull())
        both = both.unionByName(r, allowMissingColumns=True)
    places = [f"_o{i}" for i in range(len(sides))]
    both = both.withColumn("_c", F.coalesce(chunk_of(F.col("_t"), chunk_ms), F.lit(-(2**62)))).repartition(*keys, "_c")
    of_side = lambda i, *c: F.when(F.col("_side") == i, F.struct("_t", *c))
    last = [F.max_by(f"_r{i}", of_side(i, f"_o{i}")).alias(f"_e{i}") for i in range(len(sides))]
    # _l is counted so that this branch reads the very shuffle the rows below read
    edges = both.groupBy(*keys, "_c").agg(*last, F.count("_l").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.where("_c > -4611686018427387904").select(*keys, "_c", *[F.last(f"_e{i}", True).over(before).alias(f"_b{i}") for i in range(len(sides))])
    within = Window.partitionBy(*keys, "_c").orderBy("_t", "_side", *places).rowsBetween(Window.unboundedPreceding, 0)
    met = both.select("*", *[F.last(f"_r{i}", True).over(within).alias(f"_m{i}") for i in range(len(sides))]).where(F.col("_side") == len(sides))
    met = met.select(*keys, "_c", "_t", "_l", *[f"_m{i}" for i in range(len(sides))]).join(carry, [*keys, "_c"], "left")
    out = [F.col("_l")[c].alias(c) for c in left.columns]
    for i, s in enumerate(sides):
        m = F.coalesce(f"_m{i}", f"_b{i}")
        fresh = F.col("_t").isNotNull()
        if s.tolerance_ms is not None:
            fresh = fresh & (F.col("_t") - m[s.time_name] <= s.tolerance_ms)
        out += [F.when(fresh, m[c]).alias(c) for c in (s.time_name, *s.cols)]
    return met.select(*out)


def asof_join(
    left: DataFrame, right: DataFrame, *, left_ms: Column, right_ms: Column, on: list[str] = (), right_cols: list[str], seq: list[str] = (),
    tolerance_ms: int | None = None, chunk_ms: int = 3_600_000, time_name: str = "matched_ms",
) -> DataFrame:
    """``asof_joins`` with one right side."""
    side = Side(right, right_ms, list(right_cols), time_name, list(seq), tolerance_ms)
    return asof_joins(left, [side], left_ms=left_ms, on=list(on), chunk_ms=chunk_ms)


def latest_per_key(events: DataFrame, at_ms: int, *, keys: list[str], time_ms: Column, seq: list[str], value_cols: list[str], staleness_ms: int, expected: DataFrame | None = None) -> DataFrame:
    """Newest eligible row per key at an instant: keys, value_cols, last_ms, age_ms, status.

    A row is eligible if its time is at most at_ms. status: AVAILABLE up to an age of staleness_ms, inclusive, else
    STALE; expected keys without a row are NEVER_OBSERVED. One partial aggregation; stale rows are kept, labelled.
    """
    seen = events.where(time_ms <= at_ms)
    order = F.struct(time_ms.alias("t"), *seq)
    newest = seen.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), order).alias("_v"), F.max(time_ms).alias("last_ms"))
    newest = newest.select(*keys, *[F.col("_v")[c].alias(c) for c in value_cols], "last_ms")
    if expected is not None:
        newest = newest.join(expected.select(*keys).distinct(), keys, "full_outer")
    age = F.lit(at_ms) - F.col("last_ms")
    status = F.when(age.isNull(), "NEVER_OBSERVED").when(age <= staleness_ms, "AVAILABLE").otherwise("STALE")
    return newest.withColumn("age_ms", age).withColumn("status", status)


def snapshots(events: DataFrame, instants: DataFrame, *, key: str, time_ms: Column, seq: list[str], value_cols: list[str], staleness_ms: int, chunk_ms: int = 3_600_000) -> DataFrame:
    """``latest_per_key`` at many instants (column at_ms): the keys met in events times the instants, one as-of join.

    The wanted rows are the product itself; it is made in blocks: instants fall into blocks by hash, keys go to every block.
    """
    blocks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = events.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    points = instants.select("at_ms").distinct().withColumn("_b", F.pmod(F.xxhash64("at_ms"), F.lit(blocks)).cast("int"))
    grid = keys.join(points, "_b").select(key, "at_ms")
    out = asof_join(grid, events, left_ms=F.col("at_ms"), right_ms=time_ms, on=[key], right_cols=value_cols, seq=seq, chunk_ms=chunk_ms, time_name="last_ms")
    age = F.col("at_ms") - F.col("last_ms")
    return out.withColumn("age_ms", age).withColumn("status", F.when(age.isNull(), "NEVER_OBSERVED").when(age <= staleness_ms, "AVAILABLE").otherwise("STALE"))


def bins_observed(bins: DataFrame, gaps: DataFrame, *, bin_end: str, grid_ms: int, on: list[str] = ()) -> DataFrame:
    """bins with ``observed``: whether (bin_end - grid_ms, bin_end] meets none of the gaps [start_ms, end_ms).

    Gaps of a key are disjoint, so the last one that starts at or before a bin's end decides: one as-of join instead of a
    range join.
    """
    met = asof_join(bins, gaps, left_ms=F.col(bin_end), right_ms=F.col("start_ms"), on=list(on), right_cols=["end_ms"], time_name="_gap_ms")
    return met.withColumn("observed", unmet(F.col("end_ms"), F.col(bin_end), grid_ms)).drop("end_ms", "_gap_ms")


def unmet(gap_end: Column, bin_end: Column, grid_ms: int) -> Column:
    """Whether the last gap that starts at or before a bin's end is over before the bin (T - grid, T] begins, or there is none."""
    return F.coalesce(gap_end <= bin_end - grid_ms + 1, F.lit(True))


def fixed_grid(spark, start_ms: int, end_ms: int, grid_ms: int, name: str = "grid_ts") -> DataFrame:
    """start, start + grid, ... before end, made by the executors."""
    return spark.range(start_ms, end_ms, grid_ms).withColumnRenamed("id", name)
