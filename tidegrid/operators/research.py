"""Forward labels, chronological splits, column statistics and checks of a dataset's grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import materialize

HORIZONS_S = (1, 5, 15, 60, 300)


def forward_labels(grid: DataFrame, *, time: str, price: str, grid_ms: int, horizons_s=HORIZONS_S, threshold: float = 5e-5, on: list[str] = ()) -> DataFrame:
    """grid with return_<h>s and direction_<h>s per horizon; rows without every return are dropped.

    The future price is met by time (t + h), an equi-join per horizon, so no key is ordered in one task; a horizon must be
    a whole multiple of the grid. direction is 1 or -1 strictly beyond the threshold, else 0. A row whose time occurs
    twice is an error of the grid (see ``grid_report``).
    """
    out = grid
    for h in horizons_s:
        if h * 1000 % grid_ms:
            raise ValueError(f"a horizon of {h} s is no multiple of a grid of {grid_ms} ms")
        later = grid.select(*on, (F.col(time) - h * 1000).alias(time), F.col(price).alias("_f"))
        out = out.join(later, [*on, time], "left")
        back = F.try_divide(F.col("_f") - F.col(price), F.col(price))
        out = out.withColumn(f"return_{h}s", back).drop("_f")
    out = out.dropna(subset=[f"return_{h}s" for h in horizons_s])
    for h in horizons_s:
        r = F.col(f"return_{h}s")
        out = out.withColumn(f"direction_{h}s", F.when(r > threshold, 1).when(r < -threshold, -1).otherwise(0).cast("tinyint"))
    return out


def grid_report(df: DataFrame, *, time: str, grid_ms: int, on: list[str], chunk_ms: int = 86_400_000) -> DataFrame:
    """Per key: rows, irregular steps (unlike grid_ms), the commonest step (the least of several) and duplicate times."""
    from tidegrid.operators.neighbours import chunk_of, with_adjacent

    once = df.where(F.col(time).isNotNull()).groupBy(*on, time).agg(F.count(F.lit(1)).alias("_n")).withColumn("_c", chunk_of(F.col(time), chunk_ms))
    near = with_adjacent(once, list(on), "_c", [time], time, prev="_p").withColumn("_d", F.col(time) - F.col("_p"))
    return near.groupBy(*on).agg(
        F.sum("_n").alias("n_rows"), F.count_if((F.col("_d") != grid_ms)).alias("irregular_steps"), F.mode("_d", True).alias("step_ms"), F.sum(F.col("_n") - 1).alias("duplicate_times")
    )


def split_manifest(dates: list, *, horizon_s: int = 300, embargo_days: int = 1, purge_days: int | None = None, train: float = 0.70, validate: float = 0.85) -> dict:
    """Leakage-safe chronological split of sorted distinct dates (a list on the driver: one entry a day).

    The days to purge follow from the label horizon; purge and embargo are taken from the end of the earlier split.
    Returns lists train, val, test, and required_purge, gap, leakage_safe.
    """
    import math

    required = 0 if horizon_s <= 0 else max(1, math.ceil(horizon_s / 86_400))
    gap = (required if purge_days is None else purge_days) + embargo_days
    days = sorted(set(dates))
    a, b = int(len(days) * train), int(len(days) * validate)
    parts = {"train": days[: max(a - gap, 0)], "val": days[a : max(b - gap, a)], "test": days[b:]}
    held = [p for p in parts.values() if p]
    safe = len(held) == 3 and (purge_days is None or purge_days >= required)
    safe = safe and all((y[0] - x[-1]).days - 1 >= gap for x, y in zip(held, held[1:]))
    return parts | {"required_purge": required, "gap": gap, "leakage_safe": safe}


def column_stats(df: DataFrame, columns: list[str], *, values_per_part: int = 500_000) -> DataFrame:
    """One row per numeric or boolean column: mean, std (sample), min, max, p01, p99 (interpolated), count, null_count.

    NaN counts as null. Percentiles are exact: distinct values are counted, range-partitioned by column and value, and the
    values at the wanted ranks are found by counts carried over the partitions, so no column is gathered in one place.
    """
    spark = df.sparkSession
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), number(c).alias("v")) for c in columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.column_name", "p.v")
    names = spark.createDataFrame([(c,) for c in columns], "column_name string")
    stats = values.groupBy("column_name").agg(
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.count("v").alias("count"), F.count_if(F.col("v").isNull()).alias("null_count")
    )
    counted = materialize(values.where("v is not null").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c")), "counted-values")
    parts = max(1, -(-counted.count() // values_per_part))
    placed = materialize(counted.repartitionByRange(parts, "column_name", "v").withColumn("part", F.spark_partition_id()), "ranked-values")
    sums = placed.groupBy("column_name", "part").agg(F.sum("c").alias("s"))
    before = F.sum("s").over(Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("column_name", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("s").over(Window.partitionBy("column_name")).alias("n"))
    upto = F.sum("c").over(Window.partitionBy("column_name", "part").orderBy("v"))
    ranked = placed.withColumn("upto", upto).join(sums, ["column_name", "part"]).withColumn("high", F.col("before") + F.col("upto"))
    at = lambda p: F.lit(p) * (F.col("n") - 1)
    holds = lambda rank: (F.col("high") > rank) & (F.col("high") - F.col("c") <= rank)
    picks = [F.max(F.when(holds(f(at(p))), F.col("v"))).alias(f"{n}{i}") for n, p in (("p01", 0.01), ("p99", 0.99)) for i, f in enumerate((F.floor, F.ceil))]
    found = ranked.groupBy("column_name").agg(*picks, F.max("n").alias("n"))
    part = lambda p: at(p) - F.floor(at(p))
    value = lambda n, p: (F.col(f"{n}0") + (F.col(f"{n}1") - F.col(f"{n}0")) * part(p)).alias(n)
    found = found.select("column_name", value("p01", 0.01), value("p99", 0.99))
    out = names.join(stats, "column_name", "left").join(found, "column_name", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("column_name", "mean", "std", "min", "max", "p01", "p99", zero("count"), zero("null_count"))


def validity_reason(*rules: tuple[str, Column]) -> Column:
    """The first rule (reason, condition that must hold) a row breaks, or null; a condition that is null is broken."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return reason


def gaps_since_last(df: DataFrame, *, key: str, time_ms: Column, order: list[str], threshold_ms: int, chunk: Column) -> DataFrame:
    """Rows that come more than threshold_ms after the latest time seen before them in arrival order; a time that steps
    back doesn't move the latest. Columns: key, order, t, gap_ms."""
    rows = df.select(key, *order, time_ms.alias("t"), chunk.alias("_c")).where(F.col(key).isNotNull() & F.col("t").isNotNull())
    own = Window.partitionBy(key, "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(key, "_c").agg(F.max("t").alias("top"))
    tops = tops.select(key, "_c", F.max("top").over(Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    out = rows.join(tops, [key, "_c"])
    gap = F.col("t") - F.greatest(F.max("t").over(own), "_before")
    return out.withColumn("gap_ms", gap).where(F.col("gap_ms") > threshold_ms).select(key, *order, "t", "gap_ms")
