"""Right-closed bars over trades, and trade flow: cumulative, trailing and at many instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions.clock import ceil_grid
from tidegrid.operators.asof import asof_join


def trade_bars(trades: DataFrame, *, time_ms: Column, sign: Column, price: str, quantity: str, id_col: str, grid_ms: int, start_ms: int = 0, on: list[str] = ()) -> DataFrame:
    """Bars (T - grid, T]: on, grid_ts, trade_count, buy_volume, sell_volume, net_volume, vwap, imbalance, last_price.

    trade_count counts non-null ids; a side that is unknown adds to neither volume; last_price is the last non-null price
    by time, then id; vwap is over the quantities of both sides, null without any; imbalance 0 without any.
    """
    t, q, p = time_ms, F.col(quantity), F.col(price)
    known = sign.isNotNull()
    g = trades.withColumn("grid_ts", ceil_grid(t, start_ms, grid_ms)).where(t.isNotNull()).groupBy(*on, "grid_ts")
    out = g.agg(
        F.count(id_col).alias("trade_count"),
        F.coalesce(F.sum(F.when(sign == 1, q)), F.lit(0.0)).alias("buy_volume"),
        F.coalesce(F.sum(F.when(sign == -1, q)), F.lit(0.0)).alias("sell_volume"),
        F.sum(F.when(known, q * p)).alias("_qp"),
        F.max_by(price, F.when(p.isNotNull(), F.struct(t.alias("t"), F.col(id_col).alias("i")))).alias("last_price"),
    )
    volume = F.col("buy_volume") + F.col("sell_volume")
    net = F.col("buy_volume") - F.col("sell_volume")
    return out.select(
        *on, "grid_ts", "trade_count", "buy_volume", "sell_volume", net.alias("net_volume"),
        F.when(volume > 0, F.col("_qp") / volume).alias("vwap"), F.when(volume > 0, net / volume).otherwise(0.0).alias("imbalance"), "last_price",
    )


def flow_at(trades: DataFrame, at_ms: int, *, time_ms: Column, sign: Column, quantity: str, keys: list[str], window_ms: int | None = None, staleness_ms: int = 5_000) -> DataFrame:
    """Flow known at an instant per key: buy_volume, sell_volume, cvd, trade_count, last_ms, age_ms, status.

    With window_ms only trades in (at - window, at] count for volumes and count; age is that of the last trade known.
    Volumes are 0 for an empty window. Keys without a trade by then have no row.
    """
    inside = F.lit(True) if window_ms is None else time_ms > at_ms - window_ms
    q = F.col(quantity)
    volume = lambda s: F.coalesce(F.sum(F.when(inside & (sign == s), q)), F.lit(0.0))
    out = trades.where(time_ms <= at_ms).groupBy(*keys).agg(
        volume(1).alias("buy_volume"), volume(-1).alias("sell_volume"), F.count(F.when(inside, 1)).alias("trade_count"), F.max(time_ms).alias("last_ms")
    )
    age = F.lit(at_ms) - F.col("last_ms")
    return out.withColumn("cvd", F.col("buy_volume") - F.col("sell_volume")).withColumn("age_ms", age).withColumn(
        "status", F.when(age <= staleness_ms, "AVAILABLE").otherwise("STALE")
    )


def prefix_sums(trades: DataFrame, *, time_ms: Column, sign: Column, quantity: str, key: str, chunk_ms: int = 3_600_000) -> DataFrame:
    """(key, t, buys, sells, n): running sums by time, one row for each distinct time of a key, carried over chunks."""
    q = F.col(quantity)
    points = trades.where(time_ms.isNotNull() & F.col(key).isNotNull()).groupBy(key, time_ms.alias("t")).agg(
        F.coalesce(F.sum(F.when(sign == 1, q)), F.lit(0.0)).alias("b"), F.coalesce(F.sum(F.when(sign == -1, q)), F.lit(0.0)).alias("s"), F.count(F.lit(1)).alias("c")
    )
    points = points.withColumn("_c", F.floor(F.col("t") / chunk_ms))
    before = Window.partitionBy(key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    sums = points.groupBy(key, "_c").agg(*[F.sum(c).alias(c) for c in "bsc"])
    sums = sums.select(key, "_c", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"p{c}") for c in "bsc"])
    run = Window.partitionBy(key, "_c").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    out = points.join(sums, [key, "_c"])
    return out.select(key, "t", *[(F.col(f"p{c}") + F.sum(c).over(run)).alias(n) for c, n in zip("bsc", ("buys", "sells", "n"))])


def flow_many(trades: DataFrame, points: DataFrame, windows_ms: list[int], *, time_ms: Column, sign: Column, quantity: str, key: str) -> DataFrame:
    """Trailing flow (T - W, T] at many points (key, at_ms) and windows: replayed once into prefix sums, whose values at both
    ends of every window come from one as-of join. A point given twice has one row."""
    sums = prefix_sums(trades, time_ms=time_ms, sign=sign, quantity=quantity, key=key)
    ends = [F.struct(F.lit(w).alias("window_ms"), (F.col("at_ms") - d).alias("end"), F.lit(s).alias("s")) for w in windows_ms for d, s in ((0, 1), (w, -1))]
    asked = points.select(key, "at_ms").distinct().select(key, "at_ms", F.explode(F.array(*ends)).alias("e")).select(key, "at_ms", "e.*")
    met = asof_join(asked, sums, left_ms=F.col("end"), right_ms=F.col("t"), on=[key], right_cols=["buys", "sells", "n"], time_name="_met_ms")
    part = lambda c: F.sum(F.col("s") * F.coalesce(c, F.lit(0)))
    return met.groupBy(key, "at_ms", "window_ms").agg(part("buys").alias("buy_volume"), part("sells").alias("sell_volume"), part("n").alias("trade_count"))
