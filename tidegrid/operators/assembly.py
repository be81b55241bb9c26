"""Streams made ready for an aligned dataset: one instrument, one clock, one day's grid; bars of liquidations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.clock import ceil_grid, last_grid_instant


def prepare_stream(df: DataFrame, prefix: str, *, instrument: str) -> DataFrame:
    """df on its availability clock: <prefix>_ts (local_timestamp, or timestamp where the table has no such column),
    <prefix>_process_ts, <prefix>_exchange_ts, <prefix>_time_unknown (whether it had to fall back), and <prefix>_loss: null for rows
    that stay, else why one can't be used (other_instrument, no_time).

    A null instrument_key is no contradiction. local_timestamp and instrument_key go. Nothing is dropped here, so losses can
    be counted in the same pass; ``usable`` drops them.
    """
    known = "local_timestamp" in df.columns
    at = F.col("local_timestamp" if known else "timestamp")
    other = F.coalesce(F.col("instrument_key") != instrument, F.lit(False)) if "instrument_key" in df.columns else F.lit(False)
    out = df.withColumn(f"{prefix}_ts", at).withColumn(f"{prefix}_time_unknown", F.lit(not known))
    out = out.withColumn(f"{prefix}_loss", F.when(other, "other_instrument").when(at.isNull(), "no_time"))
    names = {"timestamp": f"{prefix}_process_ts", "exchange_timestamp": f"{prefix}_exchange_ts"}
    return out.withColumnsRenamed(names).drop("local_timestamp", "instrument_key")


def usable(prepared: DataFrame, prefix: str) -> DataFrame:
    return prepared.where(F.col(f"{prefix}_loss").isNull()).drop(f"{prefix}_loss")


def losses(prepared: DataFrame, prefix: str) -> DataFrame:
    """(loss, n) of the rows ``usable`` drops."""
    return prepared.where(F.col(f"{prefix}_loss").isNotNull()).groupBy(F.col(f"{prefix}_loss").alias("loss")).agg(F.count(F.lit(1)).alias("n"))


def day_place(t: Column, start_ms: int, end_ms: int, grid_ms: int) -> Column:
    """Where a time lies to the grid of [start, end): inside, before, trailing (after the last grid instant) or after; null for none."""
    last = last_grid_instant(start_ms, end_ms, grid_ms)
    return F.when(t < start_ms, "before").when(t >= end_ms, "after").when(t > last, "trailing").when(t.isNotNull(), "inside")


def liquidation_bars(rows: DataFrame, *, time_ms: Column, side: Column, price: str, quantity: str, grid_ms: int, start_ms: int, end_ms: int, identity: list[str], on: list[str] = ()) -> DataFrame:
    """Bars (T - grid, T] of a day: on, grid_ts, liquidation_count, _buy_volume, _sell_volume, _net_volume, _notional and
    _dup_dropped, the rows like an earlier one in ``identity`` (null cells make no identity) in the bin.

    side: above 0 buys, below sells. Which of like rows stays doesn't show, as they must agree in bin, price and quantity to be
    alike, so identity has to hold what the sums read. Rows outside the day's grid add nothing.
    """
    inside = rows.withColumn("grid_ts", ceil_grid(time_ms, start_ms, grid_ms)).where(day_place(time_ms, start_ms, end_ms, grid_ms) == "inside").withColumn("_side", side)
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    keys = list(dict.fromkeys([*on, "grid_ts", *identity, price, quantity, "_side"]))
    alike = inside.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_dup", F.col("_n") - 1)
    single = inside.where(~known).select(*keys).withColumn("_n", F.lit(1).cast("long")).withColumn("_dup", F.lit(0).cast("long"))
    q, p, s = F.col(quantity), F.col(price), F.col("_side")
    total = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    buys, sells = total(F.when(s > 0, q)), total(F.when(s < 0, q))
    return alike.unionByName(single).groupBy(*on, "grid_ts").agg(
        F.count(p).alias("liquidation_count"), buys.alias("liquidation_buy_volume"), sells.alias("liquidation_sell_volume"), (buys - sells).alias("liquidation_net_volume"),
        total(q * p).alias("liquidation_notional"), F.sum("_dup").alias("liquidation_dup_dropped"),
    )


def trade_row(maker: Column, quantity: Column) -> dict[str, Column]:
    """side_sign (-1 if the buyer is the maker, else 1; null as no) and signed_qty."""
    sign = F.when(F.coalesce(maker, F.lit(False)), -1).otherwise(1)
    return {"side_sign": sign, "signed_qty": quantity.cast("double") * sign}


def mark_row(funding: Column, next_funding_ms: Column, exchange_ms: Column) -> dict[str, Column]:
    """funding_rate_bps and hours_to_funding."""
    return {"funding_rate_bps": funding.cast("double") * 10_000.0, "hours_to_funding": (next_funding_ms - exchange_ms) / 3_600_000.0}


def liquidation_row(side: Column, price: Column, quantity: Column) -> dict[str, Column]:
    """side (1 for BUY, else -1, also unknown ones) and signed_qty; both null where price or quantity isn't above zero."""
    ok = (price > 0) & (quantity > 0)
    sign = F.when(side == "BUY", 1).otherwise(-1)
    return {"side": F.when(ok, sign), "signed_qty": F.when(ok, quantity.cast("double") * sign)}


def comparable_unit(interest: DataFrame, *, unit: str = "unit", exchange: str = "exchange") -> DataFrame:
    """interest, or an error when it is read if it mixes units or exchanges, or a unit is UNKNOWN or null: such figures can't be compared."""
    kinds = interest.agg(F.count_distinct(unit).alias("u"), F.count_distinct(exchange).alias("e"), F.count_if(F.coalesce(F.col(unit), F.lit("UNKNOWN")) == "UNKNOWN").alias("x"))
    ok = kinds.select(F.when((F.col("u") > 1) | (F.col("e") > 1) | (F.col("x") > 0), F.raise_error("open interest of unlike units or exchanges")).otherwise(F.lit(True)).alias("_ok"))
    return interest.join(F.broadcast(ok), F.col("_ok")).drop("_ok")  # one row


def base_coin_interest(unit: Column, interest: Column, in_currency: Column) -> Column:
    return F.when(unit == "BASE_COIN", interest).otherwise(in_currency)


def end_boundary(df: DataFrame, time: str, allowed_end: int) -> DataFrame:
    """df, or an error for a row later than allowed_end; as a condition of the rows, no column pruning drops it."""
    late = F.raise_error(F.concat(F.lit("row after the allowed end: "), F.col(time).cast("string"))).cast("boolean")
    return df.where(F.when(F.col(time) > allowed_end, late).otherwise(F.lit(True)))
