"""Validity of rows against what was accepted before them, and comparison of sequence numbers by venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators.research import validity_reason
from tidegrid.session import add_package

#: Clocks further apart than this are an event of their own; the row stays.
CLOCK_DRIFT_MS = 5_000


def finite(x: Column) -> Column:
    """Whether a number is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def positive(x: Column) -> Column:
    return finite(x) & (x > 0)


def time_rules(time: Column, exchange: Column) -> list[tuple[str, Column]]:
    return [("Invalid timestamp", F.coalesce(time > 0, F.lit(False))), ("Invalid exchange timestamp", exchange.isNull() | (exchange > 0))]


def trade_rules(price: Column, quantity: Column) -> list[tuple[str, Column]]:
    """Also those of liquidations."""
    return [("Invalid price", positive(price)), ("Invalid quantity", positive(quantity))]


def mark_rules(mark: Column, funding: Column, next_funding: Column, exchange: Column) -> list[tuple[str, Column]]:
    later = next_funding.isNull() | (next_funding > 0) & (exchange.isNull() | (next_funding > exchange))
    return [("Invalid mark price", positive(mark)), ("Invalid funding rate", funding.isNull() | finite(funding)), ("Invalid next funding time", later)]


def book_rules(bid: Column, ask: Column, bid_qty: Column, ask_qty: Column, obi: Column, bids: Column, asks: Column) -> list[tuple[str, Column]]:
    full = (F.coalesce(F.size(bids), F.lit(0)) > 0) & (F.coalesce(F.size(asks), F.lit(0)) > 0)
    return [
        ("Empty book", full), ("Invalid best bid/ask", positive(bid) & positive(ask)), ("Crossed book", ask > bid),
        ("Invalid total qty", positive(bid_qty) & positive(ask_qty)), ("OBI out of bounds", finite(obi) & obi.between(-1, 1)),
    ]


def monotone_verdicts(
    df: DataFrame, *, key: str, time: Column, exchange: Column, rules: list[tuple[str, Column]], order: list[str], chunk: Column, allow_equal: bool = False
) -> DataFrame:
    """df with reason (null: accepted) and drift_ms (distance of the clocks where it is more than CLOCK_DRIFT_MS).

    Checked in turn: the times, that time doesn't step back (nor, unless allow_equal, stand still) against the rows accepted
    before it in arrival order, then the rules. Only accepted rows count as before. A row refused for stepping back lies at
    or below the greatest time accepted, so that is the greatest time of the rows that break no other rule: a running
    maximum, carried over chunks (a column that rises with ``order``) over a table with one row a chunk. A null key is a key.
    """
    times = time_rules(time, exchange)
    rows = df.withColumn("_t", time).withColumn("_c", chunk).withColumn("_k", F.struct(F.col(key).alias("k")))
    rows = rows.withColumn("_first", validity_reason(*times)).withColumn("_then", validity_reason(*rules))
    rows = rows.withColumn("_good", F.when(F.col("_first").isNull() & F.col("_then").isNull(), F.col("_t")))
    tops = rows.groupBy("_k", "_c").agg(F.max("_good").alias("_top"))
    before = F.max("_top").over(Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(tops.select("_k", "_c", before.alias("_before")), ["_k", "_c"])
    own = F.max("_good").over(Window.partitionBy("_k", "_c").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    last = F.greatest(own, "_before")
    steps_back = F.coalesce((F.col("_t") < last) if allow_equal else (F.col("_t") <= last), F.lit(False))
    reason = F.coalesce("_first", F.when(steps_back, "Timestamp regression"), "_then")
    drift = F.abs(exchange - F.col("_t"))
    fresh = F.col("_first").isNull() & (drift > CLOCK_DRIFT_MS)
    return rows.withColumn("reason", reason).withColumn("drift_ms", F.when(fresh, drift)).drop("_t", "_c", "_k", "_first", "_then", "_good", "_before")


class TradeState:
    """What a stream of trades has accepted so far: its time and its id, which must rise together."""

    def __init__(self):
        self.time, self.id = 0, None

    def check(self, time, exchange, price, quantity, trade_id) -> str | None:
        good = lambda x: x is not None and x == x and 0 < x < float("inf")
        if not good(time):
            return "Invalid timestamp"
        if exchange is not None and not good(exchange):
            return "Invalid exchange timestamp"
        if time < self.time:
            return "Timestamp regression"
        if not good(price):
            return "Invalid price"
        if not good(quantity):
            return "Invalid quantity"
        if trade_id is None or self.id is not None and trade_id <= self.id:
            return "Duplicate/Regressive trade_id"
        self.time, self.id = time, trade_id
        return None


def trade_verdicts(trades: DataFrame) -> DataFrame:
    """(row_id, reason) of trades (key, seq, row_id, time_ms, exchange_ms, price, quantity, trade_id bigint).

    Time may stand still, the id must rise; only accepted rows move either, so a row refused for its id leaves the time
    alone, and the state depends on every row before: a key is one sequence in order of seq, streamed, not held. A null id is
    refused. Null keys are one key.
    """
    add_package(trades.sparkSession)
    cols = ["key", "seq", "row_id", "time_ms", "exchange_ms", "price", "quantity", "trade_id"]

    def run(batches):
        import pyarrow as pa

        key, state = object(), None
        for batch in batches:
            out = []
            keys, _, ids, *fields = (batch.column(c).to_pylist() for c in cols)
            for k, i, *values in zip(keys, ids, *fields):
                if k != key or state is None:
                    key, state = k, TradeState()
                out.append((i, state.check(*values)))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([r for _, r in out], pa.string())], ["row_id", "reason"])

    return trades.select(*cols).repartition("key").sortWithinPartitions("key", "seq").mapInArrow(run, "row_id long, reason string")


def continuity(venue: Column, update_id: Column, first_id: Column, prev_id: Column, before: Column) -> Column:
    """Struct (verdict, reason) of a depth update against the update_id applied before it (null: none), by the venue's rule.

    BINANCE (USD-M): prev_id must be the one before. BINANCE_SPOT: first_id must follow it. BYBIT: ids may skip, a lower one calls
    for a new snapshot. OKX: prev_id must be the one before, -1 is a snapshot. Others: as BINANCE.
    """
    out = lambda verdict, reason=None: F.struct(F.lit(verdict).alias("verdict"), F.lit(reason).cast("string").alias("reason"))
    okx = F.when(prev_id == -1, out("continue")).when(before.isNull(), out("gap", "missing_snapshot")).when(~prev_id.eqNullSafe(before), out("gap", "prev_seq_id_mismatch")).otherwise(out("continue"))
    bybit = F.when(update_id < before, out("resync", "update_id_decrease_or_reset")).when(update_id == before, out("stale", "duplicate_update")).otherwise(out("continue"))
    spot = F.when(first_id == before + 1, out("continue")).otherwise(out("gap", "u_chain_broken"))
    usdm = (
        F.when(update_id < before, out("stale", "stale_update")).when(update_id == before, out("stale", "duplicate_update"))
        .when(prev_id.isNull(), out("gap", "pu_missing")).when(prev_id != before, out("gap", "pu_mismatch")).otherwise(out("continue"))
    )
    missing = update_id.isNull() | (venue == "BINANCE_SPOT") & first_id.isNull()
    others = F.when(before.isNull(), out("continue")).when(missing, out("gap", "update_id_missing")).when(venue == "BYBIT", bybit).when(venue == "BINANCE_SPOT", spot).otherwise(usdm)
    return F.when(venue == "OKX", okx).otherwise(others)
