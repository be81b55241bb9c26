"""Late and out-of-order events (problem 5): per-minute aggregates by event time, corrected as late rows arrive.

Rows are classed by how late they arrive. On-time rows are folded, in the JVM, into ordered slots of a second; late rows
into slots of the correction tick they arrive in (ticks are ``tick_ms`` apart and end at the cut-off, so a minute has a
bounded number of them). So a key's minute reaches Python as at most slots * ticks rows, however many rows it has. There
a minute's state is checkpointed every few slots; a tick's late slots restore the checkpoint before the earliest of them,
the sorted suffix is replayed, and the minute's output is replaced by a new revision. Slots of the tick after the last one
find the minute closed. The replay's log holds what it did with each tick; a row's verdict is read from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import add_package

MINUTE_MS = 60_000


def arrivals(books: DataFrame, items: DataFrame) -> DataFrame:
    """books' rows with both times: book_id, instrument_key, event_ms, arrival_ms, minute_ms, late_ms (arrival after the
    minute's end), mid_price. A row without an ingest item, or with an unknown time, is left out. Rows stored twice each count.
    """
    left = books.select(
        "book_id", "instrument_key", F.unix_millis("exchange_timestamp").alias("event_ms"), F.col("ingest_item_id").alias("_item"), "mid_price"
    )
    times = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").alias("_item"), F.col("local_receive_ts").alias("arrival_ms"))
    out = left.join(times, "_item").drop("_item").where("event_ms is not null and arrival_ms is not null")
    minute = F.floor(F.col("event_ms") / MINUTE_MS) * MINUTE_MS
    return out.withColumn("minute_ms", minute.cast("long")).withColumn("late_ms", F.col("arrival_ms") - F.col("minute_ms") - MINUTE_MS)


class MinuteState:
    """Ordered state of a minute: folds slots in order, keeps a checkpoint every ``every`` slots.

    A slot is (key, n, first place, first, high, low, last place, last, sum); a place is (event time, id). Slots of one
    second that arrived in different ticks may interleave, so the fold compares places.
    """

    def __init__(self, every: int = 8):
        self.every, self.slots, self.checkpoints, self.state = every, [], [None], None

    @staticmethod
    def fold(state, slot):
        new = slot[1:]
        if state is None:
            return new
        n, first_at, first, high, low, last_at, last, total = state
        m, a, x, h, lo, z, y, s = new
        if a < first_at:
            first_at, first = a, x
        if z > last_at:
            last_at, last = z, y
        return n + m, first_at, first, max(high, h), min(low, lo), last_at, last, total + s

    def merge(self, new):
        """Add slots: restore the checkpoint before the earliest of them and replay the sorted suffix."""
        import bisect

        at = bisect.bisect_left(self.slots, min(s[0] for s in new), key=lambda s: s[0])
        kept = min(at // self.every, len(self.checkpoints) - 1)
        self.slots = sorted(self.slots + list(new), key=lambda s: s[0])
        del self.checkpoints[kept + 1 :]
        state = self.checkpoints[kept]
        for i in range(kept * self.every, len(self.slots)):
            if i and i % self.every == 0 and i // self.every == len(self.checkpoints):
                self.checkpoints.append(state)
            state = self.fold(state, self.slots[i])
        self.state = state


def _ticked(rows: DataFrame, publish_ms: int, cutoff_ms: int, tick_ms: int) -> tuple[DataFrame, int]:
    """Rows with the tick they are taken in at (0: the first publication; one after the last: the minute is closed), and the last tick."""
    last = -(-(cutoff_ms - publish_ms) // tick_ms)
    late = F.col("late_ms")
    tick = F.when(late <= publish_ms, 0).when(late <= cutoff_ms, F.ceil((late - publish_ms) / tick_ms)).otherwise(last + 1)
    return rows.withColumn("tick", tick.cast("int")), last


def replay_minutes(
    rows: DataFrame, *, publish_ms: int = 5_000, cutoff_ms: int = 600_000, tick_ms: int = 60_000, slot_ms: int = 1_000, every: int = 8, span_ms: int = 3_600_000
) -> DataFrame:
    """The replay's log, one row for each tick of a key's minute in which rows (see ``arrivals``) came: instrument_key, minute_ms,
    tick, action (published, corrects or too_late), revision (0: the first one; null if the tick changed no output),
    published_ms, n_rows, open_mid, high_mid, low_mid, close_mid, mean_mid, is_last.

    Rows with a missing or NaN mid price are taken in but add nothing to the aggregates. Of rows with a null key a log is kept
    as for any key. A minute all of whose rows came late first appears with its first correction. Ties in event time are
    ordered by book_id, then price. Empty input: no rows.
    """
    add_package(rows.sparkSession)
    ticked, last = _ticked(rows, publish_ms, cutoff_ms, tick_ms)
    usable = F.col("mid_price").isNotNull() & ~F.isnan("mid_price")
    price = F.when(usable, F.col("mid_price"))
    order = F.when(usable, F.struct("event_ms", F.coalesce("book_id", F.lit(-1)).alias("b"), "mid_price"))
    slots = (
        ticked.withColumn("slot", F.floor(F.col("event_ms") / slot_ms).cast("long"))
        .groupBy("instrument_key", "minute_ms", "tick", "slot")
        .agg(
            F.count(price).alias("n"),
            F.min_by(price, order).alias("first"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("last"),
            F.sum(price).alias("total"),
            F.min(order).alias("_a"),
            F.max(order).alias("_z"),
        )
        .select("*", *[F.coalesce(F.col(f"_{x}.{c}"), F.lit(0)).alias(f"{x}_{c}") for x in "az" for c in ("event_ms", "b", "mid_price")])
        .drop("_a", "_z")
        .withColumn("span", F.floor(F.col("minute_ms") / span_ms).cast("long"))
    )
    names = ["instrument_key", "minute_ms", "tick", "action", "revision", "published_ms", "n_rows", "open_mid", "high_mid", "low_mid", "close_mid", "mean_mid", "is_last"]

    def replay(pdf):
        import numpy as np
        import pandas as pd

        out = []
        pdf = pdf.sort_values(["minute_ms", "tick", "slot"])
        column = {c: pdf[c].tolist() for c in pdf.columns}
        low_at = list(zip(column["a_event_ms"], column["a_b"], column["a_mid_price"]))
        high_at = list(zip(column["z_event_ms"], column["z_b"], column["z_mid_price"]))
        slots = list(zip(zip(column["slot"], low_at), column["n"], low_at, column["first"], column["high"], column["low"], high_at, column["last"], column["total"]))
        minutes, ticks = pdf.minute_ms.to_numpy(), pdf.tick.to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(minutes) != 0) | (np.diff(ticks) != 0)])).tolist()
        key, minute, state, revision, newest = column["instrument_key"][0], None, None, 0, None
        for begin, end in zip(starts, [*starts[1:], len(slots)]):
            tick = int(ticks[begin])
            if minutes[begin] != minute:
                minute, state, revision, newest = int(minutes[begin]), MinuteState(every), 0, None
            if tick > last:
                out.append([key, minute, tick, "too_late", *[None] * 8, False])
                continue
            row = [key, minute, tick, "corrects" if tick else "published", *[None] * 8, False]
            new = [s for s in slots[begin:end] if s[1]]
            if new:
                state.merge(new)
                n, _, a, h, lo, _, z, s = state.state
                row[4:] = [revision, minute + MINUTE_MS + publish_ms + tick * tick_ms, n, a, h, lo, z, s / n, True]
                revision += 1
                if newest is not None:
                    newest[-1] = False
                newest = row
            out.append(row)
        return pd.DataFrame(out, columns=names).astype({"revision": "Int32", "published_ms": "Int64", "n_rows": "Int64"})

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a set number: small shuffles would be run together in one task
    return slots.repartition(parts, "instrument_key", "span").groupBy("instrument_key", "span").applyInPandas(
        replay,
        "instrument_key string, minute_ms long, tick int, action string, revision int, published_ms long, n_rows long, open_mid double, high_mid double,"
        " low_mid double, close_mid double, mean_mid double, is_last boolean",
    )


def minute_revisions(rows: DataFrame, **options) -> DataFrame:
    """Every published state of a key's minute: instrument_key, minute_ms, revision, published_ms, n_rows, open_mid, high_mid,
    low_mid, close_mid, mean_mid, is_last. Rows without a key add nothing."""
    log = replay_minutes(rows.where("instrument_key is not null"), **options)
    return log.where("revision is not null").drop("tick", "action")


def late_rows(rows: DataFrame, *, publish_ms: int = 5_000, cutoff_ms: int = 600_000, tick_ms: int = 60_000, **options) -> DataFrame:
    """(book_id, verdict) of the rows the replay took in after their minute was first published: corrects, or too_late where
    it found the minute closed. Each row counts for itself, also without a key or a price."""
    log = replay_minutes(rows, publish_ms=publish_ms, cutoff_ms=cutoff_ms, tick_ms=tick_ms, **options)
    key = F.struct(F.col("instrument_key").isNull(), F.coalesce("instrument_key", F.lit("")))
    done = log.where("action <> 'published'").select(key.alias("_k"), F.col("minute_ms").alias("_m"), F.col("tick").alias("_t"), F.col("action").alias("verdict"))
    late = _ticked(rows, publish_ms, cutoff_ms, tick_ms)[0].where("tick > 0").select("book_id", key.alias("_k"), F.col("minute_ms").alias("_m"), F.col("tick").alias("_t"))
    return late.join(done, ["_k", "_m", "_t"]).select("book_id", "verdict")
