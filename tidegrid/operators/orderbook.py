"""Order-book reconstruction: a pure fold over ordered frames, applied per instrument, in batch and streaming alike."""

from __future__ import annotations

import bisect
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import add_package

SCHEMA = "instrument_key string, seq long, update_id long, state string, outcome string, best_bid double, best_ask double, bid_levels int, ask_levels int, generation int"


def venue_of(instrument_key: str) -> str:
    """Whose rules a book follows, by the key's exchange and market (EXCHANGE|market|...): BYBIT, OKX, BINANCE_SPOT, else BINANCE (USD-M)."""
    exchange, market = (instrument_key.strip().upper().split("|") + [""])[:2]
    if exchange in ("BYBIT", "OKX"):
        return exchange
    return "BINANCE_SPOT" if exchange == "BINANCE_SPOT" or (exchange, market) == ("BINANCE", "SPOT") else "BINANCE"


class Levels:
    """One side of a book: quantities by price, and the prices in order. Changes are made in place and can be taken back."""

    def __init__(self):
        self.quantities: dict = {}
        self.prices: list = []

    def __len__(self) -> int:
        return len(self.prices)

    def _set(self, price, quantity) -> None:
        if quantity:
            if price not in self.quantities:
                bisect.insort(self.prices, price)
            self.quantities[price] = quantity
        elif self.quantities.pop(price, None) is not None:
            del self.prices[bisect.bisect_left(self.prices, price)]

    def change(self, changes) -> list | None:
        """Apply (price, quantity) texts in turn, quantity 0 removes; what undoes it, or None (and no change) if one isn't valid."""
        undo: list = []
        for price, quantity in changes if changes is not None else ():
            try:
                p, q = Decimal(price), Decimal(quantity)
                good = p > 0 and q >= 0 and p.is_finite() and q.is_finite()
            except (InvalidOperation, TypeError):
                good = False
            if not good:
                self.take_back(undo)
                return None
            undo.append((p, self.quantities.get(p)))
            self._set(p, q)
        return undo

    def take_back(self, undo: list) -> None:
        for price, quantity in reversed(undo):
            self._set(price, quantity)


class BookFold:
    """State of one instrument's book.

    A frame is a dict: seq, is_snapshot, update_id, first_id, prev_id, bids, asks (lists of (price, quantity) texts).
    Quantity 0 removes a level. Levels that aren't valid, or that cross the book, leave it unchanged and open a gap.
    ``apply`` returns the outcome. The rest is the venue's:

    * BINANCE (USD-M): diffs are buffered until a snapshot bridges them: the first kept diff must span the snapshot's id. A diff
      continues the book if prev_id is the last applied id; one at or below that id is stale.
    * BINANCE_SPOT: the first kept diff must span the snapshot's id + 1. A diff continues if first_id is the last applied id + 1,
      else it opens a gap, repeats too.
    * BYBIT: a snapshot replaces the book. A diff with a higher id continues, whatever it skips; an equal one is stale, a lower one
      calls for a new snapshot (resync).
    * OKX: a snapshot replaces the book. A diff continues if prev_id is the last applied id or -1.

    Diffs of the last two are discarded, not buffered, while the book isn't trusted.
    """

    venue, anchored = "BINANCE", False  # also for states pickled before these were kept

    def __init__(self, capacity: int = 10_000, venue: str = "BINANCE"):
        self.venue = venue
        self.bids, self.asks = Levels(), Levels()
        self.buffer: list = []
        self.capacity, self.last, self.state, self.pending, self.generation = capacity, None, "RECOVERING", None, 0

    @staticmethod
    def _change(bids: Levels, asks: Levels, frame) -> bool:
        """Apply a frame's levels to both sides; False, and no change, if one isn't valid or the book would cross."""
        undo = bids.change(frame["bids"])
        if undo is None:
            return False
        more = asks.change(frame["asks"])
        if more is not None and not (bids.prices and asks.prices and bids.prices[-1] >= asks.prices[0]):
            return True
        if more is not None:
            asks.take_back(more)
        bids.take_back(undo)
        return False

    def _fresh(self, snapshot) -> tuple[Levels, Levels] | None:
        book = Levels(), Levels()
        return book if self._change(*book, snapshot) else None

    def _keep(self, frame) -> str:
        if len(self.buffer) >= self.capacity:
            self.buffer, self.state = [], "SEQUENCE_GAP"
            return "buffer_overflow"
        bisect.insort(self.buffer, frame, key=lambda f: f["seq"])
        return "buffered"

    def _bridge(self, snapshot) -> str:
        base = snapshot["update_id"]
        book = self._fresh(snapshot)
        if base is None or book is None:
            self.state = "SEQUENCE_GAP"
            return "snapshot_invalid"
        due = base + (self.venue == "BINANCE_SPOT")
        later = [f for f in self.buffer if f["update_id"] is not None and f["update_id"] >= due]
        if not later:
            self.pending, self.state = snapshot, "RECOVERING"
            return "snapshot_ahead_of_buffer"
        head = later[0]
        if head["first_id"] is None or not head["first_id"] <= due <= head["update_id"]:
            self.pending = None
            return "snapshot_bridge_not_found"
        last = None
        for f in later:
            why = self._order(f, last) if last is not None else None
            if why == "stale":
                continue
            if why or not self._change(*book, f):
                self.buffer, self.state, self.pending = later, "SEQUENCE_GAP", None
                return "bridge_broken"
            last = f["update_id"]
        self.bids, self.asks = book
        self.last, self.buffer, self.pending, self.state = last, [], None, "VALID"
        self.generation += 1
        return "bridged"

    def _order(self, frame, last) -> str | None:
        """Why a diff doesn't continue a book whose last applied id is ``last``; None if it does."""
        u, first, prev = frame["update_id"], frame["first_id"], frame["prev_id"]
        if self.venue == "OKX":
            return None if prev == -1 else "missing_snapshot" if last is None else "sequence_gap" if prev != last else None
        if u is None or last is None or self.venue == "BINANCE_SPOT" and first is None:
            return "update_id_missing"
        if self.venue == "BINANCE_SPOT":
            return None if first == last + 1 else "sequence_gap"
        if self.venue == "BYBIT":
            return "resync" if u < last else "stale" if u == last else None
        return "stale" if u <= last else "sequence_gap" if prev != last else None

    def _replace(self, snapshot) -> str:
        book = self._fresh(snapshot)
        if book is None:
            self.state = "SEQUENCE_GAP"
            return "snapshot_invalid"
        self.bids, self.asks = book
        self.last, self.state, self.anchored = snapshot["update_id"], "VALID", True
        return "snapshot_applied"

    def apply(self, frame) -> str:
        wire = self.venue in ("BYBIT", "OKX")
        if frame["is_snapshot"]:
            return self._replace(frame) if wire else self._bridge(frame)
        if wire:
            # an OKX book that never had a frame is told so by its comparator
            if self.state != "VALID" and (self.anchored or self.venue == "BYBIT"):
                return "discarded"
        elif self.state != "VALID":
            outcome = self._keep(frame)
            return self._bridge(self.pending) if self.pending and outcome == "buffered" else outcome
        why = self._order(frame, self.last)
        if why == "stale":
            return why
        if why:
            return self._gap(frame, why)
        if not self._change(self.bids, self.asks, frame):
            return self._gap(frame, "invalid_book")
        self.last, self.anchored = frame["update_id"], True
        return "applied"

    def _gap(self, frame, why: str) -> str:
        self.state = "RECOVERING" if why == "resync" else "SEQUENCE_GAP"
        if self.venue not in ("BYBIT", "OKX"):
            self._keep(frame)
        return why

    def row(self, frame, outcome: str) -> tuple:
        best = lambda side, at: float(side.prices[at]) if side.prices else None
        return (frame["seq"], frame["update_id"], self.state, outcome, best(self.bids, -1), best(self.asks, 0), len(self.bids), len(self.asks), self.generation)


def frames_of(pdf):
    """Frames of a pandas batch in order of seq; bids and asks are lists of [price, quantity] texts."""
    whole = lambda x: None if x is None or x != x else int(x)
    for r in pdf.sort_values("seq", kind="stable").itertuples():
        yield {
            "seq": int(r.seq), "is_snapshot": bool(r.is_snapshot), "update_id": whole(r.update_id), "first_id": whole(r.first_id), "prev_id": whole(r.prev_id),
            "bids": r.bids if r.bids is not None else [], "asks": r.asks if r.asks is not None else [],
        }


def _last_of_each_price(prices: Column, quantities: Column) -> Column:
    """Levels (p, q) of a stored side; of a price that comes twice the last, as the fold takes it."""
    later = lambda i: F.slice(prices, i + 2, F.size(prices))
    return F.filter(F.arrays_zip(prices.alias("p"), quantities.alias("q")), lambda x, i: ~F.coalesce(F.array_contains(later(i), x["p"]), F.lit(False)))


def frames_of_ladders(ladders: DataFrame) -> DataFrame:
    """Frames (see ``reconstruct``) that lead from each stored ladder of an instrument to its next.

    ladders: instrument_key, seq, bids_price, bids_qty, asks_price, asks_qty (arrays of double, not null). A row's diff holds the levels that
    changed and quantity 0 for those that went; seq is its update_id. A ladder the fold must refuse (levels that aren't valid, crossed sides)
    is sent whole, so it opens a gap; the first ladder and one after a refused one are sent whole with a snapshot behind them, or, where
    snapshots come on the wire (Bybit, OKX), as that snapshot alone. Diffs get twice their seq, snapshots one more.
    """
    rows = ladders.select(
        "instrument_key", "seq", _last_of_each_price(F.col("bids_price"), F.col("bids_qty")).alias("b"), _last_of_each_price(F.col("asks_price"), F.col("asks_qty")).alias("a")
    )
    parts = int(ladders.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a set number: small shuffles would be run together in one task
    rows = rows.repartition(parts, "instrument_key")
    inf = F.lit(float("inf"))
    valid = lambda x: F.coalesce((x["p"] > 0) & (x["p"] < inf) & (x["q"] >= 0) & (x["q"] < inf), F.lit(False))
    held = lambda side: F.transform(F.filter(side, lambda x: x["q"] > 0), lambda x: x["p"])
    crossed = F.coalesce(F.array_max(held("b")) >= F.array_min(held("a")), F.lit(False))
    rows = rows.withColumn("bad", crossed | ~F.forall("b", valid) | ~F.forall("a", valid))
    w = Window.partitionBy("instrument_key").orderBy("seq")
    rows = rows.select("*", *[F.lag(c).over(w).alias(f"{c}0") for c in ("seq", "b", "a", "bad")]).withColumn("start", F.coalesce("bad0", F.lit(True)))
    whole = lambda side: F.transform(side, lambda x: F.array(x["p"].cast("string"), x["q"].cast("string")))

    def change(side: str) -> Column:
        one = lambda c: F.transform(c, lambda x: F.concat_ws(" ", x["p"].cast("string"), x["q"].cast("string")))
        price = lambda c: F.transform(c, lambda x: x["p"].cast("string"))
        new = F.transform(F.array_except(one(side), one(f"{side}0")), lambda x: F.split(x, " "))
        gone = F.transform(F.array_except(price(f"{side}0"), price(side)), lambda x: F.array(x, F.lit("0")))
        return F.when(F.col("start") | F.col("bad"), whole(side)).otherwise(F.concat(new, gone))

    none = F.lit(None).cast("long")
    part = lambda n: F.upper(F.trim(F.coalesce(F.get(F.split("instrument_key", r"\|"), F.lit(n)), F.lit(""))))
    wire, spot = part(0).isin("BYBIT", "OKX"), (part(0) == "BINANCE_SPOT") | ((part(0) == "BINANCE") & (part(1) == "SPOT"))
    diffs = rows.where(~(F.col("start") & wire)).select(
        "instrument_key", (F.col("seq") * 2).alias("seq"), F.lit(False).alias("is_snapshot"), F.col("seq").alias("update_id"),
        F.when(F.col("start"), F.col("seq")).otherwise(F.col("seq0") + 1).alias("first_id"), F.col("seq0").alias("prev_id"), change("b").alias("bids"), change("a").alias("asks"),
    )
    snaps = rows.where("start").select(
        "instrument_key", (F.col("seq") * 2 + 1).alias("seq"), F.lit(True).alias("is_snapshot"), F.when(spot, F.col("seq") - 1).otherwise(F.col("seq")).alias("update_id"), none.alias("first_id"),
        F.when(part(0) == "OKX", F.lit(-1).cast("long")).alias("prev_id"), whole("b").alias("bids"), whole("a").alias("asks"),
    )
    return diffs.unionByName(snaps)


def reconstruct(frames: DataFrame, *, capacity: int = 10_000) -> DataFrame:
    """The book after every frame of each instrument (columns: see SCHEMA).

    frames: instrument_key, seq (arrival order), is_snapshot, update_id, first_id, prev_id bigint, bids, asks
    array<array<string>>. The key's exchange and market choose the venue's rules (``venue_of``). The state of a book depends on
    all frames before, so an instrument is one sequence; sequences of different instruments run in parallel. Batches of rows stream through the fold, none is held as a whole.
    """
    add_package(frames.sparkSession)
    columns = ["instrument_key", "seq", "is_snapshot", "update_id", "first_id", "prev_id", "bids", "asks"]

    def run(batches):
        import pyarrow as pa

        key, book = object(), None
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "int": pa.int32()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])
        for batch in batches:
            out = []
            for name, *fields in zip(*(batch.column(c).to_pylist() for c in columns)):
                if name != key:
                    key, book = name, BookFold(capacity, venue_of(name))
                frame = dict(zip(columns[1:], fields))
                out.append((name, *book.row(frame, book.apply(frame))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    known = frames.select(*columns).where("instrument_key is not null and seq is not null")
    parts = int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a set number: small shuffles would be run together in one task
    return known.repartition(parts, "instrument_key").sortWithinPartitions("instrument_key", "seq").mapInArrow(run, SCHEMA)
