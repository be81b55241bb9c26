"""A total order over two logs, ties in it, the replay of recorded frames, and digests of an ordered output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.operators import orderbook
from tidegrid.sources import normalize


def merged_log(wire: DataFrame, rest: DataFrame) -> DataFrame:
    """Both logs (ts_ms, ns, source_index, ...) with kind_rank (wire 0, rest 1); order by ``ORDER`` for the total order."""
    a, b = wire.withColumn("kind_rank", F.lit(0)), rest.withColumn("kind_rank", F.lit(1))
    return a.unionByName(b, allowMissingColumns=True).withColumn("ns", F.coalesce("ns", F.lit(-1).cast("long")))


ORDER = ["ts_ms", "kind_rank", "ns", "source_index"]


def order_ties(wire: DataFrame, rest: DataFrame) -> DataFrame:
    """(ts_ms, wire_frames, rest_frames) of milliseconds in which both logs have frames."""
    w = wire.groupBy("ts_ms").agg(F.count(F.lit(1)).alias("wire_frames"))
    return w.join(rest.groupBy("ts_ms").agg(F.count(F.lit(1)).alias("rest_frames")), "ts_ms")


def output_digest(df: DataFrame, *, by: list[str], order: list[str], columns: list[str], chunk: str, fan: int = 256) -> DataFrame:
    """(by, digest): SHA-256 over the ordered rows of each group, chunk by chunk, then over groups of ``fan`` chunks in order, then
    over those. Chunks hold digests of rows, not rows; how many is the caller's choice of chunk."""
    row = F.sha2(F.to_json(F.struct(*columns)), 256)
    rows = df.select(*by, F.col(chunk).alias("_c"), F.struct(*order, row.alias("_r")).alias("_x"))
    parts = rows.groupBy(*by, "_c").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list("_x")), lambda x: x["_r"]), ""), 256).alias("d"))
    joined = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_c", "d"))), lambda x: x["d"]), ""), 256).alias("d")
    parts = parts.withColumn("_g", F.floor(F.col("_c") / fan)).groupBy(*by, "_g").agg(joined).withColumnRenamed("_g", "_c")
    return parts.groupBy(*by).agg(joined.alias("digest"))


def ordered(log: DataFrame, *, chunk_ms: int = 3_600_000) -> DataFrame:
    """log (see ``merged_log``) with place: 1, 2, ... in the total order. Chunks of time are ordered by themselves; the rows of
    those before are added over a table with one row a chunk."""
    rows = log.withColumn("_c", F.floor(F.col("ts_ms") / chunk_ms))
    before = F.sum("n").over(Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, -1))
    earlier = rows.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).select("_c", F.coalesce(before, F.lit(0)).alias("_earlier"))
    own = F.row_number().over(Window.partitionBy("_c").orderBy(*ORDER))
    return rows.withColumn("place", own).join(earlier, "_c").withColumn("place", F.col("place") + F.col("_earlier")).drop("_c", "_earlier")


def replay_frames(frames: DataFrame, *, venue: str) -> dict[str, DataFrame]:
    """What recorded frames of a venue give: books, trades, marks, open_interest, liquidations, tickers, unhandled and foreign.

    frames: place (total order), venue, instrument_key, payload, decode_ok. Frames of other venues are left out and counted
    (foreign: venue, frames); ones that weren't decoded are unhandled as malformed_payload. Books are folded per instrument
    by the venue's rules in order of place; the rest is stateless. Each output's frame_id is the place it came from.
    """
    name = F.upper(F.trim("venue"))
    own = frames.where(name == venue)
    readable = own.where(F.coalesce("decode_ok", F.lit(True))).select(F.col("place").alias("frame_id"), "payload", "instrument_key")
    lost = own.where(~F.coalesce("decode_ok", F.lit(True))).select(F.col("place").alias("frame_id"), F.lit("malformed_payload").alias("reason"), F.lit("unrouted").alias("channel"))
    depth = normalize.depth(readable).join(readable.select("frame_id", "instrument_key"), "frame_id")
    return {
        "books": orderbook.reconstruct(depth.withColumn("seq", F.col("frame_id"))),
        "trades": normalize.trades(readable), "marks": normalize.marks(readable), "open_interest": normalize.open_interest(readable),
        "liquidations": normalize.liquidations(readable), "tickers": normalize.tickers(readable), "unhandled": normalize.unhandled(readable).unionByName(lost),
        "foreign": frames.where(F.coalesce(name != venue, F.lit(True))).groupBy(name.alias("venue")).agg(F.count(F.lit(1)).alias("frames")),
    }


def counters(outputs: dict[str, DataFrame]) -> DataFrame:
    """(output, outcome, n) of a replay: the books' outcomes, the reasons of what was unhandled, and the rows of all else."""
    kinds = {"books": "outcome", "unhandled": "reason"}
    every = None
    for name, df in outputs.items():
        outcome = F.col(kinds[name]) if name in kinds else F.lit("rows")
        part = df.groupBy(outcome.alias("outcome")).agg((F.sum("frames") if name == "foreign" else F.count(F.lit(1))).alias("n")).select(F.lit(name).alias("output"), "outcome", "n")
        every = part if every is None else every.unionByName(part)
    return every
