"""Structured Streaming twins: exact deduplication, admission by batch, corrected minutes, coverage sessions, books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.orderbook import SCHEMA, BookFold, frames_of, venue_of
from tidegrid.session import add_package


def exact_dedup(stream: DataFrame, identity: list[str]) -> DataFrame:
    """First arrival of each identity; state is exact and never expires. Rows with a null in the identity pass unchecked, so
    split them off with ``where`` before and write them by a query of their own."""
    return stream.dropDuplicates(identity)


def admit_by_batch(stream: DataFrame, *, table: str, out: str, checkpoint: str, identity: Column, order: list[str], bucket: Column | None = None):
    """Writer that admits each batch's new identities: anti-join with the identity table, first in ``order`` of the batch.

    The table is kept in buckets (``bucket``, of identity_key and the batch's columns; else 256 by hash), and a batch reads only
    the buckets its identities lie in; a bucket must follow from the identity alone, or repeats are missed. Both are appended
    under the batch's number, so a batch that is run again replaces its own output: exactly once.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("identity_key", identity)
        of = F.pmod(F.xxhash64("identity_key"), F.lit(256)) if bucket is None else bucket
        rows = rows.withColumn("bucket", of.cast("long"))
        first = F.min_by(F.struct(*batch.columns), F.struct(*order)).alias("r")
        known = rows.where("identity_key is not null").groupBy("identity_key", "bucket").agg(first)
        try:
            earlier = spark.read.parquet(table).where(F.col("batch") != number)
            met = known.select("bucket").distinct().limit(10_001).collect()  # which buckets to read; beyond 10,000 all are
            if len(met) <= 10_000:
                earlier = earlier.where(F.col("bucket").isin([r.bucket for r in met]))
            known = known.join(earlier.select("identity_key"), "identity_key", "left_anti")
        except Exception as error:  # noqa: BLE001 - the first batch has no table, or one without identities
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
        known = known.persist()
        new = known.select("r.*").unionByName(rows.where("identity_key is null").select(*batch.columns))
        new.write.mode("overwrite").parquet(f"{out}/batch={number}")
        known.select("identity_key", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/batch={number}")
        known.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)


def corrected_minutes(stream: DataFrame, *, time_col: str, key: str, value: str, cutoff: str = "10 minutes") -> DataFrame:
    """Per key and minute of event time n, low, high and mean, for update mode: a late row within the cut-off corrects its minute."""
    return (
        stream.withWatermark(time_col, cutoff)
        .groupBy(F.window(time_col, "1 minute").alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"))
        .select(key, F.col("w.start").alias("minute"), "n", "low", "high", "mean")
    )


def coverage_sessions(stream: DataFrame, *, time_col: str, key: str, tolerance: str, lateness: str) -> DataFrame:
    """Covered spans of each key: observations whose covers touch or overlap merge."""
    return (
        stream.withWatermark(time_col, lateness)
        .groupBy(F.session_window(time_col, tolerance).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )


def books(stream: DataFrame) -> DataFrame:
    """The batch fold's rows (see ``orderbook.reconstruct``) over a stream of frames, in append mode: frames of a trigger are
    folded in order of seq into the state kept for their instrument."""
    add_package(stream.sparkSession)

    def step(key, batches, state):
        import pickle

        import pandas as pd

        book = pickle.loads(state.get[0]) if state.exists else BookFold(venue=venue_of(key[0]))
        rows = pd.concat(list(batches))
        out = [(key[0], *book.row(frame, book.apply(frame))) for frame in frames_of(rows)]
        state.update((pickle.dumps(book),))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"update_id": "Int64"})

    return stream.groupBy("instrument_key").applyInPandasWithState(step, SCHEMA, "book binary", "append", "NoTimeout")
