"""Far too many small files (problem 2): every record of the finished segments, once, in few sorted files of a set size.

1. ``superseded``: entries that must add nothing. An entry's keys can only lie in another entry that holds its rarest key,
   so each entry is held against one candidate, the largest such entry, and against the others only if that one fails and
   only where their signatures (least hashes of the keys) allow it; entries with equal sets of keys are first reduced to one.
   No group of files is paired with itself.
2. ``consolidate``: the records of the remaining entries, one of each identity, are range-partitioned by stream, time and
   key with boundaries Spark samples, as many ranges as the target size asks for, and written sorted to a folder of their own.
3. That folder is read back and reconciled with the source, per stream: number of records and a sum over their identities,
   joined where they lie. Only then the pointer file that names the current folder is replaced, by one atomic rename.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import hadoop_fs, materialize, scratch_path

#: Hashes in an entry's signature: each lets about as many unrelated pairs through as their sets overlap.
SIGNATURE = 12
#: Name of the file that names the current folder.
POINTER = "_CURRENT"


def finished(listing: DataFrame) -> DataFrame:
    """Entries whose path names a finished segment. A null path is none."""
    return listing.where(F.col("path").endswith(".seg") | F.col("path").endswith(".parquet"))


def _segment_keys(listing: DataFrame, records: DataFrame) -> DataFrame:
    """(file_id, record_key, stream): the distinct keys of each finished entry, written once for all that reads them."""
    done = finished(listing).select("file_id", F.coalesce("stream", F.lit("")).alias("stream"))
    keys = records.where(F.col("record_key").isNotNull()).select("file_id", "record_key").distinct().join(done, "file_id")
    return materialize(keys, "segment-keys")


def superseded(listing: DataFrame, records: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(file_id, reason): unfinished, empty, or contained (all its record keys are in one other finished entry of the
    stream that has more distinct keys, or equally many and a lower file_id). Records without a key don't count as keys;
    an entry that has only such records is not empty."""
    done = finished(listing).select("file_id", F.coalesce("stream", F.lit("")).alias("stream"))
    unfinished = listing.select("file_id").exceptAll(done.select("file_id")).select("file_id", F.lit("unfinished").alias("reason"))
    counts = records.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows"))
    empty = done.join(counts, "file_id", "left_anti").select("file_id", F.lit("empty").alias("reason"))

    keys = _segment_keys(listing, records) if keys is None else keys
    files = keys.groupBy("stream", "file_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("record_key")).alias("h1"),
        F.sum(F.xxhash64("record_key", F.lit(7)).cast("decimal(38,0)")).alias("h2"),
        F.array(*[F.min(F.xxhash64("record_key", F.lit(100 + i))) for i in range(SIGNATURE)]).alias("sig"),
    )
    alike = Window.partitionBy("stream", "n", "h1", "h2")
    files = materialize(files.withColumn("leader", F.min("file_id").over(alike)).drop("h1", "h2"), "segment-files")
    leaders = files.where("file_id = leader").select("stream", "file_id", "n")
    signatures = files.where("file_id = leader").select("file_id", "sig")
    # the rarest key of each leader, and the largest leader that holds it
    held = keys.join(leaders, ["stream", "file_id"])
    best = F.struct(F.col("n"), (-F.col("file_id")).alias("low"))
    spread = held.groupBy("stream", "record_key").agg(F.count(F.lit(1)).alias("df"), F.max(best).alias("best"))
    rarest = (
        held.join(spread, ["stream", "record_key"])
        .groupBy("stream", "file_id", "n")
        .agg(F.min(F.struct("df", "record_key", "best")).alias("r"))
        .select("stream", "file_id", "n", F.col("r.df").alias("df"), F.col("r.record_key").alias("record_key"), (-F.col("r.best.low")).alias("other"))
        .where("df > 1")
    )
    rarest = materialize(rarest, "segment-rarest")
    copies = files.where("file_id <> leader").select("stream", "file_id", "n", F.col("leader").alias("other"))
    first = rarest.where("file_id <> other").select("stream", "file_id", "n", "other").unionByName(copies)
    inside = materialize(_contained(first, keys), "segment-inside")
    # what the largest candidate doesn't hold: the others that hold the rarest key and whose least hashes are all as low,
    # as they must be if they hold all keys; the condition is part of the join, so other pairs are never rows
    open_rows = rarest.join(inside, "file_id", "left_anti").join(signatures, "file_id")
    open_rows = open_rows.select(F.col("stream").alias("s0"), F.col("record_key").alias("k0"), "file_id", F.col("n").alias("n0"), F.col("sig").alias("sig0"))
    asked = open_rows.select(F.col("s0").alias("stream"), F.col("k0").alias("record_key")).distinct()
    others = held.join(asked, ["stream", "record_key"], "left_semi").join(signatures, "file_id").select("stream", "record_key", F.col("file_id").alias("other"), F.col("n").alias("m"), "sig")
    larger = (F.col("m") > F.col("n0")) | (F.col("m") == F.col("n0")) & (F.col("other") < F.col("file_id"))
    may_hold = larger & F.forall(F.arrays_zip("sig", "sig0"), lambda x: x["sig"] <= x["sig0"])
    rest = open_rows.join(others, (F.col("s0") == F.col("stream")) & (F.col("k0") == F.col("record_key")) & (F.col("other") != F.col("file_id")) & may_hold)
    more = _contained(rest.select("stream", "file_id", F.col("n0").alias("n"), "other"), keys)
    contained = inside.unionByName(more).distinct().select("file_id", F.lit("contained").alias("reason"))
    return unfinished.unionByName(empty).unionByName(contained)


def _contained(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """file_id of the pairs (file_id, n, other) where all n keys of file_id are keys of other."""
    asked = pairs.join(keys.select("file_id", "record_key"), "file_id")
    theirs = keys.select(F.col("file_id").alias("other"), "record_key")
    met = asked.join(theirs, ["other", "record_key"]).groupBy("file_id", "other").agg(F.count(F.lit(1)).alias("met"), F.max("n").alias("n"))
    return met.where("met = n").select("file_id").distinct()


def _of_entries(records: DataFrame, entries: DataFrame) -> DataFrame:
    """records of the entries with the entry's stream ('' for none); a column of records of that name becomes record_stream."""
    if "stream" in records.columns:
        records = records.withColumnRenamed("stream", "record_stream")
    return records.join(entries.select("file_id", F.coalesce("stream", F.lit("")).alias("stream")), "file_id")


def distinct_records(records: DataFrame, entries: DataFrame, *, unkeyed: DataFrame | None = None) -> DataFrame:
    """One row, with all its columns, of each (stream, record_key) in the entries (file_id, stream): that of the lowest
    file_id, then row_no; rows without a key are all kept, those of the entries ``unkeyed`` if given."""
    rows = _of_entries(records, entries)
    plain = [f.name for f in rows.schema if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    place = F.struct("file_id", F.coalesce("row_no", F.lit(-1)), F.xxhash64(*plain))
    once = rows.where("record_key is not null").groupBy("stream", "record_key").agg(F.min_by(F.struct(*rows.columns), place).alias("r")).select("r.*")
    free = rows if unkeyed is None else _of_entries(records, unkeyed)
    return once.unionByName(free.where("record_key is null"))


def _tally(df: DataFrame, name: str) -> DataFrame:
    """(stream, name): per stream the records with a key, the sum over their identities, and the records without one."""
    h = F.xxhash64("record_key").cast("decimal(38,0)")
    known = F.col("record_key").isNotNull()
    return df.groupBy("stream").agg(F.struct(F.count_if(known).alias("n"), F.sum(F.when(known, h)).alias("h"), F.count_if(~known).alias("free")).alias(name))


def reconcile(written: DataFrame, due: DataFrame) -> None:
    """Raises if the two tables differ, per stream, in number of records or in the sum over their identities. The tallies
    are joined where they lie; only examples of what differs reach the driver."""
    met = _tally(written, "written").join(_tally(due, "due"), "stream", "full_outer").where(~F.col("written").eqNullSafe(F.col("due")))
    if wrong := met.limit(5).collect():
        raise RuntimeError(f"the consolidated records don't agree with their source, for example {wrong}")


def _switch(spark, out_dir: str, version: str) -> None:
    """Make ``version`` the current folder of out_dir: the pointer is written beside and renamed over the old one."""
    fs, path = hadoop_fs(spark, out_dir)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    new, pointer = path(f"{out_dir}/.{POINTER}-{version}"), path(f"{out_dir}/{POINTER}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri() if new.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(new, pointer, how)


def current(spark, out_dir: str) -> str | None:
    """The folder that holds the consolidated files of out_dir, as its pointer names it; None before the first run."""
    fs, path = hadoop_fs(spark, out_dir)
    pointer = path(f"{out_dir.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = bytes(stream.readNBytes(200)).decode()
    finally:
        stream.close()
    return f"{out_dir.rstrip('/')}/{name}"


def consolidate(listing: DataFrame, records: DataFrame, out_dir: str, *, target_bytes: int = 128 << 20, bytes_per_record: float = 40.0):
    """Writes the consolidated files below out_dir and returns (their table, the entries that added nothing).

    Files hold about, and on the average at most, target_bytes each, by the bytes a record takes in the listing (size_bytes over rows of finished
    entries; bytes_per_record where the listing has neither), sorted by stream, record_ts and record_key. All columns of
    records are kept, those of the lowest file_id and row_no of an identity; a column named stream is kept as record_stream.
    If the counts disagree, or a rename fails, an error is raised and what out_dir held stays current. The folder that was
    current before is kept until the next run. Without any record an empty table results.
    """
    spark, out_dir = listing.sparkSession, out_dir.rstrip("/")
    keys = _segment_keys(listing, records)
    dropped = materialize(superseded(listing, records, keys), "superseded")
    everything = finished(listing).select("file_id", "stream")
    kept = everything.join(dropped, "file_id", "left_anti")
    if {"size_bytes", "rows"} <= set(listing.columns):
        sound = finished(listing).where("size_bytes > 0 and rows > 0").agg(F.sum("size_bytes").alias("b"), F.sum("rows").alias("n")).first()
        bytes_per_record = sound.b / sound.n if sound.n else bytes_per_record
    order = ["stream", "record_ts", "record_key"]
    # nothing else holds a record without a key, so those of contained entries are written too
    once = distinct_records(records, kept, unkeyed=everything)
    most = keys.join(kept.select("file_id"), "file_id", "left_semi").count()  # before equal identities are reduced to one
    files = max(1, -(-most * int(max(bytes_per_record, 1)) // target_bytes))
    version = f"version-{uuid.uuid4().hex}"
    out = once.repartitionByRange(files, *order).sortWithinPartitions(*order)
    out.write.parquet(f"{out_dir}/{version}")
    written = spark.read.schema(out.schema).parquet(f"{out_dir}/{version}")
    # what must come out: each identity of all finished entries, those set aside included
    free = _of_entries(records.where("record_key is null").select("file_id", "record_key"), everything).select("stream", "record_key")
    fs, path = hadoop_fs(spark, out_dir)
    before = current(spark, out_dir)
    try:
        reconcile(written, keys.select("stream", "record_key").distinct().unionByName(free))
        _switch(spark, out_dir, version)
    except Exception:
        fs.delete(path(f"{out_dir}/{version}"), True)
        raise
    for status in fs.listStatus(path(out_dir)):  # a folder a run
        name = status.getPath().getName()
        if name.startswith("version-") and name != version and before and not before.endswith(name):
            fs.delete(status.getPath(), True)
    return written, dropped


def consolidated_in_scratch(listing: DataFrame, records: DataFrame, **options):
    """``consolidate`` into a folder of its own in the shared folder."""
    return consolidate(listing, records, scratch_path(listing.sparkSession, "consolidated"), **options)
