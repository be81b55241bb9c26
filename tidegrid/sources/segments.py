"""Segments on storage: names, listing, collisions, catalogue, byte checks, and reading into a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.session import hadoop_fs

#: YYYY-MM-DD-HH-NNNNNN.seg, or YYYY-MM-DD-HH.parquet for the older hourly files.
SEGMENT = r"^(\d{4}-\d{2}-\d{2})-(\d{2})-(\d{6})\.seg$"
HOURLY = r"^(\d{4}-\d{2}-\d{2})-(\d{2})\.parquet$"


def parse_names(df: DataFrame, path: str) -> DataFrame:
    """Adds date, hour, seq and kind (segment, hourly; null: no data file) of a path's last part."""
    name = F.regexp_extract(path, r"([^/\\]+)$", 1)
    seg, hourly = name.rlike(SEGMENT), name.rlike(HOURLY)
    part = lambda i: F.when(seg, F.regexp_extract(name, SEGMENT, i)).when(hourly, F.regexp_extract(name, HOURLY, min(i, 2)))
    return (
        df.withColumn("date", part(1).try_cast("date"))
        .withColumn("hour", part(2).try_cast("int"))
        .withColumn("seq", F.when(seg, F.regexp_extract(name, SEGMENT, 3).try_cast("int")))
        .withColumn("kind", F.when(seg, "segment").when(hourly, "hourly"))
    )


def resolve(entries: DataFrame, *, on_collision: str = "raise") -> DataFrame:
    """One representation per (stream, date, hour): entries of parse_names, with those of the other kind removed where both
    exist (prefer_segments, prefer_legacy), or an error (raise)."""
    if on_collision not in ("raise", "prefer_segments", "prefer_legacy"):
        raise ValueError(on_collision)
    w = Window.partitionBy("stream", "date", "hour")
    both = (F.max(F.col("kind") == "segment").over(w)) & (F.max(F.col("kind") == "hourly").over(w))
    rows = entries.where("kind is not null").withColumn("_both", both)
    if on_collision == "raise":
        # a condition of the rows: whatever columns are read, it is checked
        two = F.raise_error(F.concat(F.lit("two representations: "), F.coalesce("path", F.lit("")))).cast("boolean")
        return rows.where(F.when(F.col("_both"), two).otherwise(F.lit(True))).drop("_both")
    wanted = "segment" if on_collision == "prefer_segments" else "hourly"
    return rows.where(~F.col("_both") | (F.col("kind") == wanted)).drop("_both")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size_bytes, modified_ms) of the files below root, sub-folders included; an absent root has none, an unreadable one is
    an error. Spark lists the folders in parallel; contents aren't read."""
    fs, path = hadoop_fs(spark, root)
    if not fs.exists(path(root)):
        return spark.createDataFrame([], "path string, size_bytes long, modified_ms long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("size_bytes"), F.unix_millis("modificationTime").alias("modified_ms"))


def trust(listing: DataFrame) -> DataFrame:
    """Candidate files of a listing (path, size_bytes, ...) with stream (their folder), parsed name and trust: INVALID (no data file,
    or empty), AMBIGUOUS (both kinds in an hour), LEGACY (hourly), MARKED (a .meta.json lies beside it) or UNMARKED. Files aren't opened."""
    files = listing.withColumn("stream", F.regexp_extract("path", r"([^/\\]+)[/\\][^/\\]+$", 1))
    markers = files.where(F.col("path").endswith(".meta.json")).select(F.regexp_replace("path", r"\.meta\.json$", "").alias("path"), F.lit(True).alias("marked")).distinct()
    data = parse_names(files.where(~F.coalesce(F.col("path").endswith(".meta.json"), F.lit(False))), "path").join(markers, "path", "left")
    kinds = data.where("kind is not null").groupBy("stream", "date", "hour").agg(F.count_distinct("kind").alias("_kinds"))
    data = data.join(kinds, ["stream", "date", "hour"], "left")
    verdict = (
        F.when(F.col("kind").isNull() | F.coalesce(F.col("size_bytes") == 0, F.lit(False)), "INVALID").when(F.col("_kinds") > 1, "AMBIGUOUS").when(F.col("kind") == "hourly", "LEGACY")
        .when(F.col("marked"), "MARKED").otherwise("UNMARKED")
    )
    return data.withColumn("trust", verdict).drop("marked", "_kinds")


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """``trust`` of the files below root."""
    return trust(list_files(spark, root)).drop("modified_ms")


def byte_digests(spark: SparkSession, root: str, glob: str = "*.seg") -> DataFrame:
    """(path, size_bytes, sha256) of the files' bytes."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    return raw.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))


def align(df: DataFrame, schema: T.StructType, *, may_lack: frozenset[str]) -> DataFrame:
    """df in the schema given: casts, null for missing columns that may_lack allows, an error for others; extra ones go."""
    missing = [f.name for f in schema if f.name not in df.columns and f.name not in may_lack]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def missing_hours(entries: DataFrame) -> DataFrame:
    """(stream, date, hour) without an entry, of the days that have one."""
    days = entries.select("stream", "date").distinct()
    every = days.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return every.join(entries.select("stream", "date", "hour"), ["stream", "date", "hour"], "left_anti")


def finished_listing(listing: DataFrame) -> DataFrame:
    """Entries whose path names a finished segment. A null path is none."""
    return listing.where(F.col("path").endswith(".seg") | F.col("path").endswith(".parquet"))


def timestamps(spark: SparkSession, root: str, *, column: str = "timestamp", glob: str = "*.{seg,parquet}") -> DataFrame:
    """(path, t, problem) of the Parquet files below root: a row for each value of the time column (epoch ms, null stays null), or one
    row with the problem of a file that can't be read or lacks the column. No file hides another's state, and none is dropped
    unsaid. A task holds one file's bytes at a time, and of its columns only the time is decoded."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root).select("path", "content")

    def run(batches):
        import io

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        names = ["path", "t", "problem"]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    found = pq.ParquetFile(io.BytesIO(content.as_py())).read([column])[column]
                    t = pc.cast(found, pa.timestamp("ms", tz="UTC"), safe=False) if pa.types.is_timestamp(found.type) else found
                    t = t.cast(pa.int64()).combine_chunks()
                    if isinstance(t, pa.ChunkedArray):
                        t = pa.concat_arrays(t.chunks) if t.num_chunks else pa.array([], pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(t), pa.string()), t, pa.nulls(len(t), pa.string())], names)
                except (OSError, ValueError, KeyError) as error:  # Arrow's errors are among these
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([None], pa.int64()), pa.array([f"{type(error).__name__}: {error}"[:500]])], names)

    return raw.mapInArrow(run, "path string, t long, problem string")
