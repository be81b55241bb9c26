"""Publication of segments and datasets: markers beside segments, generations named by their content, acceptance of hourly tables."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.operators.evidence import set_digest
from tidegrid.session import hadoop_fs

# Fixed values of the marker format.
MARKER_SCHEMA, WRITER_SCHEMA, CONFIRMED = 2, "parquet_writer/2", "PUBLICATION_CONFIRMED"
CONFIRMED_BY = ("writer", "startup_refsync")


def markers(segments: DataFrame, *, confirmed_by: str = "writer", legacy: bool = False, confirmed_at: str) -> DataFrame:
    """(segment, content) from segments (segment, record_count, first_ts, last_ts, sha256, size_bytes): the marker's text, keys sorted,
    compact, one newline at the end."""
    if confirmed_by not in CONFIRMED_BY:
        raise ValueError(f"confirmed_by must be one of {CONFIRMED_BY}")
    long = lambda c: F.col(c).cast("long")
    publication = F.struct(
        F.lit(None).cast("string").alias("boot_id"), F.lit(confirmed_at).alias("confirmed_at_utc"), F.lit(confirmed_by).alias("confirmed_by"), F.lit(legacy).alias("legacy"),
        F.lit(MARKER_SCHEMA).alias("schema"), "segment", "sha256", long("size_bytes").alias("size_bytes"), F.lit(CONFIRMED).alias("state"), F.lit(WRITER_SCHEMA).alias("writer_schema"),
    )
    marker = F.struct(long("first_ts").alias("first_record_ts"), long("last_ts").alias("last_record_ts"), publication.alias("publication"), long("record_count").alias("record_count"))
    return segments.select("segment", F.concat(F.to_json(marker, {"ignoreNullFields": "false"}), F.lit("\n")).alias("content"))


def marker_status(found: DataFrame) -> DataFrame:
    """(segment, content, status, problems) of marker texts (segment, content): VALID, ABSENT (no text, or one from before publication
    was marked) or INVALID with every problem. The segment's bytes aren't looked at (see ``byte_verdicts``)."""
    v = F.try_parse_json("content")
    get = lambda path, kind: F.try_variant_get(F.col("_v"), path, kind)
    # a number in quotes is no number, nor is true
    plain = lambda path, *kinds: F.coalesce(F.schema_of_variant(F.try_variant_get(F.col("_v"), path, "variant")).isin(*kinds), F.lit(False))
    whole = lambda path, low=None: plain(path, "BIGINT") & (F.lit(True) if low is None else F.coalesce(get(path, "bigint") >= low, F.lit(False)))
    absent = lambda path: F.coalesce(F.is_variant_null(F.try_variant_get(F.col("_v"), path, "variant")), F.lit(True))
    p = "$.publication."
    rules = [
        ("schema != 2", whole(p + "schema") & (get(p + "schema", "bigint") == MARKER_SCHEMA)), ("state != PUBLICATION_CONFIRMED", get(p + "state", "string") == CONFIRMED),
        ("segment name does not match", get(p + "segment", "string") == F.col("segment")), ("size_bytes invalid", whole(p + "size_bytes", 0)),
        ("sha256 invalid", plain(p + "sha256", "STRING") & get(p + "sha256", "string").rlike("^[0-9a-f]{64}$")), ("confirmed_by not allowed", get(p + "confirmed_by", "string").isin(*CONFIRMED_BY)),
        ("legacy not a bool", plain(p + "legacy", "BOOLEAN")), ("record_count invalid", whole("$.record_count", 0)),
        *[(f"{k} invalid", absent(f"$.{k}") | whole(f"$.{k}")) for k in ("first_record_ts", "last_record_ts")],
    ]
    rows = found.select("segment", "content", v.alias("_v"))
    shape = F.coalesce(F.schema_of_variant("_v"), F.lit(""))
    publication = F.schema_of_variant(F.try_variant_get(F.col("_v"), "$.publication", "variant"))
    problems = F.array_compact(F.array(*[F.when(~F.coalesce(holds, F.lit(False)), name) for name, holds in rules]))
    one = lambda text: F.array(F.lit(text))
    problems = (
        F.when(F.col("content").isNull(), F.array().cast("array<string>")).when(F.col("_v").isNull(), one("not valid JSON")).when(~shape.startswith("OBJECT"), one("top level is not a JSON object"))
        .when(publication.isNull(), F.array().cast("array<string>")).when(~publication.startswith("OBJECT"), one("publication is not an object")).otherwise(problems)
    )
    none = F.col("content").isNull() | shape.startswith("OBJECT") & publication.isNull()
    status = F.when(none, "ABSENT").when(F.size("problems") == 0, "VALID").otherwise("INVALID")
    return rows.withColumn("problems", problems).select("segment", "content", status.alias("status"), "problems")


def byte_verdicts(digests: DataFrame, claims: DataFrame) -> DataFrame:
    """(segment, verdict) of segments' bytes (segment, size_bytes, sha256) against their markers' claims (the same columns):
    VERIFIED, SIZE_MISMATCH, SHA256_MISMATCH, UNCLAIMED (no marker) or MISSING (no segment)."""
    a = digests.select("segment", F.col("size_bytes").alias("_s"), F.col("sha256").alias("_h"), F.lit(True).alias("_a"))
    b = claims.select("segment", F.col("size_bytes").alias("_s0"), F.col("sha256").alias("_h0"), F.lit(True).alias("_b"))
    verdict = (
        F.when(F.col("_a").isNull(), "MISSING").when(F.col("_b").isNull(), "UNCLAIMED").when(~F.col("_s").eqNullSafe(F.col("_s0")), "SIZE_MISMATCH")
        .when(~F.col("_h").eqNullSafe(F.col("_h0")), "SHA256_MISMATCH").otherwise("VERIFIED")
    )
    return a.join(b, "segment", "full_outer").select("segment", verdict.alias("verdict"))


def label_horizon(schema) -> int:
    """The longest horizon in seconds among columns return_<N>s; 0 without one. Reads no data."""
    return max((int(m[1]) for f in schema if (m := re.fullmatch(r"return_(\d+)s", f.name))), default=0)


def content_id(parts: dict[str, DataFrame]) -> tuple[str, dict[str, str]]:
    """(id, {name: digest}): digests of the tables' rows whatever their order, and 16 hex digits over all of them."""
    digests = {}
    for name, df in sorted(parts.items()):
        text = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
        # rows that occur several times count
        rows = df.groupBy(text.alias("t")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), F.concat(F.col("n").cast("string"), F.lit(" "), F.col("t")).alias("k"))
        row = set_digest(rows, by=["part"], key=F.col("k")).first()
        digests[name] = row.digest if row else hashlib.sha256(b"").hexdigest()
    joined = "\n".join(f"{n}:{d}" for n, d in sorted(digests.items()))
    return hashlib.sha256(joined.encode()).hexdigest()[:16], digests


def publish_generation(spark: SparkSession, out_dir: str, parts: dict[str, DataFrame], manifest: dict) -> str:
    """Write the tables to out_dir/generations/<id>, the manifest last, and return the id. A generation that has its manifest
    is compared with its tables instead of being written again; one without is written anew."""
    name, digests = content_id(parts)
    root = f"{out_dir.rstrip('/')}/generations/{name}"
    fs, path = hadoop_fs(spark, root)
    if fs.exists(path(f"{root}/manifest.json")):
        again, _ = content_id({n: spark.read.schema(df.schema).parquet(f"{root}/{n}") for n, df in parts.items()})
        if again != name:
            raise RuntimeError(f"generation {name} doesn't hold what its name says")
        return name
    for n, df in parts.items():
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{root}/{n}")
    text = json.dumps(manifest | {"generation": name, "digests": digests}, sort_keys=True, separators=(",", ":"), default=str)
    stream = fs.create(path(f"{root}/.manifest.json"), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(path(f"{root}/.manifest.json"), path(f"{root}/manifest.json")):
        raise RuntimeError("the manifest couldn't be moved into place")
    return name


def accept_hours(rows: DataFrame, *, by: list[str], time_ms: Column, instrument: Column, expected: str, id_col: str | None = None) -> DataFrame:
    """(by, n, problems) of hourly tables: null_time, repeated_time (of several rows; of trades, told by id_col, repeated_key),
    other_instrument. A table is accepted if it has none. One row for each table that has rows; rows are counted per time (and id)
    first, so no table is ordered or gathered."""
    key = [time_ms.alias("_t"), *([F.col(id_col).alias("_id")] if id_col else [])]
    wrong = F.coalesce(instrument != expected, F.lit(False))
    once = rows.select(*by, *key, wrong.alias("_w")).groupBy(*by, "_t", *(["_id"] if id_col else [])).agg(F.count(F.lit(1)).alias("n"), F.count_if("_w").alias("w"))
    doubled = F.count_if((F.col("n") > 1) & F.col("_t").isNotNull())
    totals = once.groupBy(*by).agg(F.sum("n").alias("n"), F.count_if(F.col("_t").isNull()).alias("_null"), doubled.alias("_twice"), F.sum("w").alias("_other"))
    names = (("_null", "null_time"), ("_twice", "repeated_key" if id_col else "repeated_time"), ("_other", "other_instrument"))
    return totals.select(*by, "n", F.array_compact(F.array(*[F.when(F.col(c) > 0, name) for c, name in names])).alias("problems"))


def overlaps(ranges: DataFrame, *, by: list[str], shared_end: bool = False) -> DataFrame:
    """ranges (by, name, min_ms, max_ms) that begin before (or, unless shared_end, when) one before them in order of min_ms, max_ms
    and name ends: by, name, overlap_ms."""
    w = Window.partitionBy(*by).orderBy("min_ms", "max_ms", "name").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("max_ms").over(w)
    out = ranges.withColumn("_b", before).where((F.col("_b") > F.col("min_ms")) if shared_end else (F.col("_b") >= F.col("min_ms")))
    return out.select(*by, "name", (F.col("_b") - F.col("min_ms")).alias("overlap_ms"))
