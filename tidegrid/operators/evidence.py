"""Exact duplicates: first occurrence wins, forensics of repeats, census over segments, digests of identity sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, *, identity: list[str], order: list[str]) -> DataFrame:
    """One row of each identity, the first in ``order``; rows with a null in the identity are all kept.

    A partial aggregation picks the row, so a hot identity is reduced before it is shuffled.
    """
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    row = F.struct(*df.columns)
    once = df.where(known).groupBy(*identity).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")
    return once.unionByName(df.where(~known))


def repeats_of(df: DataFrame, *, identity: list[str], order: list[str], content: list[str], time_ms: Column) -> DataFrame:
    """Every later delivery of an identity: its columns with delay_ms (after the first one), kind (EXACT_DUPLICATE where all of
    ``content`` equals the first's, else IDENTITY_PAYLOAD_CONFLICT) and ambiguous (same arrival time as the first)."""
    known = F.lit(True)
    for c in identity:
        known = known & F.col(c).isNotNull()
    rows = df.where(known).withColumn("_t", time_ms)
    first = rows.groupBy(*identity).agg(F.min(F.struct(*order)).alias("_o"), F.min_by(F.struct("_t", *content), F.struct(*order)).alias("_f"), F.count(F.lit(1)).alias("_n"))
    met = rows.join(first.where("_n > 1"), identity).where(F.struct(*order) != F.col("_o"))
    same = F.lit(True)
    for c in content:
        same = same & F.col(c).eqNullSafe(F.col("_f")[c])
    delay = F.col("_t") - F.col("_f._t")
    return met.select(
        *df.columns, delay.alias("delay_ms"), F.when(same, "EXACT_DUPLICATE").otherwise("IDENTITY_PAYLOAD_CONFLICT").alias("kind"), (delay == 0).alias("ambiguous")
    )


def nearest_rank(values: Column, p: float) -> Column:
    """The value at rank round-half-even(p * (n - 1)) of a sorted array."""
    return F.try_element_at(values, F.bround(F.lit(p) * (F.size(values) - 1)).cast("int") + 1)


def delay_percentiles(repeats: DataFrame, *, by: list[str], points=(0.5, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank percentiles of delay_ms with n, min and max per group.

    Delays are first counted per value; ranks come from running counts over the distinct values of a group, so no group's
    delays are gathered in one row.
    """
    counts = repeats.where("delay_ms is not null").groupBy(*by, "delay_ms").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by).orderBy("delay_ms")
    counts = counts.withColumn("high", F.sum("c").over(w)).withColumn("n", F.sum("c").over(Window.partitionBy(*by)))
    picks = [F.min(F.when(F.col("high") > F.bround(F.lit(p) * (F.col("n") - 1)), F.col("delay_ms"))).alias(f"p{int(p * 100):02d}_ms") for p in points]
    return counts.groupBy(*by).agg(F.max("n").alias("n"), F.min("delay_ms").alias("min_ms"), *picks, F.max("delay_ms").alias("max_ms"))


def census(df: DataFrame, *, identity: list[str], segment: str) -> DataFrame:
    """How many segments hold an identity: (owners, identities, row_count)."""
    per = df.groupBy(*identity, segment).agg(F.count(F.lit(1)).alias("r")).groupBy(*identity).agg(F.count(F.lit(1)).alias("owners"), F.sum("r").alias("r"))
    return per.groupBy("owners").agg(F.count(F.lit(1)).alias("identities"), F.sum("r").alias("row_count"))


def segment_distances(df: DataFrame, *, identity: list[str], segment: str) -> DataFrame:
    """(bucket, n) over neighbouring owners of an identity: adjacent, 2-10, 11-100 or >100 segments apart."""
    owners = df.groupBy(*identity, segment).agg(F.lit(1).alias("_"))
    d = F.col(segment) - F.lag(segment).over(Window.partitionBy(*identity).orderBy(segment))
    bucket = F.when(F.col("d") == 1, "adjacent").when(F.col("d") <= 10, "2-10").when(F.col("d") <= 100, "11-100").otherwise(">100")
    return owners.withColumn("d", d).where("d is not null").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def set_digest(df: DataFrame, *, by: list[str], key: Column, leaf: int = 4096, fan: int = 256) -> DataFrame:
    """(by, n_keys, digest): order-independent digest of each group's set of keys, as a tree.

    Distinct keys fall by hash into as many leaves as the group's number of keys asks for, about ``leaf`` keys each; a leaf's
    digest is the SHA-256 of its sorted, length-framed keys, a node's that of its ``fan`` children's in order. So no row holds
    more than a leaf's keys or a node's digests, whatever the group's size.
    """
    keys = df.select(*by, key.alias("_k")).where("_k is not null").distinct()
    counts = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("n_keys"))
    most = counts.agg(F.max("n_keys")).first()[0] or 0
    leaves = F.greatest(F.ceil(F.col("n_keys") / leaf), F.lit(1))
    match = [F.col(f"k.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    framed = F.concat(F.octet_length("_k").cast("string"), F.lit(":"), F.col("_k"))
    every = keys.alias("k").join(counts.alias("c"), match, "inner").select("k.*", "c.n_keys").withColumn("_b", F.pmod(F.xxhash64("_k"), leaves))
    level = every.groupBy(*by, "n_keys", "_b").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(framed)), ""), 256).alias("d"))
    width = max(1, -(-most // leaf))
    while True:
        inner = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "d"))), lambda x: x["d"]), ""), 256)
        level = level.withColumn("_up", F.floor(F.col("_b") / fan)).groupBy(*by, "n_keys", "_up").agg(inner.alias("d")).withColumnRenamed("_up", "_b")
        width = -(-width // fan)
        if width == 1:
            return level.select(*by, "n_keys", F.col("d").alias("digest"))


def index_audit(on_disk: DataFrame, index: DataFrame, *, key: str, digest: str) -> DataFrame:
    """(key, reason) of keys where what is stored and the index disagree: missing_in_index, missing_on_disk, digest_differs."""
    a, b = on_disk.select(key, F.col(digest).alias("_a")), index.select(key, F.col(digest).alias("_b"))
    met = a.withColumn("_x", F.lit(True)).join(b.withColumn("_y", F.lit(True)), key, "full_outer")
    reason = F.when(F.col("_y").isNull(), "missing_in_index").when(F.col("_x").isNull(), "missing_on_disk").when(~F.col("_a").eqNullSafe(F.col("_b")), "digest_differs")
    return met.withColumn("reason", reason).where("reason is not null").select(key, "reason")


def rebuilt_index(rows: DataFrame, *, key: Column, segment: str) -> DataFrame:
    """(identity_key, first_segment_id) as the segments themselves give it: the lowest segment that holds each identity. Rows
    without an identity or a segment give none. To be held against the stored index with ``index_audit``."""
    return rows.select(key.alias("identity_key"), F.col(segment).alias("_s")).where("identity_key is not null and _s is not null").groupBy("identity_key").agg(F.min("_s").alias("first_segment_id"))
