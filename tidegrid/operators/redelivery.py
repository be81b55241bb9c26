"""Messages delivered more than once (problem 4): exactly one copy of each is kept.

1. Identities are hashed; hashes fall into blocks, each of a bounded number of identities, and in a block into the time
   buckets their deliveries came in. Identities admitted by earlier runs have buckets of their own. Each task first counts
   equal hashes of a bucket, so copies of a hot identity travel as one row.
2. A block's task builds a Bloom filter per bucket (its false positives are set by the number of buckets) and holds each
   bucket's hashes against the filters of the others. A hash none of them covers, and which came once in its own bucket, is
   definitely new. The others, the possible repeats, are kept as one small bit array per block and bucket.
3. Deliveries are screened against the array of their own block and bucket, before anything is shuffled; only possible
   repeats go on, and of the earlier identities only those in matching buckets whose bits match. Those are compared exactly,
   as text. Bloom filters never miss a repeat, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.session import add_package, materialize

#: Bits an identity sets in a word of a block's array of possible repeats, and bits of the array per identity.
BITS, ROOM = 4, 14
#: Arrays of possible repeats up to this size in all are broadcast; beyond it they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: A task counts equal hashes over this many deliveries at a time.
COUNT_ROWS = 500_000
FIRST_STORED = -(2**40)


def framed(*parts: Column) -> Column:
    """``<length>:<value>`` of each part in turn; the length counts code points."""
    return F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])


def trade_identity(df: DataFrame) -> Column:
    """Identity of a trade: exchange, market type, instrument or '', stream, and its id without case and surrounding
    white space. Null where the id is null or blank, or where exchange, market type or stream is null."""
    trade = F.lower(F.regexp_replace("trade_id", r"^[\s ]+|[\s ]+$", ""))
    key = framed(F.col("exchange"), F.col("market_type"), F.coalesce("instrument_key", F.lit("")), F.col("stream"), trade)
    return F.when(F.length(trade) > 0, key)


def _blocks(deliveries: DataFrame, seen: DataFrame, block_bytes: int) -> int:
    """Number of blocks, from the size the optimizer estimates or, where it knows none (rows that lie in memory), from the
    number of input partitions; only the use of memory depends on it."""
    size = sum(int(str(d._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for d in (deliveries, seen))
    known = size < 1 << 55
    wanted = -(-size // block_bytes) if known else 4 * deliveries.rdd.getNumPartitions()
    return max(int(deliveries.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def _keyed(df: DataFrame, identity: Column, bucket: Column, blocks: int) -> DataFrame:
    """df with _i (identity), _h (its hash), _block and _bucket."""
    out = df.withColumn("_i", identity).withColumn("_h", F.xxhash64("_i")).withColumn("_bucket", bucket)
    return out.withColumn("_block", F.pmod(F.xxhash64("_h", F.lit(7)), F.lit(blocks)).cast("int"))


def _counted(batches):
    """Distinct (block, bucket, hash) of a task's rows with their number."""
    import numpy as np
    import pyarrow as pa

    def flush(held):
        block, bucket, h = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((h, bucket))
        block, bucket, h = block[order], bucket[order], h[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (bucket[1:] != bucket[:-1])]))
        n = np.diff(np.append(new, len(h)))
        return pa.RecordBatch.from_arrays([pa.array(block[new]), pa.array(bucket[new]), pa.array(h[new]), pa.array(n > 1)], ["_block", "_bucket", "_h", "again"])

    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(c).to_numpy() for c in ("_block", "_bucket", "_h")])
            rows += batch.num_rows
        if rows >= COUNT_ROWS:
            yield flush(held)
            held, rows = [], 0
    if held:
        yield flush(held)


class BloomFilter:
    """A Bloom filter over 64-bit hashes, sized for their number and the chance of a false positive."""

    def __init__(self, hashes, chance: float):
        import math

        import numpy as np

        bits = max(4.0, -math.log(chance) / math.log(2) ** 2)
        self.probes = max(1, round(bits * math.log(2)))
        self.bits = np.zeros(int(len(hashes) * bits) + 64, bool)
        for at in self._places(hashes):
            self.bits[at] = True

    def _places(self, hashes):
        import numpy as np

        h = hashes.astype(np.uint64)
        step = ((h >> np.uint64(33)) ^ (h * np.uint64(0x9E3779B97F4A7C15))) | np.uint64(1)
        for i in range(self.probes):
            yield ((h + np.uint64(i) * step) % np.uint64(len(self.bits))).astype(np.int64)

    def covers(self, hashes):
        """Whether each hash may be in the filter: never False for one that is."""
        import numpy as np

        open_rows, out = np.arange(len(hashes)), np.zeros(len(hashes), bool)
        for at in self._places(hashes):
            hit = self.bits[at[open_rows]]
            open_rows = open_rows[hit]
            if not len(open_rows):
                return out
        out[open_rows] = True
        return out


def _word_and_mask(h: Column, words: Column) -> tuple[Column, Column]:
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS), words).cast("int"), mask


def _packed(hashes):
    """The hashes' bits as an array of words (see ``_word_and_mask``)."""
    import numpy as np

    h = hashes.astype(np.uint64)
    words = np.zeros(max(1, -(-len(h) * ROOM // 64)), np.uint64)
    mask = np.zeros(len(h), np.uint64)
    for i in range(BITS):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    np.bitwise_or.at(words, ((h >> np.uint64(6 * BITS)) % np.uint64(len(words))).astype(np.int64), mask)
    return words.view(np.int64)


def _possible(pdf, chance: float):
    """The bit arrays of one block's possible repeats, one for each bucket that has any."""
    import numpy as np
    import pandas as pd

    bucket, h, again = pdf["_bucket"].to_numpy(), pdf["_h"].to_numpy(), pdf["again"].to_numpy()
    order = np.lexsort((h, bucket))
    bucket, h, again = bucket[order], h[order], again[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (bucket[1:] != bucket[:-1])]))
    size = np.diff(np.append(new, len(h)))  # tasks that counted the same hash
    again = np.logical_or.reduceat(again, new) | (size > 1)
    bucket, h = bucket[new], h[new]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])).tolist()
    spans = list(zip(starts, [*starts[1:], len(h)]))
    possible = again.copy()
    for begin, end in spans:
        own = BloomFilter(h[begin:end], chance / len(spans))
        for other in (slice(0, begin), slice(end, len(h))):
            possible[other] |= own.covers(h[other])
    out = [(pdf["_block"].iloc[0], bucket[b], _packed(h[b:e][possible[b:e]])) for b, e in spans if possible[b:e].any()]
    return pd.DataFrame(out, columns=["_block", "_bucket", "_words"])


def _screen(rows: DataFrame, arrays: DataFrame) -> DataFrame:
    """rows (see ``_keyed``) with _possible: whether their bits are in the array of their block and bucket. Each (block, bucket) has at most one."""
    word, mask = _word_and_mask(F.col("_h"), F.size("_words"))
    hit = F.element_at("_words", word + 1).bitwiseAND(mask) == mask
    return rows.join(arrays, ["_block", "_bucket"], "left").withColumn("_possible", F.coalesce(hit, F.lit(False))).drop("_words")


def _screened(
    deliveries: DataFrame, seen: DataFrame, *, identity: Column, id_col: str = "delivery_id", time_ms: Column, seen_col: str = "identity_key", seen_bucket: Column | None = None,
    bucket_ms: int = 6 * 3_600_000, block_bytes: int = 4 << 20, chance: float = 0.01,
) -> tuple[DataFrame, DataFrame]:
    """The deliveries with _at and _possible, and the earlier identities (_i) that may be among them."""
    add_package(deliveries.sparkSession)
    blocks = _blocks(deliveries, seen, block_bytes)
    rows = deliveries.withColumn("_at", F.coalesce(time_ms, F.lit(2**62)))
    bucket = F.when(F.col("_at") < 2**62, F.floor(F.col("_at") / bucket_ms)).otherwise(-1).cast("long")
    rows = _keyed(rows, identity, bucket, blocks)
    stored = F.lit(FIRST_STORED) - F.coalesce((F.lit(0) if seen_bucket is None else seen_bucket).cast("long"), F.lit(-1))
    old = _keyed(seen.where(F.col(seen_col).isNotNull()), F.col(seen_col), stored, blocks).select("_i", "_h", "_block", "_bucket")
    hashes = rows.where("_i is not null").select("_block", "_bucket", "_h").unionByName(old.select("_block", "_bucket", "_h"))
    counted = hashes.mapInArrow(_counted, "_block int, _bucket long, _h long, again boolean").repartition(blocks, "_block")
    arrays = materialize(counted.groupBy("_block").applyInPandas(lambda pdf: _possible(pdf, chance), "_block int, _bucket long, _words array<bigint>"), "possible-repeats")
    held = arrays.agg(F.sum(F.size("_words") * 8 + 64)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        arrays = F.broadcast(arrays)
    return _screen(rows, arrays), _screen(old, arrays).where("_possible").select("_i")


def _judged(possible: DataFrame, earlier: DataFrame, id_col: str) -> DataFrame:
    """(id_col, reason) of the deliveries to drop among the possible repeats, by their identities' text."""
    repeats = materialize(possible.select(F.col(id_col).alias("id"), F.col("_at").alias("at"), F.col("_i").alias("identity")), "repeats")
    place = F.struct("at", F.coalesce("id", F.lit(2**63 - 1)).alias("i"))
    first = repeats.groupBy("identity").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    stored = earlier.select(F.col("_i").alias("identity")).distinct().withColumn("seen", F.lit(True))
    judged = first.join(stored, "identity", "left").where((F.col("n") > 1) | F.col("seen"))
    out = repeats.join(judged, "identity").where(F.col("seen") | (place != F.col("first")))
    return out.select(F.col("id").alias(id_col), F.when(F.col("seen"), "seen").otherwise("repeat").alias("reason"))


def repeated_deliveries(deliveries: DataFrame, seen: DataFrame, *, id_col: str = "delivery_id", **options) -> DataFrame:
    """(id_col, reason) of the deliveries to drop: ``seen`` (an earlier run admitted the identity) or ``repeat`` (another
    delivery of it came first, by time, then id).

    Options: identity and time_ms (columns of deliveries), seen_col, seen_bucket (the stored bucket of an earlier identity),
    bucket_ms. Deliveries without an identity are never dropped. Contents aren't compared. A null time comes last, a null id
    too; of deliveries equal in both one, no particular one, would stay, and ids being unique none are. Repeated rows
    in ``seen`` don't matter, null identities there are ignored. Other columns of both tables are not read.
    """
    rows, earlier = _screened(deliveries, seen, id_col=id_col, **options)
    return _judged(rows.where("_possible"), earlier, id_col)


def first_deliveries(deliveries: DataFrame, seen: DataFrame, *, id_col: str = "delivery_id", **options) -> DataFrame:
    """The deliveries that remain: exactly one of each identity not seen before, and all without an identity. What the
    filters find definitely new passes without a shuffle. A delivery with a null id stays."""
    rows, earlier = _screened(deliveries, seen, id_col=id_col, **options)
    drop = _judged(rows.where("_possible"), earlier, id_col).select(id_col)
    checked = rows.where("_possible").select(deliveries.columns).join(drop, id_col, "left_anti")
    return rows.where("not _possible").select(deliveries.columns).unionByName(checked)
