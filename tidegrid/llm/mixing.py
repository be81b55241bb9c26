"""Mixing of sources to target weights (problem 9).

1. ``pack_blocks``: documents fall into shards by hash, a number of them set by the number of documents alone, and are
   ordered by id within. A task encodes the texts of its shards and packs each source's tokens into blocks of a fixed length.
   What is left of a shard and source is packed again with that of other shards, so a source has one short block for each
   TAILS shards. Blocks depend on the documents, not on how their table is split.
2. Blocks of a source are numbered by adding counts per shard, full ones first, so that no source is sorted in one place.
3. ``quotas``, in tokens: the size of a mix is the largest at which every source reaches its weight within max_repeats.
   ``plan_slots``: whole rounds take all of a source's blocks, the last round takes full ones and cuts the very last block, so
   a source's tokens are its quota. Each group of shards gets its exact part of every source; within a group each shard's
   counts are drawn at random (the multinomial draw under the condition that the group's totals are kept), and the n-th slot of
   a source takes a block by a keyed pseudorandom permutation of the source's block numbers, one for each round.
4. Slots and blocks meet in one equi-join on (source, block number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.tokens import TOKENIZER_DIR, LibraryEncoder, encoded, slices, word_encoder
from tidegrid.session import add_package, materialize


#: Rows of (source, task, start) that may be broadcast: some 30 MB.
MOST_BROADCAST_ROWS = 500_000
#: Shards whose left-over tokens are packed together: at most TAILS * (block_tokens - 1) tokens a source in one place.
TAILS = 256


def source_name(column):
    """Sources spelled with other case or blanks are the same source."""
    return F.lower(F.regexp_replace(column, r"^[\s ]+|[\s ]+$", ""))


def _cut(ids, block_tokens: int):
    """Ends of the blocks of a run of tokens; the last may be short."""
    import numpy as np

    return np.minimum(np.arange(-(-len(ids) // block_tokens) + 1) * block_tokens, len(ids)).astype(np.int32)


def pack_blocks(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_tokens: int = 512,
    docs_per_shard: int = 4_000,
    tokenizer: str = f"{TOKENIZER_DIR}/byte_bpe_50k.json",
    slice_bytes: int = 8_000_000,
) -> DataFrame:
    """(source, shard, at, n_tokens, ids): blocks of each source's tokens, at from 0 in each shard, the last one of a shard maybe
    short. Null sources are left out. docs_per_shard: documents of a shard, on the average."""
    spark = docs.sparkSession
    add_package(spark)
    shards = max(1, -(-docs.count() // docs_per_shard))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def emit(shard, name, ids):
            ends = _cut(ids, block_tokens)
            n = len(ends) - 1
            columns = [pa.array([name] * n), pa.array(np.full(n, shard, np.int64)), pa.array(np.arange(n)), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))]
            return pa.RecordBatch.from_arrays(columns, ["source", "shard", "at", "n_tokens", "ids"])

        shard, held = None, {}
        for table in slices(batches, "text", slice_bytes):
            _, _, _, first, ids, counts = encoded(table["text"], word_encoder(tokenizer, LibraryEncoder))
            ends = np.concatenate([[0], np.cumsum(counts)])[first]
            names, of = table["source"].to_pylist(), table["shard"].to_numpy()
            for row, (name, at) in enumerate(zip(names, of.tolist())):
                if at != shard:
                    yield from (emit(shard, n, np.concatenate(v)) for n, v in held.items())
                    shard, held = at, {}
                held.setdefault(name, []).append(ids[ends[row] : ends[row + 1]])
        yield from (emit(shard, n, np.concatenate(v)) for n, v in held.items())

    id_, text = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(source_name(F.col(source_col)).alias("source"), text.alias("text"), id_.alias("id"), F.pmod(F.xxhash64(id_, text), F.lit(shards)).alias("shard"))
    texts = texts.where(F.col("source").isNotNull() & (F.length("text") > 0))
    parts = min(shards, 100 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = texts.repartition(parts, "shard").sortWithinPartitions("shard", "id", "text", "source")
    return texts.mapInArrow(run, "source string, shard long, at long, n_tokens int, ids array<int>")


def stored_blocks(docs: DataFrame, *, block_tokens: int = 512, **options) -> DataFrame:
    """The blocks written to the shared folder and numbered: (source, block_no, n_tokens, ids). A source's full blocks come first."""
    packed = materialize(pack_blocks(docs, block_tokens=block_tokens, **options), "blocks")
    whole = F.col("n_tokens") == block_tokens

    def again(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("shard")
        ids = np.concatenate([np.asarray(x, np.int32) for x in pdf.ids])
        ends = _cut(ids, block_tokens)
        rows = [(pdf.source.iloc[0], int(pdf.grp.iloc[0]), k, int(b - a), ids[a:b]) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]
        return pd.DataFrame(rows, columns=["source", "shard", "at", "n_tokens", "ids"])

    grp = F.floor(F.col("shard") / TAILS).cast("long")
    tails = packed.where(~whole).select("source", "shard", "ids", grp.alias("grp")).groupBy("source", "grp").applyInPandas(again, packed.schema)
    tails = materialize(tails, "block-tails")
    # 0: packed at once, 1: full, of tails, 2: short
    blocks = packed.where(whole).withColumn("kind", F.lit(0)).unionByName(tails.withColumn("kind", F.when(whole, 1).otherwise(2)))
    blocks = blocks.withColumn("at", F.when(F.col("kind") == 2, 0).otherwise(F.col("at")))  # a group of tails has one short block
    by_shard = blocks.groupBy("source", "kind", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("kind", "shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialize(by_shard.select("source", "kind", "shard", F.coalesce(before, F.lit(0)).alias("start")), "block-starts")
    if starts.count() <= MOST_BROADCAST_ROWS:  # a row for each shard and source; beyond the bound, a shuffled join
        starts = F.broadcast(starts)
    numbered = blocks.join(starts, ["source", "kind", "shard"])
    return numbered.select("source", (F.col("start") + F.col("at")).alias("block_no"), "n_tokens", "ids")


def permuted(index, size: int, key: int):
    """A pseudorandom permutation of 0..size-1 at the given places: a keyed four-round Feistel network, walked until it
    falls below size. index: an int64 array."""
    import numpy as np

    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in range(4):
            mixed = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 4 + r) & 0xFFFFFFFFFFFFFFFF)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def quotas(weights: dict[str, float], tokens: dict[str, int], repeats: dict[str, int]) -> dict[str, int]:
    """Tokens of each source in the largest mix that keeps the weights within the repeats. Sources without tokens, weight
    or repeats have none; the weights of the others are taken relative to their sum."""
    able = {s: w for s, w in weights.items() if w and w > 0 and tokens.get(s) and (repeats.get(s) or 0) > 0}
    if not able:
        return {}
    total = sum(able.values())
    size = min(tokens[s] * repeats[s] * total / w for s, w in able.items())
    return {s: min(int(size * w / total + 1e-6), tokens[s] * repeats[s]) for s, w in able.items()}


def slots_of(quota: int, block_tokens: int, full: int, shorts: list[int]) -> tuple[int, int]:
    """(slots, tokens of the last one) that hold exactly ``quota`` tokens of a source of ``full`` full blocks and some short ones:
    whole rounds of all blocks, then full blocks, then short ones, the last cut."""
    round_tokens, round_slots = full * block_tokens + sum(shorts), full + len(shorts)
    rounds, rest = divmod(quota, round_tokens)
    if not rest:  # ends with the last block of a round, which nothing cuts
        return rounds * round_slots, -1
    slots = min(full, -(-rest // block_tokens))
    if rest <= slots * block_tokens:
        return rounds * round_slots + slots, rest - (slots - 1) * block_tokens
    rest -= slots * block_tokens
    for n in shorts:
        slots += 1
        if rest <= n:
            break
        rest -= n
    return rounds * round_slots + slots, rest


def plan_slots(spark, mixes: dict[str, dict[str, tuple[int, int, int, int]]], *, shard_blocks: int = 1024, group_shards: int = 64, seed: int = 17) -> DataFrame:
    """(mix_name, shard, slot, source, round, block_no, take) for mixes {mix: {source: (slots, blocks of the source, full blocks
    among them, tokens of the last slot)}}; take: tokens to take of the block, -1 for all.

    Slots from 0 in each shard; every shard but a group's last has shard_blocks of them. The same seed, the same plan.
    """
    add_package(spark)
    groups = [(mix, max(1, -(-sum(x[0] for x in sources.values()) // (shard_blocks * group_shards)))) for mix, sources in sorted(mixes.items())]
    plan = {m: sorted(s.items()) for m, s in mixes.items()}

    def run(batches):
        import hashlib

        import numpy as np
        import pandas as pd

        for pdf in batches:
            for mix, group, n_groups in zip(pdf["mix_name"], pdf["grp"], pdf["n_groups"]):
                names = [s for s, _ in plan[mix]]
                slots = [x[0] for _, x in plan[mix]]
                begin = [n * group // n_groups for n in slots]
                left = np.array([n * (group + 1) // n_groups for n in slots]) - begin
                place = np.array(begin)
                digest = hashlib.sha256(f"{seed}|{mix}|{group}".encode()).digest()
                rng = np.random.default_rng(int.from_bytes(digest[:8], "little"))
                shard = group * (group_shards + 1)
                while left.sum():
                    size = min(shard_blocks, int(left.sum()))
                    draw = rng.multivariate_hypergeometric(left, size, method="marginals") if len(left) > 1 else np.array([size])
                    order = rng.permutation(size)
                    which = np.repeat(np.arange(len(names)), draw)
                    nth = np.concatenate([np.arange(p, p + d) for p, d in zip(place, draw)])
                    block, turn, take = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1, np.int32)
                    for i, (name, (n_slots, blocks, full, last)) in enumerate(plan[mix]):
                        mine = which == i
                        turn[mine] = nth[mine] // blocks
                        for t in np.unique(turn[mine]):
                            key = int.from_bytes(hashlib.sha256(f"{seed}|{mix}|{name}|{t}".encode()).digest()[:6], "little")
                            now = mine & (turn == t)
                            at = nth[now] % blocks
                            if (t + 1) * blocks > n_slots:  # the round that isn't whole: full blocks first, then short ones in order
                                at[at < full] = permuted(at[at < full], full, key)
                            else:
                                at = permuted(at, blocks, key)
                            block[now] = at
                        take[mine & (nth == n_slots - 1)] = last
                    yield pd.DataFrame(
                        {"mix_name": mix, "shard": shard, "slot": order, "source": np.array(names, object)[which], "round": turn, "block_no": block, "take": take}
                    )
                    place, left, shard = place + draw, left - draw, shard + 1

    schema = "mix_name string, shard long, slot long, source string, round long, block_no long, take int"
    every = spark.createDataFrame(groups, "mix_name string, n_groups long").select("mix_name", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_groups") - 1)).alias("grp"), "n_groups")
    parts = max(1, min(sum(n for _, n in groups), 100 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return every.repartition(parts, "mix_name", "grp").mapInPandas(run, schema)


def _targets(targets: DataFrame, blocks: DataFrame, block_tokens: int):
    """(the settings' rows, {source: its tokens, full blocks and the sizes of its short ones}, {mix: {source: as ``plan_slots`` wants it}})."""
    rows = (
        targets.where(F.col("mix_name").isNotNull() & F.col("source").isNotNull())
        .groupBy("mix_name", source_name(F.col("source")).alias("source"))
        .agg(F.sum("target_weight").alias("w"), F.max("max_repeats").alias("r"))
        .limit(100_001)
        .collect()
    )
    if len(rows) > 100_000:
        raise ValueError("more than 100,000 mix targets")
    named = targets.select(source_name(F.col("source")).alias("source")).distinct()
    short = F.when(F.col("n_tokens") < block_tokens, F.struct("block_no", "n_tokens"))
    held = blocks.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_if(F.col("n_tokens") == block_tokens).alias("full"), F.collect_list(short).alias("shorts"))
    # short blocks: one for TAILS shards
    held = {r.source: (r.tokens, r.full, [x.n_tokens for x in sorted(r.shorts)]) for r in held.join(named, "source", "left_semi").collect()}
    mixes: dict = {}
    for mix in {r.mix_name for r in rows}:
        own = [r for r in rows if r.mix_name == mix]
        quota = quotas({r.source: r.w for r in own}, {s: x[0] for s, x in held.items()}, {r.source: r.r for r in own})
        mixes[mix] = {}
        for s, q in quota.items():
            if q:
                slots, last = slots_of(q, block_tokens, *held[s][1:])
                mixes[mix][s] = (slots, held[s][1] + len(held[s][2]), held[s][1], last)
    return rows, held, {m: s for m, s in mixes.items() if s}


def mix_sources(docs: DataFrame, targets: DataFrame, *, block_tokens: int = 512, shard_blocks: int = 1024, seed: int = 17, **options) -> DataFrame:
    """The mixed blocks: mix_name, shard, slot, source, round, block_no, n_tokens, ids.

    Sources are compared without case and surrounding blanks; a source named twice in a mix has the sum of its weights
    and the larger of its max_repeats. Documents without a source, and null and empty texts, add no tokens. A source
    without documents, a positive weight or a positive max_repeats has no slots. A block occurs at most max_repeats
    times in a mix, in different rounds; of a source's last slot only the beginning may be taken, so that its tokens are its
    quota. The rows depend on the documents and the seed, not on how the tables are split. Targets are settings: more than
    100,000 are refused. Empty tables: no rows.
    """
    blocks = stored_blocks(docs, block_tokens=block_tokens, **options)
    _, _, mixes = _targets(targets, blocks, block_tokens)
    slots = plan_slots(docs.sparkSession, mixes, shard_blocks=shard_blocks, seed=seed)
    # the planner can't know how many slots the plan makes; a shuffled join, built on the slots, holds at any number
    out = slots.hint("shuffle_hash").join(blocks, ["source", "block_no"])
    cut = F.col("take") >= 0
    n, ids = F.when(cut, F.col("take")).otherwise(F.col("n_tokens")), F.when(cut, F.slice("ids", F.lit(1), F.greatest("take", F.lit(0)))).otherwise(F.col("ids"))
    return out.select("mix_name", "shard", "slot", "source", "round", "block_no", n.alias("n_tokens"), ids.alias("ids"))


def mix_shares(docs: DataFrame, targets: DataFrame, *, block_tokens: int = 512, seed: int = 17, **options) -> DataFrame:
    """Shares really reached: mix_name, source, target_share, share, n_tokens, n_slots, n_blocks, most_repeats.

    One row for each source a mix names; target_share is its weight over all weights of the mix, those of sources
    without documents included, share its part of the mix's tokens."""
    spark = docs.sparkSession
    blocks = stored_blocks(docs, block_tokens=block_tokens, **options)
    rows, held, mixes = _targets(targets, blocks, block_tokens)
    slots = plan_slots(spark, mixes, seed=seed)
    used = slots.groupBy("mix_name", "source", "block_no").agg(F.count(F.lit(1)).alias("times"), F.count_if(F.col("take") < 0).alias("whole"), F.sum(F.greatest("take", F.lit(0))).alias("part"))
    joined = used.hint("shuffle_hash").join(blocks.select("source", "block_no", "n_tokens"), ["source", "block_no"])
    reached = joined.groupBy("mix_name", "source").agg(
        F.sum(F.col("whole") * F.col("n_tokens") + F.col("part")).alias("n_tokens"), F.sum("times").alias("n_slots"), F.max("times").alias("most_repeats")
    )
    totals: dict = {}
    for r in rows:
        totals[r.mix_name] = totals.get(r.mix_name, 0) + (r.w or 0)
    blocks_of = {s: full + len(shorts) for s, (_, full, shorts) in held.items()}
    wanted = spark.createDataFrame(
        [(r.mix_name, r.source, (r.w or 0) / totals[r.mix_name] if totals[r.mix_name] else None, blocks_of.get(r.source, 0)) for r in rows],
        "mix_name string, source string, target_share double, n_blocks long",
    )
    out = wanted.join(reached, ["mix_name", "source"], "left")
    whole = F.sum("n_tokens").over(Window.partitionBy("mix_name"))
    return out.select(
        "mix_name",
        "source",
        "target_share",
        F.coalesce(F.col("n_tokens") / whole, F.lit(0.0)).alias("share"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_slots")],
        "n_blocks",
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
