"""Problems 3, 8, 9 and 10 against brute force, the public library and exact round trips."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import mixing, nearest, pieces, tokens

VOCABULARY = f"{tokens.TOKENIZER_DIR}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files")

TEXTS = [
    None, "", " ", "  ", "\n", "\n\n  x", "a", "Hello world, it's  we'll 'street 's's ''s don'T", "  indented\n\n\n- item\n  - inner 12345 678", "tab\tand nbsp　wide line",
    "价格没有更新。请检查！好的？", "Привет, мир 123", "é \U0001f600\U0001f680 ​ zero", "<|endoftext|> is text", "x" * 5000, "ha" * 3000, "=" * 3859, " " * 2000 + "z", "\n" * 99,
    "0" * 4001, "a1b2c3" * 500, "# Title\n\nText one. Text two! Three?\n\n## Part\n\n* a\n* b\n  1. c\n" * 30, "\x00\x1c\x85﻿ odd", "한국어 텍스트", "aaaa" * 7 + " " + "aaa",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_merges_only_build_on_lower_ranks():
    _, merges, _ = tokens._vocabulary(VOCABULARY)
    made = dict(zip(merges["made"].to_pylist(), merges["rk"].to_pylist()))
    assert len(made) == merges.num_rows
    for pair, rank in zip(merges["pair"].to_pylist(), merges["rk"].to_pylist()):
        assert made.get(pair // 65536, -1) < rank and made.get(pair % 65536, -1) < rank


@pytest.mark.parametrize("slice_bytes", [1, 3_000, 10**9])
def test_ids_equal_the_library(spark, library, slice_bytes):
    rng = random.Random(1)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "'", "9", "12", ".", "--", "é", "价", "\U0001f600", " ", "'ll", "re"]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    data = [(i, t, "clash") for i, t in enumerate(texts)] + [(7, texts[7], "again"), (None, "no id", "")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string").repartition(3)
    got = [(r.doc_id, list(r.ids)) for r in tokens.encode_documents(docs, slice_bytes=slice_bytes).collect()]
    want = [(i, library(t or "")) for i, t, _ in data]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_unbroken_words_equal_the_library(library):
    import pyarrow as pa

    rng = random.Random(8)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(5_000)), "qx" * 3_000]
    _, _, _, first, ids, counts = tokens.encoded(pa.array(texts), tokens.WordEncoder(VOCABULARY))
    assert ids.tolist() == [i for t in texts for i in library(t)] and len(first) == 4 and counts.sum() == len(ids)


def test_ids_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.encode_documents(docs).dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    assert tokens.encode_documents(docs).count() == 0


def test_known_words_are_exact_after_forgetting(monkeypatch):
    import pyarrow as pa

    both = [tokens.KnownWords(tokens.LibraryEncoder(VOCABULARY)), tokens.WordEncoder(VOCABULARY)]
    for limit in (10**9, 1):
        monkeypatch.setattr(tokens, "KNOWN_BYTES", limit)
        for words in (["a", " the", "xyzzy"], ["xyzzy", " newer", "a", "ha" * 50]):
            arrays = [e.encode(pa.array([w.encode() for w in words], pa.large_binary())) for e in both]
            assert [list(x) for x in arrays[0]] == [list(x) for x in arrays[1]]


# Problem 3


@pytest.mark.parametrize("seed", range(3))
def test_nearest_against_brute_force(spark, seed):
    rng = random.Random(seed)
    left = [(i, rng.choice(["A|x", " a|X ", "b", None]), rng.choice([None, *[rng.randrange(0, 3_000) for _ in range(9)]])) for i in range(150)]
    right = [(rng.choice([i, i % 7]), rng.choice(["a|x", "A|X", "B ", None]), rng.choice([None, *[rng.randrange(0, 3_000) for _ in range(9)]])) for i in range(60)]
    left.append(left[0])
    l = spark.createDataFrame(left, "observation_id long, key string, at long").withColumn("_t", F.lit(1))
    r = spark.createDataFrame(right, "book_id long, key string, at long").withColumn("_t", F.lit("x"))
    pairs = nearest.nearest_pairs(
        l, r, left_id="observation_id", left_key=nearest.entity_name(F.col("key")), left_ms=F.col("at"), right_id="book_id", right_key=nearest.entity_name(F.col("key")), right_ms=F.col("at"),
        tolerance_ms=40, chunk_ms=500,
    )
    want = []
    for i, k, t in left:
        if k is not None and t is not None:
            near = [(abs(t - rt), rt, b) for b, rk, rt in right if rk is not None and rt is not None and rk.strip().lower() == k.strip().lower() and abs(t - rt) <= 40]
            if near:
                want.append((i, min(near)[2], min(near)[0]))
    assert sorted(map(tuple, pairs.collect())) == sorted(want)


def test_nearest_boundaries(spark):
    l = spark.createDataFrame([(1, "k", 100), (2, "k", 105), (3, "k", 5_110), (4, "k", 5_111)], "i long, k string, at long")
    r = spark.createDataFrame([(9, "k", 100), (8, "k", 110), (7, "k", 110)], "b long, k string, at long")
    how = {"left_id": "i", "left_key": F.col("k"), "left_ms": F.col("at"), "right_id": "b", "right_key": F.col("k"), "right_ms": F.col("at")}
    assert sorted(map(tuple, nearest.nearest_pairs(l, r, **how).collect())) == [(1, 9, 0), (2, 9, 5), (3, 7, 5_000)]
    assert nearest.nearest_pairs(l, r.where("false"), **how).count() == 0


# Problem 9


def test_permutation_is_one():
    import numpy as np

    for size in (1, 2, 3, 17, 64, 1000):
        for key in (0, 1, 2**47):
            assert sorted(mixing.permuted(np.arange(size), size, key)) == list(range(size))


def test_quotas():
    q = mixing.quotas({"a": 1.0, "b": 3.0, "gone": 2.0, "zero": 0.0}, {"a": 100, "b": 100, "zero": 50}, {"a": 4, "b": 2, "gone": 9, "zero": 9})
    assert q == {"a": 66, "b": 200}
    assert mixing.quotas({"x": 1.0}, {}, {"x": 1}) == {}


def test_slots_hold_the_quota_exactly():
    for full, shorts in ((0, [3]), (4, []), (3, [5, 7]), (1, [1])):
        sizes = [8] * full + shorts
        for quota in range(1, 3 * sum(sizes)):
            slots, last = mixing.slots_of(quota, 8, full, shorts)
            taken = [sizes[i % len(sizes)] for i in range(slots)]  # full ones first within the round that isn't whole
            assert sum(taken[:-1]) + (taken[-1] if last < 0 else last) == quota and last <= taken[-1] and last != 0


def test_mix_invariants(spark, library):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "42"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 80))), rng.choice(["big", "Big ", "big", "small", None])) for i in range(300)] + [(900, None, "small"), (901, "", "big")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("ids", F.lit("clash")).repartition(3)
    targets = spark.createDataFrame(
        [("m", "SMALL", 3.0, 3), ("m", "big", 1.0, 3), ("m", "absent", 1.0, 9), ("n", "big", 1.0, 1), ("none", "absent", 1.0, 1), (None, "big", 1.0, 1), ("m", None, 5.0, 1)],
        "mix_name string, source string, target_weight double, max_repeats int",
    )
    blocks = {(r.source, r.block_no): list(r.ids) for r in mixing.stored_blocks(df, block_tokens=16).collect()}
    for source in ("big", "small"):
        numbers = sorted(n for s, n in blocks if s == source)
        assert numbers == list(range(len(numbers)))
        want = sorted(i for _, t, s in docs if s and s.strip().lower() == source and t for i in library(t))
        assert sorted(i for (s, _), ids in blocks.items() if s == source for i in ids) == want
    out = mixing.mix_sources(df, targets, block_tokens=16, shard_blocks=8).collect()
    n = {s: sum(x == s for x, _ in blocks) for s in ("big", "small")}
    tokens = {s: sum(len(ids) for x, ids in blocks.items() if x[0] == s) for s in ("big", "small")}
    m = [r for r in out if r.mix_name == "m"]
    assert sum(r.source == "small" for r in m) == 3 * n["small"] and all(r.n_tokens == len(r.ids) for r in out)
    assert sum(r.n_tokens for r in m if r.source == "small") == 3 * tokens["small"] and sum(r.n_tokens for r in m if r.source == "big") == tokens["small"]
    assert len([r for r in out if r.mix_name == "n"]) == n["big"] and {r.mix_name for r in out} == {"m", "n"}
    assert len({(r.mix_name, r.shard, r.slot) for r in out}) == len(out)
    uses = {}
    for r in m:
        uses[r.source, r.block_no] = uses.get((r.source, r.block_no), 0) + 1
    assert all(c == 3 for (s, _), c in uses.items() if s == "small")
    assert len({(r.source, r.round, r.block_no) for r in m}) == len(m)
    again = mixing.mix_sources(df.repartition(7), targets, block_tokens=16, shard_blocks=8).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))
    shares = {(r.mix_name, r.source): r for r in mixing.mix_shares(df, targets, block_tokens=16).collect()}
    assert shares["m", "absent"].n_tokens == 0 and shares["m", "small"].share == pytest.approx(0.75, abs=1e-3) and shares["m", "small"].most_repeats == 3
    assert mixing.mix_sources(df.where("false"), targets).count() == 0 and mixing.mix_sources(df, targets.where("false")).count() == 0


# Problem 10


@pytest.mark.parametrize("limit,overlap", [(5, 0), (8, 3), (16, 4), (64, 8), (64, 99)])
def test_pieces_round_trip(spark, library, limit, overlap):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choices(["word", " ", ". ", "\n", "\n\n", "# h", "- ", "ha" * 40, "价格", "。", "\U0001f600", "  ", "7" * 30], k=rng.randrange(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("policy_name", F.lit("clash")).repartition(2)
    policies = spark.createDataFrame([("p", limit, overlap), ("off", None, 1), ("zero", 0, 0)], "policy_name string, max_tokens int, overlap_tokens int")
    got = {}
    for r in pieces.split_documents(docs, policies, slice_bytes=20_000).collect():
        assert r.policy_name == "p"
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == {i for i, t in enumerate(texts) if t and len(library(t)) > limit}
    real = overlap if overlap < limit else limit // 2
    for i, parts in got.items():
        parts.sort(key=lambda r: r.piece_no)
        joined = ""
        for no, r in enumerate(parts):
            assert r.piece_no == no and r.n_tokens == len(library(r.text)) and r.n_tokens <= limit and r.overlap_tokens <= real
            shared = r.text[: r.overlap_chars]
            assert joined.endswith(shared) and len(library(shared)) == r.overlap_tokens
            joined += r.text[r.overlap_chars :]
        assert joined == texts[i]


def test_pieces_follow_the_structure(spark):
    text = "# One\n\nshort text here.\n\n# Two\n\n" + "- item words here\n" * 4 + "\n# Three\n\nend."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    policies = spark.createDataFrame([("p", 24, 0)], "policy_name string, max_tokens int, overlap_tokens int")
    parts = [r.text for r in pieces.split_documents(docs, policies).orderBy("piece_no").collect()]
    assert "".join(parts) == text and parts[0].startswith("# One") and all(p.lstrip().startswith("#") or p.startswith("-") for p in parts)
    assert pieces.split_documents(docs.where("false"), policies).count() == 0 and pieces.split_documents(docs, policies.where("false")).count() == 0


def test_outline_knows_fences_tables_tags_brackets_and_lists():
    text = b"# A\nintro\n```sh\n# restart the collector\nrun\n```\n## B\n| a | b |\n| 1 | 2 |\n<log>\nx\n# C in no fence\n- one\n  - two\n    more\n- three\ncall(\n  1,\n)\nend"
    lines = text.split(b"\n")
    at = dict(zip(lines, pieces.outline(lines)))
    heading = pieces.HEADING
    assert at[b"# A"] == (0, heading) and at[b"## B"] == (1, heading) and at[b"# C in no fence"] == (0, heading)
    assert at[b"# restart the collector"] == (2, pieces.LINE) and at[b"run"] == (2, pieces.LINE) and at[b"```sh"] == (1, pieces.LINE)
    assert at[b"| a | b |"] == (2, pieces.LINE) and at[b"| 1 | 2 |"] == (3, pieces.LINE)
    assert at[b"<log>"] == (2, pieces.LINE) and at[b"x"] == (3, pieces.LINE)
    assert at[b"- one"] == (1, pieces.LIST_ITEM) and at[b"  - two"] == (2, pieces.LIST_ITEM) and at[b"    more"] == (3, pieces.LINE) and at[b"- three"] == (1, pieces.LIST_ITEM)
    assert at[b"  1,"] == (2, pieces.LINE) and at[b"end"] == (1, pieces.LINE)


@pytest.mark.parametrize("seed", range(30))
def test_pack_merges_bottom_up(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 40)
    keys, sizes, limit = [rng.randrange(4) for _ in range(n)], [0], rng.randrange(3, 30)
    for _ in range(n):
        sizes.append(sizes[-1] + rng.randrange(1, 9))

    def brute(low, high):  # the same tree, from the top
        if sizes[high] - sizes[low] <= limit or high - low == 1:
            return [(low, high)]
        top = max(keys[low + 1 : high])
        cuts = [low, *[i for i in range(low + 1, high) if keys[i] == top], high]
        out, room = [], False
        for a, b in zip(cuts, cuts[1:]):
            whole = sizes[b] - sizes[a] <= limit
            if whole and room and sizes[b] - sizes[out[-1][0]] <= limit:
                out[-1] = (out[-1][0], b)
            else:
                out += brute(a, b)
            room = whole
        return out

    got = pieces.pack(sizes, keys, limit)
    assert got == brute(0, n) and [x for run in got for x in range(*run)] == list(range(n))


def test_fenced_comments_are_no_boundaries_of_sections(spark):
    code = "```sh\n# restart the collector\nsystemctl restart collector\n# wait for it\nsleep 5\n```\n"
    text = "intro words here\n\n" + code + "\nlast words here\n"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    policies = spark.createDataFrame([("p", 30, 0)], "policy_name string, max_tokens int, overlap_tokens int")
    parts = [(r.text, r.boundary) for r in pieces.split_documents(docs, policies).orderBy("piece_no").collect()]
    assert "".join(t for t, _ in parts) == text and any(code.strip() in t for t, _ in parts) and pieces.HEADING not in [b for _, b in parts]


def test_shares_are_the_targets_at_any_split(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randrange(1, 300))), rng.choice(["a", "a", "a", "b", "c"])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("m", "a", 0.2, 1), ("m", "b", 0.35, 2), ("m", "c", 0.45, 2)], "mix_name string, source string, target_weight double, max_repeats int")
    for parts in (2, 9):
        got = {r.source: r for r in mixing.mix_shares(df.repartition(parts), targets, block_tokens=64, docs_per_shard=50).collect()}
        assert all(abs(r.share - r.target_share) <= 0.001 * r.target_share for r in got.values()) and max(r.most_repeats for r in got.values()) == 2
