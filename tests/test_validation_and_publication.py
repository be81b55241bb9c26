"""Row validity, sequence rules, stream preparation, markers and generations, against brute force and at their edges."""

import random

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import assembly, asof, evidence, research, validation
from tidegrid.sources import publication, segments


def test_monotone_verdicts_move_by_accepted_rows_only(spark):
    rng = random.Random(1)
    for allow_equal in (False, True):
        data = [(i, rng.choice(["a", None]), rng.choice([None, -1, *range(1, 30)]), rng.choice([None, 0, 5, 9_000]), rng.choice([1.0, 1.0, 1.0, 0.0, float("nan"), None])) for i in range(300)]
        df = spark.createDataFrame(data, "n long, k string, t long, e long, p double").repartition(3)
        out = validation.monotone_verdicts(
            df, key="k", time=F.col("t"), exchange=F.col("e"), rules=[("Invalid price", validation.positive(F.col("p")))], order=["n"], chunk=F.floor(F.col("n") / 17), allow_equal=allow_equal
        )
        got = {r.n: (r.reason, r.drift_ms) for r in out.collect()}
        last = {}
        for n, k, t, e, p in data:
            before, why = last.get(k), None
            if t is None or t <= 0:
                why = "Invalid timestamp"
            elif e is not None and e <= 0:
                why = "Invalid exchange timestamp"
            elif before is not None and (t < before or t == before and not allow_equal):
                why = "Timestamp regression"
            elif p is None or p != p or p <= 0:
                why = "Invalid price"
            else:
                last[k] = t
            drift = abs(e - t) if why not in ("Invalid timestamp", "Invalid exchange timestamp") and e is not None and abs(e - t) > 5_000 else None
            assert got[n] == (why, drift)


def test_trades_are_folded_with_time_and_id_together(spark):
    rows = [
        ("a", 1, 10, 5, None, 1.0, 1.0, 7), ("a", 2, 11, 9, None, 1.0, 1.0, 7), ("a", 3, 12, 6, None, 1.0, 1.0, 8), ("a", 4, 13, 6, 0, 1.0, 1.0, 9), ("a", 5, 14, 5, None, 1.0, 1.0, 9),
        ("a", 6, 15, 6, None, 0.0, 1.0, 9), ("a", 7, 16, 6, None, 1.0, float("inf"), 9), ("a", 8, 17, 6, None, 1.0, 1.0, None), (None, 1, 18, None, None, 1.0, 1.0, 1), ("b", 1, 19, 1, None, 1.0, 1.0, 1),
    ]
    t = spark.createDataFrame(rows, "key string, seq long, row_id long, time_ms long, exchange_ms long, price double, quantity double, trade_id long").orderBy(F.rand(2))
    got = {r.row_id: r.reason for r in validation.trade_verdicts(t).collect()}
    # row 11 is refused for its id, so its later time doesn't count against row 12
    assert got == {
        10: None, 11: "Duplicate/Regressive trade_id", 12: None, 13: "Invalid exchange timestamp", 14: "Timestamp regression", 15: "Invalid price", 16: "Invalid quantity",
        17: "Duplicate/Regressive trade_id", 18: "Invalid timestamp", 19: None,
    }


def test_continuity_of_each_venue(spark):
    cases = [
        ("BINANCE", 5, None, 4, None, "continue", None), ("BINANCE", 5, None, 4, 4, "continue", None), ("BINANCE", 3, None, 4, 4, "stale", "stale_update"), ("BINANCE", 4, None, 4, 4, "stale", "duplicate_update"),
        ("BINANCE", 6, None, 5, 4, "gap", "pu_mismatch"), ("BINANCE", 6, None, None, 4, "gap", "pu_missing"), ("BINANCE", None, None, 4, 4, "gap", "update_id_missing"),
        ("BINANCE_SPOT", 8, 5, None, 4, "continue", None), ("BINANCE_SPOT", 4, 4, None, 4, "gap", "u_chain_broken"), ("BINANCE_SPOT", 8, None, None, 4, "gap", "update_id_missing"),
        ("BYBIT", 9, None, None, 4, "continue", None), ("BYBIT", 4, None, None, 4, "stale", "duplicate_update"), ("BYBIT", 1, None, None, 4, "resync", "update_id_decrease_or_reset"),
        ("OKX", 9, None, -1, 4, "continue", None), ("OKX", 9, None, 4, 4, "continue", None), ("OKX", 9, None, 3, 4, "gap", "prev_seq_id_mismatch"), ("OKX", 9, None, 3, None, "gap", "missing_snapshot"),
    ]
    df = spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(cases)], "i int, venue string, u long, f long, p long, b long")
    v = validation.continuity(*[F.col(c) for c in ("venue", "u", "f", "p", "b")])
    got = {r.i: (r.v.verdict, r.v.reason) for r in df.select("i", v.alias("v")).collect()}
    assert got == {i: c[5:] for i, c in enumerate(cases)}


def test_streams_are_prepared_and_losses_counted(spark):
    df = spark.createDataFrame([(1, 10, "X", 1.0), (2, None, "X", 2.0), (3, 30, "Y", 3.0), (4, 40, None, 4.0)], "timestamp long, local_timestamp long, instrument_key string, price double")
    p = assembly.prepare_stream(df, "t", instrument="X")
    assert sorted((r.t_process_ts, r.t_ts, r.t_time_unknown) for r in assembly.usable(p, "t").collect()) == [(1, 10, False), (4, 40, False)]
    assert {r.loss: r.n for r in assembly.losses(p, "t").collect()} == {"no_time": 1, "other_instrument": 1}
    assert "instrument_key" not in p.columns and assembly.prepare_stream(df.drop("local_timestamp"), "t", instrument="X").first().t_time_unknown
    place = spark.createDataFrame([(t,) for t in (-1, 0, 90, 91, 95, 99, 100, None)], "t long").select(assembly.day_place(F.col("t"), 0, 100, 30).alias("p"))
    assert [r.p for r in place.collect()] == ["before", "inside", "inside", "trailing", "trailing", "trailing", "after", None]
    with pytest.raises(Exception, match="after the allowed end"):
        assembly.end_boundary(df, "timestamp", 3).select("price").collect()
    assert assembly.end_boundary(df, "timestamp", 4).count() == 4
    oi = spark.createDataFrame([("CONTRACTS", "OKX"), ("CONTRACTS", "OKX")], "unit string, exchange string")
    assert assembly.comparable_unit(oi).count() == 2
    with pytest.raises(Exception, match="unlike units"):
        assembly.comparable_unit(oi.union(oi.select(F.lit("BASE_COIN"), "exchange"))).collect()


def test_liquidation_bars_drop_like_rows(spark):
    rows = [(5, 1, 2.0, 1.0), (5, 1, 2.0, 1.0), (5, 1, 2.0, None), (6, -1, 3.0, 2.0), (11, -1, 3.0, 2.0), (99, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "t long, side int, p double, q double")
    out = assembly.liquidation_bars(df, time_ms=F.col("t"), side=F.col("side"), price="p", quantity="q", grid_ms=10, start_ms=0, end_ms=50, identity=["t", "side", "p", "q"])
    got = {r.grid_ts: r for r in out.collect()}
    assert set(got) == {10, 20} and (got[10].liquidation_count, got[10].liquidation_buy_volume, got[10].liquidation_net_volume, got[10].liquidation_notional, got[10].liquidation_dup_dropped) == (3, 1.0, -1.0, 8.0, 1)


def test_markers_are_read_as_they_were_written(spark):
    seg = spark.createDataFrame([("a.seg", 3, 1, 9, "0" * 64, 77), ("b.seg", 0, None, None, "f" * 64, 0)], "segment string, record_count long, first_ts long, last_ts long, sha256 string, size_bytes long")
    made = publication.markers(seg, confirmed_at="2025-01-01T00:00:00Z")
    assert {r.segment: (r.status, r.problems) for r in publication.marker_status(made).collect()} == {"a.seg": ("VALID", []), "b.seg": ("VALID", [])}
    good = made.where("segment = 'a.seg'").first().content
    broken = [
        ("absent", None, "ABSENT", []), ("old", '{"record_count":1}', "ABSENT", []), ("text", "{", "INVALID", ["not valid JSON"]), ("list", "[1]", "INVALID", ["top level is not a JSON object"]),
        ("kind", '{"publication":3}', "INVALID", ["publication is not an object"]), ("other", good, "INVALID", ["segment name does not match"]),
        ("a.seg", good.replace('"schema":2', '"schema":"2"').replace('"legacy":false', '"legacy":0').replace('"record_count":3', '"record_count":-1').replace("writer\"", "me\"", 1), "INVALID",
         ["schema != 2", "confirmed_by not allowed", "legacy not a bool", "record_count invalid"]),
        ("a.seg", good.replace('"size_bytes":77', '"size_bytes":true').replace("0" * 64, "0" * 63).replace('"first_record_ts":1', '"first_record_ts":1.5'), "INVALID", ["size_bytes invalid", "sha256 invalid", "first_record_ts invalid"]),
    ]
    df = spark.createDataFrame([b[:2] for b in broken], "segment string, content string").coalesce(1)
    assert [(r.status, r.problems) for r in publication.marker_status(df).collect()] == [b[2:] for b in broken]
    disk = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "segment string, size_bytes long, sha256 string")
    claim = spark.createDataFrame([("a", 1, "x"), ("b", 9, "y"), ("d", 3, "z")], "segment string, size_bytes long, sha256 string")
    assert {r.segment: r.verdict for r in publication.byte_verdicts(disk, claim).collect()} == {"a": "VERIFIED", "b": "SIZE_MISMATCH", "c": "UNCLAIMED", "d": "MISSING"}


def test_generations_are_named_by_content(spark, tmp_path):
    train = spark.createDataFrame([(1, 2.0), (2, None), (2, None)], "t long, return_60s double")
    parts = {"train": train, "test": train.where("t = 1")}
    out = f"file://{tmp_path}/splits"
    name = publication.publish_generation(spark, out, parts, {"gap": 2})
    assert len(name) == 16 and publication.publish_generation(spark, out, {n: d.repartition(3) for n, d in parts.items()}, {"gap": 2}) == name
    assert publication.content_id(parts | {"test": train.where("t = 2")})[0] != name and publication.content_id(parts | {"train": train.distinct()})[0] != name
    train.limit(1).write.mode("overwrite").parquet(f"{out}/generations/{name}/train")
    with pytest.raises(RuntimeError):
        publication.publish_generation(spark, out, parts, {"gap": 2})
    assert publication.label_horizon(train.schema) == 60 and publication.label_horizon(train.drop("return_60s").schema) == 0


def test_hours_are_accepted_or_say_why(spark):
    rows = [(1, 10, "X", 1), (1, 20, "X", 2), (2, 10, "X", 1), (2, 10, "X", 2), (3, None, "X", 1), (4, 5, "Y", 1)]
    df = spark.createDataFrame(rows, "hour int, t long, key string, id long")
    how = {"by": ["hour"], "time_ms": F.col("t"), "instrument": F.col("key"), "expected": "X"}
    assert {r.hour: r.problems for r in publication.accept_hours(df, **how).collect()} == {1: [], 2: ["repeated_time"], 3: ["null_time"], 4: ["other_instrument"]}
    assert {r.hour: r.problems for r in publication.accept_hours(df, id_col="id", **how).collect()}[2] == []
    r = spark.createDataFrame([("s", "a", 0, 10), ("s", "b", 10, 20), ("s", "c", 15, 18)], "stream string, name string, min_ms long, max_ms long")
    assert sorted(x.name for x in publication.overlaps(r, by=["stream"]).collect()) == ["b", "c"]
    assert [x.name for x in publication.overlaps(r, by=["stream"], shared_end=True).collect()] == ["c"]


def test_two_representations_are_an_error_whatever_is_read(spark):
    e = spark.createDataFrame([(1, "s", "2024-01-01-00-000001.seg"), (2, "s", "2024-01-01-00.parquet")], "file_id long, stream string, path string")
    both = segments.resolve(segments.parse_names(e, "path"))
    for read in (lambda: both.select("file_id").collect(), both.count):
        with pytest.raises(Exception, match="two representations"):
            read()


@pytest.mark.parametrize("leaf,fan", [(3, 2), (7, 3), (4096, 256)])
def test_digest_trees_ignore_order_and_see_every_key(spark, leaf, fan):
    keys = [(g, f"k{i}") for g in ("a", None) for i in range(60)]
    of = lambda rows: {r.g: (r.n_keys, r.digest) for r in evidence.set_digest(spark.createDataFrame(rows, "g string, k string"), by=["g"], key=F.col("k"), leaf=leaf, fan=fan).collect()}
    whole = of(keys)
    assert whole == of(keys[::-1] + keys[:9]) and whole["a"][0] == 60 and set(whole) == {"a", None}
    less = of([k for k in keys if k != ("a", "k7")])
    assert less["a"] != whole["a"] and less[None] == whole[None]
    assert of([("a", None)]) == {}


def test_column_stats_against_brute_force(spark):
    import numpy as np

    rng = random.Random(3)
    data = [(rng.choice([None, float("nan"), *[rng.gauss(0, 1) for _ in range(6)]]), rng.choice([1, 1, 1, 2, None]), None) for _ in range(400)]
    df = spark.createDataFrame(data, "x double, y int, z double")
    for size in (50, 10_000):
        got = {r.column_name: r for r in research.column_stats(df, ["x", "y", "z"], values_per_part=size).collect()}
        for i, c in enumerate("xy"):
            v = np.array([r[i] for r in data if r[i] is not None and r[i] == r[i]], float)
            assert (got[c]["count"], got[c].null_count, got[c].min, got[c].max) == (len(v), 400 - len(v), v.min(), v.max())
            assert got[c].p01 == pytest.approx(np.percentile(v, 1)) and got[c].p99 == pytest.approx(np.percentile(v, 99)) and got[c].std == pytest.approx(v.std(ddof=1))
        assert (got["z"]["count"], got["z"].null_count, got["z"].p01) == (0, 400, None)


def test_several_sides_in_one_join(spark):
    rng = random.Random(4)
    sides = [[(rng.choice(["a", "b"]), rng.randrange(0, 400), i) for i in range(40)] for _ in range(3)]
    left = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(0, 400)]), i) for i in range(80)]
    l = spark.createDataFrame(left, "k string, at long, n long")
    right = [asof.Side(spark.createDataFrame(s, f"k string, t long, v{i} long"), F.col("t"), [f"v{i}"], f"t{i}", [f"v{i}"], tolerance) for (i, s), tolerance in zip(enumerate(sides), (None, 30, 0))]
    got = {r.n: r for r in asof.asof_joins(l, right, left_ms=F.col("at"), on=["k"], chunk_ms=50).collect()}
    assert len(got) == 80
    for k, at, n in left:
        for i, (s, tolerance) in enumerate(zip(sides, (None, 30, 0))):
            past = [(t, v) for kk, t, v in s if kk == k and at is not None and t <= at and (tolerance is None or at - t <= tolerance)]
            assert (got[n][f"t{i}"], got[n][f"v{i}"]) == (max(past) if past else (None, None))


def test_scratch_is_shared_and_goes(spark):
    from tidegrid import session

    df = session.materialize(spark.range(5), "t")
    assert df.count() == 5
    session.release_scratch(spark)
    fs, path = session.hadoop_fs(spark, session.shared_dir(spark))
    assert not fs.exists(path(session.shared_dir(spark) + "/tidegrid"))
