"""Tickers with state, accounting of unhandled frames, polled bodies, stamping, and the replay of recorded frames."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import exact
from tidegrid.operators import neighbours, replay
from tidegrid.sources import normalize


def test_last_values_are_carried_over_chunks(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", None]), i, rng.choice([None, None, rng.randrange(9)])) for i in range(200)]
    df = spark.createDataFrame(data, "k string, n long, v long").withColumn("c", F.floor(F.col("n") / 7)).where("k is not null").repartition(3)
    got = {r.n: r.last for r in neighbours.with_carried(df, ["k"], "c", ["n"], {"last": F.col("v")}).collect()}
    last = None
    for k, n, v in data:
        if k is not None:
            last = v if v is not None else last
            assert got[n] == last


def _ticker(kind, ts, **data):
    return json.dumps({"topic": "tickers.B", "type": kind, "ts": ts, "data": data})


def test_tickers_carry_what_earlier_ones_said(spark):
    frames = [
        _ticker("snapshot", 10, markPrice="1", indexPrice="2", openInterest="7"), _ticker("delta", 20, indexPrice="3"), _ticker("delta", 30, bid1Price="9"), _ticker("delta", 25, openInterest="8"),
        _ticker("snapshot", 40, fundingRate="0.1"), _ticker("delta", 50, markPrice="5"), '{"topic":"orderbook.1.B"}',
    ]
    df = spark.createDataFrame(list(enumerate(frames)), "frame_id long, payload string").repartition(3)
    num = lambda x: None if x is None else float(x)
    got = {(r.frame_id, r.kind): (num(r.mark_price), num(r.index_price), num(r.funding_rate), num(r.open_interest), sorted(r.carried_forward), dict(r.field_age_ms)) for r in normalize.tickers(df).collect()}
    assert got == {
        (0, "markprice"): (1.0, 2.0, None, None, [], {"markPrice": 0, "indexPrice": 0}), (0, "openinterest"): (None, None, None, 7.0, [], {"openInterest": 0}),
        (1, "markprice"): (1.0, 3.0, None, None, ["markPrice"], {"markPrice": 10, "indexPrice": 0}), (3, "openinterest"): (None, None, None, 8.0, [], {"openInterest": 0}),
        (4, "markprice"): (None, None, 0.1, None, [], {"fundingRate": 0}), (5, "markprice"): (5.0, None, 0.1, None, ["fundingRate"], {"markPrice": 0, "fundingRate": 10}),
    }


def test_every_unhandled_frame_has_a_reason(spark):
    cases = [
        ("pong", "malformed_payload"), (None, "malformed_payload"), ('{"op":"subscribe","success":true}', "control_frame"), ('{"event":"error","code":"1"}', "control_frame"), ('{"result":null,"id":3}', "control_frame"),
        ('{"topic":"allLiquidation.B","data":[]}', "empty_data"), ('{"arg":{"channel":"books5"},"data":[{}]}', "channel_not_implemented"), ('{"x":1}', "no_route"),
        ('{"e":"depthUpdate","u":1}', None), ('{"topic":"publicTrade.B","data":[{"i":"1","p":"1","v":"1","S":"Buy","T":1}]}', None),
    ]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(cases)], "frame_id long, payload string")
    assert {r.frame_id: r.reason for r in normalize.unhandled(df).collect()} == {i: why for i, (_, why) in enumerate(cases) if why}
    kinds = ['{"event":"subscribe"}', '{"event":"channel-conn-count"}', '{"event":"new"}', '{"arg":{},"data":[1]}', "{}", "x", None]
    got = spark.createDataFrame([(k,) for k in kinds], "p string").coalesce(1).select(normalize.okx_envelope(F.col("p")).alias("k")).collect()
    assert [r.k for r in got] == ["subscribe_ack", "conn_count", "unknown", "data_push", "unknown", "unknown", "unknown"]


def test_polled_open_interest_says_what_is_wrong(spark):
    cases = [
        ('{"openInterest":"10.5","symbol":"B","time":7}', None), ('{"openInterest":"10.5"}', None), ("x", "invalid_json"), ("[1]", "not_an_object"), ("{}", "no_open_interest"), ('{"openInterest":"abc"}', "not_a_number"),
        ('{"openInterest":"0"}', "not_positive"), ('{"openInterest":"1","symbol":"C"}', "symbol_contradicts"), ('{"openInterest":"1","time":"soon"}', None), (None, "invalid_json"),
    ]
    df = spark.createDataFrame([(p,) for p, _ in cases], "p string").coalesce(1)
    got = [r.b for r in df.select(normalize.open_interest_body(F.col("p"), F.lit("B")).alias("b")).collect()]
    assert [b.reason for b in got] == [why for _, why in cases] and (float(got[0].open_interest), got[0].exchange_ms) == (10.5, 7) and got[8].exchange_ms is None and got[6].open_interest is None


def test_instruments_are_stamped_and_contradictions_fail(spark):
    known = spark.createDataFrame([("OKX", "B", "OKX|p|B-U|B")], "venue string, native string, instrument_key string")
    e = spark.createDataFrame([("OKX", "B", None), ("OKX", "B", "OKX|p|B-U|B"), ("OKX", "C", None), (None, None, "x")], "venue string, native string, instrument_key string")
    assert sorted(str(r.instrument_key) for r in normalize.stamp_instruments(e, known).collect()) == ["None", "OKX|p|B-U|B", "OKX|p|B-U|B", "x"]
    assert normalize.stamp_instruments(e.drop("instrument_key"), known).where("instrument_key is not null").count() == 2
    with pytest.raises(Exception, match="contradicts"):
        normalize.stamp_instruments(e.union(known.select("venue", "native", F.lit("other"))), known).select("venue").collect()


def test_recorded_frames_are_replayed_in_total_order(spark):
    book = lambda kind, u, bids: json.dumps({"topic": "orderbook.50.B", "type": kind, "ts": 1, "data": {"s": "B", "b": bids, "a": [["10", "1"]], "u": u}})
    trade = '{"topic":"publicTrade.B","ts":1,"data":[{"i":"t1","T":1,"p":"1.0","v":"0.2","S":"Buy"}]}'
    rows = [
        (30, 0, None, 3, "BYBIT", book("delta", 9, [["9", "2"]]), True), (10, 0, 5, 1, "bybit ", book("snapshot", 7, [["8", "1"]]), True), (10, 1, 1, 2, "BYBIT", trade, True), (5, 0, None, 0, "OKX", trade, True),
        (3_700_000, 0, None, 4, "BYBIT", "broken", False), (3_700_001, 0, None, 5, "BYBIT", '{"op":"pong"}', True), (3_700_002, 0, None, 6, None, trade, True),
    ]
    log = spark.createDataFrame(rows, "ts_ms long, kind_rank int, ns long, source_index long, venue string, payload string, decode_ok boolean").withColumn("ns", F.coalesce("ns", F.lit(-1)))
    log = replay.ordered(log.withColumn("instrument_key", F.lit("BYBIT|linear_perpetual|B-U|B")).repartition(3))
    assert {r.source_index: r.place for r in log.collect()} == {0: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: 6, 6: 7}
    out = replay.replay_frames(log, venue="BYBIT")
    assert [(r.seq, r.outcome, r.best_bid) for r in out["books"].orderBy("seq").collect()] == [(2, "snapshot_applied", 8.0), (4, "applied", 9.0)]
    assert {(r.frame_id, r.reason) for r in out["unhandled"].collect()} == {(5, "malformed_payload"), (6, "control_frame")}
    got = {(r.output, r.outcome): r.n for r in replay.counters(out).collect()}
    assert got == {
        ("books", "snapshot_applied"): 1, ("books", "applied"): 1, ("trades", "rows"): 1, ("unhandled", "malformed_payload"): 1, ("unhandled", "control_frame"): 1, ("foreign", "rows"): 2,
    }


def test_identity_keys_are_read_back(spark):
    rng = random.Random(5)
    parts = [["".join(rng.choices("a:1é", k=rng.randrange(0, 5))) for _ in range(rng.randrange(1, 5))] for _ in range(50)]
    keys = ["".join(f"{len(p)}:{p}" for p in x) for x in parts]
    df = spark.createDataFrame([(k,) for k in [*keys, None, "3:ab", "x:ab", "-1:a"]], "k string").coalesce(1)
    assert [r.p for r in df.select(exact.parts_of_key(F.col("k")).alias("p")).collect()] == [*parts, None, None, None, None]


def test_receive_times_have_typed_reasons(spark):
    from tidegrid.functions.clock import receive_time

    name = "INVALID_LOCAL_RECEIVE_TS_"
    cases = [("5", None), ("2024-01-01T00:00:00Z", None), (None, name + "NONE"), ("null", name + "NONE"), ("true", name + "BOOL"), ("abc", name + "NON_INT"), ("", name + "NON_INT"), ("-3", name + "NEGATIVE")]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string").coalesce(1)
    got = [r.x for r in df.select(receive_time(F.col("t")).alias("x")).collect()]
    assert [x.reason for x in got] == [why for _, why in cases] and [x.ms for x in got[:3]] == [5, 1_704_067_200_000, None]


def test_unreadable_files_are_reported(spark, tmp_path):
    import pandas as pd

    from tidegrid.sources import segments

    (tmp_path / "trades").mkdir()
    pd.DataFrame({"timestamp": pd.to_datetime([1_000, None, 3_000], unit="ms", utc=True), "x": [1, 2, 3]}).to_parquet(tmp_path / "trades" / "a.parquet")
    pd.DataFrame({"timestamp": [7, 8]}).to_parquet(tmp_path / "trades" / "b.seg")
    pd.DataFrame({"other": [7]}).to_parquet(tmp_path / "trades" / "c.seg")
    (tmp_path / "trades" / "d.seg").write_bytes(b"no parquet")
    (tmp_path / "trades" / "e.tmp").write_bytes(b"x")
    out = segments.timestamps(spark, f"file://{tmp_path}").collect()
    got = {}
    for r in out:
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.t, r.problem is not None))
    assert got == {"a.parquet": [(1_000, False), (None, False), (3_000, False)], "b.seg": [(7, False), (8, False)], "c.seg": [(None, True)], "d.seg": [(None, True)]}
