"""Time-series operators against brute force, at their boundaries and in any order of rows."""

import datetime as dt
import random
import sys
import time

import pytest
from pyspark.sql import functions as F

from tidegrid.functions import book as B
from tidegrid.functions import exact
from tidegrid.functions.clock import ceil_grid, coerce_ms
from tidegrid.operators import asof, bars, coverage, evidence, orderbook, research
from tidegrid.sources import normalize, segments
from tidegrid.streaming import operators as streams


def test_asof_boundaries_and_chunks(spark):
    rng = random.Random(2)
    right = [(k, rng.randrange(0, 50_000), i) for i, k in enumerate(["a", "b", None] * 40)]
    left = [(k, rng.randrange(0, 60_000)) for k in ["a", "b", "c", None] * 30] + [("a", None), ("a", right[0][1]), ("a", right[0][1] + 500), ("a", right[0][1] + 501)]
    l = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(left)], "k string, at long, n long")
    r = spark.createDataFrame([(k, t, i, None if i % 5 == 0 else i) for k, t, i in right], "k string, t long, s long, v long").orderBy(F.rand(1))
    for tolerance in (None, 500):
        got = {x.n: (x.matched_ms, x.s, x.v) for x in asof.asof_join(l, r, left_ms=F.col("at"), right_ms=F.col("t"), on=["k"], right_cols=["s", "v"], seq=["s"], tolerance_ms=tolerance, chunk_ms=3_000).collect()}
        assert len(got) == len(left)
        for n, (k, at) in enumerate(left):
            past = [(t, s) for kk, t, s in right if kk == k and k is not None and at is not None and t <= at and (tolerance is None or at - t <= tolerance)]
            assert got[n] == ((*max(past), None if max(past)[1] % 5 == 0 else max(past)[1]) if past else (None, None, None))
    with pytest.raises(ValueError):
        asof.asof_join(l, r, left_ms=F.col("at"), right_ms=F.col("t"), on=["k"], right_cols=["k"])


def test_ceil_grid_is_right_closed(spark):
    df = spark.createDataFrame([(t,) for t in (-1, 0, 1, 99, 100, 101)], "t long")
    assert [r[0] for r in df.select(ceil_grid(F.col("t"), 0, 100)).collect()] == [0, 0, 100, 100, 100, 200]


def test_flow_window_is_open_below_closed_above(spark):
    t = spark.createDataFrame([("k", 900, 1, 1.0), ("k", 901, -1, 2.0), ("k", 1000, None, 4.0), ("k", 1001, 1, 8.0)], "key string, t long, sign int, q double")
    how = {"time_ms": F.col("t"), "sign": F.col("sign"), "quantity": "q"}
    r = bars.flow_at(t, 1000, keys=["key"], window_ms=100, **how).first()
    assert (r.buy_volume, r.sell_volume, r.trade_count, r.last_ms, r.age_ms) == (0.0, 2.0, 2, 1000, 0)
    points = spark.createDataFrame([("k", p) for p in (0, 900, 1000, 1100)], "key string, at_ms long")
    for r in bars.flow_many(t, points, [1, 100, 10_000], key="key", **how).collect():
        inside = [x for x in t.collect() if r.at_ms - r.window_ms < x.t <= r.at_ms]
        assert (r.buy_volume, r.sell_volume, r.trade_count) == (sum(x.q for x in inside if x.sign == 1), sum(x.q for x in inside if x.sign == -1), len(inside))


@pytest.mark.parametrize("seed", range(3))
def test_coverage_against_brute_force(spark, seed):
    rng = random.Random(seed)
    obs = [(k, rng.randrange(-50, 400)) for k in "ab" for _ in range(rng.randrange(0, 12))] + [("a", None)]
    w = spark.createDataFrame([(k, 0, 300) for k in "abc"], "k string, window_start_ms long, window_end_ms long")
    o = spark.createDataFrame(obs, "k string, t long")
    gaps = coverage.coverage_gaps(o, w, key="k", time_ms=F.col("t"), tolerance_ms=20, chunk_ms=50).collect()
    for k in "abc":
        covered = {m for kk, t in obs if kk == k and t is not None for m in range(t, t + 20)}
        open_ms = [m for m in range(300) if m not in covered]
        mine = sorted((g.start_ms, g.end_ms) for g in gaps if g.k == k)
        assert [m for a, b in mine for m in range(a, b)] == open_ms
        kinds = {g.kind for g in gaps if g.k == k}
        evidence_there = any(kk == k and t is not None and -20 < t < 300 for kk, t in obs)
        assert ("ABSENT" in kinds) == (not evidence_there)
    report = {r.k: r for r in coverage.coverage_report(o, w, key="k", time_ms=F.col("t"), tolerance_ms=20).collect()}
    assert report["c"].status == "ABSENT" and report["c"].missing_ms == 300


def test_alignment_expects_every_customer(spark, tmp_path):
    from tidegrid.plans import reference

    day = lambda n: dt.datetime(2024, 1, n)
    events = [(1, 7, day(15), "view", 1.0), (2, 500, day(3), "view", 1.0), (3, 900, day(20), "view", 1.0), (4, 7, day(2), "view", 1.0)]
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    spark.createDataFrame([(k,) for k in (7, 500, 900, 15_000)], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = {r.user_id: (r.event_id, r.status) for r in reference.QUERIES["alignment_status_expected_keys"](spark, str(tmp_path)).collect()}
    assert got == {7: (1, "AVAILABLE"), 500: (2, "STALE"), 900: (None, "NEVER_OBSERVED"), 15_000: (None, "NEVER_OBSERVED")}


def test_coverage_spans_every_day(spark, tmp_path):
    from tidegrid.plans import reference

    data = [(1, 4, dt.datetime(2024, 1, 1), "view", 1.0), (2, 4, dt.datetime(2024, 1, 20), "view", 1.0)]
    spark.createDataFrame(data, "event_id long, user_id long, ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    gaps = reference.QUERIES["coverage_gaps"](spark, str(tmp_path)).collect()
    assert sorted((g.kind, g.duration_ms) for g in gaps) == [("INTERIOR", 19 * reference.DAY - 1_800_000), ("TRAILING", 11 * reference.DAY - 1_800_000)]
    r = reference.QUERIES["coverage_report"](spark, str(tmp_path)).first()
    assert (r.covered_ms, r.gap_count, r.observation_count) == (3_600_000, 2, 2)


def test_labels_purge_and_split(spark):
    g = spark.createDataFrame([(i * 100, 100.0 + i) for i in range(40)], "ts long, mid double")
    out = research.forward_labels(g, time="ts", price="mid", grid_ms=100, horizons_s=(1, 2)).collect()
    assert len(out) == 20 and all(r.direction_2s == 1 for r in out)
    with pytest.raises(ValueError):
        research.forward_labels(g, time="ts", price="mid", grid_ms=300, horizons_s=(1,))
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(20)]
    m = research.split_manifest(days, horizon_s=300, embargo_days=1)
    assert (len(m["train"]), len(m["val"]), len(m["test"])) == (12, 1, 3) and m["leakage_safe"]
    assert not research.split_manifest(days[:3])["leakage_safe"]


def test_exact_numbers(spark):
    df = spark.createDataFrame([("1.10",), (" 2 ",), ("NaN",), ("1e3",), ("",), (None,), ("abc",), ("007",)], "s string")
    got = [None if r[0] is None else float(r[0]) for r in df.select(exact.dec(F.col("s"))).collect()]
    assert got == [1.1, 2.0, None, 1000.0, None, None, None, 7.0]
    assert [r[0] for r in df.select(exact.lossless_long(F.col("s"))).collect()][-1] is None
    t = spark.createDataFrame([("1700000000000",), ("1.9",), ("2024-01-01T00:00:00Z",), ("x",), (None,)], "s string")
    assert [r[0] for r in t.select(coerce_ms(F.col("s"))).collect()] == [1_700_000_000_000, 1, 1_704_067_200_000, None, None]


def test_book_reasons_and_features(spark):
    books = [([2.0, 1.0], [1.0, 1.0], [3.0], [1.0]), ([], [], [3.0], [1.0]), ([3.0], [1.0], [3.0], [1.0]), ([1.0, 2.0], [1.0, 1.0], [3.0], [1.0]), ([2.0], [0.0], [3.0], [1.0]), ([2.0], [1.0, 1.0], [3.0], [1.0]), (None, None, None, None)]
    df = spark.createDataFrame(books, "a array<double>, b array<double>, c array<double>, d array<double>").coalesce(1)
    cols = [F.col(x) for x in "abcd"]
    assert [r[0] for r in df.select(B.untrusted_reason(*cols)).collect()] == [None, "empty_side", "crossed_or_locked", "bids_not_descending", "non_positive_level", "malformed_levels", "empty_side"]
    f = B.features(*cols)
    first = df.select(f["mid_price"].alias("m"), f["obi_level_3"].alias("o"), f["bid_depth"].alias("d")).collect()
    assert (first[0].m, first[0].o, first[0].d) == (2.5, None, 2) and first[1].m is None and first[6].m is None


def test_first_wins_and_digest_ignore_order(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), rng.randrange(5), i) for i in range(60)]
    a = spark.createDataFrame(data, "k string, t long, i long")
    b = spark.createDataFrame(rng.sample(data, len(data)), "k string, t long, i long")
    pick = lambda df: sorted(r.i for r in evidence.first_wins(df, identity=["k"], order=["t", "i"]).collect())
    want = sorted([min((t, i) for k, t, i in data if k == x)[1] for x in "ab"] + [i for k, _, i in data if k is None])
    assert pick(a) == pick(b) == want
    dig = lambda df: evidence.set_digest(df, by=["k"], key=F.col("t").cast("string")).orderBy("k").collect()
    assert dig(a) == dig(b)


def test_order_is_carried_over_days_and_hours(spark, tmp_path):
    from tidegrid.plans import reference

    at = lambda s: dt.datetime(2024, 1, 1, 23, 59, 50) + dt.timedelta(seconds=s)
    marks = [(1, "k", at(0), at(8)), (2, "k", at(5), at(9)), (3, "k", at(4), at(11)), (4, "k", at(4), at(12))]  # reading 3 steps back over midnight
    spark.createDataFrame(marks, "reading_id long, instrument_key string, exchange_timestamp timestamp, local_timestamp timestamp").write.parquet(str(tmp_path / "markprice.parquet"))
    got = reference.QUERIES["out_of_order_counts"](spark, str(tmp_path)).first()
    assert (got.n, got.out_of_order, got.repeated) == (4, 1, 1)
    items = [(i, 3_600_000 * h + ms, None, control) for i, (h, ms, control) in enumerate([(2, 5, False), (0, 7, True), (0, 7, False), (1, 0, False), (2, 4, True)])]
    spark.createDataFrame(items, "item_id long, local_receive_ts long, receive_ns long, is_control boolean").write.parquet(str(tmp_path / "ingest_items.parquet"))
    got = {r.source_index: r.place for r in reference.QUERIES["replay_total_order"](spark, str(tmp_path)).collect()}
    assert got == {2: 1, 1: 2, 3: 3, 4: 4, 0: 5}


def _frames():
    f = lambda s, snap, u, first, prev, b, a: ("X", s, snap, u, first, prev, b, a)
    return [
        f(1, False, 105, 100, 99, [["100.0", "1"]], [["101.0", "1"]]), f(2, True, 102, None, None, [["99.0", "2"]], [["102.0", "2"]]), f(3, False, 110, 106, 105, [["100.0", "0"]], []),
        f(4, False, 110, 106, 105, [], []), f(5, False, 120, 115, 112, [], []), f(6, True, 118, None, None, [["98.0", "1"]], [["103.0", "1"]]),
        f(7, False, 121, 121, 120, [["97.0", "1"]], []), f(8, False, 122, 122, 121, [["200.0", "1"]], []), f(9, False, 123, 123, 122, [["x", "1"]], []),
    ]


FRAME = "instrument_key string, seq long, is_snapshot boolean, update_id long, first_id long, prev_id long, bids array<array<string>>, asks array<array<string>>"
WANT = ["buffered", "bridged", "applied", "stale", "sequence_gap", "bridged", "applied", "invalid_book", "buffered"]


def test_book_fold(spark):
    out = orderbook.reconstruct(spark.createDataFrame(_frames(), FRAME).orderBy(F.desc("seq"))).orderBy("seq").collect()
    assert [r.outcome for r in out] == WANT
    assert (out[1].best_bid, out[1].best_ask, out[1].bid_levels) == (100.0, 101.0, 2) and out[2].best_bid == 99.0
    assert out[7].best_bid == 98.0 and out[7].state == "SEQUENCE_GAP"


def test_book_reconstruction_follows_every_ladder(spark, tmp_path):
    from tidegrid.plans import reference

    rng, rows = random.Random(5), []
    for i in range(400):
        key, mid = f"BINANCE|linear_perpetual|C{i % 2}-USDT|C{i % 2}USDT", 100.0 + rng.randrange(-20, 20)
        bids, asks = sorted({mid - rng.randrange(1, 9) for _ in range(4)}, reverse=True), sorted({mid + rng.randrange(1, 9) for _ in range(4)})
        if i % 50 == 30:
            bids, asks = asks, bids  # crossed: the fold must refuse it and recover with the next
        if i % 50 == 40:
            bids = []
        rows.append((i, key, dt.datetime(2024, 1, 1), bids, [float(rng.randrange(1, 9)) for _ in bids], asks, [float(rng.randrange(1, 9)) for _ in asks]))
    rows.append((400, rows[0][1], dt.datetime(2024, 1, 1), [99.0, 99.0, None], [1.0, 0.0, 1.0], [101.0], [1.0]))
    rows.append((402, rows[0][1], dt.datetime(2024, 1, 1), [99.0, 98.0, 98.0], [1.0, 0.0, 2.0], [101.0, 101.0], [1.0, 3.0]))
    rows.append((404, rows[0][1], dt.datetime(2024, 1, 1), [98.0, 97.0], [2.0, 2.0], [101.0], [1.0]))
    schema = "book_id long, instrument_key string, local_timestamp timestamp, bids_price array<double>, bids_qty array<double>, asks_price array<double>, asks_qty array<double>"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "orderbook.parquet"))
    last = {r.seq // 2: r for r in reference.book_reconstruction(spark, str(tmp_path)).orderBy("seq").collect()}
    refused = {n for n, _, _, b, _, a, _ in rows if None in b or (b and a and max(b) >= min(a))}
    assert len(last) == len(rows) and len(refused) == 9
    for n, _, _, bids, _, asks, _ in rows:
        got = last[n]
        if n in refused:
            assert got.state == "SEQUENCE_GAP"
        else:
            assert (got.state, got.best_bid, got.best_ask, got.bid_levels, got.ask_levels) == ("VALID", max(bids, default=None), min(asks), len(set(bids)), len(set(asks)))


VENUES = {"BINANCE|linear_perpetual|A|A": "BINANCE", "BINANCE|spot|A|A": "BINANCE_SPOT", "BYBIT|linear_perpetual|A|A": "BYBIT", "OKX|linear_perpetual|A|A": "OKX"}


def _venue_frames():
    """(key, frame of FRAME without its key, outcome due) by the rules of SURVEY A.1, A.3 and A.4."""
    spot, bybit, okx = [k for k, v in VENUES.items() if v != "BINANCE"]
    b, a = [["99.0", "1"]], [["101.0", "1"]]
    return [
        (spot, (1, False, 100, 98, None, b, a), "buffered"), (spot, (2, False, 102, 101, None, [["99.5", "1"]], []), "buffered"),
        (spot, (3, True, 100, None, None, b, a), "bridged"),  # the diff ending at the snapshot's id adds nothing; 101 follows it
        (spot, (4, False, 105, 103, None, [["99.6", "1"]], []), "applied"), (spot, (5, False, 105, 103, None, [], []), "sequence_gap"),
        (spot, (6, True, 110, None, None, b, a), "snapshot_ahead_of_buffer"), (spot, (7, False, 112, 112, None, [], []), "snapshot_bridge_not_found"),
        (bybit, (1, False, 5, None, None, b, a), "discarded"), (bybit, (2, True, 7, None, None, b, a), "snapshot_applied"),
        (bybit, (3, False, 20, None, None, [["99.5", "1"]], []), "applied"), (bybit, (4, False, 20, None, None, [], []), "stale"),
        (bybit, (5, False, 1, None, None, [], []), "resync"), (bybit, (6, False, 21, None, None, [], []), "discarded"), (bybit, (7, True, 1, None, None, b, a), "snapshot_applied"),
        (bybit, (8, False, None, None, None, [], []), "update_id_missing"),
        (okx, (1, False, 5, None, 4, b, a), "missing_snapshot"), (okx, (2, True, 7, None, -1, b, a), "snapshot_applied"), (okx, (3, False, 9, None, 7, [["99.5", "1"]], []), "applied"),
        (okx, (4, False, 9, None, 9, [], []), "applied"), (okx, (5, False, 12, None, 11, [], []), "sequence_gap"), (okx, (6, False, 13, None, 9, [], []), "discarded"),
        (okx, (7, True, 2, None, -1, b, a), "snapshot_applied"), (okx, (8, False, 3, None, 2, [["101.0", "1"]], []), "invalid_book"),
    ]


def test_book_fold_of_each_venue(spark, tmp_path):
    due = {(k, f[0]): want for k, f, want in _venue_frames()}
    frames = spark.createDataFrame([(k, *f) for k, f, _ in _venue_frames()], FRAME)
    out = orderbook.reconstruct(frames.orderBy(F.rand(3))).collect()
    assert {(r.instrument_key, r.seq): r.outcome for r in out} == due
    best = {(r.instrument_key.split("|")[0], r.seq): (r.state, r.best_bid) for r in out}
    assert best["BINANCE", 3] == ("VALID", 99.5) and best["BYBIT", 3] == ("VALID", 99.5) and best["BYBIT", 5] == ("RECOVERING", 99.5) and best["OKX", 7] == ("VALID", 99.0)
    frames.coalesce(1).write.parquet(str(tmp_path / "frames"))
    got = _run_stream(spark, streams.books(spark.readStream.schema(FRAME).parquet(str(tmp_path / "frames"))), str(tmp_path / "c"), name="venue_books").collect()
    assert {(r.instrument_key, r.seq): r.outcome for r in got} == due


def test_ladders_are_followed_by_the_rules_of_each_venue(spark):
    rng, rows = random.Random(6), []
    for i in range(240):
        mid = 100.0 + rng.randrange(-20, 20)
        bids, asks = [mid - 1, mid - 2], [mid + 1, mid + 3]
        rows.append((i, list(VENUES)[i % 4], *((asks, [1.0, 1.0], bids) if i in range(100, 110) else (bids, [1.0, 2.0], asks)), [1.0, 3.0]))
    ladders = spark.createDataFrame(rows, "seq long, instrument_key string, bids_price array<double>, bids_qty array<double>, asks_price array<double>, asks_qty array<double>")
    frames = orderbook.frames_of_ladders(ladders)
    assert [orderbook.venue_of(k) for k in VENUES] == list(VENUES.values())
    last = {r.seq // 2: r for r in orderbook.reconstruct(frames).orderBy("seq").collect()}
    for n, _, bids, _, asks, _ in rows:
        got = (last[n].state, last[n].best_bid, last[n].best_ask, last[n].bid_levels)
        assert got[0] == "SEQUENCE_GAP" if n in range(100, 110) else got == ("VALID", bids[0], asks[0], 2)


def _run_stream(spark, df, path, mode="append", name="out"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", path).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streaming_twins(spark, tmp_path):
    src = tmp_path / "frames"
    for i, part in enumerate((_frames()[:4], _frames()[4:])):
        spark.createDataFrame(part, FRAME).coalesce(1).write.mode("append").parquet(str(src))
        time.sleep(1.1 * (i == 0))
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).parquet(str(src))
    got = _run_stream(spark, streams.books(stream), str(tmp_path / "c1"), name="books_out").orderBy("seq").collect()
    assert [r.outcome for r in got] == WANT
    ids = _run_stream(spark, streams.exact_dedup(stream.select("update_id"), ["update_id"]), str(tmp_path / "c2"), name="ids_out")
    assert sorted(r[0] for r in ids.collect()) == sorted({f[3] for f in _frames()})
    out, table = str(tmp_path / "admitted"), str(tmp_path / "ids")
    q = streams.admit_by_batch(stream.select("seq", "update_id"), table=table, out=out, checkpoint=str(tmp_path / "c3"), identity=F.col("update_id").cast("string"), order=["seq"]).trigger(availableNow=True).start()
    q.awaitTermination(120)
    admitted = spark.read.parquet(out).select("seq", "update_id").collect()
    assert len(admitted) == len({r.update_id for r in admitted}) == len({f[3] for f in _frames()})


def test_normalisers(spark):
    payloads = ['{"stream":"x@aggTrade","data":{"e":"aggTrade","E":1,"T":1,"a":7,"p":"65000.0","q":"0.5","m":false}}', '{"topic":"publicTrade.X","ts":1,"data":[{"i":"b1","T":1,"p":"1.0","v":"0.2","S":"Buy"},{"i":"b2","T":2,"p":"2.0","v":"0.3","S":"Sell"}]}',
                '{"lastUpdateId":102,"bids":[["100.0","5.0"]],"asks":[["101.0","5.0"]]}', '{"e":"depthUpdate","U":1,"u":2,"pu":0,"b":[["1","2"]],"a":[]}', "{broken", None, '{"a":1}']
    df = spark.createDataFrame(list(enumerate(payloads)), "frame_id long, payload string")
    t = sorted((r.frame_id, r.pos, r.trade_id, float(r.price), r.side) for r in normalize.trades(df).collect())
    assert t == [(0, 0, "7", 65000.0, "BUY"), (1, 0, "b1", 1.0, "BUY"), (1, 1, "b2", 2.0, "SELL")]
    assert sorted((r.frame_id, r.is_snapshot, r.update_id) for r in normalize.depth(df).collect()) == [(2, True, 102), (3, False, 2)]
    assert {r.reason: r.frames for r in normalize.rejects(df).collect()} == {"undecodable": 2, "unsupported": 1}


def test_normalisers_of_every_channel(spark):
    okx = lambda channel, *data: '{"arg":{"channel":"%s","instId":"B"},"data":[%s]}' % (channel, ",".join(data))
    payloads = [
        '{"topic":"orderbook.50.B","type":"snapshot","ts":10,"data":{"s":"B","b":[["1.5","2"]],"a":[["3","4"]],"u":7,"seq":1}}',
        '{"topic":"orderbook.50.B","type":"delta","ts":11,"data":{"s":"B","b":[["1.5","0"]],"a":[],"u":9,"seq":2}}',
        okx("books", '{"bids":[["1","2","0","1"]],"asks":[],"ts":"12","seqId":5,"prevSeqId":-1}', '{"bids":[],"asks":[["3","1","0","1"]],"ts":"13","seqId":6,"prevSeqId":5}'),
        '{"stream":"b@markPrice@1s","data":{"e":"markPriceUpdate","E":14,"s":"B","p":"100.5","i":"100.4","r":"0.0001","T":99}}',
        okx("mark-price", '{"markPx":"101","ts":"15"}'), okx("index-tickers", '{"idxPx":"102","ts":"16"}'),
        okx("funding-rate", '{"fundingRate":"0.0002","nextFundingRate":"","fundingTime":"50","nextFundingTime":"60","ts":"17"}'),
        '{"topic":"tickers.B","type":"delta","ts":18,"data":{"markPrice":"103","openInterest":"7"}}', '{"topic":"tickers.B","type":"delta","ts":19,"data":{"bid1Price":"1"}}',
        okx("open-interest", '{"oi":"8","oiCcy":"0.8","oiUsd":"9","ts":"20"}'),
        '{"e":"forceOrder","E":21,"o":{"s":"B","S":"SELL","p":"90","q":"1","T":20}}', '{"topic":"allLiquidation.B","ts":23,"data":[{"T":22,"s":"B","S":"Buy","v":"2","p":"91"},{"s":"B","S":"Sell","v":"3","p":"92"}]}',
        okx("liquidation-orders", '{"instId":"B","details":[{"side":"sell","bkPx":"93","sz":"4","ts":"24"},{"side":"buy","bkPx":"94","sz":"5","ts":"25"}]}'),
        okx("books5", '{"bids":[]}'), okx("candle1m", "[]"), "pong",
    ]
    df = spark.createDataFrame(list(enumerate(payloads)), "frame_id long, payload string")
    num = lambda x: None if x is None else float(x)
    got = sorted((r.frame_id, r.is_snapshot, r.update_id, r.prev_id, r.bids, r.asks, r.exchange_ms) for r in normalize.depth(df).collect())
    assert got == [(0, True, 7, None, [["1.5", "2"]], [["3", "4"]], 10), (1, False, 9, None, [["1.5", "0"]], [], 11), (2, False, 6, 5, [], [["3", "1"]], 13), (2, True, 5, -1, [["1", "2"]], [], 12)]
    got = sorted((r.frame_id, num(r.mark_price), num(r.index_price), num(r.funding_rate), r.next_funding_ms, r.funding_ms, num(r.next_funding_rate), r.exchange_ms) for r in normalize.marks(df).collect())
    assert got == [(3, 100.5, 100.4, 0.0001, 99, None, None, 14), (4, 101.0, None, None, None, None, None, 15), (5, None, 102.0, None, None, None, None, 16), (6, None, None, 0.0002, 60, 50, None, 17), (7, 103.0, None, None, None, None, None, 18)]
    assert sorted((r.frame_id, num(r.open_interest), r.unit, num(r.in_currency), r.exchange_ms) for r in normalize.open_interest(df).collect()) == [(7, 7.0, "UNKNOWN", None, 18), (9, 8.0, "CONTRACTS", 0.8, 20)]
    got = sorted((r.frame_id, r.pos, r.part, r.side, num(r.price), num(r.quantity), r.exchange_ms) for r in normalize.liquidations(df).collect())
    assert got == [(10, 0, 0, "SELL", 90.0, 1.0, 20), (11, 0, 0, "BUY", 91.0, 2.0, 22), (11, 1, 0, "SELL", 92.0, 3.0, 23), (12, 0, 0, "SELL", 93.0, 4.0, 24), (12, 0, 1, "BUY", 94.0, 5.0, 25)]
    assert {r.reason: r.frames for r in normalize.rejects(df).collect()} == {"book": 1, "unsupported": 1, "undecodable": 1}


def test_segments_on_storage(spark, tmp_path):
    root = tmp_path / "raw" / "trades"
    root.mkdir(parents=True)
    for name in ("2024-01-01-00-000001.seg", "2024-01-01-00.parquet", "2024-01-01-01.parquet", "2024-01-01-02-000001.seg.tmp", "2024-01-01-03-000001.seg", "2024-01-01-03-000001.seg.meta.json"):
        (root / name).write_bytes(b"x")
    got = {r.path.rsplit("/", 1)[1]: r.trust for r in segments.catalog(spark, f"file://{tmp_path}/raw").collect()}
    assert got == {"2024-01-01-00-000001.seg": "AMBIGUOUS", "2024-01-01-00.parquet": "AMBIGUOUS", "2024-01-01-01.parquet": "LEGACY", "2024-01-01-02-000001.seg.tmp": "INVALID", "2024-01-01-03-000001.seg": "MARKED"}
    e = segments.parse_names(segments.list_files(spark, f"file://{tmp_path}/raw").withColumn("stream", F.lit("trades")), "path")
    assert segments.resolve(e, on_collision="prefer_segments").count() == 3 and segments.resolve(e, on_collision="prefer_legacy").count() == 3
    with pytest.raises(Exception):
        segments.resolve(e).select("path").collect()
    assert segments.missing_hours(e.where("kind is not null")).count() == 21
    assert segments.byte_digests(spark, f"file://{tmp_path}/raw").count() == 2
    assert segments.list_files(spark, f"file://{tmp_path}/absent").count() == 0


def test_rest_imports_without_llm():
    import __spark_entry__ as entry

    hidden = {m: sys.modules.pop(m) for m in list(sys.modules) if m.startswith("tidegrid.llm")}
    sys.modules["tidegrid.llm"] = None
    try:
        assert "p1_found" in entry.queries() and not any(q.startswith(("p3_", "p8_", "p9_", "p10_")) for q in entry.queries())
    finally:
        del sys.modules["tidegrid.llm"]
        sys.modules.update(hidden)
