"""Queries over the test tables for the time-series operators, each with the SQL DuckDB can run for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.functions import book as B
from tidegrid.functions import exact
from tidegrid.functions.clock import ceil_grid, coerce_ms, epoch_ms, purge_days, receive_time
from tidegrid.operators import assembly, asof, bars, coverage, evidence, orderbook, replay, research, validation
from tidegrid.operators.neighbours import with_adjacent, with_carried
from tidegrid.session import read_table
from tidegrid.sources import normalize, publication, segments

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
HOUR, DAY = 3_600_000, 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01, where the events begin
AT = T0 + 15 * DAY


def case(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return keep


def events(spark, d) -> DataFrame:
    """The events as trades: t (epoch ms), qty, side and sign by type, venue by user."""
    e = read_table(spark, d, "events").withColumn("t", epoch_ms(F.col("ts")))
    side = F.when(F.col("event_type") == "purchase", "BUY").when(F.col("event_type") == "error", "SELL")
    return e.withColumn("qty", (1 + F.col("user_id") % 5).cast("double")).withColumn("venue", F.col("user_id") % 4).withColumn("side", side).withColumn("sign", B.signed_side(F.col("side")))


EV = """e as (select *, epoch_us(ts) // 1000 t, (1 + user_id % 5)::double qty, user_id % 4 venue,
 case event_type when 'purchase' then 'BUY' when 'error' then 'SELL' end side,
 case event_type when 'purchase' then 1 when 'error' then -1 end sgn from events)"""


# As-of joins and the aligned grid


@case(f"""with {EV}, g as (select unnest(range({T0}, {T0 + 30 * DAY}, {HOUR})) grid_ts), v as (select t, event_id, value from e where event_type = 'view')
select grid_ts, case when grid_ts - t <= 600000 then event_id end view_id, case when grid_ts - t <= 600000 then value end view_value,
 coalesce(grid_ts - t > 600000, true) as gap from g asof left join v on g.grid_ts >= v.t""")
def asof_backward_tolerance(spark, d):
    grid = asof.fixed_grid(spark, T0, T0 + 30 * DAY, HOUR)
    views = events(spark, d).where("event_type = 'view'").select("t", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    out = asof.asof_join(grid, views, left_ms=F.col("grid_ts"), right_ms=F.col("t"), right_cols=["view_id", "view_value"], seq=["view_id"], tolerance_ms=600_000)
    return out.select("grid_ts", "view_id", "view_value", F.col("matched_ms").isNull().alias("gap"))


@case(f"""with {EV} select p.event_id, v.event_id view_id, p.t - v.t age_ms from (select * from e where event_type = 'purchase') p
asof left join (select * from e where event_type = 'view') v on p.user_id = v.user_id and p.t >= v.t""")
def asof_by_key(spark, d):
    e = events(spark, d)
    views = e.where("event_type = 'view'").select("user_id", "t", F.col("event_id").alias("view_id"))
    out = asof.asof_join(
        e.where("event_type = 'purchase'").select("event_id", "user_id", F.col("t").alias("at")), views, left_ms=F.col("at"), right_ms=F.col("t"), on=["user_id"],
        right_cols=["view_id"], seq=["view_id"], chunk_ms=DAY,
    )
    return out.select("event_id", "view_id", (F.col("at") - F.col("matched_ms")).alias("age_ms"))


BARS = f"""bar as (select ((t - {T0}) + {HOUR} - 1) // {HOUR} * {HOUR} + {T0} grid_ts, count(event_id) trade_count,
 coalesce(sum(case when sgn = 1 then qty end), 0) buy_volume, coalesce(sum(case when sgn = -1 then qty end), 0) sell_volume,
 sum(case when sgn is not null then qty * value end) qp, arg_max(value, (t, event_id)) last_price from e where event_type in ('purchase', 'error', 'click') group by 1)"""


def _bars(spark, d):
    trades = events(spark, d).where("event_type in ('purchase', 'error', 'click')")
    return bars.trade_bars(trades, time_ms=F.col("t"), sign=F.col("sign"), price="value", quantity="qty", id_col="event_id", grid_ms=HOUR, start_ms=T0)


@case(f"""with {EV}, {BARS} select grid_ts, trade_count, buy_volume, sell_volume, buy_volume - sell_volume as net_volume,
 round(qp / nullif(buy_volume + sell_volume, 0), 7) as vwap,
 round(case when buy_volume + sell_volume > 0 then (buy_volume - sell_volume) / (buy_volume + sell_volume) else 0 end, 7) as imbalance, last_price from bar""")
def grid_trade_bars(spark, d):
    return _bars(spark, d).withColumn("vwap", F.round("vwap", 7)).withColumn("imbalance", F.round("imbalance", 7))


OBSERVED = f"""obs as (select distinct t from e where event_type in ('purchase', 'error', 'click')),
seen as (select t, lead(t) over (order by t) nx, lag(t) over (order by t) pv from obs),
gap as (select t + 900000 a, coalesce(nx, {T0 + 30 * DAY}) b from seen where t + 900000 < coalesce(nx, {T0 + 30 * DAY})
 union all select {T0}, t from seen where pv is null and t > {T0})"""


@case(f"""with {EV}, {BARS}, {OBSERVED}, g as (select unnest(range({T0}, {T0 + 30 * DAY}, {HOUR})) grid_ts),
v as (select t, value from e where event_type = 'view'), c as (select t, value from e where event_type = 'signup'),
m as (select grid_ts, case when grid_ts - v.t <= 1800000 then v.value end mark, coalesce(grid_ts - v.t > 1800000, true) mark_gap from g asof left join v on grid_ts >= v.t),
k as (select m.*, case when grid_ts - c.t <= 7200000 then c.value end interest, coalesce(grid_ts - c.t > 7200000, true) interest_gap from m asof left join c on grid_ts >= c.t)
select k.grid_ts, mark, mark_gap, interest, interest_gap, coalesce(mark > 50, false) as spike_flag, coalesce(trade_count, 0) as trade_count,
 coalesce(buy_volume, 0) as buy_volume, coalesce(sell_volume, 0) as sell_volume, round(qp / nullif(buy_volume + sell_volume, 0), 7) as vwap, last_price,
 not exists (select 1 from gap where a <= k.grid_ts and b > k.grid_ts - {HOUR} + 1) as bin_observed
from k left join bar on k.grid_ts = bar.grid_ts""")
def aligned_dataset_day(spark, d):
    """The assembled dataset in one plan: a grid, two as-of joins with staleness, bars, flags and evidence."""
    e = events(spark, d)
    of = lambda kind, name: e.where(F.col("event_type") == kind).select("t", "event_id", F.col("value").alias(name))
    sides = [
        asof.Side(of("view", "mark"), F.col("t"), ["mark"], "mark_ms", ["event_id"], 1_800_000),
        asof.Side(of("signup", "interest"), F.col("t"), ["interest"], "interest_ms", ["event_id"], 7_200_000),
        asof.Side(_evidence_gaps(e), F.col("start_ms"), ["end_ms"], "gap_ms"),
    ]
    out = asof.asof_joins(asof.fixed_grid(spark, T0, T0 + 30 * DAY, HOUR), sides, left_ms=F.col("grid_ts"), chunk_ms=DAY)
    out = out.withColumn("bin_observed", asof.unmet(F.col("end_ms"), F.col("grid_ts"), HOUR)).withColumn("spike_flag", F.coalesce(F.col("mark") > 50, F.lit(False)))
    for name in ("mark", "interest"):
        out = out.withColumn(f"{name}_gap", F.col(f"{name}_ms").isNull()).drop(f"{name}_ms")
    out = out.join(_bars(spark, d).drop("net_volume", "imbalance"), "grid_ts", "left").drop("end_ms", "gap_ms")
    for c in ("trade_count", "buy_volume", "sell_volume"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out.withColumn("vwap", F.round("vwap", 7))


def _evidence_gaps(e):
    trades = e.where("event_type in ('purchase', 'error', 'click')")
    return coverage.coverage_gaps(trades, (T0, T0 + 30 * DAY), time_ms=F.col("t"), tolerance_ms=900_000, chunk_ms=DAY)


@case(f"""with {EV}, {OBSERVED}, g as (select unnest(range({T0}, {T0 + 30 * DAY}, 1800000)) grid_ts)
select grid_ts, not exists (select 1 from gap where a <= grid_ts and b > grid_ts - 1800000 + 1) as observed from g""")
def bin_observed(spark, d):
    return asof.bins_observed(asof.fixed_grid(spark, T0, T0 + 30 * DAY, 1_800_000), _evidence_gaps(events(spark, d)), bin_end="grid_ts", grid_ms=1_800_000)


@case("""select book_id, coalesce(spread > 1.0, false) as spread_spike_flag,
 coalesce(epoch_ms(local_timestamp) - epoch_ms(exchange_timestamp) > 500, true) as stale from orderbook""")
def spread_gap_flags(spark, d):
    age = epoch_ms(F.col("local_timestamp")) - epoch_ms(F.col("exchange_timestamp"))
    return read_table(spark, d, "orderbook").select(
        "book_id", F.coalesce(F.col("spread") > 1.0, F.lit(False)).alias("spread_spike_flag"), F.coalesce(age > 500, F.lit(True)).alias("stale")
    )


@case("""select book_id, round(case when obi is not null and not isnan(obi) then atanh(greatest(least(obi, 0.9999), -0.9999)) end, 7) as obi_fisher from orderbook""")
def fisher_transform(spark, d):
    return read_table(spark, d, "orderbook").select("book_id", F.round(B.fisher(F.col("obi")), 7).alias("obi_fisher"))


# Coverage

WINDOWS = "w as (select distinct user_id % 4 as venue from events)"
def _cover(start: int, length: int) -> str:
    return f"""{EV}, {WINDOWS}, o as (select distinct venue, t from e where t > {start} - 1800000 and t < {start + length}),
s as (select venue, t, lead(t) over (partition by venue order by t) nx, lag(t) over (partition by venue order by t) pv from o),
gap as (select venue, t + 1800000 start_ms, coalesce(nx, {start + length}) end_ms, case when nx is null then 'TRAILING' else 'INTERIOR' end kind
  from s where t + 1800000 < coalesce(nx, {start + length})
 union all select venue, {start}, t, 'LEADING' from s where pv is null and t > {start}
 union all select venue, {start}, {start + length}, 'ABSENT' from w where venue not in (select venue from o))"""


def _windows(e, start, length):
    return e.select("venue").distinct().select("venue", F.lit(start).cast("long").alias("window_start_ms"), F.lit(start + length).cast("long").alias("window_end_ms"))


@case(f"with {_cover(T0, 30 * DAY)} select venue, start_ms, end_ms, end_ms - start_ms as duration_ms, kind from gap")
def coverage_gaps(spark, d):
    """Gaps of every venue over all days of the events."""
    e = events(spark, d)
    return coverage.coverage_gaps(e, _windows(e, T0, 30 * DAY), key="venue", time_ms=F.col("t"), tolerance_ms=1_800_000)


def _report(start: int, length: int) -> str:
    return f"""with {_cover(start, length)}, l as (select venue, sum(end_ms - start_ms) m, count(*) n, max(end_ms - start_ms) x, sum(case kind when 'LEADING' then end_ms - start_ms else 0 end) a,
 sum(case kind when 'INTERIOR' then end_ms - start_ms else 0 end) b, sum(case kind when 'TRAILING' then end_ms - start_ms else 0 end) c from gap group by 1),
k as (select venue, count(distinct t) oc, count(*) - count(distinct t) dc, min(t) f, max(t) z from e where t >= {start} and t < {start + length} group by 1)
select w.venue, {length} - coalesce(m, 0) as covered_ms, coalesce(m, 0) as missing_ms, ({length} - coalesce(m, 0)) * 100.0::double / {length} as coverage_pct,
 case when coalesce(m, 0) = 0 then 'COMPLETE' when m = {length} then 'ABSENT' else 'PARTIAL' end as status, coalesce(n, 0) as gap_count, coalesce(x, 0) as longest_gap_ms,
 coalesce(a, 0) as leading_ms, coalesce(b, 0) as interior_ms, coalesce(c, 0) as trailing_ms, coalesce(oc, 0) as observation_count, coalesce(dc, 0) as duplicate_count, f as first_ms, z as last_ms
from w left join l using (venue) left join k using (venue)"""


@case(_report(T0, 30 * DAY))
def coverage_report(spark, d):
    e = events(spark, d)
    return coverage.coverage_report(e, _windows(e, T0, 30 * DAY), key="venue", time_ms=F.col("t"), tolerance_ms=1_800_000)


@case("""with o as (select instrument_key, reading_id, epoch_ms(exchange_timestamp) t, epoch_ms(local_timestamp) // 86400000 c from markprice where instrument_key is not null and local_timestamp is not null),
l as (select *, lag(t) over (partition by instrument_key order by c, reading_id) p from o where t is not null)
select instrument_key, count(*) as n, count(*) filter (where t < p) as out_of_order, count(*) filter (where t = p) as repeated from l group by 1""")
def out_of_order_counts(spark, d):
    """Readings that step back against the one before; the last reading of a day is carried to the next."""
    m = read_table(spark, d, "markprice").where("instrument_key is not null and local_timestamp is not null")
    rows = m.select("instrument_key", "reading_id", epoch_ms(F.col("exchange_timestamp")).alias("t"), F.floor(epoch_ms(F.col("local_timestamp")) / DAY).alias("c")).where("t is not null")
    return with_adjacent(rows, ["instrument_key"], "c", ["reading_id"], "t", prev="p").groupBy("instrument_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("t") < F.col("p")).alias("out_of_order"), F.count_if(F.col("t") == F.col("p")).alias("repeated")
    )


# Labels, splits, statistics, checks

GRID = f"""g as (select unnest(range({T0}, {T0 + 30 * DAY}, 60000)) ts),
p as (select g.ts, v.value mid from g asof left join (select epoch_us(ts) // 1000 t, value from events where event_type = 'view') v on g.ts >= v.t)"""


def _minute_grid(spark, d):
    grid = asof.fixed_grid(spark, T0, T0 + 30 * DAY, 60_000, "ts")
    views = events(spark, d).where("event_type = 'view'").select("t", "event_id", F.col("value").alias("mid"))
    return asof.asof_join(grid, views, left_ms=F.col("ts"), right_ms=F.col("t"), right_cols=["mid"], seq=["event_id"]).drop("matched_ms")


@case(f"""with {GRID}, r as (select p.ts, p.mid, (a.mid - p.mid) / nullif(p.mid, 0) ra, (b.mid - p.mid) / nullif(p.mid, 0) rb
 from p left join p a on a.ts = p.ts + 60000 left join p b on b.ts = p.ts + 300000)
select ts, mid, round(ra, 7) as return_60s, round(rb, 7) as return_300s, (case when ra > 5e-5 then 1 when ra < -5e-5 then -1 else 0 end)::tinyint as direction_60s,
 (case when rb > 5e-5 then 1 when rb < -5e-5 then -1 else 0 end)::tinyint as direction_300s from r where ra is not null and rb is not null""")
def forward_return_labels(spark, d):
    out = research.forward_labels(_minute_grid(spark, d), time="ts", price="mid", grid_ms=60_000, horizons_s=(60, 300))
    return out.withColumn("return_60s", F.round("return_60s", 7)).withColumn("return_300s", F.round("return_300s", 7))


@case("""with t as (select instrument_key, epoch_ms(local_timestamp) // 30000 * 30000 s from markprice where instrument_key is not null and local_timestamp is not null),
o as (select instrument_key, s, count(*) n from t group by all), l as (select *, s - lag(s) over (partition by instrument_key order by s) dd from o),
m as (select instrument_key, dd, row_number() over (partition by instrument_key order by count(*) desc, dd) r from l where dd is not null group by instrument_key, dd)
select l.instrument_key, sum(n) as n_rows, count(*) filter (where l.dd <> 30000) as irregular_steps, any_value(m.dd) as step_ms, sum(n - 1) as duplicate_times
from l left join m on m.instrument_key = l.instrument_key and r = 1 group by 1""")
def grid_regularity(spark, d):
    m = read_table(spark, d, "markprice").where("instrument_key is not null").withColumn("s", (F.floor(epoch_ms(F.col("local_timestamp")) / 30_000) * 30_000).cast("long"))
    return research.grid_report(m, time="s", grid_ms=30_000, on=["instrument_key"])


@case("""with d as (select distinct ts::date dt from events), r as (select dt, row_number() over (order by dt) - 1 i, count(*) over () n from d),
c as (select *, floor(n * 0.70)::int a, floor(n * 0.85)::int b from r)
select strftime(dt, '%Y-%m-%d') as date, case when i < greatest(a - 2, 0) then 'train' when i >= a and i < greatest(b - 2, a) then 'val' when i >= b then 'test' else 'purged' end as part from c""")
def chrono_split_manifest(spark, d):
    days = sorted(r[0] for r in read_table(spark, d, "events").select(F.to_date("ts").alias("x")).distinct().collect())  # one row a day
    m = research.split_manifest(days, horizon_s=300, embargo_days=1)
    part = {x: p for p in ("train", "val", "test") for x in m[p]}
    return spark.createDataFrame([(str(x), part.get(x, "purged")) for x in days], "date string, part string")


@case("""with s as (select instrument_key, window_ms::double as window_ms, trade_count::double as trade_count, cvd, buy_volume, sell_volume from windowed_trade_flow),
u as (unpivot s on window_ms, trade_count, cvd, buy_volume, sell_volume into name column_name value v),
k as (select column_name, case when isnan(v) then null else v end v from u), n as (select count(*) rows from windowed_trade_flow)
select column_name, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, min(v) as min, max(v) as max, round(quantile_cont(v, 0.01), 6) as p01, round(quantile_cont(v, 0.99), 6) as p99,
 count(v) as count, any_value(rows) - count(v) as null_count from k, n group by column_name""")
def column_stats_long(spark, d):
    out = research.column_stats(read_table(spark, d, "windowed_trade_flow"), ["window_ms", "trade_count", "cvd", "buy_volume", "sell_volume"])
    return out.select("column_name", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", "max", *[F.round(c, 6).alias(c) for c in ("p01", "p99")], "count", "null_count")


@case("""select book_id, case when not coalesce(best_bid > 0 and isfinite(best_bid), false) then 'best_bid' when not coalesce(best_ask > 0 and isfinite(best_ask), false) then 'best_ask'
 when not coalesce(best_ask > best_bid, false) then 'crossed' when not coalesce(total_bid_qty > 0 and total_ask_qty > 0, false) then 'empty_side'
 when not coalesce(obi between -1 and 1, false) then 'obi' end as reason from orderbook""")
def validate_rows_reason(spark, d):
    finite = lambda c: (F.col(c) > 0) & (F.col(c) < float("inf")) & ~F.isnan(c)
    reason = research.validity_reason(
        ("best_bid", finite("best_bid")), ("best_ask", finite("best_ask")), ("crossed", F.col("best_ask") > F.col("best_bid")),
        ("empty_side", (F.col("total_bid_qty") > 0) & (F.col("total_ask_qty") > 0)), ("obi", F.col("obi").between(-1, 1)),
    )
    return read_table(spark, d, "orderbook").select("book_id", reason.alias("reason"))


@case("""with r as (select epoch_ms(local_timestamp) // 60000 * 60000 m, not coalesce(best_ask > best_bid, false) bad from orderbook where local_timestamp is not null)
select m as minute_ms, count(*) as n, count(*) filter (where bad) as failures, count(*) filter (where bad) > 0.001 * count(*) as alarm from r group by 1""")
def failure_rate_window(spark, d):
    bad = ~F.coalesce(F.col("best_ask") > F.col("best_bid"), F.lit(False))
    rows = read_table(spark, d, "orderbook").where("local_timestamp is not null").select((F.floor(epoch_ms(F.col("local_timestamp")) / 60_000) * 60_000).cast("long").alias("minute_ms"), bad.alias("bad"))
    return rows.groupBy("minute_ms").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("failures")).withColumn("alarm", F.col("failures") > 0.001 * F.col("n"))


@case("""select venue, local_receive_ts // 60000 * 60000 as minute_ms, count(*) as n from ingest_items where local_receive_ts is not null group by all""")
def messages_per_minute(spark, d):
    rows = read_table(spark, d, "ingest_items").where("local_receive_ts is not null")
    return rows.groupBy("venue", (F.floor(F.col("local_receive_ts") / 60_000) * 60_000).cast("long").alias("minute_ms")).agg(F.count(F.lit(1)).alias("n"))


GAPROWS = """with o as (select instrument_key k, reading_id i, epoch_ms(exchange_timestamp) t, epoch_ms(local_timestamp) // 3600000 c from markprice
 where instrument_key is not null and exchange_timestamp is not null and local_timestamp is not null)"""


@case(GAPROWS + """, g as (select k, i, t, t - max(t) over (partition by k order by c, i rows between unbounded preceding and 1 preceding) gap from o)
select k as instrument_key, i as reading_id, t, gap as gap_ms from g where gap > 60000""")
def gap_detector(spark, d):
    m = read_table(spark, d, "markprice").where("local_timestamp is not null")
    return research.gaps_since_last(
        m, key="instrument_key", time_ms=epoch_ms(F.col("exchange_timestamp")), order=["reading_id"], threshold_ms=60_000, chunk=F.floor(epoch_ms(F.col("local_timestamp")) / HOUR)
    )


# Snapshots and flow

LATEST = f"""n as (select user_id, arg_max(event_id, (t, event_id)) event_id, max(t) last_ms from e where t <= {AT} group by 1)"""


@case(f"with {EV}, {LATEST} select user_id, event_id, last_ms, {AT} - last_ms as age_ms, case when {AT} - last_ms <= {DAY} then 'AVAILABLE' else 'STALE' end as status from n")
def latest_per_key_at_t(spark, d):
    return asof.latest_per_key(events(spark, d), AT, keys=["user_id"], time_ms=F.col("t"), seq=["event_id"], value_cols=["event_id"], staleness_ms=DAY)


@case(f"""with {EV}, {LATEST}, w as (select c_custkey user_id from customer)
select user_id, event_id, last_ms, {AT} - last_ms as age_ms, case when last_ms is null then 'NEVER_OBSERVED' when {AT} - last_ms <= {DAY} then 'AVAILABLE' else 'STALE' end as status
from n full join w using (user_id)""")
def alignment_status_expected_keys(spark, d):
    """Every customer is expected."""
    expected = read_table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return asof.latest_per_key(events(spark, d), AT, keys=["user_id"], time_ms=F.col("t"), seq=["event_id"], value_cols=["event_id"], staleness_ms=DAY, expected=expected)


@case(f"""with {EV}, p as (select unnest(range({T0}, {T0 + 30 * DAY}, {6 * HOUR})) at_ms), k as (select distinct venue from e), g as (select * from k, p)
select g.venue, at_ms, e.t as last_ms, e.event_id, at_ms - e.t as age_ms, case when e.t is null then 'NEVER_OBSERVED' when at_ms - e.t <= {HOUR} then 'AVAILABLE' else 'STALE' end as status
from g asof left join e on g.venue = e.venue and g.at_ms >= e.t""")
def snapshot_many_t(spark, d):
    points = asof.fixed_grid(spark, T0, T0 + 30 * DAY, 6 * HOUR, "at_ms")
    return asof.snapshots(events(spark, d), points, key="venue", time_ms=F.col("t"), seq=["event_id"], value_cols=["event_id"], staleness_ms=HOUR)


FLOW = f"sum(case when sgn = 1 and {{w}} then qty else 0 end) as buy_volume, sum(case when sgn = -1 and {{w}} then qty else 0 end) as sell_volume, count(case when {{w}} then 1 end) as trade_count, max(t) as last_ms, sum(case when {{w}} then coalesce(sgn, 0) * qty else 0 end) as cvd, {AT} - max(t) as age_ms, case when {AT} - max(t) <= {HOUR} then 'AVAILABLE' else 'STALE' end as status"


@case(f"with {EV} select venue, {FLOW.replace('{w}', 'true')} from e where t <= {AT} group by 1")
def trade_flow_cumulative(spark, d):
    return bars.flow_at(events(spark, d), AT, time_ms=F.col("t"), sign=F.col("sign"), quantity="qty", keys=["venue"], staleness_ms=HOUR)


@case(f"with {EV} select venue, {FLOW.replace('{w}', f't > {AT - 6 * HOUR}')} from e where t <= {AT} group by 1")
def trade_flow_window(spark, d):
    return bars.flow_at(events(spark, d), AT, time_ms=F.col("t"), sign=F.col("sign"), quantity="qty", keys=["venue"], window_ms=6 * HOUR, staleness_ms=HOUR)


@case(f"""with {EV}, p as (select distinct venue, at_ms, w from e, (select unnest(range({T0}, {T0 + 30 * DAY}, {12 * HOUR})) at_ms), (select unnest([{HOUR}, {6 * HOUR}]) w))
select p.venue, at_ms, w as window_ms, coalesce(sum(case when sgn = 1 then qty end), 0) as buy_volume, coalesce(sum(case when sgn = -1 then qty end), 0) as sell_volume, count(t) as trade_count
from p left join e on e.venue = p.venue and t <= at_ms and t > at_ms - w group by all""")
def trade_flow_prefix_many(spark, d):
    e = events(spark, d)
    points = asof.fixed_grid(spark, T0, T0 + 30 * DAY, 12 * HOUR, "at_ms").withColumn("venue", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    points = points.join(e.select("venue").distinct(), "venue")
    return bars.flow_many(e, points, [HOUR, 6 * HOUR], time_ms=F.col("t"), sign=F.col("sign"), quantity="qty", key="venue")


@case(f"""with {EV}, s as (select * from e where t <= {AT}),
l as (select venue, arg_max(value, (t, event_id)) filter (where sgn is not null) last_trade, max(t) filter (where sgn is not null) trade_ms,
 arg_max(value, (t, event_id)) filter (where event_type = 'view') mark, max(t) filter (where event_type = 'view') mark_ms,
 sum(case when sgn = 1 then qty else 0 end) buys, sum(case when sgn = -1 then qty else 0 end) sells, count(*) filter (where event_type = 'click') unknown_side from s group by 1)
select venue, last_trade, mark, {AT} - mark_ms > {HOUR} as mark_stale, case when {AT} - mark_ms <= {HOUR} then round(last_trade - mark, 7) end as price_vs_mark,
 buys as buy_volume, sells as sell_volume, unknown_side from l""")
def market_state_at_t(spark, d):
    s = events(spark, d).where(F.col("t") <= AT)
    order, trade, view = F.struct("t", "event_id"), F.col("sign").isNotNull(), F.col("event_type") == "view"
    out = s.groupBy("venue").agg(
        F.max_by("value", F.when(trade, order)).alias("last_trade"), F.max_by("value", F.when(view, order)).alias("mark"), F.max(F.when(view, F.col("t"))).alias("mark_ms"),
        F.sum(F.when(F.col("sign") == 1, F.col("qty")).otherwise(0.0)).alias("buy_volume"), F.sum(F.when(F.col("sign") == -1, F.col("qty")).otherwise(0.0)).alias("sell_volume"),
        F.count_if(F.col("event_type") == "click").alias("unknown_side"),
    )
    age = F.lit(AT) - F.col("mark_ms")
    return out.select(
        "venue", "last_trade", "mark", (age > HOUR).alias("mark_stale"), F.when(age <= HOUR, F.round(F.col("last_trade") - F.col("mark"), 7)).alias("price_vs_mark"), "buy_volume", "sell_volume", "unknown_side"
    )


@case("""with o as (select instrument_key, funding_rate, row_number() over (partition by instrument_key order by local_timestamp desc, reading_id desc) r from markprice
 where instrument_key is not null and local_timestamp is not null and funding_rate is not null and not isnan(funding_rate))
select instrument_key, max(case r when 1 then funding_rate end) as newest, max(case r when 2 then funding_rate end) as earlier,
 round(max(case r when 1 then funding_rate end) - max(case r when 2 then funding_rate end), 9) as change from o where r <= 2 group by 1""")
def last_two_change(spark, d):
    o = read_table(spark, d, "markprice").where("instrument_key is not null and local_timestamp is not null and funding_rate is not null and not isnan(funding_rate)")
    # ranked with a limit the planner applies before the shuffle, so a key sends two rows a task
    rank = F.row_number().over(Window.partitionBy("instrument_key").orderBy(F.desc("local_timestamp"), F.desc("reading_id")))
    top = o.select("instrument_key", "funding_rate", rank.alias("r")).where("r <= 2")
    pick = lambda r: F.max(F.when(F.col("r") == r, F.struct("funding_rate")))
    out = top.groupBy("instrument_key").agg(pick(1).alias("a"), pick(2).alias("b"))
    return out.select("instrument_key", F.col("a.funding_rate").alias("newest"), F.col("b.funding_rate").alias("earlier"), F.round(F.col("a.funding_rate") - F.col("b.funding_rate"), 9).alias("change"))


@case("""with s as (select collector_run r, segment_seq q, row_no n, record_id, (payload ->> '$.bid_depth') v from raw_records where stream = 'orderbook'),
c as (select *, last_value(v ignore nulls) over w lv, last_value(case when v is not null then q * 100000 + n end ignore nulls) over w lp from s
 window w as (partition by r order by q, n, record_id rows between unbounded preceding and current row))
select record_id, lv as bid_depth, v is null and lv is not null as carried, q * 100000 + n - lp as age_rows from c""")
def carry_forward_provenance(spark, d):
    s = read_table(spark, d, "raw_records").where("stream = 'orderbook'").withColumn("v", F.get_json_object("payload", "$.bid_depth"))
    place = (F.col("segment_seq") * 100_000 + F.col("row_no")).cast("long")
    s = s.withColumn("place", place).withColumn("c", F.floor(F.col("segment_seq") / 64))
    s = with_carried(s, ["collector_run"], "c", ["segment_seq", "row_no", "record_id"], {"last": F.when(F.col("v").isNotNull(), F.struct("v", "place"))})
    return s.select("record_id", F.col("last.v").alias("bid_depth"), (F.col("v").isNull() & F.col("last.v").isNotNull()).alias("carried"), (F.col("place") - F.col("last.place")).alias("age_rows"))


@case("""with s as (select collector_run r, segment_seq q, row_no n, record_id, try_cast(coalesce(payload ->> '$.trade_id', payload ->> '$.tradeId', payload ->> '$.tid') as bigint) i
 from raw_records where stream = 'trades'), l as (select *, lag(i) over (partition by r order by q, n, record_id) p from s where i is not null)
select record_id, case when p is null or i = p + 1 then 'continue' when i = p then 'duplicate' when i < p then 'stale' else 'gap' end as verdict from l""")
def sequence_continuity(spark, d):
    i = F.coalesce(*[F.get_json_object("payload", p) for p in ("$.trade_id", "$.tradeId", "$.tid")]).try_cast("long")
    s = read_table(spark, d, "raw_records").where("stream = 'trades'").withColumn("i", i).where("i is not null")
    s = with_adjacent(s.withColumn("c", F.floor(F.col("segment_seq") / 64)), ["collector_run"], "c", ["segment_seq", "row_no", "record_id"], "i", prev="p")
    verdict = F.when(F.col("p").isNull() | (F.col("i") == F.col("p") + 1), "continue").when(F.col("i") == F.col("p"), "duplicate").when(F.col("i") < F.col("p"), "stale").otherwise("gap")
    return s.select("record_id", verdict.alias("verdict"))


# Duplicates

IDS = ["exchange", "market_type", "instrument_key", "stream", "trade_id"]
KNOWN = " and ".join(f"{c} is not null" for c in IDS)


def _trades(spark, d):
    return read_table(spark, d, "trade_events")


@case(f"""with n as (select delivery_id, price, row_number() over (partition by {", ".join(IDS)} order by local_receive_ts, delivery_id) r from trade_events where {KNOWN})
select delivery_id, price from n where r = 1""")
def dedup_first_wins(spark, d):
    return evidence.first_wins(_trades(spark, d).where(KNOWN), identity=IDS, order=["local_receive_ts", "delivery_id"]).select("delivery_id", "price")


@case(f"""with n as (select delivery_id, row_number() over (partition by {", ".join(IDS)} order by local_receive_ts, delivery_id) r from trade_events where {KNOWN})
select delivery_id from n where r = 1 union all select delivery_id from trade_events where not ({KNOWN})""")
def dedup_null_id_exempt(spark, d):
    return evidence.first_wins(_trades(spark, d), identity=IDS, order=["local_receive_ts", "delivery_id"]).select("delivery_id")


@case("""with n as (select delivery_id, row_number() over (partition by exchange_event_ts, side, price, quantity order by local_receive_ts, delivery_id) r
 from trade_events where exchange_event_ts is not null and side is not null and price is not null and quantity is not null)
select delivery_id from n where r = 1 union all select delivery_id from trade_events where exchange_event_ts is null or side is null or price is null or quantity is null""")
def heuristic_dedup(spark, d):
    return evidence.first_wins(_trades(spark, d), identity=["exchange_event_ts", "side", "price", "quantity"], order=["local_receive_ts", "delivery_id"]).select("delivery_id")


REPEATS = f"""k as (select * from trade_events where {KNOWN}), f as (select *, first_value(struct_pack(t := epoch_ms(local_receive_ts), p := price, q := quantity, s := side, e := exchange_event_ts))
 over w fv, row_number() over w r from k window w as (partition by {", ".join(IDS)} order by local_receive_ts, delivery_id)),
rep as (select delivery_id, exchange, epoch_ms(local_receive_ts) - fv.t as delay_ms, case when price is not distinct from fv.p and quantity is not distinct from fv.q and side is not distinct from fv.s
 and exchange_event_ts is not distinct from fv.e then 'EXACT_DUPLICATE' else 'IDENTITY_PAYLOAD_CONFLICT' end as kind, epoch_ms(local_receive_ts) - fv.t = 0 as ambiguous from f where r > 1)"""


def _repeats(spark, d):
    return evidence.repeats_of(
        _trades(spark, d), identity=IDS, order=["local_receive_ts", "delivery_id"], content=["price", "quantity", "side", "exchange_event_ts"], time_ms=epoch_ms(F.col("local_receive_ts"))
    )


@case(f"with {REPEATS} select delivery_id, delay_ms, kind, ambiguous from rep")
def dedup_forensics(spark, d):
    return _repeats(spark, d).select("delivery_id", "delay_ms", "kind", "ambiguous")


@case(f"""with {REPEATS}, s as (select exchange, list_sort(list(delay_ms)) a from rep where delay_ms is not null group by 1)
select exchange, len(a) as n, a[1] as min_ms, a[round_even(0.5::double * (len(a) - 1), 0)::int + 1] as p50_ms, a[round_even(0.95::double * (len(a) - 1), 0)::int + 1] as p95_ms,
 a[round_even(0.99::double * (len(a) - 1), 0)::int + 1] as p99_ms, a[len(a)] as max_ms from s""")
def duplicate_delay_percentiles(spark, d):
    return evidence.delay_percentiles(_repeats(spark, d), by=["exchange"])


@case("""with p as (select l_orderkey, l_linenumber, l_suppkey, count(*) r from lineitem group by all), i as (select l_orderkey, l_linenumber, count(*) owners, sum(r) r from p group by all)
select owners, count(*) as identities, sum(r) as row_count from i group by 1""")
def dedup_census(spark, d):
    return evidence.census(read_table(spark, d, "lineitem"), identity=["l_orderkey", "l_linenumber"], segment="l_suppkey")


@case(f"""with o as (select distinct {", ".join(IDS)}, segment_id from trade_events where {KNOWN}),
l as (select segment_id - lag(segment_id) over (partition by {", ".join(IDS)} order by segment_id) g from o)
select case when g = 1 then 'adjacent' when g <= 10 then '2-10' when g <= 100 then '11-100' else '>100' end as bucket, count(*) as n from l where g is not null group by 1""")
def segment_distance_census(spark, d):
    return evidence.segment_distances(_trades(spark, d).where(KNOWN), identity=IDS, segment="segment_id")


KEY = "concat(length(exchange), ':', exchange, length(market_type), ':', market_type, length(trade_id), ':', trade_id)"


@case(f"select delivery_id, case when exchange is not null and market_type is not null and trade_id is not null then {KEY} end as identity_key from trade_events")
def identity_key(spark, d):
    return _trades(spark, d).select("delivery_id", exact.framed_key(F.col("exchange"), F.col("market_type"), F.col("trade_id")).alias("identity_key"))


@case("""with p as (select instrument_key k, string_split(instrument_key, '|') a, delivery_id from trade_events)
select delivery_id, case when k is null or trim(k) = '' then 'absent' when regexp_full_match(k, '[A-Z0-9_]+\\|[a-z0-9_]+\\|[A-Z0-9]+-[A-Z0-9]+\\|[^|\\s]+') then 'ok' else 'error' end as state,
 case when regexp_full_match(k, '[A-Z0-9_]+\\|[a-z0-9_]+\\|[A-Z0-9]+-[A-Z0-9]+\\|[^|\\s]+') then string_split(a[3], '-')[1] end as base from p""")
def instrument_parts(spark, d):
    t = _trades(spark, d).withColumn("p", exact.parse_instrument(F.col("instrument_key")))
    return t.select("delivery_id", F.col("p.state").alias("state"), F.col("p.base").alias("base"))


@case()
def identity_set_digest(spark, d):
    t = _trades(spark, d)
    return evidence.set_digest(t, by=["exchange"], key=exact.framed_key(F.col("exchange"), F.col("market_type"), F.col("trade_id")))


@case(f"""with k as (select delivery_id, case when {KNOWN} then concat({", ".join(f"length({c}), ':', {c}" for c in IDS)}) end as key from trade_events)
select delivery_id from k where key is null or key not in (select identity_key from seen_trade_ids)""")
def anti_join_admission(spark, d):
    t = _trades(spark, d).withColumn("identity_key", exact.framed_key(*[F.col(c) for c in IDS]))
    return t.join(read_table(spark, d, "seen_trade_ids"), "identity_key", "left_anti").select("delivery_id")


@case("""with a as (select file_id, count(*) n from segment_rows group by 1), b as (select file_id, rows from hour_sources)
select coalesce(a.file_id, b.file_id) as file_id, case when b.file_id is null then 'missing_in_index' when a.file_id is null then 'missing_on_disk' else 'digest_differs' end as reason
from a full join b on a.file_id = b.file_id where b.file_id is null or a.file_id is null or n is distinct from rows""")
def index_audit(spark, d):
    stored = read_table(spark, d, "segment_rows").groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    return evidence.index_audit(stored, read_table(spark, d, "hour_sources").withColumnRenamed("rows", "n"), key="file_id", digest="n")


@case("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def duplicate_group_check(spark, d):
    return read_table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@case("""with r as (select stream, file_id, min_ts_ms lo, max_ts_ms hi, hour from hour_sources where min_ts_ms is not null and max_ts_ms is not null),
l as (select *, max(hi) over (partition by stream order by lo, hi, file_id rows between unbounded preceding and 1 preceding) before from r)
select stream, file_id, before - lo as overlap_ms from l where before >= lo""")
def boundary_overlap_check(spark, d):
    r = read_table(spark, d, "hour_sources").where("min_ts_ms is not null and max_ts_ms is not null")
    w = Window.partitionBy("stream").orderBy("min_ts_ms", "max_ts_ms", "file_id").rowsBetween(Window.unboundedPreceding, -1)
    return r.withColumn("before", F.max("max_ts_ms").over(w)).where("before >= min_ts_ms").select("stream", "file_id", (F.col("before") - F.col("min_ts_ms")).alias("overlap_ms"))


# Books

_SUM = "list_sum(list_slice({0}, 1, {1}))"


def _obi(n: int) -> str:
    b, a = _SUM.format("bids_qty", n), _SUM.format("asks_qty", n)
    return f"case when len(bids_qty) >= {n} and len(asks_qty) >= {n} then case when {b} + {a} <> 0 then round(({b} - {a}) / ({b} + {a}), 7) else 0 end end"


OK_BOOK = "len(bids_price) > 0 and len(asks_price) > 0 and len(bids_qty) > 0 and len(asks_qty) > 0 and bids_price[1] + asks_price[1] <> 0 and bids_qty[1] + asks_qty[1] <> 0"


@case(f"""select book_id, bids_price[1] as best_bid, asks_price[1] as best_ask, (bids_price[1] + asks_price[1]) / 2 as mid_price, asks_price[1] - bids_price[1] as spread,
 (bids_price[1] * asks_qty[1] + asks_price[1] * bids_qty[1]) / (bids_qty[1] + asks_qty[1]) as micro_price, {_obi(3)} as obi_level_3, {_obi(5)} as obi_level_5,
 least(len(bids_price), 10)::int as bid_depth, least(len(asks_price), 10)::int as ask_depth from orderbook where {OK_BOOK}""")
def book_features_arrays(spark, d):
    f = B.features(*[F.col(c) for c in ("bids_price", "bids_qty", "asks_price", "asks_qty")])
    names = ["best_bid", "best_ask", "mid_price", "spread", "micro_price", "obi_level_3", "obi_level_5", "bid_depth", "ask_depth"]
    rounded = {"obi_level_3", "obi_level_5"}
    return read_table(spark, d, "orderbook").select("book_id", *[(F.round(f[n], 7) if n in rounded else f[n]).alias(n) for n in names]).where("best_bid is not null")


@case(f"""select book_id, round(({_SUM.format('bids_qty', 10)} - {_SUM.format('asks_qty', 10)}) / ({_SUM.format('bids_qty', 10)} + {_SUM.format('asks_qty', 10)}), 7) as obi,
 round(case when bids_qty[1] + asks_qty[1] <> 0 then (bids_qty[1] - asks_qty[1]) / (bids_qty[1] + asks_qty[1]) else 0 end, 7) as obi_level_1 from orderbook where {OK_BOOK}""")
def obi_levels(spark, d):
    f = B.features(*[F.col(c) for c in ("bids_price", "bids_qty", "asks_price", "asks_qty")])
    return read_table(spark, d, "orderbook").select("book_id", F.round(f["obi"], 7).alias("obi"), F.round(f["obi_level_1"], 7).alias("obi_level_1")).where("obi is not null")


@case("""select book_id, bids_price[1] as bid, asks_price[1] as ask, round((asks_price[1] - bids_price[1]) / nullif((asks_price[1] + bids_price[1]) / 2, 0) * 10000, 6) as spread_bps from orderbook""")
def top_of_book_metrics(spark, d):
    bid, ask = F.try_element_at("bids_price", F.lit(1)), F.try_element_at("asks_price", F.lit(1))
    return read_table(spark, d, "orderbook").select("book_id", bid.alias("bid"), ask.alias("ask"), F.round(F.try_divide(ask - bid, (ask + bid) / 2) * 10_000, 6).alias("spread_bps"))


_STEP = "list_bool_and(list_transform(range(1, greatest(len({0}), 1)), lambda i: {0}[i] {1} {0}[i + 1]))"


@case(f"""select book_id, case when coalesce(len(bids_price), 0) = 0 or coalesce(len(asks_price), 0) = 0 then 'empty_side'
 when len(bids_price) <> len(bids_qty) or len(asks_price) <> len(asks_qty) then 'malformed_levels'
 when len(list_filter(list_concat(bids_price, asks_price, bids_qty, asks_qty), lambda x: not coalesce(x > 0 and isfinite(x), false))) > 0 then 'non_positive_level'
 when not coalesce({_STEP.format('bids_price', '>')}, true) then 'bids_not_descending' when not coalesce({_STEP.format('asks_price', '<')}, true) then 'asks_not_ascending'
 when bids_price[1] >= asks_price[1] then 'crossed_or_locked' end as reason from orderbook""")
def book_trust_reason(spark, d):
    reason = B.untrusted_reason(*[F.col(c) for c in ("bids_price", "bids_qty", "asks_price", "asks_qty")])
    return read_table(spark, d, "orderbook").select("book_id", reason.alias("reason"))


@case()
def book_reconstruction(spark, d):
    """Books folded from frames that lead from each stored ladder of an instrument to its next."""
    o = read_table(spark, d, "orderbook").where("instrument_key is not null and local_timestamp is not null and bids_price is not null and asks_price is not null")
    return orderbook.reconstruct(orderbook.frames_of_ladders(o.withColumn("seq", F.col("book_id"))))


# Time, exact numbers, JSON, logs, sources


@case(f"""select event_id, {T0} + (epoch_us(ts) // 1000 - {T0} + 299999) // 300000 * 300000 as bin_end, greatest(1, ceil(value / 86400))::int as purge,
 (epoch_us(ts) // 86400000000)::bigint as day from events""")
def clock_arithmetic(spark, d):
    e = events(spark, d)
    return e.select("event_id", ceil_grid(F.col("t"), T0, 300_000).alias("bin_end"), purge_days(F.col("value")).alias("purge"), F.floor(F.col("t") / DAY).cast("long").alias("day"))


@case("""select record_id, case when regexp_full_match(v, '-?\\d+') then v::bigint else epoch_ms(try_cast(v as timestamptz)) end as t
from (select record_id, coalesce(payload ->> '$.exchange_timestamp', payload ->> '$.E', payload ->> '$.event_ts') v from raw_records)""")
def coerced_times(spark, d):
    v = F.coalesce(*[F.get_json_object("payload", p) for p in ("$.exchange_timestamp", "$.E", "$.event_ts")])
    return read_table(spark, d, "raw_records").select("record_id", coerce_ms(v).alias("t"))


@case("""select delivery_id, try_cast(price_exact as decimal(38,18))::double as price_dec, price_exact as text,
 case when regexp_full_match(trade_id, '[0-9]+') and try_cast(trade_id as bigint)::varchar = trade_id then trade_id::bigint end as long_id,
 coalesce(regexp_full_match(trade_id, '\\s*[+-]?\\d+(_\\d+)*\\s*'), false) as is_numeric from trade_events""")
def exact_numbers(spark, d):
    t = _trades(spark, d)
    return t.select(
        "delivery_id", exact.dec(F.col("price_exact")).cast("double").alias("price_dec"), F.col("price_exact").alias("text"), exact.lossless_long(F.col("trade_id")).alias("long_id"),
        F.coalesce(exact.numeric_id(F.col("trade_id")), F.lit(False)).alias("is_numeric"),
    )


@case("select event_id, try_cast(props ->> '$.k' as bigint) as k from events")
def json_extract_typed(spark, d):
    return read_table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@case("""with f as (select stream, unnest(json_keys(payload)) as field from raw_records), n as (select stream, count(*) rows from raw_records group by 1)
select f.stream, field, count(*) as records, round(count(*) / any_value(rows), 7) as ratio from f join n on f.stream = n.stream group by all""")
def json_field_presence(spark, d):
    r = read_table(spark, d, "raw_records")
    keys = r.select("stream", F.explode(F.json_object_keys("payload")).alias("field")).groupBy("stream", "field").agg(F.count(F.lit(1)).alias("records"))
    n = r.groupBy("stream").agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(n, "stream").select("stream", "field", "records", F.round(F.col("records") / F.col("rows"), 7).alias("ratio"))


@case("""select item_id, case when not coalesce(trim(msg) like '{%', false) or not json_valid(msg) then 'undecodable' when msg ->> '$.lastUpdateId' is not null then 'snapshot'
 when coalesce(msg ->> '$.data.e', msg ->> '$.e') = 'depthUpdate' then 'depth' when coalesce(msg ->> '$.data.e', msg ->> '$.e') in ('aggTrade', 'trade') then 'trade'
 when coalesce(msg ->> '$.data.e', msg ->> '$.e') = 'markPriceUpdate' then 'mark' when coalesce(msg ->> '$.data.e', msg ->> '$.e') = 'forceOrder' then 'liquidation'
 when lower(coalesce(msg ->> '$.stream', msg ->> '$.topic', msg ->> '$.arg.channel', '')) like '%trade%' then 'trades'
 when lower(coalesce(msg ->> '$.stream', msg ->> '$.topic', msg ->> '$.arg.channel', '')) like '%orderbook%' or lower(coalesce(msg ->> '$.stream', msg ->> '$.topic', msg ->> '$.arg.channel', '')) like 'books%' then 'book'
 when lower(coalesce(msg ->> '$.stream', msg ->> '$.topic', msg ->> '$.arg.channel', '')) like '%mark-price%' then 'marks' else 'unsupported' end as kind
from (select item_id, case when json_valid(msg) then msg else null end as msg, msg raw from ingest_items)""")
def frame_routing(spark, d):
    return read_table(spark, d, "ingest_items").select("item_id", normalize.route("msg").alias("kind")).withColumn("kind", F.coalesce("kind", F.lit("undecodable")))


_LEVELS = "list_aggregate(list_transform({0}, lambda x: concat(x[1], ':', x[2])), 'string_agg', ',')"


@case("""with m as (select item_id, case when json_valid(msg) and trim(msg) like '{%' then msg end msg from ingest_items), d as (select item_id, coalesce(msg -> '$.data', msg::json) d, msg from m where msg is not null),
k as (select *, d ->> '$.lastUpdateId' is not null or msg ->> '$.lastUpdateId' is not null snap, coalesce(msg ->> '$.data.e', msg ->> '$.e') = 'depthUpdate' dep from d)
select item_id as frame_id, snap as is_snapshot, try_cast(case when snap then d ->> '$.lastUpdateId' else d ->> '$.u' end as bigint) as update_id, try_cast(d ->> '$.U' as bigint) as first_id,
 try_cast(d ->> '$.pu' as bigint) as prev_id, """ + ", ".join(
    _LEVELS.format(f"try_cast(coalesce(d -> '$.{x}', d -> '$.{x[0]}') as varchar[][])") + f" as {x}" for x in ("bids", "asks")
) + """, try_cast(d ->> '$.E' as bigint) as exchange_ms from k where snap or dep""")
def depth_frames(spark, d):
    """Frames of the wire payloads for the book fold; each side's levels as one text."""
    out = normalize.depth(read_table(spark, d, "ingest_items").select(F.col("item_id").alias("frame_id"), F.col("msg").alias("payload")))
    text = lambda c: F.nullif(F.array_join(F.transform(c, lambda x: F.concat(x[0], F.lit(":"), x[1])), ","), F.lit(""))
    return out.withColumn("bids", text("bids")).withColumn("asks", text("asks"))


@case("""with f as (select item_id, venue, coalesce(msg ->> '$.data.s', msg ->> '$.s') s, try_cast(msg ->> '$.u' as bigint) u, try_cast(msg ->> '$.U' as bigint) f, try_cast(msg ->> '$.pu' as bigint) p
 from ingest_items where json_valid(msg) and trim(msg) like '{%' and msg ->> '$.e' = 'depthUpdate'), k as (select * from f where s is not null and venue is not null),
l as (select *, lag(u) over (partition by venue, s order by item_id) b from k)
select item_id, case when venue = 'OKX' then case when p = -1 then 'continue' when b is null or p is distinct from b then 'gap' else 'continue' end when b is null then 'continue' when u is null then 'gap'
 when venue = 'BYBIT' then case when u < b then 'resync' when u = b then 'stale' else 'continue' end when u <= b then 'stale' when p is null or p <> b then 'gap' else 'continue' end as verdict,
 case when venue = 'OKX' then case when p = -1 then null when b is null then 'missing_snapshot' when p is distinct from b then 'prev_seq_id_mismatch' end when b is null then null when u is null then 'update_id_missing'
 when u < b then case when venue = 'BYBIT' then 'update_id_decrease_or_reset' else 'stale_update' end when u = b then 'duplicate_update' when venue = 'BYBIT' then null
 when p is null then 'pu_missing' when p <> b then 'pu_mismatch' end as reason from l""")
def depth_continuity(spark, d):
    """Every depth update against the one before it of its venue and symbol, by the venue's rule."""
    g = lambda p: F.get_json_object("msg", p)
    i = read_table(spark, d, "ingest_items").where(F.try_parse_json("msg").isNotNull() & F.trim("msg").startswith("{")).where(g("$.e") == "depthUpdate")
    long = lambda p: g(p).try_cast("long")
    i = i.select("item_id", "venue", g("$.s").alias("s"), long("$.u").alias("u"), long("$.U").alias("f"), long("$.pu").alias("p")).where("s is not null and venue is not null")
    near = with_adjacent(i.withColumn("c", F.floor(F.col("item_id") / 50_000)), ["venue", "s"], "c", ["item_id"], "u", prev="b")
    v = validation.continuity(F.col("venue"), F.col("u"), F.col("f"), F.col("p"), F.col("b"))
    return near.select("item_id", v.alias("v")).select("item_id", "v.verdict", "v.reason")


@case("""with w as (select local_receive_ts ts_ms, case when is_control then 1 else 0 end kind_rank, coalesce(receive_ns, -1) ns, item_id source_index from ingest_items
 where local_receive_ts is not null and is_control is not null)
select source_index, row_number() over (order by ts_ms, kind_rank, ns, source_index) as place from w""")
def replay_total_order(spark, d):
    """Places in the whole log: places within an hour, raised by the rows of the hours before."""
    i = read_table(spark, d, "ingest_items").where("local_receive_ts is not null").select(
        F.col("local_receive_ts").alias("ts_ms"), F.col("receive_ns").alias("ns"), F.col("item_id").alias("source_index"), "is_control"
    )
    log = replay.merged_log(i.where("not is_control"), i.where("is_control")).withColumn("c", F.floor(F.col("ts_ms") / HOUR))
    before = F.sum("n").over(Window.orderBy("c").rowsBetween(Window.unboundedPreceding, -1))  # over one row an hour
    earlier = log.groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c", F.coalesce(before, F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("c").orderBy(*replay.ORDER))
    return log.withColumn("place", place).join(earlier, "c").select("source_index", (F.col("place") + F.col("earlier")).alias("place"))


@case("""with w as (select epoch_ms(local_timestamp) // 1000 s, count(*) n from orderbook where local_timestamp is not null group by 1), r as (select epoch_ms(local_timestamp) // 1000 s, count(*) n from markprice where local_timestamp is not null group by 1)
select w.s as ts_ms, w.n as wire_frames, r.n as rest_frames from w join r on w.s = r.s""")
def order_ties(spark, d):
    second = lambda t: read_table(spark, d, t).where("local_timestamp is not null").select(F.floor(epoch_ms(F.col("local_timestamp")) / 1000).cast("long").alias("ts_ms"))
    return replay.order_ties(second("orderbook"), second("markprice"))


@case()
def replay_digest(spark, d):
    t = _trades(spark, d).where("local_receive_ts is not null and exchange is not null").withColumn("chunk", F.floor(epoch_ms(F.col("local_receive_ts")) / HOUR))
    return replay.output_digest(t, by=["exchange"], order=["local_receive_ts", "delivery_id"], columns=["delivery_id", "trade_id", "price_exact"], chunk="chunk")


@case("""with s as (select venue, ts, sum(g) over (partition by venue order by ts, event_id) i from (select user_id % 4 as venue, ts, event_id,
 case when epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id % 4 order by ts, event_id) <= 900000000 then 0 else 1 end g from events))
select venue, epoch_us(min(ts)) // 1000 as start_ms, count(*) as n from s group by venue, i""")
def session_windows(spark, d):
    e = events(spark, d)
    return e.groupBy("venue", F.session_window(F.col("ts").cast("timestamp"), "15 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("venue", epoch_ms(F.col("w.start")).alias("start_ms"), "n")


FILES = r"regexp_extract(path, '([^/\\]+)$', 1)"


def _entries(spark, d):
    return segments.parse_names(read_table(spark, d, "hour_sources").drop("hour"), "path")


@case(f"""select file_id, case when regexp_full_match({FILES}, '\\d{{4}}-\\d{{2}}-\\d{{2}}-\\d{{2}}-\\d{{6}}\\.seg') then 'segment' when regexp_full_match({FILES}, '\\d{{4}}-\\d{{2}}-\\d{{2}}-\\d{{2}}\\.parquet') then 'hourly' end as kind,
 try_cast(nullif(regexp_extract({FILES}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}-\\d{{2}}-(\\d{{6}})\\.seg$', 1), '') as int) as seq from hour_sources""")
def segment_names(spark, d):
    return _entries(spark, d).select("file_id", "kind", "seq")


@case(f"""with p as (select stream, regexp_extract({FILES}, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})-(\\d{{2}})(-\\d{{6}}\\.seg|\\.parquet)$', ['d', 'h', 'x']) s from hour_sources),
h as (select distinct stream, s.d::date as date, s.h::int as hour from p where s.d <> ''), a as (select distinct stream, date, unnest(range(24))::int as hour from h)
select stream, strftime(date, '%Y-%m-%d') as date, hour from a anti join h using (stream, date, hour)""")
def missing_hours(spark, d):
    out = segments.missing_hours(_entries(spark, d).where("kind is not null and stream is not null"))
    return out.withColumn("date", F.col("date").cast("string"))


_NAMES = f"""n as (select file_id, stream, path, size_bytes, regexp_extract({FILES}, '^(\\d{{4}}-\\d{{2}}-\\d{{2}})-(\\d{{2}})(-\\d{{6}}\\.seg|\\.parquet)$', ['d', 'h', 'x']) s, regexp_extract(path, '([^/\\\\]+)[/\\\\][^/\\\\]+$', 1) folder from hour_sources),
p as (select file_id, stream, folder, path, size_bytes, try_cast(nullif(s.d, '') as date) as date, try_cast(nullif(s.h, '') as int) as hour, case when s.x like '%seg' then 'segment' when s.x = '.parquet' then 'hourly' end as kind from n)"""


@case(f"""with {_NAMES}, b as (select *, count(distinct kind) over (partition by stream, date, hour) k from p where kind is not null)
select file_id, stream, strftime(date, '%Y-%m-%d') as date, hour, kind from b where k = 1 or kind = 'segment'""")
def segment_resolution(spark, d):
    out = segments.resolve(_entries(spark, d), on_collision="prefer_segments").select("file_id", "stream", "date", "hour", "kind")
    return out.withColumn("date", F.col("date").cast("string"))


@case(f"""with {_NAMES}, m as (select *, path like '%.meta.json' meta from p), k as (select folder, date, hour, count(distinct kind) kinds from m where not coalesce(meta, false) and kind is not null group by all),
x as (select m.*, k.kinds from m left join k on m.folder = k.folder and m.date = k.date and m.hour = k.hour where not coalesce(meta, false))
select file_id, case when kind is null or coalesce(size_bytes = 0, false) then 'INVALID' when kinds > 1 then 'AMBIGUOUS' when kind = 'hourly' then 'LEGACY'
 when exists (select 1 from m y where y.meta and y.path = x.path || '.meta.json') then 'MARKED' else 'UNMARKED' end as trust from x""")
def source_catalog(spark, d):
    """Every listed file with how far it may be trusted before it is opened."""
    return segments.trust(read_table(spark, d, "hour_sources").drop("stream", "hour")).select("file_id", "trust")


@case("""with f as (select * from hour_sources where path like '%.seg' or path like '%.parquet'), r as (select file_id, path, coalesce(rows, 0) n, coalesce(size_bytes, 0) b, min_ts_ms a, max_ts_ms z from f)
select path as segment, concat('{"first_record_ts":', coalesce(a::varchar, 'null'), ',"last_record_ts":', coalesce(z::varchar, 'null'), ',"publication":{"boot_id":null,"confirmed_at_utc":"2025-01-01T00:00:00Z",',
 '"confirmed_by":"writer","legacy":false,"schema":2,"segment":', to_json(path), ',"sha256":"', sha256(path), '","size_bytes":', b, ',"state":"PUBLICATION_CONFIRMED","writer_schema":"parquet_writer/2"},"record_count":', n, '}', chr(10)) as content,
 case when n < 0 or b < 0 then 'INVALID' else 'VALID' end as status from r""")
def publication_markers(spark, d):
    """Markers of the listed segments (the digest is that of the path, as there are no bytes), and what reading them back says."""
    listed = segments.finished_listing(read_table(spark, d, "hour_sources"))
    rows = listed.select(
        F.col("path").alias("segment"), F.coalesce("rows", F.lit(0)).alias("record_count"), F.col("min_ts_ms").alias("first_ts"), F.col("max_ts_ms").alias("last_ts"),
        F.sha2("path", 256).alias("sha256"), F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
    )
    made = publication.markers(rows, confirmed_at="2025-01-01T00:00:00Z")
    return publication.marker_status(made).select("segment", "content", "status")


@case("""with o as (select instrument_key k, epoch_ms(local_timestamp) // 3600000 h, epoch_ms(local_timestamp) t, count(*) n from markprice group by all)
select k as instrument_key, h as hour, sum(n)::bigint as n, concat_ws(',', case when count(*) filter (where t is null) > 0 then 'null_time' end, case when count(*) filter (where n > 1 and t is not null) > 0 then 'repeated_time' end,
 case when k <> 'BINANCE|linear_perpetual|BTC-USDT|BTCUSDT' then 'other_instrument' end) as problems from o group by k, h""")
def accepted_hours(spark, d):
    """Hourly tables of mark prices against the rules of compaction."""
    m = read_table(spark, d, "markprice").withColumn("t", epoch_ms(F.col("local_timestamp"))).withColumn("hour", F.floor(F.col("t") / HOUR))
    out = publication.accept_hours(m, by=["instrument_key", "hour"], time_ms=F.col("t"), instrument=F.col("instrument_key"), expected="BINANCE|linear_perpetual|BTC-USDT|BTCUSDT")
    return out.withColumn("problems", F.array_join("problems", ","))


# Validity and preparation

_TIMES = "case when not coalesce(t > 0, false) then 'Invalid timestamp' when e <= 0 then 'Invalid exchange timestamp' end a"
_ACCEPT = """w as (select *, max(case when a is null and b is null then t end) over (partition by k order by id rows between unbounded preceding and 1 preceding) p from c)
select id as {0}, coalesce(a, case when t <= p then 'Timestamp regression' end, b) as reason, case when a is null and abs(e - t) > 5000 then abs(e - t) end as drift_ms from w"""


@case(f"""with r as (select reading_id id, instrument_key k, epoch_ms(timestamp) t, epoch_ms(exchange_timestamp) e, mark_price m, funding_rate f, next_funding_time n from markprice),
c as (select *, {_TIMES}, case when not coalesce(m > 0 and isfinite(m), false) then 'Invalid mark price' when f is not null and not isfinite(f) then 'Invalid funding rate'
 when n is not null and not (n > 0 and (e is null or n > e)) then 'Invalid next funding time' end b from r), {_ACCEPT.format('reading_id')}""")
def validated_marks(spark, d):
    m = read_table(spark, d, "markprice")
    e = epoch_ms(F.col("exchange_timestamp"))
    out = validation.monotone_verdicts(
        m, key="instrument_key", time=epoch_ms(F.col("timestamp")), exchange=e, rules=validation.mark_rules(F.col("mark_price"), F.col("funding_rate"), F.col("next_funding_time"), e),
        order=["reading_id"], chunk=F.floor(F.col("reading_id") / 100_000),
    )
    return out.select("reading_id", "reason", "drift_ms")


@case(f"""with r as (select book_id id, instrument_key k, epoch_ms(timestamp) t, epoch_ms(exchange_timestamp) e, * from orderbook),
c as (select *, {_TIMES}, case when not (coalesce(len(bids_price), 0) > 0 and coalesce(len(asks_price), 0) > 0) then 'Empty book'
 when not coalesce(best_bid > 0 and isfinite(best_bid) and best_ask > 0 and isfinite(best_ask), false) then 'Invalid best bid/ask' when not coalesce(best_ask > best_bid, false) then 'Crossed book'
 when not coalesce(total_bid_qty > 0 and isfinite(total_bid_qty) and total_ask_qty > 0 and isfinite(total_ask_qty), false) then 'Invalid total qty'
 when not coalesce(isfinite(obi) and obi between -1 and 1, false) then 'OBI out of bounds' end b from r), {_ACCEPT.format('book_id')}""")
def validated_books(spark, d):
    o = read_table(spark, d, "orderbook")
    rules = validation.book_rules(*[F.col(c) for c in ("best_bid", "best_ask", "total_bid_qty", "total_ask_qty", "obi", "bids_price", "asks_price")])
    out = validation.monotone_verdicts(
        o, key="instrument_key", time=epoch_ms(F.col("timestamp")), exchange=epoch_ms(F.col("exchange_timestamp")), rules=rules, order=["book_id"], chunk=F.floor(F.col("book_id") / 100_000)
    )
    return out.select("book_id", "reason", "drift_ms")


@case()
def validated_trades(spark, d):
    """Trades in order of delivery; time and id must rise together, so each instrument is a fold."""
    t = _trades(spark, d).select(
        F.col("instrument_key").alias("key"), F.col("delivery_id").alias("seq"), F.col("delivery_id").alias("row_id"), epoch_ms(F.col("local_receive_ts")).alias("time_ms"),
        epoch_ms(F.col("exchange_event_ts")).alias("exchange_ms"), "price", "quantity", exact.lossless_long(F.col("trade_id")).alias("trade_id"),
    )
    return validation.trade_verdicts(t)


ONE = "BINANCE|linear_perpetual|BTC-USDT|BTCUSDT"


@case(f"""with x as (select case when instrument_key <> '{ONE}' then 'other_instrument' when local_timestamp is null then 'no_time' end loss, epoch_ms(local_timestamp) t from markprice)
select coalesce(loss, case when t < 1756857600000 then 'before' when t >= 1756944000000 then 'after' when t > 1756943940000 then 'trailing' else 'inside' end) as place, count(*) as n from x group by 1""")
def prepared_places(spark, d):
    """What becomes of the mark prices on their way to one instrument's grid of a day of minutes."""
    p = assembly.prepare_stream(read_table(spark, d, "markprice"), "mark", instrument=ONE)
    place = F.coalesce("mark_loss", assembly.day_place(epoch_ms(F.col("mark_ts")), 1_756_857_600_000, 1_756_944_000_000, 60_000))
    return p.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))


@case(f"""with {EV}, f as (select t, qty, value, sgn, {T0} + (t - {T0} + {HOUR} - 1) // {HOUR} * {HOUR} g from e where event_type in ('purchase', 'error') and t >= {T0} and t <= {T0 + 30 * DAY - HOUR}),
o as (select g, t, qty, value, sgn, count(*) c from f group by all)
select g as grid_ts, count(*) as liquidation_count, sum(case when sgn = 1 then qty else 0 end) as liquidation_buy_volume, sum(case when sgn = -1 then qty else 0 end) as liquidation_sell_volume,
 sum(sgn * qty) as liquidation_net_volume, round(sum(qty * value), 6) as liquidation_notional, sum(c - 1)::bigint as liquidation_dup_dropped from o group by 1""")
def liquidation_bars(spark, d):
    e = events(spark, d).where("event_type in ('purchase', 'error')")
    out = assembly.liquidation_bars(
        e, time_ms=F.col("t"), side=F.col("sign"), price="value", quantity="qty", grid_ms=HOUR, start_ms=T0, end_ms=T0 + 30 * DAY, identity=["t", "sign", "value", "qty"]
    )
    return out.withColumn("liquidation_notional", F.round("liquidation_notional", 6))


@case("""select reading_id, round(funding_rate * 10000, 6) as funding_rate_bps, round((next_funding_time - epoch_ms(exchange_timestamp)) / 3600000, 9) as hours_to_funding from markprice""")
def mark_feature_rows(spark, d):
    r = assembly.mark_row(F.col("funding_rate"), F.col("next_funding_time"), epoch_ms(F.col("exchange_timestamp")))
    return read_table(spark, d, "markprice").select("reading_id", F.round(r["funding_rate_bps"], 6).alias("funding_rate_bps"), F.round(r["hours_to_funding"], 9).alias("hours_to_funding"))


_JSON = "case when json_valid(msg) and trim(msg) like '{%' then msg end"


@case(f"""with m as (select item_id, {_JSON} m from ingest_items), r as (select item_id, case when m is null then 'malformed_payload' when m ->> '$.lastUpdateId' is not null or coalesce(m ->> '$.data.e', m ->> '$.e') = 'depthUpdate' then null
 when coalesce(m ->> '$.op', m ->> '$.success', m ->> '$.event', m ->> '$.ret_msg') is not null or (m ->> '$.id' is not null and m ->> '$.data' is null and m ->> '$.e' is null) then 'control_frame' else 'no_route' end as reason,
 coalesce(m ->> '$.stream', m ->> '$.topic', m ->> '$.arg.channel', 'unrouted') as channel from m) select item_id, reason, channel from r where reason is not null""")
def unhandled_frames(spark, d):
    """Frames that give no event, with why; of the test tables' payloads only depth is routed."""
    out = normalize.unhandled(read_table(spark, d, "ingest_items").select(F.col("item_id").alias("frame_id"), F.col("msg").alias("payload")))
    return out.withColumnRenamed("frame_id", "item_id")


@case()
def replay_counters(spark, d):
    """The recorded frames of one venue replayed in total order, and what became of them."""
    i = read_table(spark, d, "ingest_items").where("local_receive_ts is not null")
    log = i.select(F.col("local_receive_ts").alias("ts_ms"), F.col("receive_ns").alias("ns"), F.col("item_id").alias("source_index"), F.when(F.col("is_control"), 1).otherwise(0).alias("kind_rank"),
                   "venue", F.col("msg").alias("payload"), F.col("decode_error").isNull().alias("decode_ok"))
    symbol = F.coalesce(F.get_json_object("payload", "$.data.s"), F.get_json_object("payload", "$.s"))
    log = log.withColumn("ns", F.coalesce("ns", F.lit(-1))).withColumn("instrument_key", F.concat(F.lit("BYBIT|linear_perpetual|"), symbol, F.lit("|"), symbol))
    return replay.counters(replay.replay_frames(replay.ordered(log), venue="BYBIT"))


@case(f"""with k as (select case when {KNOWN} then concat({", ".join(f"length({c}), ':', {c}" for c in IDS)}) end as identity_key, segment_id from trade_events),
a as (select identity_key, min(segment_id) s from k where identity_key is not null and segment_id is not null group by 1), b as (select identity_key, first_segment_id s from seen_trade_ids)
select coalesce(a.identity_key, b.identity_key) as identity_key, case when b.identity_key is null then 'missing_in_index' when a.identity_key is null then 'missing_on_disk' else 'digest_differs' end as reason
from a full join b on a.identity_key = b.identity_key where b.identity_key is null or a.identity_key is null or a.s is distinct from b.s""")
def rebuilt_index_audit(spark, d):
    """The identity index rebuilt from the trades' segments, held against the stored one."""
    made = evidence.rebuilt_index(_trades(spark, d), key=exact.framed_key(*[F.col(c) for c in IDS]), segment="segment_id")
    return evidence.index_audit(made, read_table(spark, d, "seen_trade_ids"), key="identity_key", digest="first_segment_id")


@case("""with v as (select record_id, payload ->> '$.local_timestamp' t from raw_records)
select record_id, case when t is null or lower(trim(t)) in ('null', 'nat') then 'INVALID_LOCAL_RECEIVE_TS_NONE' when lower(trim(t)) in ('true', 'false') then 'INVALID_LOCAL_RECEIVE_TS_BOOL'
 when coalesce(try_cast(t as bigint), epoch_ms(try_cast(t as timestamptz))) is null then 'INVALID_LOCAL_RECEIVE_TS_NON_INT' when coalesce(try_cast(t as bigint), epoch_ms(try_cast(t as timestamptz))) < 0
 then 'INVALID_LOCAL_RECEIVE_TS_NEGATIVE' end as reason from v""")
def receive_time_reasons(spark, d):
    """Why the receive time of a recorded payload can't be used, if so."""
    return read_table(spark, d, "raw_records").select("record_id", receive_time(F.get_json_object("payload", "$.local_timestamp"))["reason"].alias("reason"))
