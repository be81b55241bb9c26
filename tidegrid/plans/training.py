"""Queries of the core operators for training data (problems 1, 2, 4, 5, 6 and 7), and SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.operators import consolidation, drift, gridding, lateness, redelivery, spikes
from tidegrid.session import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _lateness(spark, sf_dir):
    return lateness.arrivals(read_table(spark, sf_dir, "orderbook"), read_table(spark, sf_dir, "ingest_items"))


@query
def p5_found(spark, sf_dir):
    return lateness.late_rows(_lateness(spark, sf_dir))


@query
def p5_minutes(spark, sf_dir):
    return lateness.minute_revisions(_lateness(spark, sf_dir)).where("is_last").drop("is_last", "revision", "published_ms").withColumn(
        "mean_mid", F.round("mean_mid", 7)
    )


@query
def p5_revisions(spark, sf_dir):
    return lateness.minute_revisions(_lateness(spark, sf_dir)).withColumn("mean_mid", F.round("mean_mid", 7))


_P5 = """
with r as (select book_id, instrument_key k, epoch_ms(exchange_timestamp) t, mid_price,
                  epoch_ms(exchange_timestamp) // 60000 * 60000 m, local_receive_ts - (epoch_ms(exchange_timestamp) // 60000 + 1) * 60000 late
           from orderbook left join ingest_items on ingest_item_id = item_id)
"""
ORACLE["p5_found"] = _P5 + "select book_id, case when late <= 600000 then 'corrects' else 'too_late' end as verdict from r where late > 5000"
ORACLE["p5_minutes"] = _P5 + """
select k as instrument_key, m as minute_ms, count(*) as n_rows, arg_min(mid_price, (t, book_id)) as open_mid, max(mid_price) as high_mid,
       min(mid_price) as low_mid, arg_max(mid_price, (t, book_id)) as close_mid, round(sum(mid_price) / count(*), 7) as mean_mid
from r where late <= 600000 and k is not null and mid_price is not null and not isnan(mid_price) group by all"""


ORACLE["p5_revisions"] = _P5 + """, u as (select *, case when late <= 5000 then 0 else (late - 5000 + 59999) // 60000 end tick from r
  where late <= 600000 and k is not null and mid_price is not null and not isnan(mid_price)),
ticks as (select distinct k, m, tick from u),
p as (select ticks.k, ticks.m, ticks.tick, count(*) n, arg_min(mid_price, (t, book_id)) a, max(mid_price) h, min(mid_price) lo, arg_max(mid_price, (t, book_id)) z,
             round(sum(mid_price) / count(*), 7) mean from ticks join u on u.k = ticks.k and u.m = ticks.m and u.tick <= ticks.tick group by all)
select k as instrument_key, m as minute_ms, (row_number() over (partition by k, m order by tick) - 1)::int as revision, m + 65000 + tick * 60000 as published_ms, n as n_rows,
       a as open_mid, h as high_mid, lo as low_mid, z as close_mid, mean as mean_mid, tick = max(tick) over (partition by k, m) as is_last from p"""


def _grid(spark, sf_dir):
    marks = gridding.usable_readings(
        read_table(spark, sf_dir, "markprice"), series="markprice", id_col="reading_id", time_ms=F.unix_millis("local_timestamp")
    )
    states = gridding.usable_readings(
        read_table(spark, sf_dir, "price_states"), series="price_states", id_col="state_id", time_ms=F.col("observation_ts")
    )
    return gridding.regular_grid(marks.unionByName(states), step_ms=30_000)


@query
def p7_found(spark, sf_dir):
    return gridding.empty_steps(_grid(spark, sf_dir))


@query
def p7_grid(spark, sf_dir):
    return _grid(spark, sf_dir).withColumn("value", F.round("value", 7)).withColumn("coverage", F.round("coverage", 9))


_P7 = """
with u as (select 'markprice' as series, instrument_key, epoch_ms(local_timestamp) t, reading_id id, mark_price v from markprice
           union all select 'price_states', instrument_key, observation_ts, state_id, mark_price from price_states),
ok as (select * from u where instrument_key is not null and t is not null and v > 0 and isfinite(v)),
one as (select series, instrument_key, t, t // 86400000 as d, arg_max(v, id) v, count(*) n from ok group by all),
span as (select series, instrument_key, d, min(t) // 30000 lo, max(t) // 30000 hi from one group by all),
cell as (select series, instrument_key, d, unnest(range(lo, hi + 1)) c from span),
"""
ORACLE["p7_found"] = _P7 + """
had as (select distinct series, instrument_key, t // 30000 c from one)
select series, instrument_key, c * 30000 as step_start_ms from cell anti join had using (series, instrument_key, c)"""
ORACLE["p7_grid"] = _P7 + """
iv as (select *, coalesce(lead(t) over (partition by series, instrument_key, d order by t), (t // 30000 + 1) * 30000) until from one),
x as (select cell.series, cell.instrument_key, c, v, n, t, greatest(t, c * 30000) a, least(until, (c + 1) * 30000) b
      from cell join iv on cell.series = iv.series and cell.instrument_key = iv.instrument_key and cell.d = iv.d
       and iv.t < (c + 1) * 30000 and iv.until > c * 30000)
select series, instrument_key, c * 30000 as step_start_ms, sum(case when t // 30000 = c then n else 0 end) as n_readings,
       round(sum(v * (b - a)) / sum(b - a), 7) as value, round(sum(greatest(least(b, t + 60000) - a, 0)) / 30000, 9) as coverage,
       sum(case when t // 30000 = c then n else 0 end) = 0 as filled
from x group by series, instrument_key, c"""


def _p4(spark, sf_dir):
    trades = read_table(spark, sf_dir, "trade_events")
    return trades, read_table(spark, sf_dir, "seen_trade_ids"), {
        "identity": redelivery.trade_identity(trades), "time_ms": F.unix_millis("local_receive_ts"), "seen_bucket": F.floor(F.col("first_segment_id") / 256)
    }


@query
def p4_found(spark, sf_dir):
    trades, seen, how = _p4(spark, sf_dir)
    return redelivery.repeated_deliveries(trades, seen, **how).select("delivery_id")


@query
def p4_kept(spark, sf_dir):
    trades, seen, how = _p4(spark, sf_dir)
    return redelivery.first_deliveries(trades, seen, **how).select("delivery_id", "exchange", "instrument_key", "trade_id", "price", "quantity")


_P4 = r"""
with t as (select *, lower(regexp_replace(trade_id, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')) i from trade_events),
k as (select *, case when i <> '' then concat(length(exchange), ':', exchange, length(market_type), ':', market_type,
        length(coalesce(instrument_key, '')), ':', coalesce(instrument_key, ''), length(stream), ':', stream, length(i), ':', i) end as key from t),
n as (select *, row_number() over (partition by key order by local_receive_ts, delivery_id) rn from k),
f as (select delivery_id from n where key is not null and (rn > 1 or key in (select identity_key from seen_trade_ids)))
"""
ORACLE["p4_found"] = _P4 + "select delivery_id from f"
ORACLE["p4_kept"] = _P4 + "select delivery_id, exchange, instrument_key, trade_id, price, quantity from trade_events anti join f using (delivery_id)"


@query
def p6_found(spark, sf_dir):
    return drift.changes(read_table(spark, sf_dir, "raw_records"))


@query
def p6_lifespans(spark, sf_dir):
    return drift.lifespans(drift.fields(read_table(spark, sf_dir, "raw_records")))


@query
def p6_trades(spark, sf_dir):
    return drift.one_table(read_table(spark, sf_dir, "raw_records"), "trades").drop("extra")


@query
def p6_orderbook(spark, sf_dir):
    return drift.one_table(read_table(spark, sf_dir, "raw_records"), "orderbook").drop("extra")


def _alias_values() -> str:
    pairs = [(alias, name) for name, (_, others) in drift.ALIASES.items() for alias in (name, *others)]
    return ", ".join(f"('{alias}', '{name}')" for alias, name in pairs)


_P6 = """
with f as (select collector_run, stream, segment_seq, k.field, payload -> ('$."' || k.field || '"') as v
           from (select *, unnest(json_keys(payload)) as field from raw_records) k),
t as (select collector_run, stream, segment_seq, field, case json_type(v) when 'VARCHAR' then 'text' when 'BOOLEAN' then 'boolean'
             when 'ARRAY' then 'list' when 'OBJECT' then 'object' else 'number' end as type, count(*) n
      from f where v is not null and json_type(v) <> 'NULL' group by all)"""

# names unknown to the alias table aren't matched here: the test tables' renames are all in it
ORACLE["p6_found"] = _P6 + f""", al(field, family) as (values {_alias_values()}),
h as (select collector_run r, stream s, segment_seq q, field, string_agg(type, '+' order by type) types from t group by all),
seg as (select distinct r, s, q from h), cmp as (select a.r, a.s, a.q from seg a join seg b on a.r = b.r and a.s = b.s and a.q = b.q + 1),
now as (select cmp.*, field, types from cmp join h using (r, s, q)), old as (select cmp.*, field, types from cmp join h on h.r = cmp.r and h.s = cmp.s and h.q = cmp.q - 1),
starts as (select now.*, family from now anti join old using (r, s, q, field) left join al using (field)),
ends as (select old.*, family from old anti join now using (r, s, q, field) left join al using (field)),
ren as (select a.r, a.s, a.q, a.field old_name, b.field new_name from ends a join starts b using (r, s, q, family, types))
select r as collector_run, s as stream, q as segment_seq, 'retyped' as change_kind, field as old_name, field as new_name from now join old using (r, s, q, field) where now.types <> old.types
union all select r, s, q, 'renamed', old_name, new_name from ren
union all select r, s, q, 'added', '', field from starts anti join ren on starts.r = ren.r and starts.s = ren.s and starts.q = ren.q and field = new_name
union all select r, s, q, 'removed', field, '' from ends anti join ren on ends.r = ren.r and ends.s = ren.s and ends.q = ren.q and field = old_name"""


def _one_table_sql(stream: str) -> str:
    def column(name: str) -> str:
        kind, others = drift.ALIASES[name]
        x = "coalesce(" + ", ".join(f"payload ->> '$.\"{n}\"'" for n in (name, *others)) + ")"
        return {
            "time": f"coalesce(try_cast({x} as bigint), trunc(try_cast({x} as double))::bigint, epoch_ms(try_cast({x} as timestamptz)))",
            "flag": f"coalesce(try_cast({x} as boolean), try_cast({x} as double) <> 0)",
            "key": f"case when {x} like '[%' then array_to_string(try_cast(try_cast({x} as json) as varchar[]), '|') else {x} end",
            "doubles": f"try_cast(try_cast({x} as json) as double[])",
            "long": f"coalesce(try_cast({x} as bigint), trunc(try_cast({x} as double))::bigint)",
            "string": x,
            "double": f"try_cast({x} as double)",
        }[kind] + f" as {name}"

    columns = ",\n ".join(column(n) for n in drift.STREAM_FIELDS[stream])
    return f"select record_id, collector_run, segment_seq, row_no, {columns} from raw_records where stream = '{stream}'"


ORACLE["p6_trades"] = _one_table_sql("trades")


@query
def p6_orderbook_flat(spark, sf_dir):
    """``p6_orderbook`` with each list as its number of levels and their sum."""
    out = drift.one_table(read_table(spark, sf_dir, "raw_records"), "orderbook").drop("extra")
    for c in ("bids_price", "bids_qty", "asks_price", "asks_qty"):
        total = F.aggregate(c, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
        out = out.withColumn(f"{c}_levels", F.when(F.col(c).isNotNull(), F.size(c))).withColumn(f"{c}_sum", F.round(total, 5)).drop(c)
    return out


_LISTS = ("bids_price", "bids_qty", "asks_price", "asks_qty")
ORACLE["p6_orderbook_flat"] = (
    f"with o as ({_one_table_sql('orderbook')}) select * exclude ({', '.join(_LISTS)}), "
    + ", ".join(f"len({c})::int as {c}_levels, case when {c} is not null then round(coalesce(list_sum({c}), 0), 5) end as {c}_sum" for c in _LISTS)
    + " from o"
)
ORACLE["p6_lifespans"] = _P6 + """,
i as (select *, segment_seq - row_number() over (partition by collector_run, stream, field, type order by segment_seq) g from t)
select collector_run, stream, field, type, min(segment_seq) as first_seg, max(segment_seq) as last_seg, sum(n) as n
from i group by collector_run, stream, field, type, g"""


def _scores(spark, sf_dir):
    states = read_table(spark, sf_dir, "price_states")
    readings = spikes.long_readings(
        states, id_col="state_id", source=F.col("instrument_key"), time_ms=F.col("observation_ts"), fields=["last_trade_price", "mark_price"]
    )
    return spikes.score_readings(readings).withColumnRenamed("id", "state_id")


@query
def p1_found(spark, sf_dir):
    return _scores(spark, sf_dir).where("reason is not null").select("state_id", "field_name")


@query
def p1_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


def _consolidated(spark, sf_dir):
    return consolidation.consolidated_in_scratch(read_table(spark, sf_dir, "hour_sources"), read_table(spark, sf_dir, "segment_rows"))


@query
def p2_found(spark, sf_dir):
    return _consolidated(spark, sf_dir)[1].select("file_id")


@query
def p2_consolidated(spark, sf_dir):
    return _consolidated(spark, sf_dir)[0].select("stream", "record_key")


_P2 = """
with fin as (select * from hour_sources where path like '%.seg' or path like '%.parquet'),
k as (select distinct f.file_id, f.stream, record_key from fin f join segment_rows s on f.file_id = s.file_id where record_key is not null),
n as (select file_id, stream, count(*) n from k group by all),
shared as (select a.file_id a, b.file_id b, count(*) c from k a join k b on a.stream = b.stream and a.record_key = b.record_key
           and a.file_id <> b.file_id group by all)
"""
ORACLE["p2_found"] = _P2 + """
select file_id from hour_sources where file_id not in (select file_id from fin)
union all select file_id from fin where file_id not in (select file_id from segment_rows)
union all select distinct a from shared join n x on x.file_id = a join n y on y.file_id = b
where c = x.n and (y.n > x.n or (y.n = x.n and b < a))"""
ORACLE["p2_consolidated"] = _P2 + "select distinct stream, record_key from k"
