"""Wire payloads (JSON text) of four venues to canonical events, by the shape of the payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.exact import dec
from tidegrid.operators.neighbours import with_carried

LEVELS = "array<array<string>>"


def _get(path: str) -> Column:
    return F.get_json_object("payload", path)


def route(payload: str = "payload") -> Column:
    """Kind of a payload: depth, snapshot, trade, mark, liquidation, unsupported, or undecodable (no JSON object)."""
    g = lambda p: F.get_json_object(payload, p)
    name = F.lower(F.coalesce(g("$.stream"), g("$.topic"), g("$.arg.channel"), F.lit("")))
    event = F.coalesce(g("$.data.e"), g("$.e"))
    return (
        F.when(~F.coalesce(F.trim(payload).startswith("{"), F.lit(False)) | F.try_parse_json(payload).isNull(), "undecodable")
        .when(g("$.lastUpdateId").isNotNull(), "snapshot")
        .when(event == "depthUpdate", "depth")
        .when(event.isin("aggTrade", "trade"), "trade")
        .when(event == "markPriceUpdate", "mark")
        .when(event == "forceOrder", "liquidation")
        .when(name.contains("trade"), "trades")
        .when(name.contains("orderbook") | name.startswith("books"), "book")
        .when(name.contains("mark-price"), "marks")
        .otherwise("unsupported")
    )


def trades(frames: DataFrame) -> DataFrame:
    """(frame_id, pos, trade_id, price, quantity, price_exact, quantity_exact, side, exchange_ms) of trade payloads.

    frames: frame_id, payload. Payloads with a list of trades give one row each, pos from 0 in the list's order. Prices
    are exact decimals, their text is kept. Undecodable and other payloads give no rows (see ``rejects``).
    """
    kinds = frames.select("frame_id", "payload").withColumn("kind", route())
    d = F.coalesce(_get("$.data"), F.col("payload"))
    one = kinds.where("kind = 'trade'").withColumn("payload", d)
    maker = _get("$.m").try_cast("boolean")
    one = one.select(
        "frame_id", F.lit(0).alias("pos"), F.coalesce(_get("$.a"), _get("$.t")).alias("trade_id"), _get("$.p").alias("p"), _get("$.q").alias("q"),
        F.when(maker, "SELL").when(~maker, "BUY").alias("side"), _get("$.T").try_cast("long").alias("exchange_ms"),
    )
    many = kinds.where("kind = 'trades'").select("frame_id", F.posexplode(F.from_json(_get("$.data"), "array<map<string,string>>")).alias("pos", "r"))
    r = F.col("r")
    many = many.select(
        "frame_id", "pos", F.coalesce(r["tradeId"], r["i"]).alias("trade_id"), F.coalesce(r["px"], r["p"]).alias("p"), F.coalesce(r["sz"], r["v"]).alias("q"),
        F.upper(F.coalesce(r["side"], r["S"])).alias("side"), F.coalesce(r["ts"], r["T"]).try_cast("long").alias("exchange_ms"),
    )
    both = one.unionByName(many)
    return both.select(
        "frame_id", "pos", "trade_id", dec(F.col("p")).alias("price"), dec(F.col("q")).alias("quantity"), F.col("p").alias("price_exact"), F.col("q").alias("quantity_exact"),
        "side", "exchange_ms",
    )


def _channel() -> Column:
    """Lower-case topic, stream or channel a payload names, '' without one."""
    return F.lower(F.coalesce(_get("$.stream"), _get("$.topic"), _get("$.arg.channel"), F.lit("")))


def _taken() -> Column:
    """Which normaliser takes a payload: trades, depth, marks, open_interest or liquidations; Bybit's tickers feed two, so they
    give ``tickers``. Null: none. Follows ``route``, which doesn't name the channels of tickers, funding and open interest."""
    kind, name = F.col("kind"), _channel()
    bybit, okx = _get("$.topic").isNotNull(), _get("$.arg.channel").isNotNull()
    return (
        F.when(kind.isin("trade", "trades"), "trades")
        .when(kind.isin("depth", "snapshot") | (kind == "book") & (bybit & name.startswith("orderbook.") | okx & (name == "books")), "depth")
        .when((kind == "mark") | okx & name.isin("mark-price", "index-tickers", "funding-rate"), "marks")
        .when((kind == "liquidation") | bybit & name.startswith("allliquidation.") | okx & (name == "liquidation-orders"), "liquidations")
        .when(bybit & name.startswith("tickers."), "tickers")
        .when(okx & (name == "open-interest"), "open_interest")
    )


def _frames_for(frames: DataFrame, *takers: str) -> DataFrame:
    """frame_id, payload, kind, by (the normaliser), name (the channel)."""
    kinds = frames.select("frame_id", "payload").withColumn("kind", route())
    return kinds.where(kinds.kind != "undecodable").withColumn("by", _taken()).where(F.col("by").isin(*takers)).withColumn("name", _channel())


def _each(rows: DataFrame, *keep: str) -> DataFrame:
    """One row for each entry of a payload's list ``data`` (pos, payload = the entry)."""
    return rows.select("frame_id", *keep, F.posexplode(F.from_json(_get("$.data"), "array<string>")).alias("pos", "payload"))


def depth(frames: DataFrame) -> DataFrame:
    """Frames for the book fold: frame_id, is_snapshot, update_id, first_id, prev_id, bids, asks, exchange_ms.

    Binance's depthUpdate and REST snapshots, Bybit's orderbook (snapshot, delta) and OKX's books (one row an entry; prevSeqId -1 is
    a snapshot). Levels are price and quantity.
    """
    rows = _frames_for(frames, "depth").where("kind <> 'book'").withColumn("payload", F.coalesce(_get("$.data"), F.col("payload")))
    snap = F.col("kind") == "snapshot"
    long = lambda p: _get(p).try_cast("long")
    levels = lambda p, q: F.from_json(F.coalesce(_get(p), _get(q)), LEVELS)
    binance = rows.select(
        "frame_id", snap.alias("is_snapshot"), F.when(snap, long("$.lastUpdateId")).otherwise(long("$.u")).alias("update_id"), long("$.U").alias("first_id"),
        long("$.pu").alias("prev_id"), levels("$.bids", "$.b").alias("bids"), levels("$.asks", "$.a").alias("asks"), long("$.E").alias("exchange_ms"),
    )
    books = _frames_for(frames, "depth").where("kind = 'book'")
    none = F.lit(None).cast("long")
    bybit = books.where("name <> 'books'").select(
        "frame_id", (F.coalesce(_get("$.type"), F.lit("")) == "snapshot").alias("is_snapshot"), long("$.data.u").alias("update_id"), none.alias("first_id"), none.alias("prev_id"),
        levels("$.data.b", "$.data.bids").alias("bids"), levels("$.data.a", "$.data.asks").alias("asks"), long("$.ts").alias("exchange_ms"),
    )
    two = lambda c: F.transform(c, lambda x: F.slice(x, 1, 2))  # noqa: E731 - OKX adds two fields to a level
    okx = _each(books.where("name = 'books'")).select(
        "frame_id", F.coalesce(long("$.prevSeqId") == -1, F.lit(False)).alias("is_snapshot"), long("$.seqId").alias("update_id"), none.alias("first_id"),
        long("$.prevSeqId").alias("prev_id"), two(levels("$.bids", "$.b")).alias("bids"), two(levels("$.asks", "$.a")).alias("asks"), long("$.ts").alias("exchange_ms"),
    )
    return binance.unionByName(bybit).unionByName(okx)


def marks(frames: DataFrame) -> DataFrame:
    """(frame_id, pos, mark_price, index_price, funding_rate, next_funding_ms, funding_ms, next_funding_rate, exchange_ms) of
    Binance's markPriceUpdate, Bybit's tickers and OKX's mark-price, index-tickers and funding-rate.

    A field the payload doesn't carry is null: values of earlier Bybit tickers are not carried forward, and a ticker without any
    of these fields gives no row.
    """
    rows = _frames_for(frames, "marks", "tickers")
    one = rows.where("kind = 'mark'").select("frame_id", F.lit(0).alias("pos"), F.lit("mark").alias("name"), F.coalesce(_get("$.data"), F.col("payload")).alias("payload"))
    ticker = rows.where("by = 'tickers'").select("frame_id", F.lit(0).alias("pos"), F.lit("tickers").alias("name"), _get("$.ts").alias("at"), _get("$.data").alias("payload"))
    okx = _each(rows.where("kind <> 'mark' and by = 'marks'"), "name")
    every = one.unionByName(okx).withColumn("at", F.lit(None).cast("string")).unionByName(ticker)
    at = lambda **paths: F.coalesce(*[F.when(F.col("name") == k.replace("_", "-"), _get(f"$.{v}")) for k, v in paths.items()])
    long = lambda c: c.try_cast("long")
    out = every.select(
        "frame_id", "pos", dec(at(mark="p", tickers="markPrice", mark_price="markPx")).alias("mark_price"), dec(at(mark="i", tickers="indexPrice", index_tickers="idxPx")).alias("index_price"),
        dec(at(mark="r", tickers="fundingRate", funding_rate="fundingRate")).alias("funding_rate"),
        long(at(mark="T", tickers="nextFundingTime", funding_rate="nextFundingTime")).alias("next_funding_ms"), long(at(funding_rate="fundingTime")).alias("funding_ms"),
        dec(at(funding_rate="nextFundingRate")).alias("next_funding_rate"), long(F.coalesce("at", at(mark="E", mark_price="ts", index_tickers="ts", funding_rate="ts"))).alias("exchange_ms"),
        F.col("name"),
    )
    surfaced = F.coalesce("mark_price", "index_price", "funding_rate", "next_funding_ms").isNotNull()
    return out.where((F.col("name") != "tickers") | surfaced).drop("name")


def open_interest(frames: DataFrame) -> DataFrame:
    """(frame_id, pos, open_interest, unit, in_currency, in_usd, exchange_ms) of Bybit's tickers that carry it (unit UNKNOWN) and
    OKX's open-interest (unit CONTRACTS)."""
    rows = _frames_for(frames, "open_interest", "tickers")
    none = F.lit(None).cast("string")
    bybit = rows.where("by = 'tickers'").select(
        "frame_id", F.lit(0).alias("pos"), _get("$.data.openInterest").alias("v"), F.lit("UNKNOWN").alias("unit"), none.alias("c"), none.alias("u"), _get("$.ts").alias("ts")
    )
    okx = _each(rows.where("by = 'open_interest'")).select(
        "frame_id", "pos", _get("$.oi").alias("v"), F.lit("CONTRACTS").alias("unit"), _get("$.oiCcy").alias("c"), _get("$.oiUsd").alias("u"), _get("$.ts").alias("ts")
    )
    both = bybit.where("v is not null").unionByName(okx)
    return both.select(
        "frame_id", "pos", dec(F.col("v")).alias("open_interest"), "unit", dec(F.col("c")).alias("in_currency"), dec(F.col("u")).alias("in_usd"), F.col("ts").try_cast("long").alias("exchange_ms")
    )


def liquidations(frames: DataFrame) -> DataFrame:
    """(frame_id, pos, part, native, side, price, quantity, exchange_ms) of Binance's forceOrder, Bybit's allLiquidation (one row an
    entry) and OKX's liquidation-orders (one row a detail, part from 0; of all instruments of the push)."""
    rows = _frames_for(frames, "liquidations")
    zero = F.lit(0).alias("part")
    force = rows.where("kind = 'liquidation'").withColumn("payload", F.coalesce(_get("$.data"), F.col("payload"))).select(
        "frame_id", F.lit(0).alias("pos"), zero, _get("$.o.s").alias("native"), _get("$.o.S").alias("side"), _get("$.o.p").alias("p"), _get("$.o.q").alias("q"),
        F.coalesce(_get("$.o.T"), _get("$.E")).alias("ts"),
    )
    bybit = _each(rows.where("kind <> 'liquidation' and name <> 'liquidation-orders'").withColumn("sent", _get("$.ts")), "sent").select(
        "frame_id", "pos", zero, _get("$.s").alias("native"), _get("$.S").alias("side"), _get("$.p").alias("p"), _get("$.v").alias("q"), F.coalesce(_get("$.T"), F.col("sent")).alias("ts")
    )
    okx = _each(rows.where("name = 'liquidation-orders'")).select(
        "frame_id", "pos", _get("$.instId").alias("native"), F.posexplode(F.from_json(_get("$.details"), "array<string>")).alias("part", "payload")
    ).select("frame_id", "pos", "part", "native", _get("$.side").alias("side"), _get("$.bkPx").alias("p"), _get("$.sz").alias("q"), _get("$.ts").alias("ts"))
    every = force.unionByName(bybit).unionByName(okx)
    return every.select(
        "frame_id", "pos", "part", "native", F.upper("side").alias("side"), dec(F.col("p")).alias("price"), dec(F.col("q")).alias("quantity"), F.col("ts").try_cast("long").alias("exchange_ms")
    )


def rejects(frames: DataFrame) -> DataFrame:
    """(reason, frames) of payloads no normaliser takes: undecodable, else the kind ``route`` gives them."""
    kinds = frames.select("payload").withColumn("kind", route()).withColumn("by", _taken())
    return kinds.where("kind = 'undecodable' or by is null").groupBy(F.col("kind").alias("reason")).agg(F.count(F.lit(1)).alias("frames"))


def tickers(frames: DataFrame) -> DataFrame:
    """Bybit's tickers with what earlier ones said: (frame_id, symbol, kind, mark_price, index_price, funding_rate, next_funding_ms,
    open_interest, carried_forward, field_age_ms, exchange_ms).

    frames: frame_id (order of arrival), payload. A snapshot clears what was known; a message gives a ``markprice`` row if it
    carries a mark, index or funding field, and an ``openinterest`` row if it carries that. carried_forward: fields known but
    not in this message; field_age_ms: age of each known field by the exchange's clock, at least 0. Fields never seen are null
    in no list. Messages without any of these fields give no rows.
    """
    rows = _frames_for(frames, "tickers").withColumn("symbol", F.substring_index("name", ".", -1))
    paths = {"markPrice": "markprice", "indexPrice": "markprice", "fundingRate": "markprice", "nextFundingTime": "markprice", "openInterest": "openinterest"}
    at = _get("$.ts").try_cast("long")
    rows = rows.withColumn("at", at).withColumn("snap", F.coalesce(_get("$.type") == "snapshot", F.lit(False)))
    for i, p in enumerate(paths):
        rows = rows.withColumn(f"p{i}", _get(f"$.data.{p}"))
    nothing = F.struct(F.lit(None).cast("string").alias("v"), F.lit(None).cast("long").alias("t"))
    seen = {f"s{i}": F.when(F.col(f"p{i}").isNotNull(), F.struct(F.col(f"p{i}").alias("v"), F.col("at").alias("t"))).when(F.col("snap"), nothing) for i in range(len(paths))}
    rows = with_carried(rows.withColumn("c", F.floor(F.col("frame_id") / 100_000)), ["symbol"], "c", ["frame_id"], seen)
    of = lambda kind: [i for i, k in enumerate(paths.values()) if k == kind]
    names = list(paths)

    def events(kind: str) -> DataFrame:
        own = of(kind)
        known = lambda i: F.col(f"s{i}.v").isNotNull()
        carried = F.array_compact(F.array(*[F.when(known(i) & F.col(f"p{i}").isNull(), F.lit(names[i])) for i in own]))
        age = lambda i: F.greatest(F.col("at") - F.col(f"s{i}.t"), F.lit(0))
        ages = F.map_from_entries(F.array_compact(F.array(*[F.when(known(i) & age(i).isNotNull(), F.struct(F.lit(names[i]), age(i))) for i in own])))
        value = lambda i: F.col(f"s{i}.v") if i in own else F.lit(None).cast("string")
        here = F.coalesce(*[F.col(f"p{i}") for i in own]).isNotNull()
        return rows.where(here).select(
            "frame_id", "symbol", F.lit(kind).alias("kind"), dec(value(0)).alias("mark_price"), dec(value(1)).alias("index_price"), dec(value(2)).alias("funding_rate"),
            value(3).try_cast("long").alias("next_funding_ms"), dec(value(4)).alias("open_interest"), carried.alias("carried_forward"), ages.alias("field_age_ms"), F.col("at").alias("exchange_ms"),
        )

    return events("markprice").unionByName(events("openinterest"))


def unhandled(frames: DataFrame) -> DataFrame:
    """(frame_id, reason, channel) of payloads that give no event: malformed_payload (no JSON object), control_frame (acks, errors,
    pongs), empty_data (a list of none), channel_not_implemented (a channel known by name that no normaliser takes), no_route.
    Each is one row lost; a trade suppressed as a repeat is not (see ``redelivery``)."""
    rows = frames.select("frame_id", "payload").withColumn("kind", route()).withColumn("by", _taken())
    control = F.coalesce(_get("$.op"), _get("$.success"), _get("$.event"), _get("$.ret_msg")).isNotNull() | (_get("$.id").isNotNull() & _get("$.data").isNull() & _get("$.e").isNull())
    reason = (
        F.when(F.col("kind") == "undecodable", "malformed_payload").when(F.col("by").isNotNull(), F.when(_get("$.data") == "[]", "empty_data"))
        .when(control, "control_frame").when(F.col("kind") != "unsupported", "channel_not_implemented").otherwise("no_route")
    )
    name = F.coalesce(_get("$.stream"), _get("$.topic"), _get("$.arg.channel"), F.lit("unrouted"))
    return rows.withColumn("reason", reason).where("reason is not null").select("frame_id", "reason", name.alias("channel"))


def okx_envelope(payload: Column) -> Column:
    """Kind of an OKX frame by its envelope: subscribe_ack, unsubscribe_ack, error, notice, conn_count, data_push or unknown."""
    g = lambda p: F.get_json_object(payload, p)
    event = g("$.event")
    names = {"subscribe": "subscribe_ack", "unsubscribe": "unsubscribe_ack", "error": "error", "notice": "notice", "channel-conn-count": "conn_count", "channel-conn-count-error": "conn_count"}
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), event)
    return F.when(event.isNotNull(), F.coalesce(kind, F.lit("unknown"))).when(g("$.arg").isNotNull() & g("$.data").isNotNull(), "data_push").otherwise("unknown")


def open_interest_body(body: Column, symbol: Column) -> Column:
    """Struct (open_interest, exchange_ms, reason) of a polled response: reason is null, or invalid_json, not_an_object,
    no_open_interest, not_a_number, not_positive, or symbol_contradicts (it names another symbol than was asked for)."""
    g = lambda p: F.get_json_object(body, p)
    value = dec(g("$.openInterest"))
    reason = (
        F.when(F.try_parse_json(body).isNull(), "invalid_json").when(~F.trim(body).startswith("{"), "not_an_object").when(g("$.openInterest").isNull(), "no_open_interest")
        .when(value.isNull(), "not_a_number").when(value <= 0, "not_positive").when(g("$.symbol") != symbol, "symbol_contradicts")
    )
    return F.struct(F.when(reason.isNull(), value).alias("open_interest"), F.when(reason.isNull(), g("$.time").try_cast("long")).alias("exchange_ms"), reason.alias("reason"))


def stamp_instruments(events: DataFrame, instruments: DataFrame) -> DataFrame:
    """events (venue, native, ...) with instrument_key from instruments (venue, native, instrument_key; one a pair). An event that
    brings a key of its own keeps it; another key than the table's is an error when the rows are read. Unknown pairs stay null."""
    known = instruments.select("venue", "native", F.col("instrument_key").alias("_key"))
    own = F.col("instrument_key") if "instrument_key" in events.columns else F.lit(None).cast("string")
    out = events.join(known, ["venue", "native"], "left")
    clash = F.raise_error(F.concat(F.lit("instrument contradicts its adapter: "), own)).cast("boolean")
    out = out.where(F.when(F.coalesce(own != F.col("_key"), F.lit(False)), clash).otherwise(F.lit(True)))
    return out.withColumn("instrument_key", F.coalesce(own, "_key")).drop("_key")
