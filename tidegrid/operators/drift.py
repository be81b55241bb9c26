"""Schemas that drift between files (problem 6): a catalogue of field lifespans, a log of changes, one table per stream.

The records' own top level stands for a file's footer: it is exploded to (producer, stream, segment, field, type) with a
profile of the content. Islands of neighbouring segments per producer, field and type are the catalogue of lifespans. All
changes are read off it: where all of a field's lifespans end it is removed, where the first of them starts it is added, where
they change it is retyped; a start and an end in one segment are a rename where type, kind of content and, by the alias
table, name agree. Casts for the one table per stream are made from the alias table, which is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.session import add_package, materialize

#: Canonical field: (type in the one table, other names it goes by).
ALIASES: dict[str, tuple[str, tuple[str, ...]]] = {
    "instrument_key": ("key", ("inst_key", "instrument", "instrumentKey", "symbol_key")),
    "bid_depth": ("long", ("bidDepth", "bids_depth", "depth_bid", "n_bids")),
    "ask_depth": ("long", ("askDepth", "asks_depth", "depth_ask", "n_asks")),
    "timestamp": ("time", ()),
    "exchange_timestamp": ("time", ("E", "event_ts", "exchangeTimestamp")),
    "local_timestamp": ("time", ("localTimestamp", "recv_ts")),
    "trade_id": ("string", ("tid", "tradeId")),
    "price": ("double", ("px", "trade_price")),
    "quantity": ("double", ("qty", "sz")),
    "price_exact": ("string", ()),
    "quantity_exact": ("string", ()),
    "is_buyer_maker": ("flag", ("buyer_is_maker",)),
    "side_sign": ("long", ()),
    "signed_qty": ("double", ()),
    "block_trade": ("flag", ()),
    "venue_sequence": ("long", ()),
    "connection_id": ("string", ()),
    "best_bid": ("double", ("bid", "bestBid")),
    "best_ask": ("double", ("ask", "bestAsk")),
    "mid_price": ("double", ("mid", "midPrice")),
    "spread": ("double", ()),
    "bids_price": ("doubles", ("bidPx",)),
    "bids_qty": ("doubles", ("bidQty",)),
    "asks_price": ("doubles", ("askPx",)),
    "asks_qty": ("doubles", ("askQty",)),
    "update_id": ("long", ("updateId",)),
    "is_snapshot": ("flag", ("isSnapshot",)),
    "quality_state": ("string", ("qualityState",)),
}
STREAM_FIELDS = {
    "trades": ("timestamp", "exchange_timestamp", "local_timestamp", "trade_id", "price", "quantity", "is_buyer_maker", "side_sign", "signed_qty",
               "instrument_key", "price_exact", "quantity_exact", "block_trade", "venue_sequence", "connection_id"),
    "orderbook": ("timestamp", "exchange_timestamp", "local_timestamp", "bids_price", "bids_qty", "asks_price", "asks_qty", "best_bid", "best_ask",
                  "mid_price", "spread", "instrument_key", "bid_depth", "ask_depth", "update_id", "is_snapshot", "quality_state"),
}
#: What values may look like.
KINDS = ("flag", "key", "time", "whole", "broken", "word")
PRODUCER = ["collector_run", "stream"]


def alias_table(names: DataFrame) -> dict[str, tuple[str, tuple[str, ...]]]:
    """The alias table of rows (canonical, type, alias): one of each name; a null alias adds only the canonical field. It is a
    setting: more than 10,000 rows are refused."""
    rows = names.select("canonical", "type", "alias").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 aliases")
    kinds = {r.canonical: r.type for r in rows if r.canonical is not None}
    return {c: (t, tuple(sorted({r.alias for r in rows if r.canonical == c and r.alias is not None} - {c}))) for c, t in kinds.items()}


def fields(records: DataFrame) -> DataFrame:
    """(collector_run, stream, segment_seq, field, type, n, kind, shape, scale) of each segment: a field is there if a record
    holds it non-null.

    kind: what the values look like (a time, an instrument, a whole or a broken number, a word, ...). shape, scale:
    the commonest pattern of the text and the mean magnitude, to tell fields of one kind apart. Payloads that aren't a
    JSON object, and records without run, stream or segment, have no fields.
    """
    rows = records.where(F.col("collector_run").isNotNull() & F.col("stream").isNotNull() & F.col("segment_seq").isNotNull())
    parsed = rows.select("collector_run", "stream", "segment_seq", F.explode(F.from_json("payload", "map<string,variant>")).alias("field", "v"))
    parsed = parsed.where(F.col("v").isNotNull() & ~F.is_variant_null("v"))
    text = F.col("v").cast("string")
    kind_of = F.schema_of_variant("v")
    parsed = parsed.withColumn("text", text).withColumn(
        "type",
        F.when(kind_of.startswith("ARRAY"), "list")
        .when(kind_of.startswith("OBJECT"), "object")
        .when(kind_of == "STRING", "text")
        .when(kind_of == "BOOLEAN", "boolean")
        .otherwise("number"),
    )
    first = F.when(F.col("type") == "list", F.regexp_extract("text", r'^\[\s*"?([^",\]]*)', 1)).otherwise(F.col("text"))
    number = F.expr("try_cast(_first as double)")
    parsed = parsed.withColumn("_first", first)
    kind = (
        F.when(F.col("type") == "boolean", "flag")
        .when(F.col("text").contains("|") | (F.col("type") == "list") & number.isNull(), "key")
        .when(F.col("_first").rlike(r"^\d{4}-\d\d-\d\dT"), "time")
        .when(number.between(1e12, 1e13), "time")
        .when(number.isNotNull(), F.when(F.col("_first").rlike(r"^-?\d+$"), "whole").otherwise("broken"))
        .otherwise("word")
    )
    shape = F.substring(F.regexp_replace(F.regexp_replace("_first", r"\d+", "9"), r"\p{L}+", "a"), 1, 40)
    parsed = parsed.withColumn("kind", kind).withColumn("shape", shape).withColumn("scale", F.log10(F.abs(number) + 1e-9))
    keys = ["collector_run", "stream", "segment_seq", "field", "type"]
    alike = parsed.groupBy(*keys, "kind", "shape").agg(F.count(F.lit(1)).alias("c"), F.sum("scale").alias("s"), F.count("scale").alias("m"))
    by_kind = [F.struct(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("c"))), F.lit(0)).alias("c"), F.lit(k).alias("k")) for k in KINDS]
    return alike.groupBy(*keys).agg(
        F.sum("c").alias("n"), F.greatest(*by_kind)["k"].alias("kind"), F.max_by("shape", F.struct("c", "shape")).alias("shape"), F.try_divide(F.sum("s"), F.sum("m")).alias("scale")
    )


def _catalogue(found: DataFrame) -> DataFrame:
    """``lifespans`` with what the field looked like in the first and the last segment of each."""
    w = Window.partitionBy(*PRODUCER, "field", "type").orderBy("segment_seq")
    island = found.withColumn("island", F.col("segment_seq") - F.row_number().over(w))
    look = F.struct("n", "type", "kind", "shape", "scale")
    return island.groupBy(*PRODUCER, "field", "type", "island").agg(
        F.min("segment_seq").alias("first_seg"), F.max("segment_seq").alias("last_seg"), F.sum("n").alias("total"),
        F.min_by(look, "segment_seq").alias("first_look"), F.max_by(look, "segment_seq").alias("last_look"),
    ).drop("island")


def lifespans(found: DataFrame) -> DataFrame:
    """The catalogue: (collector_run, stream, field, type, first_seg, last_seg, n), one row per island of neighbouring segments."""
    return _catalogue(found).select(*PRODUCER, "field", "type", "first_seg", "last_seg", F.col("total").alias("n"))


def _family(aliases: dict) -> dict[str, str]:
    return {alias: name for name, (_, others) in aliases.items() for alias in (name, *others)}


def _named(at: tuple, rows: list, family: dict[str, str]) -> list[tuple]:
    """The changes of one segment: starts and ends matched to renames where each is the other's best, all else added, removed or retyped."""
    out, starts, ends = [], [], []
    for r in rows:
        if r.before and r.now:
            out.append(("retyped", r.field, r.field))
        else:
            (starts if r.now else ends).append(r)

    def score(old, new):
        if old.types != new.types:
            return None
        a, b = family.get(old.field), family.get(new.field)
        known = a is not None and b is not None
        far = abs(old.scale - new.scale) if old.scale == old.scale and new.scale == new.scale and None not in (old.scale, new.scale) else 0.0
        alike = old.kind == new.kind and far < 0.5 and (old.kind != "word" or old.shape == new.shape)
        if a != b if known else not alike:
            return None
        return (not known, old.shape != new.shape, far, old.field, new.field)

    pairs = [(s, o.field, n.field) for o in ends for n in starts if (s := score(o, n)) is not None]
    best_old = {o: min(p for p in pairs if p[1] == o) for _, o, _ in pairs}
    best_new = {n: min(p for p in pairs if p[2] == n) for _, _, n in pairs}
    renamed = {p[1]: p[2] for p in pairs if best_old[p[1]] == p == best_new[p[2]]}
    out += [("renamed", o, n) for o, n in renamed.items()]
    out += [("removed", o.field, "") for o in ends if o.field not in renamed]
    out += [("added", "", n.field) for n in starts if n.field not in renamed.values()]
    return [(*at, *row) for row in out]


def changes(records: DataFrame, aliases: dict | None = None) -> DataFrame:
    """(collector_run, stream, segment_seq, change_kind, old_name, new_name) of each segment against the one before it.

    A segment whose predecessor has no records is compared with nothing. Renames are matched one to one within a segment
    and type: first names of one canonical field in the alias table, then, where a name is unknown to it, equal kinds of
    content of like shape and magnitude. What isn't matched is added or removed. A field of several types in a segment
    is retyped when its set of types changes. A segment's starts and ends, at most its fields, are matched in one place; segments stream through it.
    """
    add_package(records.sparkSession)
    family = _family(ALIASES if aliases is None else aliases)
    found = materialize(fields(records), "fields")
    spans = _catalogue(found)
    edge = lambda seg, look, start: F.struct(seg.cast("int").alias("segment_seq"), F.lit(start).alias("start"), F.col(look).alias("look"))
    edges = F.array(edge(F.col("first_seg"), "first_look", 1), edge(F.col("last_seg") + 1, "last_look", 0))
    at = spans.select(*PRODUCER, "field", F.explode(edges).alias("e")).select(*PRODUCER, "field", "e.*")
    at = at.groupBy(*PRODUCER, "field", "segment_seq").agg(
        F.sum("start").alias("starts"), F.sum(1 - F.col("start")).alias("ends"), F.max("look").alias("look"), F.concat_ws("+", F.array_sort(F.collect_set("look.type"))).alias("types")
    )
    # lifespans of the field that hold this segment, and those that hold the one before
    alive = F.sum(F.col("starts") - F.col("ends")).over(Window.partitionBy(*PRODUCER, "field").orderBy("segment_seq"))
    at = at.withColumn("now", alive).withColumn("before", F.col("now") - F.col("starts") + F.col("ends"))
    segments = found.select(*PRODUCER, "segment_seq").distinct()
    compared = segments.join(segments.select(*PRODUCER, (F.col("segment_seq") + 1).alias("segment_seq")), [*PRODUCER, "segment_seq"], "left_semi")
    at = at.join(compared, [*PRODUCER, "segment_seq"], "left_semi").select(*PRODUCER, "segment_seq", "field", "now", "before", "types", "look.kind", "look.shape", "look.scale")
    schema = "collector_run long, stream string, segment_seq int, change_kind string, old_name string, new_name string"

    def named(batches):
        import pandas as pd

        place, held = None, []
        columns = [c.split()[0] for c in schema.split(", ")]
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                if r[:3] != place:
                    out += _named(place, held, family) if held else []
                    place, held = r[:3], []
                held.append(r)
            yield pd.DataFrame(out, columns=columns)
        if held:
            yield pd.DataFrame(_named(place, held, family), columns=columns)

    by = [*PRODUCER, "segment_seq"]
    return at.repartition(*by).sortWithinPartitions(*by, "field").mapInPandas(named, schema)


def _cast(kind: str, text: Column) -> Column:
    """The cast of a field's JSON text (unquoted) into the one table's type."""
    if kind == "time":  # epoch ms, or ISO text
        return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"), F.unix_millis(text.try_cast("timestamp")))
    if kind == "flag":
        return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)
    if kind == "key":  # a text, or a list of its parts
        parts = F.from_json(text, "array<string>")
        return F.when(text.startswith("["), F.array_join(parts, "|")).otherwise(text)
    if kind == "doubles":
        return F.from_json(text, "array<double>")
    if kind == "long":
        return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))
    return text if kind == "string" else text.try_cast(kind)


def one_table(records: DataFrame, stream: str, aliases: dict | None = None, stream_fields: dict | None = None) -> DataFrame:
    """All records of a stream in one schema: record_id, collector_run, segment_seq, row_no, then the stream's fields.

    Of several names of one field in a record the first in the alias table that is non-null counts. What can't be cast
    is null, as is everything of a payload that is no JSON object. Fields unknown to the alias table are left to ``extra``,
    a map of their texts.
    """
    aliases = ALIASES if aliases is None else aliases
    rows = records.where(F.col("stream") == stream).withColumn("_m", F.from_json("payload", "map<string,string>"))
    columns = []
    known: list[str] = []
    for name in (STREAM_FIELDS if stream_fields is None else stream_fields)[stream]:
        kind, others = aliases[name]
        known += [name, *others]
        columns.append(_cast(kind, F.coalesce(*[F.col("_m")[x] for x in (name, *others)])).alias(name))
    names = F.array(*[F.lit(x) for x in known])
    extra = F.map_filter("_m", lambda k, v: ~F.array_contains(names, k) & v.isNotNull())
    return rows.select("record_id", "collector_run", "segment_seq", "row_no", *columns, extra.alias("extra"))
