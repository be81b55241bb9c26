"""Queries of the llm operators, and the SQL that DuckDB can run for them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.llm import mixing, nearest, pieces, tokens
from tidegrid.session import read_table


def p8_ids(spark, sf_dir):
    return tokens.encode_documents(read_table(spark, sf_dir, "documents"))


def p9_mix(spark, sf_dir):
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets"))


def p9_shares(spark, sf_dir):
    return mixing.mix_shares(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "mix_targets"))


def p10_pieces(spark, sf_dir):
    return pieces.split_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "piece_policies"))


QUERIES = {"p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_pieces": p10_pieces}

ORACLE: dict[str, str] = {}


def _flow_books(spark, sf_dir):
    return nearest.nearest_pairs(
        read_table(spark, sf_dir, "windowed_trade_flow"),
        read_table(spark, sf_dir, "orderbook"),
        left_id="observation_id", left_key=nearest.entity_name(F.col("instrument_key")), left_ms=F.col("observation_ts"),
        right_id="book_id", right_key=nearest.entity_name(F.col("instrument_key")), right_ms=F.unix_millis("local_timestamp"),
        tolerance_ms=5_000,
    )


def p3_found(spark, sf_dir):
    return _flow_books(spark, sf_dir).select("observation_id", "book_id")


def p3_pairs(spark, sf_dir):
    return _flow_books(spark, sf_dir)


QUERIES |= {"p3_found": p3_found, "p3_pairs": p3_pairs}

_P3 = """
with l as (select observation_id, lower(trim(instrument_key, ' \t\n\r' || chr(160))) k, observation_ts t
           from windowed_trade_flow where observation_ts is not null and instrument_key is not null),
r as (select book_id, lower(trim(instrument_key, ' \t\n\r' || chr(160))) k, epoch_ms(local_timestamp) t
      from orderbook where local_timestamp is not null and instrument_key is not null),
m as (select observation_id, book_id, abs(r.t - l.t) distance_ms,
             row_number() over (partition by observation_id order by abs(r.t - l.t), r.t, book_id) n
      from l join r on l.k = r.k and r.t between l.t - 5000 and l.t + 5000)
"""
ORACLE |= {
    "p3_found": _P3 + "select observation_id, book_id from m where n = 1",
    "p3_pairs": _P3 + "select observation_id, book_id, distance_ms from m where n = 1",
}
