"""Order-book features as column expressions over best-first ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEPTH = 10


def total(quantities: Column, levels: int = DEPTH) -> Column:
    return F.aggregate(F.slice(quantities, 1, levels), F.lit(0.0), lambda a, x: a + x)


def imbalance(bids: Column, asks: Column, levels: int, *, need: bool = True) -> Column:
    """(bid - ask) / (bid + ask) over the best levels; null if ``need`` and a side has fewer; 0 where both are 0."""
    b, a = total(bids, levels), total(asks, levels)
    value = F.when(b + a != 0, (b - a) / (b + a)).otherwise(0.0)
    return F.when((F.size(bids) >= levels) & (F.size(asks) >= levels), value) if need else value


def features(bid_px: Column, bid_qty: Column, ask_px: Column, ask_qty: Column) -> dict[str, Column]:
    """The feature columns of a two-sided book; all null for one-sided, empty or weightless ones."""
    bb, ba, bq, aq = (F.try_element_at(c, F.lit(1)) for c in (bid_px, ask_px, bid_qty, ask_qty))
    mid = (bb + ba) / 2
    tb, ta = total(bid_qty), total(ask_qty)
    ok = bb.isNotNull() & ba.isNotNull() & (mid != 0) & (bq + aq != 0) & (tb + ta != 0)
    out = {
        "best_bid": bb,
        "best_ask": ba,
        "mid_price": mid,
        "micro_price": F.try_divide(bb * aq + ba * bq, bq + aq),
        "spread": ba - bb,
        "spread_bps": F.try_divide(ba - bb, mid) * 10_000,
        "total_bid_qty": tb,
        "total_ask_qty": ta,
        "obi": F.try_divide(tb - ta, tb + ta),
        "obi_level_1": imbalance(bid_qty, ask_qty, 1, need=False),
        "obi_level_3": imbalance(bid_qty, ask_qty, 3),
        "obi_level_5": imbalance(bid_qty, ask_qty, 5),
        "bid_depth": F.least(F.size(bid_px), F.lit(DEPTH)),
        "ask_depth": F.least(F.size(ask_px), F.lit(DEPTH)),
    }
    return {name: F.when(ok, c) for name, c in out.items()}


def strictly(ladder: Column, falling: bool) -> Column:
    """Whether a ladder falls (or rises) strictly from level to level."""
    steps = F.zip_with(F.slice(ladder, 1, F.greatest(F.size(ladder) - 1, F.lit(0))), F.slice(ladder, 2, F.greatest(F.size(ladder), F.lit(1))), lambda a, b: (a > b) if falling else (a < b))
    return F.when(F.size(ladder) < 2, True).otherwise(F.forall(steps, lambda x: x))


def untrusted_reason(bid_px: Column, bid_qty: Column, ask_px: Column, ask_qty: Column) -> Column:
    """The first reason not to trust a book, or null."""
    empty = F.coalesce(F.size(bid_px), F.lit(0)) <= 0
    positive = lambda c: F.forall(c, lambda x: F.coalesce((x > 0) & (x < float("inf")) & ~F.isnan(x), F.lit(False)))
    return (
        F.when(empty | (F.coalesce(F.size(ask_px), F.lit(0)) <= 0), "empty_side")
        .when((F.size(bid_px) != F.size(bid_qty)) | (F.size(ask_px) != F.size(ask_qty)), "malformed_levels")
        .when(~(positive(bid_px) & positive(ask_px) & positive(bid_qty) & positive(ask_qty)), "non_positive_level")
        .when(~strictly(bid_px, True), "bids_not_descending")
        .when(~strictly(ask_px, False), "asks_not_ascending")
        .when(F.element_at(bid_px, 1) >= F.element_at(ask_px, 1), "crossed_or_locked")
    )


def fisher(x: Column, clip: float = 0.9999) -> Column:
    """Inverse hyperbolic tangent of x clipped to +-clip; null stays null."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.atanh(F.greatest(F.least(x, F.lit(clip)), F.lit(-clip))))


def signed_side(side: Column, *, short: bool = False) -> Column:
    """+1 for buys, -1 for sells, null for unknown. ``short``: b and s count too (in any case), else only BUY and SELL."""
    name = F.upper(side)
    buys, sells = (["BUY", "B"], ["SELL", "S"]) if short else (["BUY"], ["SELL"])
    return F.when(name.isin(buys), 1).when(name.isin(sells), -1)
