"""Exact decimals and identity text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"


def dec(text: Column) -> Column:
    """Exact decimal of a text; null for blank, malformed, NaN and infinite ones. Texts beyond (38,18) are null as well:
    the text itself remains the evidence."""
    plain = F.trim(text)
    return F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), plain.try_cast(DECIMAL))


def number_or_null(text: Column) -> Column:
    """A number, or null (never 0) for an empty text."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double")


def numeric_id(text: Column) -> Column:
    """Whether an id is a whole number as text: blanks around, a sign and single underscores between digits are allowed."""
    return text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$")


def lossless_long(text: Column) -> Column:
    """A bigint only if its decimal text is the text given (no sign, no leading zeros, in range)."""
    value = text.try_cast("long")
    return F.when(text.rlike("^[0-9]+$") & (value.cast("string") == text), value)


def framed_key(*parts: Column) -> Column:
    """``<length>:<value>`` of each part in turn; lengths in code points; null if a part is null."""
    return F.concat(*[F.concat(F.length(p.cast("string")).cast("string"), F.lit(":"), p.cast("string")) for p in parts])


def make_instrument(exchange: Column, market: Column, base: Column, quote: Column, native: Column) -> Column:
    return F.concat(exchange, F.lit("|"), market, F.lit("|"), base, F.lit("-"), quote, F.lit("|"), native)


def parse_instrument(key: Column) -> Column:
    """Struct of the parts of EXCHANGE|market|BASE-QUOTE|native with state: absent (null or blank), ok, or error."""
    ok = key.rlike(r"^[A-Z0-9_]+\|[a-z0-9_]+\|[A-Z0-9]+-[A-Z0-9]+\|[^|\s]+$")
    part = lambda i: F.when(ok, F.split(key, r"\|")[i])
    state = F.when(key.isNull() | (F.trim(key) == ""), "absent").when(ok, "ok").otherwise("error")
    return F.struct(
        state.alias("state"), part(0).alias("exchange"), part(1).alias("market"),
        F.when(ok, F.split(F.split(key, r"\|")[2], "-")[0]).alias("base"), F.when(ok, F.split(F.split(key, r"\|")[2], "-")[1]).alias("quote"), part(3).alias("native"),
    )


def parts_of_key(key: Column) -> Column:
    """The parts of a ``framed_key`` in order, or null if the text isn't one. Lengths are read one after the other, so this is a
    function over Arrow batches."""
    import pandas as pd

    def split(texts):
        def one(text):
            parts, rest = [], text
            while rest:
                size, colon, rest = rest.partition(":")
                if not colon or not (size.isascii() and size.isdigit()) or len(rest) < int(size):
                    return None
                parts.append(rest[: int(size)])
                rest = rest[int(size) :]
            return parts

        return texts.map(one, na_action="ignore")

    split.__annotations__ = {"texts": pd.Series, "return": pd.Series}  # as types: the module's annotations are texts
    return F.pandas_udf(split, "array<string>")(key)
