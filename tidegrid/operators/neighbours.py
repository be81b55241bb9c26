"""Values of the neighbouring rows in an ordered group, without sorting a whole group in one task.

A group's rows are cut into chunks (of time); each chunk is sorted by itself, and the edges of chunks are carried across
over a table with one row a chunk. So a source that holds a third of all rows is spread over as many tasks as it has
chunks, and what one task sorts is bounded by the chunk's length, not by the length of history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(ms: Column, chunk_ms: int) -> Column:
    """Number of the chunk a time (epoch ms) lies in."""
    return F.floor(ms / F.lit(chunk_ms)).cast("long")


def with_adjacent(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, *, prev: str | None = None, following: str | None = None) -> DataFrame:
    """df with the value of the row before (column ``prev``) and after (``following``) in the group ``keys``.

    Order columns must have no nulls and rise with the chunk. The first row of a group has a null ``prev``, the last a null
    ``following``.
    """
    own = Window.partitionBy(*keys, chunk).orderBy(*order)
    groups = Window.partitionBy(*keys).orderBy(chunk)
    edge = F.struct(*order, F.col(value).alias("_v"))
    edges = df.groupBy(*keys, chunk).agg(F.min(edge).alias("_first"), F.max(edge).alias("_last"))
    edges = edges.select(
        *keys, chunk, F.lag("_last").over(groups)["_v"].alias("_prev"), F.lead("_first").over(groups)["_v"].alias("_next")
    )
    out = df.join(edges, [*keys, chunk])
    if prev:
        out = out.withColumn(prev, F.coalesce(F.lag(value).over(own), "_prev"))
    if following:
        out = out.withColumn(following, F.coalesce(F.lead(value).over(own), "_next"))
    return out.drop("_prev", "_next")


def with_carried(df: DataFrame, keys: list[str], chunk: str, order: list[str], values: dict[str, Column]) -> DataFrame:
    """df with, for each name in ``values``, the last non-null value of that column at or before the row in its group.

    Chunks must rise with the order; what a chunk inherits is carried over a table with one row a chunk.
    """
    rows = df.select("*", *[c.alias(f"_v{i}") for i, c in enumerate(values.values())])
    place = F.struct(*order)
    edges = rows.groupBy(*keys, chunk).agg(*[F.max_by(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), place)).alias(f"_e{i}") for i in range(len(values))])
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*keys, chunk, *[F.last(f"_e{i}", True).over(before).alias(f"_b{i}") for i in range(len(values))])
    own = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(edges, [*keys, chunk])
    out = out.select("*", *[F.coalesce(F.last(f"_v{i}", True).over(own), f"_b{i}").alias(name) for i, name in enumerate(values)])
    return out.drop(*[f"_{x}{i}" for x in "vb" for i in range(len(values))])
