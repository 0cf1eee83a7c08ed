"""Lookup of a small or a large keyed table from a skewed fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import stored

# A table of ids with at most this many rows is broadcast.
BROADCAST_ROWS = 200_000

# A table of vectors with at most this many entries in all is broadcast (256 MB of doubles).
BROADCAST_ENTRIES = 32_000_000

# Rows of one key that meet one copy of its table row; a hotter key gets more copies.
ROWS_PER_COPY = 1_000_000


def fits_broadcast(table: DataFrame, bound: int | None = None, limit: int = BROADCAST_ROWS) -> bool:
    """Whether the table is small; counted unless the caller knows a bound on its rows."""
    return limit > 0 and (table.count() if bound is None else bound) <= limit


def vectors_fit_broadcast(table: DataFrame, vec: str, limit: int = BROADCAST_ENTRIES) -> bool:
    """Whether all vectors of a table together are small; they have equal length."""
    if limit <= 0:
        return False
    first = table.select(F.size(vec).alias("dims")).first()
    return first is None or table.count() * first["dims"] <= limit


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    spread: list[str] | None,
    how: str = "left",
    small: bool | None = None,
    per_copy: int = ROWS_PER_COPY,
) -> DataFrame:
    """Join ``rows`` to ``table``, which is unique on ``on``.

    A small table is broadcast; it is counted unless the caller has checked its size and says
    ``small``. For a larger one the rows of each key are counted first. A key with more than
    ``per_copy`` rows gets as many copies of its table row as its share asks for, and its rows
    are dealt over them by a hash of the columns ``spread``, or by the row itself if there are
    none that tell rows apart. All other table rows are shuffled once.
    """
    if fits_broadcast(table) if small is None else small:
        return rows.join(F.broadcast(table), on, how)
    heavy = heavy_keys(rows, on, per_copy)
    if heavy.isEmpty():
        return rows.join(table.hint("merge"), on, how)
    heavy = F.broadcast(heavy)  # one row for each ``per_copy`` rows at most
    number = F.monotonically_increasing_id() if spread is None else F.xxhash64(*spread)
    own = F.pmod(number, F.coalesce("_copies", F.lit(1))).cast("int")
    salted = rows.join(heavy, on, "left").withColumn("_salt", own).drop("_copies")
    last = F.coalesce("_copies", F.lit(1)) - 1
    copies = table.join(heavy, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_copies")
    return salted.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")


def heavy_keys(rows: DataFrame, on: str, per_copy: int = ROWS_PER_COPY) -> DataFrame:
    """``(key, _copies)`` of the keys with more than ``per_copy`` rows, stored."""
    counts = rows.groupBy(on).agg(F.ceil(F.count("*") / per_copy).cast("int").alias("_copies"))
    return stored(counts.where((F.col("_copies") > 1) & F.col(on).isNotNull()), "heavy")
