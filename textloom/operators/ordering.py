"""Running sums and ranks over a whole table in key order, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import stored

# Rows of a range, which one task sorts, and the most ranges there are. A table beyond their
# product has larger ranges, whose sort spills.
ROWS_PER_RANGE = 250_000
MAX_RANGES = 65_536


@dataclass(frozen=True)
class OrderIndex:
    """Key ranges and what all earlier ranges add up to."""

    key: str
    bounds: tuple[float, ...]
    offsets: tuple[tuple[int, int], ...]


def range_count(rows: int, per_range: int = ROWS_PER_RANGE) -> int:
    """How many ranges a table is cut into: it follows the rows, not the cluster."""
    return min(MAX_RANGES, max(1, -(-rows // per_range)))


def build_order_index(
    df: DataFrame, key: str, value: str | None = None, ranges: int | None = None, per_range: int = ROWS_PER_RANGE
) -> OrderIndex:
    """Cut the key into ranges of about equal row count and total each range.

    ``value`` is the column to be summed, one per row if not given. ``key`` is a unique
    number, so no range can be dominated by one key. The passes read only the key and the
    value; one total for each range reaches the driver.
    """
    if ranges is None:
        ranges = range_count(df.select(key).count(), per_range)
    cuts = [i / ranges for i in range(1, ranges)]
    inner = sorted(set(df.approxQuantile(key, cuts, 0.25 / ranges))) if cuts else []
    bounds = (float("-inf"), *inner, float("inf"))
    amount = F.lit(1) if value is None else F.col(value)
    totals = _with_range(df, key, bounds).groupBy("_range").agg(F.sum(amount.cast("bigint")).alias("total"))
    return OrderIndex(key, bounds, _offsets(totals))


def _offsets(totals: DataFrame) -> tuple[tuple[int, int], ...]:
    rows = sorted((r["_range"], r["total"]) for r in totals.collect())
    before = [0, *accumulate(total for _, total in rows)]
    return tuple((rows[i][0], before[i]) for i in range(len(rows)))


def _with_range(df: DataFrame, key: str, bounds: tuple[float, ...]) -> DataFrame:
    missing = F.raise_error(F.lit(f"{key} is NULL and has no place in the order"))
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("double"), missing.cast("double")))
    if len(bounds) == 2:
        return keyed.withColumn("_range", F.when(F.col("_key").isNotNull(), 0)).drop("_key")
    cut = Bucketizer(splits=list(bounds), inputCol="_key", outputCol="_range", handleInvalid="error")
    return cut.transform(keyed).withColumn("_range", F.col("_range").cast("int")).drop("_key")


def running_sum(df: DataFrame, index: OrderIndex, value: str | None, out: str, unique: bool = False) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and including this one, in key order.

    With ``unique`` a key that occurs twice is an error: its rows would have no order, and a
    repeated task could number them the other way round. Equal keys share a range, so the
    check costs no shuffle.
    """
    ranged = _with_range(df, index.key, index.bounds)
    return _numbered(ranged, [index.key], index.offsets, value, out, unique)


def _numbered(
    ranged: DataFrame, keys: Sequence[str], offsets: tuple[tuple[int, int], ...], value: str | None, out: str, unique: bool
) -> DataFrame:
    spark, name = ranged.sparkSession, ", ".join(keys)
    amount = F.lit(1) if value is None else F.col(value)
    within = Window.partitionBy("_range").orderBy(*keys)
    total = F.sum(amount.cast("bigint")).over(within.rowsBetween(Window.unboundedPreceding, 0))
    if unique:
        this = F.struct(*keys)
        twice = F.lag(this).over(within).eqNullSafe(this)
        total = F.when(twice, F.raise_error(F.lit(f"{name} occurs twice and gives no order")).cast("bigint")).otherwise(total)
    starts = spark.createDataFrame(list(offsets), "_range INT, _offset BIGINT")
    # as many offsets as there are ranges, MAX_RANGES at most; left, so that no row can get lost
    placed = ranged.withColumn(out, total).join(F.broadcast(starts), "_range", "left")
    unknown = F.raise_error(F.lit(f"{name} lies outside the table the index was built from"))
    offset = F.coalesce("_offset", unknown.cast("bigint"))
    return placed.withColumn(out, F.col(out) + offset).drop("_range", "_offset")


def rank_rows(
    df: DataFrame, keys: Sequence[str], out: str, unique: bool = False, per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add the place of each row, from 1, in the order of several columns or of any sortable type.

    Spark deals the rows over ranges of the keys; the dealt table is stored, so that every
    later pass sees the same ranges. NULL comes first.
    """
    ranges = range_count(df.count(), per_range)
    if ranges == 1:  # one task sorts all there is, and nothing has to agree with it
        return _numbered(df.withColumn("_range", F.lit(0)), keys, ((0, 0),), None, out, unique)
    dealt = df.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    ranged = stored(dealt, "ranges")
    offsets = _offsets(ranged.groupBy("_range").agg(F.count("*").alias("total")))
    return _numbered(ranged, keys, offsets, None, out, unique)
