"""A uniform shuffle of documents into shards of exact sizes, by a communication matrix.

How many rows of each partition go to each shard is drawn first: a matrix whose rows sum to the
partitions and whose columns sum to the shards, with the hypergeometric law that a uniform
shuffle has. Each partition is permuted locally and deals its rows out by its row of the matrix;
after the exchange each shard is permuted again. The rows see DataFrame operations only.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.operators.joins import BROADCAST_ROWS
from textloom.session import remove_path, work_path

# Rows of a shard that one task puts in order; a shard is cut into as many buckets as it needs.
BUCKET_ROWS = 4096

# Cells of the matrix that are drawn at a time.
CELLS = 1 << 20

# NumPy draws from urns below this size.
URN = 1_000_000_000

SHARD_SCHEMA = "doc_id BIGINT, text STRING, slot BIGINT, shard INT"


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def hypergeometric(good: int, bad: int, drawn: int, rng: random.Random) -> int:
    """How many of ``drawn`` come from ``good``, for an urn of any size: inversion outward from the mode."""
    low, high = max(0, drawn - bad), min(drawn, good)
    mode = min(max((drawn + 1) * (good + 1) // (good + bad + 2), low), high)
    share = math.exp(_log_choose(good, mode) + _log_choose(bad, drawn - mode) - _log_choose(good + bad, drawn))
    left, at, before, after = rng.random() - share, (mode, mode), share, share
    while left > 0 and (at[0] > low or at[1] < high):
        down, up = at
        if up < high:
            after *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up, left = up + 1, left - after
            if left <= 0:
                return up
        if down > low:
            before *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down, left = down - 1, left - before
            if left <= 0:
                return down
        if (down, up) == at or before + after == 0:
            break
        at = (down, up)
    return mode


def _split(drawn: int, colours: np.ndarray, generator: np.random.Generator, rng: random.Random) -> np.ndarray:
    """How many of ``drawn`` rows go to each shard whose open places are ``colours``."""
    taken, rest = np.zeros_like(colours), int(colours.sum())
    for i, places in enumerate(colours.tolist()):
        rest -= places
        if places and drawn:
            draw = generator.hypergeometric if places + rest < URN else lambda g, b, n: hypergeometric(g, b, n, rng)
            taken[i] = draw(places, rest, drawn) if rest else drawn
            drawn -= int(taken[i])
    return taken


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(partition, rows to each shard)`` in order of partitions; one row of the matrix is held at a time.

    ``rows`` are the sizes of the partitions, ``shards`` those of the shards, with equal sums.
    Each partition takes its share of the places that are left, which gives the law of all cells.
    """
    generator, rng = np.random.default_rng(seed), random.Random(seed)
    places = np.array(shards, dtype=np.int64)
    for partition, n in enumerate(rows):
        taken = _split(n, places, generator, rng)
        places = places - taken
        yield partition, taken


def _bounds(spark: SparkSession, parts: list[tuple[int, int]], sizes: list[int], seed: int) -> DataFrame:
    """``(_part, _ends)``: where the rows for each shard end among the permuted rows of a partition.

    One chunk of the matrix is broadcast; a larger matrix is written in chunks and joined.
    """
    schema = "_part INT, _ends ARRAY<BIGINT>"
    step = max(1, CELLS // len(sizes))
    drawn = communication_matrix([n for _, n in parts], sizes, seed)
    rows = ((parts[i][0], np.cumsum(taken).tolist()) for i, taken in drawn)
    if len(parts) <= step:
        return F.broadcast(spark.createDataFrame(list(rows), schema))
    path = work_path(spark, "matrix")
    for _ in range(0, len(parts), step):
        chunk = [row for _, row in zip(range(step), rows)]
        spark.createDataFrame(chunk, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path).hint("merge")


def shuffle_to_shards(
    docs: DataFrame, folder: str, shards: int = 8, seed: int = 0, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write ``(doc_id, text, slot)`` to one folder ``shard=N`` for each shard, numbered from 0.

    Numbers of rows differ by one at most, lower shards first; ``slot`` numbers the rows of a
    shard from 0 without gaps. Every way to deal the rows out and to order them is equally
    likely; rows that share a text or an id are dealt like any others. The permuted partitions
    are stored before they are counted, so a lost executor cannot change a drawn order; texts
    cross the network once. NULL ids and NULL or empty texts are rows like others, repeated
    rows stay. Other columns are left out, whatever their names. An empty table gives empty
    shards: a folder without files.
    """
    if shards < 1:
        raise ValueError("there is no shard")
    spark = docs.sparkSession
    path = work_path(spark, "permuted")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = texts.withColumn("_turn", F.rand(seed)).sortWithinPartitions("_turn")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    permuted = keyed.select("doc_id", "text", F.spark_partition_id().alias("_part"), place.alias("_place"), F.rand(seed + 1).alias("_again"))
    permuted.write.option("compression", "zstd").parquet(path)
    permuted = spark.read.parquet(path)
    parts = sorted((row["_part"], row["n"]) for row in permuted.groupBy("_part").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in parts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    buckets = max(1, -(-sizes[0] // bucket_rows))

    shard = F.size(F.filter("_ends", lambda end: end <= F.col("_place")))
    dealt = permuted.join(_bounds(spark, parts, sizes, seed), "_part").withColumn("shard", shard)
    dealt = dealt.withColumn("_bucket", F.floor(F.col("_again") * buckets).cast("int")).drop("_ends")
    tallies = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = tallies.select("shard", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    starts = F.broadcast(starts) if shards * buckets <= BROADCAST_ROWS else starts.hint("merge")
    order = Window.partitionBy("shard", "_bucket").orderBy("_again", "_part", "_place")
    slot = (F.col("_start") + F.row_number().over(order) - 1).alias("slot")
    placed = dealt.join(starts, ["shard", "_bucket"]).select("doc_id", "text", slot, "shard")
    placed.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    remove_path(spark, path)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, text, slot, shard)`` of all shards; a filter on ``shard`` reads its folder only."""
    return spark.read.schema(SHARD_SCHEMA).parquet(folder)
