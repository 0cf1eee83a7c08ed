"""Pairs and weighted aggregates of rows that lie close together in one group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import dense
from textloom.functions.encoding import MASKED_BIAS
from textloom.session import stored, work_path
from textloom.sources.blocks import read_block, write_block

# Positions per block of a long group, for pairs within a band and for all-against-all work.
BLOCK = 1024
TILE = 4096

# Rows of a strip at most: queries that a task holds, or keys that it reads at a time.
STRIP_ROWS = 4096

# A block of a band is this many times its width, so most scores that are computed count.
BANDS_PER_BLOCK = 8

# Tasks that blocks of queries are dealt over at most.
MOST_TASKS = 10_000

# Scores computed at a time within a task (64 MB of doubles).
SCORES_AT_ONCE = 8_000_000


def _band_blocks(rows: DataFrame, pos: str, w: int, block: int) -> DataFrame:
    """Cut groups into blocks of positions, with copies of the ``w`` rows beyond either edge.

    Adds ``_block`` and ``_centre``; only the copies near an edge are extra rows. Blocks are
    at least ``2 w`` long, so a row lies near the edge of one neighbour at most on each side.
    """
    size = max(block, 2 * w, 1)
    own = F.floor(F.col(pos) / size)
    first, last = F.floor((F.col(pos) - w) / size), F.floor((F.col(pos) + w) / size)
    return rows.withColumn("_block", F.explode(F.sequence(first, last))).withColumn("_centre", F.col("_block") == own)


def band_pairs_of_arrays(rows: DataFrame, by: str, items: str, w: int) -> DataFrame:
    """The pairs of ``band_pairs`` within an array, as ``(by, i, j, item_i, item_j)``; nothing is shuffled."""
    place = rows.select(by, F.col(items).alias("_items"), F.posexplode(items).alias("_i", "item_i"))
    first = F.greatest(F.col("_i") - w, F.lit(0))
    near = F.slice("_items", first + 1, F.col("_i") + w + 1 - first)
    pairs = place.select(by, F.col("_i").cast("bigint").alias("i"), first.alias("_first"), "item_i", F.posexplode(near).alias("_j", "item_j"))
    return pairs.select(by, "i", (F.col("_first") + F.col("_j")).cast("bigint").alias("j"), "item_i", "item_j")


def band_pairs(
    rows: DataFrame, by: str, pos: str, w: int, carry: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """Ordered pairs ``(by, i, j)`` with ``abs(j - i) <= w`` in one group, each row with itself too.

    ``carry`` columns come along as ``<name>_i`` and ``<name>_j``. A row has at most 2w+1
    pairs, made by one sliding window per block.
    """
    near = Window.partitionBy(by, "_block").orderBy(pos).rangeBetween(-w, w)
    blocks = _band_blocks(rows.select(by, F.col(pos).cast("bigint").alias(pos), *carry), pos, w, block)
    found = F.collect_list(F.struct(F.col(pos).alias("j"), *[F.col(c).alias(f"{c}_j") for c in carry])).over(near)
    pairs = blocks.withColumn("_near", found).where("_centre").withColumn("_pair", F.explode("_near"))
    return pairs.select(
        by,
        F.col(pos).alias("i"),
        F.col("_pair.j").alias("j"),
        *[F.col(c).alias(f"{c}_i") for c in carry],
        *[F.col(f"_pair.{c}_j").alias(f"{c}_j") for c in carry],
    )


def _partial_pool(
    query: np.ndarray, key: np.ndarray, value: np.ndarray, bias: np.ndarray, distance: tuple | None, w: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query: the largest score, the sum of powers relative to it, and the weighted sum.

    ``distance`` holds the positions of queries and keys if only keys up to ``w`` away count.
    """
    top, weight = np.empty(len(query)), np.empty(len(query))
    summed = np.empty((len(query), value.shape[1]))
    step = max(1, SCORES_AT_ONCE // len(key))
    for i in range(0, len(query), step):
        part = slice(i, i + step)
        scores = query[part] @ key.T
        scores *= query.shape[1] ** -0.5
        scores += bias
        if distance is not None:
            scores[np.abs(distance[0][part, None] - distance[1][None, :]) > w] = -np.inf
        top[part] = scores.max(axis=1)
        scores -= top[part, None]
        powers = np.exp(scores, out=scores)
        weight[part] = powers.sum(axis=1)
        summed[part] = powers @ value
    return top, weight, summed


def neighbour_pool(
    rows: DataFrame,
    by: str,
    w: int | None = None,
    pos: str = "pos",
    query: str = "vector",
    key: str | None = None,
    value: str | None = None,
    mask: str = "mask",
    max_len: int | None = None,
    block: int | None = None,
    wanted: tuple[int, int] | None = None,
) -> DataFrame:
    """``(by, pos, pooled)``: the mean of the value vectors of a group, weighted per query row.

    A weight is the softmax, over the keys of the group or of the band ``abs(j - i) <= w``, of
    the dot product over the root of the width, plus 0 or the smallest float if the key is
    masked, which a NULL mask means too. Masked rows are still queries. If all keys in reach
    are masked the weights are equal. ``(by, pos)`` is unique. With ``wanted``, the first and the
    last position that is asked for, other rows are keys only, and within a band those out of
    reach are left out before the shuffle.

    With ``w`` the work is cut into blocks of positions. Without it, it grows with the square
    of the group: ``max_len`` promises that positions stay below it, as in texts of fixed
    length; otherwise groups are cut into blocks that are shuffled and stored once. A strip of
    blocks of queries is a task; the keys of its group stream past it, ``block`` at a time, and
    each query carries its largest score, its sum of powers and its weighted sum along.
    """
    key, value = key or query, value or query
    parts = {name: f"_v{i}" for i, name in enumerate(dict.fromkeys((query, key, value)))}
    table = rows.select(
        F.col(by),
        F.col(pos).cast("bigint").alias("_pos"),
        *[F.col(name).alias(part) for name, part in parts.items()],  # a column that serves twice travels once
        F.coalesce(F.col(mask).cast("int"), F.lit(0)).alias("_mask"),
    )
    roles = (parts[query], parts[key], parts[value])
    by_type = rows.schema[by].dataType.simpleString()
    if w is not None:
        return _pool_band(table, roles, by, by_type, pos, w, block or max(64, BANDS_PER_BLOCK * w), wanted)
    if max_len is not None and max_len <= (block or TILE):
        pooled = _pool_whole(table, roles, by, by_type, pos, max_len)
    else:
        pooled = _pool_tiles(table, roles, by, by_type, pos, block or TILE)
    return pooled if wanted is None else pooled.where(F.col(pos).between(*wanted))


def _columns(
    table: pa.Table, roles: tuple[str, str, str]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions, query, key and value vectors in double precision, and the bias of each key."""
    bias = (1 - table["_mask"].to_numpy()) * MASKED_BIAS
    dense_parts = {name: dense.to_matrix(table[name]).astype(np.float64) for name in dict.fromkeys(roles)}
    q, k, v = (dense_parts[name] for name in roles)
    return table["_pos"].to_numpy(), q, k, v, bias


def _result(table: pa.Table, by: str, pos: str, positions: np.ndarray, pooled: np.ndarray) -> pa.Table:
    group = table[by].combine_chunks()[:1].take(pa.array(np.zeros(len(positions), np.int64)))
    return pa.Table.from_arrays([group, pa.array(positions), dense.to_lists(pooled)], [by, pos, "pooled"])


def _pool_whole(table: DataFrame, roles: tuple[str, str, str], by: str, by_type: str, pos: str, max_len: int) -> DataFrame:
    def pool(group: pa.Table) -> pa.Table:
        positions, q, k, v, bias = _columns(group, roles)
        if positions.max() >= max_len:
            raise ValueError(f"position {positions.max()} is not below max_len {max_len}")
        _, weight, summed = _partial_pool(q, k, v, bias, None)
        return _result(group, by, pos, positions, summed / weight[:, None])

    return table.groupBy(by).applyInArrow(pool, f"`{by}` {by_type}, `{pos}` BIGINT, pooled ARRAY<DOUBLE>")


def _pool_band(table: DataFrame, roles: tuple[str, str, str], by: str, by_type: str, pos: str, w: int, block: int, wanted: tuple[int, int] | None) -> DataFrame:
    def pool(part: pa.Table) -> pa.Table:
        positions, q, k, v, bias = _columns(part, roles)
        centre = part["_centre"].to_numpy()
        _, weight, summed = _partial_pool(q[centre], k, v, bias, (positions[centre], positions), w)
        return _result(part, by, pos, positions[centre], summed / weight[:, None])

    def pool_centres(part: pa.Table) -> pa.Table:
        if not part["_centre"].to_numpy().any():
            return _result(part, by, pos, np.zeros(0, np.int64), np.zeros((0, 0)))
        return pool(part)

    if wanted is not None:
        table = table.where(F.col("_pos").between(wanted[0] - w, wanted[1] + w))
    blocks = _band_blocks(table, "_pos", w, block)
    if wanted is not None:
        size = max(block, 2 * w, 1)
        blocks = blocks.where(F.col("_block").between(wanted[0] // size, wanted[1] // size))
        blocks = blocks.withColumn("_centre", F.col("_centre") & F.col("_pos").between(*wanted))
    schema = f"`{by}` {by_type}, `{pos}` BIGINT, pooled ARRAY<DOUBLE>"
    return blocks.groupBy(by, "_block").applyInArrow(pool_centres, schema)


def _pool_tiles(table: DataFrame, roles: tuple[str, str, str], by: str, by_type: str, pos: str, block: int) -> DataFrame:
    """Rows are stored once, in strips; a task holds a strip of queries and the keys of its group stream past.

    A strip is what one task of the shuffle has got of the blocks of a group, at most ``STRIP_ROWS``
    rows, however far apart their positions are. So the files that are read grow with the square
    of the strips, not of the blocks.
    """
    spark = table.sparkSession
    folder = work_path(spark, "tiles")
    name = F.coalesce(F.md5(F.col(by).cast("string").cast("binary")), F.lit("null"))
    cut = table.withColumn("_block", F.floor(F.col("_pos") / block)).withColumn("_group", name)
    kept = [by, "_pos", *dict.fromkeys(roles), "_mask"]
    dealt = cut.repartition("_group", "_block").sortWithinPartitions("_group", "_pos").select("_group", *kept)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, rows in enumerate(_strips(batches, STRIP_ROWS)):
            if rows["_pos"].null_count:
                raise ValueError("a position is NULL")
            group, strip = rows["_group"][0].as_py(), f"{part}-{number}"
            write_block(f"{folder}/{group}/{strip}.arrow", rows.select(kept))
            yield pa.RecordBatch.from_pydict({"group": pa.array([group], pa.string()), "strip": pa.array([strip], pa.string())})

    manifest = stored(dealt.mapInArrow(store, "group STRING, strip STRING"), "tiles")
    strips = manifest.groupBy("group").agg(F.sort_array(F.collect_list("strip")).alias("strips"))
    tasks = max(1, min(MOST_TASKS, manifest.count()))
    work = manifest.join(strips, "group").repartition(tasks)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = read_block(f"{folder}/{row['group']}/{row['strip']}.arrow")
                positions, q, _, v, _ = _columns(own, roles)
                triple = np.full(len(q), -np.inf), np.zeros(len(q)), np.zeros((len(q), v.shape[1]))
                for number in row["strips"]:
                    _, _, key, value, bias = _columns(read_block(f"{folder}/{row['group']}/{number}.arrow"), roles)
                    for i in range(0, len(key), block):
                        part = slice(i, i + block)
                        triple = _merged(triple, _partial_pool(q, key[part], value[part], bias[part], None))
                _, weight, summed = triple
                yield from _result(own, by, pos, positions, summed / weight[:, None]).to_batches()

    return work.mapInArrow(pool, f"`{by}` {by_type}, `{pos}` BIGINT, pooled ARRAY<DOUBLE>")


def _strips(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows that come group by group, as tables of at most ``size`` rows of one group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        names = batch.column("_group").dictionary_encode().indices.to_numpy()
        for piece in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(names)) + 1):
            at = 0
            while at < len(piece):
                rows = sum(part.num_rows for part in held)
                if held and (rows == size or held[0]["_group"][0] != batch["_group"][piece[at]]):
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
                take = min(len(piece) - at, size - rows)
                held.append(batch.slice(piece[at], take))
                at += take
    if held:
        yield pa.Table.from_batches(held)


def _merged(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple:
    """Largest score, sum of powers and weighted sum over the keys of both; in any order."""
    top = np.maximum(a[0], b[0])
    left, right = np.exp(a[0] - top), np.exp(b[0] - top)
    return top, a[1] * left + b[1] * right, a[2] * left[:, None] + b[2] * right[:, None]
