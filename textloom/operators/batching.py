"""Batches and sequence packing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.encoding import PAD_ID, sequence_length
from textloom.operators.ordering import OrderIndex, build_order_index, rank_rows, running_sum


def assign_batches(
    df: DataFrame, order_by: str | Sequence[str], batch_size: int, index: OrderIndex | None = None
) -> DataFrame:
    """Add ``batch_id`` and ``slot``: chunks of ``batch_size`` rows in the order of a unique key.

    The key is a number, or several columns of any type. Rows with equal keys would have no
    order of their own, so they are an error. ``index`` may come from another table with the
    same keys, such as the key column of the source, which is cheaper to read than a derived ``df``.
    """
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    if isinstance(order_by, str):
        if index is None:
            index = build_order_index(df, order_by)
        ranked = running_sum(df, index, None, "_rank", unique=True)
    else:
        ranked = rank_rows(df, order_by, "_rank", unique=True)
    rank = F.col("_rank") - 1
    return (
        ranked.withColumn("batch_id", F.floor(rank / batch_size))
        .withColumn("slot", F.pmod(rank, F.lit(batch_size)).cast("int"))
        .drop("_rank")
    )


def seq_lengths(df: DataFrame, mask: str = "attention_mask", out: str = "seqlen") -> DataFrame:
    """Add the number of unmasked positions of each row."""
    return df.withColumn(out, sequence_length(F.col(mask)))


def max_seqlen(df: DataFrame, by: str = "batch_id") -> DataFrame:
    return df.groupBy(by).agg(F.max("seqlen").alias("max_seqlen"))


def cu_seqlens(
    df: DataFrame,
    by: str | None = "batch_id",
    order: str = "slot",
    as_array: bool = False,
    index: OrderIndex | None = None,
) -> DataFrame:
    """Cumulative sequence offsets.

    Adds ``cu_start`` and ``cu_end`` to each row, or with ``as_array`` gives one row per batch
    with the b+1 offsets, the first of them 0. ``by`` names a batch, whose rows are bounded by
    the batch size; ``by=None`` packs the whole table in the order of a unique number.
    """
    if by is None:
        if as_array:
            raise ValueError("as_array needs batches")
        if index is None:
            index = build_order_index(df, order, "seqlen")
        summed = running_sum(df, index, "seqlen", "cu_end")
    else:
        to_here = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        summed = df.withColumn("cu_end", F.sum("seqlen").over(to_here))
    if as_array:
        ends = F.array_sort(F.collect_list(F.struct(order, "cu_end")))["cu_end"]
        return summed.groupBy(by).agg(F.concat(F.array(F.lit(0).cast("bigint")), ends).alias("cu_seqlens"))
    return summed.withColumn("cu_start", F.col("cu_end") - F.col("seqlen"))


def stride_offsets(df: DataFrame, seq_len: int, by: str = "batch_id", as_array: bool = False) -> DataFrame:
    """Offsets of rows of fixed length: ``slot * seq_len``, or the b+1 offsets of each batch."""
    if as_array:
        count = F.count("*").cast("int")
        offsets = F.transform(F.sequence(F.lit(0), count), lambda i: i.cast("bigint") * seq_len)
        return df.groupBy(by).agg(offsets.alias("offsets"))
    start = F.col("slot").cast("bigint") * seq_len
    return df.withColumn("start", start).withColumn("end", start + seq_len)


def flatten_tokens(df: DataFrame, seq_len: int) -> DataFrame:
    """One row per position, padding kept: ``(batch_id, slot, pos, flat_pos, token_id, mask)``."""
    cells = F.posexplode(F.arrays_zip("input_ids", "attention_mask")).alias("pos", "cell")
    flat = F.col("slot").cast("bigint") * seq_len + F.col("pos")
    return df.select("batch_id", "slot", cells).select(
        "batch_id",
        "slot",
        "pos",
        flat.alias("flat_pos"),
        F.col("cell.input_ids").alias("token_id"),
        F.col("cell.attention_mask").alias("mask"),
    )


def unpad(df: DataFrame) -> DataFrame:
    """One row per unmasked position, packed: ``(batch_id, slot, pos, flat_pos, token_id)``."""
    offset_known = df if "cu_start" in df.columns else cu_seqlens(df)
    cells = F.transform(
        F.arrays_zip("input_ids", "attention_mask"),
        lambda cell, pos: F.struct(
            pos.alias("pos"), cell["input_ids"].alias("token_id"), cell["attention_mask"].alias("mask")
        ),
    )
    kept = F.posexplode(F.filter(cells, lambda cell: cell["mask"] == 1)).alias("rank", "cell")
    return offset_known.select("batch_id", "slot", "cu_start", kept).select(
        "batch_id",
        "slot",
        F.col("cell.pos").alias("pos"),
        (F.col("cu_start") + F.col("rank")).alias("flat_pos"),
        F.col("cell.token_id").alias("token_id"),
    )


def repad(tokens: DataFrame, seq_len: int, pad_id: int = PAD_ID, rows: DataFrame | None = None) -> DataFrame:
    """Rows of fixed length from token rows: ``(batch_id, slot, input_ids, attention_mask)``.

    Each token goes back to its ``pos``. ``rows`` are the ``(batch_id, slot)`` there are; with
    them a row without any token comes back as padding, which token rows cannot tell of.
    """
    cells = F.array_sort(F.collect_list(F.struct("pos", "token_id")))
    found = tokens.groupBy("batch_id", "slot").agg(cells.alias("cells"))
    if rows is not None:
        found = rows.select("batch_id", "slot").join(found, ["batch_id", "slot"], "left")
        found = found.withColumn("cells", F.coalesce("cells", F.array().cast(found.schema["cells"].dataType)))
    blank = F.struct(F.lit(pad_id).alias("id"), F.lit(0).alias("bit"))

    def with_gap(cell: Column, i: Column) -> Column:
        """A token behind the padding since the token before it."""
        before = F.coalesce(F.get("cells", i - 1)["pos"], F.lit(-1))
        token = F.struct(cell["token_id"].cast("int").alias("id"), F.lit(1).alias("bit"))
        return F.concat(F.array_repeat(blank, (cell["pos"] - before - 1).cast("int")), F.array(token))

    last = F.coalesce(F.get("cells", F.size("cells") - 1)["pos"], F.lit(-1))
    places = F.concat(F.flatten(F.transform("cells", with_gap)), F.array_repeat(blank, (F.lit(seq_len - 1) - last).cast("int")))
    filled = found.select("batch_id", "slot", places.alias("places"))
    return filled.select("batch_id", "slot", F.col("places.id").alias("input_ids"), F.col("places.bit").alias("attention_mask"))


def collect_batches(df: DataFrame, label: str | None = None) -> DataFrame:
    """One row per batch with nested arrays in slot order; its size is bounded by the batch size."""
    fields = ["slot", "input_ids", "attention_mask", *([label] if label else [])]
    rows = df.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rows"))
    names = {"input_ids": "input_ids", "attention_mask": "attention_mask"}
    if label:
        names[label] = "labels"
    return rows.select("batch_id", *[F.col(f"rows.{c}").alias(out) for c, out in names.items()])
