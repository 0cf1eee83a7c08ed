"""Names for columns that an operator adds beside those of the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with as many ``_`` before it as it takes to differ from all columns (in any case)."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def new_column(df: DataFrame, out: str) -> str:
    """``out``, or an error where the caller's table has such a column, which would be lost."""
    if out.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"the table already has a column named {out}")
    return out
