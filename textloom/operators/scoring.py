"""Hook for a user's own model over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def score_batches(
    df: DataFrame, fn: Callable[..., pa.RecordBatch], output_schema: str, broadcast: object = None
) -> DataFrame:
    """Run ``fn`` on every Arrow batch of the table.

    With ``broadcast`` the value is sent to each worker once and passed as second argument.
    """
    shared = None if broadcast is None else df.sparkSession.sparkContext.broadcast(broadcast)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch) if shared is None else fn(batch, shared.value)

    return df.mapInArrow(run, output_schema)
