"""Compressing vectors to codes of their parts, each found by an equal-average search.

A vector of integers is cut into parts, and each part is replaced by the number of the nearest
entry of a codebook for its position. Entries are sorted by the sum of their components. By
Cauchy's inequality the squared difference of two sums over the width is no more than the squared
distance, so the search starts at the entry whose sum is next to the part's own and goes outward
on both sides, each until that bound strictly exceeds the best distance. All parts of a batch
go outward together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.worker import release
from textloom.operators.joins import lookup_join
from textloom.session import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

# Integers times the width of a part stay below this, so no squared sum leaves 64 bits.
LARGEST = 1 << 27

# Vector lengths whose codebooks are fitted and broadcast together: this many components (64 MB) in all.
COMPONENTS = 1 << 17

# Components of vectors that a task searches at a time (32 MB).
AT_ONCE = 1 << 22


class Codebook:
    """The entries of one part position, sorted by the sum of their components."""

    def __init__(self, entries: np.ndarray):
        self.order = np.argsort(entries.sum(axis=1), kind="stable")
        self.entries = entries[self.order]
        self.sums = self.entries.sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and its squared distance for each row; ties to the lower number."""
        rows, width = x.shape
        own = x.sum(axis=1)
        after = np.searchsorted(self.sums, own)
        best, number = np.full(rows, (1 << 62) // max(width, 1)), np.full(rows, len(self.sums))
        open_rows, turn = [np.arange(rows), np.arange(rows)], 0
        while len(open_rows[0]) or len(open_rows[1]):
            for side in (0, 1):
                row = open_rows[side]
                at = after[row] + turn if side else after[row] - 1 - turn
                inside = (at >= 0) & (at < len(self.sums))
                row, at = row[inside], at[inside]
                gap = own[row] - self.sums[at]
                near = gap * gap <= width * best[row]
                row, at = row[near], at[near]
                apart = x[row] - self.entries[at]
                distance, found = np.einsum("rd,rd->r", apart, apart), self.order[at]
                better = (distance < best[row]) | ((distance == best[row]) & (found < number[row]))
                best[row[better]], number[row[better]] = distance[better], found[better]
                open_rows[side] = row
            turn += 1
        return number, best


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows as parts of equal width; zeros fill up the last one."""
    width = -(-x.shape[1] // parts)
    return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)


class Codebooks:
    """The codebooks of all part positions for vectors of one length."""

    def __init__(self, dims: int, entries: np.ndarray):
        self.dims, self.entries = dims, entries  # part, entry, place
        self._search = [Codebook(part) for part in entries]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, a column for each part."""
        found = [book.nearest(part) for book, part in zip(self._search, np.moveaxis(_cut(x, len(self.entries)), 1, 0))]
        return np.stack([number for number, _ in found], axis=1), np.stack([distance for _, distance in found], axis=1)

    def decode(self, codes: list[str]) -> np.ndarray:
        """The vectors that codes stand for."""
        numbers = np.array([list(bytes.fromhex(code)) for code in codes], dtype=np.int64).reshape(-1, len(self.entries))
        chosen = self.entries[np.arange(len(self.entries)), numbers]
        return chosen.reshape(len(codes), -1)[:, : self.dims]

    def sha256(self) -> str:
        """Digest of all components in decimal, by part, entry and place, joined by commas."""
        places = [self.entries[p, :, : max(0, self.dims - p * self.entries.shape[2])] for p in range(len(self.entries))]
        return hashlib.sha256(",".join(str(v) for part in places for v in part.ravel().tolist()).encode()).hexdigest()


def usable(vector: str) -> Column:
    """Whether a vector is present and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & fine


def _integers(vectors: DataFrame, vector: str, scale: int, parts: int, *keep: Column) -> DataFrame:
    """Usable rows with ``_ints``, the rounded-down multiples of ``1 / scale``."""
    cells = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    limit = F.floor(F.lit(LARGEST) / F.greatest(F.lit(1), F.ceil(F.size("_ints") / parts)))
    small = F.forall("_ints", lambda x: F.abs(x) <= limit)
    checked = F.when(small, F.col("_ints")).otherwise(F.raise_error(F.lit("a component is too large for codes")))
    return vectors.where(usable(vector)).select(*keep, cells.alias("_ints")).withColumn("_ints", checked)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length in a batch, a bounded part at a time."""
    lengths = column.value_lengths().to_numpy()
    for dims in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dims)
        step = max(1, AT_ONCE // max(1, dims))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            yield part, column.take(pa.array(part)).flatten().to_numpy().reshape(len(part), dims)


def fit_codebooks(ints: DataFrame, lengths: list[int], parts: int, entries: int, rounds: int) -> dict[int, Codebooks]:
    """Codebooks by vector length from ``(_id, _ints)``: first rows by id, then ``rounds`` of means.

    A task adds up its own vectors, so the shuffle carries a number for each component of an
    entry and task. Means are rounded down; an entry without vectors stays.
    """
    spark, books = ints.sparkSession, {}
    for dims in lengths:
        first = ints.where(F.size("_ints") == dims).orderBy(F.asc_nulls_last("_id"), "_ints").limit(entries).collect()
        cut = _cut(np.array([row["_ints"] for row in first], dtype=np.int64).reshape(len(first), dims), parts)
        books[dims] = Codebooks(dims, np.ascontiguousarray(np.moveaxis(cut, 1, 0)))
    schema = "dims INT, part INT, entry INT, place INT, total BIGINT, n BIGINT"
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)  # ``COMPONENTS`` times ``entries`` integers at most

        def add_up(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            release()
            totals = {dims: np.zeros_like(own.entries) for dims, own in shared.value.items()}
            counts = {dims: np.zeros(own.entries.shape[:2], np.int64) for dims, own in shared.value.items()}
            for batch in batches:
                for _, x in _by_length(batch.column(0)):
                    dims = x.shape[1]
                    numbers, _ = shared.value[dims].assign(x)
                    for part, own in enumerate(np.moveaxis(_cut(x, parts), 1, 0)):
                        np.add.at(totals[dims][part], numbers[:, part], own)
                        counts[dims][part] += np.bincount(numbers[:, part], minlength=counts[dims].shape[1])
            for dims, n in counts.items():
                part, entry = np.nonzero(n)
                width = totals[dims].shape[2]
                columns = [
                    np.full(len(part) * width, dims, np.int32),
                    np.repeat(part, width).astype(np.int32),
                    np.repeat(entry, width).astype(np.int32),
                    np.tile(np.arange(width, dtype=np.int32), len(part)),
                    totals[dims][part, entry].ravel(),
                    np.repeat(n[part, entry], width),
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["dims", "part", "entry", "place", "total", "n"])

        own = ints.where(F.size("_ints").isin(lengths)).select("_ints")
        sums = own.mapInArrow(add_up, schema).groupBy("dims", "part", "entry", "place")
        moved = {dims: old.entries.copy() for dims, old in books.items()}
        found = sums.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow().to_pydict()
        for dims, part, entry, place, total, n in zip(*(found[c] for c in ("dims", "part", "entry", "place", "total", "n"))):
            moved[dims][part, entry, place] = total // n
        books = {dims: Codebooks(dims, values) for dims, values in moved.items()}
    return books


def _encoder(shared: Broadcast) -> Callable[[str], Column]:
    @F.arrow_udf("struct<code: string, error: bigint>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            codes, errors = np.empty(len(batch), object), np.zeros(len(batch), np.int64)
            for rows, x in _by_length(batch):
                numbers, distances = shared.value[x.shape[1]].assign(x)
                codes[rows] = [code.tobytes().hex() for code in numbers.astype(np.uint8)]
                errors[rows] = distances.sum(axis=1)
            yield pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(errors)], ["code", "error"])

    return encode


def compress_vectors(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, dict[int, str]]:
    """``(vec_id, label, dims, code, error)`` of each usable vector, stored, and the codebooks' digests by length.

    Components become integers, ``scale`` times the number rounded down. ``code`` has two hex
    digits for each part, ``error`` is the sum of squared distances. Rows whose vector is NULL
    or holds NULL, NaN or an infinity are left out; a zero vector stays. Each vector length is
    a search of its own with codebooks of its own; where it is no multiple of ``parts``, the
    last parts are filled with zeros, and an empty vector is code 0 throughout. Codebooks start
    from the rows of lowest id, equal ids by their components, NULL ids last; with fewer rows
    than ``entries`` there are fewer entries. Repeated rows stay and weigh as often as they
    occur. An empty table gives no rows and no digests. Other columns are left out, whatever
    their names. A component beyond 2^27 / ``scale`` over the width of a part is an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits hold 256 entries at most")
    ints = _integers(vectors, vector_col, scale, parts, F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    lengths = sorted(row[0] for row in ints.select(F.size("_ints")).distinct().collect())
    groups: list[list[int]] = []
    for dims in lengths:
        if not groups or sum(groups[-1]) + dims > COMPONENTS:
            groups.append([])
        groups[-1].append(dims)
    digests: dict[int, str] = {}
    coded = []
    for group in groups or [[]]:
        books = fit_codebooks(ints, group, parts, entries, rounds) if group else {}
        digests.update((dims, own.sha256()) for dims, own in books.items())
        shared = vectors.sparkSession.sparkContext.broadcast(books)

        own = ints.where(F.size("_ints").isin(group)).withColumn("_found", _encoder(shared)("_ints"))
        coded.append(
            stored(
                own.select(
                    F.col("_id").alias("vec_id"), F.col("_label").alias("label"), F.size("_ints").alias("dims"), "_found.code", "_found.error"
                ),
                "codes",
            )
        )
    whole = coded[0]
    for more in coded[1:]:
        whole = whole.unionByName(more)
    return whole, digests


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add ``label_error``, the sum of ``error`` over rows of an equal label, NULL labels together.

    Errors are summed before the shuffle; the sums come back by a broadcast behind a size
    check, or a join that deals a hot label over many copies.
    """
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    unlabelled = sums.where(F.col("label").isNull()).first()
    named = lookup_join(coded, sums.where(F.col("label").isNotNull()), "label", ["vec_id", "code"])
    of_null = F.lit(None if unlabelled is None else unlabelled["label_error"]).cast("bigint")
    return named.withColumn("label_error", F.when(F.col("label").isNull(), of_null).otherwise(F.col("label_error")))


def compression_report(vectors: DataFrame, **names: str) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, one row for each usable vector."""
    coded, digests = compress_vectors(vectors, **names)
    of_length = F.lit(None).cast("string")
    if digests:
        of_length = F.create_map(*[F.lit(x) for pair in digests.items() for x in pair])[F.col("dims")]
    rows = with_label_errors(coded)
    return rows.select("vec_id", "code", "error", "label_error", of_length.alias("codebooks_sha256"))
