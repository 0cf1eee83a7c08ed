"""Near duplicates of vectors: coarse inverted lists, product codes of residuals, exact cosine rerank.

Vectors are scaled to length one, where a cosine of ``t`` is a distance of ``sqrt(2 - 2 t)``. A
vector is stored in the list of its nearest centre as eight code bytes of its residual, and it
visits further lists: those whose border with its own list is at most half the reach away. Of two
vectors within reach on either side of a border one is that near, so one visits the other's list
and no link is lost. In a list a table of distances to all code words gives the distance to a coded vector in
eight lookups. The coding error of every vector is known, so a pair is left only if even that
error cannot bring it within reach; all others get the exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.components import connected_components, lowest_reachable
from textloom.llm.simhash import Groups
from textloom.session import stored

# Code words of a subspace and number of subspaces.
WORDS = 256
SUBSPACES = 8

# Lists are the square root of the number of vectors, up to this many; the index is fitted on a
# sample of this many vectors for each list.
MAX_LISTS = 4096
SAMPLE_PER_LIST = 64

# Vectors of a list that one task holds; more are dealt over blocks, and queries visit each block.
BLOCK = 4096

# Added to the distance to a border, so that rounding keeps no vector from a list.
SLACK = 1e-6

ROUNDS = 8


@dataclass(frozen=True)
class Index:
    """Centres of the lists and code words of the residuals, in double precision."""

    centres: np.ndarray
    words: np.ndarray  # subspace, word, dimension
    reach: float

    @cached_property
    def between(self) -> np.ndarray:
        """Distances between all centres."""
        return np.sqrt(_squares(self.centres, self.centres)).astype(np.float32)

    def codes(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code words of residuals and the length of what they leave out."""
        parts = _parts(residuals, self.words.shape[2])
        codes = np.empty((len(residuals), len(self.words)), dtype=np.uint8)
        left = np.zeros(len(residuals))
        for m, words in enumerate(self.words):
            far = _squares(parts[:, m], words)
            codes[:, m] = far.argmin(1)
            left += far[np.arange(len(far)), codes[:, m]]
        return codes, np.sqrt(left)

    def lists(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The own list of each vector, and which lists it visits (its own included)."""
        far = _squares(units, self.centres)
        own = far.argmin(1)
        # the difference over twice the distance of the centres is the distance to the border
        border = (far - far[np.arange(len(own)), own][:, None]) <= (self.reach + SLACK) * self.between[own]
        border[np.arange(len(own)), own] = True
        return own, border

    def tables(self, units: np.ndarray, number: int) -> np.ndarray:
        """Squared distances of each vector to all words of each subspace, seen from one centre."""
        parts = _parts(units - self.centres[number], self.words.shape[2])
        return np.stack([_squares(parts[:, m], words) for m, words in enumerate(self.words)], axis=1).astype(np.float32)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T)


def _parts(x: np.ndarray, width: int) -> np.ndarray:
    """Rows cut into subspaces of equal width, the last filled up with zeros."""
    count = -(-x.shape[1] // width)
    full = np.zeros((len(x), count * width))
    full[:, : x.shape[1]] = x
    return full.reshape(len(x), count, width)


def _nearest(x: np.ndarray, centres: np.ndarray, cells: int = 1 << 22) -> np.ndarray:
    """The nearest centre of each row, with ``cells`` distances (32 MB) held at a time."""
    step = max(1, cells // len(centres))
    return np.concatenate([_squares(x[i : i + step], centres).argmin(1) for i in range(0, len(x), step)])


def _means(x: np.ndarray, count: int, seed: int) -> np.ndarray:
    """k-means; a centre without members stays where it is."""
    centres = x[np.random.default_rng(seed).choice(len(x), min(count, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        sizes = np.bincount(own, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit_index(sample: np.ndarray, lists: int, threshold: float) -> Index:
    """Centres and code words from a sample of unit vectors."""
    centres = _means(sample, lists, seed=1)
    residuals = sample - centres[_nearest(sample, centres)]
    width = -(-sample.shape[1] // SUBSPACES)
    parts = _parts(residuals, width)
    words = [_means(parts[:, m], WORDS, seed=2 + m) for m in range(parts.shape[1])]
    return Index(centres, np.stack(words), float(np.sqrt(2 - 2 * threshold)))


def _units(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # squares of extreme numbers stay finite
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _comparable(column: Column, dims: int | None) -> Column:
    """Whether a vector has the right length, if one is given, only finite components and one that is not zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    length = F.lit(True) if dims is None else F.size(column) == dims
    return F.coalesce(length & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _matrix(classes: DataFrame, dims: int) -> np.ndarray:
    """The vectors of a bounded table on the driver."""
    column = classes.select("vector").toArrow()["vector"].combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


CELL = "list int, block int, is_query boolean, key bigint, n bigint, own int, vector binary, codes binary, error double"


def cosine_links(classes: DataFrame, dims: int, threshold: float = 0.9, block: int = BLOCK, max_lists: int = MAX_LISTS) -> DataFrame:
    """``(a, links, b)`` from distinct vectors ``(key, n, vector)`` that are ``n`` rows each.

    The sum of ``links`` over rows with one ``a`` is the number of rows that its vector is linked
    to. ``(a, b)``, where ``b`` is not NULL, are links that connect what is linked; they are a star
    in each block and not all pairs.
    """
    spark, schema = classes.sparkSession, classes.schema["vector"].dataType
    kind = "<f4" if schema.elementType.typeName() == "float" else "<f8"
    total = classes.count()
    if total < 2:
        return spark.createDataFrame([], "a bigint, links bigint, b bigint")
    lists = int(min(max_lists, max(1, round(total**0.5))))
    share = min(1.0, max(SAMPLE_PER_LIST * lists, 4096) / total)
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1  # 64 x 4096 vectors at most, about
    sample = _matrix(classes.where(drawn), dims)
    if not len(sample):
        sample = _matrix(classes.limit(4096), dims)
    shared = spark.sparkContext.broadcast(fit_index(_units(sample), lists, threshold))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for some in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                vectors = some.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)
                units = _units(vectors)
                own, visits = index.lists(units)
                codes, errors = index.codes(units - index.centres[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        some.column(1),
                        pa.array(own.astype(np.int32)),
                        pa.array([np.flatnonzero(v).astype(np.int32) for v in visits], pa.list_(pa.int32())),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(errors),
                    ],
                    ["key", "n", "own", "visits", "vector", "codes", "error"],
                )

    schema = "key bigint, n bigint, own int, visits array<int>, vector binary, codes binary, error double"
    placed = stored(classes.select("key", "n", "vector").mapInArrow(place, schema), "placed")
    sizes = placed.groupBy("own").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes.withColumnRenamed("own", "list"))  # a row for each list
    number = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    members = placed.withColumn("list", F.col("own")).join(sizes, "list").withColumn("block", number)
    members = members.select("list", "block", F.lit(False).alias("is_query"), "key", "n", "own", "vector", "codes", "error")
    queries = placed.withColumn("list", F.explode("visits")).join(sizes, "list")
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    nothing = F.lit(None)
    queries = queries.select("list", "block", F.lit(True).alias("is_query"), "key", "n", "own", "vector", nothing.cast("binary").alias("codes"), nothing.cast("double").alias("error"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, cell = shared.value, None
        for batch in batches:
            lists_, blocks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((lists_[1:] != lists_[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lists_)]):
                if cell is None or cell.place != (lists_[a], blocks[a]):
                    if cell is not None:
                        yield cell.end()
                    cell = _Cell((int(lists_[a]), int(blocks[a])), index, dims, kind, threshold)
                yield from cell.add(batch.slice(a, b - a))
        if cell is not None:
            yield cell.end()

    cells = members.union(queries).repartition("list", "block").sortWithinPartitions("list", "block", "is_query", "key")
    return cells.mapInArrow(compare, "a bigint, links bigint, b bigint")


class _Cell:
    """One block of a list: its members are held, its queries pass by."""

    def __init__(self, place: tuple[int, int], index: Index, dims: int, kind: str, threshold: float):
        self.place, self.index, self.dims, self.kind, self.threshold = place, index, dims, kind, threshold
        self.members: list[pa.RecordBatch] = []
        self.ready = False

    def _vectors(self, rows: pa.Table) -> np.ndarray:
        joined = b"".join(rows["vector"].to_pylist())
        return np.frombuffer(joined, dtype=self.kind).reshape(-1, self.dims).astype(np.float64)

    def _prepare(self) -> None:
        rows = pa.Table.from_batches(self.members)
        self.key, self.n = rows["key"].to_numpy(), rows["n"].to_numpy()
        self.vectors = self._vectors(rows)
        self.units = _units(self.vectors)
        self.codes = np.frombuffer(b"".join(rows["codes"].to_pylist()), dtype=np.uint8).reshape(len(self.key), -1)
        # single-precision sums of eight squares: a small allowance keeps the bound safe
        self.bound = ((self.index.reach + rows["error"].to_numpy() + 1e-3) ** 2).astype(np.float32)
        self.visits = self.index.lists(self.units)[1]
        self.links, self.groups, self.ready = np.zeros(len(self.key), dtype=np.int64), Groups(len(self.key)), True

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        is_query = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        first = int(np.argmax(is_query)) if is_query.any() else len(is_query)
        if first:
            self.members.append(batch.slice(0, first))
        for i in range(first, len(is_query), 512):
            if not self.ready:
                if not self.members:
                    return
                self._prepare()
            yield self._ask(pa.Table.from_batches([batch.slice(i, 512)]))

    def _ask(self, rows: pa.Table) -> pa.RecordBatch:
        number, index = self.place[0], self.index
        key, n, own = (rows[c].to_numpy() for c in ("key", "n", "own"))
        vectors = self._vectors(rows)
        units = _units(vectors)
        tables = index.tables(units, number)
        far = np.zeros((len(key), len(self.key)), dtype=np.float32)
        for m in range(tables.shape[1]):
            far += tables[:, m].take(self.codes[:, m], axis=1)
        q, x = np.nonzero(far <= self.bound)
        # each pair once: within a list from its lower key; between lists in one that the other visits
        here = own[q] == number
        once = np.where(here, key[q] < self.key[x], (own[q] > number) | ~self.visits[x, own[q]])
        q, x = q[once], x[once]
        close = np.empty(len(q), dtype=bool)
        for i in range(0, len(q), 1 << 16):
            a, b = units[q[i : i + (1 << 16)]], self.units[x[i : i + (1 << 16)]]
            close[i : i + (1 << 16)] = np.einsum("ij,ij->i", a, b) >= self.threshold
        q, x = q[close], x[close]
        np.add.at(self.links, x, n[q])
        found, at, mine = np.unique(q, return_index=True, return_inverse=True)
        self.groups.join(x[at][mine], x)
        counts = np.bincount(mine, weights=self.n[x], minlength=len(found)).astype(np.int64)
        return _links(key[found], counts, self.key[x[at]])

    def end(self) -> pa.RecordBatch:
        if not self.ready:
            return _links(np.array([], np.int64), np.array([], np.int64), np.array([], np.int64))
        linked = np.flatnonzero((self.links > 0) | (self.groups.label != np.arange(len(self.key))))
        return _links(self.key[linked], self.links[linked], self.key[self.groups.label[linked]])


def _links(a: np.ndarray, links: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(links, pa.int64()), pa.array(b, pa.int64())], ["a", "links", "b"])


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    dims: int | None = None,
    block: int = BLOCK,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each input row.

    Two rows are linked if the cosine of their vectors is ``threshold`` or more. ``n_links``
    counts the other rows linked, ``component_id`` is the smallest id reachable by links, and
    ``kept`` says whether it is the row's own. Links with a lower cosine are never made and none
    is missed. Equal vectors are one class before any search, so copies cost nothing. Vectors of
    each length are searched on their own, one length after the other; with ``dims`` those of
    other lengths link with nothing, as does a vector that is NULL, zero or has NULL or
    non-finite components. Repeated rows link with each other; a NULL id is never the smallest.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vector"))
    rows = rows.withColumn("vector", F.when(_comparable(F.col("vector"), dims), F.transform("vector", lambda x: x + 0)))
    grouped = rows.where(F.col("vector").isNotNull()).groupBy("vector").agg(F.min("vec_id").alias("low_id"), F.count("*").alias("n"))
    classes = stored(grouped.withColumn("key", F.monotonically_increasing_id()), "classes")
    lengths = classes.groupBy(F.size("vector").alias("dims")).count().orderBy("dims").collect()  # a row for each length
    links = vectors.sparkSession.createDataFrame([], "a bigint, links bigint, b bigint")
    for length in (row["dims"] for row in lengths if row["count"] > 1):
        group = classes.where(F.size("vector") == length).select("key", "n", "vector")
        links = links.union(stored(cosine_links(group, length, threshold, block), "cosine_links"))
    counts = links.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    components = connected_components(links, "a", "b").select(F.col("node").alias("key"), "component")
    joined = classes.join(counts, "key", "left").join(components, "key", "left")
    joined = stored(joined, "linked")
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    placed = lowest_reachable(joined, "component", "low_id", "key", "component_id")
    described = placed.select("vector", n_links.alias("n_links"), "component_id")
    found = rows.join(described, "vector", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
