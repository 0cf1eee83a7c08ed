"""Near duplicates by SimHash fingerprints, linked by a self-join of their binary trie.

Two fingerprints within ``budget`` differing bits agree on one of ``budget + 1`` blocks of bits.
For each block the trie is built with that block on top; there the budget is zero, so only equal
blocks meet, and these subtrees are what Spark spreads over tasks. Below, a task walks pairs of
nodes together, adds up the bits in which they differ, and leaves a pair once the sum exceeds
the budget. Pairs of subtrees that already are one component are left too, so a dense group costs
about its size, and a task hands on a spanning star of each group and not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StructType, VariantType

from textloom.llm.columns import free_name
from textloom.llm.components import connected_components, lowest_reachable
from textloom.llm.worker import release
from textloom.operators.joins import BROADCAST_ROWS, lookup_join
from textloom.session import stored

BITS = 64
SEED = 42

# Shingles whose bits are counted at a time.
SHINGLES = 1 << 16

# Fingerprints of one subtree that a task takes; larger subtrees are split further down the trie.
SUBTREE = 1 << 21

# Distinct fingerprints from which keys take one more block, so that subtrees stay small.
MORE_BLOCKS = (1 << 23, 1 << 31)

# Node pairs a task expands at a time, and pairs of leaves it compares instead of descending.
PAIRS = 1 << 17
LEAVES = 64


def fingerprint(text: str | None, shingle: int = 4, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash: a bit is set if more than half of the shingle hashes have it."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words))
    starts, ends = starts[: len(words) - span + 1], ends[span - 1 :]
    counts, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(starts), SHINGLES):
        cuts = zip(starts[i : i + SHINGLES].tolist(), ends[i : i + SHINGLES].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in cuts], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = SEED, out: str = "fingerprint", text_col: str = "text") -> DataFrame:
    """Add ``out``, the fingerprint as a signed bigint. NULL and texts without words get 0."""

    @F.arrow_udf(LongType())
    def of_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            found = [fingerprint(text, shingle, seed) for text in batch.to_pylist()]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, of_texts(F.col(text_col)))


class Groups:
    """Components of the entries of one array, by their lowest position."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self._changes()

    def _changes(self) -> None:
        self.changes = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        label, moved = self.label, False
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, moved = i[apart], j[apart], True
            np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while not np.array_equal(up := label[label], label):
                label = up
        self.label = label
        if moved:
            self._changes()

    def uniform(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return self.changes[hi - 1] == self.changes[lo]


def join_trie(bits: np.ndarray, roots: list[tuple[int, int, int, int]], depth: int, differing: int, budget: int, groups: Groups) -> None:
    """Link all entries of the sorted ``bits`` below pairs of nodes that differ in ``budget`` bits at most.

    A node is a range of positions that share their first ``depth`` bits; ``roots`` are pairs
    ``(from, to, from, to)`` of such nodes, a node with itself or an earlier with a later one.
    """
    start = np.array(roots, dtype=np.int64).reshape(-1, 4).T
    stack = [(depth, *start, np.full(start.shape[1], differing, dtype=np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        open_ = (alo < ahi) & (blo < bhi) & (diff <= budget) & ~((alo == blo) & (ahi - alo < 2))
        alo, ahi, blo, bhi, diff = (x[open_] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        done = groups.uniform(alo, ahi) & groups.uniform(blo, bhi) & (groups.label[alo] == groups.label[blo])
        alo, ahi, blo, bhi, diff = (x[~done] for x in (alo, ahi, blo, bhi, diff))
        if len(alo) > PAIRS:
            for part in np.array_split(np.arange(len(alo)), len(alo) // PAIRS + 1):
                stack.append((depth, *(x[part] for x in (alo, ahi, blo, bhi, diff))))
            continue
        few = ((ahi - alo) * (bhi - blo) <= LEAVES) | (depth >= BITS)
        if few.any():
            sizes = (ahi - alo) * (bhi - blo)
            at = np.repeat(np.flatnonzero(few), sizes[few])
            k = np.arange(len(at)) - np.repeat(np.cumsum(sizes[few]) - sizes[few], sizes[few])
            width = (bhi - blo)[at]
            i, j = alo[at] + k // width, blo[at] + k % width
            near = (i < j) & (np.bitwise_count(bits[i] ^ bits[j]) <= budget)
            groups.join(i[near], j[near])
            alo, ahi, blo, bhi, diff = (x[~few] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        bit = np.uint64(1 << (BITS - 1 - depth))
        above = np.uint64((1 << BITS) - (1 << (BITS - depth)))

        def middle(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            return np.clip(np.searchsorted(bits, (bits[lo] & above) | bit), lo, hi)

        amid, bmid, same = middle(alo, ahi), middle(blo, bhi), alo == blo
        cross = ~same
        children = [
            (alo, amid, blo, bmid, diff),
            (amid, ahi, bmid, bhi, diff),
            (alo, amid, bmid, bhi, diff + 1),
            tuple(x[cross] for x in (amid, ahi, blo, bmid, diff + 1)),
        ]
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*children))))


def _blocks(budget: int, agree: int) -> list[tuple[tuple[int, int], ...]]:
    """For each choice of ``agree`` of ``budget + agree`` blocks: all blocks (offset, width), the chosen first."""
    count = budget + agree
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [(a, b - a) for a, b in zip(edges, edges[1:])]
    return [tuple([blocks[i] for i in chosen] + [b for i, b in enumerate(blocks) if i not in chosen]) for chosen in combinations(range(count), agree)]


def _turned(values: np.ndarray, blocks: tuple[tuple[int, int], ...]) -> np.ndarray:
    """The values with their blocks of bits in another order, the first block on top."""
    out, at = np.zeros(len(values), dtype=np.uint64), BITS
    for offset, width in blocks:
        at -= width
        out |= ((values >> np.uint64(offset)) & np.uint64((1 << width) - 1)) << np.uint64(at)
    return out


def _turned_back(values: np.ndarray, blocks: tuple[tuple[int, int], ...]) -> np.ndarray:
    out, at = np.zeros(len(values), dtype=np.uint64), BITS
    for offset, width in blocks:
        at -= width
        out |= ((values >> np.uint64(at)) & np.uint64((1 << width) - 1)) << np.uint64(offset)
    return out


CELL = "turn int, x bigint, x_depth int, y bigint, y_depth int, bits bigint"


def hamming_links(prints: DataFrame, column: str, budget: int, subtree: int = SUBTREE, agree: int | None = None) -> DataFrame:
    """``(a, b)``: links that connect just the distinct values of ``column`` within ``budget`` differing bits.

    Not all pairs: a star over each group that a task finds, so there are fewer rows than values
    times turns of the trie. ``agree`` is the number of blocks in a key; by default it follows
    the number of values. No subtree is skipped: one with more than ``subtree`` values is cut into
    deeper nodes, and those pairs of nodes that are within the budget become tasks of their own.
    """
    values = prints.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    if agree is None:
        size = values.count()
        agree = 1 + sum(size > limit for limit in MORE_BLOCKS)
    turns = _blocks(budget, agree)
    key_bits = [sum(width for _, width in blocks[:agree]) for blocks in turns]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy().view(np.uint64)
            for number, blocks in enumerate(turns):
                yield _cells(number, _turned(found, blocks), key_bits[number])

    cells = values.mapInArrow(turn, CELL)
    heavy = cells.groupBy("turn", "x").count().where(F.col("count") > subtree).select("turn", "x")
    heavy = stored(heavy, "heavy")
    if not heavy.isEmpty():
        cells = _split_heavy(stored(cells, "cells"), heavy, subtree, budget)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            number, x_depth, y_depth = int(rows["turn"][0]), int(rows["x_depth"][0]), int(rows["y_depth"][0])
            bits = rows["bits"].view(np.uint64)
            groups = Groups(len(bits))
            near = np.flatnonzero(np.bitwise_count(bits[1:] ^ bits[:-1]) <= budget)
            groups.join(near, near + 1)
            depth, x, y = min(x_depth, y_depth), int(rows["x"][0]), int(rows["y"][0])
            if x == y:  # one or many subtrees of a sorted turn, each with itself
                tops = bits >> np.uint64(BITS - depth)
                edges = np.concatenate(([0], np.flatnonzero(tops[1:] != tops[:-1]) + 1, [len(bits)]))
                join_trie(bits, [(a, b, a, b) for a, b in zip(edges, edges[1:])], depth, 0, budget, groups)
            else:
                cut = int(np.searchsorted(bits, np.array([y], dtype=np.int64).view(np.uint64)[0]))
                above = BITS - depth
                apart = (((x ^ y) & ((1 << BITS) - 1)) >> above).bit_count()
                join_trie(bits, [(0, cut, cut, len(bits))], depth, apart, budget, groups)
            linked = np.flatnonzero(groups.label != np.arange(len(bits)))
            back = _turned_back(bits, turns[number]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(back[linked]), pa.array(back[groups.label[linked]])], ["a", "b"])

    order = [F.col("turn"), F.col("x_depth"), F.col("y_depth"), (F.col("x") != F.col("y")), _unsigned("x"), _unsigned("y"), _unsigned("bits")]
    return cells.repartition("turn", "x", "y").sortWithinPartitions(*order).mapInArrow(join, "a bigint, b bigint")


def _unsigned(column: str):
    return F.col(column).bitwiseXOR(F.lit(-(1 << 63)))  # sorts a bigint as unsigned


def _cells(number: int, bits: np.ndarray, depth: int) -> pa.RecordBatch:
    prefix = (bits >> np.uint64(BITS - depth)) << np.uint64(BITS - depth)
    n = len(bits)
    columns = [np.full(n, number, np.int32), prefix.view(np.int64), np.full(n, depth, np.int32), prefix.view(np.int64), np.full(n, depth, np.int32), bits.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["turn", "x", "x_depth", "y", "y_depth", "bits"])


def _whole_cells(batches: Iterator[pa.RecordBatch], rows_held: int = 1 << 20) -> Iterator[dict[str, np.ndarray]]:
    """Cells of sorted rows: many subtrees with the same turn and depth together, a pair of nodes alone."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        new = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
        held = new if held is None else {k: np.concatenate((held[k], new[k])) for k in held}
        if len(held["turn"]) < rows_held:
            continue
        cuts = _cuts(held)
        for a, b in zip(cuts[:-2], cuts[1:-1]):  # the last may go on in the next batch
            yield {k: v[a:b] for k, v in held.items()}
        held = {k: v[cuts[-2] :] for k, v in held.items()}
        one = (held["x"] == held["x"][0]) & (held["y"] == held["y"][0])
        if one.all() or held["x"][0] != held["y"][0]:
            continue
        last = int(np.flatnonzero(held["x"] != held["x"][-1])[-1]) + 1  # all subtrees but the open one
        yield {k: v[:last] for k, v in held.items()}
        held = {k: v[last:] for k, v in held.items()}
    if held is not None and len(held["turn"]):
        cuts = _cuts(held)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield {k: v[a:b] for k, v in held.items()}


def _cuts(rows: dict[str, np.ndarray]) -> list[int]:
    pair = rows["x"] != rows["y"]
    new = np.zeros(len(pair), dtype=bool)
    for name in ("turn", "x_depth", "y_depth"):
        new[1:] |= rows[name][1:] != rows[name][:-1]
    new[1:] |= pair[1:] != pair[:-1]
    new[1:] |= pair[1:] & ((rows["x"][1:] != rows["x"][:-1]) | (rows["y"][1:] != rows["y"][:-1]))
    return [0, *np.flatnonzero(new).tolist(), len(pair)]


def _split_heavy(cells: DataFrame, heavy: DataFrame, subtree: int, budget: int, step: int = 4) -> DataFrame:
    """Cut heavy subtrees into nodes of at most ``subtree`` values; pair the nodes that the budget lets meet.

    A node's bits below its depth are zero, and ``x`` and ``y`` of a cell are its two nodes. There
    are about as many nodes as heavy values divided by ``subtree``.
    """
    plain = cells.join(F.broadcast(heavy), ["turn", "x"], "left_anti")  # at most values times turns / subtree rows
    rest = cells.join(F.broadcast(heavy), ["turn", "x"], "left_semi").select("turn", F.col("x").alias("top"), F.col("x_depth").alias("depth"), "bits")
    leaves = None
    while True:
        depth = F.least(F.col("depth") + step, F.lit(BITS))
        node = F.col("bits").bitwiseAND(F.when(depth == BITS, F.lit(-1)).otherwise(F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(BITS) - depth)))
        rest = stored(rest.withColumn("depth", depth).withColumn("node", node), "nodes")
        sizes = rest.groupBy("turn", "top", "node", "depth").agg(F.count("*").alias("n"))
        small = stored(sizes.where((F.col("n") <= subtree) | (F.col("depth") == BITS)).drop("n"), "leaves")
        placed = rest.join(small, ["turn", "top", "node", "depth"], "left_semi")
        leaves = placed if leaves is None else leaves.union(placed)
        rest = rest.join(small, ["turn", "top", "node", "depth"], "left_anti").drop("node")
        if rest.isEmpty():
            break
    leaves = stored(leaves.select("turn", "top", "node", "depth", "bits"), "leaves")
    nodes = leaves.select("turn", "top", "node", "depth").distinct()
    x = nodes.select("turn", "top", F.col("node").alias("x"), F.col("depth").alias("x_depth"))
    y = nodes.select("turn", "top", F.col("node").alias("y"), F.col("depth").alias("y_depth"))
    shared = F.least("x_depth", "y_depth")
    apart = F.bit_count(F.call_function("shiftrightunsigned", F.col("x").bitwiseXOR(F.col("y")), F.lit(BITS) - shared))
    pairs = stored(x.join(y, ["turn", "top"]).where((_unsigned("x") <= _unsigned("y")) & (apart <= budget)), "node_pairs")
    first = leaves.join(pairs, (leaves["node"] == pairs["x"]) & (leaves["turn"] == pairs["turn"]) & (leaves["top"] == pairs["top"]))
    second = leaves.join(pairs.where("x <> y"), (leaves["node"] == pairs["y"]) & (leaves["turn"] == pairs["turn"]) & (leaves["top"] == pairs["top"]))
    columns = [pairs["turn"], "x", "x_depth", "y", "y_depth", "bits"]
    plain = plain.select("turn", "x", "x_depth", "y", "y_depth", "bits")
    return plain.union(first.select(*columns)).union(second.select(*columns))


def near_duplicates(docs: DataFrame, shingle: int = 4, budget: int = 4, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fingerprint, cluster, component_id)``, one row for each input row.

    Rows link if their fingerprints differ in ``budget`` bits at most; ``cluster`` is the lowest
    fingerprint of what is reachable by links and ``component_id`` the smallest id there. Texts
    without words and NULL have fingerprint 0 and link like any other; so do repeated rows. A
    NULL id is never the smallest unless all are NULL. ``text_hash`` tells rows of one id apart.
    Copies are one fingerprint before any join, and texts are read once and never shuffled.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    rows = stored(fingerprints(found, shingle, seed).drop("text"), "fingerprints")
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low_id")), "classes")
    components = connected_components(hamming_links(classes, "fingerprint", budget), "a", "b")
    linked = stored(classes.join(components, classes["fingerprint"] == components["node"], "left").drop("node"), "linked")
    placed = lowest_reachable(linked, "component", "low_id", "fingerprint", "component_id")
    placed = placed.select("fingerprint", F.coalesce("component", "fingerprint").alias("cluster"), "component_id")
    # rows of one fingerprint may be very many
    return lookup_join(rows, stored(placed, "placed"), "fingerprint", ["doc_id", "text_hash"], "inner").select(
        "doc_id", "text_hash", "fingerprint", "cluster", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    budget: int = 4,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """The rows of ``docs`` of which each cluster keeps one: that of its smallest id.

    Of texts with that id the one with the lowest hash stays, and of rows with that id and text
    the lowest by all columns that have an order; a NULL id stays only where there is no other.
    All columns stay as they are, whatever their names. Texts that are NULL or have no words are
    one cluster; an empty table stays empty.

    What goes is decided on ids and hashes. Up to ``limit`` of them are broadcast, so texts are
    read in place; more are joined, which shuffles texts once. Repeats of a row that stays are
    compared with each other only.
    """
    found = near_duplicates(docs, shingle, budget, seed, id_col, text_col)
    each = stored(found.groupBy("doc_id", "text_hash").agg(F.min("cluster").alias("cluster"), F.count("*").alias("n")), "texts")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = each.groupBy("cluster").agg(F.min(F.struct(order.alias("order"), "n")).alias("first"))
    kept = stored(first.select("first.order.doc_id", "first.order.text_hash", "first.n"), "kept")
    own, twin, mark = (free_name(docs, stem) for stem in ("text_hash", "other_id", "other_hash"))
    named = [F.col("doc_id").alias(twin), F.col("text_hash").alias(mark)]
    same = F.col(id_col).eqNullSafe(F.col(twin)) & (F.col(own) == F.col(mark))
    stays = each["doc_id"].eqNullSafe(kept["doc_id"]) & (each["text_hash"] == kept["text_hash"])
    gone = stored(each.join(kept, stays, "left_anti").select(*named), "gone")
    repeated = stored(kept.where("n > 1").select(*named), "repeated")
    hashed = docs.withColumn(own, F.xxhash64(text_col))
    n_gone, n_repeated = gone.count(), repeated.count()

    def bounded(table: DataFrame, rows: int) -> DataFrame:
        return F.broadcast(table) if rows <= limit else table.hint("merge")

    single = hashed.join(bounded(gone, n_gone), same, "left_anti")
    if not n_repeated:
        return single.drop(own)
    single = single.join(bounded(repeated, n_repeated), same, "left_anti").drop(own)
    copies = hashed.join(bounded(repeated, n_repeated), same, "left_semi")
    ordered = F.struct(*[F.col(f"`{f.name}`") for f in docs.schema if _has_order(f.dataType)])
    lowest = copies.groupBy(id_col, own).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), ordered).alias(mark))
    return single.union(lowest.select(f"{mark}.*"))


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, StructType):
        return all(_has_order(field.dataType) for field in kind)
    return not isinstance(kind, (MapType, VariantType))
