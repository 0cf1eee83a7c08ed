"""A vocabulary that every worker reads from the shared folder, so that tokens need not move to it.

Entries are dealt by a hash of the token into shards. Each shard is one block with a perfect hash: a
token's bucket names a seed, the seed names the one slot where the token can be. A mark of 16 bits
rejects most unknown tokens there, and the string that is stored in the slot decides, so an unknown
token never gets the id of another one. Spark hashes the tokens; tasks map the blocks into memory.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.encoding import UNK_ID
from textloom.session import remove_path, work_path
from textloom.sources.blocks import is_mapped, read_block, write_block

# Entries of a shard, about, and of a bucket of its hash.
SHARD_ENTRIES = 65_536
BUCKET_ENTRIES = 3

# Seeds tried at once for a bucket.
SEEDS_AT_ONCE = 256

# Bytes of blocks that a task holds where they cannot be mapped into memory.
HELD_BYTES = 128_000_000

# Increment and multipliers of the SplitMix64 generator.
INCREMENT = np.uint64(0x9E3779B97F4A7C15)
MULTIPLIERS = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(hashes: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """Numbers from 0 to ``size`` - 1 by hash and seed."""
    x = hashes + (seeds.astype(np.uint64) + np.uint64(1)) * INCREMENT
    x = (x ^ (x >> np.uint64(30))) * MULTIPLIERS[0]
    x = (x ^ (x >> np.uint64(27))) * MULTIPLIERS[1]
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return _mixed(hashes, np.array(0), buckets)


def perfect_seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by bucket and the slot of each hash; hashes differ and slots are 0 to n - 1, each once.

    Large buckets choose first, while most slots are free. A bucket of one takes any free slot,
    written as a negative seed.
    """
    n = len(hashes)
    buckets = -(-n // BUCKET_ENTRIES)
    seeds, slots, taken = np.zeros(buckets, np.int32), np.empty(n, np.int64), np.zeros(n, bool)
    bucket = _bucket(hashes, buckets)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    for b in np.argsort(-sizes, kind="stable"):
        if sizes[b] < 2:
            break
        members = order[ends[b] - sizes[b] : ends[b]]
        first = 1
        while True:
            tried = np.arange(first, first + SEEDS_AT_ONCE)
            places = _mixed(hashes[members][None, :], tried[:, None], n)
            ranked = np.sort(places, axis=1)
            fits = ~taken[places].any(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if fits.any():
                break
            first += SEEDS_AT_ONCE
        own = int(np.argmax(fits))
        seeds[b], slots[members] = tried[own], places[own]
        taken[places[own]] = True
    alone = np.flatnonzero(sizes == 1)
    free = np.flatnonzero(~taken)
    seeds[alone], slots[order[ends[alone] - 1]] = -1 - free, free
    return seeds, slots


@dataclass(frozen=True)
class StoredVocab:
    """A folder and, for each shard, the number of slots of its hash and of its rows in all."""

    folder: str
    shards: tuple[tuple[int, int], ...]

    def remove(self, spark: SparkSession) -> None:
        """Remove the files; results that are not computed yet cannot be after that."""
        remove_path(spark, self.folder)


def store_vocab(vocab: DataFrame, shard_entries: int = SHARD_ENTRIES) -> StoredVocab:
    """Store ``(token, token_id)`` for lookups; a token that is there twice is an error, a NULL one is left out.

    The vocabulary is made once and stored; its entries are shuffled once, to the tasks that write
    their shards; the driver gets three numbers for each shard. An empty vocabulary knows no token.
    """
    spark = vocab.sparkSession
    folder = work_path(spark, "vocab")
    draft = work_path(spark, "entries")
    vocab.where("token IS NOT NULL").select("token", F.col("token_id").cast("int").alias("token_id")).write.parquet(draft)
    try:
        return _store_entries(spark.read.parquet(draft), folder, shard_entries)
    finally:
        remove_path(spark, draft)


def _store_entries(entries: DataFrame, folder: str, shard_entries: int) -> StoredVocab:
    count = -(-entries.count() // shard_entries)
    if not count:
        return StoredVocab(folder, ())
    hashed = entries.withColumn("hash", F.xxhash64("token"))

    def write(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("token")  # a repeated task writes the same file
        shard, tokens = rows["shard"][0].as_py(), rows["token"].combine_chunks()
        if rows["token_id"].null_count or pc.count_distinct(tokens).as_py() < len(tokens):
            raise ValueError("a token of the vocabulary is there twice, or has no id")
        hashes, first = np.unique(rows["hash"].to_numpy().view(np.uint64), return_index=True)
        seeds, slots = perfect_seeds(hashes)
        at = np.empty(len(slots), np.int64)
        at[slots] = first
        others = np.setdiff1d(np.arange(len(tokens)), first)  # tokens whose hash is that of another one
        at = pa.array(np.concatenate((at, others)))
        ordered = rows.take(at)
        marks = (ordered["hash"].to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        padded = np.zeros(len(tokens), np.int32)
        padded[: len(seeds)] = seeds
        columns = [ordered["token"].combine_chunks(), ordered["token_id"].combine_chunks(), pa.array(marks), pa.array(padded)]
        write_block(f"{folder}/{shard}.arrow", pa.Table.from_arrays(columns, ["token", "token_id", "mark", "seed"]))
        return pa.table({"shard": [shard], "slots": [len(slots)], "rows": [len(tokens)]})

    dealt = hashed.withColumn("shard", F.pmod("hash", F.lit(count)))
    manifest = dealt.groupBy("shard").applyInArrow(write, "shard BIGINT, slots BIGINT, rows BIGINT").collect()
    sizes = {row["shard"]: (row["slots"], row["rows"]) for row in manifest}
    return StoredVocab(folder, tuple(sizes.get(shard, (0, 0)) for shard in range(count)))


class _Reader:
    """Blocks as a task uses them: mapped ones stay open, others are held up to ``HELD_BYTES``."""

    def __init__(self, store: StoredVocab):
        self.store, self.mapped = store, is_mapped(store.folder)
        self.blocks: OrderedDict[int, pa.Table] = OrderedDict()

    def block(self, shard: int) -> pa.Table:
        if shard in self.blocks:
            self.blocks.move_to_end(shard)
            return self.blocks[shard]
        found = read_block(f"{self.store.folder}/{shard}.arrow")
        self.blocks[shard] = found
        while not self.mapped and len(self.blocks) > 1 and sum(b.nbytes for b in self.blocks.values()) > HELD_BYTES:
            self.blocks.popitem(last=False)
        return found

    def ids(self, tokens: pa.Array, hashes: np.ndarray, unk_id: int) -> np.ndarray:
        """Ids of tokens with their hashes."""
        found = np.full(len(tokens), unk_id, np.int32)
        if not self.store.shards or not len(tokens):
            return found
        shard = hashes.view(np.int64) % len(self.store.shards)
        order = np.argsort(shard, kind="stable")
        starts = np.flatnonzero(np.diff(shard[order], prepend=-1))
        for rows in np.split(order, starts[1:]):
            self._ids_of_shard(int(shard[rows[0]]), tokens, hashes, rows, found)
        return found

    def _ids_of_shard(self, shard: int, tokens: pa.Array, hashes: np.ndarray, rows: np.ndarray, found: np.ndarray) -> None:
        slots, total = self.store.shards[shard]
        if not total:
            return
        block, own = self.block(shard), hashes[rows]
        seed = block["seed"].to_numpy()[_bucket(own, -(-slots // BUCKET_ENTRIES))]
        slot = np.where(seed < 0, -1 - seed.astype(np.int64), _mixed(own, np.maximum(seed, 0), slots))
        maybe = block["mark"].to_numpy()[slot] == own >> np.uint64(48)
        rows, slot = rows[maybe], slot[maybe]
        same = pc.equal(block["token"].combine_chunks().take(pa.array(slot)), tokens.take(pa.array(rows)))
        same = pc.fill_null(same, False).to_numpy(zero_copy_only=False)
        found[rows[same]] = block["token_id"].to_numpy()[slot[same]]
        if total > slots:
            rest = rows[~same]
            others = block.slice(slots)
            place = pc.index_in(tokens.take(pa.array(rest)), value_set=others["token"].combine_chunks())
            known = place.is_valid().to_numpy(zero_copy_only=False)
            found[rest[known]] = others["token_id"].to_numpy()[place.drop_null().to_numpy()]


def stored_ids(store: StoredVocab, token: Column, unk_id: int = UNK_ID) -> Column:
    """The id of a token; ``unk_id`` for one that is not there and for NULL."""

    @F.arrow_udf("int")
    def look_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        reader = _Reader(store)
        for tokens, hashes in batches:
            yield pa.array(_distinct_ids(reader, tokens, hashes, unk_id))

    return look_up(token, F.xxhash64(token))


def stored_id_arrays(store: StoredVocab, tokens: Column, unk_id: int = UNK_ID) -> Column:
    """The same for each token of an array, in order; a NULL array has no ids."""

    @F.arrow_udf("array<int>")
    def look_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        reader = _Reader(store)
        for rows, hashes in batches:
            ids = _distinct_ids(reader, rows.flatten(), hashes.flatten(), unk_id)
            lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
            offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

    return look_up(tokens, F.transform(tokens, lambda token: F.xxhash64(token)))


def _distinct_ids(reader: _Reader, tokens: pa.Array, hashes: pa.Array, unk_id: int) -> np.ndarray:
    """Each distinct token of a batch is looked up once."""
    coded = tokens.dictionary_encode()
    code = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy()
    own = np.zeros(len(coded.dictionary) + 1, np.int64)
    own[code] = hashes.to_numpy()
    ids = reader.ids(coded.dictionary, own[:-1].view(np.uint64), unk_id)
    return np.append(ids, np.int32(unk_id))[code]
