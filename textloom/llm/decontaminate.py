"""Passages of benchmark items inside documents, by one Aho-Corasick automaton over words."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.columns import free_name, new_column
from textloom.llm.worker import held
from textloom.session import stored, work_path
from textloom.sources.blocks import read_block, write_block

# Words of a window.
WINDOW = 13

# Characters of benchmark words behind one automaton, 260 MB as measured on prose; more takes several.
PART_CHARS = 1 << 20

# Words of an item that stay together; a longer item is cut into pieces that overlap by a window.
PIECE_WORDS = 1 << 14

# Text that a task holds while one automaton after the other reads it.
CHUNK_BYTES = 1 << 26

# Bytes that make up words: digits, letters and all of non-ASCII; A-Z become a-z, the rest spaces.
_WORD = bytes((b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

# A word that no item has.
_OTHER = chr(0x10000) * 2

SPANS = "array<struct<item_id: string, start: bigint, end: bigint>>"
HITS = f"struct<n_words: bigint, hits: array<int>, items: array<string>, spans: {SPANS}>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD).split()


def windows(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """Windows of ``size`` consecutive words; all words if they are fewer, but not none."""
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


class Finder:
    """All windows of some items in one automaton over words; a text is read once.

    A word of the items is two signs, one of a first and one of a second alphabet, so that no match
    begins inside a word; all other words are one and the same pair. Windows are short that way,
    and a node has few branches.
    """

    def __init__(self, items: Iterable[tuple[str | None, str | None]], size: int = WINDOW):
        pieces = [(item, words_of(text)) for item, text in items]
        known = dict.fromkeys(word for _, words in pieces for word in words)
        side = math.isqrt(len(known)) + 1
        self._codes = {word: chr(0x20000 + i // side) + chr(0x40000 + i % side) for i, word in enumerate(known)}
        owners: dict[str, set[str | None]] = {}
        for item, words in pieces:
            for window in windows([self._codes[word] for word in words], size):
                owners.setdefault("".join(window), set()).add(item)
        self._automaton = ahocorasick.Automaton()
        for window, found in owners.items():
            self._automaton.add_word(window, (len(window) // 2, sorted(i for i in found if i is not None)))
        self._automaton.make_automaton()
        self._empty = not owners

    def find(self, text: str | None, spans: bool = False) -> tuple[int, list[int], list[str], list[dict]]:
        """``(n_words, hit word positions, item ids, spans)``.

        The normalised text has one byte for each byte of the original, so a word's place in it
        is its place in the original; spans count characters of the original.
        """
        original = (text or "").encode()
        plain = original.translate(_WORD)
        words = plain.split()
        if self._empty or not words:
            return len(words), [], [], []
        matches = list(self._automaton.iter("".join(map(self._codes.get, words, repeat(_OTHER)))))
        if not matches:
            return len(words), [], [], []
        lasts = np.array([end for end, _ in matches]) // 2
        counts = np.array([count for _, (count, _) in matches])
        steps = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(steps, lasts - counts + 1, 1)
        np.add.at(steps, lasts + 1, -1)
        hits = np.flatnonzero(np.cumsum(steps[:-1]) > 0).tolist()
        items = sorted({item for _, (_, owners) in matches for item in owners})
        return len(words), hits, items, self._spans(original, plain, matches, lasts, counts) if spans else []

    @staticmethod
    def _spans(original: bytes, plain: bytes, matches: list, lasts: np.ndarray, counts: np.ndarray) -> list[dict]:
        inside = np.frombuffer(plain, np.uint8) != 32
        edges = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        character = np.concatenate(([0], np.cumsum((np.frombuffer(original, np.uint8) & 0xC0) != 0x80)))
        found = {
            (item, int(character[starts[last - count + 1]]), int(character[ends[last]]))
            for (_, (_, owners)), last, count in zip(matches, lasts, counts)
            for item in owners
        }
        return [{"item_id": item, "start": start, "end": end} for item, start, end in sorted(found, key=lambda x: (x[1], x[2], x[0]))]


def find_passages(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, spans: bool = True, part_chars: int = PART_CHARS, text_col: str = "text", out: str = "found") -> DataFrame:
    """Add ``out``: ``n_words``, positions of ``hits``, ``items`` with occurring windows, and ``spans``.

    Words are runs of digits, letters and non-ASCII characters, with A-Z in lower case. A window
    is ``size`` consecutive words of an item, or a shorter item as a whole; a document word is hit
    if it lies in any occurrence of a window. ``spans`` are ``(item_id, start, end)`` in
    characters of the original text; without ``spans`` the list is empty. Items are the ids as
    strings, each once, sorted; windows of an item without id count as hits only. NULL, empty
    texts and texts without words have no hits, items without words no windows. Repeated rows of
    an item are one; repeated documents are found alike. A column named ``out`` is an error.

    Distinct items are stored in the shared folder in parts of about ``part_chars`` characters; no
    item passes through the driver. Up to that size the benchmark is one automaton in every worker. Beyond it
    a task holds a chunk of its texts and lets one automaton after the other read it, with one in
    memory at a time. Texts are read once in place, without a shuffle.
    """
    folder, count = _stored_parts(benchmark, size, part_chars)

    def finder(part: int) -> Finder:
        def make() -> Finder:
            rows = read_block(f"{folder}/part-{part}")
            return Finder(zip(rows["item"].to_pylist(), rows["text"].to_pylist()), size)

        return held(("finder", folder, part), make)

    @F.arrow_udf(HITS)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if count <= 1:
            for batch in batches:
                one = finder(0) if count else Finder([], size)
                yield _hits([one.find(text, spans) for text in batch.to_pylist()])
            return
        for chunk in _chunks(batches, CHUNK_BYTES):
            found = None
            for part in range(count):
                one = finder(part)
                new = [[one.find(text, spans) for text in batch.to_pylist()] for batch in chunk]
                found = new if found is None else [[_both(x, y) for x, y in zip(a, b)] for a, b in zip(found, new)]
            yield from map(_hits, found or [])

    return docs.withColumn(new_column(docs, out), scan(F.col(text_col)))


def _stored_parts(benchmark: DataFrame, size: int, part_chars: int) -> tuple[str, int]:
    """Write pieces of the distinct items as blocks ``part-0`` and so on; the folder and their number."""
    spark = benchmark.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                for i in range(0, max(1, len(words) - size + 1) if words else 0, PIECE_WORDS):
                    piece = b" ".join(words[i : i + PIECE_WORDS + size - 1]).decode()
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.string()), pa.array([piece], pa.string())], ["item", "text"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    pieces = stored(items.mapInArrow(cut, "item string, text string"), "benchmark_pieces")
    total = pieces.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    count = -(-total // part_chars)
    folder = work_path(spark, "benchmark_parts")

    def write(rows: pa.Table) -> pa.Table:
        write_block(f"{folder}/part-{rows['part'][0].as_py()}", rows.select(["item", "text"]))
        return pa.table({"part": rows["part"].slice(0, 1)})

    if count:
        number = F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("int")
        parts = pieces.withColumn("part", number).groupBy("part").applyInArrow(write, "part int").collect()  # numbers only
        for part in set(range(count)) - {row["part"] for row in parts}:
            write_block(f"{folder}/part-{part}", pa.table({"item": pa.array([], pa.string()), "text": pa.array([], pa.string())}))
    return folder, count


def _chunks(batches: Iterator[pa.Array], size: int) -> Iterator[list[pa.Array]]:
    chunk: list[pa.Array] = []
    for batch in batches:
        chunk.append(batch)
        if sum(b.nbytes for b in chunk) >= size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def _both(x: tuple, y: tuple) -> tuple:
    """What two automata found in one text; one item may have pieces in both."""
    if not y[1]:
        return x
    if not x[1]:
        return y
    places = {(s["start"], s["end"], s["item_id"]): s for s in (*x[3], *y[3])}
    return x[0], sorted({*x[1], *y[1]}), sorted({*x[2], *y[2]}), [places[k] for k in sorted(places)]


def _hits(found: list[tuple]) -> pa.Array:
    n_words, hits, names, places = zip(*found) if found else ((), (), (), ())
    return pa.StructArray.from_arrays(
        [
            pa.array(n_words, pa.int64()),
            pa.array(hits, pa.list_(pa.int32())),
            pa.array(names, pa.list_(pa.string())),
            pa.array(places, pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ],
        ["n_words", "hits", "items", "spans"],
    )


def is_contaminated(found: Column, share: int = 20) -> Column:
    """Whether any word is hit and hits are at least one in ``share`` of all words."""
    hits = F.size(found["hits"])
    return (hits > 0) & (share * hits >= found["n_words"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row for each input row.

    See ``find_passages`` for NULL, empty and repeated texts and items. ``items_sha256`` is the
    digest of the item ids, sorted as strings and joined by commas, of nothing for none. Other
    columns are left out, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = F.col("found")
    return find_passages(rows, benchmark, size, spans=False).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        F.size(found["hits"]).cast("bigint").alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        is_contaminated(found).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns as they are, whatever their names.

    NULL, empty texts and texts without words stay; repeated rows stay or go together; an empty
    table, or a benchmark without words, changes nothing.
    """
    out = free_name(docs, "found")
    found = find_passages(docs, benchmark, size, spans=False, text_col=text_col, out=out)
    return found.where(~is_contaminated(F.col(out))).drop(out)
