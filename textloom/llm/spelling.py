"""Words that differ by one letter, by Bloom-guided neighbourhoods.

Every word of the vocabulary is added to a blocked Bloom filter, one for each word length, which
is broadcast. A task generates the edits of its words, as hashes that follow from the word's own
by one addition, and looks each up. Only edits that may be words become strings; they are
shuffled to the vocabulary, which drops those that are none. Being near is mutual, so deletions
and replacements by a later letter reach every pair once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.worker import release
from textloom.operators.joins import lookup_join
from textloom.session import stored, work_path

SHORTEST = 5
LEAST = 3
DELETE_EVERY = 97

# Words counted by a task before it hands its counts on.
TASK_WORDS = 1 << 18

# Bits of the filter for each word, 64-bit cells in a block, and cells that are broadcast at a time (32 MB).
BITS_PER_WORD = 16
BLOCK = 8
PASS_CELLS = 1 << 22

# Edits looked up at a time.
EDITS = 1 << 20

EDIT_SCHEMA = "word STRING, n BIGINT, near STRING"

_RUNS = regex.compile(rf"[a-zÀ-ÿ]{{{SHORTEST},}}")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words of five letters or more that occur three times or more.

    Words are whole runs of ``A-Z a-z À-ÿ`` with A-Z in lower case. Where 97 divides the CRC-32
    of ``<doc_id>:<run>``, the run loses one letter, the one at the CRC-32 modulo its length. NULL
    and empty texts hold no words; a NULL id counts as the empty string. Counts are added up by
    tasks before the shuffle.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts: dict[str, int] = {}

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in Counter(_RUNS.findall(text.encode().lower().decode())).items():
                    code = zlib.crc32(run.encode(), start)
                    if code % DELETE_EVERY == 0:
                        at = code % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < SHORTEST:
                            continue
                    counts[run] = counts.get(run, 0) + n
                if len(counts) >= TASK_WORDS:
                    yield handed_on()
                    counts.clear()
        yield handed_on()

    found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tally, "word STRING, n BIGINT")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


# Odd, so that it has an inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters(codes: np.ndarray) -> np.ndarray:
    return _mix(codes.astype(np.uint64) + np.uint64(_BASE))


def _powers(length: int) -> np.ndarray:
    """The base to the power of each place."""
    out = np.full(length, _BASE, np.uint64)
    if length:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class Layout:
    """Where the words of each length lie in the filter: so many blocks from a first cell on."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = {length: -(-n * BITS_PER_WORD // (64 * BLOCK)) for length, n in sorted(counts.items())}
        self.first, self.cells = {}, 0
        for length, blocks in self.blocks.items():
            self.first[length] = self.cells
            self.cells += blocks * BLOCK

    def places(self, hashes: np.ndarray, length: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Two cells of the block of each word, each with three bits."""
        spread = _mix(hashes)
        block = ((spread >> np.uint64(32)) * np.uint64(self.blocks[length])) >> np.uint64(32)
        first = block * np.uint64(BLOCK) + np.uint64(self.first[length])
        return tuple((first + ((spread >> np.uint64(at)) & np.uint64(7)), _bits(hashes, at)) for at in (0, 3))  # type: ignore[return-value]


def _bits(hashes: np.ndarray, at: int) -> np.ndarray:
    one, low = np.uint64(1), np.uint64(63)
    shifted = hashes >> np.uint64(6 * at)
    return (one << (shifted & low)) | (one << ((shifted >> np.uint64(6)) & low)) | (one << ((shifted >> np.uint64(12)) & low))


class Words:
    """Some words of one length as a matrix of code points, with their hashes and those of their edits."""

    def __init__(self, words: list[str], length: int):
        self.words = words
        self.codes = np.array(words, dtype=f"U{length}").view(np.uint32).reshape(len(words), length)
        self.powers = _powers(length)
        self.terms = _letters(self.codes) * self.powers
        self.sums = np.cumsum(self.terms, axis=1, dtype=np.uint64)
        self.hashes = _mix(self.sums[:, -1])

    def without(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes of the words without one letter; of equal neighbours the first goes."""
        rows = np.flatnonzero(self.codes[:, at] != self.codes[:, at - 1]) if at else np.arange(len(self.codes))
        upto = self.sums[rows, at]
        return rows, _mix(upto - self.terms[rows, at] + (self.sums[rows, -1] - upto) * _INVERSE)

    def replaced(self, at: int, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, new letters and hashes of the words with one letter replaced by a later one."""
        rows, letters = np.nonzero(self.codes[:, at, None] < alphabet)
        rest = self.sums[:, -1] - self.terms[:, at]
        return rows, alphabet[letters], _mix(rest[rows] + (_letters(alphabet) * self.powers[at])[letters])


def _by_length(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Words of equal length, so few at a time that a letter of each has ``EDITS`` edits at most."""
    for batch in batches:
        words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            step = max(1, EDITS // max(width, length))
            for i in range(0, len(rows), step):
                part = rows[i : i + step]
                yield length, [words[row] for row in part.tolist()], n[part]


def _filter_cells(vocabulary: DataFrame, layout: Layout, first: int, last: int) -> np.ndarray:
    """The cells ``first`` to ``last`` of the filter of all words; bits are joined before the shuffle."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for length, words, _ in _by_length(batches, 1):
            for cells, bits in layout.places(Words(words, length).hashes, length):
                own = (cells >= first) & (cells < last)
                columns = [pa.array((cells[own] - np.uint64(first)).astype(np.int64)), pa.array(bits[own].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "bits"])

    added = vocabulary.select("word", "n").mapInArrow(add, "cell BIGINT, bits BIGINT")
    found = added.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()  # ``PASS_CELLS`` rows at most
    cells = np.zeros(last - first, np.uint64)
    cells[found["cell"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return cells


def _candidates(vocabulary: DataFrame, layout: Layout, alphabets: dict[int, np.ndarray], first: int, last: int, path: str) -> None:
    """Write ``(word, n, near)`` of all edits that the cells ``first`` to ``last`` let pass."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(_filter_cells(vocabulary, layout, first, last))
    width = max((len(a) for a in alphabets.values()), default=1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        cells = shared.value

        def passed(hashes: np.ndarray, length: int) -> np.ndarray:
            left = np.arange(len(hashes))
            for place in (0, 1):
                at, bits = layout.places(hashes[left], length)[place]
                own = (at >= first) & (at < last)
                left, at, bits = left[own], at[own] - np.uint64(first), bits[own]
                left = left[cells[at] & bits == bits]
            return left

        for length, words, n in _by_length(batches, width):
            own = Words(words, length)
            rows, edits = [], []
            for at in range(length):
                if length - 1 in layout.blocks:
                    row, hashes = own.without(at)
                    for i in row[passed(hashes, length - 1)].tolist():
                        rows.append(i)
                        edits.append(words[i][:at] + words[i][at + 1 :])
                row, letters, hashes = own.replaced(at, alphabets[length])
                left = passed(hashes, length)
                for i, letter in zip(row[left].tolist(), letters[left].tolist()):
                    rows.append(i)
                    edits.append(words[i][:at] + chr(letter) + words[i][at + 1 :])
                if len(rows) >= EDITS or at == length - 1:
                    columns = [pa.array([words[i] for i in rows], pa.string()), pa.array(n[rows]), pa.array(edits, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "n", "near"])
                    rows, edits = [], []

    vocabulary.select("word", "n").mapInArrow(probe, EDIT_SCHEMA).write.mode("append").parquet(path)
    shared.destroy()


def near_words(vocabulary: DataFrame, pass_cells: int = PASS_CELLS) -> DataFrame:
    """``(word, n, near, near_n)`` of all pairs that differ by one letter, each pair once; ``word`` is unique.

    The filter is broadcast ``pass_cells`` cells at a time: a vocabulary of any size is gone
    through as often as its filter needs, and each edit is looked up in the one pass that holds
    its block. What passes meets the vocabulary in one join.
    """
    pass_cells = max(BLOCK, pass_cells - pass_cells % BLOCK)
    sizes = {row["length"]: row["n"] for row in vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    split = vocabulary.select(F.length("word").alias("length"), F.explode(F.split("word", "")).alias("letter"))
    letters: dict[int, list[int]] = {length: [] for length in sizes}
    for row in split.where("letter <> ''").distinct().collect():  # 90 letters for each length at most
        letters[row["length"]].append(ord(row["letter"]))
    alphabets = {length: np.array(sorted(own), dtype=np.uint32) for length, own in letters.items()}
    layout = Layout(sizes)
    spark = vocabulary.sparkSession
    path = work_path(spark, "edits")
    spark.createDataFrame([], EDIT_SCHEMA).write.parquet(path)
    for first in range(0, layout.cells, pass_cells):
        _candidates(vocabulary, layout, alphabets, first, min(layout.cells, first + pass_cells), path)
    found = spark.read.schema(EDIT_SCHEMA).parquet(path)
    words = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(words, "near").select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: the last of the forms from there on.

    A form occurs twice as often at least, so a chain is no longer than the binary digits of the
    highest count; a round takes on the words that are not at the end.
    """
    ahead = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    moving, ended = forms.select("word", F.col("form").alias("at")), []
    while not moving.isEmpty():
        step = stored(lookup_join(moving, ahead, "at", ["word"]), "forms")
        ended.append(step.where("next IS NULL").select("word", F.col("at").alias("root")))
        moving = step.where("next IS NOT NULL").select("word", F.col("next").alias("at"))
    out = ended.pop(0) if ended else forms.select("word", F.col("form").alias("root"))
    for more in ended:
        out = out.unionByName(more)
    return out


def group_spellings(vocabulary: DataFrame, pass_cells: int = PASS_CELLS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a vocabulary ``(word, n)``.

    Two words are near if one letter is inserted, deleted or replaced. The form of a word is its
    near word of largest ``n``, among ties the first in code-point order, if that occurs twice
    as often as the word at least; else NULL. ``root`` is the last of the forms from the word
    on, the word itself without one. Repeated words are one word with their counts added; rows
    with NULL are left out. An empty vocabulary gives no rows, other columns are left out.
    """
    known = vocabulary.where(F.col("word").isNotNull() & F.col("n").isNotNull() & (F.col("word") != ""))
    words = stored(known.groupBy("word").agg(F.sum("n").cast("bigint").alias("n")), "vocabulary")
    pairs = stored(near_words(words, pass_cells), "near")
    both = pairs.select("word", "near", "near_n").unionByName(
        pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    often = -F.col("best.less") >= 2 * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(often, F.col("best.form")).alias("form"),
        F.when(often, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    rooted = formed.join(_roots(formed.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of whole texts; see ``count_words``, ``group_spellings``."""
    return group_spellings(count_words(docs, id_col, text_col))
