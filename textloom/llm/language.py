"""Language identification: known words first, shorter and shorter character n-grams for the rest."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from textloom.llm.columns import free_name, new_column
from textloom.llm.worker import held
from textloom.session import stored

# Labelled documents learned from, per language, and the entries kept of words and of each n-gram length.
DOCS_PER_LANGUAGE = 4_000
WORDS = 60_000
GRAMS = 20_000
LENGTHS = (5, 4, 3, 2, 1)

# Words of one document that the score counts as independent evidence at most.
EVIDENCE = 20

# Words each worker remembers; a longer one counts once more for each LONGEST characters.
REMEMBERED = 1 << 18

# Longer runs of letters, as of scripts without spaces, teach in consecutive pieces of this length.
LONGEST = 64

UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Log frequencies by language, of words and of n-grams by length, longest first."""

    languages: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: tuple[tuple[int, dict[str, tuple[float, ...]]], ...]

    def word_scores(self, word: str) -> tuple[float, ...]:
        """Log frequency of one word in each language, by the longest n-grams known where it is new."""
        known = self.words.get(word)
        if known is not None:
            return known
        framed = f"<{word}>"
        for length, grams in self.grams:
            found = [grams[g] for i in range(len(framed) - length + 1) if (g := framed[i : i + length]) in grams]
            if found:
                return tuple(sum(scores[i] for scores in found) / len(found) for i in range(len(self.languages)))
        return (0.0,) * len(self.languages)


class Scorer:
    """The model with remembered words; a row of scores for each."""

    def __init__(self, model: Model, remembered: int = REMEMBERED):
        self._model, self._limit = model, remembered
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[str, int] = {}
        self._held = 0
        self._scores = np.zeros((1024, len(self._model.languages)))

    def _row(self, word: str) -> int:
        row = self._rows.get(word)
        if row is None:
            row = self._rows[word] = len(self._rows)
            self._held += 1 + len(word) // (LONGEST + 1)
            if row == len(self._scores):
                self._scores = np.concatenate((self._scores, np.zeros_like(self._scores)))
            self._scores[row] = self._model.word_scores(word)
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the probability; ``und`` and 0 without letters or languages."""
        words = _WORD.findall((text or "").lower())
        if not self._model.languages or not any(c.isalpha() for word in words for c in word):
            return UNKNOWN, 0.0  # a word may be a sign such as a raised two
        total = np.zeros(len(self._model.languages))
        for i in range(0, len(words), 1 << 16):
            if self._held > self._limit:
                self._forget()
            some = words[i : i + (1 << 16)]
            rows = list(map(self._rows.get, some))
            if None in rows:
                rows = [self._row(word) if row is None else row for word, row in zip(some, rows)]
            total += self._scores[rows].sum(axis=0)
        scores = total / len(words) * min(len(words), EVIDENCE)
        shares = np.exp(scores - scores.max())
        best = int(shares.argmax())  # of equal shares the first language by name
        return self._model.languages[best], float(shares[best] / shares.sum())


def is_held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept out of training: CRC-32 of the id as text, modulo 5, is 0. A NULL id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(True))


def _table(counts: DataFrame, totals: dict[str, int], key: str, size: int, languages: tuple[str, ...]) -> dict[str, tuple[float, ...]]:
    """Log frequencies of the ``size`` most frequent keys, smoothed by a half, less their mean."""
    each = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(f"_{i}") for i, lang in enumerate(languages)]
    top = counts.groupBy(key).agg(F.sum("n").alias("_n"), *each).orderBy(F.desc("_n"), key).limit(size).collect()
    found = {}
    for row in top:
        logs = [float(np.log((row[f"_{i}"] + 0.5) / (totals.get(lang, 0) + 0.5 * size))) for i, lang in enumerate(languages)]
        mean = sum(logs) / len(logs)
        found[row[key]] = tuple(x - mean for x in logs)
    return found


def _grams(framed: Column, length: int) -> Column:
    """All n-grams of one length of a framed word, with the length."""
    places = F.sequence(F.lit(1), F.length(framed) - (length - 1))
    cut = F.transform(places, lambda i: F.struct(F.lit(length).alias("length"), framed.substr(i, F.lit(length)).alias("gram")))
    return F.when(F.length(framed) >= length, cut).otherwise(F.array().cast("array<struct<length: int, gram: string>>"))


def learn(docs: DataFrame, label_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """A model from labelled rows: all of a language, or about ``per_language`` of them by a hash of the id.

    Counts are made by Spark; the driver gets ``WORDS`` words and ``GRAMS`` n-grams of each
    length at most. Runs of more than ``LONGEST`` letters teach in consecutive pieces. Rows whose label or text is NULL teach nothing.
    """
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = labelled.groupBy(F.col(label_col).alias("lang")).count().collect()
    languages = tuple(sorted(row["lang"] for row in sizes))
    if not languages:
        return Model((), {}, ())
    shares = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], min(1.0, per_language / row["count"]))])
    drawn = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < shares[F.col(label_col)] * (1 << 30)
    sample = labelled.where(drawn).select(F.col(label_col).alias("lang"), F.lower(text_col).alias("text"))
    words = sample.select("lang", F.explode(F.regexp_extract_all("text", F.lit(rf"\p{{L}}{{1,{LONGEST}}}"), F.lit(0))).alias("word"))
    counts = stored(words.groupBy("word", "lang").agg(F.count("*").alias("n")), "words")
    framed = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    cut = counts.select("lang", "n", F.explode(F.concat(*[_grams(framed, length) for length in LENGTHS])).alias("cut"))
    grams = stored(cut.groupBy("cut.length", "cut.gram", "lang").agg(F.sum("n").alias("n")), "grams")
    sums = counts.groupBy(F.lit(0).alias("length"), "lang").agg(F.sum("n").alias("n"))
    sums = sums.union(grams.groupBy("length", "lang").agg(F.sum("n").alias("n"))).collect()  # a row for each length and language
    totals = {length: {row["lang"]: row["n"] for row in sums if row["length"] == length} for length in (0, *LENGTHS)}
    tables = [(length, _table(grams.where(F.col("length") == length), totals[length], "gram", GRAMS, languages)) for length in LENGTHS]
    return Model(languages, _table(counts, totals[0], "word", WORDS, languages), tuple(tables))


PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "language") -> DataFrame:
    """Add ``out``, a struct of ``lang_pred`` and ``score`` between 0 and 1, from the whole text.

    Each known word adds its log frequency in each language; a new word adds the mean of its
    longest known n-grams; the score is the share of the best language, with the evidence of at
    most ``EVIDENCE`` words. NULL and texts without letters are ``und`` with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        scorer = held(("scorer", id(model)), lambda: Scorer(model))  # the scorer holds the model, so its id stays its own
        for batch in batches:
            found = [scorer.predict(text) for text in batch.to_pylist()]
            names, scores = zip(*found) if found else ((), ())
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(new_column(docs, out), predict(F.col(text_col)))


def language_report(docs: DataFrame, id_col: str = "doc_id", label_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row for each input row; held-out rows teach nothing.

    A row without id is held out. Repeated rows teach and are predicted one by one, whole texts
    of any length are read, of equal scores the first language by name wins, and without any
    labelled row, as in an empty table, all texts are ``und``. Other columns are left out.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("lang"), F.col(text_col).alias("text"), is_held_out(id_col).alias("held_out"))
    model = learn(rows.where(~F.col("held_out")), "lang", "doc_id", "text")
    found = identify(rows.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", label_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows whose language is known with a score of ``least`` or more, columns as they are.

    NULL and texts without letters go; repeated rows stay or go together. Columns whose names
    clash with results of the operator stay what they were.
    """
    teachers = docs.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    model = learn(teachers.where(~is_held_out("doc_id")), "lang", "doc_id", "text")
    out = free_name(docs, "language")
    found = identify(docs, model, text_col, out)
    sure = (F.col(out)["lang_pred"] != UNKNOWN) & (F.col(out)["score"] >= least)
    return found.where(sure).drop(out)
