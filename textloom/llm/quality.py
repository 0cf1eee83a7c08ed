"""Document quality: random Fourier features of document statistics, ridge regression, isotonic scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from textloom.llm.columns import free_name, new_column
from textloom.llm.language import is_held_out
from textloom.llm.worker import release
from textloom.session import stored

# Labelled rows learned from, at most about, and the tasks that sum them up.
TRAINING_ROWS = 20_000
TRAINING_TASKS = 16

# Random features, ridge and width of the kernel in units of the root of the number of statistics.
FEATURES = 256
RIDGE = 1e-3
WIDTH = 1.0

# Every fourth training row calibrates; scores are counted in so many bins.
CALIBRATION = 4
BINS = 1024

# Part of the score that rises with the uncalibrated score, so that a step does not tie its rows.
SLOPE = 0.01

STATISTICS = (
    "log_words log_words_a_line word_length word_length_spread upper lower digit symbol sentence_mark non_ascii "
    "exclamation bar first_upper last_letter last_sentence_mark last_symbol upper_words symbol_words short_words "
    "long_words distinct_words repeated_next commonest_word distinct_lines byte_entropy control"
).split()

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SYMBOL, _WIDE, _CONTROL = range(8)
_KINDS = np.full(256, _SYMBOL, dtype=np.uint8)
_KINDS[:32] = _CONTROL
_KINDS[127] = _CONTROL
_KINDS[[9, 10, 11, 12, 13, 32]] = _SPACE
_KINDS[48:58], _KINDS[65:91], _KINDS[97:123], _KINDS[128:] = _DIGIT, _UPPER, _LOWER, _WIDE
_KINDS[[ord(c) for c in ".,;:?!'\"()-"]] = _MARK


def statistics(text: str | None) -> list[float]:
    """``STATISTICS`` of one text; all zero where there are no words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(data, np.uint8)
    kinds = _KINDS[codes]
    share = np.bincount(kinds, minlength=8) / len(codes)
    letters = np.bincount(codes, minlength=256)
    used = letters[letters > 0] / len(codes)
    inside = np.concatenate(([False], kinds != _SPACE, [False]))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    lengths, n = ends - starts, len(starts)
    first, last = kinds[starts], kinds[ends - 1]

    def inside_words(of: np.ndarray) -> np.ndarray:
        running = np.concatenate(([0], np.cumsum(of)))
        return running[ends] - running[starts]

    upper, lower = inside_words(kinds == _UPPER), inside_words((kinds == _LOWER) | (kinds == _WIDE))
    lines = [line for line in data.split(b"\n") if line.strip()]
    distinct, counts = np.unique(np.array([hash(word) for word in words]), return_counts=True)
    return [
        float(np.log1p(n)),
        float(np.log1p(n / len(lines))),
        float(lengths.mean()),
        float(lengths.std()),
        *(float(share[kind]) for kind in (_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _WIDE)),
        float(letters[33] / len(codes)),
        float(letters[124] / len(codes)),
        float((first == _UPPER).mean()),
        float(((last == _LOWER) | (last == _WIDE) | (last == _UPPER)).mean()),
        float((last == _MARK).mean()),
        float((last == _SYMBOL).mean()),
        float(((upper > 1) & (lower == 0)).mean()),
        float((upper + lower == 0).mean()),
        float((lengths <= 3).mean()),
        float((lengths > 15).mean()),
        len(distinct) / n,
        sum(map(eq, words, words[1:])) / n,
        float(counts.max() / n),
        len(set(lines)) / len(lines),
        float(-(used * np.log(used)).sum()),
        float(share[_CONTROL]),
    ]


@dataclass(frozen=True)
class QualityModel:
    """Scaling of the statistics, random features, ridge weights, and the calibrated steps."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(scaled @ self.waves + self.shifts) * np.sqrt(2 / len(self.shifts))
        return np.concatenate((np.ones((len(stats), 1)), waves), axis=1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores between 0 and 1: straight lines between the steps, which a small slope keeps in order."""
        raw = self.features(stats) @ self.weights
        return (1 - SLOPE) * np.interp(raw, self.raw, self.calibrated) + SLOPE * np.clip((raw + 1) / 3, 0, 1)


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest sequence that never falls: neighbours that fall are pooled to their mean."""
    pools: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist()):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            value, weight, size = pools.pop()
            before = pools[-1]
            before[0] = (before[0] * before[1] + value * weight) / (before[1] + weight)
            before[1] += weight
            before[2] += size
    return np.repeat([pool[0] for pool in pools], [int(pool[2]) for pool in pools])


@F.arrow_udf(ArrayType(DoubleType(), False))
def _statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    release()
    for batch in batches:
        yield pa.array([statistics(text) for text in batch.to_pylist()], pa.list_(pa.float64()))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", training_rows: int = TRAINING_ROWS) -> QualityModel:
    """A model from the labels of documents that are not held out.

    ``labels`` has ``id_col`` and ``label_col``; an id with several labels has their mean, NULL
    labels say nothing. About ``training_rows`` labelled ids are drawn by a hash, and only
    statistics of their texts are shuffled. Tasks sum the normal equations of the random
    features over their rows, and the driver gets ``TRAINING_TASKS`` such sums and ``BINS`` bins.
    Without labels every score is one half; with labels of one kind it is their mean.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    known = known.where(F.col("label").isNotNull() & ~is_held_out("doc_id")).groupBy("doc_id").agg(F.avg("label").alias("label"))
    total = known.count()
    share = min(1.0, training_rows / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("training")), F.lit(1 << 30)) < share * (1 << 30)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(~is_held_out("doc_id") & drawn)
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    stats = texts.select("doc_id", _statistics("text").alias("stats"), calibrates.alias("calibrates"))
    rows = stored(stats.join(known.where(drawn), "doc_id").repartition(TRAINING_TASKS), "training")
    spread = [F.avg(F.get("stats", F.lit(i))).alias(f"m{i}") for i in range(len(STATISTICS))]
    spread += [F.stddev_pop(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(len(STATISTICS))]
    found = rows.agg(F.avg("label").alias("mean"), F.min("label").alias("least"), F.max("label").alias("most"), *spread).first()
    size = len(STATISTICS)
    draws = np.random.default_rng(7)
    waves = draws.normal(size=(size, FEATURES)) / (WIDTH * np.sqrt(size))
    shifts = draws.uniform(0, 2 * np.pi, FEATURES)
    mean = np.array([found[f"m{i}"] or 0.0 for i in range(size)])
    scale = np.array([found[f"s{i}"] or 0.0 for i in range(size)])
    scale = np.where(scale > 1e-9, scale, 1.0)
    ends, whole = np.array([-1.0, 2.0]), np.array([0.0, 1.0])
    if found["mean"] is None or found["least"] == found["most"]:
        level = 0.5 if found["mean"] is None else found["mean"]
        return QualityModel(mean, scale, waves, shifts, np.zeros(FEATURES + 1), ends, np.array([level, level]))
    start = QualityModel(mean, scale, waves, shifts, np.zeros(FEATURES + 1), ends, whole)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            x = start.features(batch.column(0).flatten().to_numpy().reshape(-1, size))
            both += x.T @ np.concatenate((x, batch.column(1).to_numpy()[:, None]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([both.tobytes()], pa.binary())], ["sums"])

    training = rows.where(~F.col("calibrates")).select("stats", "label").coalesce(TRAINING_TASKS)
    both = sum(np.frombuffer(row["sums"]).reshape(FEATURES + 1, -1) for row in training.mapInArrow(sums, "sums binary").collect())
    ridge = RIDGE * max(both[0, 0], 1.0) * np.eye(FEATURES + 1)
    ridge[0, 0] = 1e-9
    weights = np.linalg.solve(both[:, :-1] + ridge, both[:, -1])
    fitted = QualityModel(mean, scale, waves, shifts, weights, ends, whole)

    @F.arrow_udf(DoubleType())
    def raw(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(fitted.features(batch.flatten().to_numpy().reshape(-1, size)) @ weights)

    place = F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), raw("stats"))) * (BINS / 2))
    binned = rows.where("calibrates").groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.sum("label").alias("ones")).orderBy("bin").collect()
    if not binned:
        return fitted
    n = np.array([row["n"] for row in binned], dtype=np.float64)
    steps = rising(np.array([row["ones"] for row in binned]) / n, n)
    places = (np.array([row["bin"] for row in binned]) + 0.5) / (BINS / 2)
    return QualityModel(mean, scale, waves, shifts, weights, places, steps)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, a new column: the calibrated score of the whole text, 0 to 1. NULL scores as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for batch in batches:
            stats = np.array([statistics(text) for text in batch.to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.array(np.clip(shared.value.score(stats), 0.0, 1.0))

    return docs.withColumn(new_column(docs, out), score(F.col(text_col)))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``docs``; held-out rows teach nothing.

    NULL and empty texts have a score like any other, that of statistics which are all zero.
    Whole texts of any length are read. A row without id is held out; repeated rows have equal
    scores; other columns are left out. See ``fit`` for labels that are missing or disagree.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    scored = score_quality(rows, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score is ``threshold`` or more, columns as they are, whatever their names.

    NULL is judged as the empty text; repeated rows stay or go together; an empty table stays empty.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    score = free_name(docs, "score")
    return score_quality(docs, model, text_col, score).where(F.col(score) >= threshold).drop(score)
