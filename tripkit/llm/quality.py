"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A text has one score, the product of hashed features and weights that all grades share. Ordered
thresholds cut the score line into grades: P(grade <= k) = 1 / (1 + exp(score - threshold_k)). So
one model gives the expected grade and the probability of each grade or better, by which
documents are selected. It is fitted on a bounded sample of rated rows; every document is scored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import row_columns, row_schema

#: Bound of the rated rows that are learned from, in expectation; number of hashed weights.
TRAIN_ROWS, WEIGHTS = 12_000, 1 << 16
#: Steps, step size and weight decay of the fit.
STEPS, RATE, DECAY = 250, 0.05, 2e-4
#: Weight of the share of a token shape beside words, whose squares sum to 1.
SHAPE_WEIGHT = 3.0

#: Kind of each byte: 0 a mark, 1 a lower-case letter or part of a character beyond ASCII, 2 a capital, 3 a digit, 4 a space or line end.
KIND = np.zeros(256, np.int8)
KIND[[*range(97, 123), *range(128, 256)]], KIND[65:91], KIND[48:58], KIND[[10, 32]] = 1, 2, 3, 4

LETTERS, DIGITS, REPEATED = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"([^\w\s])\1+")


def slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % WEIGHTS


@lru_cache(maxsize=100_000)
def word_slots(token: str) -> tuple[int, int]:
    """Slots of a token's word and of its shape: letters a or A, digits 9, runs of a mark as one."""
    letters = LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", token)
    return slot("word " + token.lower()), slot("shape " + REPEATED.sub(r"\1+", DIGITS.sub("9", letters))[:12])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text."""
    tokens = text.split()
    n = len(tokens)
    values: dict[int, float] = Counter()
    counts = Counter(tokens)
    scale = 1 / math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values())) if n else 0.0
    for token, c in counts.items():
        word, shape = word_slots(token)
        values[word] += math.log1p(c) * scale
        values[shape] += SHAPE_WEIGHT * c / n
    lines = [x for x in text.split("\n") if x.strip()]
    kinds = np.bincount(KIND[np.frombuffer(text.encode(), np.uint8)], minlength=5) / max(1, len(text))
    shares = {
        "distinct": len(counts) / max(1, n), "repeated": sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)) / max(1, n),
        "lines": len(set(lines)) / max(1, len(lines)), "letters": kinds[1], "upper": kinds[2], "digits": kinds[3], "spaces": kinds[4],
    }
    for name, share in shares.items():
        values[slot(f"{name} {round(share * 10)}")] += 1.0
        values[slot(name)] += share
    values[slot(f"length {n.bit_length()}")] += 1.0
    values[slot("bias")] += 1.0
    return np.fromiter(values.keys(), np.int32, len(values)), np.fromiter(values.values(), np.float64, len(values))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(slots: np.ndarray, values: np.ndarray, limits: np.ndarray, rank: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of most likelihood, by Adam on all rows.

    Thresholds are the first one and the logarithms of the gaps between them.
    """
    share = np.clip(np.cumsum(np.bincount(rank, minlength=n_grades))[:-1] / len(rank), 0.001, 0.999)
    first = np.log(share / (1 - share))
    ends = np.r_[first[:1], np.log(np.maximum(np.diff(first), 1e-2))]
    weights = np.zeros(WEIGHTS)
    moments = [np.zeros((2, len(x))) for x in (weights, ends)]
    rows = np.repeat(np.arange(len(rank)), np.diff(limits))
    for step in range(1, STEPS + 1):
        thresholds = np.cumsum(np.r_[ends[:1], np.exp(ends[1:])])
        score = np.bincount(rows, weights[slots] * values, len(rank))
        below = sigmoid(np.r_[-np.inf, thresholds, np.inf][None, :] - score[:, None])
        below[:, 0], below[:, -1] = 0, 1
        slope = below * (1 - below)
        row = np.arange(len(rank))
        chance = np.maximum(below[row, rank + 1] - below[row, rank], 1e-12)
        pull = (slope[row, rank + 1] - slope[row, rank]) / chance / len(rank)
        gradient = np.bincount(slots, values * pull[rows], WEIGHTS) + DECAY * weights
        per = np.zeros(n_grades + 1)
        np.add.at(per, rank + 1, -slope[row, rank + 1] / chance / len(rank))
        np.add.at(per, rank, slope[row, rank] / chance / len(rank))
        moved = np.cumsum(per[1:-1][::-1])[::-1]  # a lower gap moves every threshold above it
        for x, g, (m, v) in zip((weights, ends), (gradient, np.r_[moved[:1], moved[1:] * np.exp(ends[1:])]), moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return weights, np.cumsum(np.r_[ends[:1], np.exp(ends[1:])])


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(x) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in found], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
             batch.column(1)], names=["slots", "values", "grade"])


def learn(docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          grade_column: str = "grade") -> Model:
    """A model of the rated rows of ``docs``: a bounded number of them, drawn by a hash of the id.

    Grades are integers, lower ones worse; ids rated more than once count with their lowest grade,
    null ratings and null ids not at all. With fewer than two grades every text gets the one there is.
    """
    given = ratings.where(F.col(grade_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        F.min(F.col(grade_column).cast("int")).alias("_grade"))
    share = min(1.0, TRAIN_ROWS / max(1, ratings.count()))
    drawn = given.where(F.pmod(F.xxhash64(F.lit(9), F.col(id_column)), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about TRAIN_ROWS narrow rows at most, whatever the size of the ratings
    rows = (docs.select(id_column, F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
            .join(F.broadcast(drawn), id_column).select("_text", "_grade")
            .mapInArrow(feature_batches, "slots array<int>, values array<float>, grade int").toArrow())
    rows = rows.combine_chunks()
    grades, rank = np.unique(rows.column("grade").to_numpy(), return_inverse=True)
    if len(grades) < 2:
        return Model(np.zeros(WEIGHTS), np.zeros(0), grades if len(grades) else np.zeros(1, np.int64))
    slots, values = (pa.concat_arrays(rows.column(c).chunks).flatten().to_numpy() for c in ("slots", "values"))
    limits = np.r_[0, np.cumsum([len(x) for x in rows.column("slots")])]
    return Model(*fit(slots, values.astype(np.float64), limits, rank, len(grades)), grades)


def graded(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Texts in the first column to P(grade or better) for each grade but the lowest."""
    for batch in batches:
        scores = []
        for text in batch.column(0).to_pylist():
            slots, values = features(text)
            scores.append(float(model.weights[slots] @ values))
        tails = sigmoid(np.array(scores).reshape(-1, 1) - model.thresholds[None, :]) if scores else np.zeros((0, len(model.thresholds)))
        yield pa.RecordBatch.from_arrays([pa.array(list(tails), pa.list_(pa.float64())), *batch.columns[1:]],
                                         names=["tails", *batch.schema.names[1:]])


def grade(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``tails``, the probabilities of each grade or better but the lowest, and ``expected_grade``.

    A null text counts as empty, an empty one has only its length and shares. Every whole text is scored.
    """
    found = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("tails"), F.struct("*").alias("_row")).mapInArrow(
        partial(graded, model=model), row_schema(docs, "tails array<double>"))
    gaps = np.diff(model.grades).tolist()
    expected = sum((F.col("tails")[k] * float(g) for k, g in enumerate(gaps)), F.lit(float(model.grades[0])))
    return found.select(*row_columns(docs.drop("tails", "expected_grade")), "tails", expected.alias("expected_grade"))
