"""Secret scans: known forms of secrets, and strings that look drawn at random.

Three patterns find assignments, access keys and hexadecimal strings. Beside them two character Markov
models, one of random strings and one of ordinary words and identifiers, are compared: a run of key
characters outside those spans is a secret too where the logarithm of the ratio of its likelihoods is
high. The models count transitions from the two characters before to the next in labelled strings: the
secrets that the patterns find are random, all other runs are ordinary. Counting is done in Spark; the
models are tables whose size follows from the alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import row_columns, row_schema

#: Kinds in the order in which spans that start at one place are listed; the last one is the models'.
KINDS = ["assign", "access", "hex", "random"]
# The patterns of the three known forms; letters of the first one's words in either case.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
#: Shortest value of an assignment.
LEAST_VALUE = 8
#: The same for the quicker search that tells which texts may hold one. It may find more.
MAYBE = {"assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}

#: Characters of the models; any other ends a run.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CODE = np.full(256, -1, np.int64)
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
#: Symbols of a context: the alphabet, and the place before a run's first character.
SYMBOLS = len(ALPHABET) + 1
LETTERS = len(ALPHABET)

#: Bound of the documents that the models are learned from, in expectation.
TRAIN_ROWS = 20_000
#: Shortest run that is learned from as ordinary, and that is judged.
LEAST_ORDINARY, LEAST_RUN = 4, 16
#: How much a shorter context counts beside a longer one, in characters seen.
PRIOR = 5.0
#: Logarithm of the likelihood ratio from which a run is a secret: odds of e^20 make up for the rarity of secrets.
THRESHOLD = 20.0

ORDINARY = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_ORDINARY},}}")
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")
MAYBE_RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN}}}"


def base_spans(text: str, kinds: tuple[bool, ...] = (True, True, True)) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms in one text, leftmost and not overlapping within a kind."""
    found = []
    if kinds[0]:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        if kinds[kind]:
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text)]
    return sorted(found)


def values(text: str) -> list[str]:
    """The secrets themselves: values of assignments, keys and hexadecimal strings, each place once."""
    found = {m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE}
    found |= {m.span() for pattern in (ACCESS, HEX) for m in pattern.finditer(text)}
    return [text[a:b] for a, b in sorted(found)]


def outside(spans: list[tuple[int, int, int]], runs: Iterator[re.Match]) -> Iterator[re.Match]:
    """Runs that overlap no span; both rise."""
    at, reach = 0, 0
    for run in runs:
        while at < len(spans) and spans[at][0] < run.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= run.start():
            yield run


def transitions(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per character of strings over the alphabet: number of its context and of itself as one, and the owner.

    Characters outside the alphabet are left out of the string.
    """
    codes = CODE[np.frombuffer("".join(strings).encode("ascii", "replace"), np.uint8)]
    owner = np.repeat(np.arange(len(strings)), np.fromiter((len(s) for s in strings), np.int64, len(strings)))
    owner, codes = owner[codes >= 0], codes[codes >= 0]
    first = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)
    one = np.where(first, LETTERS, np.r_[0, codes[:-1]][: len(codes)])
    two = np.where(first | np.r_[False, first[:-1]][: len(codes)], LETTERS, np.r_[0, 0, codes[:-2]][: len(codes)])
    return (two * SYMBOLS + one) * LETTERS + codes, owner


@dataclass
class Model:
    """Per transition the logarithm of its likelihood in a random string over that in an ordinary one."""

    ratios: np.ndarray
    threshold: float

    def scores(self, strings: list[str]) -> np.ndarray:
        place, owner = transitions(strings)
        return np.bincount(owner, self.ratios[place], len(strings))


def likelihoods(counts: np.ndarray) -> np.ndarray:
    """Smoothed logarithms: each context is backed by the shorter one, that by all characters, those by even odds."""
    table = counts.reshape(SYMBOLS, SYMBOLS, LETTERS).astype(float)
    found = np.full(LETTERS, 1 / LETTERS)
    for seen in (table.sum((0, 1)), table.sum(0)[None], table):
        found = (seen + PRIOR * found) / (seen.sum(-1, keepdims=True) + PRIOR)
    return np.log(found).ravel()


def fit(random: np.ndarray, ordinary: np.ndarray, threshold: float = THRESHOLD) -> Model:
    """The model of two tables of transition counts."""
    return Model(likelihoods(random) - likelihoods(ordinary), threshold)


def labelled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to labelled strings: secrets of the known forms, and runs outside them."""
    for batch in batches:
        strings, labels = [], []
        for text in batch.column(0).to_pylist():
            spans = base_spans(text)
            secrets = values(text) if spans else []
            ordinary = [m[0] for m in outside(spans, ORDINARY.finditer(text))]
            strings += secrets + ordinary
            labels += [1] * len(secrets) + [0] * len(ordinary)
        yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(labels, pa.int32())], names=["string", "label"])


def labelled_strings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """Strings with label 1 (secret) or 0 (ordinary) of about ``rows`` documents, drawn by a hash of id and text.

    Null texts have none. Copies of a text under other ids are drawn one by one; equal rows are drawn together.
    """
    share = min(1.0, rows / max(1, docs.count()))
    text = F.col(text_column)
    drawn = docs.where(text.isNotNull() & (F.pmod(F.xxhash64(F.lit(12), F.col(id_column), text), F.lit(1 << 20)) < int(share * (1 << 20))))
    return drawn.select(text).mapInArrow(labelled_batches, "string string, label int")


def counted_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how often each transition occurs under each label."""
    counts = np.zeros((2, SYMBOLS * SYMBOLS * LETTERS), np.int64)
    for batch in batches:
        labels = batch.column(1).to_numpy()
        strings = batch.column(0).to_pylist()
        for label in (0, 1):
            place, _ = transitions([strings[k] for k in np.flatnonzero(labels == label)])
            np.add.at(counts[label], place, 1)
    label, place = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(place, pa.int32()), pa.array(counts[label, place])],
                                     names=["label", "place", "n"])


def learn(samples: DataFrame, threshold: float = THRESHOLD) -> Model:
    """A model of labelled strings (string, label). Null strings, and labels other than 0 and 1, are left out.

    Without strings of a label its likelihoods are even, as for a string of independent characters.
    """
    given = samples.where("string IS NOT NULL AND label IN (0, 1)").select("string", F.col("label").cast("int").alias("label"))
    # a row per label and transition at most: the alphabet bounds them
    rows = given.mapInArrow(counted_batches, "label int, place int, n bigint").groupBy("label", "place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, SYMBOLS * SYMBOLS * LETTERS), np.int64)
    counts[rows.column("label").to_numpy(), rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    return fit(counts[1], counts[0], threshold)


SPANS = "spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def span_batches(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    """Texts in the first column to their spans."""
    for batch in batches:
        texts = batch.column(0)
        maybe = np.stack([pc.match_substring_regex(texts, MAYBE[k]).to_numpy(zero_copy_only=False) for k in KINDS[:3]])
        runs = pc.match_substring_regex(texts, MAYBE_RUN).to_numpy(zero_copy_only=False) & (model is not None)
        spans: list[list] = [[] for _ in range(len(texts))]
        candidates: list[tuple[int, re.Match]] = []
        for k in np.flatnonzero(maybe.any(0) | runs).tolist():
            text = texts[k].as_py()
            spans[k] = base_spans(text, tuple(maybe[:, k].tolist()))
            if runs[k]:
                candidates += ((k, m) for m in outside(spans[k], RUN.finditer(text)))
        scores = model.scores([m[0] for _, m in candidates]) if candidates else np.zeros(0)
        found: dict[int, list] = {}
        for c in np.flatnonzero(scores >= model.threshold).tolist() if candidates else ():
            k, m = candidates[c]
            found.setdefault(k, []).append((m.start(), 3, m.end(), float(scores[c])))
        rows = [[(KINDS[s[1]], s[0], s[2], s[3] if len(s) > 3 else None) for s in sorted([*own, *found.get(k, ())])] for k, own in enumerate(spans)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(SPAN)), *batch.columns[1:]], names=["spans", *batch.schema.names[1:]])


def find_secrets(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start and end (code points, end exclusive) and score of each secret.

    Spans follow their start, then their kind as listed in ``KINDS``. Spans of the known forms may overlap
    between kinds and have no score; the models' are whole runs of key characters that overlap none of
    them, and without a model there are none. A null text is empty and has no span; every whole text is
    searched, equal rows all stay. A column named spans is replaced.
    """
    found = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("spans"), F.struct("*").alias("_row")).mapInArrow(
        partial(span_batches, model=model), row_schema(docs, SPANS))
    return found.select(*row_columns(docs.drop("spans")), "spans")


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
