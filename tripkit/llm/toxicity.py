"""Toxicity: a lexicon learned from labels, matched with its misspellings, weighed by context.

The lexicon holds the whole words that labelled toxic documents share far beyond chance and clean
ones hardly have, and the stems that hold true for more than one such word; near copies of a
document count once. It becomes a trie, and Levenshtein automata of its terms are run over that trie all at once: a state is the
set of trie nodes a word may have reached, with the errors left to each. States and steps are
remembered, so a word costs one lookup per letter and most words end after a few.

Each match is read in its window of words: one that stands in quotation marks, or near words that
report speech, counts as quoted; matches close to each other count as abuse. Six figures per
document go into a logistic score, fitted to the labels around prior weights.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import row_columns, row_schema
from tripkit.session import materialize

#: Bound of labelled rows to learn from, in expectation.
TRAIN_ROWS = 20_000
#: This share of the documents a term is in are toxic; least log-likelihood ratio of a term, so that
#: one in some 10**5 passes by chance; a stem is in this many times the documents of any one word on it.
LEAST_SHARE, LEAST_RATIO, STEM_GAIN = 0.9, 18.0, 1.5
#: Lengths of word stems that may be terms; letters of a term from which 1 and 2 errors are forgiven.
STEMS, ONE_ERROR, TWO_ERRORS = (4, 5, 6, 7, 8), 5, 9
#: Words on either side that are a match's context; letters in which a quotation must close.
WINDOW, QUOTE_REACH = 8, 200
#: Distinct words, and states of the automata, that a task remembers.
REMEMBERED, STATES = 200_000, 20_000

WORD = re.compile(r"[^\W_]+")
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "‘": "’"}
# Words that report what somebody else said or wrote.
REPORTING = frozenset("said says say quoted quote quotes called calls wrote writes word words term phrase dit écrit mot sagte schrieb "
                      "wort dijo escribió palabra".split())
#: Prior weights: bias, matches, quoted matches, misspelled, quoted misspelled, most matches in a window.
PRIOR = np.array([-4.0, 3.0, 0.5, 1.5, 0.2, 1.5])
PRIOR_STRENGTH = 0.5


@dataclass
class Node:
    """A letter of the trie; ``errors`` of the term that ends here, -1 for none, and whether it is a stem."""

    children: dict[str, Node] = field(default_factory=dict)
    errors: int = -1
    stem: bool = False


class Matcher:
    """Levenshtein automata of all terms, intersected with their trie as words are read."""

    MOST = 2

    def __init__(self, words: list[str], stems: list[str]) -> None:
        self.nodes = [Node()]
        self.numbers: dict[int, int] = {id(self.nodes[0]): 0}
        for term, stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
            node = self.nodes[0]
            for letter in term:
                if letter not in node.children:
                    node.children[letter] = Node()
                    self.numbers[id(node.children[letter])] = len(self.nodes)
                    self.nodes.append(node.children[letter])
                node = node.children[letter]
            if stem:
                node.stem = True
            else:
                node.errors = 2 if len(term) >= TWO_ERRORS else 1 if len(term) >= ONE_ERROR else 0
        # the most errors that any term below a node forgives: fewer states survive
        self.allowed = [0] * len(self.nodes)
        for k in reversed(range(len(self.nodes))):
            node = self.nodes[k]
            below = [self.allowed[self.numbers[id(c)]] for c in node.children.values()]
            self.allowed[k] = max([node.errors, 0, *below])
        self.found: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        """Drops all remembered states; the start is number 0."""
        self.numbered: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.stem: list[bool] = []  # whether a state has read a whole stem, a whole term, a misspelled term
        self.whole: list[bool] = []
        self.close: list[bool] = []
        self.number(self.closed({0: 0}))

    def number(self, state: tuple) -> int:
        found = self.numbered.get(state)
        if found is None:
            found = self.numbered[state] = len(self.states)
            self.states.append(state)
            self.stem.append(any(not used and self.nodes[k].stem for k, used in state))
            self.whole.append(any(not used and self.nodes[k].errors >= 0 for k, used in state))
            self.close.append(any(used <= self.nodes[k].errors for k, used in state))
        return found

    def closed(self, reached: dict[int, int]) -> tuple:
        """A state: nodes with errors so far, after skipping letters of terms."""
        stack = list(reached.items())
        while stack:
            k, used = stack.pop()
            if reached.get(k, 9) < used:
                continue
            for child in self.nodes[k].children.values():
                c = self.numbers[id(child)]
                if used + 1 <= self.allowed[c] and reached.get(c, 9) > used + 1:
                    reached[c] = used + 1
                    stack.append((c, used + 1))
        return tuple(sorted(reached.items()))

    def step(self, state: tuple, letter: str) -> tuple:
        reached: dict[int, int] = {}

        def reach(k: int, used: int) -> None:
            if used <= self.allowed[k] and used < reached.get(k, 9):
                reached[k] = used

        for k, used in state:
            for other, child in self.nodes[k].children.items():
                reach(self.numbers[id(child)], used + (other != letter))
            reach(k, used + 1)
        return self.closed(reached)

    def match(self, word: str) -> int:
        """0: none; 1: a term or a word that begins with a stem; 2: a misspelled term."""
        found = self.found.get(word)
        if found is None:
            if len(self.found) >= REMEMBERED:
                self.found.clear()
            found = self.found[word] = self.read(word)
        return found

    def read(self, word: str) -> int:
        if len(self.states) > STATES:
            self.forget()
        state = 0
        for letter in word:
            if self.stem[state]:
                return 1
            after = self.steps.get((state, letter))
            if after is None:
                after = self.steps[state, letter] = self.number(self.step(self.states[state], letter))
            state = after
            if not self.states[state]:
                return 0
        if self.stem[state] or self.whole[state]:
            return 1
        return 2 if self.close[state] else 0


def quoted(text: str, start: int, end: int) -> bool:
    """Whether a quotation opens before the match, in its line, and closes after it."""
    line = text[max(text.rfind("\n", 0, start) + 1, start - QUOTE_REACH) : start]
    rest = text[end : end + QUOTE_REACH].split("\n", 1)[0]
    for opening, closing in QUOTES.items():
        is_open = line.count('"') % 2 if opening == closing else line.rfind(opening) > line.rfind(closing)
        if is_open and closing in rest:
            return True
    return False


def figures(text: str, matcher: Matcher) -> list[float]:
    """The six inputs of a document's score."""
    lowered = text.lower()
    words = WORD.findall(lowered)
    match = matcher.match
    hits = [(i, kind) for i, kind in enumerate(map(match, words)) if kind]
    if not hits:
        return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    wanted = dict(hits)
    spans = {i: m.span() for i, m in enumerate(WORD.finditer(lowered)) if i in wanted}
    counts = np.zeros(4)
    plain = []
    for i, kind in hits:
        reported = quoted(lowered, *spans[i]) or not REPORTING.isdisjoint(words[max(0, i - WINDOW) : i])
        counts[(kind - 1) * 2 + reported] += 1
        if not reported:
            plain.append(i)
    near = np.array(plain, np.int64)
    densest = (np.searchsorted(near, near + WINDOW, "right") - np.arange(len(near))).max() if plain else 0
    return [1.0, *np.log1p(counts).tolist(), float(np.log1p(max(0, densest - 1)))]


def terms_of(text: str) -> set[str]:
    """Words, and stems marked with a star, of a text."""
    words = set(WORD.findall(text.lower()))
    return {w for w in words if len(w) > 2} | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts of a batch (_text, _label) each term occurs."""
    for batch in batches:
        counts = Counter(), Counter()
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update(terms_of(text))
        terms = list(counts[0] | counts[1])
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts)],
                                         names=["term", "clean", "toxic"])


def copy_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two MinHash values over five-word shingles; near copies mostly share one at least."""
    for batch in batches:
        marks = []
        for text in batch.column(0).to_pylist():
            words = WORD.findall(text.lower())
            lines = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
            marks.append([min(xxhash.xxh64_intdigest(x, seed) for x in lines) >> 1 for seed in (1, 2)])
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1))],
                                         names=[*batch.schema.names, "_m1", "_m2"])


def ratio(toxic: int, clean: int) -> Column:
    """Log-likelihood ratio of a term in columns ``toxic`` and ``clean`` of so many documents."""
    total = F.lit(0.0)
    for seen, of in ((F.col("toxic"), toxic), (F.col("clean"), clean)):
        expected = (F.col("toxic") + F.col("clean")) * F.lit(of / max(1, toxic + clean))
        total = total + F.when(seen > 0, 2 * seen * F.ln(seen / expected)).otherwise(0.0)
    return total


def chosen_terms(texts: DataFrame, toxic: int, clean: int) -> tuple[list[str], list[str]]:
    """Words and stems of the lexicon, the most telling first: all that pass the tests of share, ratio and gain."""
    counts = materialize(texts.select("_text", "_label").mapInArrow(term_counts, "term string, clean bigint, toxic bigint").groupBy("term")
                         .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 1"))
    telling = (counts.where(F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("clean")))
               .withColumn("strength", ratio(toxic, clean)).where(F.col("strength") >= LEAST_RATIO))
    most = (counts.where("NOT endswith(term, '*')")
            .select(F.explode(F.array(*(F.substring("term", 1, n) for n in STEMS))).alias("stem"), "toxic")
            .groupBy("stem").agg(F.max("toxic").alias("most")))
    words = telling.where("NOT endswith(term, '*')").select("term", "strength")
    stems = (telling.where("endswith(term, '*')").withColumn("stem", F.expr("substring(term, 1, length(term) - 1)")).join(most, "stem", "left")
             .where(F.col("toxic") >= STEM_GAIN * F.coalesce("most", F.lit(0))).select(F.col("stem").alias("term"), "strength"))
    return tuple([r.term for r in sorted(found.collect(), key=lambda r: (-r.strength, r.term))] for found in (words, stems))


def fit(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton's method, drawn towards the prior ones."""
    weights = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (labels - p) - PRIOR_STRENGTH * (weights - PRIOR)
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + PRIOR_STRENGTH * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: np.ndarray


_MATCHERS: dict[tuple, Matcher] = {}


def matcher_of(words: list[str], stems: list[str]) -> Matcher:
    """The matcher of this Python worker, kept from task to task."""
    key = tuple(words), tuple(stems)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(words, stems)
    return _MATCHERS[key]


def figure_batches(batches: Iterator[pa.RecordBatch], words: list[str], stems: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts in the first column to their six figures; every other column stays."""
    matcher = matcher_of(words, stems)
    for batch in batches:
        found = [figures(x, matcher) for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), *batch.columns[1:]],
                                         names=["figures", *batch.schema.names[1:]])


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic") -> Model:
    """Lexicon and weights from the labelled rows of ``docs``; a bounded number, drawn by a hash of the id."""
    given = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(
        F.max(F.col(label_column).cast("int")).alias("_label"))
    share = min(1.0, TRAIN_ROWS / max(1, labels.count()))
    drawn = given.where(F.pmod(F.xxhash64(F.lit(7), F.col(id_column)), F.lit(1 << 20)) < int(share * (1 << 20)))
    # at most about TRAIN_ROWS narrow rows, whatever the size of the labels
    rows = materialize(docs.select(id_column, F.col(text_column).alias("_text")).where("_text IS NOT NULL")
                       .join(F.broadcast(drawn), id_column).select("_text", "_label"))
    single = materialize(rows.mapInArrow(copy_marks, "_text string, _label int, _m1 bigint, _m2 bigint")
                         .dropDuplicates(["_m1"]).dropDuplicates(["_m2"]).select("_text", "_label"))
    sizes = {r._label: r["count"] for r in single.groupBy("_label").count().collect()}
    words, stems = chosen_terms(single.where("_label IN (0, 1)"), sizes.get(1, 0), sizes.get(0, 0))
    seen = rows.mapInArrow(partial(figure_batches, words=words, stems=stems), "figures array<double>, _label int").collect()
    inputs = np.array([r.figures for r in seen]).reshape(-1, len(PRIOR))
    return Model(words, stems, fit(inputs, np.array([r._label for r in seen], float)))


def score(docs: DataFrame, model: Model, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic. A null or empty text has no matches, only the bias."""
    found = docs.select(F.coalesce(F.col(text_column), F.lit("")).alias("figures"), F.struct("*").alias("_row")).mapInArrow(
        partial(figure_batches, words=model.words, stems=model.stems), row_schema(docs, "figures array<double>"))
    total = sum((F.col("figures")[k] * float(w) for k, w in enumerate(model.weights)), F.lit(0.0))
    return found.select(*row_columns(docs, but=score_column), (1 / (1 + F.exp(-total))).alias(score_column))
