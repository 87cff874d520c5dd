"""Quality classifier without hand labels: heuristics vote, EM weighs them, a linear scorer generalises.

1. Seven heuristic labellers look at each whole text and vote good, bad or nothing.
2. The votes of all documents are counted by pattern. Expectation-maximisation on these counts
   estimates how often each labeller casts each vote on good and on bad documents, taking the
   labellers as independent given the class, and so the posterior of each pattern.
3. The posteriors label a bounded sample of documents, on which a logistic scorer over hashed features
   is trained; it then scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.shipping import ship

# The scorer is trained on about this many documents at most, dealt by hash; all else covers all rows.
SAMPLE = 20_000
DIMENSIONS = 4096
EM_ROUNDS, TRAINING_ROUNDS = 200, 400
ABSTAIN, GOOD, BAD = 0, 1, 2

# Labellers: the measure, then good at or below the first value, bad at or above the second.
LABELLERS = {
    "repeated_next": (0.06, 0.20),  # share of words equal to the word before
    "repeated_any": (0.55, 0.75),  # share of words that occurred before; not for few words
    "top_word": (0.13, 0.20),  # share of the most frequent word; not for few words
    "symbols": (0.004, 0.02),  # share of bytes that are symbols rare in prose
    "wordless": (0.06, 0.25),  # share of words without a letter or digit
    "shouting": (0.30, 0.60),  # share of ASCII letters in upper case; not for few words
    "decorated": (0.05, 0.30),  # share of words ending in two or more punctuation marks
}
FEW_WORDS = 20
OFTEN_WRONG_ON_FEW = ("repeated_any", "top_word", "shouting")
# A document goes if its log-odds of being good are at or below this.
REJECT_AT = -1.0
# What is expected of a labeller before any data, as shares of good and bad among its votes on bad and
# on good documents: it seldom calls a good one bad, and sees some kinds of bad ones only. Weighs like
# this share of the documents, so that a kind of bad documents that few labellers see is not taken for
# good. Abstaining says nothing: it counts neither way.
EXPECTED = np.array([[1.0, 0.5, 0.5], [1.0, 0.985, 0.015]])
EXPECTED_WEIGHT = 0.1
PATTERNS = 3 ** len(LABELLERS)

_code = np.arange(256)
_UPPER = (_code >= 65) & (_code <= 90)
_LOWER = (_code >= 97) & (_code <= 122)
_DIGIT = (_code >= 48) & (_code <= 57)
_OTHER = _code >= 128
_SYMBOL = np.isin(_code, np.frombuffer(b"#$%&*+<=>@[]\\^_`{|}~", np.uint8))
_MARK = (_code > 32) & (_code < 127) & ~(_UPPER | _LOWER | _DIGIT)


class Model(NamedTuple):
    votes: np.ndarray  # class x labeller x vote
    prior: np.ndarray
    weights: np.ndarray
    bias: float


class _Texts:
    """Measures and word shapes of the texts of one chunk."""

    def __init__(self, texts: pa.Array):
        raw, offsets = W.utf8(texts)
        starts, ends, rows = W.word_spans(raw, offsets)
        hashes = W.words(texts).values
        self.rows, self.counts = rows, np.diff(rows)
        n = np.maximum(self.counts, 1)
        row = np.repeat(np.arange(len(self.counts)), self.counts)

        def per_row(flags: np.ndarray) -> np.ndarray:
            return np.bincount(row, weights=flags, minlength=len(self.counts))

        def inside(table: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int64)])
            return total[end] - total[begin]

        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        ordered = hashes.copy()
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
            ordered[a:b].sort()
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (ordered[1:] != ordered[:-1]) | (row[1:] != row[:-1])
        runs = np.flatnonzero(fresh)
        top = np.zeros(len(self.counts))
        np.maximum.at(top, row[runs], np.diff(np.append(runs, len(hashes))))
        sizes = np.maximum(np.diff(offsets), 1)
        upper, lower = (inside(t, offsets[:-1], offsets[1:]) for t in (_UPPER, _LOWER))
        wordy = inside(_UPPER | _LOWER | _DIGIT | _OTHER, starts, ends)
        marks = _MARK[raw[ends - 1]].astype(int) if len(ends) else np.zeros(0, int)
        two = ends - starts > 1
        marks[two] += marks[two] * _MARK[raw[ends[two] - 2]]
        capitals = inside(_UPPER, starts, ends)
        self.few = self.counts < FEW_WORDS
        self.measures = np.stack(
            [
                per_row(same) / n,
                np.where(self.counts > 0, 1 - per_row(fresh) / n, 0.0),
                top / n,
                inside(_SYMBOL, offsets[:-1], offsets[1:]) / sizes,
                per_row(wordy == 0) / n,
                upper / np.maximum(upper + lower, 1),
                per_row(marks == 2) / n,
            ],
            axis=1,
        )
        length = np.minimum(ends - starts, 31).astype(np.int64) // 4
        capital = np.where(capitals == 0, 0, np.where(capitals * 2 <= wordy, 1, 2))
        self.shape = (((same * 2 + (wordy == 0)) * 3 + marks) * 3 + capital) * 8 + length
        self.row = row

    def votes(self) -> np.ndarray:
        limits = np.array(list(LABELLERS.values()))
        votes = np.where(self.measures <= limits[:, 0], GOOD, np.where(self.measures >= limits[:, 1], BAD, ABSTAIN))
        votes[self.counts == 0] = ABSTAIN
        for name in OFTEN_WRONG_ON_FEW:
            votes[self.few, list(LABELLERS).index(name)] = ABSTAIN
        return votes

    def patterns(self) -> np.ndarray:
        return self.votes() @ 3 ** np.arange(len(LABELLERS))

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, hashed feature, value): shares of word shapes, and each measure's bucket."""
        shapes = int(self.shape.max(initial=0)) + 1
        pairs, counts = np.unique(self.row * shapes + self.shape, return_counts=True)
        row = pairs // shapes
        value = np.sqrt(counts / np.maximum(self.counts, 1)[row])
        bucket = np.minimum(np.sqrt(self.measures) * 16, 15).astype(np.int64)
        which = np.arange(len(LABELLERS)) * 16 + bucket + 16 * len(LABELLERS) * self.few[:, None]
        at = np.repeat(np.arange(len(self.counts)), len(LABELLERS))
        names = np.concatenate([pairs % shapes, (1 << 20) + which.ravel()])
        hashed = (W.mix(names.astype(np.uint64)) % np.uint64(DIMENSIONS)).astype(np.int64)
        return np.concatenate([row, at]), hashed, np.concatenate([value, np.full(len(at), 0.5)])

    def scores(self, model: Model) -> np.ndarray:
        row, feature, value = self.features()
        return model.bias + np.bincount(row, weights=model.weights[feature] * value, minlength=len(self.counts))


def fit_labellers(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vote probabilities (class x labeller x vote; 1 for abstaining) and the prior, from the number of documents per pattern.

    Class 0 is bad, 1 good; ``EXPECTED``, the start and the prior of the estimates, tells them apart.
    """
    labellers = len(LABELLERS)
    pattern = np.flatnonzero(counts)
    weight = counts[pattern].astype(float)
    cast = pattern[:, None] // 3 ** np.arange(labellers) % 3
    votes = np.tile(EXPECTED[:, None, :], (1, labellers, 1))
    believed = EXPECTED_WEIGHT * weight.sum()
    prior = np.array([0.2, 0.8])
    for _ in range(EM_ROUNDS if len(pattern) else 0):
        both = posterior_log(cast, votes, prior)
        share = np.exp(both - np.logaddexp(both[0], both[1])) * weight
        prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
        voted = share @ (cast != ABSTAIN)
        for vote in (GOOD, BAD):
            votes[:, :, vote] = (share @ (cast == vote) + believed * EXPECTED[:, vote, None]) / (voted + believed)
    return votes, prior


def posterior_log(cast: np.ndarray, votes: np.ndarray, prior: np.ndarray) -> np.ndarray:
    picked = np.log(votes)[:, np.arange(cast.shape[1]), cast]
    return picked.sum(axis=2) + np.log(prior)[:, None]


def posteriors(votes: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The probability of being good for each of the possible patterns."""
    cast = np.arange(PATTERNS)[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    both = posterior_log(cast, votes, prior)
    return np.exp(both[1] - np.logaddexp(both[0], both[1]))


def fit_scorer(rows: list, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression of the posteriors on sparse features, by full gradient steps with momentum."""
    weights, bias = np.zeros(DIMENSIONS), 0.0
    if not rows:
        return weights, bias
    row = np.repeat(np.arange(len(rows)), [len(r["features"]) for r in rows])
    feature = np.concatenate([r["features"] for r in rows]).astype(np.int64)
    value = np.concatenate([r["values"] for r in rows])
    speed, speed_bias = np.zeros(DIMENSIONS), 0.0
    for _ in range(TRAINING_ROUNDS):
        score = bias + np.bincount(row, weights=weights[feature] * value, minlength=len(rows))
        error = good - 1 / (1 + np.exp(-score))
        step = np.bincount(feature, weights=error[row] * value, minlength=DIMENSIONS) / len(rows) - 1e-5 * weights
        speed, speed_bias = 0.9 * speed + step, 0.9 * speed_bias + error.mean()
        weights, bias = weights + 0.5 * speed, bias + 0.5 * speed_bias
    return weights, bias


def fit(docs: DataFrame) -> Model:
    """Train on the texts of ``docs``: votes of all documents, scorer on ``SAMPLE`` of them at most."""
    ship(docs.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(PATTERNS, np.int64)
        for batch in batches:
            for part in W.chunks(batch, "text"):
                texts = _Texts(part.column("text"))
                counts += np.bincount(texts.patterns()[texts.counts > 0], minlength=PATTERNS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["pattern", "n"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    # At most 3^7 patterns, whatever the size of the table.
    counted = texts.mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(PATTERNS, np.int64)
    for r in counted:
        counts[r["pattern"]] = r["n"]
    votes, prior = fit_labellers(counts)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                found = _Texts(part.column("text"))
                row, feature, value = found.features()
                order = np.argsort(row, kind="stable")
                ends = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
                columns = [
                    part.column("place"),
                    pa.array(found.patterns()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(feature[order].astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(value[order])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["place", "pattern", "features", "values"])

    # Equal texts hash alike and count once, so that no group of copies can fill the sample. Of different texts at one
    # place the one with the least checksum is taken, and the rows are put in order: one table gives one model.
    place = F.pmod(F.xxhash64("text"), F.lit(max(int(counts.sum()), 1)))
    sample = texts.where("text is not null").withColumn("place", place).where(F.col("place") < SAMPLE)
    sample = sample.groupBy("place").agg(F.min_by("text", F.md5("text")).alias("text"))
    rows = sample.mapInArrow(describe, "place long, pattern long, features array<int>, values array<double>").collect()
    rows.sort(key=lambda r: r["place"])
    good = posteriors(votes, prior)[[r["pattern"] for r in rows]] if rows else np.zeros(0)
    return Model(votes, prior, *fit_scorer(rows, good))


def classify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row doc_id, posterior (of its votes), score (log-odds of the scorer) and keep (score above ``REJECT_AT``).

    Texts without words, null ones among them, have nothing to score: posterior and score are 0
    and they are not kept. Rows may repeat; only the columns doc_id and text are read.
    """
    model = model or fit(docs)
    ship(docs.sparkSession)
    good = posteriors(model.votes, model.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                texts = _Texts(part.column("text"))
                some = texts.counts > 0
                score = np.where(some, texts.scores(model), 0.0)
                posterior = np.where(some, good[texts.patterns()], 0.0)
                columns = [part.column("doc_id"), pa.array(posterior), pa.array(score), pa.array(some & (score > REJECT_AT))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "posterior", "score", "keep"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, posterior double, score double, keep boolean"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``classify`` keeps."""
    model = model or fit(docs)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                texts = _Texts(part.column("text"))
                yield part.filter(pa.array((texts.counts > 0) & (texts.scores(model) > REJECT_AT)))

    return docs.mapInArrow(run, docs.schema)
