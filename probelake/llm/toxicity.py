"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier.

Voters are lexicon entries (words) and patterns (beginnings of words) that labelled documents of class 1 have far
more often than others; one more votes for class 0 where no other fires. A generative model of the votes
estimates by expectation maximisation how often each fires in either class, and the correlations of voters
within a class, by which it discounts those that fire together. Its posteriors, not the labels, train a logistic
regression over a wider set of words and beginnings, which scores every document.

It learns from at most ``TOXIC`` and ``CLEAN`` labelled rows, chosen by a hash of the id, none of them held out. A row
of a class that was cut stands for as many as there are to each chosen one, so rates are those of all labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import held_out, importable, map_texts, pieces, record, texts
from probelake.session import stage

#: Bounds of the sample of labelled rows that the classifier is fitted on.
TOXIC = 10_000
CLEAN = 20_000
BEGINNINGS = (4, 5, 6)
VOTERS = 100
FEATURES = 2000
LEAST_DOCS = 5
#: Least log-likelihood ratio of a feature; among a million that mean nothing hardly one gets there by chance.
LEAST_GAIN = 14.0
#: A voter has at least this share of class 1 among the documents it fires on.
LEAST_PRECISION = 0.7
ROUNDS = 30
RIDGE = 0.5
#: Features whose part of the gradient is worked out at a time.
BLOCK = 1_000_000
THRESHOLD = 0.3
REMEMBERED = 300_000
WORD = re.compile(r"[^\W\d_]+")


def features_of(token: str) -> list[str]:
    """The words in a piece of text without spaces, and their beginnings (marked by a star)."""
    found = []
    for word in WORD.findall(token.lower()):
        found.append(word)
        found += [word[:n] + "*" for n in BEGINNINGS if len(word) >= n]
    return found


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("feature", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]
    for batch in batches:
        for piece in pieces(batch):
            every, bad = Counter(), Counter()
            for text, toxic in zip(texts(piece), piece.column("toxic").to_pylist()):
                present = {f for t in set(text.split()) for f in features_of(t)}
                every.update(present)
                if toxic:
                    bad.update(present)
            yield record(kinds, [every, [n - bad[f] for f, n in every.items()], [bad[f] for f in every]])


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[float]]:
    """Texts and labels of the labelled rows to learn from, and for how many rows one of class 0 and 1 stands.

    At most ``TOXIC`` and ``CLEAN`` rows, whatever the tables hold: ``toxic`` is the larger one of several labels, and of
    several texts of one doc_id it is the least.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    times = [max(1.0, totals.get(k, 0) / n) for k, n in ((0, CLEAN), (1, TOXIC))]
    draw = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == k).orderBy(draw, "doc_id").limit(n) for k, n in ((1, TOXIC), (0, CLEAN))]
    ids = chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "__id")
    rows = docs.where(~held_out()).select("doc_id", "text")
    # At most TOXIC + CLEAN ids, whatever the size of the corpus.
    rows = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return stage(rows.select("toxic", "text"), "toxicity-sample"), times


def surprise(both: np.ndarray, alone: np.ndarray, n: float, n_toxic: float) -> np.ndarray:
    """How much more than expected a feature goes with class 1, as a log-likelihood ratio."""
    expected = alone * n_toxic / n
    return np.where(both > expected, both * np.log(np.maximum(both, 1e-9) / np.maximum(expected, 1e-9)), 0.0)


def label_model(votes: np.ndarray, weights: np.ndarray, start: np.ndarray, share: float) -> np.ndarray:
    """Posterior of class 1 for each row of ``votes`` (0 or 1, a voter for class 0 first).

    ``start`` holds each voter's share of class 1 and ``share`` that of all rows, as the labels have them; the
    model stays half way to them, so that voters which only agree with each other don't make a class of their
    own. ``weights`` counts equal rows.
    """
    total = weights.sum()
    fired = (weights @ votes + 1.0) / (total + 2.0)
    first = [np.clip(fired * start / share, 1e-4, 0.9), np.clip(fired * (1 - start) / (1 - share), 1e-6, 1.0)]
    (yes, no), begun = first, share
    discount = np.ones(votes.shape[1])
    for _ in range(ROUNDS):
        evidence = discount * (np.log(np.clip(yes, 1e-6, 1)) - np.log(np.clip(no, 1e-6, 1)))
        odds = np.log(share / (1 - share)) + votes @ evidence
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        in_class = [weights * posterior, weights * (1 - posterior)]
        share = float(np.clip((in_class[0].sum() / total + begun) / 2, 0.01, 0.9))
        yes, no = (((w @ votes + 0.05) / (w.sum() + 0.1) + f) / 2 for w, f in zip(in_class, first))
        together = np.zeros((votes.shape[1],) * 2)
        for w in in_class:
            rate = (w @ votes + 0.05) / (w.sum() + 0.1)
            spread = np.sqrt(rate * (1 - rate))
            both = (votes * w[:, None]).T @ votes / max(w.sum(), 1e-9) - np.outer(rate, rate)
            both = both / np.maximum(np.outer(spread, spread), 1e-9) * (w.sum() / total)
            together = np.maximum(together, both)
        np.fill_diagonal(together, 0.0)
        discount = 1 / (1 + np.clip(together, 0, 1).sum(1))
    return posterior


def regression(
    at: np.ndarray, which: np.ndarray, target: np.ndarray, width: int, counted: np.ndarray, block: int = BLOCK
) -> np.ndarray:
    """Weights (the constant last) of a ridge logistic regression on sets of features, by gradient steps.

    Row i has the features ``which[at[i]:at[i + 1]]`` and counts ``counted[i]``. The gradient is summed over blocks of rows
    with about ``block`` features.
    """
    weights, momentum, scale = np.zeros(width + 1), np.zeros(width + 1), np.full(width + 1, 1e-9)
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, at[-1], block)), len(target)))
    cuts = np.append(0, cuts[cuts > 0])
    for step in range(300):
        slope = np.zeros(width + 1)
        for low, high in zip(cuts[:-1], cuts[1:]):
            features = which[at[low] : at[high]]
            row = np.repeat(np.arange(high - low), np.diff(at[low : high + 1]))
            sums = weights[-1] + np.bincount(row, weights[features], high - low)
            error = counted[low:high] * (1 / (1 + np.exp(-np.clip(sums, -30, 30))) - target[low:high])
            slope[:-1] += np.bincount(features, error[row], width)
            slope[-1] += error.sum()
        slope += RIDGE * np.append(weights[:-1], 0.0)
        momentum = 0.9 * momentum + 0.1 * slope
        scale = 0.99 * scale + 0.01 * slope**2
        weights -= 0.1 * (0.98**step + 0.02) * momentum / np.sqrt(scale)
    return weights


class Classifier:
    """Weights of words and beginnings of words."""

    def __init__(self, features: list[str], weights: np.ndarray, constant: float):
        self.features, self.weights, self.constant = features, weights, constant
        self.numbers = {f: i for i, f in enumerate(features)}
        self.tokens: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        return Classifier, (self.features, self.weights, self.constant)

    def present(self, text: str) -> set[int]:
        if len(self.tokens) > REMEMBERED:
            self.tokens.clear()
        found: set[int] = set()
        for token in set(text.split()):
            numbers = self.tokens.get(token)
            if numbers is None:
                numbers = tuple(n for f in features_of(token) if (n := self.numbers.get(f)) is not None)
                self.tokens[token] = numbers
            found.update(numbers)
        return found

    def score(self, text: str) -> float:
        total = self.constant + sum(self.weights[sorted(self.present(text))])
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn a classifier; without labelled rows of class 1 it scores every text 0."""
    importable(docs.sparkSession)
    rows, times = sample(docs, labels)
    sizes = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not sizes.toxic:
        return Classifier([], np.zeros(0), -30.0)
    all_toxic, all_clean = times[1] * sizes.toxic, times[0] * (sizes.n - sizes.toxic)
    share = all_toxic / (all_toxic + all_clean)
    counts = rows.mapInArrow(_presence, "feature string, clean long, toxic long").groupBy("feature")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # What chance gives depends on the rows there are, so this bound is on the sample as drawn, unlike all rates.
    lift = F.col("toxic") / (F.col("clean") + F.col("toxic")) / (sizes.toxic / sizes.n)
    gain = F.col("toxic") * F.log(lift)
    kept = counts.where((F.col("toxic") >= LEAST_DOCS) & (gain >= LEAST_GAIN)).orderBy(gain.desc(), "feature")
    kept = kept.limit(FEATURES).collect()
    if not kept:
        return Classifier([], np.zeros(0), float(np.log(all_toxic / (all_clean + 1.0))))
    names = [r.feature for r in kept]
    both, clean = (times[k] * np.array([r[c] for r in kept], dtype=float) for k, c in ((1, "toxic"), (0, "clean")))
    alone = both + clean
    gains = surprise(both, alone, all_toxic + all_clean, all_toxic)
    voters = [i for i in np.argsort(-gains, kind="stable") if both[i] >= LEAST_PRECISION * alone[i]][:VOTERS]
    blank = Classifier(names, np.zeros(len(names)), 0.0)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = [sorted(blank.present(t)) for t in texts(piece)]
                yield record([("found", pa.list_(pa.int32())), ("toxic", pa.int32())], [found, piece.column("toxic").cast("int32")])

    table = rows.mapInArrow(present, "found array<int>, toxic int").orderBy("found", "toxic").toArrow()
    lists = table.column("found").combine_chunks()
    at, which = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    toxic = table.column("toxic").to_numpy()
    del table
    # Rows count by what they stand for, and all of them as many as were drawn.
    counted = np.array(times)[toxic]
    counted *= len(counted) / counted.sum()
    place = np.zeros(len(names), np.int64)
    place[voters] = np.arange(1, len(voters) + 1)
    voter = place[which]
    row = np.repeat(np.arange(len(toxic)), np.diff(at))[voter > 0]
    votes = np.zeros((len(toxic), len(voters) + 1), np.uint8)
    votes[row, voter[voter > 0]] = 1
    votes[:, 0] = ~votes.any(1)
    start = np.clip(np.append(0.01, both[voters] / alone[voters]), 0.01, 0.99)
    _, first, inverse = np.unique(np.packbits(votes, axis=1), axis=0, return_index=True, return_inverse=True)
    inverse = inverse.ravel()
    patterns = votes[first].astype(float)
    posterior = label_model(patterns, np.bincount(inverse, counted), start, share)[inverse]
    weights = regression(at, which, posterior, len(names), counted)
    return Classifier(names, weights[:-1], float(weights[-1]))


SCORED = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())]


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD`` on).

    A null text scores as an empty one; rows with null (not held out) or equal ids are scored each; an empty
    table gives an empty result; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")

    def work(piece: pa.RecordBatch):
        scores = [sent.value.score(t) for t in texts(piece)]
        yield record(SCORED, [piece.column("doc_id"), piece.column("held_out"), scores])

    scored = map_texts(rows, work, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents, all columns, that score below ``THRESHOLD``.

    A null text scores as an empty one; rows with null or equal ids are judged each; an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def work(piece: pa.RecordBatch):
        yield piece.filter(pa.array([sent.value.score(t) < THRESHOLD for t in texts(piece)], pa.bool_()))

    return map_texts(docs, work, docs.schema)
