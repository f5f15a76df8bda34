"""Quality by naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, a linear hinge-loss model.

N-grams are words and pairs of words, and one to three *shapes* of words in a row: which kinds of characters follow
each other (``Ul.`` for ``Then.``), and whether the word before is repeated. A shape n-gram has an indicator for being there at
all and one for each share of the text it reaches, so that a text which is junk in part shows how much of it is. Indicators
are hashed to ``2**BITS`` places. Each is scaled by the log of the ratio of its shares in the two classes (naive Bayes),
a text's vector is brought to length one, and a support vector machine is fitted by dual coordinate descent. A logistic
curve, fitted to margins of rows that were kept from the descent, makes them scores.

It learns from at most ``SAMPLE`` labelled rows of each class, chosen by a hash of the id, none of them held out; a row of a
class that was cut counts as many times as there are rows to each chosen one. Scoring covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import importable, pieces, record, texts
from probelake.llm.words import NOT_SPACE, hashes, mixed
from probelake.session import stage

#: Most labelled rows of a class that the model is fitted on.
SAMPLE = 6000
BITS = 18
#: Shares of a text's words from which on a shape n-gram counts once more.
SHARES = (1 / 64, 1 / 16, 1 / 4, 1 / 2)
#: Characters of short texts that are worked on together.
TOGETHER = 300_000
SMOOTHING = 1.0
#: Cost of a margin violation, passes over the rows, and how much the fitted weights count beside their mean size.
COST = 1.0
PASSES = 30
MIXTURE = 0.25
THRESHOLD = 0.3
#: One row of so many is kept from the descent, for the logistic curve.
CURVE = 4
FOLDS = 5

_LINE = 10


def _kinds() -> bytes:
    """For each byte, the kind it belongs to: space, capital, small, digit, beyond ASCII; others are their own."""
    table = bytearray(range(256))
    for b in range(256):
        if b == 0x20 or 9 <= b <= 13:
            table[b] = 0x20
        elif 0x41 <= b <= 0x5A:
            table[b] = ord("U")
        elif 0x61 <= b <= 0x7A or b >= 0x80:
            table[b] = ord("l")
        elif 0x30 <= b <= 0x39:
            table[b] = ord("0")
    return bytes(table)


KINDS = _kinds()


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[False], NOT_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def _distinct(text: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each n-gram once per text, and how often it is there."""
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    new = np.append(True, (text[1:] != text[:-1]) | (grams[1:] != grams[:-1]))[: len(text)]
    first = np.flatnonzero(new)
    return text[first], grams[first], np.diff(np.append(first, len(text)))


def _seeded(grams: np.ndarray, seed: int) -> np.ndarray:
    return mixed(grams ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64)))


def indicators(group: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts (by number) and places of the indicators that are on, sorted, each pair once."""
    parts = [t.encode("utf-8", "replace") for t in group]
    raw = b"\n".join(parts) + b"\n"
    data = np.frombuffer(raw.lower(), np.uint8)
    starts, ends = _spans(data)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    limits = np.cumsum([len(p) + 1 for p in parts])
    text = np.searchsorted(limits, starts, side="right")
    words = hashes(data, starts, ends)
    kinds = np.frombuffer(raw.translate(KINDS), np.uint8)
    kinds = kinds[np.append(True, kinds[1:] != kinds[:-1])]
    shapes = hashes(kinds, *_spans(kinds))
    n_words = np.bincount(text, minlength=len(group))

    def after(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Values in a row of n, within a text."""
        joined = values[: len(values) - n + 1].copy()
        for i in range(1, n):
            joined = mixed(joined * np.uint64(3) + values[i : len(values) - n + 1 + i])
        same = text[: len(joined)] == text[n - 1 :]
        return text[: len(joined)][same], joined[same]

    found: list[tuple[np.ndarray, np.ndarray]] = []
    for n in (1, 2):
        where, grams, _ = _distinct(*after(words, n))
        found.append((where, _seeded(grams, n)))
    repeated = np.append(False, (words[1:] == words[:-1]) & (text[1:] == text[:-1]))
    told = np.where(repeated, np.uint64(7), shapes)
    for n in (1, 2, 3):
        where, grams, times = _distinct(*after(told, n))
        found.append((where, _seeded(grams, 10 * n)))
        for level, share in enumerate(SHARES, 1):
            enough = times >= share * n_words[where]
            found.append((where[enough], _seeded(grams[enough], 10 * n + level)))
    where = np.concatenate([w for w, _ in found])
    place = (np.concatenate([g for _, g in found]) >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.unique(where * (1 << BITS) + place)
    return both >> BITS, both & ((1 << BITS) - 1)


def groups(found: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts with about ``TOGETHER`` characters, one text at least, with the number of the first."""
    at, size = 0, 0
    for i, text in enumerate(found):
        if size and size + len(text) > TOGETHER:
            yield at, found[at:i]
            at, size = i, 0
        size += len(text)
    if at < len(found):
        yield at, found[at:]


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text is divisible by 5 (a null id: learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[DataFrame, list[float]]:
    """Vectors (``places``) and labels of rows to learn from, and how many rows one of class 0 and of class 1 counts for.

    At most ``most`` documents of a class, whatever the tables hold: ``quality`` is the smaller one of several labels,
    and of several texts of one doc_id it is the least.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = docs.where(~held_out()).select(F.col("doc_id").alias("__id"), "text")
    have = rows.select("__id").distinct()
    known = stage(known.join(have, F.col("doc_id") == F.col("__id"), "left_semi"), "quality-labels")
    totals = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    draw = F.xxhash64("doc_id")
    chosen = [known.where(F.col("quality") == k).orderBy(draw, "doc_id").limit(most) for k in (0, 1)]
    # At most twice `most` ids, whatever the size of the corpus.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    found = rows.join(ids, F.col("doc_id") == F.col("__id"))
    found = found.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.coalesce("text", F.lit(""))).alias("text"))
    times = [max(1.0, totals.get(k, 0) / most) for k in (0, 1)]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("doc_id", pa.int64()), ("quality", pa.int32()), ("places", pa.list_(pa.int32()))]
        for batch in batches:
            for piece in pieces(batch):
                for at, group in groups(texts(piece)):
                    where, place = indicators(group)
                    cuts = np.searchsorted(where, np.arange(len(group) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(place, pa.int32()))
                    part = piece.slice(at, len(group))
                    yield record(kinds, [part.column("doc_id").cast("int64"), part.column("quality").cast("int32"), lists])

    importable(docs.sparkSession)
    return stage(found.mapInArrow(vectors, "doc_id long, quality int, places array<int>"), "quality-sample"), times


def log_count_ratio(which: np.ndarray, in_good: np.ndarray, width: int) -> np.ndarray:
    """Log of the ratio of an indicator's share among all of class 1 to that among class 0."""
    counts = [SMOOTHING + np.bincount(which[k], minlength=width) for k in (in_good, ~in_good)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def descend(
    at: np.ndarray, which: np.ndarray, values: np.ndarray, sign: np.ndarray, cost: np.ndarray, width: int, passes: int = PASSES
) -> np.ndarray:
    """Weights (the constant last) that minimise half their square plus the cost of hinge losses, by dual coordinates.

    Row i has ``values[at[i]:at[i + 1]]`` at ``which[...]``, the class ``sign[i]`` (1 or -1) and the cost ``cost[i]``. Each
    step solves for the multiplier of one row, between 0 and its cost; rows go in a new order in each pass.
    """
    weights, alpha = np.zeros(width + 1), np.zeros(len(sign))
    square = np.add.reduceat(np.append(values**2, 0.0), at[:-1]) * (at[1:] > at[:-1]) + 1.0
    draw = np.random.default_rng(0)
    for _ in range(passes):
        moved = 0.0
        for i in draw.permutation(len(sign)):
            where, x = which[at[i] : at[i + 1]], values[at[i] : at[i + 1]]
            slope = sign[i] * (weights[where] @ x + weights[-1]) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            change = (new - alpha[i]) * sign[i]
            if change:
                alpha[i] = new
                weights[where] += change * x
                weights[-1] += change
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return weights


def logistic(margin: np.ndarray, good: np.ndarray, counted: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and constant of the curve from margins to the share of class 1, by Newton steps."""
    rise, constant = 1.0, 0.0
    n_good, n_poor = counted[good].sum(), counted[~good].sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_poor + 2))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rise * margin + constant, -30, 30)))
        error, curve = counted * (p - target), counted * p * (1 - p) + 1e-12
        slope = np.array([error @ margin + 1e-3 * rise, error.sum()])
        bend = np.array([[curve @ margin**2 + 1e-3, curve @ margin], [curve @ margin, curve.sum() + 1e-9]])
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        rise, constant = rise - step[0], constant - step[1]
        if abs(step).max() < 1e-6:
            break
    return max(float(rise), 0.0), float(constant)


class Model:
    """Scaled weights of hashed indicators and the curve from margins to scores."""

    def __init__(self, ratio: np.ndarray, weights: np.ndarray, constant: float, rise: float, level: float):
        self.ratio, self.weights, self.constant, self.rise, self.level = ratio, weights, constant, rise, level

    def margins(self, group: list[str]) -> np.ndarray:
        where, place = indicators(group)
        scaled = self.ratio[place]
        sums = np.bincount(where, scaled * self.weights[place], len(group))
        return sums / np.sqrt(np.maximum(np.bincount(where, scaled**2, len(group)), 1e-12)) + self.constant

    def scores(self, group: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.rise * self.margins(group) + self.level, -30, 30)))


def fit(places: list[np.ndarray] | tuple[np.ndarray, np.ndarray], good: np.ndarray, times: list[float]) -> Model:
    """A model from vectors, given as (borders, places), and their classes; ``times``: what a row of each class counts."""
    at, which = places
    row = np.repeat(np.arange(len(good)), np.diff(at))
    learned = np.arange(len(good)) % CURVE != 0
    if min(good[learned].sum(), (~good)[learned].sum(), good[~learned].sum(), (~good)[~learned].sum()) == 0:
        learned[:] = True  # too few rows to keep some back
    known = learned[row]
    ratio = log_count_ratio(which[known], good[row[known]], 1 << BITS)
    scaled = ratio[which]
    scaled /= np.sqrt(np.maximum(np.bincount(row, scaled**2, len(good)), 1e-12))[row]
    counted = np.where(good, times[1], times[0])
    kept = np.flatnonzero(learned)
    borders = np.append(0, np.cumsum(np.diff(at)[kept]))
    cost = COST * counted[kept] / counted[kept].mean()
    weights = descend(borders, which[known], scaled[known], np.where(good[kept], 1.0, -1.0), cost, 1 << BITS)
    slopes, constant = weights[:-1], weights[-1]
    size = np.abs(slopes[slopes != 0]).mean() if slopes.any() else 0.0
    slopes = (1 - MIXTURE) * size + MIXTURE * slopes
    margin = np.bincount(row, scaled * slopes[which], len(good)) + constant
    rest = ~learned if not learned.all() else learned
    rise, level = logistic(margin[rest], good[rest], counted[rest])
    return Model(ratio, slopes, float(constant), rise, level)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs`` and ``labels``; with rows of one class or none it scores every text by their share (0.5: none)."""
    rows, times = sample(docs, labels)
    table = rows.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    good = table.column("quality").to_numpy() == 1
    if good.all() or not good.any():
        level = 0.0 if not len(good) else 30.0 if good.all() else -30.0
        return Model(np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0, level)
    lists = table.column("places").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return fit((lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()), good, times)


SCORED = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from ``THRESHOLD`` on).

    A null text scores as an empty one; rows with null (not held out) or equal ids are scored each; an empty table gives
    an empty result; other columns are not read.
    """
    importable(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                for at, group in groups(texts(piece)):
                    part = piece.slice(at, len(group))
                    yield record(SCORED, [part.column("doc_id"), part.column("held_out"), sent.value.scores(group)])

    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
