"""Naive Bayes support vectors against plain forms of its parts, and on held-out labels."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from probelake.llm import naive_bayes as nb

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


def plain_indicators(text):
    """Names of the indicators of one text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lowered = [w.encode().lower() for w in words]
    shapes = []
    for word in words:
        kinds = "".join(
            "U" if "A" <= c <= "Z" else "l" if "a" <= c <= "z" or ord(c) > 127 else "0" if c.isdigit() else c for c in word
        )
        shapes.append(re.sub(r"(.)\1*", r"\1", kinds, flags=re.S))
    told = ["=" if i and lowered[i] == lowered[i - 1] else s for i, s in enumerate(shapes)]
    found = {("words", n, tuple(lowered[i : i + n])) for n in (1, 2) for i in range(len(words) - n + 1)}
    for n in (1, 2, 3):
        counts = Counter(tuple(told[i : i + n]) for i in range(len(words) - n + 1))
        for gram, times in counts.items():
            levels = [0] + [k for k, share in enumerate(nb.SHARES, 1) if times >= share * len(words)]
            found |= {("shapes", n, k, gram) for k in levels}
    return found


TEXTS = ["", "  \n", "One word.", "a a a a", "The THE the 12 x!! é", "B&&& c$$$ d### B&&&", "Ab ab\x00ab\tab", "x " * 50 + "y"]


def test_indicators_are_those_of_the_plain_form():
    where, place = nb.indicators(TEXTS)
    for i, text in enumerate(TEXTS):
        # 2**18 places and few indicators: equal numbers, but for a rare clash.
        assert abs((where == i).sum() - len(plain_indicators(text))) <= 1
        alone = nb.indicators([text])[1]
        assert (np.sort(place[where == i]) == np.sort(alone)).all()


def test_same_text_in_any_group():
    for _, group in nb.groups(["ab " * 200_000, "c d", "", "e"] * 2):
        assert (nb.indicators(group)[0] < len(group)).all()
    assert [at for at, _ in nb.groups(["ab " * 200_000, "c d", "", "e"])] == [0, 1]


def test_descent_reaches_the_optimum():
    """Against a slow subgradient descent on the primal problem."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(40, 5)) * (draw.random((40, 5)) < 0.6)
    sign = np.where(x @ [1, -2, 0.5, 0, 1] + draw.normal(size=40) * 0.5 > 0, 1.0, -1.0)
    cost = draw.uniform(0.5, 2, 40)
    at = np.append(0, np.cumsum((x != 0).sum(1)))
    weights = nb.descend(at, np.nonzero(x)[1], x[x != 0], sign, cost, 5, 2000)

    def objective(w):
        return w @ w / 2 + cost @ np.maximum(0, 1 - sign * (x @ w[:-1] + w[-1]))

    w, best = np.zeros(6), math.inf
    for step in range(1, 30_000):
        active = sign * (x @ w[:-1] + w[-1]) < 1
        slope = w - np.append((cost * sign * active) @ x, cost @ (sign * active))
        w = w - slope / (step + 10)
        best = min(best, objective(w))
    assert objective(weights) <= best * 1.001


def test_log_count_ratio_by_hand():
    which, good = np.array([0, 0, 1, 2, 0]), np.array([True, True, True, False, False])
    ratio = nb.log_count_ratio(which, good, 3)
    shares = [np.array([3, 2, 1]) / 6, np.array([2, 1, 2]) / 5]
    assert np.allclose(ratio, np.log(shares[0] / shares[1]))


def test_logistic_gives_shares():
    margin = np.array([-1.0, -1.0, -1.0, 1.0, 1.0, 1.0] * 50)
    good = np.array([False, False, True, True, True, False] * 50)
    rise, level = nb.logistic(margin, good, np.ones(300))
    assert abs(1 / (1 + math.exp(-(rise + level))) - 2 / 3) < 0.02


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_rows_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = nb.score(docs, nb.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id) for r in rows)
    right = [r.predicted == r.quality for r in rows if r.held_out]
    assert sum(right) >= 0.95 * len(right) > 40
    good = [r.predicted for r in rows if r.quality]
    assert sum(good) >= 0.99 * len(good)


def test_labels_held_out_are_never_read(spark):
    docs = spark.createDataFrame([(i, "Good words here." if i % 2 else "BAD!! BAD!!") for i in range(200)], DOCS)
    right = [(i, i % 2) for i in range(200)]
    wrong = [(i, 1 - q if held(i) else q) for i, q in right]
    scores = [
        [r.score for r in nb.score(docs, nb.train(docs, spark.createDataFrame(labels, LABELS))).orderBy("doc_id").collect()]
        for labels in (right, wrong)
    ]
    assert scores[0] == scores[1] and scores[0][1] > 0.7 > 0.3 > scores[0][0]


def test_odd_tables(spark):
    texts = [(None, None), (1, None), (1, ""), (1, "Some words."), (2, "x" * 400_000), (3, "BAD!!"), (3, "BAD!!"), (None, "y")]
    docs = spark.createDataFrame(texts, DOCS).selectExpr("*", "'z' AS quality", "1 AS score", "2 AS places")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (4, 1), (None, 1), (5, None), (6, 7)], LABELS)
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        found = nb.score(docs, nb.train(docs, known)).collect()
        assert len(found) == len(texts) and all(0 <= r.score <= 1 for r in found)
        assert sum(r.doc_id is None and not r.held_out for r in found) == 2
    assert nb.score(docs.limit(0), nb.train(docs.limit(0), labels)).count() == 0


def test_the_sample_is_bounded(spark):
    """One doc_id may be repeated without end, and a class may be large."""
    texts = [(7, f"row {i % 3}") for i in range(500)] + [(i, "other text") for i in range(100, 400)]
    labels = spark.createDataFrame([(7, 0)] + [(i, 1) for i in range(100, 400)], LABELS)
    rows, times = nb.sample(spark.createDataFrame(texts, DOCS), labels, 50)
    found = rows.collect()
    assert Counter(r.quality for r in found) == {0: 1, 1: 50}
    assert times[0] == 1 and times[1] == sum(not held(i) for i in range(100, 400)) / 50


@pytest.mark.parametrize("n", [10, 1000])
def test_scores_hardly_move_with_the_bound(spark, n):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows, _ = nb.sample(docs, labels, n)
    assert max(Counter(r.quality for r in rows.select("quality").collect()).values()) <= n
