"""Trained models against plain forms of what they add up and fit."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from probelake.llm import language, toxicity
from probelake.llm.common import held_out
from probelake.llm.jaccard import connected

DOCS = "doc_id long, text string, lang string"


def plain_language(rows, learned):
    """Predictions by the definition, one word after the other."""
    counts = [defaultdict(Counter) for _ in range(language.ORDER + 1)]
    words_of = lambda text: re.findall(r"[^\W\d_]+", (text or "").lower())
    for text, lang in learned:
        for word in words_of(text):
            counts[0][word][lang] += 1
            for gram in language.grams_of(word):
                counts[len(gram)][gram][lang] += 1
    langs = sorted({lang for _, lang in learned})
    sums = [{lang: sum(c[lang] for c in of.values()) for lang in langs} for of in counts]

    def add(totals, size, gram):
        for lang in langs:
            n = counts[size][gram][lang] if gram in counts[size] else 0
            totals[lang] += math.log(0.5 / (sums[size][lang] + 1)) + math.log(2 * n + 1)

    out = {}
    for doc_id, text in rows:
        if not any(map(str.isalpha, text or "")):
            out[doc_id] = ("und", 0.0)
            continue
        totals = dict.fromkeys(langs, 0.0)
        for word in words_of(text):
            if word in counts[0]:
                add(totals, 0, word)
                continue
            padded = f" {word} "
            for at in range(len(padded) - 1):
                for size in range(language.ORDER, 0, -1):
                    gram = padded[at : at + size]
                    if len(gram) == size and gram in counts[size]:
                        add(totals, size, gram)
                        break
        best = max(langs, key=lambda k: (totals[k], [-ord(c) for c in k]))
        share = 1 / sum(math.exp((v - totals[best]) / math.sqrt(len(text.split()))) for v in totals.values())
        out[doc_id] = (best, share)
    return out


@pytest.mark.parametrize("entries,chunk", [(400_000, 8_000_000), (6, 300), (0, 1)])
def test_languages_of_the_definition(spark, monkeypatch, entries, chunk):
    """Whatever words are common and wherever chunks end."""
    monkeypatch.setattr(language, "ENTRIES", entries)
    monkeypatch.setattr(language, "CHUNK", chunk)
    monkeypatch.setattr(language, "HELD", 50)
    draw = random.Random(entries)
    letters = {"aa": "abcdef", "bb": "defghi", "cc": "éüß日本"}
    rows = []
    for i in range(90):
        lang = draw.choice(list(letters))
        words = ["".join(draw.choices(letters[lang], k=draw.randrange(1, 5))) for _ in range(draw.randrange(12))]
        rows.append((i, " ".join(words) + draw.choice(["", " 12 x-y", "\n"]), draw.choice([lang, lang, None])))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "1 2 3", "cc"), (203, "zzz qqq", None), (204, "ab " * 500, None)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = [(r.text, r.lang) for r in docs.where(~held_out()).collect() if r.lang]
    expected = plain_language([(i, text) for i, text, _ in rows], kept)
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    assert found.keys() == expected.keys()
    for doc_id, (lang, score) in expected.items():
        assert found[doc_id][1] == pytest.approx(score, rel=1e-9)
        assert found[doc_id][0] == lang or score < 0.51


@pytest.mark.parametrize("n", [1, 3, 49_999, 50_000, 50_002, 50_003, 50_004, 50_005, 120_000])
def test_grams_of_long_words_come_in_pieces(n):
    word = "".join(chr(97 + (i * i) % 26) for i in range(n))
    assert Counter(g for some in language._grams(word) for g in some) == Counter(language.grams_of(word))


def test_numbers_in_few_bytes():
    for values in ([], [0], [65_535, 3], [65_536], [1 << 31]):
        assert language.expanded(language.compact(np.array(values, np.int64))).tolist() == values


def test_regression_reaches_the_slope_of_a_dense_one():
    draw = np.random.default_rng(2)
    dense = draw.random((200, 12)) < 0.3
    target, counted = draw.random(200), draw.uniform(0.5, 3, 200)
    at, which = np.append(0, np.cumsum(dense.sum(1))), np.nonzero(dense)[1]
    for block in (7, 10_000):
        weights = toxicity.regression(at, which, target, 12, counted, block)
        error = counted * (1 / (1 + np.exp(-(dense @ weights[:-1] + weights[-1]))) - target)
        slope = np.append(error @ dense + toxicity.RIDGE * weights[:-1], error.sum())
        assert abs(slope).max() < 0.5 < abs(np.append((counted * (0.5 - target)) @ dense, 1)).max()


def test_label_model_round_by_hand(monkeypatch):
    """One round of the estimate, on three patterns of two voters, worked out plainly."""
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    votes, weights, start, share = np.array([[1.0, 0], [0, 1], [1, 1]]), np.array([6.0, 3, 1]), np.array([0.1, 0.8]), 0.3
    fired = (np.array([7.0, 4.0]) + 1) / 12
    yes, no = np.clip(fired * start / share, 1e-4, 0.9), np.clip(fired * (1 - start) / 0.7, 1e-6, 1)
    expected = []
    for row in votes:
        odds = math.log(0.3 / 0.7) + sum(v * (math.log(y) - math.log(min(n, 1))) for v, y, n in zip(row, yes, no))
        expected.append(1 / (1 + math.exp(-odds)))
    assert toxicity.label_model(votes, weights, start, share) == pytest.approx(expected)


def test_the_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CLEAN", 40)
    rows = [(3, f"bad {i % 2}", "x") for i in range(600)] + [(i, "fine words", "x") for i in range(1000, 1300)]
    labels = spark.createDataFrame([(3, 1)] + [(i, 0) for i in range(1000, 1300)], "doc_id long, toxic int")
    found, times = toxicity.sample(spark.createDataFrame(rows, DOCS), labels)
    assert Counter(r.toxic for r in found.collect()) == {0: 40, 1: 1} and times[0] > 5


def test_repeated_rows_are_one_node(spark):
    """The same id and text in many tasks, beside a near copy."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text)] * 200 + [(9, text + " end")] * 3 + [(8, "other words " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = Counter((r.doc_id, r.component_id) for r in connected(docs).collect())
    assert found == {(7, 7): 200, (9, 7): 3, (8, 8): 1}
