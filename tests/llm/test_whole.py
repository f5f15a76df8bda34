"""Whole results where a bound once cut them."""

import base64
import bz2
import gzip
import lzma
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from probelake.llm import jaccard, language, secrets, toxicity
from probelake.llm.common import held_out


def test_language_has_no_bound_on_languages_and_words(spark):
    def word(n):
        return "".join(chr(97 + n // 26**i % 26) for i in range(5))

    # More than 200 languages, and words that occur once each, more than any share of a fixed number of entries.
    rows = [(i, word(7919 * i), f"l{i % 205:03}") for i in range(205 * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identify(docs).collect()}
    kept = {r.doc_id: r.lang for r in docs.where(~held_out()).collect()}
    assert len(set(kept.values())) == 205 and all(found[i] == lang for i, lang in kept.items())

    words = {word(7919 * i) for i in range(300_000, 360_000)}
    model = language.train(spark.createDataFrame([(1_000_000, " ".join(words), "x")], docs.schema))
    assert {r.gram for r in model.words.collect()} == words


def test_jaccard_units_may_end_where_batches_end():
    kinds = [(c, pa.int64()) for c in ("unit", "node", "n", "part", "root")] + [("counts", pa.binary())]
    sets = [np.arange(40, dtype=np.uint64) * np.uint64(2**33 + 1), np.arange(41, dtype=np.uint64) * np.uint64(2**33 + 1)]
    rows = [(unit, 2 * unit + i, len(s), 2, 2 * unit + i, jaccard.counted(s)) for unit in range(4) for i, s in enumerate(sets)]
    expected = [(2 * unit, 2 * unit + 1) for unit in range(4)]
    for size in range(1, 9):
        batches = [jaccard.record(kinds, list(zip(*rows[at : at + size]))) for at in range(0, 8, size)]
        found = [tuple(p.values()) for b in jaccard._joined(iter(batches), 80) for p in b.to_pylist()]
        assert found == expected


def test_toxicity_scores_do_not_follow_the_bounds_of_the_sample(spark, monkeypatch):
    rng = random.Random(3)
    noise = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(60)]
    docs, labels = [], []
    for i in range(12_000):
        toxic = rng.random() < 0.1
        words = rng.choices(noise, k=5) + [w for w, yes, no in (("vileword", 0.7, 0.005), ("weakword", 0.5, 0.08)) if rng.random() < (yes if toxic else no)]
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")

    def odds(toxic, clean):
        monkeypatch.setattr(toxicity, "TOXIC", toxic)
        monkeypatch.setattr(toxicity, "CLEAN", clean)
        scores = [toxicity.train(docs, labels).score(t) for t in ("nothing", "weakword")]
        return np.log(np.array(scores) / (1 - np.array(scores)))

    assert np.abs(odds(10_000, 20_000) - odds(600, 1200)).max() < 0.4


PLAIN = b"password=abcdefghij1234"
GZIPPED = gzip.compress(PLAIN, mtime=0)


@pytest.mark.parametrize(
    "data",
    [
        gzip.compress(GZIPPED, mtime=0),
        *(pack(GZIPPED) for pack in (zlib.compress, bz2.compress, lzma.compress)),
        *(pack(b"nothing here") + pack(PLAIN) for pack in (lambda d: gzip.compress(d, mtime=0), bz2.compress, lzma.compress)),
        *(c.encode() + PLAIN for c in "\ufeff\xa0\u200b\xad\f\0"),
        b"\xff " + PLAIN,
        PLAIN.decode().encode("utf-16"),
        PLAIN.decode().encode("utf-16-le"),
    ],
)
def test_secrets_in_layers_of_any_bytes(data):
    text = f"x {base64.b64encode(data).decode()} y"
    _, found, cut = secrets.scan(text)
    assert (2, 0, len(text) - 2) in found and not cut


def test_secrets_beside_a_bad_escape():
    _, found, _ = secrets.scan("x %FF%70%61ssword=abcdefghij1234 y")
    assert (5, 0, 32) in found


def test_secrets_in_runs_of_either_alphabet_over_lines_and_behind_prefixes():
    rng = random.Random(8)
    for _ in range(40):
        data = rng.randbytes(30) + b" " + PLAIN + b" " + rng.randbytes(30)
        lines = b"".join(b"line %d\n" % rng.randrange(10**9) for _ in range(30)) + PLAIN
        prefix = "/" + "".join(rng.choices("abc/", k=rng.randint(1, 9))) + "/"
        runs = [base64.urlsafe_b64encode(d).decode() for d in (data, zlib.compress(lines))]
        runs += [base64.encodebytes(d).decode().strip() for d in (data, lines, zlib.compress(lines))]
        runs += [prefix + base64.b64encode(d).decode() for d in (data, GZIPPED)]
        for run in runs:
            _, found, _ = secrets.scan(f"x {run} y")
            assert any(kind == 0 and start == 2 for start, kind, _ in found), run
