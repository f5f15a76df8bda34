"""Every registered query over its whole table against a plain form of its contract."""

import hashlib
import html
import re
import zlib
from array import array
from collections import defaultdict

import brute
import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from compare import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as entry
from probelake.llm import sharding
from probelake.llm.queries import ORACLES, QUERIES

SMALLEST, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALLEST}/documents.parquet'").fetchall()
    return dict(rows)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def result(spark, name, sf_dir=SMALLEST, key="doc_id"):
    rows = [r.asDict() for r in entry.queries()[name](spark, sf_dir).collect()]
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SMALLEST), SMALLEST, QUERIES[name], ORACLES[name]) is None


def test_sharding(spark, texts):
    table = [r.shard for r in sharding.lookup_table(spark, sharding.shard_names()).orderBy("slot").collect()]
    found = result(spark, "op1_sharding")
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        slot = int(hashlib.md5(str(doc_id).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (row["slot"], row["shard"]) == (slot, table[slot])


def test_quality(spark, texts):
    found = result(spark, "op2_quality_rules")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for doc_id, text in texts.items():
        assert tuple(found[doc_id][n] for n in names) == brute.quality(text)
        assert not (found[doc_id]["base_failed"] and found[doc_id]["kept"])


def test_quality_keeps_clean_documents(spark):
    found = result(spark, "op2_quality_rules", SMALL)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SMALL}/labels.parquet'").fetchall()
    judged = [(q, found[i]["kept"]) for i, q in labels if not found[i]["base_failed"]]
    good, poor = ([k for q, k in judged if q == value] for value in (1, 0))
    assert sum(good) >= 0.99 * len(good)
    assert sum(poor) <= 0.5 * len(poor)


def test_tokens(spark, texts, tokenizer):
    found = result(spark, "op3_token_counts")
    for doc_id, text in texts.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        row = found[doc_id]
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 1024)


def test_pages(spark):
    found = result(spark, "op4_html_extraction", key="page_id")
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SMALLEST}/pages.parquet'").fetchall())
    assert found.keys() == pages.keys()
    for page_id, page in pages.items():
        body = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<script.*?</script>", " ", page)
        plain = html.unescape(re.sub(r"<[^>]*>", " ", body))
        marks = re.sub(r"(?m)^( *)- ", r"\1", found[page_id]["text"])
        assert "".join(marks.split()) == "".join(plain.split())


def test_secrets(spark, texts):
    found = result(spark, "op5_secret_scan")
    for doc_id, text in texts.items():
        row, (counts, digest) = found[doc_id], brute.secrets(text)
        assert ((row["n_assign"], row["n_access"], row["n_hex"]), row["base_sha256"]) == (counts, digest)


def test_toxicity(spark):
    found = result(spark, "op6_toxicity", "/root/testdata/sf0.1")
    labels = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    assert all(r["held_out"] == held(i) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found.values())
    rows = [(labels[i], found[i]["predicted"]) for i in found if held(i) and i in labels]
    caught = sum(p for t, p in rows if t)
    assert caught >= 0.8 * sum(t for t, _ in rows)
    assert sum(p for t, p in rows if not t) <= 0.05 * sum(not t for t, _ in rows)


def test_leaks(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    found = result(spark, "op7_decontamination", SMALL)
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = brute.leaks([t for _, t in rows], items)
    assert sum(e[-1] for e in expected) > 10
    for (doc_id, _), wanted in zip(rows, expected):
        assert tuple(found[doc_id][n] for n in names) == wanted


def check_pieces(rows, ids_of):
    pieces, sequences = defaultdict(list), set()
    for r in rows:
        pieces[r.doc_id].append(r)
        assert r.sequence_id not in sequences and r.offset == 0
        sequences.add(r.sequence_id)
        assert r.length in {1 << b for b in range(12)}
    for doc_id, ids in ids_of.items():
        ids, at = [*ids, 1], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = array("I", ids[r.start : r.start + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)


def test_packing(spark, texts, tokenizer):
    rows = QUERIES["op8_packing"](spark, SMALLEST).collect()
    check_pieces(rows, {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()})


def test_language(spark):
    found = result(spark, "op9_language_id", SMALL)
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMALL}/documents.parquet'").fetchall())
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in found.items())
    out = [i for i in langs if held(i)]
    assert sum(found[i]["lang_pred"] == langs[i] for i in out) >= 0.97 * len(out)


def test_jaccard(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    found = result(spark, "op10_jaccard_join", SMALL)
    expected = brute.components(rows)
    assert sum(i != c for i, (_, c) in expected.items()) > 20
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected


def test_pipeline(spark, tokenizer):
    """Each stage on what the one before kept: the filters by brute force, the toxic by their scores."""
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    columns = docs.columns
    scores = result(spark, "op6_toxicity")
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = {i: t for i, t in texts.items() if not scores[i]["predicted"]}
    groups = brute.components(list(left.items()))
    left = {i: t for i, t in left.items() if groups[i][1] == i}
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALLEST}/benchmark.parquet'").fetchall()
    leaked = brute.leaks(list(left.values()), items)
    left = {i: t for (i, t), leak in zip(left.items(), leaked) if not leak[-1]}
    kept = docs
    for _, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, kept, SMALLEST)
        assert kept.columns == columns
    kept = {r.doc_id: r for r in kept.collect()}
    assert kept.keys() == left.keys()
    for i, row in kept.items():
        assert brute.secrets(row.text)[0] == (0, 0, 0) and row.n_chars == len(row.text)
        assert row.text == left[i] or sum(brute.secrets(left[i])[0])
    rows = corpus_pipeline.run(spark, SMALLEST).collect()
    check_pieces(rows, {i: tokenizer.encode(r.text, add_special_tokens=False).ids for i, r in kept.items()})
