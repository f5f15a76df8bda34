"""Nulls, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

import corpus_pipeline
import public_tokenizers
import pytest

from probelake.llm import (
    decontamination,
    html,
    jaccard,
    language,
    packing,
    quality,
    secrets,
    sharding,
    toxicity,
    transducer,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor sit amet consectetur " * 8000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, row long,"
    " node string, slot int, shard int, root int, leaks int, _leaks int, __row int, __keep int, toxic int, n_words int"
)
EXTRA = (0.5, "no", 3, "x", 1, 2, 3, 4, 5, 6, 7, 1, 9)
ROWS = [
    (None, "no id, but a text of some words", "en", None),
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (2, "", None, "a"),
    (3, " \n\t ", "en", "a"),
    (4, LONG, "en", "a"),
    (5, "x", "de", "b"),
    (5, "x", "de", "b"),
    (6, "no id, but a text of some words", None, "a"),
    (-7, "日本 � 12 <|endoftext|> ½", "ja", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, source, len(t or ""), *EXTRA) for i, t, lang, source in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (99, 0, 1), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        (1, "a text of some words"),
        (1, "a text of some words"),
        (None, "dolor sit amet consectetur lorem ipsum dolor sit amet consectetur lorem"),
        (3, None),
        (4, ""),
        (5, "..."),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(benchmark, labels):
    return {
        "sharding": lambda d: sharding.place(d, sharding.shard_names(5), slots=101),
        "quality": quality.quality_rules,
        "tokens": lambda d: transducer.token_counts(d, TOKENIZER, chunk_chars=1000),
        "secrets": secrets.find_secrets,
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "leaks": lambda d: decontamination.find_leaks(d, benchmark),
        "language": language.identify,
        "jaccard": jaccard.connected,
    }


NAMES = ["sharding", "quality", "tokens", "secrets", "toxicity", "leaks", "language", "jaccard"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(docs, benchmark, labels, name):
    found = operators(benchmark, labels)[name](docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((i is None, i or 0) for i, *_ in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, benchmark, labels, name):
    assert operators(benchmark, labels)[name](docs.limit(0)).collect() == []


def of(rows, doc_id):
    return [r for r in rows if r.doc_id == doc_id]


def test_defined_results(docs, benchmark, labels):
    run = {n: f(docs).collect() for n, f in operators(benchmark, labels).items()}
    assert {(r.n_words, r.base_failed, r.kept) for i in (1, 2, 3) for r in of(run["quality"], i)} == {(0, True, False)}
    assert {(r.n_bytes, r.n_tokens) for i in (1, 2) for r in of(run["tokens"], i)} == {(0, 0)}
    assert {(r.base_spans, r.spans) for i in (1, 2) for r in of(run["secrets"], i)} == {("", "")}
    assert {(r.lang_pred, r.score) for i in (1, 2, 3) for r in of(run["language"], i)} == {("und", 0.0)}
    assert {(r.n_shingles, r.component_id) for i in (1, 2, 3) for r in of(run["jaccard"], i)} == {(0, 1), (0, 2), (0, 3)}
    (no_id,) = of(run["jaccard"], None)
    assert no_id.component_id == 6  # the copy that has an id
    (long_leak,) = of(run["leaks"], 4)
    # The item begins with the third word.
    assert (long_leak.n_words - long_leak.n_hit, long_leak.n_items, long_leak.longest) == (2, 1, 11)
    assert [(r.n_hit, r.n_items) for i in (None, 6) for r in of(run["leaks"], i)] == [(5, 1), (5, 1)]


def test_pieces(docs):
    rows = packing.pack(docs, TOKENIZER).collect()
    assert [(r.length, r.ids) for r in of(rows, 1)] == [(1, [1])]
    assert len(of(rows, 2)) == 2 and sum(r.length for r in of(rows, 4)) == of(rows, 4)[0].doc_tokens
    assert packing.pack(docs.limit(0), TOKENIZER).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, TOKENIZER, longest=1000)


def test_pages(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (2, ""), (3, "<div>" * 20_000 + "y")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()
    assert [(r.page_id, r.text, r.n_lines) for r in found] == [
        (1, "", 0), (2, "", 0), (None, "x", 1), (2, "", 0), (3, "y", 1),
    ]


def test_stages_pass_columns_on(spark, docs, tmp_path, labels, benchmark):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.schema == docs.schema or kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    # Copies of 2, 5 and 6 go, and the long text, which repeats an item; 6 has a passage of another.
    assert ids == [(False, -7), (False, 1), (False, 2), (False, 3), (False, 5)]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.collect() == []
