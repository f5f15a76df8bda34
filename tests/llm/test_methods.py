"""The operators' own parts, on small inputs."""

import base64
import gzip
import random
import zlib
from urllib.parse import quote

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from probelake.llm import decontamination, jaccard, packing, quality, secrets, sharding, toxicity, transducer
from probelake.llm.html import rendered
from probelake.llm.words import LETTERS, NOT_SPACE, Words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "the", " the", "  ", "\n", "\t ", "'s", "don't", "1234", " 99", "!!", " ?!", "é", "日本", " ü", "\xa0", "　x",
    "<|endoftext|>", "<|end", "oftext|>", "\x1c", "\x85", "😀", "٣", "֋", "zzzzzzzzzz", "aaaaaaaaaaaaaaaaaaaaa",
]


def texts(n, seed, most=30):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, most))) for _ in range(n)]


# --- tokens ----------------------------------------------------------------------


def test_counts_and_ids_are_those_of_the_library():
    library, machine = Tokenizer.from_file(TOKENIZER), transducer.transducer(TOKENIZER)
    words = packing.encoder(TOKENIZER)
    for text in [*texts(1500, 1), "x" * 5000, "ab" * 3000, " " * 3000, "日" * 2000]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert machine.tokens(text) == machine.count(text) == len(ids)
        assert np.frombuffer(b"".join(words.over(text)), "<u4").tolist() == ids


def test_chunk_maps_compose_however_a_text_is_cut():
    library, machine, rng = Tokenizer.from_file(TOKENIZER), transducer.transducer(TOKENIZER), random.Random(2)
    for text in texts(300, 3, 60):
        cuts = sorted(rng.choices(range(len(text) + 1), k=rng.randint(0, 8)))
        chunks = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        maps = [machine.chunk_map(c) for c in chunks]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert machine.total(maps) == n
        for i in range(len(maps) - 2):
            a, b, c = maps[i : i + 3]
            left = machine.compose(machine.compose(a, b), c)
            right = machine.compose(a, machine.compose(b, c))
            assert machine.total([left]) == machine.total([right])


def test_the_transducer_starts_anew_when_it_is_full(monkeypatch):
    library, machine = Tokenizer.from_file(TOKENIZER), transducer.Transducer(TOKENIZER)
    monkeypatch.setattr(transducer, "STATES", 5)
    for text in texts(50, 4):
        assert machine.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_binary_lengths():
    for n in (1, 2, 1023, 2048, 2049, 10_000):
        found = packing.lengths(n)
        assert sum(found) == n and found == sorted(found, reverse=True)
        assert all(x == 2048 or found.count(x) == 1 for x in found)


def test_buckets_hold_one_length_each(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words " * 50), (2, "more")], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs, TOKENIZER), str(tmp_path / "b"))
    rows = spark.read.parquet(str(tmp_path / "b")).collect()
    assert rows and all(r.bucket == r.length == len(r.ids) for r in rows)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


# --- secrets ---------------------------------------------------------------------

PLAIN = "password=abcdefghij1234"


def coded(data):
    return base64.b64encode(data).decode()


@pytest.mark.parametrize(
    "text, start, end",
    [
        (f"x {quote(PLAIN, safe='')} y", 2, 27),
        (f"x {quote(quote(PLAIN, safe=''), safe='')} y", 2, 29),
        (f"x {coded(PLAIN.encode())} y", 2, 34),
        (f"x {coded(gzip.compress(PLAIN.encode(), mtime=0))} y", 2, None),
        (f"x {coded(coded(zlib.compress(PLAIN.encode())).encode())} y", 2, None),
        ("x p\\u0061ssword=abcdefghij1234 y", 2, 30),
        ("x &#112;assword=abcdefghij1234 y", 2, 30),
        ("x p%5Cu0061ssword=abcdefghij1234 y", 2, 32),
    ],
)
def test_layers_are_unwrapped_and_mapped(text, start, end):
    base, found, cut = secrets.scan(text)
    end = len(text) - 2 if end is None else end
    assert any((a, b) == (start, end) for a, _, b in found) and set(base) <= set(found) and not cut
    assert secrets.redacted(text, found) == f"x {secrets.REDACTED} y"


def test_plain_texts_give_base_spans_only():
    rng = random.Random(5)
    parts = [PLAIN, "token: ", "AKIA", "ABCDEFGH1234567890", "0123456789abcdef", " ", "secret=", "%", "é", "api-key='", "K"]
    for _ in range(500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        base, found, _ = secrets.scan(text)
        assert tuple(sum(k == i for _, k, _ in base) for i in range(3)) == brute.secrets(text)[0]
        assert set(base) <= set(found)


def test_data_that_unpacks_to_itself_ends():
    assert secrets.scan(coded(b"A" * 40) * 3)[0] == []
    bomb = coded(gzip.compress(b"a" * (40 * 1024**2), mtime=0))
    assert secrets.scan(bomb)[2]


# --- sharding --------------------------------------------------------------------


def test_few_slots_move_when_a_shard_goes(spark):
    names = sharding.shard_names(10)
    table = lambda n: [r.shard for r in sharding.lookup_table(spark, n, 1009).orderBy("slot").collect()]
    before, after = table(names), table(names[:-1])
    assert max(before.count(i) for i in range(10)) - min(before.count(i) for i in range(10)) <= 1
    moved = sum(a != b for a, b in zip(before, after) if a != 9)
    assert moved < 0.25 * 1009


def test_weights_and_wrong_arguments(spark):
    table = [r.shard for r in sharding.lookup_table(spark, ["a", "b"], 101, [3, 1]).collect()]
    assert abs(table.count(0) - 3 * table.count(1)) <= 4
    for names, slots, weights in ((["a"], 100, None), (["a", "a"], 101, None), (["a"], 101, [0]), (["a"] * 0, 7, None)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, names, slots, weights)


def test_a_hot_key_can_be_spread(spark, tmp_path):
    docs = spark.range(1000).selectExpr("id AS doc_id", "'hot' AS source")
    names = sharding.shard_names(7)
    assert sharding.place(docs, names, "source").select("shard").distinct().count() == 1
    assert sharding.place(docs, names, "source", spread=50).select("shard").distinct().count() > 4
    sharding.write_shards(docs, names, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1000


# --- words, suffix arrays, R-trees -------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_words_are_those_of_the_patterns(seed, monkeypatch):
    import re

    from probelake.llm import words

    monkeypatch.setattr(words, "STEP", 64)
    all_texts = texts(60, seed) + ["A.b-C d", ""]
    for wanted, pattern in ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = Words(all_texts, wanted)
        plain = [re.findall(pattern, brute.lowered(t)) for t in all_texts]
        assert found.count.tolist() == [len(w) for w in plain]
        flat = [w for words_ in plain for w in words_]
        assert len(set(zip(flat, found.hash.tolist()))) == len(set(flat)) == len(set(found.hash.tolist()))


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(7)
    words = rng.integers(0, 4, 300)
    order = decontamination.suffix_array(words, 400)
    ends = np.append(np.flatnonzero(words == 0), 300)
    suffixes = [words[i : ends[np.searchsorted(ends, i)]].tolist() for i in order]  # a 0 ends every match
    assert sorted(order.tolist()) == np.flatnonzero(words).tolist() and suffixes == sorted(suffixes)


@pytest.mark.parametrize("seed", range(4))
def test_occurrences_against_brute_force(seed):
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choices("a b c d".split(), k=n))
    items = [(i, make(rng.randint(0, 14))) for i in range(12)] + [(99, "zz")]
    documents = [make(rng.randint(0, 60)) for _ in range(30)] + [items[0][1], ""]
    index = decontamination.Items([str(i) for i, _ in items], [t for _, t in items], 10)
    found = Words(documents, LETTERS)
    hits = decontamination.shard_hits(found, len(documents), index)
    for i, (n, n_hit, n_items, _, _) in enumerate(brute.leaks(documents, items)):
        spans, ids, longest = hits.get(i, ([], set(), 0))
        assert (found.count[i], sum(b - a for a, b in spans), len(ids)) == (n, n_hit, n_items)
        assert longest == 0 or any(longest <= len(t.split()) for _, t in items)


@pytest.mark.parametrize("n", [1, 2, 5, 17, 300])
def test_rtree_loses_no_similar_pair(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = []
    for _ in range(n):
        keep = base[rng.random(60) < 0.9]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, rng.integers(1, 12)).astype(np.uint64)])))
    at = jaccard.points([jaccard.counted(s) for s in sets])
    a, b = jaccard.tree_pairs(np.array([len(s) for s in sets]), at, 80)
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    assert len(found) == len(a)
    for i in range(n):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                assert (j, i) in found
                fine = [jaccard.counted(s, jaccard.fine_groups(len(s))) for s in (sets[i], sets[j])]
                assert jaccard.most_shared(*fine) >= shared


def test_chains_become_components(spark):
    order = list(range(200))
    random.Random(8).shuffle(order)
    links = [(min(a, b), max(a, b)) for a, b in zip(order, order[1:])] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    found = jaccard.components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in found.collect()} == {**dict.fromkeys(range(200), 0), **dict.fromkeys((1000, 1001, 1002), 1000)}


def test_tiles_and_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choices(words, k=60) for _ in range(3)]
    rows = []
    for i in range(90):
        text = list(base[i % 3])
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute.components(rows)
    for small, tile, common in ((64, 4096, 65_536), (2, 5, 65_536), (2, 5, 0)):
        monkeypatch.setattr(jaccard, "SMALL", small)
        monkeypatch.setattr(jaccard, "TILE", tile)
        monkeypatch.setattr(jaccard, "COMMON", common)
        found = jaccard.connected(docs).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


# --- quality, toxicity -------------------------------------------------------------


def test_quantiles():
    assert quality.chi_square(0.95, 5) == pytest.approx(11.07, abs=0.05)
    assert 1 < quality.consistency() < 2


def test_outliers_of_a_group_are_rejected_and_small_groups_are_judged(spark):
    rng, rows = random.Random(10), []
    for i in range(400):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(rng.randint(60, 200))]
        if i < 40:
            words = [f"#%{w}%#" for w in words]  # a tenth of the rows: a mean and a variance would follow them
        rows.append((i, " ".join(words), "en", "s" if i % 50 else f"rare{i}"))
    found = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    common = [i for i in range(400) if i % 50]
    assert not any(found[i].kept for i in common if i < 40) and all(found[i].kept for i in common if i >= 40)
    # Eight rows in groups of their own: judged by what all rows give, one of them is an outlier.
    assert [found[i].kept for i in range(0, 400, 50)] == [False] + [True] * 7
    assert all(r.distance is not None for r in found.values())


def plain_mcd(x):
    """Concentration steps on whole arrays, from the mean and from medians and quartiles, until nothing changes."""
    floors, best = np.diag(np.square(quality.FLOORS)), None
    keep = int(np.ceil(len(x) * quality.KEEP))
    quartiles = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    starts = [(x.mean(0), np.cov(x.T, bias=True) + floors), (quartiles[1], np.diag(((quartiles[2] - quartiles[0]) / 1.349) ** 2) + floors)]
    for centre, scatter in starts:
        last = None
        while True:
            off = x - centre
            inner = np.sort(np.argsort(np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off), kind="stable")[:keep])
            if last is not None and (inner == last).all():
                break
            last, chosen = inner, x[inner]
            centre, scatter = chosen.mean(0), np.cov(chosen.T, bias=True) * quality.consistency() + floors
        if best is None or np.linalg.slogdet(scatter)[1] < best[0]:
            best = np.linalg.slogdet(scatter)[1], centre, scatter
    return best


def test_estimates_are_close_to_those_of_plain_steps(spark):
    """In each group, a third of whose rows are far off; distances are cut by buckets of a few percent."""
    draw, rows, groups = np.random.default_rng(12), [], {}
    for g, n in (("a", 400), ("b", 60), ("c", 31)):
        x = draw.normal(0, 1, (n, quality.P)) @ draw.normal(0, 1, (quality.P, quality.P)) + draw.normal(0, 5, quality.P)
        x[: n // 6] += 40
        groups[g] = x
        rows += [(g, *map(float, r)) for r in x]
    found = quality.fit(spark.createDataFrame(rows, "g string, " + ", ".join(f"{c} double" for c in quality.X)))
    for r in found.collect():
        log_det, centre, scatter = plain_mcd(groups[r.g])
        mine = -np.linalg.slogdet(np.array(r.precision).reshape(quality.P, quality.P))[1]
        assert mine < log_det + 0.8
        off = groups[r.g] - np.array(r.centre)
        far = np.einsum("ij,jk,ik->i", off, np.array(r.precision).reshape(quality.P, -1), off) > quality.chi_square(1 - quality.ALPHA, quality.P)
        off = groups[r.g] - centre
        plain = np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off) > quality.chi_square(1 - quality.ALPHA, quality.P)
        n = len(far)
        assert far[: n // 6].all() and plain[: n // 6].all() and (far != plain).sum() <= max(1, n // 50)


def test_label_model_discounts_voters_that_fire_together():
    rng = np.random.default_rng(11)
    truth = rng.random(4000) < 0.2
    good = np.where(truth, rng.random(4000) < 0.7, rng.random(4000) < 0.02)
    bad = rng.random(4000) < 0.3  # three copies of a voter that knows nothing
    votes = np.stack([~(good | bad), good, bad, bad, bad], axis=1).astype(float)
    posterior = toxicity.label_model(votes, np.ones(4000), np.array([0.07, 0.9, 0.2, 0.2, 0.2]), 0.2)
    assert posterior[good & ~bad].mean() > 0.5 > posterior[bad & ~good].mean()


# --- pages -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>one <b>two</b>\n three<p>four<br>five", "one two three\n\nfour\nfive"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
        ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>", "Name       Qty\napple pie  3"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td colspan=2>wide cell<tr><td>d<td>e</table>", "a  b\n   c\nwide cell\nd  e"),
        ("<head><title>t</title><style>p{}</style></head><script>'<p>'</script>x<template>y</template>", "x"),
        ("<div hidden>a</div><p style='display: none'>b<div style='visibility:hidden'>c<b style='visibility:visible'>d</b></div>", "d"),
        ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
        ("a &amp; b &lt;c&gt; &nbsp;d < e", "a & b <c>  d < e"),
        ("<details><summary>s</summary>x</details><details open><summary>t</summary>y</details>", "s\nt\ny"),
        ("<blockquote>q<p>r</blockquote>z<hr>w", "  q\n\n  r\n\nz\n\n" + "-" * 20 + "\n\nw"),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "a\n  b\nc\n  d"),
    ],
)
def test_layout(page, text):
    assert rendered(page) == text


@pytest.mark.parametrize("page", ["<" * 50_000, "<a \"" * 20_000, "<table><td>" * 500, "<p" * 30_000, "<!--" * 20_000, "<b><p>" * 5000])
def test_broken_pages_end(page):
    assert isinstance(rendered(page), str)
