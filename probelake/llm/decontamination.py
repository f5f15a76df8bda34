"""Benchmark decontamination by suffix arrays over the documents.

A shard (some megabytes of whole documents) gets a suffix array of its words. Words that no benchmark item has
end every match, so only the stretches between them that are long enough to hold a window are sorted. Every
suffix of every item is looked up by binary search, which gives its longest verbatim match, and for those that
match a whole window the range of all its places. Words are compared by 64-bit hashes and lengths.

The items are taken in blocks of ``BLOCK_CHARS`` and an item at most. Each block is sent to the workers and all
documents are searched for it, one block after the other, so neither table has to fit anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probelake.llm.common import map_texts, record, texts
from probelake.llm.words import LETTERS, Words
from probelake.session import stage

WINDOW = 10
BLOCK_CHARS = 8_000_000


class Items:
    """The suffixes of a block of benchmark items.

    ``words`` holds all items with 0 after each; words are numbered from 1 by their place in ``vocabulary``.
    ``window`` is the length of the window that begins at a place (0: none does), ``item`` its item.
    """

    def __init__(self, ids: list[str], item_texts: list[str], window: int):
        found = Words(item_texts, LETTERS)
        self.ids = ids
        self.vocabulary, first = np.unique(found.hash, return_index=True)
        self.lengths = found.length[first]
        numbers = np.searchsorted(self.vocabulary, found.hash) + 1
        places = np.arange(len(numbers)) + found.text
        self.words = np.zeros(len(numbers) + len(ids), np.int64)
        self.words[places] = numbers
        self.item = np.zeros(len(self.words), np.int64)
        self.item[places] = found.text
        self.window = np.zeros(len(self.words), np.int64)
        sizes = np.minimum(found.count, window)
        begin = np.cumsum(found.count) - found.count
        left = (begin + found.count)[found.text] - np.arange(len(numbers))
        self.window[places] = np.where(left >= sizes[found.text], sizes[found.text], 0)
        self.suffixes = np.flatnonzero(self.words)
        self.shortest = int(sizes[sizes > 0].min()) if (sizes > 0).any() else 0
        self.longest = int(found.count.max()) if len(found.count) else 0


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """The places of all words but 0, ordered by the next ``depth`` words or more, by prefix doubling."""
    rank, size = words.astype(np.int64), 1
    while size < depth:
        later = np.zeros_like(rank)
        later[:-size] = rank[size:]
        keys = rank * (int(rank.max()) + 1) + later
        values, new = np.unique(keys, return_inverse=True)
        rank = new + 1
        rank[words == 0] = 0
        size *= 2
        if len(values) == len(words):
            break
    places = np.flatnonzero(words)
    return places[np.argsort(rank[places], kind="stable")]


def common(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How many words a[at:] and b[bt:] share from their beginning, up to ``limit`` and not beyond a 0."""
    shared, left = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(left):
        d = shared[left]
        x, y = at[left] + d, bt[left] + d
        same = (d < limit[left]) & (x < len(a)) & (y < len(b))
        x, y, left = x[same], y[same], left[same]
        equal = (a[x] == b[y]) & (a[x] != 0)
        left = left[equal]
        shared[left] += 1
    return shared


def search(
    words: np.ndarray, order: np.ndarray, items: Items, at: np.ndarray, limit: np.ndarray, after: bool
) -> np.ndarray:
    """Binary search: how many suffixes are smaller than the items' words at ``at`` (``after``: or begin with them)."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        place, want = order[middle], at[open_]
        shared = common(words, place, items.words, want, limit[open_])
        whole = shared == limit[open_]
        x, y = place + shared, want + shared
        smaller = np.where(whole, after, False)
        differ = ~whole
        smaller[differ] = words[x[differ]] < items.words[y[differ]]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
    return low


Hits = tuple[list[tuple[int, int]], set[str], int]


def shard_hits(found: Words, n_texts: int, items: Items) -> dict[int, Hits]:
    """Of the texts with occurrences of windows: hit word spans, items, longest verbatim match in words."""
    if not items.shortest or not len(found.hash):
        return {}
    number = np.searchsorted(items.vocabulary, found.hash)
    number[number == len(items.vocabulary)] = 0
    known = (items.vocabulary[number] == found.hash) & (items.lengths[number] == found.length)
    # Stretches of known words within one text.
    joins = known[1:] & known[:-1] & (found.text[1:] == found.text[:-1])
    begins = np.flatnonzero(known & np.concatenate([[True], ~joins]))
    stops = np.flatnonzero(known & np.concatenate([~joins, [True]])) + 1
    enough = stops - begins >= items.shortest
    begins, sizes = begins[enough], (stops - begins)[enough]
    if not len(begins):
        return {}
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    origin = np.repeat(begins, sizes) + inside
    places = np.arange(len(origin)) + np.repeat(np.arange(len(sizes)), sizes)
    words = np.zeros(len(origin) + len(sizes), np.int64)
    words[places] = number[origin] + 1
    source = np.zeros(len(words), np.int64)
    source[places] = origin

    order = suffix_array(words, items.longest)
    at = items.suffixes
    whole = np.full(len(at), items.longest + 1)
    near = search(words, order, items, at, whole, False)
    best = np.zeros(len(at), np.int64)
    for side in (near - 1, near):
        ok = (side >= 0) & (side < len(order))
        best[ok] = np.maximum(best[ok], common(words, order[side[ok]], items.words, at[ok], whole[ok]))
    window = items.window[at]
    hit = (window > 0) & (best >= window)
    at, window = at[hit], window[hit]
    if not len(at):
        return {}
    low = search(words, order, items, at, window, False)
    high = search(words, order, items, at, window, True)
    counts = high - low
    which = np.repeat(np.arange(len(at)), counts)
    step = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = order[low[which] + step]
    position, item = source[place], items.item[at[which]]
    text = found.text[position]
    length = common(words, place, items.words, at[which], np.full(len(which), items.longest))

    out: dict[int, Hits] = {}
    first = np.cumsum(found.count) - found.count
    starts = position - first[text]
    by_text = np.lexsort((starts, text))
    pairs = np.unique(np.stack([text, item]), axis=1)
    for t, a, b, size in zip(*(x[by_text].tolist() for x in (text, starts, starts + window[which], length))):
        spans, _, longest = out.get(t, ([], set(), 0))
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
        out[t] = (spans, set(), max(longest, size))
    for t, i in pairs.T.tolist():
        out[t][1].add(items.ids[i])
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def placed(benchmark: DataFrame, block_chars: int) -> tuple[DataFrame, list]:
    """The distinct items with the block they are in, and the blocks.

    Items are dealt by hash and cut by running sums of their lengths, so a block has ``block_chars`` characters and one item
    more at most.
    """
    rows = benchmark.where(F.length("text") > 0).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text"
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, math.ceil(chars / block_chars))))
    rows = rows.distinct().withColumn("part", part)
    before = F.sum(F.length("text")).over(Window.partitionBy("part").orderBy("id", "text")) - F.length("text")
    rows = stage(rows.withColumn("cut", F.floor(before / block_chars)), "leaks-items")
    return rows, sorted(tuple(r) for r in rows.select("part", "cut").distinct().collect())


def block(rows: DataFrame, place: tuple[int, int] | None, window: int) -> Items:
    """The suffixes of one block's items; of none, without a place."""
    found = rows.where((F.col("part") == place[0]) & (F.col("cut") == place[1])).collect() if place else []
    return Items([r.id for r in found], [r.text for r in found], window)


LEAKS = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>,longest:int>"
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _prefixed(names: list[str]) -> str:
    """A column name that starts unlike all others."""
    return "_" * (1 + max((len(n) - len(n.lstrip("_")) for n in names), default=0))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with a struct column ``<underscores>leaks`` behind their own columns.

    It holds n_words, spans (word positions inside occurrences of windows, merged), items (their ids as text,
    sorted, a null id as an empty text) and longest (words of the longest verbatim match that has a window).

    A benchmark of several blocks is searched one block after the other: only one is on the driver and broadcast at a
    time, and what it finds, by the digest of the text, is stored before the next.
    """
    rows, places = placed(benchmark, block_chars)
    spark, leaks = docs.sparkSession, f"{_prefixed(docs.columns)}leaks"
    if len(places) < 2:
        sent = spark.sparkContext.broadcast(block(rows, places[0] if places else None, window))
        return _with_leaks(docs.withColumn(leaks, F.lit(None).cast(FOUND)), leaks, lambda found, n: shard_hits(found, n, sent.value))
    hits: DataFrame | None = None
    digests = docs.where("text IS NOT NULL").select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), "text")
    for place in places:
        sent = spark.sparkContext.broadcast(block(rows, place, window))

        def work(piece: pa.RecordBatch, sent=sent):
            found = shard_hits(Words(texts(piece), LETTERS), piece.num_rows, sent.value)
            keys = piece.column("key").to_pylist()
            told = {keys[i]: {"spans": _spans(s), "items": sorted(ids), "longest": n} for i, (s, ids, n) in found.items()}
            yield record([("key", pa.binary()), ("found", FOUND_TYPE)], [list(told), list(told.values())])

        some = stage(map_texts(digests, work, f"key binary, found {FOUND}"), "leaks-block")
        sent.destroy()
        hits = some if hits is None else hits.unionByName(some)
    of = F.col("found")
    hits = hits.groupBy(F.col("key").alias("__key")).agg(
        F.struct(
            F.flatten(F.collect_set(of["spans"])).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set(of["items"]))).alias("items"),
            F.max(of["longest"]).alias("longest"),
        ).alias(leaks)
    )
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return _with_leaks(docs.join(hits, key == F.col("__key"), "left").drop("__key"), leaks, lambda found, n: {})


FOUND = "struct<spans:array<struct<start:int,end:int>>,items:array<string>,longest:int>"
FOUND_TYPE = pa.struct([("spans", pa.list_(SPAN)), ("items", pa.list_(pa.string())), ("longest", pa.int32())])


def _spans(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in spans]


def _with_leaks(docs: DataFrame, leaks: str, search: Callable[[Words, int], dict[int, Hits]]) -> DataFrame:
    """Documents whose last column holds what was found before, with what ``search`` finds, and their words counted."""
    names = docs.columns[:-1]
    kind = pa.struct([("n_words", pa.int64()), *FOUND_TYPE])

    def work(piece: pa.RecordBatch):
        found = Words(texts(piece), LETTERS)
        hits = search(found, piece.num_rows)
        rows = []
        for i, before in enumerate(piece.column(leaks).to_pylist()):
            spans, ids, longest = hits.get(i, ([], set(), 0))
            if before:
                spans = merged([(s["start"], s["end"]) for s in before["spans"]])
                ids, longest = set(before["items"]), before["longest"]
            rows.append({"n_words": int(found.count[i]), "spans": _spans(spans), "items": sorted(ids), "longest": longest})
        yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), pa.array(rows, kind)], names=[*names, leaks])

    schema = docs.drop(leaks).withColumn(leaks, F.lit(None).cast(LEAKS)).schema
    return map_texts(docs, work, schema)


def digest(found: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest."""
    leaks = F.col(found.columns[-1])
    hit = F.aggregate(leaks["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(leaks["items"], ",").cast("binary")
    return found.select(
        F.col("doc_id").cast("long"),
        leaks["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(leaks["items"]).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size(leaks["spans"]) > 0).alias("contaminated"),
        leaks["longest"].alias("longest"),
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``digest`` of ``matches``.

    Null and empty texts have no words; items without words have no window; equal items count once; documents
    with null or equal ids are searched each; empty tables give no rows or no hits; other columns are not read.
    """
    return digest(matches(docs.select("doc_id", "text"), benchmark, window, block_chars))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, in which no window of a benchmark item occurs.

    Null and empty texts have none and stay, as all do with an empty benchmark; repeated rows go or stay together; an empty
    table gives an empty one.
    """
    found = matches(docs, benchmark)
    leaks = found.columns[-1]
    return found.where(F.size(F.col(leaks)["spans"]) == 0).drop(leaks)
