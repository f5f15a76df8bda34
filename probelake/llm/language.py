"""Language identification: words first, then shorter and shorter pieces of unseen words.

Words are counted per language over all documents to learn from, and the n-grams of the counted words up to
``ORDER`` characters; all of both are kept, as tables. A known word adds its log frequency in each language; an unseen one
the log frequencies of the longest known n-grams that begin at its characters. The score of a text is a sum over its
words, so no text has to move: the most common words, as many as a bound on the broadcast allows, are added up where the
text is read. Of the others a text is left with numbers; the words that a chunk of texts has numbered, and the n-grams of
those that are not in the table, are looked up by joins and meet the numbers of that chunk again.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import held_out, importable, pieces, record, texts
from probelake.session import stage

ORDER = 5
#: Characters of a chunk of texts, one text at least; a text counts for so many more.
CHUNK = 32_000_000
EACH = 100
#: Entries (word, language) that are broadcast at most, of words up to so many characters.
ENTRIES = 1_000_000
LONGEST = 64
#: Counts that a task holds before it sends them on, and characters of a word whose n-grams are made at a time.
HELD = 500_000
PIECE = 50_000
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")


def words_of(token: str) -> list[str]:
    """The words (runs of letters) in a piece of text without spaces, in lower case."""
    return WORD.findall(token.lower())


def grams_of(word: str, sizes: range = range(1, ORDER + 1)) -> Iterator[str]:
    """All n-grams of a word and the space around it."""
    padded, end = f" {word} ", len(word) + 2
    return (padded[at : at + size] for size in sizes for at in range(end - size + 1))


# --- learning ----------------------------------------------------------------------------------------------------

COUNTED = [("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]


def _counts(counts: dict[str, Counter], names: list) -> Iterator[pa.RecordBatch]:
    for lang, values in counts.items():
        yield record(names, [[lang] * len(values), list(values), list(values.values())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def words() -> Iterator[pa.RecordBatch]:
        for lang, tokens in counts.items():
            found: Counter = Counter()
            for token, n in tokens.items():
                for word in words_of(token):
                    found[word] += n
            yield from _counts({lang: found}, COUNTED)
        counts.clear()

    for batch in batches:
        for piece in pieces(batch):
            for lang, text in zip(piece.column("learned").to_pylist(), texts(piece)):
                counts.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, counts.values())) > HELD:
                yield from words()
    yield from words()


def _pieces_of(word: str) -> Iterator[str]:
    """A word and the space around it in pieces that share what an n-gram may need."""
    padded = f" {word} "
    for at in range(0, max(1, len(padded) - ORDER + 1), PIECE):
        yield padded[at : at + PIECE + ORDER - 1]


def _grams(word: str) -> Iterator[Iterator[str]]:
    """All n-grams of a word, each place once, in bounded groups."""
    padded_length, at = len(word) + 2, 0
    for piece in _pieces_of(word):
        last = at + len(piece) >= padded_length
        starts = len(piece) if last else PIECE
        yield (piece[i : i + size] for size in range(1, ORDER + 1) for i in range(min(starts, len(piece) - size + 1)))
        at += PIECE


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
            found = counts.setdefault(lang, Counter())
            for some in _grams(word):
                for gram in some:
                    found[gram] += n
                if sum(map(len, counts.values())) > HELD:
                    yield from _counts(counts, names)
                    counts.clear()
                    found = counts.setdefault(lang, Counter())
    yield from _counts(counts, names)


class Model(NamedTuple):
    """What was learned: languages, (language, size) sums, and the words (size 0) and n-grams with their counts.

    ``words`` and ``grams`` have a row for each gram: gram, size, langs, counts.
    """

    langs: list[str]
    sums: np.ndarray
    words: DataFrame
    grams: DataFrame


def _by_gram(counted: DataFrame, size) -> DataFrame:
    of = F.array_sort(F.collect_list(F.struct("lang", "n")))
    rows = counted.groupBy("gram").agg(of.alias("of"))
    return rows.select("gram", size.cast("int").alias("size"), F.col("of.lang").alias("langs"), F.col("of.n").alias("counts"))


def train(docs: DataFrame) -> Model:
    """Learn from the documents that have a language and are not held out."""
    importable(docs.sparkSession)
    learned = docs.select("text", F.when(~held_out(), F.col("lang")).alias("learned")).where("learned IS NOT NULL")
    counted = learned.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word")
    counted = stage(counted.agg(F.sum("n").alias("n")), "language-words")
    grams = counted.mapInArrow(_count_grams, "lang string, gram string, n long")
    grams = stage(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    totals = [(r.lang, 0, r.n) for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()]
    sized = grams.groupBy("lang", F.length("gram").alias("size")).agg(F.sum("n").alias("n"))
    totals += [(r.lang, r["size"], r.n) for r in sized.collect()]
    langs = sorted({lang for lang, _, _ in totals})
    number = {lang: i for i, lang in enumerate(langs)}
    sums = np.zeros((ORDER + 1, len(langs)))
    for lang, size, n in totals:
        sums[size, number[lang]] = n
    words = stage(_by_gram(counted.withColumnRenamed("word", "gram"), F.lit(0)), "language-model")
    return Model(langs, sums, words, _by_gram(grams, F.length("gram")))


class Entries:
    """Rows of the model as arrays: of row i, ``lang[at[i]:at[i + 1]]`` have the log counts ``more[...]``."""

    def __init__(self, langs: list[str], rows: pa.Table):
        lengths = pc.list_value_length(rows.column("langs")).to_numpy()
        self.at = np.append(0, np.cumsum(lengths, dtype=np.int64))
        names = pc.list_flatten(rows.column("langs"))
        self.lang = pc.index_in(names, value_set=pa.array(langs, names.type)).to_numpy().astype(np.int64)
        # A language without the entry counts a half; what others have beyond that is kept entry by entry.
        self.more = np.log(pc.list_flatten(rows.column("counts")).to_numpy() * 2.0 + 1.0)

    def added(self, rows: np.ndarray, times: np.ndarray, text: np.ndarray, n_texts: int, n_langs: int) -> np.ndarray:
        """The log counts of rows, each so many times, summed by text and language."""
        lengths = self.at[rows + 1] - self.at[rows]
        to = np.cumsum(lengths)
        flat = np.arange(to[-1] if len(to) else 0) + np.repeat(self.at[rows + 1] - to, lengths)
        place = np.repeat(text, lengths) * n_langs + self.lang[flat]
        sums = np.bincount(place, self.more[flat] * np.repeat(times, lengths), n_texts * n_langs)
        return sums.reshape(n_texts, n_langs).astype(float)


# --- scoring -----------------------------------------------------------------------------------------------------

DEALT = [
    ("chunk", pa.int64()),
    ("place", pa.int64()),
    ("word", pa.string()),
    ("doc_id", pa.int64()),
    ("held_out", pa.bool_()),
    ("letters", pa.bool_()),
    ("tokens", pa.int64()),
    ("n_common", pa.int64()),
    ("sums", pa.list_(pa.float64())),
    ("places", pa.binary()),
    ("times", pa.binary()),
]
DEALT_SCHEMA = (
    "chunk long, place long, word string, doc_id long, held_out boolean, letters boolean, tokens long, n_common long, "
    "sums array<double>, places binary, times binary"
)


def compact(values: np.ndarray) -> bytes:
    """Numbers of two or of four bytes, whichever they need, after a byte that tells which."""
    small = not len(values) or values.max() < 1 << 16
    return (b"\2" if small else b"\4") + values.astype("<u2" if small else "<u4").tobytes()


def expanded(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype(np.int64)


class Common:
    """The most common words, within ``ENTRIES``, and what they add."""

    def __init__(self, langs: list[str], rows: pa.Table):
        self.n_langs = len(langs)
        self.entries = Entries(langs, rows)
        self.numbers = {w: i for i, w in enumerate(rows.column("gram").to_pylist())}


def common_words(model: Model) -> Common:
    most = ENTRIES // max(1, len(model.langs))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    rows = model.words.where(F.length("gram") <= LONGEST).withColumn("total", total)
    rows = rows.orderBy(F.desc("total"), "gram").limit(most).select("gram", "langs", "counts")
    return Common(model.langs, rows.toArrow())


class Tokens:
    """Numbers for the tokens of a chunk, and the words of each token: common ones, and others by their place."""

    def __init__(self, common: dict[str, int]):
        self.known, self.places, self.numbers = common, {}, {}
        self.common, self.rare = (array("q"), array("q", [0])), (array("q"), array("q", [0]))

    def number(self, token: str) -> int:
        for word in words_of(token):
            at = self.known.get(word)
            if at is None:
                self.rare[0].append(self.places.setdefault(word, len(self.places)))
            else:
                self.common[0].append(at)
        for values, ends in (self.common, self.rare):
            ends.append(len(values))
        return self.numbers.setdefault(token, len(self.numbers))

    def numbered(self, tokens: list[str]) -> list[int]:
        found = list(map(self.numbers.get, tokens))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    number = self.numbers.get(tokens[i])
                    found[i] = self.number(tokens[i]) if number is None else number
        return found

    def expanded(self, kind: tuple[array, array], tokens: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words of tokens, each with its text."""
        values, at = (np.array(x, np.int64) for x in kind)
        many = at[tokens + 1] - at[tokens]
        to = np.cumsum(many)
        flat = np.arange(to[-1] if len(to) else 0) + np.repeat(at[tokens + 1] - to, many)
        return values[flat], np.repeat(text, many)


def _deal(batches: Iterator[pa.RecordBatch], common: Common) -> Iterator[pa.RecordBatch]:
    """What is left to score of each text, by chunk, and the words that a chunk has numbered for it."""
    chunk, chars, tokens = TaskContext.get().partitionId() << 32, 0, Tokens(common.numbers)

    def words() -> pa.RecordBatch:
        n = len(tokens.places)
        return record(DEALT, [[chunk] * n, range(n), list(tokens.places), *[pa.nulls(n, kind) for _, kind in DEALT[3:]]])

    for batch in batches:
        for piece in pieces(batch):
            values, n = texts(piece), piece.num_rows
            told = [any(map(str.isalpha, text)) for text in values]
            flat, n_tokens = [], []
            for text in values:
                split = text.split()
                n_tokens.append(len(split))
                flat += tokens.numbered(split)
                chars += len(text) + EACH
            flat, text_of = np.array(flat, np.int64), np.repeat(np.arange(n), n_tokens)
            rows, where = tokens.expanded(tokens.common, flat, text_of)
            sums = common.entries.added(rows, np.ones(len(rows)), where, n, common.n_langs)
            n_common = np.bincount(where, minlength=n)
            places, where = tokens.expanded(tokens.rare, flat, text_of)
            both, times = np.unique(where << 32 | places, return_counts=True)
            cuts = np.searchsorted(both >> 32, np.arange(n + 1))
            left = [(both[x:y] & 0xFFFFFFFF, times[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * common.n_langs, sums.ravel())
            none = [pa.nulls(n, kind) for _, kind in DEALT[1:3]]
            yield record(DEALT, [
                [chunk] * n, *none, piece.column("doc_id"), piece.column("held_out"), told, n_tokens, n_common, lists,
                [compact(p) for p, _ in left], [compact(t) for _, t in left],
            ])
            if chars >= CHUNK:
                yield words()
                chunk, chars, tokens = chunk + 1, 0, Tokens(common.numbers)
    yield words()


def dealt(docs: DataFrame, common: Common) -> DataFrame:
    """What is left to score of the texts (``doc_id`` and following) and the words it refers to (``word``), staged."""
    sent = docs.sparkSession.sparkContext.broadcast(common)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return stage(rows.mapInArrow(lambda batches: _deal(batches, sent.value), DEALT_SCHEMA), "language-dealt")


def _wanted_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("chunk", pa.int64()), ("gram", pa.string())]
    wanted: set[tuple[int, str]] = set()
    for batch in batches:
        for chunk, word in zip(*(batch.column(c).to_pylist() for c in ("chunk", "gram"))):
            for some in _grams(word):
                wanted.update((chunk, gram) for gram in some)
                if len(wanted) > HELD:
                    yield record(kinds, list(zip(*wanted)))
                    wanted.clear()
    if wanted:
        yield record(kinds, list(zip(*wanted)))


FOUND = ["chunk", "place", "gram", "size", "langs", "counts"]


def looked_up(chunks: DataFrame, model: Model) -> DataFrame:
    """``FOUND``: the model's rows for the words of the chunks; those of unknown words have no size, and the n-grams that
    are in the model have no place."""
    wanted = chunks.where("word IS NOT NULL").select("chunk", "place", F.col("word").alias("gram"))
    found = stage(wanted.join(model.words, "gram", "left").select(FOUND), "language-known")
    unseen = found.where("size IS NULL").select("chunk", "gram")
    grams = unseen.mapInArrow(_wanted_grams, "chunk long, gram string").distinct().join(model.grams, "gram")
    known = F.when(F.col("size").isNull(), F.col("gram")).alias("gram")  # a known word is told by its place
    grams = grams.withColumn("place", F.lit(None).cast("long"))
    return found.select("chunk", "place", known, *FOUND[3:]).unionByName(grams.select(FOUND))


def backed_off(word: str, grams: list[dict[str, int]]) -> list[int]:
    """The rows of the longest known n-grams that begin at each character of a word and the space around it."""
    padded, found = f" {word} ", []
    longest_first = list(enumerate(grams))[:0:-1]
    for at in range(len(padded) - 1):
        for size, rows in longest_first:
            row = rows.get(padded[at : at + size])
            if row is not None:
                found.append(row)
                break
    return found


def scored(model_langs: list[str], sums: np.ndarray) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Function that predicts the languages of a chunk's texts from what was found for it."""
    n_langs = len(model_langs)
    least = np.log(0.5 / (sums + 1.0))

    def work(texts_: pa.Table, found: pa.Table) -> pa.Table:
        n = texts_.num_rows
        entries = Entries(model_langs, found.set_column(4, "langs", _filled(found.column("langs"))).set_column(5, "counts", _filled(found.column("counts"))))
        sizes = np.array([-1 if s is None else s for s in found.column("size").to_pylist()], np.int64)
        place = found.column("place").to_pylist()
        words = found.column("gram").to_pylist()
        grams: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
        for i in np.flatnonzero(sizes > 0).tolist():
            grams[sizes[i]][words[i]] = i
        rows_of: dict[int, list[int]] = {}
        for i in np.flatnonzero(sizes <= 0).tolist():
            rows_of[place[i]] = [i] if sizes[i] == 0 else backed_off(words[i], grams)
        lengths = np.array([len(rows_of[p]) for p in range(len(rows_of))], np.int64)
        flat = np.array([r for p in range(len(rows_of)) for r in rows_of[p]], np.int64)
        ends = np.cumsum(lengths)
        total = np.array(texts_.column("sums").to_pylist(), float).reshape(n, n_langs)
        by_size = np.zeros((n, ORDER + 1))
        by_size[:, 0] = texts_.column("n_common").to_numpy()
        for i, (places, times) in enumerate(zip(texts_.column("places").to_pylist(), texts_.column("times").to_pylist())):
            at, weight = expanded(places), expanded(times)
            if not len(at):
                continue
            many = lengths[at]
            to = np.cumsum(many)
            rows = flat[np.arange(to[-1]) + np.repeat(ends[at] - to, many)]
            weight = np.repeat(weight, many)
            total[i] += entries.added(rows, weight, np.zeros(len(rows), np.int64), 1, n_langs)[0]
            by_size[i] += np.bincount(sizes[rows], weight, ORDER + 1)
        total += by_size @ least
        told, tokens = texts_.column("letters").to_pylist(), texts_.column("tokens").to_numpy()
        names, shares = [], []
        for i in range(n):
            if not n_langs or not told[i]:
                names.append(UNKNOWN)
                shares.append(0.0)
                continue
            best = int(total[i].argmax())
            names.append(model_langs[best])
            shares.append(float(1 / np.exp((total[i] - total[i, best]) / math.sqrt(tokens[i])).sum()))
        kept = [texts_.column(c).combine_chunks() for c in ("doc_id", "held_out")]
        return pa.Table.from_batches([record(PREDICTED, [*kept, names, shares])])

    return work


def _filled(lists: pa.ChunkedArray) -> pa.ChunkedArray:
    """Empty lists for nulls."""
    return pc.fill_null(lists, pa.scalar([], lists.type))


PREDICTED = [
    ("doc_id", pa.int64()),
    ("held_out", pa.bool_()),
    ("lang_pred", pa.string()),
    ("score", pa.float64()),
]


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (share of the prediction, 0 to 1).

    The model is learned from the documents that have a language and are not held out. Texts that are null or have
    no letter are ``und`` with the score 0, and so is everything if there is nothing to learn from; equal scores go
    to the language that sorts first; rows with null (not held out) or equal ids are scored each; other columns are
    not read.
    """
    model = train(docs)
    chunks = dealt(docs, common_words(model))
    rows = chunks.where("word IS NULL").drop("place", "word").groupBy("chunk")
    found = looked_up(chunks, model).groupBy("chunk")
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return rows.cogroup(found).applyInArrow(scored(model.langs, model.sums), schema)
