"""Token counts by finite-state transducers.

A byte-level BPE vocabulary is compiled, as far as the texts need it, into a deterministic transducer over the
bytes of a pre-token. Its state is the longest suffix read that a token may still begin with, and for each
position in it where one may the last token up to there (or one that lets the same tokens follow) and the number
of tokens relative to now. Reading a byte gives the one token
that can end here: a suffix that is a token and that the merges leave as it is beside the token before it. The
transition is annotated with how many tokens more (or fewer) the text so far has.

A text cut anywhere is counted through chunk maps. A boundary before white space ends a token whatever stands
before, so a chunk's map sends what is still open on entry to what is open on exit: text up to the first
boundary (completed by what came before), the count between first and last boundary, and the open rest. Maps
compose associatively; the maps of a long text are made in parallel and composed pairwise.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from probelake.llm.common import importable, map_texts, record, texts
from probelake.llm.units import LONGEST, REMEMBERED, SPACE, Memory

#: The pattern of the byte-level pre-tokenizer.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: From here on Unicode versions may differ in what is a letter; the library itself cuts such text.
UNSTABLE = re.compile("[԰-\U0010ffff]")
BOUNDARY = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
CHUNK_CHARS = 65_536
LIMIT = 1024
STATES = 60_000
PAIRS = 1_000_000
#: Tokens before a position count as the same if they let the same tokens begin there, compared up to so many.
FEW = 40
DEAD = -1

#: Whole chunk without a boundary: (text,). Otherwise: (head, tokens between, tail).
Map = tuple


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """The compiled vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(map(alphabet.__getitem__, token))
        vocab = {t: i for t, i in parts["model"]["vocab"].items() if all(c in alphabet for c in t)}
        self.ids = {as_bytes(t): i for t, i in vocab.items()}
        self.spelled = {i: t for t, i in vocab.items()}
        whole = Tokenizer.from_file(path)
        self.merge, self.cut = whole.model.tokenize, whole.pre_tokenizer.pre_tokenize_str
        self.longer: dict[bytes, list[int]] = {}
        for token, i in self.ids.items():
            for k in range(1, len(token)):
                self.longer.setdefault(token[:k], []).append(i)
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.cut_special = re.compile("|".join(map(re.escape, self.special)) or "(?!)")
        self._pairs: dict = {}
        self._classes: dict = {}
        self._first: dict = {}
        self.reset()
        self.known: dict[str, int] = {}
        self.words = Memory(self.count)

    def reset(self) -> None:
        self.states = [(b"", ((None, 0),))]
        self.numbers = {self.states[0]: 0}
        self.edges: list[dict[int, tuple[int, int]]] = [{}]

    def follows(self, left: int | None, right: int) -> bool:
        """Whether ``right`` can stand after ``left`` (None: first) in what the merges give."""
        known = self._pairs.get((left, right))
        if known is None:
            wanted = [right] if left is None else [left, right]
            known = [t.id for t in self.merge("".join(map(self.spelled.__getitem__, wanted)))] == wanted
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            self._pairs[left, right] = known
        return known

    def stands_for(self, last: int | None, begun: bytes) -> int | None:
        """A token after which the same tokens can end that begin with ``begun``; DEAD if none can."""
        known = self._classes.get((last, begun))
        if known is None:
            longer = self.longer.get(begun, ())
            if len(longer) > FEW:
                known = (last,)
            else:
                can = (begun, *(t for t in longer if self.follows(last, t)))
                known = (self._first.setdefault(can, last) if len(can) > 1 else DEAD,)
            if len(self._classes) >= PAIRS:
                self._classes.clear()
            self._classes[last, begun] = known
        return known[0]

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: next state and tokens emitted."""
        read, marks = self.states[state]
        longer = read + bytes((byte,))
        for at, mark in enumerate(marks):
            token = self.ids.get(longer[at:]) if mark else None
            if token is not None and self.follows(mark[0], token):
                emitted = mark[1] + 1
                break
        live = [m and (self.stands_for(m[0], longer[i:]), m[1] - emitted) for i, m in enumerate(marks)]
        live = [m if m and m[0] != DEAD else None for m in live]
        kept = next((i for i, m in enumerate(live) if m), len(longer))
        new = (longer[kept:], (*live[kept:], (token, 0)))
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.states)
            self.states.append(new)
            self.edges.append({})
        self.edges[state][byte] = (number, emitted)
        return number, emitted

    def run(self, pre_token: bytes) -> int:
        if len(self.states) >= STATES:
            self.reset()
        state = tokens = 0
        for byte in pre_token:
            edge = self.edges[state].get(byte)
            state, emitted = edge if edge else self.compile(state, byte)
            tokens += emitted
        return tokens

    def pre_tokens(self, text: str) -> list[str]:
        if not UNSTABLE.search(text):
            return PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.cut(text)]

    def count(self, text: str) -> int:
        """Tokens of a text."""
        parts = self.cut_special.split(text)
        total = len(parts) - 1
        for part in parts:
            for pre_token in self.pre_tokens(part):
                tokens = self.known.get(pre_token)
                if tokens is None:
                    tokens = self.run(pre_token.encode())
                    if len(pre_token) <= LONGEST:
                        if len(self.known) >= REMEMBERED:
                            self.known.clear()
                        self.known[pre_token] = tokens
                total += tokens
        return total

    def tokens(self, text: str) -> int:
        """Tokens of a text, through the counts of words met before."""
        return sum(self.words.over(text))

    def chunk_map(self, chunk: str) -> Map:
        cuts = BOUNDARY.search(chunk)
        if not cuts:
            return (chunk,)
        first, last = cuts.start(), max(m.start() for m in BOUNDARY.finditer(chunk))
        return chunk[:first], self.tokens(chunk[first:last]), chunk[last:]

    def compose(self, a: Map, b: Map) -> Map:
        """The map of two chunks that follow each other."""
        if len(a) == 1:
            return (a[0] + b[0],) if len(b) == 1 else (a[0] + b[0], b[1], b[2])
        if len(b) == 1:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.tokens(a[2] + b[0]) + b[1], b[2]

    def total(self, maps: list[Map]) -> int:
        """Tokens of the text whose chunks have these maps, composed pairwise."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(pairs) * 2 :]
        whole = maps[0] if maps else ("",)
        return self.tokens(whole[0]) if len(whole) == 1 else self.tokens(whole[0]) + whole[1] + self.tokens(whole[2])


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


COUNTED = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]
MAPPED = [
    ("key", pa.int64()),
    ("doc_id", pa.int64()),
    ("at", pa.int64()),
    ("n_bytes", pa.int64()),
    ("head", pa.string()),
    ("tokens", pa.int64()),
    ("tail", pa.string()),
]


def _counted(piece: pa.RecordBatch, path: str):
    machine, all_texts = transducer(path), texts(piece)
    yield record(
        COUNTED,
        [
            piece.column("doc_id").cast(pa.int64()),
            [len(t.encode()) for t in all_texts],
            [machine.tokens(t) for t in all_texts],
        ],
    )


def _cut(piece: pa.RecordBatch, size: int):
    for key, doc_id, text in zip(*(piece.column(c).to_pylist() for c in ("key", "doc_id", "text"))):
        for at in range(0, len(text), size):
            yield pa.RecordBatch.from_pylist(
                [{"key": key, "doc_id": doc_id, "at": at, "text": text[at : at + size]}],
                pa.schema([*[(n, pa.int64()) for n in ("key", "doc_id", "at")], ("text", pa.string())]),
            )


def _maps(piece: pa.RecordBatch, path: str):
    machine, chunks = transducer(path), texts(piece)
    maps = [machine.chunk_map(c) for c in chunks]
    ids = [piece.column(c) for c in ("key", "doc_id", "at")]
    sizes = [len(c.encode()) for c in chunks]
    parts = [[m[0] for m in maps], *([m[i] if len(m) > 1 else None for m in maps] for i in (1, 2))]
    yield record(MAPPED, [*ids, sizes, *parts])


def _composed(batches, path: str):
    machine = transducer(path)
    for batch in batches:
        ids, sizes, chains = (batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "chain"))
        maps = [
            [(m["head"],) if m["tokens"] is None else (m["head"], m["tokens"], m["tail"]) for m in chain]
            for chain in chains
        ]
        yield record(COUNTED, [ids, sizes, [machine.total(m) for m in maps]])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``path`` names the tokenizer file on the workers. A null text counts as empty (0 tokens); ids may be null or
    repeat, each row is counted; an empty table gives an empty result; other columns are not read. Texts of over
    ``chunk_chars`` code points are cut and their chunks counted by different tasks.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n_bytes long, n_tokens long"
    short = map_texts(rows.where(F.length("text") <= chunk_chars), lambda p: _counted(p, path), schema)
    long_texts = rows.where(F.length("text") > chunk_chars).withColumn("key", F.monotonically_increasing_id())
    chunks = map_texts(long_texts, lambda p: _cut(p, chunk_chars), "key long, doc_id long, at long, text string")
    maps = map_texts(
        chunks.repartition("key", "at"),
        lambda p: _maps(p, path),
        "key long, doc_id long, at long, n_bytes long, head string, tokens long, tail string",
    )
    chains = maps.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("at", "head", "tokens", "tail"))).alias("chain"),
    )
    long_counts = chains.mapInArrow(lambda batches: _composed(batches, path), schema)
    return short.unionByName(long_counts).withColumn("over_limit", F.col("n_tokens") > limit)
