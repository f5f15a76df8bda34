"""Packing by powers of two: documents are cut into pieces of binary length, and equal lengths share a bucket.

A document of n ids gives n // LONGEST pieces of the largest length and one for every bit of the rest, longest
first. Every piece is a sequence of its own, so no sequence crosses documents and none needs padding; a batch is
drawn from one bucket. Nothing is shuffled: pieces depend on their document only.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from probelake.llm.common import map_texts, record, texts
from probelake.llm.transducer import PRE_TOKEN, UNSTABLE, byte_alphabet
from probelake.llm.units import Memory

LONGEST = 2048
END = 1

PIECES = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("ids", pa.list_(pa.int32())),
]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


@lru_cache(maxsize=2)
def encoder(path: str) -> Memory:
    """Ids of words as little-endian unsigned 32-bit numbers.

    Where ids follow the order of merges, as in most files, a vocabulary is its own list of ranks, and the faster
    of two libraries encodes words; what they could see differently (special strings, characters of recent Unicode
    versions) always goes to ``tokenizers``.
    """
    encode = Tokenizer.from_file(path).encode
    plain, doubtful = ranked(path)

    def ids(unit: str) -> bytes:
        if plain is None or doubtful.search(unit):
            numbers = encode(unit, add_special_tokens=False).ids
        else:
            numbers = plain.encode_ordinary(unit)
        return array("I", numbers).tobytes()

    return Memory(ids)


def ranked(path: str) -> tuple[tiktoken.Encoding | None, re.Pattern]:
    """The vocabulary as ranks (None if its ids are not in the order of merges), and what it is not used for."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    special = [t["content"] for t in parts["added_tokens"]]
    doubtful = re.compile("|".join([UNSTABLE.pattern, *map(re.escape, special)]))
    alphabet, vocab = byte_alphabet(), parts["model"]["vocab"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in parts["model"]["merges"]]
    if [vocab.get(m.replace(" ", "")) for m in merges] != list(range(256, 256 + len(merges))):
        return None, doubtful
    ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranked", pat_str=PRE_TOKEN.pattern, mergeable_ranks=ranks, special_tokens={}), doubtful


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two, at most ``longest``, that add up to n: the longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _pieces(piece: pa.RecordBatch, path: str, longest: int, with_ids: bool):
    words = encoder(path)
    rows: list[tuple] = []
    for doc_id, text in zip(piece.column("doc_id").to_pylist(), texts(piece)):
        ids = b"".join(words.over(text)) + END.to_bytes(4, "little")
        start, total = 0, len(ids) // 4
        for length in lengths(total, longest):
            part = ids[4 * start : 4 * (start + length)]
            numbers = pa.Array.from_buffers(pa.int32(), length, [None, pa.py_buffer(part)]) if with_ids else None
            rows.append((doc_id, start, length, zlib.crc32(part), total, numbers))
            start += length
    columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in PIECES]
    if with_ids:
        values = pa.concat_arrays(columns[5]) if rows else pa.array([], pa.int32())
        ends = [0]
        for length in columns[2]:
            ends.append(ends[-1] + length)
        columns[5] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    yield record(PIECES, columns)


def pack(docs: DataFrame, path: str, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, ids.

    ``longest`` is a power of two. A null text is an empty one, whose only id is the end mark; ids of documents
    may be null or repeat; an empty table gives an empty result; other columns are not read. ``sequence_id`` is
    unique within one result. Without ``with_ids`` the last column is null.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest piece has to be a power of two, not {longest}")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    cut = map_texts(rows, lambda p: _pieces(p, path, longest, with_ids), SCHEMA)
    return cut.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.col("length").alias("bucket"),
        "ids",
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write pieces in one folder per length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
