"""Trie of the prefixes of conversations, by node tables per shard of conversations.

The turns lie in shards by order of conversation and turn, so that a conversation of any size is spread over as many
shards as it needs and copies that follow each other meet in one. A shard enumerates the distinct digests of its
prefixes and gives them slots by a minimal perfect hash, each slot verified against its digest. Counts go to flat
arrays by slot and up through the array of parent slots, deepest nodes first. What leaves a shard is a row per node of
it, however many conversations go through that node; rows of a node from several shards are added up.

A conversation that goes on from an earlier shard starts there at the digest reached so far; that node is a *stub*
where nothing else in the shard goes through it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.llm.common import importable, record
from probelake.llm.words import mixed
from probelake.session import stage

#: Rows of a shard, on average.
SHARD_ROWS = 50_000
#: Turns that are taken from the first conversation of a block, at most, and conversations of a block.
MOST_SHARED = 8
BLOCK = 5
# Digests of prefixes are polynomials of the turns' digests modulo a prime, so that those of pieces can be joined.
PRIME = (1 << 127) - 1
FACTOR = 0x2545F4914F6CDD1D9E3779B97F4A7C15
ROOT = bytes(16)


def as_bytes(number: int) -> bytes:
    return number.to_bytes(16, "big")


def joined(first: int, second: int, length: int) -> int:
    """Digest of a sequence followed by one of ``length`` turns."""
    return (first * pow(FACTOR, length, PRIME) + second) % PRIME


class Slots:
    """A minimal perfect hash of distinct 128-bit keys, given as two halves, to 0 ... n-1.

    Level by level, keys that are alone in their place keep it and the others go on; the rank of the place is the
    slot. Every slot holds its key, so that a key which is not in the table is told.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, used = np.arange(len(high)), 0
        slot = np.empty(len(high), np.int64)
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("equal keys have no slots of their own")
            place = self._place(high[rest], low[rest], len(self.levels), 2 * len(rest))
            once = np.bincount(place, minlength=2 * len(rest)) == 1
            rank = used + np.cumsum(once) - 1
            self.levels.append((once, rank))
            alone = once[place]
            slot[rest[alone]] = rank[place[alone]]
            used += int(once.sum())
            rest = rest[~alone]
        self.high, self.low = np.empty(len(high), np.uint64), np.empty(len(high), np.uint64)
        self.high[slot], self.low[slot] = high, low

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(mixed(high + np.uint64(level)) ^ low) % np.uint64(size)).astype(np.int64)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 for those that have none."""
        found, rest = np.full(len(high), -1, np.int64), np.arange(len(high))
        for level, (once, rank) in enumerate(self.levels):
            place = self._place(high[rest], low[rest], level, len(once))
            here = once[place]
            at, slot = rest[here], rank[place[here]]
            same = (self.high[slot] == high[at]) & (self.low[slot] == low[at])
            found[at[same]] = slot[same]
            rest = rest[~here]
        return found


def halves(column: pa.ChunkedArray | pa.Array, null: bytes = b"\xff" * 16) -> tuple[np.ndarray, np.ndarray]:
    """16-byte digests as two numbers; no prefix has the digest that stands for null."""
    data = np.frombuffer(b"".join(v or null for v in column.to_pylist()), ">u8").astype(np.uint64)
    return data[::2].copy(), data[1::2].copy()


def upwards(depth: np.ndarray, parent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and their parents' slots, the deepest first, as far as the parents are in the table."""
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        inside = level[parent[level] >= 0]
        if len(inside):
            yield inside, parent[inside]


@dataclass(frozen=True)
class Borders:
    """What goes on from one shard to the next: a row per shard at most."""

    #: Shard to (conversation, its turns so far, their digest).
    begun: dict[int, tuple[int, int, int]] = field(default_factory=dict)
    #: Shards whose last conversation goes on, to the next shard.
    open: dict[int, int] = field(default_factory=dict)
    last: dict[int, int] = field(default_factory=dict)

    @staticmethod
    def of(laid: DataFrame) -> Borders:
        ends = laid.groupBy("part").agg(
            F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "at", "prefix")).alias("last")
        )
        found, now, before = Borders(), None, -1
        for row in sorted(ends.collect(), key=lambda r: r.part):
            length, digest = 0, 0
            if now and now[0] == row.first:
                found.begun[row.part], found.open[before] = now, row.part
                if row.last.conv_id == row.first:
                    length, digest = now[1:]
            now = row.last.conv_id, length + row.last.at, joined(digest, int.from_bytes(row.last.prefix, "big"), row.last.at)
            found.last[row.part], before = row.last.conv_id, row.part
        return found

    def carried(self, spark: SparkSession) -> DataFrame:
        rows = [(part, conv, n) for part, (conv, n, _) in self.begun.items()]
        return F.broadcast(spark.createDataFrame(rows, "part int, conv_id long, before long"))


LAID = "conv_id long, part int, at long, prefix binary, token binary, n_bytes long"


def laid_out(turns: DataFrame, order: list[str], parts: int, name: str) -> DataFrame:
    """Turns (conv_id, token, n_bytes) in ``parts`` ranges of (conv_id, *order), stored.

    ``at`` counts a conversation's turns within the range ``part``, ``prefix`` is the digest of them up to this one.
    Equal rows can lie in several ranges too.
    """
    keys = ["conv_id", *order, "__row"]
    ranged = turns.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    rows = ranged.sortWithinPartitions(*keys).select("conv_id", F.spark_partition_id().alias("part"), "token", "n_bytes")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, digest = None, 0, 0
        for batch in batches:
            places, prefixes = [], []
            for conv, token in zip(batch.column("conv_id").to_pylist(), batch.column("token").to_pylist()):
                if conv != now:
                    now, n, digest = conv, 0, 0
                n, digest = n + 1, (digest * FACTOR + int.from_bytes(token, "big")) % PRIME
                places.append(n)
                prefixes.append(as_bytes(digest))
            conv, part, token, n_bytes = batch.columns
            columns = [conv, part, pa.array(places, pa.int64()), pa.array(prefixes, pa.binary()), token, n_bytes]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "prefix", "token", "n_bytes"])

    importable(turns.sparkSession)
    return stage(rows.mapInArrow(walk, LAID), name)


def as_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, token (digest of role and text) and n_bytes (of the text); rows without conv_id are left out."""
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role, text)
    token = F.substring(F.unhex(F.sha2(told, 256)), 1, 16)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        token.alias("token"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def n_parts(turns: DataFrame, shard_rows: int) -> int:
    cores = turns.sparkSession.sparkContext.defaultParallelism
    return max(cores, math.ceil(turns.count() / shard_rows))


def n_shared(conv_id: str = "conv_id") -> Column:
    """How many turns a conversation takes from the first of its block."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % (MOST_SHARED + 1)


def rebuilt(turns: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """Conversations that share turns with the first of their block, and all conv_ids.

    Conversation c has the first h = ``n_shared`` turns of c - c % 5 (all if it has fewer, none if there is no such
    conversation) and then its own turns after the first h. Turns go by ``turn`` (null first), equal ones by token.
    """
    laid = laid_out(turns, ["turn", "token"], n_parts(turns, shard_rows), "trie-turns")
    before = Borders.of(laid).carried(turns.sparkSession)
    own = laid.join(before, ["part", "conv_id"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("place"), "token", "n_bytes"
    )
    ids = own.where("place = 1").select("conv_id")
    head = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = own.where(F.col("place") <= MOST_SHARED).withColumnRenamed("conv_id", "__head")
    taken = ids.withColumn("__n", n_shared()).join(heads, (head == F.col("__head")) & (F.col("place") <= F.col("__n")))
    kept = own.where(F.col("place") > n_shared())
    columns = ["conv_id", "place", "token", "n_bytes"]
    both = taken.select(F.lit(0).alias("own"), *columns).unionByName(kept.select(F.lit(1).alias("own"), *columns))
    return both, ids


LOCAL = (
    "part int, node binary, parent binary, depth long, token binary, n_bytes long, n long, conv_id long, "
    "stub boolean, ends string"
)
LOCAL_TYPES = [
    ("part", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("token", pa.binary()),
    ("n_bytes", pa.int64()), ("n", pa.int64()), ("conv_id", pa.int64()), ("stub", pa.bool_()), ("ends", pa.string()),
]


def _local_nodes(borders: Borders) -> Callable[[pa.Table], pa.Table]:
    """The nodes of a shard with how many of its conversations go through each, their smallest, and who ends there."""

    def nodes(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        table = table.sort_by([("conv_id", "ascending"), ("at", "ascending")])
        convs, at = (table.column(c).to_numpy() for c in ("conv_id", "at"))
        keys = [int.from_bytes(p, "big") for p in table.column("prefix").to_pylist()]
        conv, before, digest = borders.begun.get(part, (None, 0, 0))
        going_on = (convs == conv) if conv is not None else np.zeros(len(convs), bool)
        depth = at + before * going_on
        for i in np.flatnonzero(going_on):
            keys[i] = joined(digest, keys[i], int(at[i]))
        keys = [as_bytes(k) for k in keys]
        parents = [p if a > 1 else ROOT for p, a in zip([ROOT, *keys], at)]
        if going_on.any():
            parents[int(np.argmax(going_on))] = as_bytes(digest)
        # A row per distinct digest, the first: rows, then the root, then the stub.
        first: dict[bytes, int] = {}
        for i, key in enumerate(keys):
            first.setdefault(key, i)
        real = len(first)
        tops = [] if going_on.all() else [(ROOT, 0)]
        if going_on.any() and as_bytes(digest) not in first:
            tops.append((as_bytes(digest), before))
        distinct = list(first) + [k for k, _ in tops]
        rows = np.array(list(first.values()), np.int64)
        slots = Slots(*halves(pa.array(distinct, pa.binary())))
        slot = slots.find(*halves(pa.array(distinct, pa.binary())))
        of_row = slots.find(*halves(pa.array(keys, pa.binary())))
        above = np.full(len(distinct), -1, np.int64)
        above[slot[:real]] = slots.find(*halves(pa.array([parents[i] for i in rows], pa.binary())))
        depths = np.zeros(len(distinct), np.int64)
        depths[slot] = np.concatenate([depth[rows], [d for _, d in tops]])
        last = np.append(convs[1:] != convs[:-1], True)
        n = np.bincount(of_row[last], minlength=len(distinct)).astype(np.int64)
        least = np.full(len(distinct), np.iinfo(np.int64).max)
        np.minimum.at(least, of_row[last], convs[last])
        if going_on.any():  # its way down to here was counted in an earlier shard
            n[slots.find(*halves(pa.array([as_bytes(digest)], pa.binary())))] -= 1
        for below, up in upwards(depths, above):
            np.add.at(n, up, n[below])
            np.minimum.at(least, up, least[below])
        ends: dict[int, list[str]] = {}
        if part in borders.open:
            last[-1] = False
        for i in np.flatnonzero(last):
            ends.setdefault(int(of_row[i]), []).append(str(convs[i]))
        tokens, sizes = table.column("token").to_pylist(), table.column("n_bytes").to_pylist()
        blank = [None] * len(tops)
        return pa.Table.from_batches([
            record(LOCAL_TYPES, [
                [part] * len(distinct), distinct, [parents[i] for i in rows] + blank, depths[slot],
                [tokens[i] for i in rows] + blank, [sizes[i] for i in rows] + [0] * len(tops), n[slot], least[slot],
                [False] * real + [k != ROOT for k, _ in tops],
                [",".join(ends[s]) if s in ends else None for s in slot.tolist()],
            ])
        ])

    return nodes


def _turnless(ids: DataFrame, laid: DataFrame, parts: int) -> DataFrame:
    """Conversations that have no turn, as shards of their own with nothing but the root."""
    lost = ids.join(laid.select("conv_id").distinct(), "conv_id", "left_anti")
    ranged = lost.repartitionByRange(parts, "conv_id").withColumn("part", F.spark_partition_id() + parts)
    told = ranged.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.array_sort(F.collect_list("conv_id")).alias("ids")
    )
    nothing = F.lit(None).cast("binary")
    return told.select(
        "part", F.lit(ROOT).alias("node"), nothing.alias("parent"), F.lit(0).cast("long").alias("depth"),
        nothing.alias("token"), F.lit(0).cast("long").alias("n_bytes"), "n", "conv_id", F.lit(False).alias("stub"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("ends"),
    )


def _verified(local: DataFrame) -> DataFrame:
    """A row per node over all shards; one digest never stands for two sequences."""
    told = local.groupBy("node").agg(
        F.max("parent").alias("parent"),
        F.max("depth").alias("depth"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum("n").alias("n_convs"),
        F.min(F.struct("conv_id", "part")).alias("owner"),
        (
            F.coalesce(F.min("parent") != F.max("parent"), F.lit(False))
            | F.coalesce(F.min("token") != F.max("token"), F.lit(False))
            | (F.min("depth") != F.max("depth"))
        ).alias("mixed"),
    )
    checked = F.when(F.col("mixed"), F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return told.select(
        "node", "parent", "depth", "n_bytes", checked.otherwise(F.col("n_convs")).alias("n_convs"),
        F.col("owner")["conv_id"].alias("conv_id"), F.col("owner")["part"].alias("owner"),
    )


SUMS = "node binary, part int, stub boolean, saved long, leaves long, parent_conv_id long"
SUM_TYPES = [
    ("node", pa.binary()), ("part", pa.int32()), ("stub", pa.bool_()), ("saved", pa.int64()), ("leaves", pa.int64()),
    ("parent_conv_id", pa.int64()),
]


def _subtree_sums(table: pa.Table) -> pa.Table:
    """What the nodes that a shard owns add to those above them in the shard."""
    slots = Slots(*halves(table.column("node")))
    slot = slots.find(*halves(table.column("node")))
    above = np.empty(len(slot), np.int64)
    above[slot] = slots.find(*halves(table.column("parent")))
    columns = {c: table.column(c).to_numpy() for c in ("part", "depth", "owner", "n_convs", "n_bytes", "n_children", "conv_id")}
    flat = {c: np.empty(len(slot), np.int64) for c in columns}
    for c, values in columns.items():
        flat[c][slot] = values
    own = flat["owner"] == flat["part"]
    saved = np.where(own, (flat["n_convs"] - 1) * flat["n_bytes"], 0)
    leaves = (own & (flat["n_children"] == 0)).astype(np.int64)
    for below, up in upwards(flat["depth"], above):
        np.add.at(saved, up, saved[below])
        np.add.at(leaves, up, leaves[below])
    of_parent = np.where(own & (above >= 0), flat["conv_id"][above], 0)
    told = pa.array(of_parent[slot], mask=~(own & (above >= 0))[slot])
    return pa.Table.from_batches([
        record(SUM_TYPES, [
            table.column("node").to_pylist(), columns["part"].astype(np.int32), table.column("stub").to_pylist(),
            saved[slot], leaves[slot], told,
        ])
    ])


def _through_borders(spark: SparkSession, sums: DataFrame, laid: DataFrame, borders: Borders) -> DataFrame | None:
    """What reaches stubs, for all nodes above them: the earlier turns of the conversations that go on.

    Both the stubs and the sums per shard are a row per shard at most.
    """
    at_stub = {r.part: (r.saved, r.leaves) for r in sums.where("stub").collect() if r.saved or r.leaves}
    ahead: dict[int, tuple[int, int]] = {}
    for part, following in sorted(borders.open.items(), reverse=True):
        whole = borders.last[following] == borders.last[part]
        saved, leaves = at_stub.get(following, (0, 0))
        more = ahead.get(following, (0, 0)) if whole else (0, 0)
        ahead[part] = saved + more[0], leaves + more[1]
    rows = [(part, borders.last[part], *values) for part, values in ahead.items() if any(values)]
    if not rows:
        return None
    reached = F.broadcast(spark.createDataFrame(rows, "part int, conv_id long, saved long, leaves long"))
    path = laid.join(reached, ["part", "conv_id"]).select("part", "conv_id", "at", "prefix", "saved", "leaves")

    def whole_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part, conv, at, prefix in zip(*(batch.column(i).to_pylist() for i in range(4))):
                begun = borders.begun.get(part, (None, 0, 0))
                digest = begun[2] if begun[0] == conv else 0
                found.append(as_bytes(joined(digest, int.from_bytes(prefix, "big"), at)))
            yield record(SUM_TYPES, [
                found, batch.column("part"), [False] * len(found), batch.column("saved"), batch.column("leaves"),
                [None] * len(found),
            ])

    paths = path.mapInArrow(whole_digest, SUMS)
    root = spark.createDataFrame(
        [(bytearray(ROOT), part, False, *ahead[part], None) for part in ahead
         if any(ahead[part]) and not (part in borders.begun and borders.begun[part][0] == borders.last[part])],
        SUMS,
    )
    return paths.unionByName(root)


def _digests(local: DataFrame) -> DataFrame:
    """Per node, SHA-256 of the ids that end there, joined in order; read as a stream of pieces, one per shard."""
    kept = local.where("ends IS NOT NULL").select("node", "part", "ends")
    rows = kept.repartition("node").sortWithinPartitions("node", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        kinds = [("node", pa.binary()), ("ends_sha256", pa.string())]
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.encode())
            yield record(kinds, [[n for n, _ in done], [d for _, d in done]])
        if digest is not None:
            yield record(kinds, [[now], [digest.hexdigest()]])

    return rows.mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame, order: list[str], shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per distinct sequence of first turns of the conversations, the root included.

    ``turns`` has conv_id, token (16 bytes that stand for the turn) and n_bytes, and goes by ``order`` within a
    conversation; ``ids`` has all conv_ids, also of conversations without turns. Columns: node and parent (digests),
    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Without
    conversations there is no root.
    """
    spark = turns.sparkSession
    importable(spark)
    turns = stage(turns, "trie-rows")
    parts = n_parts(turns, shard_rows)
    laid = laid_out(turns, order, parts, "trie-laid")
    borders = Borders.of(laid)
    nodes_of = _local_nodes(borders)
    local = laid.groupBy("part").applyInArrow(nodes_of, LOCAL)
    # The tool or a cluster may deal out more ranges than asked for, so the numbers of the others start after all.
    local = stage(local.unionByName(_turnless(ids, laid, max([parts, *borders.last]) + 1)), "trie-local")
    merged = _verified(local)
    children = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("__of")).agg(F.count(F.lit(1)).alias("n_children"))
    joined_ = merged.join(children, F.col("node") == F.col("__of"), "left").drop("__of")
    nodes = stage(joined_.fillna(0, ["n_children"]), "trie-nodes")
    shown = nodes.select("node", "owner", "n_convs", "n_bytes", "n_children", "conv_id")
    seen = local.select("part", "node", "parent", "depth", "stub").join(shown, "node")
    sums = stage(seen.groupBy("part").applyInArrow(_subtree_sums, SUMS), "trie-sums")
    more = _through_borders(spark, sums, laid, borders)
    added = sums.where(~F.col("stub"))
    totals = (added if more is None else added.unionByName(more)).groupBy("node").agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.max("parent_conv_id").alias("parent_conv_id")
    )
    whole = nodes.join(totals, "node").join(_digests(local), "node", "left")
    return whole.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations (``rebuilt``); see ``prefix_trie`` for its columns.

    A null role or text is an empty one, rows without conv_id are left out, rows of equal turn go by the digest of role
    and text, repeated rows are turns of their own, an empty table gives no row, other columns are not read.
    """
    turns, ids = rebuilt(as_turns(conversations), shard_rows)
    return prefix_trie(turns, ids, ["own", "place"], shard_rows)
