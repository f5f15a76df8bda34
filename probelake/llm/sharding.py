"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own (an offset and a step from hashes of
its name, so the order meets each slot once). The shards take turns, each claiming the first slot in its order
that is still free, until the table is full; a weight is the number of claims in a turn. Placing a row is one
lookup by the hash of its key in a table of fixed size, which is broadcast. Shards get nearly equal numbers of
slots, and few keys move between shards when one is added or removed.

Filling the table is one SQL aggregation over the tries, on one row; its state are the table (two bytes a slot),
the shard whose turn it is, its present place in its order, and where the others have got to.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 8191
SHARDS = 64


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def hashed(text: Column, salt: str = "") -> Column:
    """A number below 2**60 from the MD5 of a text (null: of an empty one)."""
    digest = F.md5(F.concat(F.coalesce(text.cast("string"), F.lit("")), F.lit(salt)).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def lookup_table(
    spark: SparkSession, names: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None
) -> DataFrame:
    """(slot, shard): ``slots`` rows; shards are numbered as in ``names``.

    ``slots`` has to be a prime above the number of claims in a turn (the sum of the weights, 1 each by default);
    names have to differ, and there are at most 65,535.
    """
    n = len(names)
    weights = [1] * n if weights is None else list(weights)
    if slots < 2 or any(slots % d == 0 for d in range(2, math.isqrt(slots) + 1)):
        raise ValueError(f"the number of slots has to be prime, not {slots}")
    if not 0 < n < 65_536 or len(set(names)) < n or len(weights) != n or min(weights) < 1:
        raise ValueError("shards need different names, at most 65,535, and one weight of 1 or more each")
    if sum(weights) >= slots:
        raise ValueError("a turn has to be shorter than the table")
    turns = [i for i, w in enumerate(weights) for _ in range(w)]
    # By the time of this many tries the table is full, but for a chance of e**-25.
    tries = math.ceil(slots * (math.log(slots) + 25))
    order = F.transform(
        F.array(*[F.lit(x) for x in names]),
        lambda x: F.struct(
            F.pmod(hashed(x, "/offset"), F.lit(slots)).alias("offset"),
            (F.pmod(hashed(x, "/step"), F.lit(slots - 1)) + 1).alias("step"),
        ),
    )
    empty = f"unhex(repeat('0000', {slots}))"
    fill = f"""
      aggregate(sequence(1, {tries} + cast(id as int)),
        struct({empty} as filled, 0 as free_from, 0 as turn, 0L as at, array_repeat(0L, {n}) as reached),
        (s, _) -> if(s.free_from >= {slots}, s,
          if(substring(s.filled, 2 * {_slot('s')} + 1, 2) = X'0000',
            named_struct(
              'filled', overlay(s.filled placing unhex(lpad(hex(turns[s.turn] + 1), 4, '0'))
                                from 2 * {_slot('s')} + 1 for 2),
              'free_from', s.free_from + 1,
              'turn', pmod(s.turn + 1, {len(turns)}),
              'at', if(turns[pmod(s.turn + 1, {len(turns)})] = turns[s.turn], s.at + 1,
                       s.reached[turns[pmod(s.turn + 1, {len(turns)})]]),
              'reached', concat(slice(s.reached, 1, turns[s.turn]), array(s.at + 1),
                                slice(s.reached, turns[s.turn] + 2, {n}))),
            named_struct('filled', s.filled, 'free_from', s.free_from, 'turn', s.turn, 'at', s.at + 1,
                         'reached', s.reached))),
        s -> if(s.free_from = {slots}, s.filled, cast(raise_error('the table is not full') as binary)))
    """.replace("SLOTS", str(slots))
    one = spark.range(0, 1, 1, 1).withColumns({"turns": F.array(*[F.lit(t) for t in turns]), "order": order})
    filled = one.select(F.expr(fill).alias("filled"))
    each = filled.select("filled", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    shard = F.conv(F.hex(F.expr("substring(filled, 2 * slot + 1, 2)")), 16, 10).cast("long") - 1
    return each.select(F.col("slot").cast("long"), shard.alias("shard"))


def _slot(state: str) -> str:
    """The slot that a shard tries next."""
    mine = f"order[turns[{state}.turn]]"
    return f"cast(pmod({mine}.offset + {state}.at * {mine}.step, SLOTS) as int)"


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(hashed(key), F.lit(slots))


def place(
    docs: DataFrame, names: Sequence[str], key: Column | str = "doc_id", slots: int = SLOTS, weights=None, spread: int = 1
) -> DataFrame:
    """The rows, all columns, with ``slot`` and ``shard`` behind them (after underscores if they have such names).

    Equal keys share a slot; null keys are placed like an empty text. A key that a third of the rows have can be
    dealt to ``spread`` slots by the hash of ``doc_id``. An empty table gives an empty result.
    """
    table = lookup_table(docs.sparkSession, names, slots, weights)
    key = F.col(key) if isinstance(key, str) else key
    if spread > 1:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(spread)).cast("string")
        key = F.concat_ws("/", F.coalesce(key.cast("string"), F.lit("")), part)
    slot, shard = "slot", "shard"
    while {slot, shard} & {c.lower() for c in docs.columns}:
        slot, shard = f"_{slot}", f"_{shard}"
    table = table.withColumnsRenamed({"slot": slot, "shard": shard})
    placed = docs.withColumn(slot, slot_of(key, slots))
    # The table has ``slots`` rows, whatever the number of documents.
    return placed.join(F.broadcast(table), slot).select(*docs.columns, slot, shard)


def write_shards(docs: DataFrame, names: Sequence[str], path: str, **options) -> None:
    """Write one folder per shard; large shards are written by several tasks."""
    placed = place(docs, names, **options)
    shard = placed.columns[-1]
    placed.drop(placed.columns[-2]).hint("rebalance", shard).write.mode("overwrite").partitionBy(shard).parquet(path)


#: The same for DuckDB: one claim after the other.
ORACLE = f"""
WITH RECURSIVE fill AS (
  SELECT 0 AS claim, list_transform(range({SLOTS}), lambda x: 0::SMALLINT) AS filled
  UNION ALL
  SELECT claim + 1, filled[1:slot - 1] || [(claim % {SHARDS} + 1)::SMALLINT] || filled[slot + 1:]
  FROM (
    SELECT claim, filled, preferred[list_position(list_select(filled, preferred), 0::SMALLINT)] AS slot
    FROM (
      SELECT claim, filled, list_transform(range({SLOTS}), lambda j: (first + j * step) % {SLOTS} + 1) AS preferred
      FROM (
        SELECT claim, filled,
          ('0x' || substring(md5('shard-' || claim % {SHARDS} || '/offset'), 1, 15))::BIGINT % {SLOTS} AS first,
          ('0x' || substring(md5('shard-' || claim % {SHARDS} || '/step'), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS step
        FROM fill WHERE claim < {SLOTS})))),
lookup AS (
  SELECT unnest(range({SLOTS})) AS slot, unnest(filled)::BIGINT - 1 AS shard FROM fill WHERE claim = {SLOTS}),
placed AS (
  SELECT doc_id, ('0x' || substring(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, shard FROM placed JOIN lookup USING (slot)
"""
