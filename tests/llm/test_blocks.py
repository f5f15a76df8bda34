"""A benchmark in blocks: the same hits, one block at a time."""

import random

import pytest
from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast

from probelake.llm import decontamination
from probelake.llm.decontamination import find_leaks, matches, placed, without_leaks


def tables(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    items = [(i, " ".join(word() for _ in range(draw.choice((3, 15, 30))))) for i in range(40)]
    items += [(99, items[0][1]), (None, items[1][1]), (7, None), (8, ""), (9, "... !"), (3, items[3][1])]
    docs = []
    for i in range(120):
        words = [word() for _ in range(60)]
        for _ in range(i % 4):
            item = draw.choice(items[:40])[1].split()
            at = draw.randrange(50)
            words[at:at] = item[draw.randrange(3) :]
        docs.append((i, " ".join(words)))
    docs += [(200, None), (201, ""), (202, docs[3][1]), (3, docs[3][1]), (None, docs[7][1])]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def rows(found):
    return sorted(map(str, found.collect()))


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    docs, benchmark = tables(spark)
    whole = rows(find_leaks(docs, benchmark))
    live, most, made = set(), [], []
    broadcast, destroy = SparkContext.broadcast, Broadcast.destroy

    def send(self, value):
        sent = broadcast(self, value)
        if isinstance(value, decontamination.Items):
            live.add(id(sent))
            made.append(sent)
            most.append(len(live))
        return sent

    def gone(self, *a, **k):
        live.discard(id(self))
        return destroy(self, *a, **k)

    monkeypatch.setattr(SparkContext, "broadcast", send)
    monkeypatch.setattr(Broadcast, "destroy", gone)
    assert rows(find_leaks(docs, benchmark, block_chars=400)) == whole
    assert len(made) >= 10 and max(most) == 1 and not live
    assert sum("contaminated=True" in r for r in whole) > 40


@pytest.mark.parametrize("chars", [1, 100, 1000])
def test_blocks_are_bounded(spark, chars):
    _, benchmark = tables(spark)
    placed_rows, places = placed(benchmark, chars)
    sizes = [sum(len(r.text) for r in placed_rows.where(f"part = {p} AND cut = {c}").collect()) for p, c in places[:12]]
    longest = max(len(r.text or "") for r in benchmark.collect())
    assert max(sizes) <= chars + longest


def test_all_columns_come_along(spark):
    docs, benchmark = tables(spark)
    docs = docs.selectExpr("*", "1 AS leaks", "2 AS key", "'x' AS found")
    for chars in (400, 1_000_000):
        found = matches(docs, benchmark, block_chars=chars)
        assert found.columns[:-1] == docs.columns and found.count() == docs.count()
    kept = without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and {200, 201} <= {r.doc_id for r in kept.collect()}
    assert without_leaks(docs.limit(0), benchmark).isEmpty() and without_leaks(docs, benchmark.limit(0)).count() == docs.count()
