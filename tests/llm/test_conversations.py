"""The conversation operators against brute force, over random conversations, borders of shards and edge cases."""

import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import pytest

from probelake.llm.repair import Search, damaged, repaired, report
from probelake.llm.trie import Slots, as_turns, conversation_trie, prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def token(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, token(role, text), role, text))
    own = {c: [x[3:] for x in sorted(found)] for c, found in convs.items()}
    whole = {}
    for c, turns in own.items():
        h, block = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(block, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, found in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(found) - 1) * (len(node[-1][1].encode()) if node else 0)
            leaves[node[:d]] += not children[node]
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in found if len(whole[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        out.append((found[0], len(node), parent, len(found), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(spark, rows, shard_rows):
    found = conversation_trie(table(spark, rows), shard_rows)
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=str)


def conversations(seed, n=40, longest=7, texts=3):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(longest + 1)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), "x" * draw.randrange(texts) + "é"))
    return rows


@pytest.mark.parametrize("seed,shard_rows", [(0, 50_000), (1, 7), (2, 3)])
def test_trie_of_random_conversations(spark, seed, shard_rows):
    rows = conversations(seed)
    assert trie_rows(spark, rows, shard_rows) == brute_trie(rows)


def test_trie_of_a_conversation_over_many_shards(spark):
    """A third of all rows is one conversation, another one follows that is its copy, one begins alike."""
    long = [(turn, ("user", "assistant")[turn % 2], f"t{turn % 7}") for turn in range(60)]
    rows = [(10, *x) for x in long] + [(15, *x) for x in long] + [(20, *x) for x in long[:30]] + [(25, 0, "user", "t0")]
    rows += conversations(3, 10, 4)
    assert trie_rows(spark, rows, 5) == brute_trie(rows)
    own, ids = rebuilt(as_turns(table(spark, rows)), 5)
    assert own.count() >= 150 and ids.count() == len({r[0] for r in rows})


def test_trie_of_odd_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 3, None, "b"), (0, 3, "user", None), (0, -1, "", ""), (3, 1, "user", "first"),
        (3, 1, "user", "first"), (3, 1, "user", "first"), (None, 1, "user", "lost"), (None, None, None, None),
        (-3, 0, "user", "y" * 200_000), (-3, 1, "user", "é"), (7, None, None, None), (9, 1, "user", "alone"),
    ]
    assert trie_rows(spark, rows, 4) == brute_trie(rows)
    assert trie_rows(spark, [], 4) == []
    other = table(spark, rows).selectExpr("*", "1 AS depth", "2 AS node", "3 AS part", "4 AS token")
    assert conversation_trie(other, 4).count() == len(brute_trie(rows))


def test_trie_of_other_sequences(spark):
    """Any sequences of 16-byte tokens; here with an own order and without sharing."""
    rows = [(c, i, bytearray(t * 16)) for c, word in ((1, b"ab"), (2, b"ac"), (3, b"")) for i, t in enumerate(bytes([x]) for x in word)]
    turns = spark.createDataFrame(rows, "conv_id long, i long, token binary").selectExpr("*", "1L AS n_bytes")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "conv_id long")
    found = {(r.conv_id, r.depth): (r.n_convs, r.n_leaves, r.saved_tokens) for r in prefix_trie(turns, ids, ["i"], 1).collect()}
    assert found == {(1, 0): (3, 2, 1), (1, 1): (2, 2, 1), (1, 2): (1, 1, 0), (2, 2): (1, 1, 0)}


def test_slots_are_a_perfect_hash():
    import numpy as np

    draw = np.random.default_rng(1)
    high, low = (draw.integers(0, 1 << 63, 5000).astype(np.uint64) for _ in range(2))
    slots = Slots(high, low)
    assert sorted(slots.find(high, low)) == list(range(5000))
    assert set(slots.find(high, low + np.uint64(1))) == {-1}
    with pytest.raises(ValueError):
        Slots(high[[0, 0]], low[[0, 0]])


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        told = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(told.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


SPACE = " \t\n\v\f\r"


def faults_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        stripped = text.rstrip(SPACE)
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        found.append(fault)
    return found


def brute_repair(rows):
    """All ways to edit the rows, with at most two insertions in a row."""
    faults = faults_of(rows)
    best = None
    ways = [(0, "", ())]  # cost, audit, repaired
    inserts = [(2 * n, "I" * n, x) for n in range(3) for x in itertools.product((("user", ""), ("assistant", "")), repeat=n)]

    def prefix_ok(done):
        initials = "".join(r[:1] or "-" for r, _ in done)
        initials = initials.removeprefix("s")
        return all(c == "ua"[i % 2] for i, c in enumerate(initials))

    def inserted(ways):
        return [(c + k, a + x, d + more) for c, a, d in ways for k, x, more in inserts if prefix_ok(d + more)]

    for (_, role, text), fault in zip(rows, faults):
        new = []
        for c, a, d in inserted(ways):
            new.append((c + 3, a + "D", d))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                new.append((c + more, a + "K", d + ((role, text),)))
                new += [(c + 2 + more, a + "R", d + ((r, text),)) for r in ("user", "assistant")]
        ways = list({w for w in new if prefix_ok(w[2])})
        # What can't be among the best any more, with room for what any rest may cost.
        least = min(w[0] for w in ways)
        ways = [w for w in ways if w[0] <= least + 8]
    for c, a, d in inserted(ways):
        initials = "".join(r[:1] for r, _ in d).removeprefix("s")
        if (not d or (initials and len(initials) % 2 == 0)) and (best is None or (c, a) < best[:2]):
            best = c, a, d
    return best


def brute_report(rows):
    convs = {r[0]: [] for r in rows}
    for conv, *rest in hurt(rows):
        convs[conv].append(tuple(rest))
    out = []
    for conv, found in convs.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in found if t is not None}
        faults = faults_of(found)
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, done = brute_repair(found)
        text = "\n".join(f"{r}:{t}" for r, t in done)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def report_rows(spark, rows):
    return sorted((tuple(r) for r in report(damaged(table(spark, rows))).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_repair_of_random_conversations(spark, seed):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ua", "sys"]
    texts = ["a.", "b", "c!", " ", "", None, "d?\n", "e. \t", "f.g"]
    rows = [
        (conv, draw.choice([None, *range(8)]), draw.choice(roles[: draw.choice((2, 3, 8))]), draw.choice(texts))
        for conv in range(60) for _ in range(draw.randrange(1, 6))
    ]
    assert report_rows(spark, rows) == brute_report(rows)


def test_repair_of_odd_rows(spark):
    rows = [(None, 1, "user", "a."), (None, None, None, None), (1, None, "user", "x."), (1, None, "user", "x."),
            (2, -(1 << 63), "user", "a."), (2, (1 << 63) - 1, "assistant", "b."), (3, 0, "user", "y" * 300_000)]
    found = report_rows(spark, rows)
    expected = [(*r[:1], min(r[1], (1 << 63) - 1), *r[2:]) for r in brute_report(rows)]
    assert found == expected
    assert report_rows(spark, []) == []
    other = table(spark, rows).selectExpr("*", "1 AS lost", "2 AS kind", "3 AS copy", "4 AS repeated")
    assert report(damaged(other)).count() == 4


def test_repaired_rows_agree_with_the_report(spark):
    rows = [(c, t, r, x) for c in range(30) for t, (r, x) in enumerate([("user", "a."), ("user", f"b{c}."), ("system", "c"), ("assistant", "d.")])]
    hurt_rows = damaged(table(spark, rows))
    lines = defaultdict(dict)
    for r in repaired(hurt_rows).collect():
        lines[r.conv_id][r.place] = f"{r.role}:{r.text}"
    for r in report(hurt_rows).collect():
        found = lines[r.conv_id]
        assert sorted(found) == list(range(len(found))) and len(found) == sum(e != "D" for e in r.audit)
        text = "\n".join(found[i] for i in range(len(found)))
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


@pytest.mark.parametrize("kind", ["alternating", "blank", "random", "systems"])
def test_search_holds_little(kind):
    """However long a conversation is, what is not yet certain stays short."""
    draw = random.Random(5)
    search, held, said = Search(), 0, 0
    for i in range(5000):
        role = {"alternating": "ua"[i % 2], "systems": "s"}.get(kind) or draw.choice("uas")
        must_go = kind == "blank" or kind == "random" and draw.random() < 0.2
        said += len(search.add(role, "x", must_go, not must_go and draw.random() < 0.3))
        held = max(held, search.held())
    _, rest = search.finish()
    assert held < 60 and said + len(rest) >= 5000


def test_search_with_two_ways_open_to_the_end():
    """Users only: which turns become assistant's is open to the end, and every step has a tie."""
    for n, audit in ((100_000, "KR" * 50_000), (100_001, "KI" + "KR" * 50_000)):
        search, edits = Search(), []
        for _ in range(n):
            edits += search.add("user", "x", False, False)
        cost, rest = search.finish()
        assert "".join(x.edit for x in edits + rest) == audit and cost == 100_000 + 2 * (n % 2)
