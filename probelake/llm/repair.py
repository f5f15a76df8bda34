"""Repair of the structure of conversations: the cheapest edits that make roles alternate, by a streaming Viterbi search.

The rows of a conversation are read in order, once. Four states say what the repaired conversation ends with so far:
nothing, a system turn, a user turn, an assistant turn. Each keeps its cheapest edits as a leaf of a tree of
backpointers; a node counts the nodes and states that refer to it and goes when none is left. As soon as all states
that can still win have an ancestor in common, the edits up to it are emitted, so only those behind it are held. Equal
costs are decided by the whole edits that are not yet emitted.

A conversation is read by one task, as a stream of rows in order: its checksum can't be made otherwise. What is held does
not grow with it, and no conversation is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import importable, record
from probelake.session import stage

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Costs of edits; undeleted rows without an end cost one more.
REROLE, DELETE, INSERT, UNENDED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
DROPPED, EMPTIED, UNPOINTED, REPEATED, USERED = range(5)
KINDS = 20


class Node:
    """An edit behind its predecessor; ``uses`` are the nodes and states that refer to it."""

    __slots__ = ("before", "edit", "role", "text", "uses")

    def __init__(self, before: Node | None, edit: str, role: str = "", text: str = ""):
        self.before, self.edit, self.role, self.text, self.uses = before, edit, role, text, 0
        if before is not None:
            before.uses += 1


class Search:
    """The cheapest edits of one conversation; ``add`` and ``finish`` give those that are certain, in order.

    A state has a cost, its node, and how its edits compare with those of the others: a rank, and the last few edits
    (``tail``). Of states with different ranks the lower has the lesser edits whatever follows; while the edits of one
    may still be the beginning of another's they have one rank, and their tails tell them apart. So a comparison of
    whole unresolved suffixes takes no walk along them.
    """

    def __init__(self):
        self.root = Node(None, "")
        self.states: dict[int, tuple[int, int, str, Node]] = {}
        self._take({START: (0, 0, "", self.root, "", "")})

    def held(self) -> int:
        """The longest way of edits that are not yet emitted."""
        longest = 0
        for *_, node in self.states.values():
            n = 0
            while node is not self.root:
                n, node = n + 1, node.before
            longest = max(longest, n)
        return longest

    def _take(self, best: dict[int, tuple]) -> None:
        """New states from the best (cost, rank, tail, node before, role, text) of each, and from insertions."""
        states = {}
        for state, (cost, rank, tail, node, role, text) in best.items():
            if tail:
                node = Node(node, tail[-1], role, text)
            states[state] = cost, rank, tail, node
        for *_, node in states.values():
            node.uses += 1

        def insert(sources: tuple[int, ...], target: int) -> None:
            old = now = states.get(target)
            for source in sources:
                if source in states:
                    cost, rank, tail, node = states[source]
                    found = cost + INSERT, rank, tail + "I", node
                    now = found if now is None or found[:3] < now[:3] else now
            if now is not old:
                fresh = Node(now[3], "I", ROLES[target])
                fresh.uses += 1
                if old:
                    self._release(old[3])
                states[target] = *now[:3], fresh

        insert((START, SYSTEM, ASSISTANT), USER)
        insert((USER,), ASSISTANT)
        # Whatever goes on from these goes on from an assistant turn too, a kept system turn as a deleted one.
        enough = states[ASSISTANT][0]
        for state, most in ((START, enough + DELETE), (SYSTEM, enough)):
            if state in states and states[state][0] > most:
                self._release(states.pop(state)[3])
        for *_, node in self.states.values():
            self._release(node)
        self.states = self._ranked(states)

    @staticmethod
    def _ranked(states: dict[int, tuple]) -> dict[int, tuple]:
        """New ranks wherever the edits of no state before begin those of one behind, and tails without what all share."""
        order = sorted(states, key=lambda s: states[s][1:3])
        ranked, group = {}, []
        for i, state in enumerate(order):
            group.append(state)
            behind = [states[s][2] for s in order[i + 1 :] if states[s][1] == states[state][1]]
            if not any(b.startswith(states[s][2]) for s in group for b in behind if states[s][1] == states[state][1]):
                shared = len(commonprefix([states[s][2] for s in group]))
                for s in group:
                    cost, _, tail, node = states[s]
                    ranked[s] = cost, i, tail[shared:], node
                group = []
        return ranked

    def _release(self, node: Node | None) -> None:
        while node is not None:
            node.uses -= 1
            if node.uses or node is self.root:
                return
            node = node.before

    def _certain(self) -> list[Node]:
        """What all states have in common becomes the new root."""
        leaves = {id(node) for *_, node in self.states.values()}
        if self.root.uses > 1 or id(self.root) in leaves:
            return []
        way = [next(iter(self.states.values()))[3]]
        while way[-1].before is not self.root:
            way.append(way[-1].before)
        shared = []
        for node in reversed(way):
            shared.append(node)
            if node.uses > 1 or id(node) in leaves:
                break
        self.root = shared[-1]
        self.root.before = None
        return shared

    def add(self, role: str, text: str, must_go: bool, unended: bool) -> list[Node]:
        best: dict[int, tuple] = {}

        def offer(state: int, *candidate) -> None:
            if state not in best or candidate[:3] < best[state][:3]:
                best[state] = candidate

        initial = role[:1]
        for state, (cost, rank, tail, node) in self.states.items():
            offer(state, cost + DELETE, rank, tail + "D", node, "", "")
            if must_go:
                continue
            cost += UNENDED if unended else 0
            target = ASSISTANT if state == USER else USER
            offer(target, cost + REROLE, rank, tail + "R", node, ROLES[target], text)
            if initial == ("a" if state == USER else "u"):
                offer(target, cost, rank, tail + "K", node, role, text)
            elif initial == "s" and state == START:
                offer(SYSTEM, cost, rank, tail + "K", node, role, text)
        self._take(best)
        return self._certain()

    def finish(self) -> tuple[int, list[Node]]:
        """The cost of all edits, and the rest of them."""
        cost, _, _, node = min((self.states[s] for s in (START, ASSISTANT) if s in self.states), key=lambda s: s[:3])
        way = []
        while node is not self.root:
            way.append(node)
            node = node.before
        return cost, way[::-1]


class Conversation:
    """One conversation as its rows come, and what is to be said of it."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.search = conv_id, Search()
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.least = self.most = self.turn = self.row = None
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> list[Node]:
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most, self.distinct = turn, self.distinct + 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        repeated = repeated or (turn, role, text) == self.row
        self.row = turn, role, text
        stripped = text.rstrip(SPACE)
        blank = not stripped
        duplicate = not blank and repeated
        unended = not blank and not duplicate and stripped[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += unended
        return self.search.add(role, text, blank or duplicate, unended)

    @property
    def gaps(self) -> int:
        return min((1 << 63) - 1, self.most - self.least + 1 - self.distinct) if self.distinct else 0


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a careless collection has them, by crc32 of ``conv_id:turn`` modulo 20 (see ``DROPPED`` and following).

    Nulls are one space, in that key too, but ``turn`` and ``conv_id`` stay null. A dropped row stays as a mark
    (``lost``) without role and text, so that its conversation is known.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(told[0], F.lit(":"), told[1]).cast("binary")) % KINDS
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        role.alias("role"), text.alias("text"),
    )
    lost = F.col("kind") == DROPPED
    changed = rows.select(
        "conv_id", "turn", lost.alias("lost"),
        F.when(lost, "").when(F.col("kind") == USERED, "user").otherwise(F.col("role")).alias("role"),
        F.when(lost | (F.col("kind") == EMPTIED), "")
        .when(F.col("kind") == UNPOINTED, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


def _seen_before(rows: DataFrame) -> Column:
    return F.coalesce(F.col("__first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("__first")["turn"]), F.lit(False))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) by conversation and turn (null first, equal ones by role and text).

    ``repeated`` says that role and text came at an earlier turn; a row equal to the one before it is left to the reader.
    Only the digests of texts that came at several turns are joined, so texts move once.
    """
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    marked = rows.withColumn("__digest", F.when(~F.col("lost"), F.unhex(digest)))
    order = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"))
    first = marked.where(~F.col("lost")).groupBy("conv_id", "__digest").agg(
        F.min(order).alias("__first"), F.max(order).alias("__last")
    )
    several = first.where(~F.col("__first").eqNullSafe(F.col("__last"))).select(
        F.col("conv_id").alias("__conv"), F.col("__digest").alias("__same"), "__first"
    )
    several = stage(several, "repair-repeated")
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__digest") == F.col("__same"))
    told = marked.join(several, same, "left")
    told = told.select("conv_id", "turn", "role", "text", "lost", _seen_before(told).alias("repeated"))
    # One more key keeps conversations apart whose ids are null.
    dealt = told.repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation | None, list[Node]]]:
    """Conversations with edits as they become certain; a conversation comes once more at its end, with none."""
    now: Conversation | None = None
    names = ("conv_id", "turn", "role", "text", "lost", "repeated")
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            piece = batch.slice(at, 512)
            for conv_id, turn, role, text, lost, repeated in zip(*(piece.column(n).to_pylist() for n in names)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        yield now, []
                    now = Conversation(conv_id)
                if not lost:
                    certain = now.add(turn, role, text, repeated)
                    if certain:
                        yield now, certain
    if now is not None:
        yield now, []


REPORT = [
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
    ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired_sha256", pa.string()),
]
REPORT_SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


def report(rows: DataFrame) -> DataFrame:
    """A row per conversation of ``rows`` (conv_id, turn, role, text, lost): its faults, and the cheapest repair.

    ``gaps`` are turn numbers that miss between the smallest and the largest. The first fault of a row counts: ``blank``
    (nothing but space), ``duplicate`` (role and text came before), ``truncated`` (doesn't end with . ! or ?).
    ``illegal`` counts neighbours whose roles don't begin with su, ua or au. ``audit`` has the initials of the edits in
    order (Keep, Rerole, Delete, Insert), ``cost`` their sum, and ``repaired_sha256`` is the checksum of the repaired
    ``role:text`` lines. Of equally cheap repairs it is that with the least ``audit``.

    Rows of equal turn go by role and text; rows marked ``lost`` only make their conversation known; rows without conv_id
    are one conversation, with a null id. A conversation without rows has zeros and empty texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        audit, digest, n = [], hashlib.sha256(), 0

        def emit(nodes: list[Node]) -> int:
            more = 0
            for node in nodes:
                audit.append(node.edit)
                if node.edit != "D":
                    digest.update(b"\n" * bool(n + more) + f"{node.role}:{node.text}".encode())
                    more += 1
            return more

        for conv, certain in _read(batches):
            if certain:
                n += emit(certain)
                continue
            cost, rest = conv.search.finish()
            n += emit(rest)
            faults = conv.gaps, conv.blank, conv.duplicate, conv.truncated, conv.illegal
            done.append((conv.conv_id, *faults, cost, "".join(audit), digest.hexdigest()))
            audit, digest, n = [], hashlib.sha256(), 0
            if len(done) == 1000:
                yield record(REPORT, list(zip(*done)))
                done = []
        if done:
            yield record(REPORT, list(zip(*done)))

    importable(rows.sparkSession)
    return in_order(rows).mapInArrow(run, REPORT_SCHEMA)


REPAIRED = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]


def repaired(rows: DataFrame) -> DataFrame:
    """The rows of the repaired conversations, kept, reroled or inserted, numbered by ``place`` from 0; see ``report``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for conv, certain in _read(batches):
            nodes = [x for x in certain or conv.search.finish()[1] if x.edit != "D"]
            columns = [[x.edit for x in nodes], [x.role for x in nodes], [x.text for x in nodes]]
            yield record(REPAIRED, [[conv.conv_id] * len(nodes), range(place, place + len(nodes)), *columns])
            place = place + len(nodes) if certain else 0

    importable(rows.sparkSession)
    return in_order(rows).mapInArrow(run, "conv_id long, place long, edit string, role string, text string")
