"""N-gram Jaccard join by count vectors.

Documents with the same set of shingles are one node. A set's shingles are hashed into ``GROUPS`` groups, and how
many fall in each is a point. Two sets share at most the sum of the smaller coordinates, and have to share
ceil(t / (1 + t) * (size + size)) shingles for a similarity of t.

Which points have to be compared at all: ordered by how common they are, the first n - ceil(t * n) + 1 shingles of
two similar sets have one in common, so the nodes are dealt to blocks by these. Any order of all shingles is
right; the most common ones come last, so that passages which many documents share don't make large blocks. A
block over ``TILE`` nodes is cut by size and hash, and each pair of its tiles goes to a task of its own. In a task
an R-tree over the points, packed by size and widest coordinate, is joined with itself: pairs of boxes whose upper
corners don't share enough are left, and the points of the remaining leaves bounded one by one. Survivors are
bounded again by counts in more groups, about one for ``PER_GROUP`` shingles, as random sets of many shingles are
alike in few groups; then they are verified on the whole sets, made again from the texts concerned.

Blocks of more than ``SMALL`` nodes would give all pairs of a group of near copies. Their nodes are first compared
with a few random neighbours; what that leaves in different components is then searched in full, as a link
within a component changes nothing. Words, shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from probelake.llm.common import importable, map_texts, pieces, record, texts
from probelake.llm.words import NOT_SPACE, Words, mixed
from probelake.session import stage

WIDTH = 5
#: The least similarity, in percent.
PERCENT = 80
GROUPS = 128
PER_GROUP = 1
#: The order of shingles puts so many of the most common last, counted where a piece of the corpus has several.
COMMON = 65_536
SEVERAL = 4
TILE = 4096
SMALL = 8
#: Nodes in larger blocks are first compared, in rounds, with so many random neighbours in each of so many blocks.
ROUNDS = 1
DRAWS = 8
BLOCKS = 2
#: Blocks of a node that are listed with it, see ``_searched``.
LISTED = 16
LEAF = 16
FANOUT = 8
STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(found: Words, n_texts: int, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the distinct shingles, by text, then hash; a short text is one shingle."""
    powers = np.multiply.accumulate(np.full(width, STEP))
    n = len(found.hash)
    if n >= width:
        same = found.text[: n - width + 1] == found.text[width - 1 :]
        sums = sum(found.hash[i : n - width + 1 + i] * powers[i] for i in range(width))
        owners, values = found.text[: n - width + 1][same], mixed(sums[same])
    else:
        owners, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.cumsum(found.count) - found.count
    short = np.flatnonzero((found.count > 0) & (found.count < width))
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = found.count[short] > k
        whole[has] += found.hash[first[short[has]] + k] * powers[k]
    whole = mixed(whole + found.count[short].astype(np.uint64))
    owners, values = np.concatenate([owners, short]), np.concatenate([values, whole])
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(owners), bool)
    new[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    return owners[new], values[new]


def sets_of(all_texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    owners, values = shingle_sets(Words(all_texts, NOT_SPACE), len(all_texts), width)
    return np.split(values, np.cumsum(np.bincount(owners, minlength=len(all_texts)))[:-1])


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(shingles.tobytes()).digest()[:8], "little", signed=True)


def counted(shingles: np.ndarray, groups: int = GROUPS) -> bytes:
    """How many shingles fall in each group, as 32-bit numbers after a 0, or as bytes after a 1 if all fit."""
    counts = np.bincount(((shingles >> np.uint64(32)) % np.uint64(groups)).astype(np.int64), minlength=groups)
    return b"\1" + counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"\0" + counts.astype("<i4").tobytes()


def fine_groups(n: int) -> int:
    """Groups of a finer count: a power of two, so that about ``PER_GROUP`` of n shingles fall in each."""
    return max(GROUPS, 1 << (n // PER_GROUP).bit_length())


def point(vector: bytes) -> np.ndarray:
    return np.frombuffer(vector, np.uint8 if vector[0] else "<i4", offset=1)


def points(vectors: list[bytes]) -> np.ndarray:
    return np.stack([point(v).astype(np.int32) for v in vectors])


def most_shared(a: bytes, b: bytes) -> int:
    """What two sets share at most by their finer counts; the one with more groups is folded."""
    x, y = sorted((point(a), point(b)), key=len)
    y = y.reshape(-1, len(x)).sum(0, dtype=np.int64) if len(y) > len(x) else y
    return int(np.minimum(x, y).sum(dtype=np.int64))


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that two sets with this sum of sizes share if they are similar."""
    return -(-percent * sizes // (100 + percent))


# --- passes over the texts -------------------------------------------------------------------------------------

PROFILE = [
    ("doc_id", pa.int64()),
    ("row", pa.int64()),
    ("node", pa.int64()),
    ("n", pa.int64()),
    ("counts", pa.binary()),
    ("fine", pa.binary()),
    ("shingle", pa.int64()),
    ("documents", pa.int64()),
]
PROFILE_SCHEMA = "doc_id long, row long, node long, n long, counts binary, fine binary, shingle long, documents long"


def _profile(piece: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """A row per text, and a row per shingle that several texts of the piece have."""
    owners, values = shingle_sets(Words(texts(piece), NOT_SPACE), piece.num_rows, width)
    sets = np.split(values, np.cumsum(np.bincount(owners, minlength=piece.num_rows))[:-1])
    some = [len(s) > 0 for s in sets]
    mine = [
        piece.column("doc_id"),
        piece.column("row"),
        [node_of(s) if ok else None for s, ok in zip(sets, some)],
        [len(s) for s in sets],
        [counted(s) if ok else None for s, ok in zip(sets, some)],
        [counted(s, fine_groups(len(s))) if ok else None for s, ok in zip(sets, some)],
    ]
    none = [None] * piece.num_rows
    yield record(PROFILE, [*mine, none, none])
    shared, times = np.unique(values, return_counts=True)
    shared, times = shared[times >= SEVERAL], times[times >= SEVERAL]
    if len(shared):
        none = [None] * len(shared)
        yield record(PROFILE, [none, none, none, none, none, none, shared.view(np.int64), times])


def _prefixes(batches: Iterator[pa.RecordBatch], width: int, percent: int, common: np.ndarray):
    """(key, common, node, n) for the first shingles of each set, each node once a task."""
    kinds = [("key", pa.int64()), ("common", pa.bool_()), ("node", pa.int64()), ("n", pa.int64())]
    seen: set[int] = set()
    for batch in batches:
        for piece in pieces(batch):
            keys, commons, nodes, sizes = [], [], [], []
            for shingles in sets_of(texts(piece), width):
                if not len(shingles) or (node := node_of(shingles)) in seen:
                    continue
                seen.add(node)
                rank = np.searchsorted(common[0], shingles)
                rank[rank == len(common[0])] = 0
                is_common = common[0][rank] == shingles if len(common[0]) else np.zeros(len(shingles), bool)
                place = common[1][rank].astype(np.int64) if len(common[0]) else np.zeros(len(shingles), np.int64)
                order = np.argsort(np.where(is_common, place, -1), kind="stable")
                first = order[: int(prefix_size(np.int64(len(shingles)), percent))]
                keys.append(shingles[first])
                commons.append(is_common[first])
                nodes += [node] * len(first)
                sizes += [len(shingles)] * len(first)
            if keys:
                yield record(kinds, [np.concatenate(keys).view(np.int64), np.concatenate(commons), nodes, sizes])


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(node, shingles), each node once a task."""
    seen: set[int] = set()
    for batch in batches:
        for piece in pieces(batch):
            found = {node_of(s): s.tobytes() for s in sets_of(texts(piece), width)}
            new = [node for node in found if node not in seen]
            seen.update(new)
            yield record([("node", pa.int64()), ("shingles", pa.binary())], [new, [found[node] for node in new]])


# --- R-tree ------------------------------------------------------------------------------------------------------


def packed(n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """An order of the points whose stretches of ``LEAF`` make small boxes: slabs of size, then widest coordinate."""
    order = np.argsort(n, kind="stable")
    slab = LEAF * max(1, int(np.sqrt(len(n) / LEAF)))
    for low in range(0, len(n), slab):
        part = order[low : low + slab]
        widest = int(np.ptp(at[part], axis=0).argmax())
        order[low : low + slab] = part[np.argsort(at[part, widest], kind="stable")]
    return order


def boxes(span: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest size, and upper corner, of each stretch of ``size`` boxes."""
    cuts = np.arange(0, len(span), size)
    low, top = np.minimum.reduceat(span[:, 0], cuts), np.maximum.reduceat(span[:, 1], cuts)
    return np.stack([low, top], axis=1), np.maximum.reduceat(high, cuts, axis=0)


def bounded(a: np.ndarray, b: np.ndarray, span: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of boxes (or points) a, b may hold similar sets: by their sizes, then by summed minima."""
    low, top = span[:, 0], span[:, 1]
    keep = (100 * top[a] >= percent * low[b]) & (100 * top[b] >= percent * low[a])
    at = np.flatnonzero(keep)
    for start in range(0, len(at), 65_536):
        part = at[start : start + 65_536]
        share = np.minimum(high[a[part]], high[b[part]]).sum(1, dtype=np.int64)
        keep[part] = share >= needed(low[a[part]] + low[b[part]], percent)
    return keep


def tree_pairs(n: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points that may be similar, by joining their R-tree with itself from the root down."""
    order = packed(n, at)
    levels = [(np.stack([n[order]] * 2, axis=1), at[order])]
    while len(levels) == 1 or len(levels[-1][0]) > 1:
        levels.append(boxes(*levels[-1], LEAF if len(levels) == 1 else FANOUT))
    a = b = np.zeros(1, np.int64)
    for level in range(len(levels) - 2, -1, -1):
        span, high = levels[level]
        size = LEAF if level == 0 else FANOUT
        first, second = (g.ravel() for g in np.meshgrid(np.arange(size), np.arange(size), indexing="ij"))
        found = []
        for start in range(0, len(a), 4096):
            x = (a[start : start + 4096, None] * size + first).ravel()
            y = (b[start : start + 4096, None] * size + second).ravel()
            ok = ((x < y) if level == 0 else (x <= y)) & (y < len(span))
            x, y = x[ok], y[ok]
            ok = bounded(x, y, span, high, percent)
            found.append((x[ok], y[ok]))
        a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(2))
    return order[a], order[b]


def _is_first(key: int, x: set[int], y: set[int]) -> bool:
    """Whether no block before this one is listed for both nodes; so it is for the first that they are in together."""
    return min(x & y, default=key) >= key


def _pairs_of(table: pa.Table, percent: int) -> pa.RecordBatch:
    unit, node, n, part, root = (table.column(c).to_numpy() for c in ("unit", "node", "n", "part", "root"))
    at = points(table.column("counts").to_pylist())
    cuts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1], [True]]))
    pairs = []
    if "keys" in table.column_names:
        key, lists, sets = table.column("key").to_numpy(), table.column("keys"), {}

        def keys(i: int) -> set[int]:
            if i not in sets:
                sets[i] = set(lists[i].as_py())
            return sets[i]

    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        a, b = (x + low for x in tree_pairs(n[low:high], at[low:high], percent))
        # Two tiles are joined across only (a tile with itself is part 2); one root means linked already.
        ok = ((part[a] != part[b]) | (part[a] == 2)) & (root[a] != root[b])
        a, b = a[ok], b[ok]
        if "keys" in table.column_names:
            first = [_is_first(own, x, y) for own, x, y in zip(key[a].tolist(), map(keys, a.tolist()), map(keys, b.tolist()))]
            a, b = a[first], b[first]
        pairs.append((node[a], node[b]))
    a, b = (np.concatenate([p[i] for p in pairs]) for i in range(2))
    return record(PAIRS, [np.minimum(a, b), np.maximum(a, b)])


PAIRS = [("a", pa.int64()), ("b", pa.int64())]
PAIRS_SCHEMA = "a long, b long"


def _joined(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of each unit; the rows of a unit follow each other, maybe over several batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        unit = batch.column("unit").to_numpy()
        before = rest[0].column("unit")[0].as_py() if rest else unit[0]
        if unit[-1] == before:
            rest.append(batch)
            continue
        # A batch of one other unit begins where the held one ends: nothing of it goes with the held rows.
        others = np.flatnonzero(unit != unit[-1])
        last = int(others[-1]) + 1 if len(others) else 0
        yield _pairs_of(pa.Table.from_batches([*rest, *([batch.slice(0, last)] if last else [])]), percent)
        rest = [batch.slice(last)]
    if rest:
        yield _pairs_of(pa.Table.from_batches(rest), percent)


def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose sizes and finer counts allow for enough shared shingles."""
    for batch in batches:
        n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
        share = [most_shared(x, y) for x, y in zip(*(batch.column(c).to_pylist() for c in ("fine", "other_fine")))]
        ok = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (np.array(share) >= needed(n + m, percent))
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("shingles"), batch.column("other_shingles")):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


# --- the join ----------------------------------------------------------------------------------------------------


def _with_both(pairs: DataFrame, of: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The pairs with columns of ``of`` for a, and renamed for b."""
    first = of.select(F.col("node").alias("a"), *columns)
    second = of.select(F.col("node").alias("b"), *[F.col(c).alias(other) for c, other in columns.items()])
    return pairs.join(first, "a").join(second, "b").select("a", "b", *columns, *columns.values())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes that have a link.

    Large and small stars in turn: every node sends its larger neighbours, then its smaller ones, to the smallest it
    knows, until all that is left are stars around roots. The number of rounds grows with the logarithm of the
    longest chain.
    """

    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.min("v").alias("least"))

    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).withColumn("least", F.least("least", "u"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = stage(large.where("u <> v").distinct(), "links-large")
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        edges = stage(small, "links-small")
        n, ends = edges.agg(F.count("*"), F.countDistinct("u")).first()
        if n == ends and edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()


def _common(profile: DataFrame) -> np.ndarray:
    """Hashes of the most common shingles, sorted, and the place of each by how common it is."""
    counts = profile.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("documents").alias("n"))
    rows = counts.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    hashes = rows.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return np.stack([hashes, np.arange(len(hashes), 0, -1, dtype=np.uint64)])[:, order]


def _blocks(prefixes: DataFrame) -> DataFrame:
    """(key, node, n) of the keys that several nodes have; of blocks with the same nodes one is left.

    Blocks of common shingles are not bounded in size: their rows are spread and pass every test.
    """
    spread = F.when(F.col("common"), F.pmod(F.xxhash64("node"), F.lit(1 << 20))).otherwise(-1)
    key = Window.partitionBy("key", "spread")
    rows = prefixes.withColumn("spread", spread)
    rows = rows.withColumns({"least": F.min("node").over(key), "most": F.max("node").over(key)})
    rows = rows.where("common or least <> most").dropDuplicates(["key", "spread", "node"])
    hashed = F.xxhash64("node").cast("decimal(38,0)")
    rows = rows.withColumns({"size": F.count("*").over(key), "sum": F.sum(hashed).over(key)})
    alike = Window.partitionBy("size", "sum", F.when(F.col("common"), F.xxhash64("key", "node")))
    return rows.withColumn("first", F.min("key").over(alike)).where("key = first").select("key", "node", "n")


def _tiled(blocks: DataFrame, percent: int) -> DataFrame:
    """Blocks with their size, and band and salt of each node's tile in blocks of more than ``TILE`` nodes."""
    sizes = blocks.groupBy("key").agg(F.count("*").alias("total")).where("total > 1")
    rows = blocks.join(sizes, "key")
    step = float(np.log(100 / percent))
    band = F.when(F.col("total") > TILE, F.floor(F.log(F.col("n").cast("double")) / step)).otherwise(0)
    rows = rows.withColumn("band", band.cast("long"))
    large = rows.where(F.col("total") > TILE).groupBy("key", "band").agg(F.ceil(F.count("*") / TILE).alias("salts"))
    rows = rows.join(large, ["key", "band"], "left")
    salt = F.pmod(F.xxhash64("node"), F.coalesce("salts", F.lit(1)))
    return rows.withColumn("salt", salt).select("key", "total", "band", "salt", "node", "n")


def _units(rows: DataFrame) -> DataFrame:
    """The rows once for each pair of tiles to join: unit, part (2: a tile with itself), node, n, root."""
    tiles = rows.select("key", "band", "salt").distinct()
    other = tiles.select("key", F.col("band").alias("band2"), F.col("salt").alias("salt2"))
    near = (F.col("band2") == F.col("band")) & (F.col("salt2") >= F.col("salt"))
    near = near | (F.col("band2") == F.col("band") + 1)
    pairs = tiles.join(other, "key").where(near)
    pairs = pairs.withColumn("unit", F.xxhash64("key", "band", "salt", "band2", "salt2"))
    itself = (F.col("band") == F.col("band2")) & (F.col("salt") == F.col("salt2"))
    kept = ["unit", "key", "part", "node", "n", "root"]
    left = pairs.withColumn("part", F.when(itself, 2).otherwise(0)).drop("band2", "salt2")
    right = pairs.where(~itself).withColumn("part", F.lit(1)).drop("band", "salt")
    right = right.withColumnsRenamed({"band2": "band", "salt2": "salt"})
    tile = ["key", "band", "salt"]
    return rows.join(left, tile).select(kept).unionByName(rows.join(right, tile).select(kept))


def _searched(units: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points don't rule out that they are similar.

    Near copies meet in all blocks of the shingles that they share. A row comes with the first ``LISTED`` blocks of its node,
    and a pair that meets in one of them is given by none behind it; in the first block of all it is given always.
    """
    lists = units.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LISTED).alias("keys"))
    rows = units.join(nodes.select("node", "counts"), "node").join(lists, "node")
    rows = rows.repartition("unit").sortWithinPartitions("unit")
    return rows.mapInArrow(lambda batches: _joined(batches, percent), PAIRS_SCHEMA).distinct()


def _drawn(rows: DataFrame, draw: int, percent: int) -> DataFrame:
    """Pairs of a few random neighbours for each node, of different roots and like sizes, however many blocks it is in."""
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("key", F.lit(draw))))
    some = rows.withColumn("rank", rank).where(F.col("rank") <= BLOCKS)
    first = draw * DRAWS
    dealt = some.withColumn("draw", F.explode(F.sequence(F.lit(first + 1), F.lit(first + DRAWS))))
    tile = Window.partitionBy("key", "band", "salt", "draw").orderBy(F.xxhash64("node", "draw"))
    near = dealt.withColumns({f"other_{c}": F.lag(c).over(tile) for c in ("node", "root", "n")}).withColumnRenamed("other_node", "other")
    alike = 100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n")
    near = near.where((F.col("root") != F.col("other_root")) & alike)
    return near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _bounded_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    both = _with_both(pairs, nodes, {"n": "m", "fine": "other_fine"})
    return stage(both.mapInArrow(lambda batches: _bounded(batches, percent), PAIRS_SCHEMA), "jaccard-pairs")


def _connected(profile: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, root) of all nodes that are similar to another one."""
    common = rows.sparkSession.sparkContext.broadcast(_common(profile))
    schema = "key long, common boolean, node long, n long"
    texts_only = rows.select("text")
    prefixes = texts_only.mapInArrow(lambda batches: _prefixes(batches, width, percent, common.value), schema)
    # Staged before its tiles are made, which read it several times.
    blocks = stage(_blocks(prefixes), "jaccard-prefixes")
    blocks = stage(_tiled(blocks, percent), "jaccard-blocks")
    nodes = profile.where(F.col("node").isNotNull()).groupBy("node")
    nodes = stage(nodes.agg(F.min(F.struct("row", "n", "counts", "fine")).alias("of")).select("node", "of.*"), "jaccard-nodes")

    small = blocks.where(F.col("total") <= SMALL)
    units = small.select(F.col("key").alias("unit"), "key", F.lit(2).alias("part"), "node", "n", F.col("node").alias("root"))
    large = blocks.where(F.col("total") > SMALL)

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        """The candidates that are similar, by the sets of the texts that they concern."""
        involved = candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = involved.join(nodes, "node").select(F.col("row").alias("wanted"))
        # Rows with the same id and text may be chosen several times; the sets, not the texts, move to be told apart.
        chosen = rows.join(wanted, F.col("row") == F.col("wanted"), "left_semi").select("text")
        sets = chosen.mapInArrow(lambda batches: _sets(batches, width), "node long, shingles binary")
        sets = sets.dropDuplicates(["node"])
        both = _with_both(candidates, stage(sets, f"{name}-sets"), {"shingles": "other_shingles"})
        return stage(both.mapInArrow(lambda batches: _verified(batches, percent), PAIRS_SCHEMA), f"{name}-links")

    def apart(roots: DataFrame) -> DataFrame:
        """Rows with their roots of the larger blocks that have several."""
        rows = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
        return stage(rows.join(several.select("key"), "key"), "jaccard-apart")

    left = large.withColumn("root", F.col("node"))
    pairs = _drawn(left, 0, percent).unionByName(_searched(units, nodes, percent)).distinct()
    compared = pairs = _bounded_pairs(pairs, nodes, percent)
    links = verified(pairs, "jaccard")
    for draw in range(1, ROUNDS):
        left = apart(components(links))
        pairs = _drawn(left, draw, percent).join(compared, ["a", "b"], "left_anti")
        pairs = _bounded_pairs(pairs, nodes, percent)
        compared = compared.unionByName(pairs)
        links = links.unionByName(verified(pairs, "jaccard-more"))
    roots = components(links)
    more = _searched(_units(apart(roots)), nodes, percent).join(compared, ["a", "b"], "left_anti")
    more = _bounded_pairs(more, nodes, percent)
    if more.isEmpty():
        return roots
    return components(links.unionByName(verified(more, "jaccard-more")))


def connected(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, row (a hash of id and text), n_shingles, component_id.

    A document's set are its distinct shingles of ``width`` words; with fewer words, the whole sequence is one. Null
    texts and texts without words have an empty set, which is linked with nothing: their component is their own id.
    Null ids count in no component's smallest id unless there is no other; repeated rows are one node and a row
    each; an empty table gives an empty result; other columns are not read.
    """
    importable(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("row"), "text")
    profile = stage(map_texts(rows, lambda p: _profile(p, width), PROFILE_SCHEMA), "jaccard-profile")
    roots = _connected(profile, rows, width, percent)
    mine = profile.where(F.col("row").isNotNull()).select("doc_id", "row", "node", F.col("n").alias("n_shingles"))
    mine = mine.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = mine.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    mine = mine.join(least, "root", "left")
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return mine.select("doc_id", "row", "n_shingles", own.alias("component_id"), "root")


def without_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, with one document of each group of linked ones: that with the smallest id.

    Documents with an empty set are in no group and stay; of rows that are equal in id and text one stays.
    """
    found = connected(docs, width, percent)
    of, row = "__row", "__keep"
    while {of, row} & {c.lower() for c in docs.columns}:
        of, row = f"_{of}", f"_{row}"
    grouped = F.coalesce(F.col("root"), F.col("row"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = found.groupBy(grouped).agg(F.min_by("row", order).alias(row)).select(row).distinct()
    doc_id = F.col("doc_id").cast("long")
    rows = docs.withColumn(of, F.xxhash64(doc_id, "text")).join(kept, F.col(of) == F.col(row), "left_semi")
    first = F.row_number().over(Window.partitionBy(of).orderBy(F.lit(0)))
    return rows.withColumn(row, first).where(F.col(row) == 1).drop(of, row)
