"""Near-duplicate vectors by a dual walk over cover trees.

Unit vectors with cosine c are at distance sqrt(2 - 2c), so the threshold is a
distance. A block of vectors has a cover tree: levels of centres with halving
radii, each vector within the radius of its centre, each centre its own centre one
level down. Two trees are walked together, from the top level down: a pair of
nodes is left when the distance of the centres less both covering radii (the
farthest vector below a node, not the level's radius) is over the threshold.
Cosines are taken only for the vectors of pairs left at the last level.

Blocks are cut from cells around sampled centres, the top of the tree. Blocks are
compared by the same bound, and a cell with many vectors is parted into blocks by
a hash, so a vector that is very common costs more tasks, not a larger one.

Each vector is shuffled once, into its block, and written once, with its tree. Trees
meet in rounds: some blocks, as many as fit a fixed size, are broadcast, and
all blocks that they may link with are read past them. So the bytes on disk follow the
input, though the pairs of blocks grow with its square where no bound holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.arrow import map_batches, ship
from lodestrata.llm.components import components
from lodestrata.llm.tables import numbered, stored
from lodestrata.session import work_dir

THRESHOLD = 0.95
RADII = (1.0, 0.5, 0.25, 0.125)
# Vectors of a block, and centres of cells at most (the sample they are drawn from is as large).
BLOCK, MOST_CELLS = 2048, 512
# Bytes of the vectors, as doubles, that are broadcast at once, and blocks of a written file.
BROADCAST, FILE_BLOCKS = 1 << 25, 4
# Coordinates that are looked at first, at least.
HEAD = 24
# Against rounding, only where pairs are left out.
_SLACK = 1e-6
_LINKS = "row long, n long, other long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def usable(rows: DataFrame) -> DataFrame:
    """(row, vector) of the vectors that have a direction: finite numbers only, not all zero, as doubles."""
    vector = F.col("vector").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("vector").isNotNull()).select("row", vector.alias("vector")).filter(
        fine & F.exists("vector", lambda x: x != 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cover(x: np.ndarray) -> np.ndarray:
    """For each vector its centre on each level. Centres are vectors; a centre is its own centre below."""
    n = len(x)
    chain, parent = np.empty((n, len(RADII)), np.int32), np.zeros(n, np.int64)
    gram = x @ x.T
    for level, radius in enumerate(RADII):
        centre = np.arange(n)
        # A parent centre comes first among its vectors, then the others in turn.
        order = np.lexsort((centre != parent, parent))
        bounds = np.flatnonzero(np.diff(parent[order], prepend=-1, append=-1))
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low > 1:
                some = order[low:high]
                near, open_ = gram[np.ix_(some, some)] >= 1 - radius * radius / 2, np.ones(high - low, bool)
                # Those that are near no other one are centres anyhow.
                for k in np.flatnonzero(near.sum(1) > 1).tolist():
                    if open_[k]:
                        centre[some[near[k] & open_]] = some[k]
                        open_ &= ~near[k]
                        centre[some[k]], open_[k] = some[k], False
        chain[:, level] = parent = centre
    return chain


class Tree:
    """The nodes of each level of a block: centre, covering radius and members."""

    def __init__(self, x: np.ndarray, chain: np.ndarray) -> None:
        self.x, self.levels = x, []
        for level in range(chain.shape[1]):
            centres, node = np.unique(chain[:, level], return_inverse=True)
            away = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", x, x[chain[:, level]])))
            radius = np.zeros(len(centres))
            np.maximum.at(radius, node, away)
            self.levels.append((centres, radius, node))
        # Trees are met by many others, and what those ask for is kept.
        self._rough: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        self._below: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def below(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of the next level, or vectors below the last, sorted by their node on this one, and where each one's start."""
        if level not in self._below:
            centres, _, node = self.levels[level]
            parent = node[self.levels[level + 1][0]] if level + 1 < len(self.levels) else node
            order = np.argsort(parent, kind="stable")
            self._below[level] = order, np.searchsorted(parent[order], np.arange(len(centres) + 1))
        return self._below[level]

    def rough(self, level: int, reach: float) -> tuple[np.ndarray, np.ndarray, float]:
        """Rows whose products, of a left one with a right one, are an upper bound of cosine + (radii + reach)^2 / 2.

        Some coordinates stand for themselves, the others for their norm; the square is a sum of three products.
        """
        if level not in self._rough:
            centres, radius, _ = self.levels[level]
            x = self.x[centres]
            head = x[:, : max(HEAD, x.shape[1] // 8)]
            tail = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", head, head)))
            one, wide = np.ones(len(x)), radius + reach
            left = np.column_stack((head, tail, radius * radius / 2, radius, one))
            right = np.column_stack((head, tail, one, wide, wide * wide / 2))
            # Eight at a time are looked at; rows of zeros make the number up.
            right = np.pad(right, ((0, -len(x) % 8), (0, 0)))
            self._rough[level] = left.astype(np.float32), right.astype(np.float32), float(radius.max())
        return self._rough[level]


def _pairs(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray):
    """All pairs of a child of a[k] and a child of b[k]."""
    n, m = np.diff(one[1])[a], np.diff(two[1])[b]
    size = n * m
    k = np.repeat(np.arange(len(a)), size)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return one[0][one[1][a[k]] + at // m[k]], two[0][two[1][b[k]] + at % m[k]]


def _at_once(x: np.ndarray) -> int:
    """Pairs whose vectors are gathered at once."""
    return max(256, (1 << 21) // x.shape[1])


def _slices(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Stretches of ``sizes`` whose sums are ``most`` at most, or that are one entry."""
    ends, low = np.cumsum(sizes), 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, most + (ends[low - 1] if low else 0), side="right")))
        yield slice(low, high)
        low = high


def _within(one: Tree, two: Tree, level: int, reach: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether nodes a[k] and b[k] may hold vectors within ``reach``."""
    (ca, ra, _), (cb, rb, _) = one.levels[level], two.levels[level]
    kept, step = np.zeros(len(a), bool), _at_once(one.x)
    for at in range(0, len(a), step):
        pa_, pb_ = a[at : at + step], b[at : at + step]
        square = 2 - 2 * np.einsum("ij,ij->i", one.x[ca[pa_]], two.x[cb[pb_]])
        kept[at : at + step] = square <= (ra[pa_] + rb[pb_] + reach) ** 2 + _SLACK
    return kept


def _screen(one: Tree, two: Tree, level: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of a level that may hold vectors within ``reach``, of all pairs."""
    (ca, ra, _), (cb, rb, _) = one.levels[level], two.levels[level]
    (left, _, most_a), (_, right, most_b) = one.rough(level, reach), two.rough(level, reach)
    # The bound is summed in single precision: the terms' sum and number say how far off that may be.
    terms = 1 + (most_a + most_b + reach) ** 2 / 2
    least = 1 - _SLACK - 4 * terms * left.shape[1] * float(np.finfo(np.float32).eps)
    found_a, found_b = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for at in range(0, len(ca), 256):
        over = left[at : at + 256] @ right.T >= np.float32(least)
        eights = np.flatnonzero(over.view(np.uint64))
        if 64 * len(eights) > over.size:
            square = 2 - 2 * (one.x[ca[at : at + 256]] @ two.x[cb].T)
            a, b = np.nonzero(square <= (ra[at : at + 256, None] + rb[None, :] + reach) ** 2 + _SLACK)
            a += at
        else:
            which, inside = np.nonzero(over.reshape(-1, 8)[eights])
            hits = eights[which] * 8 + inside
            hits = hits[hits % len(right) < len(cb)]
            a, b = hits // len(right) + at, hits % len(right)
            kept = _within(one, two, level, reach, a, b)
            a, b = a[kept], b[kept]
        found_a.append(a.astype(np.int32))
        found_b.append(b.astype(np.int32))
    return np.concatenate(found_a), np.concatenate(found_b)


def walk(one: Tree, two: Tree, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of last-level nodes that may hold vectors within ``reach``."""
    # Levels that branch little are passed over: their bounds are wide, and all pairs of the nodes below cost less than finding some.
    nodes = [len(x[0]) * len(y[0]) for x, y in zip(one.levels, two.levels)]
    top = max(k for k in range(len(nodes)) if nodes[k] <= 4 * nodes[0])
    a, b = _screen(one, two, top, reach)
    for level in range(top, len(RADII) - 1):
        if not len(a):
            break
        below = one.below(level), two.below(level)
        size = np.diff(below[0][1])[a] * np.diff(below[1][1])[b]
        # Where many children are left, all of them are screened at once.
        if 64 * size.sum() > len(below[0][0]) * len(below[1][0]):
            a, b = _screen(one, two, level + 1, reach)
            continue
        parts_a, parts_b = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for some in _slices(size, 1 << 18):
            na, nb = _pairs(*below, a[some], b[some])
            kept = _within(one, two, level + 1, reach, na, nb)
            parts_a.append(na[kept].astype(np.int32))
            parts_b.append(nb[kept].astype(np.int32))
        a, b = np.concatenate(parts_a), np.concatenate(parts_b)
    return a, b


def linked(one: Tree, two: Tree, same: bool, threshold: float,
           join: Callable[[np.ndarray, np.ndarray], None]) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector of ``one`` and of ``two``; ``join`` gets linked pairs, enough to connect all that are linked.

    With ``same`` both are one block, and each vector's links are in either result.
    """
    a, b = walk(one, two, _reach(threshold))
    links = np.zeros(len(one.x), np.int64), np.zeros(len(two.x), np.int64)
    if not len(a):
        return links
    first, second = one.below(len(RADII) - 1), two.below(len(RADII) - 1)
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    size = np.diff(first[1])[a] * np.diff(second[1])[b]
    starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
    ends = np.append(starts[1:], len(a))
    few = np.add.reduceat(size, starts) <= 512
    small = np.repeat(few, ends - starts)
    a_few, b_few = a[small], b[small]
    for some in _slices(size[small], _at_once(one.x)):
        i, j = _pairs(first, second, a_few[some], b_few[some])
        near = np.einsum("ij,ij->i", one.x[i], two.x[j]) >= threshold
        if same:
            near &= i != j
        i, j = i[near], j[near]
        links[0][:] += np.bincount(i, minlength=len(one.x))
        links[1][:] += np.bincount(j, minlength=len(two.x))
        join(i, j)
    for low, high in zip(starts[~few].tolist(), ends[~few].tolist()):
        rows = first[0][first[1][a[low]] : first[1][a[low] + 1]]
        columns = np.concatenate([second[0][second[1][k] : second[1][k + 1]] for k in b[low:high]])
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            near = one.x[some] @ two.x[columns].T >= threshold
            if same:
                near &= some[:, None] != columns[None, :]
            links[0][some] += near.sum(1)
            links[1][columns] += near.sum(0)
            if near.all():
                join(some, np.full(len(some), columns[0]))
                join(np.full(len(columns), some[0]), columns)
            else:
                i, j = np.nonzero(near)
                join(some[i], columns[j])
    return links


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Makes the labels of linked vectors equal: the least label of each group wins, until none changes."""
    while True:
        li, lj = label[i], label[j]
        if not (li != lj).any():
            return
        least = np.minimum(li, lj)
        target = np.arange(len(label))
        np.minimum.at(target, li, least)
        np.minimum.at(target, lj, least)
        while (target[target] != target).any():
            target = target[target]
        label[:] = target[label]


class Met:
    """What a task knows of the blocks that it was sent, and of the block that goes past them.

    Each has a number of links for each vector, and a label: equal labels are connected. A label is the position of a
    vector that was sent, or -1 of a vector going past without a link.
    """

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.rows, self.n, self.label = (np.zeros(0, np.int64) for _ in range(3))
        self.pass_by(np.zeros(0, np.int64))

    def sent(self, rows: np.ndarray) -> int:
        """Position of the first vector of another block."""
        at = len(self.rows)
        self.rows = np.concatenate((self.rows, rows))
        self.n = np.concatenate((self.n, np.zeros(len(rows), np.int64)))
        self.label = np.concatenate((self.label, np.arange(at, len(self.rows))))
        return at

    def pass_by(self, rows: np.ndarray) -> None:
        self.past, self.past_n, self.past_label = rows, np.zeros(len(rows), np.int64), np.full(len(rows), -1)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def meet(self, one: Tree, two: Tree, at: int, same: bool) -> None:
        """``one`` goes past ``two``, whose first vector has position ``at``."""
        def join(i: np.ndarray, j: np.ndarray) -> None:
            # Vectors that go past are -1, -2 and so on.
            self.waiting.append((at + i if same else -1 - i, at + j))
            self.held += len(i)
            if self.held > 1 << 18:
                self.settle()

        n_one, n_two = linked(one, two, same, self.threshold, join)
        self.n[at : at + len(n_two)] += n_two
        if not same:
            self.past_n += n_one

    def settle(self) -> None:
        if not self.held:
            return
        i, j = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.held = [], 0
        sent, own = len(self.label), np.arange(len(self.past))
        label = np.concatenate((self.label, np.where(self.past_label < 0, sent + own, self.past_label)))
        _join(label, np.where(i < 0, sent - 1 - i, i), j)
        self.label = label[:sent]
        self.past_label = np.where(label[sent:] >= sent, -1, label[sent:])

    def went(self) -> pa.RecordBatch:
        """Links of the block that went past."""
        self.settle()
        some = self.past_n > 0
        found = self.past[some], self.past_n[some], self.rows[self.past_label[some]]
        self.pass_by(np.zeros(0, np.int64))
        return _batch(*found)

    def stayed(self) -> pa.RecordBatch:
        """Links of the blocks that were sent."""
        some = self.n > 0
        return _batch(self.rows[some], self.n[some], self.rows[self.label[some]])


def _batch(row: np.ndarray, n: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(n), pa.array(other)], names=["row", "n", "other"])


def _reach(threshold: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * threshold)))


def _met(batches: Iterator[pa.RecordBatch], width: int, kind: str, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of pairs of blocks (index, index2, whether they meet, and rows, vectors, chain of either).

    The pairs of one first block stand together, and one of them has what is in it; what is in a second block comes
    before it meets any.
    """
    met, sent, past, one, waits = Met(threshold), {}, None, None, []

    def block(batch: pa.RecordBatch, at: int, k: int) -> tuple[Tree, np.ndarray] | None:
        parts = [batch.column(c)[k] for c in range(at, at + 3)]
        if not parts[0].is_valid:
            return None
        rows, vectors, chain = (np.frombuffer(x.as_buffer(), t) for x, t in zip(parts, (np.int64, kind, np.int32)))
        return Tree(unit(vectors.astype(np.float64).reshape(-1, width)), chain.reshape(-1, len(RADII)).copy()), rows.copy()

    def went() -> pa.RecordBatch:
        tree, rows = one
        met.pass_by(rows)
        for theirs in waits:
            met.meet(tree, *sent[theirs], past == theirs)
        return met.went()

    for batch in batches:
        pairs = zip(*(batch.column(c).to_pylist() for c in range(3)))
        for k, (mine, theirs, meets) in enumerate(pairs):
            if mine != past:
                if past is not None:
                    yield went()
                past, one, waits = mine, None, []
            one = one or block(batch, 3, k)
            if (two := block(batch, 6, k)) is not None and theirs not in sent:
                sent[theirs] = two[0], met.sent(two[1])
            if meets:
                waits.append(theirs)
    if past is not None:
        yield went()
        yield met.stayed()


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors link when their cosine, in double precision, is ``threshold`` at
    least. ``n_links`` counts the other vectors linked with one directly,
    ``component_id`` is the least id that links lead to, ``kept`` says that it is the
    vector's own. Vectors that are null, empty or zero, or that hold a null or a
    number that is not finite, link with nothing, and so do vectors of different
    lengths. Repeated rows, and repeated or null ids, are vectors of their own; a
    null id is its own component unless a link leads to another id. Other columns
    are not read.
    """
    rows, own_ids = numbered(vectors, id_col, vector_col, "vector")
    spark = vectors.sparkSession
    usable_rows = usable(rows)
    counts = usable_rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()
    # Single precision is kept where the vectors have it.
    element = getattr(vectors.schema[vector_col].dataType, "elementType", None)
    kind = "float" if isinstance(element, T.FloatType) else "double"
    path = work_dir(spark, "vector-links")
    for width, n in sorted((r["width"], r["n"]) for r in counts):
        _links(usable_rows.filter(F.size("vector") == width), width, n, threshold, kind, path)
    found = spark.read.schema(_LINKS).parquet(path) if counts else spark.createDataFrame([], _LINKS)
    sums = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    joined = components(found.select(F.col("row").alias("a"), F.col("other").alias("b")))
    named = (
        rows.select("row", "id").join(sums, "row", "left").join(joined, F.col("row") == F.col("node"), "left")
        .select("row", "id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("component", "row").alias("component_id"))
    )
    if own_ids:
        return named.select(
            F.col("id").alias(id_col), "n_links", "component_id",
            (F.col("row") == F.col("component_id")).alias("kept"))
    names = named.groupBy("component_id").agg(F.min("id").alias("least_id"))
    return named.join(names, "component_id").select(
        F.col("id").alias(id_col), "n_links", F.col("least_id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("least_id")).alias("kept"))


def _links(rows: DataFrame, width: int, n: int, threshold: float, kind: str, path: str) -> None:
    """Adds to ``path`` (row, n, other): parts of a vector's links, and a vector that these connect it with."""
    spark = rows.sparkSession
    ship(spark)
    cells = max(1, min(MOST_CELLS, n // BLOCK))
    rows = rows.select("row", F.col("vector").cast(f"array<{kind}>").alias("vector"))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(cells).select("vector").collect()
    centres = unit(np.array([r["vector"] for r in sample], float))

    def cell_of(batch: pa.RecordBatch) -> np.ndarray:
        return (unit(_matrix(batch.column("vector"), width)) @ centres.T).argmax(1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(centres), np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(cell_of(batch), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "n"])

    # One row per cell, of which there are MOST_CELLS at most.
    counted = {r["cell"]: r["n"] for r in map_batches(rows, count, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()}
    # A vector between two cells may be placed in either, so radii are taken from the blocks as they are.
    blocks = np.array([max(1, -(-counted.get(c, 0) // BLOCK)) for c in range(len(centres))])
    first = np.cumsum(blocks) - blocks

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = cell_of(batch)
                index = first[cell] + batch.column("hash").to_numpy() % blocks[cell]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("vector"), pa.array(index)], names=["row", "vector", "index"])

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        index, vectors = table.column("index")[0].as_py(), table.column("vector").chunk(0)
        x = unit(_matrix(vectors, width))
        centre = centres[np.searchsorted(first, index, side="right") - 1]
        away = float(np.sqrt(np.maximum(0, 2 - 2 * (x @ centre))).max())
        held = (table.column("row").to_numpy(), np.asarray(vectors.flatten(), kind_), cover(x))
        return pa.table({
            "index": pa.array([index], pa.int64()), "n": pa.array([len(x)], pa.int64()), "away": pa.array([away]),
            **{name: pa.array([part.tobytes()], pa.binary()) for name, part in zip(parts, held)}})

    parts = "rows", "vectors", "chain"
    kind_ = {"float": "float32", "double": "float64"}[kind]
    placed = map_batches(rows.select("row", "vector", F.xxhash64("row").alias("hash")), place,
                         f"row long, vector array<{kind}>, index long")
    trees = stored(placed.groupBy("index").applyInArrow(
        build, "index long, n long, away double, rows binary, vectors binary, chain binary"),
        "vector-trees", maxRecordsPerFile=FILE_BLOCKS)

    # One row per block.
    shapes = sorted((r["index"], r["n"], r["away"]) for r in trees.select("index", "n", "away").collect())
    index, size, away = (np.array(x) for x in zip(*shapes))
    cell = np.searchsorted(first, index, side="right") - 1
    distance = np.sqrt(np.maximum(0, 2 - 2 * (centres @ centres.T)))
    tasks = 2 * spark.sparkContext.defaultParallelism
    for some in _slices(size * width * 8, BROADCAST):
        low, high = some.start, some.stop
        gap = distance[np.ix_(cell[:high], cell[some])] - away[:high, None] - away[None, some]
        near = (gap <= _reach(threshold) + _SLACK) & (np.arange(high)[:, None] <= np.arange(low, high)[None, :])
        partners = [(int(index[k]), index[some][near[k]].tolist()) for k in np.flatnonzero(near.any(1))]
        plan = spark.createDataFrame(partners, "index long, partners array<long>")
        # What is in a block goes to a task once: with the first of its pairs, or with the first block that goes past.
        past = trees.drop("n", "away").join(F.broadcast(plan), "index").coalesce(tasks).withColumn(
            "place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
        sent = trees.filter(F.col("index").between(int(index[low]), int(index[high - 1]))).select(
            *[F.col(c).alias(f"{c}2") for c in ("index", *parts)])
        meets = F.array_contains("partners", F.col("index2"))
        pairs = past.join(F.broadcast(sent), meets | (F.col("place") == 0)).select(
            "index", "index2", meets.alias("meets"),
            *[F.when(F.col("index2") == F.col("partners")[0], F.col(c)).alias(c) for c in parts],
            *[F.when(F.col("place") == 0, F.col(f"{c}2")).alias(f"{c}2") for c in parts])
        map_batches(pairs, lambda batches: _met(batches, width, kind_, threshold), _LINKS).write.mode("append").parquet(path)
