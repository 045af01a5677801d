"""Clustering by centroids, in which only vectors whose bounds have run out are looked at again.

Vectors lie in blocks. A block keeps, for each cluster, a heap of its vectors, ordered
by the gap between the lower bound of the distance to any other centroid and the upper
bound of that to the own one. When centroids move, all gaps of a cluster shrink by the
same amount, so they are stored offset by the drift so far and stay as they are: a
round takes from the top of each heap the vectors whose gap is below the drift by now,
compares these with all centroids, exactly, and puts them back. Sums of the clusters
change by the vectors that moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.arrow import map_batches
from lodestrata.llm.tables import Buckets, stored

COMPONENTS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2:"
# Vectors of a block; a task holds one at a time.
BLOCK = 4096
# Components beyond this would let a squared distance pass 63 bits.
LARGEST = 1 << 27
# What floating-point bounds may be off; a smaller gap counts as none.
_SLACK = 1e-6


class Heaps:
    """The heaps of a block: one array, in which each cluster's part is a binary heap, smallest key first."""

    def __init__(self, cluster: np.ndarray, key: np.ndarray, k: int) -> None:
        # A part in ascending order is a heap, too.
        self.rows = np.lexsort((key, cluster))
        self.keys = key[self.rows]
        self.cuts = np.searchsorted(cluster[self.rows], np.arange(k + 1))

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """The rows whose keys are below their cluster's drift. Only they and their children in the heap are looked at."""
        size = np.diff(self.cuts)
        cluster = np.flatnonzero(size)
        place = np.zeros(len(cluster), np.int64)
        found = [np.zeros(0, np.int64)]
        while len(cluster):
            at = self.cuts[cluster] + place
            below = self.keys[at] < drift[cluster]
            found.append(at[below])
            cluster, place = np.tile(cluster[below], 2), np.concatenate((2 * place[below] + 1, 2 * place[below] + 2))
            there = place < size[cluster]
            cluster, place = cluster[there], place[there]
        return np.concatenate(found)

    def to_bytes(self) -> bytes:
        return b"".join((self.cuts.astype("<i4").tobytes(), self.rows.astype("<i4").tobytes(),
                         self.keys.astype("<f8").tobytes()))

    @classmethod
    def from_bytes(cls, data: memoryview, n: int, k: int) -> Heaps:
        own = cls.__new__(cls)
        own.cuts = np.frombuffer(data, "<i4", k + 1).astype(np.int64)
        own.rows = np.frombuffer(data, "<i4", n, 4 * (k + 1)).astype(np.int64)
        own.keys = np.frombuffer(data, "<f8", n, 4 * (k + 1) + 4 * n).copy()
        return own


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vector by centroid."""
    if max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0))) < 1 << 22:
        # Every product and sum is a whole number below 2**53: floating point is exact.
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, of equal ones the smallest; lower minus upper bound of the distances)."""
    squares = _squares(vectors, centroids)
    best = squares.argmin(axis=1)
    rows = np.arange(len(vectors))
    upper = np.sqrt(squares[rows, best].astype(np.float64))
    if len(centroids) == 1:
        return best, np.full(len(vectors), np.inf)
    squares[rows, best] = np.iinfo(np.int64).max
    return best, np.sqrt(squares.min(axis=1).astype(np.float64)) - upper


def drifts(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far the gaps of each cluster shrink: by its own way, and the longest way of another."""
    way = np.sqrt(((after - before).astype(np.float64) ** 2).sum(axis=1))
    if len(way) == 1:
        return np.zeros(1)
    others = np.array([np.delete(way, k).max() for k in range(len(way))])
    return (way + others) * (1 + 1e-12) + _SLACK * 1e-3


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, components: int, scale: int) -> DataFrame:
    """(id, vector) of the vectors of the right length without null or non-finite components, as whole numbers."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.alias(vector_col))
    return rows.filter((F.size(vector) == components) & finite).select("id", whole.alias("vector"))


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors of the ``k`` ids with the smallest digests, in their order; null ids come last."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "vector").limit(k).collect()
    return np.array([r.vector for r in first], np.int64)


def _blocks(rows: DataFrame, components: int) -> DataFrame:
    """(block, ids, vectors): packed blocks of up to ``BLOCK`` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column(1).flatten().to_numpy().reshape(-1, components)
                if vectors.max(initial=0) >= LARGEST or vectors.min(initial=0) <= -LARGEST:
                    raise ValueError(f"a component is beyond {LARGEST}: its squared distances pass 63 bits")
                ids = pa.array([part.column(0).to_pylist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([_shrunk(vectors)], pa.binary())], names=["ids", "vectors"])

    packed = map_batches(rows, run, "ids array<long>, vectors binary")
    return packed.select(F.monotonically_increasing_id().alias("block"), "*")


def _shrunk(vectors: np.ndarray) -> bytes:
    """The width in bytes, then the numbers in that width."""
    top = int(np.abs(vectors).max(initial=0))
    width = 1 if top < 128 else 2 if top < 1 << 15 else 4
    return bytes([width]) + vectors.astype(f"<i{width}").tobytes()


def _grown(data: pa.Scalar, components: int) -> np.ndarray:
    own = memoryview(data.as_buffer())
    return np.frombuffer(own[1:], f"<i{own[0]}").reshape(-1, components).astype(np.int64)


def _sums(vectors: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """The number of vectors and the sums of their components, cluster by cluster."""
    sums = np.zeros((k, vectors.shape[1] + 1), np.int64)
    np.add.at(sums, cluster, np.column_stack((np.ones(len(vectors), np.int64), vectors)))
    return sums


_STATE = "block long, cluster binary, heaps binary, changes array<array<long>>, n_scanned long"


def _state(block: int, cluster: np.ndarray, heaps: Heaps, changes: np.ndarray, scanned: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([cluster.astype("<i4").tobytes()], pa.binary()),
         pa.array([heaps.to_bytes()], pa.binary()), pa.array([changes.tolist()], pa.list_(pa.list_(pa.int64()))),
         pa.array([scanned], pa.int64())], names=["block", "cluster", "heaps", "changes", "n_scanned"])


def begin(blocks: DataFrame, centroids: np.ndarray, components: int) -> DataFrame:
    """The state of each block after all its vectors were compared with all centroids."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                vectors = _grown(data, components)
                cluster, gap = _nearest(vectors, centroids)
                yield _state(block, cluster, Heaps(cluster, gap, k), _sums(vectors, cluster, k), len(vectors))

    return map_batches(blocks.select("block", "vectors"), run, _STATE)


def advance(blocks: DataFrame, state: DataFrame, centroids: np.ndarray, drift: np.ndarray, components: int) -> DataFrame:
    """The state of each block after the centroids have moved; ``drift`` is the sum of all drifts so far."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data, known, kept in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                vectors = _grown(data, components)
                cluster = np.frombuffer(known.as_buffer(), "<i4").astype(np.int64)
                heaps = Heaps.from_bytes(memoryview(kept.as_buffer()), len(vectors), k)
                at = heaps.expired(drift + _SLACK)
                changes = np.zeros((k, components + 1), np.int64)
                if len(at):
                    rows = heaps.rows[at]
                    now, gap = _nearest(vectors[rows], centroids)
                    moved = now != cluster[rows]
                    changes = _sums(vectors[rows[moved]], now[moved], k) - _sums(
                        vectors[rows[moved]], cluster[rows[moved]], k)
                    cluster[rows] = now
                    heaps.keys[at] = gap + drift[now]
                    key = np.empty(len(vectors))
                    key[heaps.rows] = heaps.keys
                    heaps = Heaps(cluster, key, k)
                yield _state(block, cluster, heaps, changes, len(at))

    joined = blocks.select("block", "vectors").join(state.select("block", "cluster", "heaps"), "block")
    return map_batches(joined, run, _STATE)


def _changes(state: DataFrame, k: int, components: int) -> np.ndarray:
    """The sums of all blocks: ``k`` rows of ``components`` + 1 numbers reach the driver."""
    cells = state.select(F.posexplode("changes").alias("cluster", "sums")).groupBy("cluster").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(components + 1)]).alias("sums"))
    sums = np.zeros((k, components + 1), np.int64)
    for row in cells.collect():
        sums[row.cluster] = row.sums
    return sums


def clustered(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector kept.

    Vectors of another length, null, or with null or non-finite components are left out.
    Null and repeated ids are vectors of their own; equal ids start in the order of their
    vectors, null ids last. Fewer vectors than ``clusters`` are so many centroids. No
    vectors, no rows. A component of ``LARGEST`` or more raises: its distances pass 63 bits.
    Other columns are not looked at.
    """
    rows = kept_vectors(df, id_col, vector_col, components, scale)
    centroids = first_centroids(rows, clusters, seed)
    k = len(centroids)
    if not k:
        return _no_rows(rows)
    with Buckets(df.sparkSession, "block") as buckets:
        blocks = buckets.stored(_blocks(rows, components), "vectors")
        state, sums, drift = buckets.stored(begin(blocks, centroids, components), "clusters"), 0, np.zeros(k)
        for _ in range(rounds):
            sums = sums + _changes(state, k, components)
            moved = np.where(sums[:, :1] > 0, sums[:, 1:] // np.maximum(sums[:, :1], 1), centroids)
            drift = drift + drifts(centroids, moved)
            centroids = moved
            state = buckets.stored(advance(blocks, state, centroids, drift, components), "clusters")
        found = stored(_distances(blocks, state, centroids, components), "distances")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = df.sparkSession.createDataFrame(
        [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())],
        "cluster int, centroid_sha256 string")
    # One row a cluster.
    small = inertia.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy())).join(digests, "cluster")
    return found.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _no_rows(rows: DataFrame) -> DataFrame:
    return rows.filter("false").selectExpr(
        "id AS vec_id", "CAST(NULL AS INT) AS cluster", "CAST(NULL AS BIGINT) AS distance",
        "CAST(NULL AS BIGINT) AS cluster_inertia", "CAST(NULL AS BIGINT) AS inertia",
        "CAST(NULL AS STRING) AS centroid_sha256")


def _distances(blocks: DataFrame, state: DataFrame, centroids: np.ndarray, components: int) -> DataFrame:
    """(vec_id, cluster, distance) of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, known in zip(*batch.columns):
                vectors = _grown(data, components)
                cluster = np.frombuffer(known.as_buffer(), "<i4")
                squares = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(cluster), pa.array(squares)], names=["vec_id", "cluster", "distance"])

    joined = blocks.join(state.select("block", "cluster"), "block").select("ids", "vectors", "cluster")
    return map_batches(joined, run, "vec_id long, cluster int, distance long")


def oracle_sql() -> str:
    """The same as SQL: every vector with every centroid in each round."""
    steps = [
        f"""kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {COMPONENTS}
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""centres0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{SEED}' || vec_id)) - 1 AS c, v FROM kept
        QUALIFY c < {CLUSTERS})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""nearest{r} AS MATERIALIZED (
        SELECT vec_id, kept.v AS v, c, list_sum(list_transform(
            list_zip(kept.v, centres{r}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM kept CROSS JOIN centres{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""sums{r} AS (
        SELECT c, i, sum(x) AS total, count(*) AS n
        FROM (SELECT c, unnest(v) AS x, unnest(range({COMPONENTS})) AS i FROM nearest{r}) GROUP BY c, i),
    centres{r + 1} AS MATERIALIZED (
        SELECT centres{r}.c AS c, coalesce(means.v, centres{r}.v) AS v FROM centres{r} LEFT JOIN (
            SELECT c, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{r} GROUP BY c
        ) means ON means.c = centres{r}.c)""")
    return "WITH " + ",\n    ".join(steps) + f"""
    SELECT vec_id, CAST(nearest{ROUNDS}.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY nearest{ROUNDS}.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centres{ROUNDS}.v, ',')) AS centroid_sha256
    FROM nearest{ROUNDS} JOIN centres{ROUNDS} ON centres{ROUNDS}.c = nearest{ROUNDS}.c"""
