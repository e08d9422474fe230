"""Centroid clustering with heap-ordered bounds.

Lloyd's rounds over whole-number vectors. Beside its centroid every vector has a gap: the
distance to the second nearest centroid less that to its own. Centroids that move by so much
can close the gap by the movement of its own centroid and the largest of the others at most.
Each cluster adds these up as its drift. A heap per cluster holds the vectors by gap plus the
drift at the time the gap was measured, so a vector's nearest centroid can only have changed
once its entry is no more than the drift of today. Those entries are popped, their vectors
compared exactly with all centroids and pushed into the heap of the nearest; the others are
not looked at.

Vectors are cut into blocks of bounded size, once, and written as a table bucketed by block.
Heaps, owners and sums of a block are a row of a second table bucketed alike, so a round joins
the two without a shuffle and writes only the small one. Blocks without an expired entry stay
out of the join. Sums follow the vectors that change cluster; the driver sees one number per
cluster and component.

Distances are exact; gaps are floating-point numbers that are rounded so that an entry can only
expire too early. Ties go to the centroid of smaller number.

Defined results: vectors of another length, null vectors and vectors with a null or non-finite
component are left out; components beyond 2**27 in size after scaling count as that; a null id
is hashed as an empty string; rows with equal ids are vectors of their own; with fewer vectors
than clusters there are as many clusters as vectors; without vectors there are no rows; an
inertia beyond the range of a long is null; columns of other names are not read.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.taskcontext import TaskContext

from kvartal.llm.frames import small_batches
from kvartal.sources.staging import stage, staged_path

#: vectors in a block: what a task holds at a time
BLOCK = 4096
#: vectors in a bucket, the unit of work of a round
BUCKET = 64 * BLOCK
#: as many as Spark allows by default; more vectors make larger buckets, still read block by block
MOST_BUCKETS = 100_000
#: blocks sent to Python at a time
BLOCKS_AT_ONCE = 8
#: components count as this after scaling if they are larger
LARGEST = 2**27
#: share by which a gap is taken too small and a drift too large
SLACK = 1e-9

BLOCKS = "block long, ids array<long>, vectors binary"
STATE = "block long, heads array<double>, owners binary, keys binary, heaps binary, totals array<long>"


@dataclass(frozen=True)
class Clustering:
    """``rows``: id, cluster, distance of every vector; ``centroids``: whole numbers, one row each."""

    rows: DataFrame
    centroids: np.ndarray


# ---------------------------------------------------------------- vectors and blocks


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, size: int, scale: int) -> DataFrame:
    """id and scaled whole-number components of the vectors that can be compared."""
    v = F.col(vector)
    sound = (F.size(v) == size) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    number = lambda x: F.floor(F.greatest(
        F.least(scale * x.cast("double"), F.lit(float(LARGEST))), F.lit(float(-LARGEST))
    )).cast("int")
    return vectors.filter(v.isNotNull() & sound).select(
        F.col(vec_id).cast("long").alias("id"), F.transform(v, number).alias("vector")
    )


def first_centroids(whole: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = whole.orderBy(order, "vector").limit(clusters).select("vector").collect()
    return np.array([row.vector for row in rows], np.int64)


def _as_blocks(size: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 33
        made, ids, vectors = 0, [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors.append(flat.astype("<i4").reshape(-1, size))
            if len(ids) >= BLOCK:
                whole = np.concatenate(vectors)
                for i in range(0, len(ids) - BLOCK + 1, BLOCK):
                    yield _block(task + made, ids[i : i + BLOCK], whole[i : i + BLOCK])
                    made += 1
                left = len(ids) % BLOCK
                ids, vectors = ids[len(ids) - left :], [whole[len(whole) - left :]]
        if ids:
            yield _block(task + made, ids, np.concatenate(vectors))

    return cut


def _block(number: int, ids: list, vectors: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([vectors.tobytes()])],
        names=["block", "ids", "vectors"],
    )


def _buckets(blocks: DataFrame) -> int:
    size = blocks.agg(F.sum(F.size("ids")).alias("rows"), F.count(F.lit(1)).alias("blocks")).first()
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return min(max(-(-size["rows"] // BUCKET), min(size["blocks"], cores)), MOST_BUCKETS)


@contextmanager
def bucketed_tables(spark: SparkSession, buckets: int) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Writer of tables bucketed by block, joins of which need no shuffle; forgotten at the end."""
    names: list[str] = []

    def stored(df: DataFrame, label: str) -> DataFrame:
        names.append(f"kvartal_{label}_{uuid.uuid4().hex}")
        path = staged_path(spark, label)
        df.write.bucketBy(buckets, "block").sortBy("block").option("path", path).saveAsTable(names[-1])
        return spark.table(names[-1])

    try:
        yield stored
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# ---------------------------------------------------------------- one block in a round


def _distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per vector."""
    found = np.empty((len(vectors), len(centroids)), np.int64)
    for i, centroid in enumerate(centroids):
        apart = vectors.astype(np.int64) - centroid
        found[:, i] = (apart * apart).sum(axis=1)
    return found


def fresh_state(count: int, clusters: int) -> tuple[np.ndarray, list[list]]:
    """Owners and heaps before the first round: every entry has expired, nobody is counted."""
    heaps: list[list] = [[] for _ in range(clusters)]
    heaps[0] = [(-np.inf, i) for i in range(count)]
    return np.full(count, -1, np.int16), heaps


def rescan(
    vectors: np.ndarray, owners: np.ndarray, heaps: list[list], totals: np.ndarray,
    centroids: np.ndarray, drift: np.ndarray,
) -> int:
    """Pop the expired entries of all heaps and push their vectors again; tells how many.

    ``owners``, ``heaps`` and ``totals`` (a row per cluster: vectors, sums of components)
    are brought up to date in place.
    """
    popped: list[int] = []
    for cluster, heap in enumerate(heaps):
        while heap and heap[0][0] <= drift[cluster]:
            popped.append(heapq.heappop(heap)[1])
    if not popped:
        return 0
    at = np.array(popped)
    squares = _distances(vectors[at], centroids)
    nearest = squares.argmin(axis=1)
    own = np.sqrt(squares[np.arange(len(at)), nearest].astype(float))
    if len(centroids) > 1:
        squares[np.arange(len(at)), nearest] = np.iinfo(np.int64).max
        gap = np.sqrt(squares.min(axis=1).astype(float)) - own
    else:
        gap = np.full(len(at), np.inf)
    late = drift[nearest]
    keys = gap + late - SLACK * (1 + 2 * own + np.where(np.isfinite(gap), gap, 0) + late)
    for key, cluster, i in zip(keys.tolist(), nearest.tolist(), popped, strict=True):
        heapq.heappush(heaps[cluster], (key, i))
    moved = owners[at] != nearest
    for sign, clusters in ((-1, owners[at]), (1, nearest)):
        for cluster in np.unique(clusters[moved]):
            if cluster >= 0:
                gone = vectors[at[moved & (clusters == cluster)]]
                totals[cluster, 0] += sign * len(gone)
                totals[cluster, 1:] += sign * gone.astype(np.int64).sum(axis=0)
    owners[at] = nearest
    return len(at)


def _packed(block: int, owners: np.ndarray, heaps: list[list], totals: np.ndarray) -> pa.RecordBatch:
    keys = np.array([key for heap in heaps for key, _ in heap], "<f8")
    places = np.array([len(heap) for heap in heaps] + [i for heap in heaps for _, i in heap], "<i4")
    heads = [heap[0][0] if heap else np.inf for heap in heaps]
    columns = [[block], [heads], [owners.astype("<i2").tobytes()], [keys.tobytes()], [places.tobytes()],
               [totals.ravel().tolist()]]
    kinds = [pa.int64(), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["block", "heads", "owners", "keys", "heaps", "totals"],
    )


def _unpacked(row: dict, clusters: int) -> tuple[np.ndarray, list[list], np.ndarray]:
    owners = np.frombuffer(row["owners"], "<i2").copy()
    places = np.frombuffer(row["heaps"], "<i4")
    entries = list(zip(np.frombuffer(row["keys"], "<f8").tolist(), places[clusters:].tolist(), strict=True))
    ends = np.cumsum(places[:clusters])
    heaps = [entries[end - n : end] for end, n in zip(ends.tolist(), places[:clusters].tolist(), strict=True)]
    totals = np.array(row["totals"], np.int64).reshape(clusters, -1)
    return owners, heaps, totals


def _round(centroids: np.ndarray, drift: np.ndarray, begun: bool) -> Callable:
    clusters, size = centroids.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["vectors"], "<i4").reshape(-1, size)
                if begun:
                    owners, heaps, totals = _unpacked(row, clusters)
                else:
                    owners, heaps = fresh_state(len(vectors), clusters)
                    totals = np.zeros((clusters, size + 1), np.int64)
                rescan(vectors, owners, heaps, totals, centroids, drift)
                yield _packed(row["block"], owners, heaps, totals)

    return step


def _assigned(centroids: np.ndarray) -> Callable:
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["vectors"], "<i4").reshape(-1, centroids.shape[1])
                owners = np.frombuffer(row["owners"], "<i2").astype(np.int32)
                apart = vectors.astype(np.int64) - centroids[owners]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(owners),
                     pa.array((apart * apart).sum(axis=1))],
                    names=["id", "cluster", "distance"],
                )

    return tell


# ---------------------------------------------------------------- rounds


def moved_centroids(centroids: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The floor of every mean; a cluster without vectors stays where it is."""
    new = centroids.copy()
    for cluster, (count, *sums) in enumerate(totals.tolist()):
        if count:
            new[cluster] = [total // count for total in sums]
    return new


def added_drift(drift: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Per cluster, what its gaps can have lost: its own movement and the largest other."""
    apart = (new - old).astype(object)
    by = np.array([float(sum(x * x for x in row)) ** 0.5 for row in apart])
    other = np.array([max(np.delete(by, i), default=0.0) for i in range(len(by))])
    step = by + other
    return np.where(step > 0, (drift + step) * (1 + SLACK) + SLACK, drift)


def _summed(state: DataFrame, clusters: int, size: int) -> np.ndarray:
    rows = (
        state.select(F.posexplode("totals").alias("at", "total"))
        .groupBy("at").agg(F.sum("total").alias("total")).collect()  # clusters * (size + 1) rows
    )
    totals = np.zeros(clusters * (size + 1), np.int64)
    for row in rows:
        totals[row["at"]] = row["total"]
    return totals.reshape(clusters, size + 1)


def _expired(drift: np.ndarray) -> Column:
    heads = F.arrays_zip("heads", F.array(*(F.lit(float(d)) for d in drift)).alias("drift"))
    return F.exists(heads, lambda x: x["heads"] <= x["drift"])


def clustered(
    vectors: DataFrame, vec_id: str, vector: str, *, clusters: int, rounds: int, seed: str,
    size: int, scale: int = 1024,
) -> Clustering:
    """Lloyd's rounds and a last assignment. Jobs run at once; the rows are a stored table.

    Rounds end early once no centroid moves, as all later rounds would give the same.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, vec_id, vector, size, scale)
    centroids = first_centroids(whole, clusters, seed)
    if not len(centroids):
        empty = spark.createDataFrame([], "id long, cluster int, distance long")
        return Clustering(empty, centroids)
    cut = stage(whole.mapInArrow(_as_blocks(size), BLOCKS), "vector-blocks")
    buckets = _buckets(cut)
    with bucketed_tables(spark, buckets) as stored, small_batches(spark, BLOCKS_AT_ONCE):
        blocks = stored(cut.repartition(buckets, "block"), "blocks")
        drift = np.zeros(len(centroids))
        state = stored(blocks.mapInArrow(_round(centroids, drift, False), STATE), "heaps")
        for _ in range(rounds):
            new = moved_centroids(centroids, _summed(state, *centroids.shape))
            if (new == centroids).all():
                break
            drift, centroids = added_drift(drift, centroids, new), new
            again = _expired(drift)
            rescanned = blocks.join(state.filter(again).hint("merge"), "block").mapInArrow(
                _round(centroids, drift, True), STATE
            )
            state = stored(state.filter(~again).unionByName(rescanned), "heaps")
        owners = state.select("block", "owners").hint("merge")
        rows = stage(
            blocks.join(owners, "block")
            .mapInArrow(_assigned(centroids), "id long, cluster int, distance long"),
            "clustered",
        )
    return Clustering(rows, centroids)


def cluster_report(found: Clustering) -> DataFrame:
    """id, cluster, distance, its cluster's and the whole inertia, sha256 of its cluster's centroid."""
    total = lambda column: F.expr(f"try_cast(sum(cast({column} AS decimal(38, 0))) AS bigint)")
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("_sum"))
    digests = [sha256(",".join(map(str, row)).encode()).hexdigest() for row in found.centroids.tolist()]
    # one row per cluster
    own = sums.select("cluster", F.expr("try_cast(_sum AS bigint)").alias("cluster_inertia"))
    whole = sums.agg(total("_sum").alias("inertia")).scalar()
    return found.rows.join(F.broadcast(own), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", whole.alias("inertia"),
        F.get(F.array(*map(F.lit, digests)).cast("array<string>"), "cluster").alias("centroid_sha256"),
    )
