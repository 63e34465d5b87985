"""Centroid clustering with heaps of expiring gaps.

Vectors of a fixed number of components become integers, so that sums, means and distances are
exact whatever the order. Every round assigns each vector to the nearest centroid (ties: the
smaller number) and replaces each centroid by the floored mean of its vectors.

A vector's gap is its distance to the second nearest centroid less that to its own, at the
time it was last scanned. When centroids move, the gap can shrink by at most what its own moved plus the
most that any other moved; that drift adds up for each cluster. A cluster keeps its
vectors in a heap by gap plus the drift at the time: while the least is above the drift of now, no
vector of the cluster can have another nearest centroid. Vectors whose gap expires are popped,
scanned against all centroids exactly, and pushed to the heap of their cluster.
Gaps are rounded down and drifts up, so rounding can only cause a scan too many.

Vectors are packed into blocks as they are read, and shuffled once, by block, into a bucketed
table; heaps are a second table in the same buckets, written anew each round, so that a round
joins the two without a shuffle and only reads what is behind it in files. A task has the blocks
of one bucket; raise spark.sql.sources.bucketing.maxBuckets beyond three billion vectors. What a block's vectors add to and take from the sums of the clusters is
aggregated by Spark; the driver sees one row for each centroid and component.

Null vectors, vectors with another number of components or with a null, NaN or infinite one
are left out. Null ids are kept, and come last where the first centroids are chosen, as do
equal ids after the order of their components. Repeated rows are vectors like any other; with
fewer vectors than centroids there are as many centroids as vectors, and an empty table
gives an empty result. Other columns of the table are not read. A component that is 2^27 or more in size as an
integer is refused with an error, for squared distances then leave 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barstats.sources.scratch import new_folder, staged

COMPONENTS = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
#: Vectors of a block, and blocks of a bucket.
BLOCK = 4096
BLOCKS_PER_BUCKET = 8
_LARGEST = 1 << 27
#: What rounding may have done to a distance or a drift, as a share of it.
_SLACK = 1e-12


def as_integers(
    vectors: DataFrame, id_col: str, vector_col: str, components: int, scale: int
) -> DataFrame:
    """vec_id and x, an array of int, of the vectors that are kept."""
    x = F.transform(vector_col, lambda v: v.cast("double"))
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("x").isNotNull() & (F.size("x") == components)).where(usable)
    far = F.exists("x", lambda v: F.abs(v) * scale >= float(_LARGEST))
    refused = F.raise_error(F.lit(f"a component times {scale} is not below 2^27")).cast("array<int>")
    return rows.select("vec_id", F.when(far, refused).otherwise(F.transform("x", lambda v: F.floor(v * scale).cast("int"))).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed and id, k rows at most."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    picked = rows.withColumn("key", key).orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in picked], np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centroid, exact."""
    x = x.astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]


def drift_of(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """By how much the gap of each cluster's vectors can have shrunk, rounded up."""
    moved = np.sqrt(((after - before).astype(np.float64) ** 2).sum(1)) * (1 + _SLACK)
    others = np.array([max(np.delete(moved, c), default=0.0) for c in range(len(moved))])
    return (moved + others) * (1 + _SLACK)


class BlockHeaps:
    """A heap for each cluster over the vectors of one block: (gap and drift, place)."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps
        self.scanned = 0

    @classmethod
    def read(cls, sizes: Sequence[int], keys: Sequence[float], places: Sequence[int]) -> BlockHeaps:
        """Of lists in the order of ``written``; a list in heap order is a heap."""
        ends = np.cumsum([0, *sizes]).tolist()
        return cls([list(zip(keys[a:b], places[a:b])) for a, b in zip(ends, ends[1:])])

    def written(self) -> tuple[list[int], list[float], list[int]]:
        flat = [pair for heap in self.heaps for pair in heap]
        return [len(h) for h in self.heaps], [key for key, _ in flat], [place for _, place in flat]

    def expired(self, drift: np.ndarray) -> tuple[list[int], list[int]]:
        """Pop all whose gap has expired: their places and clusters."""
        places, clusters = [], []
        for c, heap in enumerate(self.heaps):
            limit = float(drift[c])
            while heap and heap[0][0] <= limit:
                places.append(heapq.heappop(heap)[1])
                clusters.append(c)
        return places, clusters

    def scan(self, x: np.ndarray, places: list[int], centroids: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Assign the vectors at these places exactly, and push them; their clusters."""
        near = distances(x[places], centroids)
        own = near.argmin(1)
        least = np.sqrt(near[np.arange(len(places)), own].astype(np.float64))
        near[np.arange(len(places)), own] = np.iinfo(np.int64).max
        if len(centroids) > 1:
            second = np.sqrt(near.min(1).astype(np.float64))
            keys = second - least - _SLACK * (second + least) + drift[own]
        else:
            keys = np.full(len(places), np.inf)
        for key, place, c in zip(keys.tolist(), places, own.tolist()):
            heapq.heappush(self.heaps[c], (key, place))
        self.scanned += len(places)
        return own

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[place for _, place in heap]] = c
        return out


_STATE = "block long, sizes array<int>, keys array<double>, places array<int>, scanned long, counts array<long>, sums array<long>"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (vec_id, x) to rows of blocks, numbered by task."""
    first = TaskContext.get().partitionId() << 32
    held, n, made = [], 0, 0

    def block(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("vec_id").combine_chunks()
        x = table.column("x").combine_chunks().flatten()
        one = [pa.array([first + made], pa.int64())]
        one += [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (ids, x)]
        return pa.RecordBatch.from_arrays(one, ["block", "ids", "x"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= BLOCK:
            rows = pa.Table.from_batches(held)
            yield block(rows.slice(0, BLOCK))
            held, n, made = rows.slice(BLOCK).to_batches(), n - BLOCK, made + 1
    if n:
        yield block(pa.Table.from_batches(held))


def _round(centroids: np.ndarray, drift: np.ndarray):
    """One round over blocks and their heaps, of which the first round has none."""
    k, width = centroids.shape
    schema = to_arrow_schema(StructType.fromDDL(_STATE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = "keys" in batch.schema.names
            for i in range(batch.num_rows):
                x = batch.column("x")[i].values.to_numpy().reshape(-1, width)
                counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
                if known:
                    heaps = BlockHeaps.read(*(batch.column(c)[i].as_py() for c in ("sizes", "keys", "places")))
                    places, was = heaps.expired(drift)
                    np.subtract.at(counts, was, 1)
                    np.subtract.at(sums, was, x[places].astype(np.int64))
                else:
                    heaps, places = BlockHeaps([[] for _ in range(k)]), list(range(len(x)))
                if places:
                    own = heaps.scan(x, places, centroids, drift)
                    np.add.at(counts, own, 1)
                    np.add.at(sums, own, x[places].astype(np.int64))
                row = [batch.column("block")[i].as_py(), *heaps.written(), heaps.scanned, counts, sums.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return run


def _assigned(centroids: np.ndarray, id_type: str):
    """The rows of the blocks' vectors: vec_id, cluster and distance."""
    schema = f"vec_id {id_type}, cluster int, distance long"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column("x")[i].values.to_numpy().reshape(-1, width).astype(np.int64)
                heaps = BlockHeaps.read(*(batch.column(c)[i].as_py() for c in ("sizes", "keys", "places")))
                own = heaps.clusters(len(x))
                away = ((x - centroids[own]) ** 2).sum(1)
                columns = [batch.column("ids")[i].values, pa.array(own.astype(np.int32)), pa.array(away)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return run, schema


@dataclass
class Clustering:
    """``rows`` has vec_id, cluster and distance; ``centroids`` a tuple of integers for each
    cluster; ``scanned`` how many vectors every round scanned."""

    rows: DataFrame
    centroids: list[tuple[int, ...]]
    scanned: list[int]


class _Buckets:
    """Tables in the same buckets of blocks, in the shared folder. Their names are forgotten at the end."""

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n, self.names = spark, n, []

    def write(self, df: DataFrame, label: str) -> DataFrame:
        name = f"{label}_{uuid4().hex}"
        path = new_folder(self.spark, label)
        self.names.append(name)
        df.write.format("parquet").bucketBy(self.n, "block").sortBy("block").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def forget(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = 3,
) -> Clustering:
    """Cluster the vectors in a fixed number of rounds."""
    spark = vectors.sparkSession
    rows = as_integers(vectors, id_col, vector_col, components, scale)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        empty = spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long")
        return Clustering(empty, [], [])
    packed = staged(rows.mapInArrow(_pack, f"block long, ids array<{id_type}>, x array<int>"), "packed")
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = _Buckets(spark, min(most, -(-packed.count() // BLOCKS_PER_BUCKET)))
    try:
        blocks = buckets.write(packed.repartition(buckets.n, "block"), "blocks")
        drift = np.zeros(len(centroids))
        state, scanned, sums, counts = None, [], np.zeros(centroids.shape, object), np.zeros(len(centroids), object)
        for step in range(rounds + 1):
            held = blocks.select("block", "x")
            if state is not None:
                held = held.join(state.select("block", "sizes", "keys", "places").hint("merge"), "block")
            state = buckets.write(held.mapInArrow(_round(centroids, drift), _STATE), "heaps")
            changed = _sums(state, "sums").reshape(centroids.shape)
            sums, counts = sums + changed, counts + _sums(state, "counts")
            scanned.append(state.agg(F.sum("scanned")).first()[0])
            if step == rounds:
                break
            mean = [s // n if n else c for s, n, c in zip(sums, counts, centroids)]
            new = np.array(mean, np.int64).reshape(centroids.shape)
            drift, centroids = drift + drift_of(centroids, new), new
        run, schema = _assigned(centroids, id_type)
        both = blocks.join(state.select("block", "sizes", "keys", "places").hint("merge"), "block")
        out = staged(both.mapInArrow(run, schema), "clusters")
    finally:
        buckets.forget()
    return Clustering(out, [tuple(c) for c in centroids.tolist()], scanned)


def _sums(state: DataFrame, column: str) -> np.ndarray:
    """The exact sums of an array column of fixed length, place by place."""
    places = state.select(F.posexplode(column).alias("place", "v")).groupBy("place")
    rows = places.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    return np.array([int(r["s"]) for r in sorted(rows)], object)


def with_inertia(found: Clustering) -> DataFrame:
    """The rows with the distances summed over their cluster and over all, and the SHA-256 of
    their centroid's components. Totals have a row for each centroid, so they are sent to the tasks."""
    spark = found.rows.sparkSession
    written = [(c, ",".join(map(str, x))) for c, x in enumerate(found.centroids)]
    named = spark.createDataFrame(written, "cluster int, components string")
    named = named.select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    each = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia"))
    totals = each.crossJoin(F.broadcast(each.agg(F.sum("inertia").alias("total"))))
    totals = totals.join(F.broadcast(named), "cluster").select(
        "cluster",
        F.col("inertia").cast("long").alias("cluster_inertia"),
        F.col("total").cast("long").alias("inertia"),
        "centroid_sha256",
    )
    return found.rows.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
