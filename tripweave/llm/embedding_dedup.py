"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Normalised vectors at a cosine of c or more are at a distance of at most sqrt(2 - 2c). A table
hashes a vector by several Gaussian projections, each shifted and cut into steps of fixed
width; near vectors share a bucket of at least one of the tables with high probability. Inside
a bucket, blocks of bounded size are compared by exact cosines in double precision; a pair is
counted in the first table whose bucket it shares, so nothing is counted twice. Tasks return
counts per vector and a spanning forest of the links, never a row per pair.

Equal vectors are one point with a weight before any hashing, so thousands of copies cost what
one vector costs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import written
from tripweave.llm.components import components

#: Width of a projection's steps, and the seed of directions and shifts.
WIDTH, SEED = 2.0, 20240521
#: Share of the pairs exactly at the threshold that some table must bring together; closer
#: pairs meet more often. And how many unrelated vectors may share a vector's bucket.
RECALL, STRANGERS = 0.97, 0.05
#: Vectors of one side of a block.
BLOCK = 1024


def collision(distance: float) -> float:
    """Probability that vectors at a distance share one step of one projection."""
    t = WIDTH / max(distance, 1e-9)
    return math.erf(t / math.sqrt(2)) - math.sqrt(2 / math.pi) / t * (1 - math.exp(-t * t / 2))


def shape(points: int, least: float) -> tuple[int, int]:
    """Tables, and projections of each: as many projections as keep unrelated (orthogonal)
    vectors apart among so many points, and as many tables as the recall then asks for."""
    near, far = collision(math.sqrt(2 - 2 * least)), collision(math.sqrt(2))
    projections = max(1, math.ceil(math.log(max(points, 2) / STRANGERS) / -math.log(far)))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - near**projections)) if near < 1 else 1
    return tables, projections


@lru_cache(maxsize=8)
def _projections(dimensions: int, tables: int, projections: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts of all tables, the same in every task."""
    random = np.random.default_rng([SEED, dimensions])
    directions = random.standard_normal((dimensions, tables * projections))
    return directions, random.uniform(0, WIDTH, tables * projections)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision, at any scale of their components."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def buckets(units: np.ndarray, tables: int, projections: int) -> np.ndarray:
    """The bucket of each vector in each table, as a 64-bit number ``[vector, table]``."""
    directions, shifts = _projections(units.shape[1], tables, projections)
    steps = np.floor((units @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    steps = steps.reshape(len(units), tables, projections)
    total = np.full((len(units), tables), units.shape[1], np.uint64)
    for at in range(projections):
        total = (total ^ steps[:, :, at]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def _usable(vector: pa.Scalar) -> bytes | None:
    """The components as doubles, or None for a vector that links with nothing."""
    if not vector.is_valid or not len(vector.values) or vector.values.null_count:
        return None
    values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(values).all() or not values.any():
        return None
    return (values + 0.0).tobytes()  # adding 0 makes -0 equal 0


def _byte_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = pa.array([_usable(vector) for vector in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["vec_id", "vector"])


def _hash_batches(
    batches: Iterator[pa.RecordBatch], tables: int, projections: int
) -> Iterator[pa.RecordBatch]:
    """node, weight, vector -> the same with the buckets of all tables."""
    for whole in batches:
        for start in range(0, len(whole), 2000):
            batch = whole.slice(start, 2000)
            vectors = [np.frombuffer(v.as_py(), np.float64) for v in batch.column(2)]
            rows = np.zeros((len(vectors), tables), np.int64)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                same = np.flatnonzero(sizes == size)
                rows[same] = buckets(unit(np.stack([vectors[i] for i in same])), tables, projections)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, rows.size + 1, tables), pa.int32()), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=["node", "weight", "vector", "buckets"]
            )


def compare_block(
    side: np.ndarray,
    node: np.ndarray,
    weight: np.ndarray,
    units: np.ndarray,
    places: np.ndarray,
    table: int,
    least: float,
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of a block that no earlier table counts: for each vector the weight of those it
    links with, and a spanning forest of the links."""
    cosines = units @ units.T
    near = cosines >= least
    # A product may round another way in another block: what is that close to the threshold is
    # summed again in one fixed order.
    for a, b in np.argwhere(np.abs(cosines - least) < 1e-12):
        near[a, b] = float(np.sum(units[min(a, b)] * units[max(a, b)])) >= least
    np.fill_diagonal(near, False)
    if side.min() != side.max():
        near &= side[:, None] != side[None, :]
    for earlier in range(table):
        near &= places[:, None, earlier] != places[None, :, earlier]
    links = near @ weight
    forest, open_ = [], links > 0
    for seed in np.flatnonzero(open_):
        if not open_[seed]:
            continue
        open_[seed] = False
        reached = np.array([seed])
        while len(reached):
            reached = np.flatnonzero(near[reached].any(axis=0) & open_)
            open_[reached] = False
            forest += [(int(node[seed]), int(node[other])) for other in reached]
    return links, forest


def _block_batches(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block; a block is at most two chunks, so it fits in a task.

    Two kinds of rows come out: (node, linked weight, NULL) and (node, NULL, other node).
    """
    block, rows = None, []

    def answer() -> pa.RecordBatch:
        side, node, weight = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        units = unit(np.stack([np.frombuffer(r[3], np.float64) for r in rows]))
        places = np.array([r[4] for r in rows], np.int64)
        links, forest = compare_block(side, node, weight, units, places, block[0], least)
        some = np.flatnonzero(links)
        a = [*node[some].tolist(), *(x for x, _ in forest)]
        counted = [*links[some].tolist(), *[None] * len(forest)]
        b = [*[None] * len(some), *(y for _, y in forest)]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in (a, counted, b)], names=["node", "linked", "other"]
        )

    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for table, bucket, i, j, *row in zip(*columns):
            if (table, bucket, i, j) != block:
                if len(rows) > 1:
                    yield answer()
                block, rows = (table, bucket, i, j), []
            rows.append(row)
    if len(rows) > 1:
        yield answer()


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    embedding: str = "embedding",
    least: float = 0.95,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Two vectors of one length link when their cosine is at least ``least``. Vectors that are
    NULL, empty, zero, or hold a NULL or non-finite component link with nothing and are kept.
    Rows with equal vectors link with each other. A row without id is returned with no links
    and a NULL component. Ids are expected to be unique; rows that share one are counted each
    and share a component. Other columns of the input are not read.
    """
    rows = written(
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(embedding).cast("array<double>").alias("embedding"),
        ).mapInArrow(_byte_batches, "vec_id long, vector binary"),
        "vectors",
    )
    points = rows.where("vector is not null and vec_id is not null").groupBy("vector").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")
    )
    points = written(points.select("node", "weight", "vector"), "vector-points")
    tables, projections = shape(points.count(), least)
    hashed = written(
        points.mapInArrow(
            partial(_hash_batches, tables=tables, projections=projections),
            "node long, weight long, vector binary, buckets array<long>"
        ),
        "vector-buckets",
    )
    places = hashed.select("node", F.posexplode("buckets").alias("table", "bucket"))
    sizes = (
        places.groupBy("table", "bucket")
        .agg(F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("table", "bucket", F.ceil(F.col("members") / block).cast("int").alias("chunks"))
    )
    members = (
        places.join(sizes, ["table", "bucket"])
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .join(hashed, "node")
        .select(
            "table",
            "bucket",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            F.col("chunk").alias("side"),
            "node",
            "weight",
            "vector",
            "buckets",
        )
    )
    found = written(
        members.repartition("table", "bucket", "i", "j")
        .sortWithinPartitions("table", "bucket", "i", "j", "side")
        .mapInArrow(partial(_block_batches, least=least), "node long, linked long, other long"),
        "vector-links",
    )
    linked = found.where("linked is not null").groupBy("node").agg(F.sum("linked").alias("linked"))
    merged = components(found.where("other is not null"), "node", "other").toDF("node", "component")
    labels = (
        hashed.select("node", "weight", "vector")
        .join(linked, "node", "left")
        .join(merged, "node", "left")
        .select(
            "vector",
            (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    return (
        rows.join(labels, "vector", "left")
        .select(
            "vec_id",
            F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
        .withColumnRenamed("vec_id", id_column)
    )
