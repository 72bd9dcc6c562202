"""Centroid clustering of integer vectors by bit planes and population counts.

A vector of 64 integers is kept as bit planes: plane p packs bit p of all components into
one 64-bit word, in two's complement, so the last plane weighs -2^p. The dot product of
two vectors is the sum over pairs of planes of weight times weight times the count of set
bits in the AND of the two words, and |x - c|^2 = x.x - 2 x.c + c.c. All of it is exact.

Vectors are packed once and written; a round reads the planes, and each task returns
one count and 64 sums for each centroid. Only the centroids pass through the driver.

Defined cases: a vector that is null, has another length than 64 or holds a null or
non-finite component is left out; components beyond 2^62 in size are held at 2^62, and
a distance or inertia that no long holds is given as the largest long; vectors with
equal distances go to the smaller centroid; of several rows of one vec_id each is a
vector, and where the first centroids tie the lesser components come first; rows without
a vec_id are clustered, and come last among first centroids; with fewer vectors than
centroids there are as many centroids as vectors; an empty table gives an empty result;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import materialise

COMPONENTS = 64
CENTROIDS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
_FARTHEST = 1 << 62
_LARGEST = (1 << 63) - 1
#: Rows worked on at once, and planes are kept in multiples of this number.
_ROWS = 4096
_STEP = 4


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == COMPONENTS) & finite, F.lit(False))


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), held within 2^62."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * scale)
    return np.clip(scaled, -float(_FARTHEST), float(_FARTHEST)).astype(np.int64)


def widths(values: np.ndarray) -> np.ndarray:
    """Planes that each row needs, in two's complement, rounded up."""
    most = np.where(values < 0, ~values, values).max(axis=1)
    needed = np.ones(len(values), np.int64)
    while (left := most > 0).any():
        needed += left
        most = most >> 1
    return -(-needed // _STEP) * _STEP


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(rows, width) words of rows of 64 integers."""
    planes = np.empty((len(values), width), "<u8")
    for p in range(width):
        bits = ((values >> p) & 1).astype(np.uint8)
        planes[:, p] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return planes


def weights(width: int) -> list[int]:
    return [1 << p for p in range(width - 1)] + [-(1 << (width - 1))]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products (rows of a, rows of b) from planes; Python integers where a long might not do."""
    wide = a.shape[1] + b.shape[1] > 52
    out = np.zeros((len(a), len(b)), object if wide else np.int64)
    for p, of_a in enumerate(weights(a.shape[1])):
        for q, of_b in enumerate(weights(b.shape[1])):
            count = np.bitwise_count(a[:, p, None] & b[None, :, q])
            out += count.astype(out.dtype) * (of_a * of_b)
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """x.x of each row."""
    wide = 2 * planes.shape[1] > 52
    out = np.zeros(len(planes), object if wide else np.int64)
    weight = weights(planes.shape[1])
    for p, of_p in enumerate(weight):
        for q, of_q in enumerate(weight):
            count = np.bitwise_count(planes[:, p] & planes[:, q])
            out += count.astype(out.dtype) * (of_p * of_q)
    return out


def distances(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return squares(planes)[:, None] - 2 * dots(planes, centroids) + squares(centroids)[None, :]


def sums(planes: np.ndarray) -> list[int]:
    """The sum over rows of each component."""
    bits = np.unpackbits(planes.view(np.uint8).reshape(len(planes), -1, 8), axis=2, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64)
    total = [0] * COMPONENTS
    for row, weight in zip(counts.tolist(), weights(planes.shape[1]), strict=True):
        total = [t + weight * n for t, n in zip(total, row, strict=True)]
    return total


def centroid_planes(centroids: list[list[int]]) -> np.ndarray:
    values = np.array(centroids, np.int64)
    return pack(values, int(widths(values).max()))


def pack_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, planes) of the usable vectors; planes are little-endian words, lowest first."""

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            values = integers(flat.reshape(batch.num_rows, COMPONENTS))
            out: list[bytes] = [b""] * batch.num_rows
            if batch.num_rows:
                needed = widths(values)
                for width in np.unique(needed).tolist():
                    rows = np.flatnonzero(needed == width)
                    for row, words in zip(rows.tolist(), pack(values[rows], width), strict=True):
                        out[row] = words.tobytes()
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column(0), "planes": pa.array(out, pa.binary())})

    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    kept = kept.where(usable(F.col("embedding")))
    return kept.mapInArrow(run, f"vec_id {dict(kept.dtypes)['vec_id']}, planes binary")


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids hash lowest; of one id those with the least components."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(rank.alias("rank"), F.col("embedding").cast("array<double>").alias("x"))
    lowest = rows.where(usable(F.col("x"))).orderBy(F.asc_nulls_last("rank"), "x").limit(k).collect()
    return [integers(np.array(row.x)).tolist() for row in lowest]


def _blocks(batch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, planes) of the rows of a batch with as many planes."""
    import pyarrow as pa
    import pyarrow.compute as pc

    planes = batch.column(batch.schema.get_field_index("planes"))
    sizes = pc.binary_length(planes).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), _ROWS):
            some = rows[at : at + _ROWS]
            words = planes.take(pa.array(some)).buffers()[2]
            yield some, np.frombuffer(words, "<u8", len(some) * size // 8).reshape(len(some), -1)


def _round(packed: DataFrame, centroids: list[list[int]]) -> dict[int, list[int]]:
    """New centroids by number, for those that have vectors."""
    target, k = centroid_planes(centroids), len(centroids)

    def run(batches: Iterator):
        import pyarrow as pa

        count, total = [0] * k, [[0] * COMPONENTS for _ in range(k)]
        for batch in batches:
            for _, planes in _blocks(batch):
                nearest = distances(planes, target).argmin(axis=1)
                for c in np.unique(nearest).tolist():
                    own = planes[nearest == c]
                    count[c] += len(own)
                    total[c] = [a + b for a, b in zip(total[c], sums(own), strict=True)]
        found = [c for c in range(k) if count[c]]
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(found, pa.int32()),
                "n": pa.array([count[c] for c in found], pa.int64()),
                "total": pa.array(
                    [[Decimal(x) for x in total[c]] for c in found], pa.list_(pa.decimal128(38, 0))
                ),
            }
        )

    parts = packed.select("planes").mapInArrow(run, "cluster int, n long, total array<decimal(38,0)>")
    every = [F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(COMPONENTS)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *every).collect()
    return {r.cluster: [int(r[f"s{i}"]) // r.n for i in range(COMPONENTS)] for r in rows}


def fit(packed: DataFrame, centroids: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after some rounds; one without vectors stays where it is."""
    for _ in range(rounds if centroids else 0):
        moved = _round(packed, centroids)
        centroids = [moved.get(c, old) for c, old in enumerate(centroids)]
    return centroids


def assign(packed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) by the nearest centroid."""
    target = centroid_planes(centroids) if centroids else None

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            cluster = np.zeros(batch.num_rows, np.int32)
            distance = np.zeros(batch.num_rows, np.int64)
            for rows, planes in _blocks(batch):
                away = distances(planes, target)
                nearest = away.argmin(axis=1)
                cluster[rows] = nearest
                distance[rows] = np.minimum(away[np.arange(len(rows)), nearest], _LARGEST).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"vec_id": batch.column(0), "cluster": pa.array(cluster), "distance": pa.array(distance)}
            )

    return packed.select("vec_id", "planes").mapInArrow(
        run, f"vec_id {dict(packed.dtypes)['vec_id']}, cluster int, distance long"
    )


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    spark = vectors.sparkSession
    packed = materialise(pack_vectors(vectors), "planes")
    centroids = fit(packed, first_centroids(vectors, k, seed), rounds)
    placed = materialise(assign(packed, centroids), "clusters")
    by_cluster = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"))
    inertia = {r.cluster: int(r.d) for r in by_cluster.collect()}
    facts = [
        (
            c,
            min(d, _LARGEST),
            min(sum(inertia.values()), _LARGEST),
            hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(),
        )
        for c, d in inertia.items()
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # one row for each centroid
    facts = F.broadcast(spark.createDataFrame(facts, schema))
    return placed.join(facts, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
