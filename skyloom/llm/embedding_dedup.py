"""Near-duplicate vectors by collision counting on sorted one-dimensional projections.

Vectors are projected on many random directions and each projection is sorted. Two
vectors collide on a projection where both lie in its sparse end, beyond a cut that a
share ``q`` of rows exceeds, and the second lies in a window centred on the first one's
value. In the dense middle a window of any use holds a large part of all rows, so nothing
is counted there. Pairs with at least ``COUNT`` collisions are verified by their cosine in
double precision.

Calibration: for two unit vectors at the least cosine, the chance to collide on one
projection follows from the bivariate normal law. The number of projections is chosen so
that a pair at the least cosine reaches ``COUNT`` collisions with the wanted recall; closer
pairs reach it more surely. ``q`` falls with the square root of the number of rows, so
rows beyond the cut, and false collisions per row, grow more slowly than the rows.

Equal vectors are one row with a count through the whole search, so a vector that a third
of all rows share costs as much as one row.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component; vectors of different lengths do not link;
equal rows link with each other; rows without a vec_id count as links and are in nobody's
name; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.components import connected_components
from skyloom.session import materialise

COSINE = 0.9
RECALL = 0.999
COUNT = 2
#: Rows beyond the cut of one projection, for each root of the number of rows.
ROOT_SHARE = 0.08
SEED = 1729
#: Half the width of a window, in standard deviations of a linked pair's difference.
REACH = 3.0


def _collision_chance(cut: float, cosine: float, reach: float) -> float:
    """P(x > cut, y > cut, |x - y| <= reach) for normal x, y with this correlation."""
    x = np.linspace(cut, cut + 8, 4001)
    spread = math.sqrt(1 - cosine * cosine)
    cdf = np.vectorize(NormalDist().cdf)
    low = np.maximum(cut, x - reach)
    chance = cdf((x + reach - cosine * x) / spread) - cdf((low - cosine * x) / spread)
    density = np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return float(np.sum(chance * density) * (x[1] - x[0]))


def calibrate(rows: int, cosine: float = COSINE, recall: float = RECALL, count: int = COUNT):
    """(projections, cut, reach) for a number of rows."""
    share = min(0.05, ROOT_SHARE / math.sqrt(max(rows, 1)))
    cut = NormalDist().inv_cdf(1 - share)
    reach = REACH * math.sqrt(2 - 2 * cosine)
    chance = _collision_chance(cut, cosine, reach)
    mean = count * 1.0
    while True:  # collisions of a pair are Poisson to a good approximation, rare and independent
        missed = sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(count))
        if missed <= 1 - recall:
            return math.ceil(mean / chance), cut, reach
        mean += 0.25


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, key, unit): unit vectors in double precision; null unit where undefined."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    # scaled first, so that squares neither overflow nor vanish
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.withColumn("scale", F.when(F.coalesce(sound, F.lit(False)), largest))
    rows = rows.withColumn("scale", F.when(F.col("scale") > 0, F.col("scale")))
    rows = rows.withColumn("vector", F.when(F.col("scale").isNotNull(), F.transform("vector", lambda x: x / F.col("scale"))))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("norm", norm)
    unit = F.transform("vector", lambda x: x / F.col("norm") + F.lit(0.0))
    return rows.select("vec_id", unit.alias("unit"))


def _tails(width: int, projections: int, cut: float, seed: int):
    def run(batches: Iterator):
        import pyarrow as pa

        # directions are drawn anew in each task from the seed, a block at a time
        for batch in batches:
            keys = np.asarray(batch.column(0))
            units = np.asarray(batch.column(1).flatten()).reshape(len(keys), width).astype(np.float32)
            for first in range(0, projections, 512):
                n = min(512, projections - first)
                lines = np.random.default_rng([seed, width, first]).standard_normal(
                    (width, n), dtype=np.float32
                )
                values = units @ lines
                row, line = np.nonzero(values > cut)
                yield pa.RecordBatch.from_pydict(
                    {
                        "line": pa.array((line + first).astype(np.int32)),
                        "value": pa.array(values[row, line].astype(np.float64)),
                        "key": pa.array(keys[row]),
                    }
                )

    return run


def candidate_pairs(units: DataFrame, width: int, rows: int, recall: float = RECALL, cosine: float = COSINE) -> DataFrame:
    """(a, b): keys of pairs that collide often enough, a < b."""
    projections, cut, reach = calibrate(rows, cosine, recall)
    ends = units.select("key", "unit").mapInArrow(
        _tails(width, projections, cut, SEED), "line int, value double, key long"
    )
    ends = materialise(ends, "projections")
    other = ends.select("line", F.col("value").alias("other"), F.col("key").alias("b"))
    hits = ends.withColumnRenamed("key", "a").join(other, "line").where(
        (F.col("a") < F.col("b")) & (F.abs(F.col("value") - F.col("other")) <= reach)
    )
    return hits.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT).select("a", "b")


def near_duplicate_vectors(
    embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = materialise(unit_vectors(embeddings), "units")
    classes = rows.where("unit is not null").groupBy("unit").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    classes = materialise(
        classes.select(F.monotonically_increasing_id().alias("key"), "unit", "copies", "least"), "classes"
    )
    sizes = {r.width: r.n for r in classes.groupBy(F.size("unit").alias("width")).agg(F.count("*").alias("n")).collect()}
    dot = F.aggregate(F.zip_with("ua", "ub", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = None
    for width, n in sorted(sizes.items()):
        own = classes.where(F.size("unit") == width)
        pairs = candidate_pairs(own, width, n, recall, cosine)
        one = own.select(F.col("key").alias("a"), F.col("unit").alias("ua"), F.col("copies").alias("na"))
        two = own.select(F.col("key").alias("b"), F.col("unit").alias("ub"), F.col("copies").alias("nb"))
        here = pairs.join(one, "a").join(two, "b").where(dot >= cosine).select("a", "b", "na", "nb")
        links = here if links is None else links.unionByName(here)
    spark = embeddings.sparkSession
    if links is None:
        links = spark.createDataFrame([], "a long, b long, na long, nb long")
    links = materialise(links, "vector-links")
    ends = links.select(F.col("a").alias("key"), F.col("nb").alias("n")).union(links.select("b", "na"))
    others = ends.groupBy("key").agg(F.sum("n").alias("others"))
    components = connected_components(links)
    labelled = (
        classes.join(components, F.col("key") == F.col("node"), "left")
        .join(others, "key", "left")
        .select(
            "unit",
            "least",
            F.coalesce("component", "key").alias("component"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    labelled = materialise(labelled, "labelled")
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = labelled.join(names, "component").select("unit", "n_links", "component_id")
    return rows.join(labelled, "unit", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(
            F.when(F.col("unit").isNull(), F.lit(True)).otherwise(F.col("vec_id") == F.col("component_id")),
            F.lit(False),
        ).alias("kept"),
    )
