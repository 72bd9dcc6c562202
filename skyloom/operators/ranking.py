"""Exact running totals and medians without one task that sees every row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.values import nan_to_null


# Rows one bucket should hold, and the most buckets ever made.
BUCKET_ROWS, MOST_BUCKETS = 200_000, 20_000


def bucket_count(rows: int) -> int:
    """Enough buckets to keep each small, and few enough for their sums to be broadcast."""
    return min(MOST_BUCKETS, max(64, rows // BUCKET_ROWS))


def running_totals(
    df: DataFrame,
    order: str,
    totals: list[str],
    *,
    descending: bool = False,
    buckets: int = 64,
) -> DataFrame:
    """Running sums ``cum_<c>`` along ``order``, and the next row's ``next_<c>``.

    ``df`` has one row per value of ``order``. Its quantiles cut it into buckets
    of about equal size; the few bucket sums give each bucket its offset, and a
    window runs inside each bucket only. The quantiles decide the balance, not
    the result.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(order, probabilities, 0.25 / buckets) if probabilities else []
    infinity = float("inf")
    edges = [-infinity, *sorted({c for c in cuts if abs(c) != infinity}), infinity]
    if len(edges) < 3:
        edges.insert(1, 0.0)
    bucketed = Bucketizer(splits=edges, inputCol=order, outputCol="_bucket").transform(df)

    direction = F.desc if descending else F.asc
    first_row = (F.max_by if descending else F.min_by)(F.struct(*totals), F.col(order))
    sums = bucketed.groupBy("_bucket").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in totals], first_row.alias("_first")
    )
    # At most ``buckets`` rows from here to the join.
    along = Window.orderBy(direction("_bucket"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in totals],
        F.lead("_first").over(along).alias("_next"),
    )
    inside = Window.partitionBy("_bucket").orderBy(direction(order))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .select(
            *df.columns,
            *[(F.col(f"_off_{c}") + F.sum(c).over(so_far)).alias(f"cum_{c}") for c in totals],
            *[F.coalesce(F.lead(c).over(inside), F.col("_next")[c]).alias(f"next_{c}") for c in totals],
        )
    )


@dataclass
class _Search:
    """Where the wanted ranks of one column lie: inside ``(low, high)``, both ends open."""

    ranks: list[int]
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    found: dict[int, float] = field(default_factory=dict)

    @property
    def open_ranks(self) -> list[int]:
        return [r for r in self.ranks if r not in self.found]

    def holds(self, value: Column) -> Column:
        keep = value.isNotNull()
        if self.low is not None:
            keep = keep & (value > F.lit(self.low))
        if self.high is not None:
            keep = keep & (value < F.lit(self.high))
        return keep


def _bracket(searches: dict[str, _Search], accuracy: int) -> list[Column]:
    """Approximate quantiles on either side of the wanted ranks, one pair per column."""
    slack = 2.0 / accuracy
    pairs = []
    for c, s in searches.items():
        at = [(r - s.below + 0.5) / s.inside for r in s.open_ranks]
        ends = [max(0.0, min(at) - slack), min(1.0, max(at) + slack)]
        inside = F.when(s.holds(F.col(c)), F.col(c))
        pairs.append(F.percentile_approx(inside, ends, accuracy).alias(c))
    return pairs


def _narrow(values: DataFrame, searches: dict[str, _Search], accuracy: int) -> None:
    """Replace each interval by one around its wanted ranks; two scans for all columns."""
    names = list(searches)
    ends = values.agg(*_bracket(searches, accuracy)).first()
    counts = []
    for c in names:
        low, high = ends[c]
        v, inside = F.col(c), searches[c].holds(F.col(c))
        counts += [
            F.count_if(inside & (v < low)).alias(f"{c}|lt"),
            F.count_if(inside & (v == low)).alias(f"{c}|low"),
            F.count_if(inside & (v > low) & (v < high)).alias(f"{c}|mid"),
            F.count_if(inside & (v == high) & F.lit(high > low)).alias(f"{c}|high"),
        ]
    n = values.agg(*counts).first()
    for c in names:
        s, (low, high) = searches[c], ends[c]
        lt, at_low, mid, at_high = (n[f"{c}|{part}"] for part in ("lt", "low", "mid", "high"))
        # The ends split the interval into values below, at low, between, at high and above. Both
        # ends are values of the column and two wanted ranks are neighbours, so the ranks
        # that are not at an end lie in one part: between them, or outside on a miss.
        parts = [
            (lt, s.low, low, False),
            (at_low, low, low, True),
            (mid, low, high, False),
            (at_high, high, high, True),
            (s.inside - lt - at_low - mid - at_high, high, s.high, False),
        ]
        first, interval = s.below, None
        for size, start, stop, is_end in parts:
            within = [r for r in s.open_ranks if first <= r < first + size]
            if within and is_end:
                s.found.update(dict.fromkeys(within, start))
            elif within:
                interval = (first, size, start, stop)
            first += size
        if interval:
            s.below, s.inside, s.low, s.high = interval


def column_medians(
    df: DataFrame, columns: list[str], *, limit: int = 1_000_000, accuracy: int = 10_000
) -> dict[str, float]:
    """A2: the exact median of each column; NaN counts as missing.

    An even count takes the midpoint of the two middle values. Approximate
    quantiles bracket the middle and exact counts place the bracket; where the quantiles
    miss, the counts tell on which side the middle is and the search goes on there. Only
    when ``limit`` values are left are they ranked, so no task holds a column. Columns without a
    value are left out of the result.
    """
    values = df.select(*[nan_to_null(F.col(c)).alias(c) for c in columns])
    sizes = values.agg(*[F.count(c).alias(c) for c in columns]).first()
    searches = {
        c: _Search(ranks=sorted({(sizes[c] - 1) // 2, sizes[c] // 2}), inside=sizes[c])
        for c in columns
        if sizes[c]
    }

    def wide(s: _Search) -> bool:
        return bool(s.open_ranks) and s.inside > limit

    while large := {c: s for c, s in searches.items() if wide(s)}:
        _narrow(values, large, accuracy)

    rest = {c: s for c, s in searches.items() if s.open_ranks}
    if rest:
        cells = [
            F.struct(F.lit(c).alias("name"), F.when(s.holds(F.col(c)), F.col(c)).alias("value"))
            for c, s in rest.items()
        ]
        counted = (
            values.select(F.inline(F.array(*cells)))
            .filter(F.col("value").isNotNull())
            .groupBy("name", "value")
            .agg(F.count("*").alias("n"))
        )
        so_far = (
            Window.partitionBy("name")
            .orderBy("value")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        ranked = counted.withColumn("upto", F.sum("n").over(so_far))
        hit = F.lit(False)
        for c, s in rest.items():
            for r in s.open_ranks:
                at = r - s.below
                covers = (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at)
                hit = hit | ((F.col("name") == c) & covers)
        # At most two rows per column.
        for row in ranked.filter(hit).collect():
            s = rest[row.name]
            for r in s.open_ranks:
                if row.upto - row.n <= r - s.below < row.upto:
                    s.found[r] = row.value
    return {c: sum(s.found[r] for r in s.ranks) / len(s.ranks) for c, s in searches.items()}


def column_moments(df: DataFrame, columns: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """A3: mean and population standard deviation of each column, in one pass."""
    row = df.agg(
        *[F.avg(c).alias(f"{name}|mean") for name, c in columns.items()],
        *[F.stddev_pop(c).alias(f"{name}|std") for name, c in columns.items()],
    ).first()
    return {name: (row[f"{name}|mean"], row[f"{name}|std"]) for name in columns}
