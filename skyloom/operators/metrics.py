"""Confusion matrix and ROC curve of a scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators.ranking import bucket_count, running_totals
from skyloom.session import materialise


def confusion_matrix(
    scored: DataFrame, label: str = "target", prediction: str = "prediction"
) -> DataFrame:
    """A4: ``actual, predicted_false, predicted_true``; both rows always exist.

    Four counts in one pass; nothing but the counts is shuffled.
    """
    actual, said = F.col(label).cast("boolean"), F.col(prediction).cast("boolean")
    counts = scored.agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )

    def line(name, no, yes):
        return F.struct(
            F.lit(name).alias("actual"),
            F.col(no).alias("predicted_false"),
            F.col(yes).alias("predicted_true"),
        )

    return counts.select(F.inline(F.array(line("False", "tn", "fp"), line("True", "fn", "tp"))))


def roc_curve(
    scored: DataFrame,
    label: str = "target",
    score: str = "score",
    *,
    drop_intermediate: bool = True,
    buckets: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """A5: ``fpr, tpr, threshold``, one point per distinct score and the point (0, 0).

    Equal scores are counted together before anything is ordered. The extra point
    has the highest score plus one as its threshold. ``drop_intermediate`` leaves
    out the points between two equal steps, which lie on a straight line; the
    first and the last score always stay. A rate whose class has no rows is NaN.
    ``buckets`` is the number of parts the ordering is cut into, by default chosen
    from the number of distinct scores. ``path`` is where the counts of each score are kept, by
    default a scratch table.
    """
    actual = F.col(label).cast("boolean")
    counts = materialise(
        scored.groupBy(F.col(score).alias("threshold")).agg(
            F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg")
        ),
        "roc",
        path,
    )
    ends = counts.agg(
        F.count("*").alias("scores"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.max("threshold").alias("top"),
    ).first()
    ranked = running_totals(
        counts,
        "threshold",
        ["pos", "neg"],
        descending=True,
        buckets=buckets or bucket_count(ends.scores),
    )

    def rate(cumulated, total):
        return cumulated / F.lit(float(total)) if total else F.lit(float("nan"))

    if drop_intermediate:
        same_step = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
        ranked = ranked.filter((F.col("threshold") == ends.top) | ~F.coalesce(same_step, F.lit(False)))
    points = ranked.select(
        rate(F.col("cum_neg"), ends.neg).alias("fpr"),
        rate(F.col("cum_pos"), ends.pos).alias("tpr"),
        "threshold",
    )
    if ends.top is None:
        return points
    origin = scored.sparkSession.range(1).select(
        rate(F.lit(0), ends.neg).alias("fpr"),
        rate(F.lit(0), ends.pos).alias("tpr"),
        F.lit(ends.top + 1.0).alias("threshold"),
    )
    return points.unionByName(origin)
