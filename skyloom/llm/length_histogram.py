"""Exact histogram of encoded lengths, with suffix sums for every context limit.

Each task counts its documents by length, so a shuffled row is one length of one task.
Suffix sums are taken in blocks of lengths: inside each block, and over one total per
block, whose number depends on the longest document only.

Defined cases: null and empty texts have length 0 and count as documents; texts are
encoded whole; equal rows each count; an empty table gives an empty histogram; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.encoding import VOCABULARY, LibraryEncoder, text_slices
from skyloom.llm.memory import encoding_task, shared_encoder
from skyloom.session import materialise

#: Lengths in a block.
BLOCK = 1024


def length_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(length, n_docs): documents by their number of ids."""

    @encoding_task
    def run(batches: Iterator):
        import pyarrow as pa

        encoder = shared_encoder(LibraryEncoder, path)
        counts: Counter[int] = Counter()
        for batch in batches:
            for _, texts in text_slices(batch):
                counts.update(len(ids) // 4 for ids in encoder.encode(texts))
        yield pa.RecordBatch.from_pydict(
            {"length": pa.array(list(counts), pa.int64()), "n": pa.array(list(counts.values()), pa.int64())}
        )

    counted = docs.select("text").mapInArrow(run, "length long, n long")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """Add, for each length that occurs, what a context limit of that length needs.

    ``docs_from`` and ``tokens_from`` sum over documents of at least this length.
    ``tokens_cut`` is the total when every document is cut to this length, and
    ``share_upto`` the share of documents that fit whole.
    """
    rows = counts.select(
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("n_tokens"),
        F.floor(F.col("length") / BLOCK).cast("long").alias("block"),
    )
    blocks = rows.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum("n_tokens").alias("block_tokens")
    )
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    docs_from: Column = F.sum("n_docs").over(inside) + F.col("later_docs")
    tokens_from: Column = F.sum("n_tokens").over(inside) + F.col("later_tokens")
    return (
        rows.join(blocks, "block")
        .withColumns({"docs_from": docs_from, "tokens_from": tokens_from})
        .select(
            "length",
            "n_docs",
            "n_tokens",
            "docs_from",
            "tokens_from",
            (
                F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
            ).alias("tokens_cut"),
            (
                (F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")
            ).alias("share_upto"),
        )
    )


def length_histogram(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    # read twice, for the blocks and for the lengths; texts are encoded once
    return with_suffix_sums(materialise(length_counts(docs, path), "lengths"))


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, n_whole, n_tokens): documents that fit and tokens kept, for any limits."""
    spark = histogram.sparkSession
    asked = spark.createDataFrame([(k,) for k in sorted(set(limits))], "limit long")
    kept = F.least("length", "limit")
    # the limits asked for are a stated handful
    return (
        histogram.join(F.broadcast(asked))
        .groupBy("limit")
        .agg(
            F.sum(F.when(F.col("length") <= F.col("limit"), F.col("n_docs")).otherwise(0)).alias("n_whole"),
            F.sum(kept * F.col("n_docs")).alias("n_tokens"),
        )
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """(length): the smallest length that at least a share ``q`` of documents does not exceed."""
    return histogram.where(F.col("share_upto") >= q).agg(F.min("length").alias("length"))
