"""Token ids in ORC files: ascending documents, run-length coded integers, pruned reads.

``write_tokens`` deals documents out by ranges of doc_id, encodes each range in order
and writes it as one ORC file. ORC codes integer columns in runs; its row indexes and
the Bloom filters on doc_id let a reader skip stripes and row groups, and stripes are
read in parallel. A row holds the ids of one document and ``offset``, the ids before it
in its file, so only one number per file has to be summed to place every document.

Defined cases: a null or empty text has the end id alone; null doc_ids come first;
equal doc_ids are ordered by a hash of their text, so equal rows are interchangeable;
texts are encoded whole; an empty table gives no rows; further columns are ignored,
whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.encoding import (
    VOCABULARY,
    LibraryEncoder,
    little_endian,
    text_slices,
)
from skyloom.llm.memory import encoding_task, shared_encoder
from skyloom.session import scratch_path

END_ID = 2
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    # runs of integers are packed to the width they need; compressing them again saves little
    "compression": "none",
}
_SCHEMA = "part int, doc_id long, offset long, n_tokens int, ids array<int>"


def write_tokens(
    docs: DataFrame, target: str, path: str = VOCABULARY, end_id: int | None = END_ID
) -> None:
    """Write (part, doc_id, offset, n_tokens, ids) of all documents below ``target``."""

    @encoding_task
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = shared_encoder(LibraryEncoder, path)
        end = b"" if end_id is None else little_endian([end_id])
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in text_slices(batch):
                encoded = [ids + end for ids in encoder.encode(texts)]
                sizes = np.array([len(ids) // 4 for ids in encoded], np.int64)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                values = pa.array(np.frombuffer(b"".join(encoded), "<u4").view("<i4"))
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(np.full(len(texts), part, np.int32)),
                        "doc_id": batch.column(0).slice(first, len(texts)),
                        "offset": pa.array(before + starts[:-1]),
                        "n_tokens": pa.array(sizes.astype(np.int32)),
                        "ids": pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), values),
                    }
                )
                before += int(starts[-1])

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(*key)
        .sortWithinPartitions(*key)
    )
    ordered.mapInArrow(run, _SCHEMA).write.options(**ORC_OPTIONS).orc(target)


def read_tokens(
    spark: SparkSession, target: str, first_id: int | None = None, last_id: int | None = None
) -> DataFrame:
    """Documents with first_id <= doc_id <= last_id; stripes outside are not read."""
    rows = spark.read.schema(_SCHEMA).orc(target)
    if first_id is not None:
        rows = rows.where(F.col("doc_id") >= first_id)
    if last_id is not None:
        rows = rows.where(F.col("doc_id") <= last_id)
    return rows


def read_documents(spark: SparkSession, target: str, doc_ids: list[int]) -> DataFrame:
    """The named documents; Bloom filters and row indexes rule out most stripes."""
    return spark.read.schema(_SCHEMA).orc(target).where(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    @encoding_task
    def sums(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids = batch.column(2)
            at = np.asarray(ids.offsets).astype(np.int64) * 4
            raw = memoryview(np.ascontiguousarray(ids.values).astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": batch.column(0),
                    "doc_id": batch.column(1),
                    "offset": batch.column(3),
                    "n_tokens": pa.array(np.diff(at) // 4),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    rows = spark.read.schema(_SCHEMA).orc(target)
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("in_file"))
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(
        "part", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("before")
    )
    return (
        rows.select("part", "doc_id", "ids", "offset")
        .mapInArrow(sums, "part int, doc_id long, offset long, n_tokens long, ids_crc32 long")
        .join(F.broadcast(files), "part")
        .select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
    )


def encode_to_files(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """Write the token files to the shared folder and return their index."""
    spark = docs.sparkSession
    target = scratch_path(spark, "tokens")
    write_tokens(docs, target, path)
    return token_index(spark, target)
