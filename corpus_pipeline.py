"""A corpus pipeline: five stages over documents, each written and reread as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; a stage
deletes its predecessor's scratch tables, so results have to be written before it. All
but the last return the columns of documents; further columns of the input are carried
along unchanged, whatever their names. Null texts count as empty, and empty tables give empty tables.

* toxicity: documents that score ``toxicity.THRESHOLD`` or more go.
* simhash_near_dedup: of each group linked by fingerprints within two bits the document
  with the smallest doc_id stays, and of equal rows one; a row without a doc_id stays
  only where no document of its group has one.
* suffix_array_dedup: bytes of every 200-byte string that occurs again are cut out; text
  and n_chars change, no document goes.
* benchmark_decontamination: documents with a benchmark window go; rows that share a
  doc_id, or have none, are judged by their own texts.
* bpe: the ids of each remaining text, with the digests of ids and decoded text.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from skyloom.llm.simhash import whole_row
from skyloom.session import bound_batches, materialise, release_scratch, scratch_tables

#: Scratch tables of the stage called last.
_last: list[str] = []


def _staged(stage):
    """The stage, deleting what its predecessor left: that result is written by now."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, [path for path in _last if path in scratch_tables()])
        before = set(scratch_tables())
        result = stage(bound_batches(spark), docs, sf_dir)
        _last[:] = [path for path in scratch_tables() if path not in before]
        return result

    return run


@_staged
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    scored = toxicity.score_documents(docs.select("text", whole_row(docs)), model, ["row"])
    return scored.where(F.col("_score") < toxicity.THRESHOLD).select("row.*")


@_staged
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs, simhash.near_duplicates(docs))


@_staged
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs.select("text", whole_row(docs)), with_text=True, keep=["row"])
    values = {
        "text": F.col("kept_text"),
        "n_chars": F.length("kept_text").cast("long"),
    }
    row = F.col("row")
    return cut.select([(values[c] if c in values else row[c]).alias(c) for c in docs.columns])


@_staged
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark, with_key=True)
    hit = found.where("contaminated").select("doc_id", "text_key").distinct()
    hit = materialise(hit.select(F.col("doc_id").alias("hit"), F.col("text_key").alias("hit_key")), "contaminated")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), simhash.text_key(F.col("text")).alias("key"), whole_row(docs))
    same = F.col("id").eqNullSafe(F.col("hit")) & (F.col("key") == F.col("hit_key"))
    return rows.join(hit, same, "left_anti").select("row.*")


@_staged
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Learned scores, fingerprints and encodings cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
