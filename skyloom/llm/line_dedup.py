"""Lines that many documents share, kept in one document only, as bitmaps of kept lines.

DataFrame functions throughout; no text is compared or shuffled until bitmaps are applied.

1. Every line of at least ``least_chars`` is reduced to the 128-bit hash of its key.
2. Hashes are partitioned by range and sorted by document, last first, and position. The
   first line of each document in a hash's stream is an occurrence. A hash that many rows
   share is dealt over ``SALTS`` streams by document, so a document is in one stream and
   counts of streams add up; their counts are combined before they meet.
3. Hashes with occurrences in ``least_docs`` documents go from all but the last document.
   A document that loses lines gets a bitmap: words of 64 lines, a set bit for a kept
   line. Words that keep everything are not stored.

Bitmaps are found by doc_id and a 128-bit hash of the text, so each of several rows of one
doc_id has its own.

Defined cases: a null or empty text is one empty line; texts are read whole; rows that
share a doc_id count as one document, and rows without one count as one document that
comes before all others; equal rows have equal results; lines repeated inside a document
stay or go together; an empty table gives an empty result; further columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.ascii import fold_ascii, strip_ascii
from skyloom.session import materialise

LEAST_CHARS = 40
LEAST_DOCS = 5
#: Streams of one hash.
SALTS = 64
#: Lines in a word of a bitmap.
WORD = 64


def _hashes(value: Column, name: str) -> list[Column]:
    """128 bits as two long columns."""
    return [F.xxhash64(value).alias(f"{name}1"), F.xxhash64(F.lit(1), value).alias(f"{name}2")]


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    return rows.select("doc_id", *_hashes(F.col("text"), "t"), "text")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(k1, k2, doc_id, t1, t2, line): the hash of each line long enough, and where it stands."""
    rows = _texts(docs).select("doc_id", "t1", "t2", F.posexplode(_lines(F.col("text"))).alias("line", "text"))
    rows = rows.withColumn("text", strip_ascii(F.col("text"))).where(F.length("text") >= least_chars)
    return rows.select(*_hashes(fold_ascii(F.col("text")), "k"), "doc_id", "t1", "t2", "line")


def repeated_hashes(lines: DataFrame, least_docs: int = LEAST_DOCS, salts: int = SALTS) -> DataFrame:
    """(k1, k2, last): hashes found in enough documents, and the last of these."""
    salt = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(salts)).cast("int")
    rows = lines.select("k1", "k2", salt.alias("salt"), "doc_id", "line")
    streams = rows.repartitionByRange("k1", "k2", "salt")
    order = Window.partitionBy("k1", "k2", "salt").orderBy(F.desc_nulls_last("doc_id"), "line")
    seen = F.row_number().over(order) > 1
    again = seen & F.lag("doc_id").over(order).eqNullSafe(F.col("doc_id"))
    first = streams.withColumn("again", again).where(~F.col("again"))
    counted = first.groupBy("k1", "k2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
    return counted.where(F.col("docs") >= least_docs).select("k1", "k2", "last")


def keep_bitmaps(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    salts: int = SALTS,
) -> DataFrame:
    """(doc_id, t1, t2, keep) of each document that loses lines.

    ``keep`` is a sorted array of (word, bits): bit b of word w is set where line 64 w + b
    stays. Lines of a word that is not listed stay.
    """
    lines = materialise(line_hashes(docs, least_chars), "lines")
    # a table, so that the join deals out both sides anew and can split a hash of many lines
    repeated = materialise(repeated_hashes(lines, least_docs, salts), "repeated")
    gone = lines.join(repeated, ["k1", "k2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    bit = F.expr(f"shiftleft(1L, line % {WORD})")
    place = F.expr(f"line div {WORD}").cast("int")
    words = gone.groupBy("doc_id", "t1", "t2", place.alias("word")).agg(F.bit_or(bit).alias("gone"))
    entry = F.struct("word", F.bitwise_not("gone").alias("bits"))
    return words.groupBy("doc_id", "t1", "t2").agg(F.array_sort(F.collect_list(entry)).alias("keep"))


def _unfolded(keep: Column) -> Column:
    """All words up to the last one listed, so that a line finds its word by number."""

    def with_gap(entry: Column, at: Column) -> Column:
        before = F.when(at == 0, F.lit(-1)).otherwise(F.get(keep, at - 1)["word"])
        return F.concat(F.array_repeat(F.lit(-1).cast("long"), entry["word"] - before - 1), F.array(entry["bits"]))

    return F.flatten(F.transform(keep, with_gap))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every document."""
    kept = bitmaps.select(F.col("doc_id").alias("d"), F.col("t1").alias("u1"), F.col("t2").alias("u2"), "keep")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2"))
    rows = _texts(docs).join(kept, same, "left").select("doc_id", "text", _unfolded(F.col("keep")).alias("words"))

    def stays(_: Column, at: Column) -> Column:
        bits = F.get("words", F.floor(at / WORD).cast("int"))
        return F.coalesce(F.getbit(bits, at % WORD) == 1, F.lit(True))

    some = rows.select("doc_id", "text", "words", _lines(F.col("text")).alias("lines")).select(
        "doc_id",
        "text",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("words").isNotNull(), F.filter("lines", stays)).alias("kept"),
    )
    return some.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join("kept", "\n"), F.col("text")).alias("kept_text"),
    )


def line_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    # two aggregations and a join read the bitmaps; a table of their own has a known size
    bitmaps = materialise(keep_bitmaps(docs), "bitmaps")
    kept = apply_bitmaps(docs, bitmaps)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
