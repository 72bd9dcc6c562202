"""Benchmark decontamination with a positional inverted index.

The index is partitioned by documents: each shard holds, for every term, the sorted
positions of that term in the shard's documents. A frequent word's list is therefore
spread over all shards, and nothing is shuffled to build it. Positions run on over the
shard with a gap between documents, so no phrase crosses one.

A phrase is looked up from its rarest term in the shard: the list of that term, moved
back by the term's place in the phrase, gives candidate starts, and the candidates are
intersected with the other lists, rarer ones first, each moved by its own place. A
phrase with a term that has no list in the shard is dropped at once.

The benchmark is worked on in blocks of at most ``BLOCK_WORDS`` words (an item longer than
that is a block of its own). Documents are numbered once; with several blocks they are
written with their numbers first, so that all blocks share one numbering.

Defined cases: null and empty texts, in either table, have no words; items with fewer
words than a window are one window, items without words are none; repeated items and
documents each count; equal doc_ids are kept apart; an empty table gives an empty
result or clean documents; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.simhash import text_key
from skyloom.llm.memory import plain_task
from skyloom.session import materialise

WINDOW = 10
#: Words of the benchmark that are searched for in one pass.
BLOCK_WORDS = 2_000_000
#: Characters of documents in a shard of the index.
SHARD_CHARS = 8 << 20
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_INDEX = """rows array<long>, doc_ids array<long>, text_keys array<string>, lengths array<int>,
            terms array<int>, starts array<int>, postings binary"""


def words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and all characters beyond ASCII; A-Z folded."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """Lists of (item_id, words), each of a bounded number of words."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    for row in rows.toLocalIterator():
        found = words(row.text)
        if block and held + len(found) > block_words:
            yield block
            block, held = [], 0
        block.append((row.item_id, found))
        held += len(found)
    if block:
        yield block


class Phrases:
    """The distinct windows of a block of items, over term numbers."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.term: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        by_length: dict[int, dict[tuple, list[int]]] = {}
        for item, (_, found) in enumerate(items):
            ids = [self.term.setdefault(w, len(self.term)) for w in found]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(tuple(ids[k : k + size]), []).append(item)
        self.groups = [
            (size, np.array(list(seen), np.int32), [sorted(set(v)) for v in seen.values()])
            for size, seen in by_length.items()
        ]


def numbered(docs: DataFrame, with_key: bool = False) -> DataFrame:
    """(row, doc_id, text, text_key): ``row`` is a number that holds once this is written."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (text_key(F.col("text")) if with_key else F.lit(None).cast("string")).alias("text_key"),
    )


def build_index(source: DataFrame, vocabulary) -> DataFrame:
    """One row per shard: its ``numbered`` documents and the positions of each term of the vocabulary.

    ``vocabulary`` is a broadcast of {word: number}; words outside it can be in no
    match, they only take up a position.
    """

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        get = vocabulary.value.get
        rows, ids, keys, lengths, numbers, held = [], [], [], [], [], 0

        def shard():
            terms = np.concatenate([*numbers, np.zeros(0, np.int32)])
            place = np.flatnonzero(terms >= 0).astype(np.int32)
            order = np.argsort(terms[place], kind="stable")
            found, first = np.unique(terms[place][order], return_index=True)
            return pa.RecordBatch.from_pydict(
                {
                    "rows": pa.array([rows], pa.list_(pa.int64())),
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    "text_keys": pa.array([keys], pa.list_(pa.string())),
                    "lengths": pa.array([lengths], pa.list_(pa.int32())),
                    "terms": pa.array([found.astype(np.int32)], pa.list_(pa.int32())),
                    "starts": pa.array([first.astype(np.int32)], pa.list_(pa.int32())),
                    "postings": pa.array([place[order].astype("<i4").tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            texts = batch.column(2)
            for k, (row, doc_id, key) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True)):
                text = texts[k].as_py()
                found = words(text)
                rows.append(row)
                ids.append(doc_id)
                keys.append(key)
                lengths.append(len(found))
                numbers.append(np.array([get(w, -1) for w in found] + [-1], np.int32))
                held += len(text or "")
                if held >= SHARD_CHARS:
                    yield shard()
                    rows, ids, keys, lengths, numbers, held = [], [], [], [], [], 0
        if ids:
            yield shard()

    return source.mapInArrow(run, _INDEX)


class Shard:
    """One row of the index, ready for lookups."""

    def __init__(self, lengths, terms, starts, postings: bytes, n_terms: int):
        self.span = np.asarray(lengths, np.int64) + 1
        self.first = np.concatenate([[0], np.cumsum(self.span)])
        self.size = int(self.first[-1])
        self.postings = np.frombuffer(postings, "<i4").astype(np.int64)
        ends = np.concatenate([starts[1:], [len(self.postings)]]).astype(np.int64)
        self.start = np.zeros(n_terms, np.int64)
        self.count = np.zeros(n_terms, np.int64)
        self.start[terms] = starts
        self.count[terms] = ends - np.asarray(starts, np.int64)
        # (term, position) as one ascending key, for membership in a term's list
        owner = np.repeat(np.asarray(terms, np.int64), self.count[terms])
        self.keys = owner * self.size + self.postings

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All positions of the terms, and which entry of ``terms`` each belongs to."""
        count = self.count[terms]
        which = np.repeat(np.arange(len(terms)), count)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return self.postings[self.start[terms][which] + inside], which

    def holds(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, terms.astype(np.int64) * self.size + positions)
        at = np.minimum(at, len(self.keys) - 1)
        inside = (positions >= 0) & (positions < self.size)
        return inside & (self.keys[at] == terms.astype(np.int64) * self.size + positions)

    def phrase(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start position, window) of every exact occurrence."""
        counts = self.count[windows]
        possible = np.flatnonzero(counts.min(axis=1) > 0)
        if not possible.size:
            return np.zeros(0, np.int64), possible
        windows = windows[possible]
        rarity = np.argsort(counts[possible], axis=1, kind="stable")
        start, which = self.lists(windows[np.arange(len(windows)), rarity[:, 0]])
        start = start - rarity[which, 0]
        for k in range(1, windows.shape[1]):
            place = rarity[which, k]
            kept = self.holds(windows[which, place], start + place)
            start, which = start[kept], which[kept]
        return start, possible[which]

    def near(self, windows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of the rarest term, window) where all other terms lie within ``reach``."""
        counts = self.count[windows]
        possible = np.flatnonzero(counts.min(axis=1) > 0)
        if not possible.size:
            return np.zeros(0, np.int64), possible
        windows = windows[possible]
        rarity = np.argsort(counts[possible], axis=1, kind="stable")
        at, which = self.lists(windows[np.arange(len(windows)), rarity[:, 0]])
        doc = np.searchsorted(self.first, at, "right") - 1
        low = np.maximum(at - reach, self.first[doc])
        high = np.minimum(at + reach, self.first[doc + 1] - 1)
        for k in range(1, windows.shape[1]):
            term = windows[which, rarity[which, k]].astype(np.int64) * self.size
            kept = np.searchsorted(self.keys, term + low) < np.searchsorted(
                self.keys, term + high, "right"
            )
            at, which, low, high = at[kept], which[kept], low[kept], high[kept]
        return at, possible[which]


def search(index: DataFrame, phrases, reach: int | None = None) -> DataFrame:
    """Matches by document: (row, spans, items); spans are [first, end) in words.

    ``phrases`` is a broadcast of ``Phrases``. With ``reach`` a match is an occurrence
    of a window's rarest term that has all its other terms within so many words, in any
    order, and its span is that one word.
    """

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        wanted = phrases.value
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(
                    row["lengths"], np.array(row["terms"], np.int64), np.array(row["starts"], np.int64),
                    row["postings"], len(wanted.term),
                )
                spans: dict[int, set] = {}
                items: dict[int, set] = {}
                for size, windows, owners in wanted.groups:
                    if not len(shard.keys):
                        continue
                    if reach is None:
                        start, which = shard.phrase(windows)
                    else:
                        start, which = shard.near(windows, reach)
                        size = 1
                    doc = np.searchsorted(shard.first, start, "right") - 1
                    begin = start - shard.first[doc]
                    for d, b, w in zip(doc.tolist(), begin.tolist(), which.tolist(), strict=True):
                        spans.setdefault(d, set()).add((b, b + size))
                        items.setdefault(d, set()).update(owners[w])
                docs = sorted(spans)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([row["rows"][d] for d in docs], pa.int64()),
                        "spans": pa.array(
                            [[{"first": a, "end": b} for a, b in sorted(spans[d])] for d in docs],
                            pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])),
                        ),
                        "items": pa.array(
                            [[wanted.names[i] for i in sorted(items[d])] for d in docs],
                            pa.list_(pa.string()),
                        ),
                    }
                )

    return index.mapInArrow(
        run, "row long, spans array<struct<first: bigint, end: bigint>>, items array<string>"
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    reach: int | None = None,
    block_words: int = BLOCK_WORDS,
    with_key: bool = False,
) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items, contaminated) for every document.

    ``spans`` are the matched word ranges and ``items`` the ids of items with a match,
    sorted as strings, both empty for clean documents. ``with_key`` adds the document's
    ``text_key``, which tells apart texts that share a doc_id.
    """
    spark = docs.sparkSession
    source, sparse, everything = numbered(docs, with_key), None, None
    blocks = benchmark_blocks(benchmark, block_words)
    block, following = next(blocks, []), next(blocks, None)
    if following is not None:
        source = materialise(source, "numbered")
    while block is not None:
        phrases = Phrases(block, window)
        index = materialise(build_index(source, spark.sparkContext.broadcast(phrases.term)), "postings")
        matches = search(index, spark.sparkContext.broadcast(phrases), reach)
        sparse = matches if sparse is None else sparse.unionByName(matches)
        everything = everything or index
        block, following = following, next(blocks, None)
    sparse = sparse.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    listed = everything.select(F.explode(F.arrays_zip("rows", "doc_ids", "text_keys", "lengths")).alias("doc")).select(
        F.col("doc.rows").alias("row"),
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.text_keys").alias("text_key"),
        F.col("doc.lengths").alias("n_words"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("reach"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda s, x: F.struct(
            (s.hit + F.greatest(x.end - F.greatest(x.first, s.reach), F.lit(0))).alias("hit"),
            F.greatest(s.reach, x.end).alias("reach"),
        ),
        lambda s: s.hit,
    )
    return (
        listed.join(sparse.withColumn("n_hit", covered), "row", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("long"),
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", F.array().cast("array<struct<first: bigint, end: bigint>>")).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
            *(["text_key"] if with_key else []),
        )
    )


def contamination_digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )
