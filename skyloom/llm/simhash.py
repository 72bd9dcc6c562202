"""SimHash near-duplicate detection with BK-trees.

Fingerprints that differ in at most two of 64 bits agree on at least two of four equal
blocks of bits. Each distinct fingerprint is therefore sent to six shards, one for each
choice of two blocks, named by the bits of those blocks; any two linked fingerprints
meet in a shard. A shard with more than ``largest`` fingerprints is cut in the same way
by the bits it has not used yet, twice at most, after which 8 free bits are left and
shards have no more than 256 members. Every shard so has a proven size.

Within a shard a BK-tree files each fingerprint under its parent by the Hamming distance
between them, and a search follows only the edges within the radius of its distance. The
tree is built where its queries are, since a shard holds both; nothing is broadcast. A
shard reports one link per member, to the first of its group there, not all pairs.

Defined cases: null, empty and blank texts have fingerprint zero, and are linked like
any other; texts are hashed whole, long ones in slices of bounded memory; equal rows share a group; rows without a doc_id
count for links and never name a group that has an id; an empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.components import connected_components
from skyloom.llm.encoding import text_slices
from skyloom.llm.memory import plain_task
from skyloom.session import materialise

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Bytes of a text that are hashed at once; bits are added up over the slices of a longer one.
SLICE = 1 << 18
#: The bytes that separate words.
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Fingerprints in a shard before it is cut further.
LARGEST = 256


class BKTree:
    """Integers by Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        node = 0
        while node != new:
            node = self.children[node].setdefault((value ^ self.values[node]).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Positions, in order of insertion, of the values at most ``radius`` away."""
        found, open_ = [], [0] if self.values else []
        while open_:
            node = open_.pop()
            away = (value ^ self.values[node]).bit_count()
            if away <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if away - radius <= edge <= away + radius:
                    open_.append(child)
        return found


def _bits(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Fingerprints of runs of hashes: bits set in over half of a run."""
    sizes = np.diff(np.concatenate([starts, [len(hashes)]]))
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _long_fingerprint(data: bytes, shingle: int, digest) -> int:
    """The fingerprint of one text from sums of bits, a slice of the text at a time."""
    ones, n, held, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(data):
        cut = _SPACE.search(data, at + SLICE)
        end = cut.start() if cut else len(data)
        found, at = held + data[at:end].split(), end
        if len(found) >= shingle:
            runs = map(b" ".join, zip(*(found[k:] for k in range(shingle)), strict=False))
            hashes = np.fromiter(map(digest, runs), np.uint64)
            ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            n += len(hashes)
            # the shingles that run into the next slice start with these
            found = found[len(found) - shingle + 1 :]
        held = found
    if not n:
        return digest(b" ".join(held)) if held else 0
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def text_key(text: Column) -> Column:
    """Names a text; null counts as empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp): SimHash of the word shingles, as a signed long."""

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def digest(data: bytes) -> int:
            return xxh64_intdigest(data, SEED)

        for batch in batches:
            for first, texts in text_slices(batch, size=1 << 20):
                hashes: list[np.ndarray] = []
                owners, starts, n = [], [], 0
                long_ones: dict[int, int] = {}
                for row, text in enumerate(texts):
                    # bytes fold A-Z and split at white space in the ASCII range only
                    data = (text or "").encode().lower()
                    if len(data) > SLICE:
                        long_ones[row] = _long_fingerprint(data, shingle, digest)
                        continue
                    found = data.split()
                    if not found:
                        continue
                    if len(found) <= shingle:
                        runs = [b" ".join(found)]
                    else:
                        runs = map(b" ".join, zip(*(found[k:] for k in range(shingle)), strict=False))
                    new = np.fromiter(map(digest, runs), np.uint64)
                    owners.append(row)
                    starts.append(n)
                    hashes.append(new)
                    n += len(new)
                fp = np.zeros(len(texts), np.uint64)
                if owners:
                    fp[owners] = _bits(np.concatenate(hashes), np.array(starts))
                for row, value in long_ones.items():
                    fp[row] = value
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(first, len(texts)),
                        "text_key": batch.column(2).slice(first, len(texts)),
                        "fp": pa.array(fp.view(np.int64)),
                    }
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_key(F.col("text")).alias("text_key"))
    return rows.mapInArrow(run, "doc_id long, text_key string, fp long")


def _masks(level: int, blocks: int, free: tuple[int, ...] = tuple(range(64)), fixed: int = 0):
    """Bits fixed by each route of choices, in the routes' order."""
    size = len(free) // blocks
    parts = [free[k * size : (k + 1) * size if k < blocks - 1 else None] for k in range(blocks)]
    found = []
    for chosen in combinations(range(blocks), 2):
        taken = [b for c in chosen for b in parts[c]]
        mask = fixed | sum(1 << b for b in taken)
        rest = tuple(b for b in free if b not in set(taken))
        found += _masks(level - 1, blocks, rest, mask) if level else [mask]
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _tree_links(radius: int):
    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        def links(members: list[int]) -> Iterator[tuple[int, int]]:
            tree, group = BKTree(), list(range(len(members)))

            def top(k: int) -> int:
                while group[k] != k:
                    group[k] = group[group[k]]
                    k = group[k]
                return k

            for k, value in enumerate(members):
                value &= (1 << 64) - 1
                for near in tree.within(value, radius):
                    a, b = top(near), top(k)
                    group[max(a, b)] = min(a, b)
                tree.add(value)
            for k, value in enumerate(members):
                if top(k) != k:
                    yield value, members[top(k)]

        held: list[int] = []
        shard = None
        for batch in batches:
            found = []
            for route, fixed, fp in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (route, fixed) != shard:
                    found.extend(links(held))
                    held, shard = [], (route, fixed)
                held.append(fp)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
            )
        found = list(links(held))
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())}
        )

    return run


def fingerprint_links(distinct: DataFrame, radius: int = MAX_BITS, largest: int = LARGEST) -> DataFrame:
    """Links (a, b) that tie together all distinct fingerprints (fp) within the radius."""
    if radius > 2:
        raise ValueError("two of four blocks agree only up to two differing bits")
    links = None
    rows = distinct.select("fp", F.lit(0).alias("route"))
    for level in range(3):
        masks = F.array(*[F.lit(_signed(m)) for m in _masks(level, 4)])
        routed = rows.select("fp", "route", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("choice"))
        routed = routed.select("fp", (F.col("route") * 6 + F.col("choice")).alias("route")).select(
            "fp", "route", F.col("fp").bitwiseAND(F.get(masks, "route")).alias("fixed")
        )
        sizes = routed.groupBy("route", "fixed").agg(F.count("*").alias("members")).where("members > 1")
        shared = materialise(routed.join(sizes, ["route", "fixed"]), "shards")
        most = largest if level < 2 else 1 << 62
        here = (
            shared.where(F.col("members") <= most)
            .select("route", "fixed", "fp")
            .repartition("route", "fixed")
            .sortWithinPartitions("route", "fixed", "fp")
            .mapInArrow(_tree_links(radius), "a long, b long")
        )
        links = here if links is None else links.unionByName(here)
        rows = shared.where(F.col("members") > most).select("fp", "route")
        if level == 2 or rows.isEmpty():
            break
    return links.distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id, component, text_key) of every document.

    ``component`` names a group even where none of its documents has an id.
    """
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    components = connected_components(fingerprint_links(distinct, max_bits))
    labelled = distinct.join(components, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(names, "component").select("fp", "component", "component_id")
    return prints.join(materialise(named, "groups"), "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "component",
        "text_key",
    )


def keep_one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The row with the smallest doc_id of each group; ids that are null come last."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")).alias("first")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("name")
    kept = groups.groupBy("component").agg(first).select("first.doc_id", "first.text_key")
    kept = materialise(kept.select(name, F.col("text_key").alias("key")), "kept")
    # the row in one column, so that no name of its own can clash
    rows = docs.select(whole_row(docs), name, text_key(F.col("text")).alias("key"))
    # the first of equal rows
    order = Window.partitionBy("name", "key").orderBy(F.lit(0))
    rows = rows.join(kept, ["name", "key"]).withColumn("n", F.row_number().over(order))
    return rows.where("n = 1").select("row.*")


def whole_row(docs: DataFrame) -> Column:
    """All columns of a frame as one, ``row``."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")
