"""Merkle manifest of a dataset, kept in a van Emde Boas layout.

Every row is a leaf. The leaves of one source form a tree in which runs of ``FANOUT``
nodes have one parent; the roots of the sources form a tree of the same kind above.

A tree is cut into aligned subtrees of at most ``HEIGHT`` levels above their lowest nodes.
Each subtree is a block: one binary value that holds its digests in van Emde Boas order, a
subtree of half the levels first and the subtrees that hang below it after it, each laid
out in the same way. The address of a node follows from its depth and number by
arithmetic, so building a block and finding siblings need no pointers. The roots of
blocks are the lowest nodes of the next tier of blocks, until a tree has one block.

1. Leaves are hashed from the rows and written; texts are never shuffled. They are
   partitioned by range of (source, doc_id, leaf), and each partition numbers its own; sizes
   of the earlier partitions add what is missing to the position in the source. A large
   source is thus spread over partitions and then over blocks.
2. Tiers of blocks are built upwards and written, the manifest.
3. Paths go downwards: a block's root has a path of siblings, its lowest nodes have that
   path behind their own siblings inside the block.

Defined cases: a null value is ``-`` in a leaf, an empty text is ``0:``; texts are hashed whole;
rows without a source are a source of their own, before all others; in a source, rows without a doc_id
come first and rows of one doc_id follow in the order of their leaves; equal rows are
leaves side by side, each with its own proof; an empty table gives an empty result;
further columns are ignored, whatever their names, and enter no leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.ascii import fold_ascii
from skyloom.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
#: Levels of a block above its lowest nodes: 16^3 of these.
HEIGHT = 3
DIGEST = 32
_PATH = "array<struct<left: binary, right: binary>>"


def _sha(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def subtree_size(levels: int) -> int:
    """Nodes of a full subtree with this many levels of nodes."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def addresses(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Places of the nodes at a depth, counted from the root, in a subtree of ``levels`` levels."""
    place = np.zeros_like(number)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = FANOUT ** (depth - top)
        place = place + subtree_size(top) + (number // below) * subtree_size(levels - top)
        number, depth, levels = number % below, depth - top, levels - top
    return place


@cache
def _level_addresses(height: int, level: int) -> np.ndarray:
    """Places of all nodes ``level`` levels above the lowest of a block."""
    depth = height - level
    return addresses(height + 1, depth, np.arange(FANOUT**depth, dtype=np.int64))


def levels_of(n: int, most: int = HEIGHT) -> int:
    """Levels of a block above its lowest nodes, for a tree that has n of these."""
    height, reach = 0, 1
    while reach < n and height < most:
        height, reach = height + 1, reach * FANOUT
    return height


class Block:
    """A subtree: digests by level, in one array in van Emde Boas order."""

    def __init__(self, height: int, counts: list[int], nodes: np.ndarray):
        self.height, self.counts, self.nodes = height, counts, nodes
        self.texts: dict[tuple[int, int], list[bytes]] = {}

    @staticmethod
    def sizes(n: int, height: int) -> list[int]:
        """Nodes of each level, lowest first."""
        counts = [n]
        for _ in range(height):
            counts.append(-(-counts[-1] // FANOUT))
        return counts

    @classmethod
    def build(cls, digests: list[bytes], height: int) -> Block:
        counts = cls.sizes(len(digests), height)
        nodes = np.zeros((subtree_size(height + 1), DIGEST), np.uint8)
        level = digests
        for k, count in enumerate(counts):
            if k:
                names = [d.hex().encode() for d in level]
                level = [_sha(b"".join(names[at : at + FANOUT])) for at in range(0, len(names), FANOUT)]
            nodes[_level_addresses(height, k)[:count]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        return cls(height, counts, nodes)

    @classmethod
    def stored(cls, n: int, height: int, nodes: bytes) -> Block:
        return cls(height, cls.sizes(n, height), np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST))

    def run(self, level: int, number: int) -> list[bytes]:
        """The digests, as hex text, of the run with this number on a level."""
        if (level, number) not in self.texts:
            first = number * FANOUT
            last = min(first + FANOUT, self.counts[level])
            found = self.nodes[_level_addresses(self.height, level)[first:last]]
            self.texts[level, number] = [d.tobytes().hex().encode() for d in found]
        return self.texts[level, number]

    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def siblings(self, number: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of a lowest node and of its ancestors, lowest first, as hex text."""
        found = []
        for level in range(self.height):
            run = self.run(level, number // FANOUT)
            at = number % FANOUT
            found.append((b"".join(run[:at]), b"".join(run[at + 1 :])))
            number //= FANOUT
        return found


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a lowest node and its siblings give."""
    for left, right in path:
        digest = _sha(left + digest.hex().encode() + right)
    return digest


def _framed(value: Column) -> Column:
    """The value's length in bytes, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(framed, F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[_framed(fields[name]) for name in FIELDS]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, tampered, row): ``tampered`` where the row is due to be tampered with."""
    fields = {name: F.col(name) for name in FIELDS}
    due = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = leaf({**fields, "text": fold_ascii(F.col("text"))})
    return docs.select(
        "doc_id",
        # orders like the source, and sets no source apart from any text
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
        leaf(fields).alias("digest"),
        F.when(due, changed).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with pos, the place within its tree by ``order``, and n, the size of the tree.

    The rows should be unique by ``order`` and read from a table.
    """
    names = [c for c in rows.columns if c != "tree"]

    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            here = []
            for tree in batch.column(0).to_pylist():
                held = held + 1 if tree == last else 0
                last = tree
                here.append(held)
            columns = dict(zip(["tree", *names], batch.columns, strict=True))
            yield pa.RecordBatch.from_pydict(
                columns
                | {"part": pa.array([part] * batch.num_rows, pa.int32()), "at": pa.array(here, pa.int64())}
            )

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["tree", *names])
    dealt = rows.select("tree", *names).repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    numbered = materialise(dealt.mapInArrow(run, f"{schema}, part int, at long"), "numbered")
    # a row for each tree and partition: as many as there are partitions and trees
    sizes = numbered.groupBy("tree", "part").agg(F.count("*").alias("size"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "tree",
        "part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"),
        F.sum("size").over(whole).alias("n"),
    )
    return numbered.join(sizes, ["tree", "part"]).select(
        "tree", *names, (F.col("before") + F.col("at")).alias("pos"), "n"
    )


class Forest:
    """Trees over ranked lowest nodes (tree, pos, n, digest), as tiers of blocks.

    Each tier is a table (tree, block, n, n_block, nodes, root): ``n`` lowest nodes in the tree's
    tier, ``n_block`` of them in the block.
    """

    def __init__(self, rows: DataFrame, height: int = HEIGHT):
        self.height = height
        self.reach = FANOUT**height
        self.tiers: list[DataFrame] = []
        rows = rows.select("tree", "pos", "n", "digest")
        while True:
            tier = materialise(self._blocks(rows), f"tier{len(self.tiers)}")
            self.tiers.append(tier)
            rows = tier.where(F.col("n") > self.reach).select(
                "tree",
                F.col("block").alias("pos"),
                F.ceil(F.col("n") / self.reach).cast("long").alias("n"),
                F.col("root").alias("digest"),
            )
            if rows.isEmpty():
                break

    def _block(self) -> Column:
        return F.floor(F.col("pos") / self.reach).cast("long")

    def _blocks(self, rows: DataFrame) -> DataFrame:
        height = self.height

        def run(batches: Iterator):
            import pyarrow as pa

            def made(held: list[bytes], key) -> list:
                tree, block, n = key
                built = Block.build(held, levels_of(n, height))
                return [tree, block, n, len(held), built.nodes.tobytes(), built.root()]

            def batch_of(found: list):
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
                names = ("tree", "block", "n", "n_block", "nodes", "root")
                columns = zip(*found, strict=True) if found else [[]] * len(names)
                return pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names
                )

            key, held, found = None, [], []
            for batch in batches:
                columns = [batch.column(k).to_pylist() for k in range(4)]
                for tree, block, n, digest in zip(*columns, strict=True):
                    if (tree, block, n) != key:
                        if held:
                            found.append(made(held, key))
                        key, held = (tree, block, n), []
                        if len(found) >= 64:
                            yield batch_of(found)
                            found = []
                    held.append(digest)
            if held:
                found.append(made(held, key))
            yield batch_of(found)

        dealt = rows.withColumn("block", self._block()).repartition("tree", "block")
        dealt = dealt.sortWithinPartitions("tree", "block", "pos").select("tree", "block", "n", "digest")
        schema = "tree string, block long, n long, n_block long, nodes binary, root binary"
        return dealt.mapInArrow(run, schema)

    def roots(self) -> DataFrame:
        """(tree, digest): the root of each tree."""
        found = None
        for tier in self.tiers:
            here = tier.where(F.col("n") <= self.reach).select("tree", F.col("root").alias("digest"))
            found = here if found is None else found.unionByName(here)
        return found

    def block_paths(self, above: DataFrame) -> DataFrame:
        """The lowest tier with (path, subroot, top): siblings above each block's root.

        ``above`` has (tree, path, subroot, top) for the root of each tree.
        """
        known = None
        for tier in reversed(self.tiers):
            last = tier.where(F.col("n") <= self.reach).join(above, "tree")
            if known is not None:
                upper = known.select("tree", F.col("pos").alias("block"), "path", "subroot", "top")
                last = last.unionByName(tier.where(F.col("n") > self.reach).join(upper, ["tree", "block"]))
            if tier is self.tiers[0]:
                return last
            known = materialise(self._node_paths(last), "paths")
        raise AssertionError("a forest has a tier")

    def _node_paths(self, blocks: DataFrame) -> DataFrame:
        """(tree, pos, path, subroot, top) of the lowest nodes of a tier's blocks."""
        height, reach = self.height, self.reach

        def run(batches: Iterator):
            import pyarrow as pa

            kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block.stored(row["n_block"], levels_of(row["n"], height), row["nodes"])
                    above = row["path"]
                    paths = [
                        [{"left": a, "right": b} for a, b in block.siblings(k)] + above
                        for k in range(row["n_block"])
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "tree": pa.array([row["tree"]] * len(paths), pa.string()),
                            "pos": pa.array(range(row["block"] * reach, row["block"] * reach + len(paths)), pa.int64()),
                            "path": pa.array(paths, kind),
                            "subroot": pa.array([row["subroot"]] * len(paths), pa.binary()),
                            "top": pa.array([row["top"]] * len(paths), pa.binary()),
                        }
                    )

        wanted = blocks.select("tree", "block", "n", "n_block", "nodes", "path", "subroot", "top")
        return wanted.mapInArrow(run, f"tree string, pos long, path {_PATH}, subroot binary, top binary")


def proofs(nodes: DataFrame, forest: Forest, above: DataFrame) -> DataFrame:
    """Every leaf with its proof and the root that it, or its tampered form, folds to."""
    height = forest.height
    blocks = forest.block_paths(above).select(
        "tree", "block", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pos"), "n", "n_block",
        "nodes", "path", "subroot", "top",
    )
    rows = nodes.select(
        "tree", forest._block().alias("block"), F.lit(1).alias("kind"), "pos", "doc_id", "digest", "tampered"
    )
    kind = dict(nodes.dtypes)["doc_id"]
    # a block comes before its leaves
    dealt = blocks.unionByName(rows, allowMissingColumns=True).repartition("tree", "block")
    dealt = dealt.sortWithinPartitions("tree", "block", "kind", "pos")

    def run(batches: Iterator):
        import pyarrow as pa

        block, path, first = None, [], 0
        subroot = top = b""
        names = ("n", "n_block", "nodes", "path", "subroot", "top", "block")
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")}
            of = {c: batch.column(batch.schema.get_field_index(c)) for c in names}
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist()
                       for c in ("kind", "pos", "doc_id", "digest", "tampered")]
            for at, (what, pos, doc_id, digest, tampered) in enumerate(zip(*columns, strict=True)):
                if what == 0:
                    row = {c: of[c][at].as_py() for c in names}
                    block = Block.stored(row["n_block"], levels_of(row["n"], height), row["nodes"])
                    path = [(p["left"], p["right"]) for p in row["path"]]
                    first = row["block"] * forest_reach
                    subroot, top = row["subroot"].hex(), row["top"].hex()
                    continue
                here = block.siblings(pos - first) + path
                out["doc_id"].append(doc_id)
                out["leaf"].append(digest.hex())
                out["subroot"].append(subroot)
                out["root"].append(top)
                out["proof_sha256"].append(_sha(b"".join(x for pair in here for x in pair)).hex())
                out["folded_root"].append(fold(tampered or digest, here).hex())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out.pop("doc_id"), of_id), *(pa.array(v, pa.string()) for v in out.values())],
                ["doc_id", *out],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    of_id, forest_reach = to_arrow_type(nodes.schema["doc_id"].dataType), forest.reach
    texts = ", ".join(f"{c} string" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))
    found = dealt.mapInArrow(run, f"doc_id {kind}, {texts}")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def build_manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, Forest, DataFrame, Forest]:
    """Ranked leaves, the forest of sources, the ranked roots of sources, and the tree above."""
    nodes = materialise(ranked(materialise(leaves(docs), "leaves"), ["doc_id", "digest", "row"]), "ranked")
    sources = Forest(nodes, height)
    roots = sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    tops = materialise(ranked(materialise(roots, "roots"), ["of"]), "ranked")
    return nodes, sources, tops, Forest(tops, height)


def merkle_proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    nodes, sources, tops, dataset = build_manifest(docs, height)
    no_path = F.array().cast(_PATH)
    above = dataset.roots().select(
        "tree", no_path.alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("top")
    )
    of_sources = dataset._node_paths(dataset.block_paths(above))
    named = tops.select("pos", F.col("of").alias("tree"), "digest")
    above = of_sources.drop("tree", "subroot").join(named, "pos").select(
        "tree", "path", F.col("digest").alias("subroot"), "top"
    )
    return proofs(nodes, sources, materialise(above, "paths"))
