"""Removal of repeated byte strings by column-wise suffix sorting of a collection.

A byte goes when some string of ``length`` bytes that covers it starts at another place
too, in the same or another document. Strings never cross documents, and they are
judged on the input.

1. *Anchors.* In every string of that length the 32 bytes with the lowest hash (the
   last of equal ones) are its anchor. Equal strings have equal anchors at the same
   place, and neighbouring strings mostly share one, so about one anchor per 85 bytes
   stands for all strings: its *segment* is the bytes of the strings it stands for.
2. *Segments of anchors that occur again* are counted by a hash of their bytes; a bit map
   of bounded size of the repeated anchors keeps the rest from being sent, and its false
   positives are settled by the counts. A segment that occurs again is repeated as a
   whole. Counting is partial before the shuffle, so a passage that fills a third of all
   documents is one row with a count. The bytes are sent only of segments whose anchor
   has differing ones, once for each of these.
3. *Column-wise construction.* The differing segments of an anchor form a collection of
   short documents, aligned on the anchor. Each round inserts one symbol per document,
   from the last column to the first, and updates the order of the suffixes (stable by
   the new symbol, as in a positional Burrows-Wheeler transform) and the common
   prefixes of neighbours (one more than the least old value between them). A string
   is repeated where a common prefix reaches its length. Spark's sorted shuffle files
   are the sequential external files: a task reads anchors in order and holds the
   columns of a few thousand segments.
4. *Large collections.* An anchor with more than ``largest`` differing segments is cut
   into ranges of string starts, each gathered by the bytes that all its strings share,
   and again, until a range is a single start, where the collection has one segment.

Inserting column by column over whole documents would take as many rounds as the
longest document has bytes, each over the whole collection; segments bound it to 368.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` keep
all; equal rows remove each other; equal doc_ids are kept apart; texts of any length
are judged whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.memory import plain_task
from skyloom.session import materialise

LENGTH = 200
ANCHOR = 32
#: Differing segments of one anchor that are sorted in one task.
LARGEST = 2_000
#: Bits of the map of repeated anchors: sixteen for each, at most 2**MOST_BITS (64 MB).
MOST_BITS = 29
_CHUNK = 1 << 18
_ODD = [np.uint64(c) for c in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
    0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53,
)]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def find_anchors(data: np.ndarray, ends: list[int], length: int = LENGTH):
    """(hash, place, first start, last start) of the anchors of documents laid end to end.

    ``data`` has under 2**20 bytes; ``ends`` are the documents' ends in it.
    """
    if len(data) < length:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    word = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,)).copy()
    mixed = word[:-24] * _ODD[0]
    for k in (1, 2, 3):
        mixed += word[8 * k : len(word) - 24 + 8 * k] * _ODD[k]
    for odd, shift in ((_ODD[4], 32), (_ODD[5], 29)):
        mixed ^= mixed >> np.uint64(shift)
        mixed *= odd
    mixed ^= mixed >> np.uint64(32)
    low = np.uint64(0xFFFFF)
    # the low bits hold the place, later places lower, so the last of equal hashes wins
    packed = (mixed & ~low) | (low - np.arange(len(mixed), dtype=np.uint64))
    owner = (low - (_sliding_min(packed, length - ANCHOR + 1) & low)).astype(np.int64)
    begin = 0
    for end in ends:
        owner[max(begin, end - length + 1) : end] = -1
        begin = end
    edges = np.flatnonzero(np.diff(owner)) + 1
    first = np.concatenate([[0], edges])
    last = np.concatenate([edges, [len(owner)]]) - 1
    kept = owner[first] >= 0
    first, last = first[kept], last[kept]
    place = owner[first]
    return mixed[place], place, first, last


def _document_anchors(texts: list[bytes], length: int):
    """Yields (rows, offsets, data, anchors): anchors of runs of documents.

    ``rows`` and ``offsets`` give the document of each anchor and where ``data``'s
    copy of it begins. A document beyond a chunk is cut into overlapping pieces, so
    that each string is in exactly one of them.
    """
    pieces = []  # (row, where the piece begins in the document, bytes)
    held = 0
    for row, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), _CHUNK):
            piece = text[at : at + _CHUNK + length - 1]
            pieces.append((row, at, piece))
            held += len(piece)
            if held >= _CHUNK:
                yield _piece_anchors(pieces, length)
                pieces, held = [], 0
    if pieces:
        yield _piece_anchors(pieces, length)


def _piece_anchors(pieces, length):
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    ends = np.cumsum([len(p) for _, _, p in pieces])
    found = find_anchors(data, ends.tolist(), length)
    which = np.searchsorted(ends, found[1], "right")
    starts = np.concatenate([[0], ends[:-1]])
    rows = np.array([r for r, _, _ in pieces])[which]
    shift = np.array([at for _, at, _ in pieces])[which] - starts[which]
    return rows, shift, data, found


def _texts(batch, name: str) -> Iterator[tuple[int, list[bytes]]]:
    """UTF-8 bytes of a batch's texts, in runs of bounded size; null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    first, out, held = 0, [], 0
    for row in range(batch.num_rows):
        value = column[row].as_buffer() if column[row].is_valid else None
        out.append(value.to_pybytes() if value is not None else b"")
        held += len(out[-1])
        if held >= 8 * _CHUNK:
            yield first, out
            first, out, held = row + 1, [], 0
    if out:
        yield first, out


def repeated_anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(anchor): hashes of anchors that occur more than once."""

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for _, texts in _texts(batch, "text"):
                hashes = [a[3][0] for a in _document_anchors(texts, length)]
                if hashes:
                    anchor, n = np.unique(np.concatenate(hashes), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"anchor": anchor.view(np.int64), "n": n})

    counted = docs.select("text").mapInArrow(run, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places in the map: bits below the top ones, which are low in every anchor."""
    return ((hashes >> np.uint64(52 - bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _marked(mapped: tuple[np.ndarray, int], hashes: np.ndarray) -> np.ndarray:
    marks, bits = mapped
    slot = _slots(hashes, bits)
    return np.flatnonzero((marks[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)


def bit_map(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit map over ``bits`` bits of the hashes (one long column), and that number."""
    wanted = 16 * max(hashes.count(), 1)
    bits = min(max(16, (wanted - 1).bit_length()), MOST_BITS)
    size = 1 << 15

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = np.sort(_slots(np.asarray(batch.column(0)).view(np.uint64), bits))
            for chunk in np.unique(slot >> 15).tolist():
                a, b = np.searchsorted(slot, [chunk << 15, (chunk + 1) << 15])
                chunks.setdefault(chunk, np.zeros(size, bool))[slot[a:b] & (size - 1)] = True
        rows = {"chunk": pa.array(list(chunks), pa.int64())}
        rows["bits"] = pa.array([np.packbits(c).tobytes() for c in chunks.values()], pa.binary())
        yield pa.RecordBatch.from_pydict(rows)

    # a range of the map per task, so every chunk comes from one or two tasks
    parts = max(1, min(1 << (bits - 15), 64))
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 52 - bits).bitwiseAND((1 << bits) - 1)
    chunks = hashes.repartitionByRange(parts, slot).mapInArrow(run, "chunk long, bits binary")
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in chunks.toLocalIterator():
        at = row.chunk * (size >> 3)
        whole[at : at + (size >> 3)] |= np.frombuffer(bytes(row.bits), np.uint8)
    return whole, bits


def _segment_id(lead: int, content: bytes) -> int:
    return int.from_bytes(hashlib.md5(lead.to_bytes(4, "big") + content).digest()[:8], "big", signed=True)


def _place_hash(anchor: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """One hash of where a segment is; ``doc`` holds the first 8 bytes of a document's name."""
    mixed = (anchor ^ (doc * _ODD[4])) + place.astype(np.uint64) * _ODD[0]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _ODD[5]
    return mixed ^ (mixed >> np.uint64(29))


def _name(text: bytes) -> bytes:
    return hashlib.md5(text).digest()


def segments(docs: DataFrame, mapped, length: int = LENGTH) -> DataFrame:
    """(anchor, id, doc, place, lead, size): segments of anchors in the map.

    ``id`` is a hash of the bytes and of how many of them lead the anchor; with the
    anchor's own hash it names a segment by 128 bits.
    """

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            for _, texts in _texts(batch, "text"):
                name: dict[int, bytes] = {}
                for row, shift, data, (hashes, place, first, last) in _document_anchors(texts, length):
                    kept = _marked(mapped.value, hashes)
                    raw, ids = data.tobytes(), []
                    lead = place[kept] - first[kept]
                    for a, b, n in zip(first[kept].tolist(), last[kept].tolist(), lead.tolist(), strict=True):
                        ids.append(_segment_id(n, raw[a : b + length]))
                    for r in set(row[kept].tolist()).difference(name):
                        name[r] = _name(texts[r])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "anchor": pa.array(hashes[kept].view(np.int64)),
                            "id": pa.array(ids, pa.int64()),
                            "doc": pa.array([name[r] for r in row[kept].tolist()], pa.binary()),
                            "place": pa.array(place[kept] + shift[kept]),
                            "lead": pa.array(lead.astype(np.int32)),
                            "size": pa.array((last[kept] - first[kept] + length).astype(np.int32)),
                        }
                    )

    return docs.select("text").mapInArrow(
        run, "anchor long, id long, doc binary, place long, lead int, size int"
    )


def segment_bytes(docs: DataFrame, mapped, length: int = LENGTH) -> DataFrame:
    """(anchor, id, lead, content): the segments at the places in the map, and a few others."""

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            seen: set[tuple[int, int]] = set()
            for _, texts in _texts(batch, "text"):
                short = np.array([int.from_bytes(_name(t)[:8], "big") for t in texts], np.uint64)
                for row, shift, data, (hashes, place, first, last) in _document_anchors(texts, length):
                    kept = _marked(mapped.value, _place_hash(hashes, short[row], place + shift))
                    raw = data.tobytes()
                    rows: list[tuple] = []
                    for h, p, a, b in zip(
                        hashes.view(np.int64)[kept].tolist(), place[kept].tolist(),
                        first[kept].tolist(), last[kept].tolist(), strict=True,
                    ):
                        content = raw[a : b + length]
                        id_ = _segment_id(p - a, content)
                        if (h, id_) not in seen:
                            seen.add((h, id_))
                            rows.append((h, id_, p - a, content))
                    columns = list(zip(*rows, strict=True)) or [()] * 4
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        ["anchor", "id", "lead", "content"],
                    )

    return docs.select("text").mapInArrow(run, "anchor long, id long, lead int, content binary")


def _place_hashes(places: DataFrame) -> DataFrame:
    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            doc = [int.from_bytes(d[:8], "big") for d in batch.column(1).to_pylist()]
            anchor = np.asarray(batch.column(0)).view(np.uint64)
            hashes = _place_hash(anchor, np.array(doc, np.uint64), np.asarray(batch.column(2)))
            yield pa.RecordBatch.from_pydict({"at": pa.array(hashes.view(np.int64))})

    return places.select("anchor", "doc", "place").mapInArrow(run, "at long")


def insert_columns(group: np.ndarray, lead: np.ndarray, contents: list[bytes], length: int = LENGTH):
    """(first, end) of each segment's repeated part, about the anchor; (0, 0) for none.

    ``group`` numbers the collections, ascending. Strings of one collection are equal
    only at the same distance from the anchor, so the suffixes that one round inserts
    are ranked among each other.
    """
    n, reach = len(contents), int(lead.max())
    size = np.array([len(c) for c in contents])
    width = int((reach - lead + size).max())
    symbols = np.full((width, n), -1, np.int16)
    for k, content in enumerate(contents):
        at = reach - int(lead[k])
        symbols[at : at + len(content), k] = np.frombuffer(content, np.uint8)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)  # with the suffix before, in the current order
    low, high = np.full(n, width), np.full(n, -1)
    base = group.astype(np.int64) * 257 + 1
    for column in range(width - 1, -1, -1):
        inserted = symbols[column, order]
        rank = base[order] + inserted
        if np.any(rank[1:] < rank[:-1]):
            moved = np.argsort(rank, kind="stable")
            inserted, rank, order = inserted[moved], rank[moved], order[moved]
        else:
            moved = np.arange(n)
        near = np.flatnonzero((rank[1:] == rank[:-1]) & (inserted[1:] >= 0)) + 1
        updated = np.zeros(n + 1, np.int32)
        if near.size:
            between = np.empty(2 * near.size, np.int64)
            between[0::2], between[1::2] = moved[near - 1] + 1, moved[near] + 1
            updated[near] = 1 + np.minimum.reduceat(common, between)[0::2]
            hit = near[updated[near] >= length]
            for rows in (order[hit], order[hit - 1]):
                low[rows] = column
                high[rows] = np.maximum(high[rows], column)
        common = updated
    # all strings of a segment hold the anchor, so their union is one stretch
    found = high >= 0
    return np.where(found, low - reach, 0), np.where(found, high - reach + length, 0)


def _sorted_collections(length: int):
    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        held: list[tuple] = []

        def settle(rows):
            anchors = np.array([r[0] for r in rows], np.int64)
            group = np.cumsum(np.concatenate([[0], anchors[1:] != anchors[:-1]]))
            first, end = insert_columns(group, np.array([r[2] for r in rows]), [r[3] for r in rows], length)
            hit = np.flatnonzero(end > first)
            return pa.RecordBatch.from_pydict(
                {
                    "anchor": pa.array(anchors[hit]),
                    "id": pa.array([rows[k][1] for k in hit], pa.int64()),
                    "first": pa.array(first[hit].astype(np.int32)),
                    "end": pa.array(end[hit].astype(np.int32)),
                }
            )

        for batch in batches:
            held.extend(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            while len(held) > 2 * LARGEST:
                cut = 2 * LARGEST
                while cut and held[cut][0] == held[cut - 1][0]:
                    cut -= 1
                if not cut:
                    break
                yield settle(held[:cut])
                held = held[cut:]
        if held:
            yield settle(held)

    return run


_LEVEL = "anchor long, id long, root_anchor long, root_id long, n long, lead int, content binary"


def _narrowed(level: int, length: int):
    """Segments of a large collection, cut by ranges of string starts."""
    span = [43, 11, 3, 1][min(level, 3)]

    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa
        import xxhash

        names = [field.split()[0] for field in _LEVEL.split(", ")]
        kinds = (*[pa.int64()] * 5, pa.int32(), pa.binary())
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                lead, content = row["lead"], row["content"]
                # starts of its strings, counted from the earliest possible one
                origin = length - ANCHOR
                begin, stop = origin - lead, origin - lead + len(content) - length
                for part in range(begin // span, stop // span + 1):
                    a, b = max(begin, part * span), min(stop, part * span + span - 1)
                    inner = content[a - begin : b - begin + length]
                    shared = content[part * span + span - 1 - begin : part * span + length - begin]
                    key = b"%d,%d,%d," % (row["anchor"], level, part) + shared
                    out.append(
                        (
                            xxhash.xxh64_intdigest(key) - (1 << 63), _segment_id(origin - a, inner),
                            row["root_anchor"], row["root_id"], row["n"], origin - a, inner,
                        )
                    )
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def _sorted_segments(distinct: DataFrame, anchors: DataFrame, length: int) -> DataFrame:
    return (
        distinct.join(anchors, "anchor")
        .select("anchor", "id", "lead", "content")
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_sorted_collections(length), "anchor long, id long, first int, end int")
    )


def repeated_stretches(docs: DataFrame, length: int = LENGTH, largest: int = LARGEST) -> DataFrame:
    """(doc, stretches): repeated byte ranges by the MD5 of the text, sorted."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    docs = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    anchors = materialise(repeated_anchors(docs, length), "anchors")
    places = materialise(segments(docs, broadcast(bit_map(anchors)), length), "places")

    counted = places.groupBy("anchor", "id").agg(
        F.count("*").alias("n"),
        F.max("lead").alias("lead"),
        F.max("size").alias("size"),
        F.min(F.struct("doc", "place")).alias("at"),
    )
    counted = materialise(counted, "counted")
    mixed = counted.groupBy("anchor").agg(F.count("*").alias("differing")).where("differing > 1")
    differing = counted.join(mixed.select("anchor"), "anchor")
    differing = materialise(differing.select("anchor", "id", "n", "at.doc", "at.place"), "differing")
    bytes_ = segment_bytes(docs, broadcast(bit_map(materialise(_place_hashes(differing), "at"))), length)
    bytes_ = bytes_.groupBy("anchor", "id").agg(
        F.first("lead").alias("lead"), F.first("content").alias("content")
    )
    rows = differing.join(bytes_, ["anchor", "id"]).select(
        "anchor", "id", F.col("anchor").alias("root_anchor"), F.col("id").alias("root_id"), "n", "lead", "content"
    )
    rows = materialise(rows, "collections")

    # a segment that occurs again is repeated as a whole, whatever the sorting found of it
    found = counted.where("n > 1").select(
        F.col("anchor").alias("root_anchor"),
        F.col("id").alias("root_id"),
        (-F.col("lead")).alias("first"),
        (F.col("size") - F.col("lead")).alias("end"),
    )
    distinct = rows
    for level in range(5):
        sizes = distinct.groupBy("anchor").agg(F.count("*").alias("differing")).where("differing > 1")
        sizes = materialise(sizes, "sizes")
        small = sizes.where(F.col("differing") <= largest).select("anchor")
        large = sizes.where(F.col("differing") > largest).select("anchor")
        here = _sorted_segments(distinct, small, length)
        if level:
            here = here.union(
                distinct.where("n > 1").select(
                    "anchor",
                    "id",
                    (-F.col("lead")).alias("first"),
                    (F.length("content") - F.col("lead")).alias("end"),
                )
            )
        roots = rows.select("anchor", "id", "root_anchor", "root_id")
        found = found.union(
            roots.join(here, ["anchor", "id"]).select("root_anchor", "root_id", "first", "end")
        )
        if large.isEmpty():
            break
        rows = materialise(rows.join(large, "anchor").select(*rows.columns).mapInArrow(
            _narrowed(level, length), _LEVEL
        ), "narrowed")
        distinct = materialise(
            rows.groupBy("anchor", "id").agg(
                F.sum("n").alias("n"), F.first("lead").alias("lead"), F.first("content").alias("content")
            ),
            "collections",
        )
    # all strings of a segment hold its anchor, so their union is one stretch
    found = found.groupBy("root_anchor", "root_id").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    # written, so that the join deals out both sides anew and can split a segment of many places
    found = materialise(found.withColumnsRenamed({"root_anchor": "anchor", "root_id": "id"}), "found")
    stretches = places.select("anchor", "id", "doc", "place").join(found, ["anchor", "id"]).select(
        "doc", (F.col("place") + F.col("first")).alias("first"), (F.col("place") + F.col("end")).alias("end")
    )
    return (
        stretches.distinct()
        .groupBy("doc")
        .agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("stretches"))
    )


def _cut(rest: list[str], with_text: bool):
    @plain_task
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            stretches = batch.column(batch.schema.get_field_index("_stretches"))
            done = 0
            for first, texts in _texts(batch, "_text"):
                made: dict[str, list] = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "sha", "text")}
                for k, text in enumerate(texts):
                    kept, at, spans, removed = [], 0, 0, 0
                    for piece in stretches[first + k].as_py() or ():
                        a, b = piece["first"], piece["end"]
                        if b <= at:
                            continue
                        if a > at or not spans:
                            spans += 1
                            kept.append(text[at:a])
                        removed += b - max(a, at)
                        at = b
                    kept.append(text[at:])
                    left = b"".join(kept)
                    made["n_bytes"].append(len(text))
                    made["n_removed"].append(removed)
                    made["n_spans"].append(spans)
                    made["sha"].append(hashlib.sha256(left).hexdigest())
                    if with_text:
                        made["text"].append(left.decode("utf-8", "ignore"))
                columns = {n: batch.column(batch.schema.get_field_index(n)).slice(done, len(texts)) for n in rest}
                columns |= {n: pa.array(made[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")}
                columns["kept_sha256"] = pa.array(made["sha"], pa.string())
                if with_text:
                    columns["kept_text"] = pa.array(made["text"], pa.string())
                done += len(texts)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    with_text: bool = False,
    keep: list[str] | None = None,
    largest: int = LARGEST,
) -> DataFrame:
    """The columns ``keep`` (doc_id) with n_bytes, n_removed, n_spans and kept_sha256.

    With ``with_text`` also kept_text, the remaining bytes as text; a character that
    lost some of its bytes is left out there.
    """
    keep = keep or ["doc_id"]
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    found = repeated_stretches(docs, length, largest).select(
        F.col("doc").alias("_doc"), F.col("stretches").alias("_stretches")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text"), F.unhex(F.md5(text.cast("binary"))).alias("_doc"))
    rows = rows.join(found, "_doc", "left").select(*keep, "_text", "_stretches")
    schema = T.StructType(list(rows.select(*keep).schema.fields))
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, T.LongType())
    for name in ("kept_sha256", "kept_text") if with_text else ("kept_sha256",):
        schema = schema.add(name, T.StringType())
    return rows.mapInArrow(_cut(keep, with_text), schema)
