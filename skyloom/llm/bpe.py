"""BPE encoding and decoding by contiguous rank arrays.

A word is held as a row of part ids and, for each pair of adjacent parts, the rank
of their merge. The row is scanned for its lowest rank, the boundary there is
deleted, and the ranks of the two neighbouring pairs are looked up again, until no
pair can merge. Many short words are worked on at once, one row of a matrix each.
Words of more than ``SHORT`` bytes keep their parts in a linked list with a heap of
ranks, for scanning would take time with the square of their length.

Results equal the tokenizers library's for the same vocabulary file. Defined cases:
null and empty texts give no ids, and the digest of an empty string; a special token
in a text is its one id; texts of any length are encoded whole; equal rows give equal
results, one each; an empty table gives an empty result; other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.encoding import LONGEST_KEPT, VOCABULARY, UnitEncoder, byte_characters, text_slices
from skyloom.llm.memory import encoding_task, shared_encoder

SHORT = 64
#: Characters of texts that are encoded at once, and bytes that the units kept may take: several workers
#: share an executor with a heap that earlier stages have filled.
SLICE = 1 << 20
KEPT_BYTES = 48 << 20
_NONE = np.iinfo(np.int32).max


class MergeTable:
    """(left id, right id) to (rank, merged id), by open addressing, for whole arrays."""

    BITS = 18

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        self.key = np.full(1 << self.BITS, -1, np.int64)
        self.rank = np.full(1 << self.BITS, _NONE, np.int32)
        self.merged = np.zeros(1 << self.BITS, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist(), strict=True)):
            while self.key[slot] not in (-1, key):
                slot = (slot + 1) & ((1 << self.BITS) - 1)
            if self.key[slot] == -1:
                self.key[slot], self.rank[slot], self.merged[slot] = key, rank, merged[rank]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged ids; the rank of a pair that does not merge is the largest integer."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        slots = self._slots(keys)
        here = self.key[slots]
        open_ = np.flatnonzero((here != keys) & (here != -1))
        while open_.size:
            slots[open_] = (slots[open_] + 1) & ((1 << self.BITS) - 1)
            here = self.key[slots[open_]]
            open_ = open_[(here != keys[open_]) & (here != -1)]
        ranks = np.where(self.key[slots] == keys, self.rank[slots], _NONE)
        return ranks.reshape(left.shape), self.merged[slots].reshape(left.shape)


class RankArrayEncoder(UnitEncoder):
    """Encodes and decodes with a byte-level BPE vocabulary file."""

    def __init__(self, path: str = VOCABULARY, kept_bytes: int = KEPT_BYTES):
        super().__init__(path, kept_bytes)
        # two generations, as for the library's encoder
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        characters = byte_characters()
        self.table = MergeTable(
            [(vocabulary[a], vocabulary[b]) for a, b in merges],
            [vocabulary[a + b] for a, b in merges],
        )
        self.byte_ids = np.array([vocabulary[c] for c in characters], np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        back = {c: b for b, c in enumerate(characters)}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.token_bytes = [b""] * size
        for token, id_ in vocabulary.items():
            self.token_bytes[id_] = bytes(back[c] for c in token)
        for token, id_ in self.special.items():
            self.token_bytes[id_] = token.encode()
        self.decimal = [str(k) for k in range(size)]

    def unit_ids(self, units):
        known, older = self.known, self.older
        new = [u for u in set(units) if u not in known and u not in older]
        found = self.fill(new) if new else {}
        ids = [known.get(u) or older.get(u) or found.get(u, b"") for u in units]
        for unit, its_ids in zip(units, ids, strict=True):
            if unit not in known and len(unit) <= LONGEST_KEPT:
                known[unit] = its_ids
                self.held += len(unit) + len(its_ids) + 200
        if self.held > self.kept_bytes // 2:
            self.older, self.known, self.held = known, {}, 0
        return ids

    def fill(self, units) -> dict[str, bytes]:
        """Ids of units: the merges of all their new words are worked on at once."""
        cut = {unit: self.cut(unit) for unit in units if unit not in self.special}
        words = {piece.encode() for pieces in cut.values() for piece in pieces}
        ids = self.merge(words)
        found = {unit: b"".join([ids[p.encode()] for p in pieces]) for unit, pieces in cut.items()}
        for unit in units:
            if unit in self.special:
                found[unit] = np.array([self.special[unit]], "<u4").tobytes()
        return found

    def merge(self, words) -> dict[bytes, bytes]:
        """For each word (bytes) its ids as little-endian unsigned 32-bit integers."""
        ids: dict[bytes, bytes] = {}
        order = sorted((w for w in words if len(w) <= SHORT), key=len)
        for k in range(0, len(order), 8192):
            self._merge_rows(order[k : k + 8192], ids)
        for word in words:
            if len(word) > SHORT:
                ids[word] = self._merge_long(word)
        return ids

    def _merge_rows(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        width = len(words[-1])
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        parts = self.byte_ids[raw.reshape(len(words), width)]
        column = np.arange(max(width - 1, 1))
        ranks = np.full((len(words), max(width - 1, 1)), _NONE, np.int32)
        merged = np.zeros_like(ranks)
        if width > 1:
            found, ids = self.table.find(parts[:, :-1], parts[:, 1:])
            inside = column[None, :] + 1 < size[:, None]
            ranks, merged = np.where(inside, found, _NONE), ids
        alive = np.arange(len(words))
        while alive.size:
            rows = np.arange(alive.size)
            lowest = ranks.argmin(axis=1)
            done = ranks[rows, lowest] == _NONE
            if done.any():
                for row in np.flatnonzero(done):
                    into[words[alive[row]]] = parts[row, : size[row]].astype("<u4").tobytes()
                stay = ~done
                alive, parts, ranks, merged, size, lowest = (
                    a[stay] for a in (alive, parts, ranks, merged, size, lowest)
                )
                if not alive.size:
                    return
                width = int(size.max())
                parts, ranks, merged = parts[:, :width], ranks[:, : width - 1], merged[:, : width - 1]
                rows, column = np.arange(alive.size), np.arange(width - 1)
            parts[rows, lowest] = merged[rows, lowest]
            # the boundary after the part at `lowest` goes: what follows moves up by one
            source = np.arange(width)[None, :] + (np.arange(width)[None, :] > lowest[:, None])
            parts = np.take_along_axis(parts, np.minimum(source, width - 1), 1)
            source = column[None, :] + (column[None, :] >= lowest[:, None])
            last = source > width - 2
            source = np.minimum(source, width - 2)
            ranks = np.where(last, _NONE, np.take_along_axis(ranks, source, 1))
            merged = np.take_along_axis(merged, source, 1)
            size = size - 1
            for left in (lowest - 1, lowest):
                near = np.flatnonzero((left >= 0) & (left + 1 < size))
                at = left[near]
                ranks[near, at], merged[near, at] = self.table.find(
                    parts[near, at], parts[near, at + 1]
                )

    def _merge_long(self, word: bytes) -> bytes:
        parts = self.byte_ids[np.frombuffer(word, np.uint8)]
        found, ids = self.table.find(parts[:-1], parts[1:])
        part, n = parts.tolist(), len(parts)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(r), k, part[k], part[k + 1], int(ids[k])) for k, r in enumerate(found) if r != _NONE]
        heapq.heapify(heap)
        pair: dict[tuple[int, int], tuple[int, int]] = {}

        def push(k: int) -> None:
            if k >= 0 and following[k] < n:
                a, b = part[k], part[following[k]]
                if (a, b) not in pair:
                    rank, id_ = self.table.find(np.array([a]), np.array([b]))
                    pair[a, b] = int(rank[0]), int(id_[0])
                if pair[a, b][0] != _NONE:
                    heapq.heappush(heap, (pair[a, b][0], k, a, b, pair[a, b][1]))

        while heap:
            _, k, a, b, id_ = heapq.heappop(heap)
            after = following[k]
            if part[k] != a or after >= n or part[after] != b:
                continue
            part[k], part[after] = id_, -1
            following[k] = following[after]
            if following[k] < n:
                before[following[k]] = k
            push(before[k])
            push(k)
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids, decoded): every whole text's ids and what they decode to."""

    @encoding_task
    def run(batches: Iterator):
        import pyarrow as pa

        encoder = shared_encoder(RankArrayEncoder, path)
        for batch in batches:
            for first, texts in text_slices(batch, size=SLICE):
                ids = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(first, len(texts)),
                        "ids": pa.array(ids, pa.list_(pa.int32())),
                        "decoded": pa.array([encoder.decode(i) for i in ids], pa.string()),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, decoded string"
    )


def encoding_digests(docs: DataFrame, path: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if wanted, token_ids.

    The digests are taken where the ids are made, so neither ids nor texts leave
    the task unless asked for.
    """

    @encoding_task
    def run(batches: Iterator):
        import pyarrow as pa

        encoder = shared_encoder(RankArrayEncoder, path)
        decimal = encoder.decimal.__getitem__
        for batch in batches:
            for first, texts in text_slices(batch, size=SLICE):
                encoded = encoder.encode(texts)
                sizes = np.array([len(b) // 4 for b in encoded], np.int64)
                shown, decoded = [], []
                # Python's integers of one text at a time
                for packed in encoded:
                    ids = np.frombuffer(packed, "<u4").tolist()
                    shown.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(encoder.decode(ids).encode()).hexdigest())
                columns = {
                    "doc_id": batch.column(0).slice(first, len(texts)),
                    "n_tokens": pa.array(sizes),
                    "ids_sha256": pa.array(shown, pa.string()),
                    "decoded_sha256": pa.array(decoded, pa.string()),
                }
                if with_ids:
                    starts = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                    values = pa.array(np.frombuffer(b"".join(encoded), "<u4").view("<i4"))
                    columns["token_ids"] = pa.ListArray.from_arrays(starts, values)
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, schema + (", token_ids array<int>" if with_ids else "")
    )
