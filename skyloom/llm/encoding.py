"""Encoding of texts with a byte-level BPE vocabulary, shared by several operators.

A text is cut into units that encode independently of each other, and a unit's
ids are kept, so a unit costs one dictionary lookup after its first sight.

Cutting: every piece the pattern finds starts with at most one space, so where no
white space stands before a space, each space starts a unit. A text in which some
white space precedes a space is cut by the pattern itself. A line feed without white
space on either side is a piece, so texts whose line feeds are all such are cut there too,
and words at the ends of lines are not units of their own. Marks and digits of ASCII are cut off
the words before them for the same reason.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import public_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Bytes that the units kept by one task may take, and characters of the longest unit kept.
KEPT_BYTES = 80 << 20
LONGEST_KEPT = 256
#: Bytes of an entry beside its text and ids: two objects and their places in a dictionary.
_ENTRY = 200
#: White space other than spaces and line feeds.
_RARE = list(map(chr, (9, *range(11, 14), *range(28, 32), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
             0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_STOPS = tuple(".,;:!?")
#: A Latin letter before a mark or digit of ASCII: a piece ends between them, whatever comes next.
_WORD_END = "([A-Za-zÀ-ÖØ-öø-ɏ])([!-@\\[-`{-~])"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in kept}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(256 + len(shown) - len(kept))
    return [shown[b] for b in range(256)]


class UnitEncoder:
    """Texts to ids; a subclass finds the ids of units."""

    def __init__(self, path: str = VOCABULARY, kept_bytes: int = KEPT_BYTES):
        import regex

        self.path = path
        self.kept_bytes = kept_bytes
        self.special: dict[str, int] = {}
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall

    def marked(self, text: str) -> str | None:
        """The text with a NUL between units; none where the pattern has to find the units."""
        if "\0" in text or any(token in text for token in self.special):
            return None
        white = [" ", "\n", *(c for c in _RARE if c in text)]
        if any(c + " " in text for c in white):
            return None
        marked = text.replace(" ", "\0 ")
        if "\n" in text and not any(c + "\n" in text or "\n" + c in text for c in white):
            marked = marked.replace("\n", "\0\n\0")
        return marked

    def units(self, text: str) -> list[str]:
        """The units of any text; special tokens are units of their own, found from left to right."""
        out, at = [], 0
        tokens = "|".join(map(re.escape, self.special)) or "(?!)"
        for found in re.finditer(tokens, text):
            out += [*self.pieces(text[at : found.start()]), found[0]]
            at = found.end()
        return out + self.pieces(text[at:])

    def cut(self, unit: str) -> list[str]:
        """The pieces of a unit; plain words, alone or before a stop, need no pattern."""
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha():
            return [unit]
        if word[-1:] in _STOPS and word[:-1].isalpha():
            return [unit[:-1], unit[-1]]
        return self.pieces(unit)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers; null counts as empty.

        The units of all texts are numbered first, so that each is looked up once a call.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        encoded, marked, rows = [b""] * len(texts), [], []
        for row, text in enumerate(texts):
            plain = self.marked(text) if text else None
            if plain is not None:
                marked.append(plain)
                rows.append(row)
            elif text:
                encoded[row] = b"".join(self.unit_ids(self.units(text)))
        if rows:
            whole = pa.array(marked, pa.large_string())
            units = pc.split_pattern(pc.replace_substring_regex(whole, _WORD_END, "\\1\0\\2"), "\0")
            numbered = units.values.dictionary_encode()
            found = self.unit_ids(numbered.dictionary.to_pylist())
            number = numbered.indices.to_numpy()
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            start = np.cumsum(size) - size
            ids = np.frombuffer(b"".join(found), "<u4")
            after = np.concatenate([[0], np.cumsum(size[number])])
            at = np.repeat(start[number] - after[:-1], size[number])
            at += np.arange(at.size)
            flat = ids[at]
            ends = after[np.asarray(units.offsets)]
            for row, first, last in zip(rows, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                encoded[row] = flat[first:last].tobytes()
        return encoded

    def unit_ids(self, units: list[str]) -> list[bytes]:
        """The ids of each unit; a subclass has its own way to find them."""
        raise NotImplementedError


class Known(dict):
    """What is known of a text, made by ``make`` where it is asked for the first time.

    Two generations that take about half of ``most`` bytes each: texts asked for again outlive
    the older. Texts of more than ``LONGEST_KEPT`` characters are made anew each time.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make = make
        self.most = most
        self.held = 0
        self.older: dict = {}

    def __missing__(self, key):
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= LONGEST_KEPT:
            self[key] = made
            self.held += _ENTRY + len(key) + len(made)
            if self.held > self.most // 2:
                self.older = self.copy()
                self.clear()
                self.held = 0
        return made


class LibraryEncoder(UnitEncoder):
    """Units are encoded by the tokenizers library; special tokens in a text are special."""

    def __init__(self, path: str = VOCABULARY, kept_bytes: int = 2 * KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(path, kept_bytes)
        tokenizer = Tokenizer.from_file(path)
        self.special = {t.content: k for k, t in tokenizer.get_added_tokens_decoder().items()}
        self.tokenize = tokenizer.model.tokenize
        self.shown = dict(enumerate(byte_characters()))
        self.known = Known(self._unit, kept_bytes)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            shown = piece.replace(" ", self.shown[32])
        else:
            shown = piece.encode().decode("latin-1").translate(self.shown)
        return little_endian([token.id for token in self.tokenize(shown)])

    def _unit(self, unit: str) -> bytes:
        if unit in self.special:
            return little_endian([self.special[unit]])
        pieces = self.cut(unit)
        if len(pieces) == 1:
            return self._piece(unit)
        return b"".join(map(self.known.__getitem__, pieces))

    def unit_ids(self, units):
        return list(map(self.known.__getitem__, units))


def little_endian(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers, lowest byte first."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def text_slices(batch, name: str = "text", rows: int = 2048, size: int = 4 << 20):
    """(first row, texts) of runs of a batch's rows with about ``size`` characters at most."""
    column = batch.column(batch.schema.get_field_index(name))
    first, texts, held = 0, [], 0
    for row in range(batch.num_rows):
        text = column[row].as_py()
        texts.append(text)
        held += len(text or "")
        if len(texts) >= rows or held >= size:
            yield first, texts
            first, texts, held = row + 1, [], 0
    if texts:
        yield first, texts
