"""Token ids of whole texts by a public word-level BPE vocabulary, batch by batch.

The vocabulary lower-cases, drops white space and never merges across the units
of its split pattern. So a text can be cut at white space and between an ASCII
letter, a digit and other ASCII characters, equal units are encoded once per
batch, and the ids of a text are the ids of its units in order. A cut is made
only where the split pattern surely ends a unit: next to an apostrophe (English
contractions) or to a character outside ASCII and Latin-1 letters (which can
compose with their neighbours, or be white space) nothing is cut, and such units
go through the library's whole encoder. Texts with a special token's string go
through it whole.

Units seen before are kept in a bounded store per Python worker.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

_SPACE, _LETTER, _DIGIT, _PUNCT, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[0x21:0x7F] = _PUNCT
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[ord("'")] = _OTHER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_PLAIN = re.compile("[a-zß-öø-ÿ]+|[!-&(-/:-@\\[-`{-~]+")
_DIGITS = re.compile("[0-9]+")
#: Units kept per worker; the store starts anew when full.
STORE = 500_000
#: Bytes of text encoded at a time.
CHUNK = 2 << 20


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class UnitEncoder:
    """Ids of text batches; one per worker and vocabulary file."""

    _made: dict[str, UnitEncoder] = {}

    @classmethod
    def of(cls, path: str) -> UnitEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._special = [t.content.encode() for t in self._whole.get_added_tokens_decoder().values()]
        self._letters = _byte_letters()
        self._store: dict[str, bytes] = {}

    def _unit(self, unit: str) -> bytes:
        low = unit if unit.isascii() else unit.lower()  # ASCII units come in lower case
        if _PLAIN.fullmatch(low):
            text = low if low.isascii() else "".join([self._letters[b] for b in low.encode()])
            ids = [t.id for t in self._model.tokenize(text)]
        elif _DIGITS.fullmatch(low):
            ids = [t.id for d in low for t in self._model.tokenize(d)]
        else:
            ids = self._whole.encode(unit, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _lookup(self, units: list[str]) -> list[bytes]:
        store, out = self._store, []
        for u in units:
            ids = store.get(u)
            if ids is None:
                if len(store) >= STORE:
                    store.clear()
                ids = store[u] = self._unit(u)
            out.append(ids)
        return out

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (uint32) of each UTF-8 text."""
        out: list[np.ndarray] = []
        part: list[bytes] = []
        size = 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= CHUNK:
                out += self._chunk(part)
                part, size = [], 0
        return out + (self._chunk(part) if part else [])

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        odd = {i for i, t in enumerate(texts) if any(s in t for s in self._special)}
        buf = np.frombuffer(b"".join(b"" if i in odd else t for i, t in enumerate(texts)), np.uint8)
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([0 if i in odd else len(t) for i, t in enumerate(texts)], out=begins[1:])
        ids, counts = self._ids(buf, begins)
        ends = np.cumsum(counts)
        cut = np.split(ids, ends[:-1])
        for i in odd:
            cut[i] = self.whole(texts[i].decode())
        return cut

    def _ids(self, buf: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(begins) - 1
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        kind = _CLASS[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]  # all but the two signs are letters
        kind[lead] = kind[lead + 1] = _LETTER
        a, b = kind[:-1], kind[1:]
        start = np.empty(len(buf), bool)
        start[0] = True
        # white space always cuts; other classes only where neither side is _OTHER
        start[1:] = (a != b) & ((a == _SPACE) | (b == _SPACE) | ((a != _OTHER) & (b != _OTHER)))
        start[begins[:-1][begins[:-1] < len(buf)]] = True
        at = np.flatnonzero(start)
        size = np.diff(np.append(at, len(buf)))
        real = kind[at] != _SPACE
        at, size = at[real], size[real]
        offsets = np.zeros(len(at) + 1, np.int32)
        np.cumsum(size, out=offsets[1:])
        # lower-casing waits for composition in units that may compose
        loose = np.zeros(len(at), bool)
        loose[np.searchsorted(at, np.flatnonzero(kind == _OTHER), "right") - 1] = True
        dense = buf[kind != _SPACE]
        dense = np.where(np.repeat(loose, size), dense, _LOWER[dense]) if loose.any() else _LOWER[dense]
        units = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(dense)).dictionary_encode()
        found = pa.array(self._lookup(units.dictionary.to_pylist()), pa.binary()).take(units.indices)
        ends = np.frombuffer(found.buffers()[1], np.int32, len(at) + 1)
        ids = np.frombuffer(found.buffers()[2], np.uint32, int(ends[-1]) >> 2)
        # units before each text's begin, then tokens before it
        return ids, np.diff(ends[np.searchsorted(at, begins)] >> 2)
