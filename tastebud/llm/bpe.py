"""Vectorised byte-level BPE encoding with a public tokenizer file.

The pre-tokenizer's pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.  Some byte positions are always a boundary of it whatever
surrounds them (a space before a solid character, an ASCII letter before an ASCII punctuation
mark, ...).  Texts are cut at those; the parts are looked up by hash in a sorted table of the
parts met so far (a second, independent hash must agree, else the block goes through the library
text by text), and only parts not met before go through the tokenizers library.  Parts that
are one pre-token go straight to its BPE model, others (and every text holding a special
token's string) through its whole pipeline.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np

from . import textops as tx

#: a worker forgets its table above this many parts (about 40 bytes each)
MAX_PARTS = 5_000_000

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
# lead bytes of white space beyond ASCII, and controls some engines call white space
_ODD = np.zeros(256, bool)
_ODD[[0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_SOLID = ~_WS & ~_ODD
# 1 letter, 2 digit, 3 other, 4 apostrophe; 0: not ASCII, white space or odd
_CLASS = np.full(256, 3, np.uint8)
_CLASS[128:] = 0
_CLASS[_WS | _ODD] = 0
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_CLASS[39] = 4


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions that begin a part: text starts and sure boundaries of the pattern."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    ws, solid, cls = _WS[data], _SOLID[data], _CLASS[data]
    last = np.zeros(n, bool)
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    last[ends - 1] = True
    next_solid = np.append(solid[1:], False) & ~last
    cut = ws & next_solid
    # white space after a solid ASCII byte; the byte after white space that doesn't stick to it
    cut[1:] |= ws[1:] & ~ws[:-1] & (data[:-1] < 0x80) & solid[:-1]
    cut[1:] |= solid[1:] & ws[:-1] & (data[:-1] != 32)
    a, b = cls[:-1], cls[1:]
    cut[1:] |= (a > 0) & (a < 4) & (b > 0) & (a != b) & ~((a == 3) & (b == 4))
    cut[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(cut)


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the others follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    for i, b in enumerate(x for x in range(256) if x not in table):
        table[b] = chr(256 + i)
    return table


class PartTable:
    """Sorted hashes of the parts met, and their ids in one pool."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.model = self.tok.model
        self.alphabet = _byte_chars()
        self.simple = re.compile(r" ?(?:[0-9]+|[!-&(-/:-@\[-`{-~]+)\Z")
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.second = np.zeros(0, np.uint64)  # another hash of the same parts
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)
        self.used = 0

    def encode_parts(self, parts: list[str]) -> list[list[int]]:
        out: list = [None] * len(parts)
        rest = []
        tokenize, simple, alphabet = self.model.tokenize, self.simple.match, self.alphabet
        for i, p in enumerate(parts):
            if (p[1:] if p[0] == " " else p).isalpha() or simple(p):
                out[i] = [t.id for t in tokenize(p.encode().decode("latin-1").translate(alphabet))]
            else:
                rest.append(i)
        if rest:
            for i, e in zip(rest, self.tok.encode_batch_fast([parts[i] for i in rest], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def add(self, keys: np.ndarray, second: np.ndarray, parts: list[str]) -> None:
        ids = self.encode_parts(parts)
        count = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((x for p in ids for x in p), np.uint32, int(count.sum()))
        if self.used + len(flat) > len(self.pool):
            bigger = np.zeros(max(1 << 16, 2 * (self.used + len(flat))), np.uint32)
            bigger[: self.used] = self.pool[: self.used]
            self.pool = bigger
        self.pool[self.used: self.used + len(flat)] = flat
        first = self.used + np.cumsum(count, dtype=np.int64) - count
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.second = np.insert(self.second, at, second)
        self.first = np.insert(self.first, at, first)
        self.count = np.insert(self.count, at, count)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block end to end, and how many each text has."""
        n = len(offsets) - 1
        starts = part_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(offsets, starts, side="right") - 1
        h, g = tx.digests(data, starts, ends, False, 3, 4)
        keys, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        second = g[sample]
        if len(self.keys) > MAX_PARTS:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        fresh = np.flatnonzero(~known)
        raw = data.tobytes()
        if (second[inverse] != g).any() or (self.second[at[known]] != second[known]).any():
            return self._one_by_one(raw, offsets)  # different parts under one hash
        if len(fresh):
            s, e = starts[sample[fresh]].tolist(), ends[sample[fresh]].tolist()
            self.add(keys[fresh], second[fresh], [raw[x:y].decode("utf-8", "replace") for x, y in zip(s, e)])
            at = np.searchsorted(self.keys, keys)
        count = self.count[at][inverse].astype(np.int64)
        first = self.first[at][inverse]
        stop = np.cumsum(count)
        ids = self.pool[np.repeat(first - (stop - count), count) + np.arange(int(stop[-1]))]
        per_text = np.bincount(row, weights=count, minlength=n).astype(np.int64)
        if any(s in raw for s in self.special):
            return self._with_special(raw, offsets, ids, per_text)
        return ids, per_text

    def _one_by_one(self, raw, offsets):
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        ids = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)

    def _with_special(self, raw, offsets, ids, per_text):
        at = np.concatenate([[0], np.cumsum(per_text)])
        out = []
        for i in range(len(per_text)):
            t = raw[offsets[i]: offsets[i + 1]]
            if any(s in t for s in self.special):
                out.append(np.array(self.tok.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32))
            else:
                out.append(ids[at[i]: at[i + 1]])
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)


def table_for(path: str) -> PartTable:
    """The table of this Python worker; it outlives a task, as workers do."""
    kept = sys.modules.setdefault("_tastebud_part_tables", types.ModuleType("_tastebud_part_tables"))
    if path not in kept.__dict__:
        kept.__dict__[path] = PartTable(path)
    return kept.__dict__[path]
