"""Token ids of whole text columns by a public tokenizer file, with equal pieces of text encoded once.

White space never joins a piece of one word to the next in these tokenizers, so a text is cut before every run of
white space and the pieces are encoded on their own. Most pieces repeat: each is encoded once per slice of rows, and a
bounded store keeps the ids of those met before. Texts with other than ASCII white space are encoded whole.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strata.llm.text import SPACE, SLICE_BYTES as HASH_BYTES, buffers, range_hashes

STORE_PIECES = 2_000_000
SLICE_BYTES = 4 << 20
JOIN_PIECES = 500
JOINS_AT_ONCE = 8
_OTHER_SPACE = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_OTHER_SPACE_RE2 = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, without special tokens added.

    The store maps a 64-bit hash of a piece to its ids. Pieces not in it are encoded many at a time, joined by a
    special token of the vocabulary: the tokenizer splits at it first, so neighbours can't touch each other.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(n, t.content) for n, t in self.tokenizer.get_added_tokens_decoder().items() if t.special]
        self.marks = [text for _, text in special]
        self.mark_id, self.mark = special[-1] if special else (-1, "")
        self._fresh()

    def _fresh(self) -> None:
        self.hashes, self.begins, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), 0

    def _one_by_one(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]

    def _fresh_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has."""
        if not self.mark or any(m in p for m in self.marks for p in ("\n".join(pieces),)):
            found = self._one_by_one(pieces)
            return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))
        joined = [self.mark.join([*pieces[k : k + JOIN_PIECES], ""]) for k in range(0, len(pieces), JOIN_PIECES)]
        ids = []
        for k in range(0, len(joined), JOINS_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(joined[k : k + JOINS_AT_ONCE], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint32) for e in found]
        ids = np.concatenate(ids)
        at = np.flatnonzero(ids == self.mark_id)
        return ids[ids != self.mark_id], np.diff(at, prepend=-1) - 1

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of different pieces begin, and how many each has."""
        hashes = piece_hashes(pieces)
        if len(self.hashes) + len(hashes) > STORE_PIECES:
            self._fresh()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        if new.any():
            ids, sizes = self._fresh_ids(pieces.filter(pa.array(new)).to_pylist())
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate((self.pool[: self.used], np.empty(len(ids) + self.used, self.pool.dtype)))
            self.pool[self.used : self.used + len(ids)] = ids
            begins = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
            every = np.concatenate((self.hashes, hashes[new]))
            order = np.argsort(every, kind="stable")
            self.hashes = every[order]
            self.begins = np.concatenate((self.begins, begins))[order]
            self.sizes = np.concatenate((self.sizes, sizes))[order]
            at = np.searchsorted(self.hashes, hashes)
        return self.begins[at], self.sizes[at]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row begins and ends in them; null counts as empty."""
        ids, counts, row = [], [], 0
        _, offsets = buffers(column)
        while row < len(column):
            end = max(int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1, row + 1)
            some, n = self._slice(column.slice(row, min(end, len(column)) - row))
            ids.append(some)
            counts.append(n)
            row = end
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), np.concatenate(([0], np.cumsum(counts)))

    def _slice(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = column.cast(pa.large_string())
        if pc.any(pc.match_substring_regex(column, _OTHER_SPACE_RE2)).as_py():
            return self._rows(column)
        data, offsets = buffers(column)
        space = SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        if len(bounds) < 2:
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        pieces = pa.LargeStringArray.from_buffers(
            len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        begins, sizes = self._distinct(pieces.dictionary)
        which = pieces.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n)
        take = np.repeat(begins[which] - (ends - n), n) + np.arange(ends[-1])
        at = np.concatenate(([0], ends))[np.searchsorted(bounds, offsets)]
        return self.pool[take].astype(np.uint32), np.diff(at)

    def _rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Row by row: whole where a text has other white space."""
        ids = []
        for text in column.to_pylist():
            whole = text and re.search(_OTHER_SPACE, text)
            ids.append(self._one_by_one([text])[0] if whole else self._slice(pa.array([text or ""]))[0])
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))


def piece_hashes(pieces: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string, case kept."""
    data, offsets = buffers(pieces)
    out = []
    row = 0
    while row < len(pieces):
        end = max(int(np.searchsorted(offsets, offsets[row] + HASH_BYTES, "right")) - 1, row + 1)
        end = min(end, len(pieces))
        out.append(range_hashes(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]))
        row = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder in each Python worker."""
    return Encoder(path)
