"""Byte-level BPE of whole texts through a cache of short pieces.

The split pattern of byte-level BPE never joins a character with a space that
follows it, so a text may be cut in front of a space whose neighbours are both
no white space, and each piece encoded alone. Pieces repeat, so their ids are
kept in a bounded cache per Python worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np

#: White space here holds all that the split pattern takes for white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces kept per Python worker; when full, the cache starts anew.
CACHE_PIECES = 400_000


def pieces(text: str) -> list[str]:
    """Cut ``text`` at spaces: the first piece, then pieces whose leading space is
    left out. A space beside other white space, or at the end, is no cut."""
    parts = text.split(" ")
    if all(parts) and not any(p[0].isspace() or p[-1].isspace() for p in parts):
        return parts
    return CUT.split(text)


class PieceCache:
    """``encode_new``: strings -> their ids as little-endian bytes."""

    def __init__(self, encode_new: Callable[[list[str]], Iterable[bytes]], limit: int = CACHE_PIECES):
        self.encode_new, self.limit, self.known = encode_new, limit, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, joined."""
        cut = [pieces(t) for t in texts]
        firsts = dict.fromkeys(c[0] for c in cut)  # at the start of a text: no leading space
        first_ids = dict(zip(firsts, self.encode_new(list(firsts)), strict=True))
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        new = list({p for c in cut for p in c[1:] if p not in known})
        known.update(zip(new, self.encode_new([" " + p for p in new]), strict=True))
        get = known.__getitem__
        return [first_ids[c[0]] + b"".join([get(p) for p in c[1:]]) for c in cut]


#: White space but the space. Beside a space it makes that space no cut.
_WHITE = [chr(i) for i in (*range(9, 14), *range(28, 32), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)]


def quick_pieces(text: str) -> list[str]:
    """The pieces of ``pieces``; a few searches of the whole text tell whether each space is a cut."""
    if "  " in text or text[:1] == " " or text[-1:] == " " or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _WHITE):
        return CUT.split(text)
    return text.split(" ")


class _Places(dict):
    """Pieces to rows of a ``PieceTable``; a new piece gets the next row and is noted."""

    def __init__(self, table: PieceTable, before: str):
        super().__init__()
        self.table, self.before = table, before

    def __missing__(self, piece: str) -> int:
        table = self.table
        row = self[piece] = table.rows
        table.rows += 1
        table.new.append(self.before + piece)
        return row


class PieceTable:
    """Ids of texts through a table of pieces: each distinct piece is encoded once (``encode_new``: strings -> id lists), its ids
    stand in one array, and a batch of texts is a single gather from it. When ``limit`` pieces are
    there, the table starts anew."""

    def __init__(self, encode_new: Callable[[list[str]], Iterable[list[int]]], dtype, limit: int = CACHE_PIECES):
        self.encode_new, self.dtype, self.limit = encode_new, np.dtype(dtype), limit
        self._start()

    def _start(self) -> None:
        self.rows, self.new = 0, []
        self.inside, self.first = _Places(self, " "), _Places(self, "")
        self.pool, self.starts, self.sizes = np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode_new(self) -> None:
        if not self.new:
            return
        ids = list(self.encode_new(self.new))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), self.dtype, int(sizes.sum()))
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes) - sizes))
        self.sizes, self.pool, self.new = np.concatenate((self.sizes, sizes)), np.concatenate((self.pool, flat)), []

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes."""
        ids, n = self.encode_joined(texts, 0)
        return [ids[b - k:b - 1].tobytes() for b, k in zip(np.cumsum(n).tolist(), n.tolist(), strict=True)]

    def encode_joined(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, one after the other, each followed by the id ``end``; the number of each text's, with it)."""
        if self.rows > self.limit:
            self._start()
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            cut = quick_pieces(t)
            counts[i] = len(cut)
            words += cut
        row = np.fromiter(map(self.inside.__getitem__, words), np.int64, len(words))
        at = np.cumsum(counts) - counts
        row[at] = [self.first[words[i]] for i in at.tolist()]  # at the start of a text: no leading space
        self._encode_new()
        size = self.sizes[row]
        per_text = (np.add.reduceat(size, at) if len(texts) else counts) + 1
        ends = np.cumsum(per_text) - 1
        size_all = size.copy()  # the end's place is left free behind each text's last piece
        last = at + counts - 1
        size_all[last] += 1
        first = np.cumsum(size_all) - size_all
        out = np.empty(int(per_text.sum()), self.dtype)
        inner = np.cumsum(size) - size
        steps = np.arange(int(size.sum()))
        out[np.repeat(first - inner, size) + steps] = self.pool[np.repeat(self.starts[row] - inner, size) + steps]
        out[ends] = end
        return out, per_text


def batches(rows: Iterable[tuple], size: Callable[[tuple], int], limit: int = 2**20) -> Iterable[list[tuple]]:
    """Rows in lists of about ``limit`` characters, so that temporaries stay small."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= limit:
            yield held
            held, n = [], 0
    if held:
        yield held
