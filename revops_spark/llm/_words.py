"""Words of many texts at once, as numpy arrays: places, 64-bit hashes, pieces."""

from __future__ import annotations

import numpy as np
import xxhash

from ._shared import mixed

WORD, BLANK, BREAK = 0, 1, 2
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))   # A-Z only
LONG_WORD = 32            # bytes from which a word is hashed by itself
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)


def byte_kinds(blanks: bytes, breaks: bytes) -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(blanks)] = BLANK
    kinds[list(breaks)] = BREAK
    return kinds


def hashes(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice; `buffer` has 8 spare bytes at its end."""
    out = mixed(sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    eights = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    todo = np.flatnonzero(sizes <= LONG_WORD)
    at = 0
    while len(todo):
        left = sizes[todo] - at
        chunk = eights[starts[todo] + at]
        part = left < 8
        chunk[part] &= _TAIL[left[part]]
        out[todo] = mixed(out[todo] ^ chunk)
        at += 8
        todo = todo[left > 8]
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(buffer[starts[i]:starts[i] + sizes[i]].tobytes())
    return out


class Words:
    """The words of a list of texts, A-Z in lower case.

    `doc` is each word's text, `piece` changes where a break stands between
    two words or a text ends, `first` the first word of every text.
    """

    def __init__(self, texts: list[bytes], kinds: np.ndarray):
        joined = b"\n".join(texts).translate(LOWER)
        self.buffer = np.frombuffer(b"\n" + joined + b"\n" + bytes(8), np.uint8)
        kind = kinds[self.buffer]
        kind[0] = kind[-9] = BREAK
        kind[-8:] = BLANK
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        kind[ends] = BREAK                       # the line ends that join the texts
        inside = (kind == WORD).view(np.int8)
        edge = np.diff(inside)
        self.starts = np.flatnonzero(edge == 1) + 1
        self.sizes = np.flatnonzero(edge == -1) + 1 - self.starts
        breaks = np.flatnonzero(kind == BREAK)
        self.piece = np.searchsorted(breaks, self.starts)
        first = np.searchsorted(self.starts, np.concatenate(([0], ends)))
        self.first, counts = first[:-1], np.diff(first)
        self.counts = counts
        self.doc = np.repeat(np.arange(len(texts)), counts)
        self.hash = hashes(self.buffer, self.starts, self.sizes)

    def text(self, i: int) -> bytes:
        return self.buffer[self.starts[i]:self.starts[i] + self.sizes[i]].tobytes()


def by_size(rows, size, most: int):
    """Rows in lists of so many bytes (or one row, where that is longer)."""
    held, total = [], 0
    for row in rows:
        n = size(row)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held
