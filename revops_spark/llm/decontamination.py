"""Benchmark decontamination by SimHash over item-sized windows.

1. Words are runs of non-white-space after ASCII lower-casing and turning
   ASCII punctuation to spaces; shingles are five words.
2. For every benchmark item, each window of a document with as many words as
   the item gets a SimHash of its shingles. Windows without a single
   benchmark shingle are left out: their similarity with every item is zero.
3. A multi-index over the items' fingerprints cuts 64 bits into eight blocks
   of a byte. Fingerprints within `radius` bits agree in some block up to
   radius // 8 bits, so a table per block, holding each byte's items within
   that distance, finds all of them.
4. A candidate counts if its weighted shingle similarity with the item (sum of
   the smaller counts over sum of the larger ones) is at least `threshold`.

At similarity 0.8 a window shares at least 8 of 9 of its shingles with the
item, which puts fingerprints about 10 of 64 bits apart; the default radius 23
is over four standard deviations beyond.

The benchmark is a query set: it is held against all documents in blocks of at
most `block_items` items, one narrow scan each, so nothing that grows without
bound is sent out and no document is shuffled.

Results for odd input: a null or empty text is clean; items without words (or
null) match nothing; items of fewer than five words are one shingle; a document
shorter than an item is one window; repeated rows are judged alike; items that
share an id are items of their own; an empty benchmark leaves all clean; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as sh

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23
BLOCK_ITEMS = 20_000
BASE = 0x9FB21C651E98DF25
_FOLD = bytes(32 if 33 <= b < 127 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b
              for b in range(256))
_TABLE_BITS = 22


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, 5)
        return value


def word_hashes(text: str | None, hashes: _WordHashes) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def shingles(symbols: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-word shingles; all words as one if there are fewer."""
    if not len(symbols):
        return symbols
    return sh.Rolling(symbols, BASE).all_windows(min(k, len(symbols)))


def signs(shingle_hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 per bit of each shingle hash."""
    bits = np.unpackbits(shingle_hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def folded(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from the sums of signs, eight bytes each."""
    return np.packbits(sums > 0, axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    ka, na = np.unique(a, return_counts=True)
    kb, nb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = np.minimum(na[ia], nb[ib]).sum()
    return float(both / (len(a) + len(b) - both)) if len(a) + len(b) else 0.0


class Items:
    """Benchmark items: shingles, fingerprints and the multi-index."""

    def __init__(self, rows: list[tuple[int, str | None]], radius: int):
        hashes = _WordHashes()
        kept = [(i, w) for i, w in ((i, word_hashes(t, hashes)) for i, t in rows) if len(w)]
        self.ids = [i for i, _ in kept]
        self.words = np.array([len(w) for _, w in kept], np.int64)
        self.shingles = [shingles(w) for _, w in kept]
        self.prints = (np.concatenate([folded(signs(s).sum(0, keepdims=True))
                                       for s in self.shingles])
                       if kept else np.zeros((0, 8), np.uint8))
        self.radius = radius
        self.by_size = {int(n): np.flatnonzero(self.words == n) for n in np.unique(self.words)}
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None]
                                ^ np.arange(256, dtype=np.uint8)) <= radius // 8
        # per item size: table [block, byte] -> mask over the items of that size
        self.index = {n: np.stack([near[:, self.prints[items, j]] for j in range(8)])
                      for n, items in self.by_size.items()}
        # shingle -> sizes of the items that have it, by shingle length
        self.lookup: dict[int, tuple] = {}
        for k in sorted({min(SHINGLE, int(n)) for n in self.by_size}):
            of = [i for i in range(len(kept)) if min(SHINGLE, int(self.words[i])) == k]
            pairs = np.unique(np.stack((
                np.concatenate([self.shingles[i] for i in of]),
                np.concatenate([np.full(len(self.shingles[i]), self.words[i], np.uint64)
                                for i in of]))), axis=1)
            keys, first = np.unique(pairs[0], return_index=True)
            bitmap = np.zeros(1 << _TABLE_BITS, bool)
            bitmap[keys >> np.uint64(64 - _TABLE_BITS)] = True
            self.lookup[k] = (keys, np.append(first, pairs.shape[1]), pairs[1].astype(np.int64),
                              bitmap)

    def hits(self, found: np.ndarray, k: int) -> dict[int, np.ndarray]:
        """Per item size: the positions whose shingle an item of that size has."""
        keys, first, sizes, bitmap = self.lookup[k]
        at = np.flatnonzero(bitmap[found >> np.uint64(64 - _TABLE_BITS)])
        if not len(at):
            return {}
        g = np.minimum(np.searchsorted(keys, found[at]), len(keys) - 1)
        at, g = at[keys[g] == found[at]], g[keys[g] == found[at]]
        n = first[g + 1] - first[g]
        pos = np.repeat(at, n)
        size = sizes[np.repeat(first[g] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
                     + np.arange(n.sum())] if len(n) else np.zeros(0, np.int64)
        return {int(s): pos[size == s] for s in np.unique(size)}

    def matches(self, symbols: np.ndarray, threshold: float) -> list[tuple]:
        """(item id, first word, words, bits apart, similarity): the best window per item."""
        out = []
        n_words = len(symbols)
        if not n_words:
            return out
        for k in self.lookup:
            if n_words < k:
                continue
            found = sh.Rolling(symbols, BASE).all_windows(k)
            for size, pos in self.hits(found, k).items():
                out += self._matches(found, pos, n_words, size, k, threshold)
        return out

    def _matches(self, found, pos, n_words, size, k, threshold):
        width = min(size, n_words) - k + 1              # shingles in a window
        last = max(0, n_words - size)                   # last window start
        edge = np.zeros(last + 2, np.int64)
        np.add.at(edge, np.maximum(0, pos - width + 1), 1)
        np.add.at(edge, np.minimum(last, pos) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        best: dict[int, tuple] = {}
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > width) + 1):
            for at in range(0, len(run), 16_384):       # bounds the sign sums' memory
                part = run[at:at + 16_384]
                a, b = part[0], part[-1] + width
                sums = np.zeros((b - a + 1, 64), np.int32)
                np.cumsum(signs(found[a:b]), axis=0, out=sums[1:])
                prints = folded(sums[part - a + width] - sums[part - a])
                self._check(found, part, prints, width, size, threshold, best)
        return [(self.ids[i], s, min(size, n_words), d, v) for i, (v, s, d) in best.items()]

    def _check(self, found, starts, prints, width, size, threshold, best):
        items, table = self.by_size[size], self.index[size]
        candidates = np.zeros((len(starts), len(items)), bool)
        for j in range(8):
            candidates |= table[j, prints[:, j]]
        w, i = np.nonzero(candidates)
        apart = np.bitwise_count(prints[w] ^ self.prints[items[i]]).sum(1)
        for x in np.flatnonzero(apart <= self.radius):
            s, item = int(starts[w[x]]), int(items[i[x]])
            v = similarity(found[s:s + width], self.shingles[item])
            if v >= threshold and (item not in best or v > best[item][0]):
                best[item] = (v, s, int(apart[x]))


_MATCH = "array<struct<item_id:long,start:long,n_words:long,bits:int,similarity:double>>"


def _added_name(docs: DataFrame) -> str:
    """A name for the matches that no column of the documents has."""
    name, taken = "bench_matches", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
            radius: int = RADIUS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The documents' columns plus, last, the matched items by id."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"),
                            F.col(item_text).cast("string").alias("t"))
    n_blocks = math.ceil(rows.count() / block_items)
    at = docs.columns.index(text_col)
    out = docs.withColumn(_added_name(docs), F.array().cast(_MATCH))
    for block in range(n_blocks):
        part = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == block)
        items = Items([(r.i, r.t) for r in part.collect()], radius)
        schema = out.schema

        def run(batches, items=items, schema=schema):
            hashes = _WordHashes()
            for b in batches:
                kind = b.schema.field(b.num_columns - 1).type
                merged = []
                for text, before in zip(b.column(at), b.column(b.num_columns - 1)):
                    new = items.matches(word_hashes(text.as_py(), hashes), threshold)
                    old = before.as_py() or []
                    merged.append(sorted(
                        old + [dict(zip(("item_id", "start", "n_words", "bits", "similarity"), m))
                               for m in new], key=lambda m: (m["item_id"] is None,
                                                             m["item_id"] or 0, m["start"])))
                yield pa.record_batch([*b.columns[:-1], pa.array(merged, kind)], schema=b.schema)

        out = out.mapInArrow(run, schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids, best_similarity."""
    found = matches(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.col(text_col).cast("string").alias("text")),
                    benchmark, "text", **options)
    return found.select(
        "doc_id", (F.size("bench_matches") > 0).alias("contaminated"),
        F.size("bench_matches").cast("long").alias("n_items"),
        F.col("bench_matches.item_id").alias("item_ids"),
        F.coalesce(F.array_max(F.col("bench_matches.similarity")), F.lit(0.0)).alias("best_similarity"))


def pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **options) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id and the best
    window's start, n_words, bits (apart) and similarity."""
    found = matches(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                F.col(text_col).cast("string").alias("text")),
                    benchmark, "text", **options)
    return found.select("doc_id", F.inline(found.columns[-1]))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = matches(docs, benchmark, text_col, **options)
    added = found.columns[-1]
    return found.filter(F.size(added) == 0).drop(added)
