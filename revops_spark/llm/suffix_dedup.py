"""Exact substring dedup over suffix arrays built by induced sorting.

All places of one `length`-byte string must meet in one shard, so text is dealt
out by content:

1. Every window of `length` bytes is ruled by its smallest `gram`-byte
   substring (by hash, the leftmost of equals): its anchor. Consecutive windows
   with one anchor form a segment of at most 2 * length - gram bytes. Chunks of
   documents send their distinct anchor hashes; an anchor seen once in the
   whole table can't rule a repeated window. Chunks get the others back, and
   which of them are hot: more distinct segments than one array holds.
2. Segments of hot anchors (a line that many documents hold in different
   surroundings) are taken apart into their windows, ruled by a hash of the
   whole window; windows seen once in the whole table are left out likewise.
3. Segments of the other repeated anchors go to the shard of their anchor, the
   repeated windows of hot ones to the shard of their own hash, equal ones once
   per chunk, with the first place each has there.
4. A shard concatenates its distinct segments, builds their suffix array by
   induced sorting and the permuted common prefixes, and so finds the classes
   of equal windows and the first place of each (smallest document, then
   start). Where a key has single windows only, equal texts are the classes.
   Back goes one bit per window sent: an earlier place exists.
5. Chunks mark the bytes under windows with an earlier place.

Whole copies go first: a text that a smaller id has too is removed altogether
(from `length` bytes on), so only the first of a group of copies takes part in
the steps, however large the group. Strings are compared byte by byte; hashes only deal out the work, so chance
hits cost time and change nothing. Documents are dealt out once and the steps
reuse that exchange. An array's text is bounded however hot an anchor is; a
window that very many chunks hold reaches its shard once per chunk.

Results for odd input: a null text counts as empty; a null id counts as larger
than every other id; a place is (id, start), so rows that repeat an id stand at
the same places and a repeated row keeps what the first one keeps; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import _shared as sh
from .suffix_array import permuted_common_prefixes, suffix_array

CHUNK_BYTES = 2 << 20       # text per chunk; a task holds about sixty times that in arrays
RANGE_ANCHORS = 1 << 20     # anchor hashes per hash range
SHARD_TEXT = 4 << 20        # input text per shard
ARRAY_BYTES = 1 << 20       # segments sorted in one array
GRAM = 32
BASE = 0xA0761D6478BD642F


def _symbols() -> np.ndarray:
    return sh.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Chunk:
    """The documents of a chunk, ordered by id, as one byte array with segments.

    Copies of other documents have no part in it; they are `copied`.
    """

    def __init__(self, tab: pa.Table, replies: pa.Table, length: int, gram: int, bits: int):
        copy = pa.array(sh.named_rows(tab["name"], replies["copy"]))
        self.copied, tab = tab.filter(copy), tab.filter(pc.invert(copy))
        text = pc.fill_null(tab["text"], "")
        key = pc.fill_null(tab["doc_id"], sh.NULL_ID)
        self.order = pc.sort_indices(pa.table({"k": key, "t": text}),
                                     sort_keys=[("k", "ascending"), ("t", "ascending")])
        self.tab = tab.take(self.order)
        text = text.take(self.order).combine_chunks().cast(pa.large_binary())
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.large_binary())
        self.ids = key.take(self.order).to_numpy()
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] \
            if len(text) else np.zeros(1, np.int64)
        raw = text.buffers()[2] if len(text) else None
        self.bytes = (np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None
                      else np.zeros(0, np.uint8))
        self.bounds = at - at[0]
        self.length = length
        self._segments(length, gram, bits)

    def _segments(self, length: int, gram: int, bits: int) -> None:
        n = len(self.bytes)
        none = np.zeros(0, np.int64)
        self.seg_start, self.seg_windows, self.seg_anchor = none, none, np.zeros(0, np.uint64)
        self.seg_row = none
        if n < length:
            return
        h = sh.Rolling(_symbols()[self.bytes], BASE).all_windows(gram)
        low = np.uint64((1 << 32) - 1)      # hash above, position in the chunk below
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width, span = length - gram + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        anchor = (least & low).astype(np.int64)          # per window start 0 .. n - length
        row = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        valid = row[:n - length + 1] == row[length - 1:]
        new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new[1:] |= row[1:n - length + 1] != row[:n - length]
        new |= np.concatenate(([False], ~valid[:-1]))
        starts = np.flatnonzero(new & valid)
        ends = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
        self.seg_start, self.seg_windows = starts, ends - starts
        # smallest hashes crowd near zero; mixed again they spread over ranges and shards
        self.seg_anchor = sh.mixed(h[anchor[starts]]) >> np.uint64(64 - bits)
        self.seg_gram_at = anchor[starts]
        self.seg_row = row[starts]

    def rolling(self) -> sh.Rolling:
        return sh.Rolling(_symbols()[self.bytes], BASE)

    def hot_windows(self, hot: np.ndarray, bits: int):
        """Starts, hashes and rows of the windows of the segments with hot anchors."""
        mine = np.flatnonzero(_among(self.seg_anchor, hot))
        w = self.seg_windows[mine]
        starts = np.repeat(self.seg_start[mine] - np.concatenate(([0], np.cumsum(w)[:-1])), w) \
            + np.arange(w.sum()) if len(mine) else np.zeros(0, np.int64)
        if not len(starts):
            return starts, np.zeros(0, np.uint64), starts
        h = self.rolling().windows(starts, self.length) >> np.uint64(64 - bits)
        return starts, h, np.repeat(self.seg_row[mine], w)

    def rule(self, live: np.ndarray, hot: np.ndarray, seen: np.ndarray, bits: int) -> None:
        """Keep the segments with live anchors; of hot ones the seen windows, each by itself."""
        starts, h, row = self.hot_windows(hot, bits)
        seen = _among(h, seen)
        kept = _among(self.seg_anchor, live) & ~_among(self.seg_anchor, hot)
        cols = [np.concatenate(x) for x in (
            (self.seg_start[kept], starts[seen]),
            (self.seg_windows[kept], np.ones(int(seen.sum()), np.int64)),
            (self.seg_anchor[kept], h[seen]), (self.seg_row[kept], row[seen]))]
        self.seg_start, self.seg_windows, self.seg_anchor, self.seg_row = cols

    def segments(self, to_send: bool = False):
        """Distinct texts of the segments that `rule` kept, by anchor.

        To send: their anchors, bytes, documents and positions. Else: the
        segments, per segment its text's place in that order and its number by
        first appearance, the windows of each text, and its first segment.
        """
        mine = np.arange(len(self.seg_start))
        raw = self.bytes.tobytes()
        number: dict[bytes, int] = {}
        first, of = [], np.empty(len(mine), np.int64)
        starts = self.seg_start[mine].tolist()
        ends = (self.seg_start[mine] + self.seg_windows[mine] + self.length - 1).tolist()
        for k, (a, b) in enumerate(zip(starts, ends)):
            i = number.setdefault(raw[a:b], len(first))
            if i == len(first):
                first.append(k)
            of[k] = i
        texts = list(number)
        first = np.array(first, np.int64)
        order = np.argsort(self.seg_anchor[mine[first]], kind="stable")
        place = np.empty(len(first), np.int64)
        place[order] = np.arange(len(first))
        lead = mine[first[order]]
        row = self.seg_row[lead]
        if to_send:
            return (self.seg_anchor[lead], [texts[i] for i in order], self.ids[row],
                    self.seg_start[lead] - self.bounds[row])
        return mine, place[of], of, self.seg_windows[lead], first


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are in the ascending array `wanted`."""
    if not len(wanted):
        return np.zeros(len(values), bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _anchors(c: _Chunk, range_shift: int):
    """Anchors to ask about, each with its distinct segments in the chunk."""
    if not len(c.seg_anchor):
        return []
    text = c.rolling().windows(c.seg_start, c.seg_windows + c.length - 1)
    return _asked(c.seg_anchor, c.seg_gram_at, text, range_shift)


def _asked(h: np.ndarray, pos: np.ndarray, text: np.ndarray, range_shift: int):
    """Rows (range, hashes, several, counts): the distinct hashes, which of them
    stand at several positions, and the number of distinct texts of each."""
    if not len(h):
        return []
    by = np.lexsort((text, h))
    h, pos, text = h[by], pos[by], text[by]
    new = np.concatenate(([True], h[1:] != h[:-1]))
    first = np.flatnonzero(new)
    several = np.minimum.reduceat(pos, first) != np.maximum.reduceat(pos, first)
    new[1:] |= text[1:] != text[:-1]
    counts = np.add.reduceat(new.astype(np.int64), first)
    h = h[first]
    at = h >> np.uint64(range_shift)
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = np.append(cut[1:], len(h))
    return [(int(at[a]), sh.pack_sorted(h[a:b]), sh.pack_bits(several[a:b]),
             sh.pack_ints(counts[a:b])) for a, b in zip(cut, ends)]


def _live(tab: pa.Table, most: int) -> list[tuple[int, bytes, bytes]]:
    """Per chunk: its hashes that repeat, and those with more than `most` distinct texts."""
    parts = [sh.unpack_sorted(x.as_py()) for x in tab["hashes"]]
    sizes = [len(p) for p in parts]
    h = np.concatenate(parts)
    several = np.concatenate([sh.unpack_bits(x.as_py(), n) for x, n in zip(tab["several"], sizes)])
    counts = np.concatenate([sh.unpack_ints(x.as_py()) for x in tab["counts"]])
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    size = np.diff(np.append(first, len(s)))
    live = (size > 1) | np.logical_or.reduceat(several[order], first)
    hit = np.zeros(len(h), bool)
    hit[order] = np.repeat(live, size)
    hot = np.zeros(len(h), bool)
    hot[order] = np.repeat(live & (np.add.reduceat(counts[order], first) > most), size)
    out, at = [], 0
    for chunk, n in zip(tab["chunk"].to_pylist(), sizes):
        mine, burning = h[at:at + n][hit[at:at + n]], h[at:at + n][hot[at:at + n]]
        at += n
        if len(mine):
            out.append((int(chunk), sh.pack_sorted(mine),
                        sh.pack_sorted(burning) if len(burning) else None))
    return out


def _sent(c: _Chunk, bits: int, n_shards: int):
    """Rows (shard, anchors, lengths, bytes, documents, positions) of the kept segments."""
    anchor, texts, ids, pos = c.segments(True)
    if not len(anchor):
        return []
    at = _shard(anchor, bits, n_shards)
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = np.append(cut[1:], len(at))
    squeeze = zstandard.ZstdCompressor(level=3).compress
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return [(int(at[a]), sh.pack_sorted(anchor[a:b]), sh.pack_ints(lens[a:b]),
             squeeze(b"".join(texts[a:b])), sh.pack_ints(ids[a:b]), sh.pack_ints(pos[a:b]))
            for a, b in zip(cut, ends)]


def _shard(anchor: np.ndarray, bits: int, n_shards: int) -> np.ndarray:
    top = anchor >> np.uint64(bits - 32) if bits > 32 else anchor
    return (top * np.uint64(n_shards)) >> np.uint64(min(bits, 32))


def _first_places(texts: list[bytes], owner: np.ndarray, length: int):
    """For the windows of the texts, one after the other: the least place (owner
    plus offset) of an equal window."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    t = joined.astype(np.uint16) + np.uint16(2)
    starts = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    t[starts + lens] = 1                                   # between the segments
    t = np.append(t, np.uint16(0))                         # the end, smallest of all
    sa = suffix_array(t, 258)
    common = permuted_common_prefixes(t, sa)
    windows = lens - length + 1
    at = np.repeat(starts - np.concatenate(([0], np.cumsum(windows)[:-1])), windows) \
        + np.arange(windows.sum())
    place = np.repeat(owner, windows) + at - np.repeat(starts, windows)
    number = np.full(len(t), -1, np.int64)
    number[at] = np.arange(len(at))
    ordered = number[sa]
    ordered = ordered[ordered >= 0]                        # the windows, as the array has them
    new = common[at[ordered]] < length
    new[0] = True
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(place[ordered], first)
    out = np.empty(len(at), np.int64)
    out[ordered] = least[np.cumsum(new) - 1]
    return out, place, windows


def _verdicts(tab: pa.Table, length: int) -> list[tuple[int, bytes, int]]:
    """Per chunk: one bit per window sent, set if an earlier place exists."""
    expand = zstandard.ZstdDecompressor().decompress
    anchors, owners, pos, number, sizes = [], [], [], [], []
    distinct: dict[bytes, int] = {}
    for r in zip(*(tab[c] for c in ("anchors", "lengths", "bytes", "ids", "pos"))):
        a, lens, blob, ids, p = (x.as_py() for x in r)
        anchors.append(sh.unpack_sorted(a))
        lens, raw = sh.unpack_ints(lens), expand(blob)
        ends = np.cumsum(lens)
        number.append(np.fromiter((distinct.setdefault(raw[x:y], len(distinct)) for x, y in
                                   zip((ends - lens).tolist(), ends.tolist())), np.int64, len(lens)))
        owners.append(sh.unpack_ints(ids))
        pos.append(sh.unpack_ints(p))
        sizes.append(len(lens))
    texts = list(distinct)
    anchors, owners, pos, number = map(np.concatenate, (anchors, owners, pos, number))
    # places as one number: rank of the document, then the position
    docs, rank = np.unique(owners, return_inverse=True)
    base = np.int64(int(pos.max()) + 2 * length + 1)
    sent = rank.reshape(-1).astype(np.int64) * base + pos
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, number, sent)
    anchor_of = np.zeros(len(texts), np.uint64)
    anchor_of[number] = anchors
    order = np.argsort(anchor_of, kind="stable")
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    windows = lens - length + 1
    at = np.concatenate(([0], np.cumsum(windows)))         # windows of text i: at[i] .. at[i + 1]
    earliest = np.empty(at[-1], np.int64)
    # equal windows of a key with single windows only are equal texts
    groups = anchor_of[order]
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    alone = np.repeat(np.maximum.reduceat(windows[order], first) == 1,
                      np.diff(np.append(first, len(order))))
    earliest[at[order[alone]]] = least[order[alone]]
    order = order[~alone]
    # one array per batch of the other anchors; an anchor is never split
    size = np.cumsum(lens[order])
    a = 0
    while a < len(order):
        b = int(np.searchsorted(size, (size[a - 1] if a else 0) + ARRAY_BYTES, "right"))
        b = max(b, a + 1)
        while b < len(order) and anchor_of[order[b]] == anchor_of[order[b - 1]]:
            b += 1
        part = order[a:b]
        found, _, w = _first_places([texts[i] for i in part], least[part], length)
        to = np.repeat(at[part] - np.concatenate(([0], np.cumsum(w)[:-1])), w) + np.arange(w.sum())
        earliest[to] = found
        a = b
    w = windows[number]
    edge = np.concatenate(([0], np.cumsum(w)))
    offset = np.arange(edge[-1]) - np.repeat(edge[:-1], w)
    bits = earliest[np.repeat(at[number], w) + offset] < np.repeat(sent, w) + offset
    out, k = [], 0
    for chunk, n in zip(tab["chunk"].to_pylist(), sizes):
        x, y = int(edge[k]), int(edge[k + n])
        out.append((int(chunk), sh.pack_bits(bits[x:y]), y - x))
        k += n
    return out


def _cut(c: _Chunk, replies: pa.Table, bits: int, out_schema: pa.Schema, with_text: bool):
    """The result rows of a chunk."""
    n = len(c.bytes)
    removed = np.zeros(n, bool)
    c.rule(*(sh.sorted_union(replies[x]) for x in ("live", "hot", "seen")), bits)
    mine, of, number, windows, first = c.segments()
    if len(mine):
        sent = sorted(((r, x, k) for r, x, k in zip(replies["shard"].to_pylist(),
                                                    replies["bits"].to_pylist(),
                                                    replies["n"].to_pylist()) if x is not None),
                      key=lambda x: x[0])
        told = np.concatenate([sh.unpack_bits(x, k) for _, x, k in sent])
        at = np.concatenate(([0], np.cumsum(windows)[:-1]))
        w = c.seg_windows[mine]
        edge = np.concatenate(([0], np.cumsum(w)[:-1]))
        offset = np.arange(w.sum()) - np.repeat(edge, w)
        row = c.seg_row[mine]
        place = np.stack((c.ids[row], c.seg_start[mine] - c.bounds[row]))
        lead = place[:, first][:, number]
        again = (place[0] > lead[0]) | ((place[0] == lead[0]) & (place[1] > lead[1]))
        gone = told[np.repeat(at[of], w) + offset] | np.repeat(again, w)
        starts = (np.repeat(c.seg_start[mine], w) + offset)[gone]
        removed = sh.covered(starts, c.length, n)
    sizes, n_removed, n_spans, shas, texts = np.diff(c.bounds), [], [], [], []
    for a, b in zip(c.bounds[:-1].tolist(), c.bounds[1:].tolist()):
        mask = removed[a:b]
        kept = c.bytes[a:b][~mask].tobytes()
        n_removed.append(int(mask.sum()))
        n_spans.append(len(sh.runs(mask)[0]) if n_removed[-1] else 0)
        shas.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            texts.append(kept)
    whole = pc.binary_length(c.copied["text"]).cast(pa.int64()).to_pylist()   # removed altogether
    none = len(whole)
    cols = {"doc_id": c.tab["doc_id"].to_pylist() + c.copied["doc_id"].to_pylist(),
            "n_bytes": sizes.tolist() + whole, "n_removed": n_removed + whole,
            "n_spans": n_spans + [1] * none,
            "kept_sha256": shas + [hashlib.sha256(b"").hexdigest()] * none}
    if with_text:
        cols["kept_bytes"] = texts + [b""] * none
    return pa.table([pa.array(cols[f.name], f.type) for f in out_schema], schema=out_schema)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          length: int = 100, gram: int = GRAM,
                          with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and,
    with `with_text`, kept_bytes (a cut may fall inside a character)."""
    if not 1 <= gram <= length:
        raise ValueError("gram must be in 1..length")
    spark = docs.sparkSession
    keys = sh.text_keys(docs, id_col, text_col)
    n_rows, n_bytes = sh.sizes(keys)
    n_chunks = sh.chunk_count(n_bytes + 16 * n_rows, CHUNK_BYTES)
    # anchors keep enough bits that chance hits stay rare; a window's anchor is
    # chosen by bits that the position in a chunk doesn't need
    bits = min(64, max(36, math.ceil(math.log2(n_bytes + 2)) + 9))
    range_bits = max(0, math.ceil(math.log2(max(1, n_bytes / 35 / RANGE_ANCHORS))))
    n_shards = sh.chunk_count(n_bytes, SHARD_TEXT)
    most = max(1, ARRAY_BYTES // (2 * length - gram))      # distinct segments of an anchor that isn't hot
    dealt = sh.chunked(docs, id_col, text_col, n_chunks)
    copied = sh.to_chunks(sh.copies(keys, length), n_chunks)

    def rows(found, chunk, schema):
        return pa.Table.from_pylist([dict(zip(schema.names, (chunk, *r))) for r in found], schema)

    asked = pa.schema([("chunk", pa.int32()), ("range", pa.int64()), ("hashes", pa.binary()),
                       ("several", pa.binary()), ("counts", pa.binary())])

    def anchors(key, tab, replies):
        found = _anchors(_Chunk(tab, replies, length, gram, bits), bits - range_bits) \
            if tab.num_rows else []
        return rows(found, key[0].as_py(), asked)

    def live(key, tab):
        found = _live(tab, most)
        return pa.table({"chunk": pa.array([x[0] for x in found], pa.int32()),
                         "live": pa.array([x[1] for x in found], pa.binary()),
                         "hot": pa.array([x[2] for x in found], pa.binary())})

    def answered(asking):
        return asking.repartition(sh.tasks(spark, 1 << range_bits), "range").groupBy("range").applyInArrow(
            live, "chunk int, live binary, hot binary").repartition(sh.tasks(spark, n_chunks), "chunk")

    asking = "chunk int, range long, hashes binary, several binary, counts binary"
    alive = answered(dealt.groupBy("chunk").cogroup(copied.groupBy("chunk")).applyInArrow(
        anchors, asking))

    def hot_windows(key, tab, replies):
        hot = sh.sorted_union(replies["hot"])
        if not tab.num_rows or not len(hot):
            return asked.empty_table()
        starts, h, _ = _Chunk(tab, replies, length, gram, bits).hot_windows(hot, bits)
        return rows(_asked(h, starts, h, bits - range_bits), key[0].as_py(), asked)

    told = alive.withColumn("copy", F.lit(None).cast("long")).unionByName(
        copied, allowMissingColumns=True)
    seen = answered(dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        hot_windows, asking)).select("chunk", F.col("live").alias("seen"))
    told = told.unionByName(seen, allowMissingColumns=True)

    parts = pa.schema([("chunk", pa.int32()), ("shard", pa.int64()), ("anchors", pa.binary()),
                       ("lengths", pa.binary()), ("bytes", pa.binary()), ("ids", pa.binary()),
                       ("pos", pa.binary())])

    def segments(key, tab, replies):
        kept = [sh.sorted_union(replies[x]) for x in ("live", "hot", "seen")]
        if not tab.num_rows or not len(kept[0]):
            return rows([], 0, parts)
        c = _Chunk(tab, replies, length, gram, bits)
        c.rule(*kept, bits)
        return rows(_sent(c, bits, n_shards), key[0].as_py(), parts)

    def shard(key, tab):
        found = _verdicts(tab, length)
        return pa.table({"chunk": pa.array([x[0] for x in found], pa.int32()),
                         "shard": pa.array([key[0].as_py()] * len(found), pa.int64()),
                         "bits": pa.array([x[1] for x in found], pa.binary()),
                         "n": pa.array([x[2] for x in found], pa.int64())})

    verdicts = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        segments, "chunk int, shard long, anchors binary, lengths binary, bytes binary, "
                  "ids binary, pos binary").repartition(sh.tasks(spark, n_shards), "shard").groupBy(
        "shard").applyInArrow(shard, "chunk int, shard long, bits binary, n long")
    replies = told.unionByName(verdicts, allowMissingColumns=True)
    out = [T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
           T.StructField("kept_sha256", T.StringType())]
    if with_text:
        out.append(T.StructField("kept_bytes", T.BinaryType()))
    out_schema = to_arrow_schema(T.StructType(out))

    def cut(key, tab, answers):
        if not tab.num_rows:
            return out_schema.empty_table()
        return _cut(_Chunk(tab, answers, length, gram, bits), answers, bits, out_schema, with_text)

    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        cut, T.StructType(out))
