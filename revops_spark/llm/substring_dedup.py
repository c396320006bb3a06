"""Substring dedup by fixed-block anchors.

A repeat of `window` words holds, in the document it starts in, at least one
block of `window // 2` words whose start is a multiple of that block length.
So only those blocks are indexed, and every rolling window of block length
probes the index:

1. Each chunk of documents sends its distinct block-length window hashes,
   with two flags: some document has it at a block position; two documents
   of the chunk have it. Per hash range, a hash is *live* if it is indexed
   and at least two documents have it. The chunks get their live hashes back.
2. A live hash at word p is an anchor hit. It is extended to the window
   starts p - (window - block) .. p; the 128-bit hashes of those whole
   windows go, once per chunk, to the range that finds the smallest document
   of each. Back comes one bit per hash: a smaller document elsewhere has it.
3. Each chunk marks the words under windows that an earlier document has;
   adjoining marked windows are the maximal exact repeats.

Whole copies go first: a document whose text a smaller id has too loses every
word that a window covers, so only the first of a group of copies takes part in
the steps, however large the group. Hash width in step 1 follows the number of words, so chance hits stay equally
rare at every size; step 2 checks whole windows, so chance hits in step 1
cost time but change nothing. Documents are dealt out once; the three steps
reuse that exchange. A hot passage arrives once per chunk, not once per document.

Results for odd input: a null text has no words; a null id counts as larger
than every other id; rows with the same id never remove each other's words;
repeated rows are all kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import _shared as sh

BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
CHUNK_BYTES = 8 << 20        # text per chunk: bounds a task's memory
RANGE_WINDOWS = 1 << 20      # probe hashes per hash range
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _WordHashes(dict):
    """64-bit hashes of words; emptied when it holds a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, 7)
        return value


class _Chunk:
    """The documents of a chunk with at least `window` words, as one symbol array.

    Copies of other documents have no part in it.
    """

    def __init__(self, tab: pa.Table, replies: pa.Table, window: int, hashes: _WordHashes):
        self.copy = sh.named_rows(tab["name"], replies["copy"])
        self.ids = np.array([sh.NULL_ID if i is None else i for i in tab["doc_id"].to_pylist()],
                            np.int64)
        self.texts = tab["text"].to_pylist()
        parts, rows, lens, self.n_words = [], [], [], np.zeros(len(self.texts), np.int64)
        for k, text in enumerate(self.texts):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            self.n_words[k] = len(words)
            if len(words) >= window and not self.copy[k]:
                rows.append(k)
                lens.append(len(words))
                parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        self.rows = np.array(rows, np.int64)
        self.lens = np.array(lens, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lens)))[:-1].astype(np.int64)
        self.symbols = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.row_of = np.repeat(self.rows, self.lens)
        self.offset = np.arange(len(self.symbols)) - np.repeat(self.starts, self.lens)
        self.left = np.repeat(self.lens, self.lens) - self.offset   # words to the document's end

    def blocks(self, block: int, shift: int):
        """Starts of the block-length windows and their (shortened) hashes."""
        starts = np.flatnonzero(self.left >= block)
        hashes = sh.Rolling(self.symbols, BASE_A).windows(starts, block) >> np.uint64(shift)
        return starts, hashes


def _probe(tab, replies, window, block, shift, range_shift, hashes):
    c = _Chunk(tab, replies, window, hashes)
    if not len(c.symbols):
        return []
    starts, h = c.blocks(block, shift)
    order = np.argsort(h, kind="stable")
    h, starts = h[order], starts[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    ids = c.ids[c.row_of[starts]]
    several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
    indexed = np.maximum.reduceat((c.offset[starts] % block == 0).astype(np.int8), first) > 0
    h = h[first]
    at = h >> np.uint64(range_shift)
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = np.append(cut[1:], len(h))
    return [(int(at[a]), sh.pack_sorted(h[a:b]), sh.pack_bits(indexed[a:b]),
             sh.pack_bits(several[a:b])) for a, b in zip(cut, ends)]


def _live(tab: pa.Table) -> list[tuple[int, bytes]]:
    chunks = tab["chunk"].to_numpy()
    parts = [sh.unpack_sorted(x.as_py()) for x in tab["hashes"]]
    sizes = [len(p) for p in parts]
    h = np.concatenate(parts)
    indexed = np.concatenate([sh.unpack_bits(x.as_py(), n) for x, n in zip(tab["indexed"], sizes)])
    several = np.concatenate([sh.unpack_bits(x.as_py(), n) for x, n in zip(tab["several"], sizes)])
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    size = np.diff(np.append(first, len(s)))
    live = (np.logical_or.reduceat(indexed[order], first)
            & ((size > 1) | np.logical_or.reduceat(several[order], first)))
    hit = np.zeros(len(h), bool)
    hit[order] = np.repeat(live, size)
    out, at = [], 0
    for chunk, n in zip(chunks, sizes):
        mine = h[at:at + n][hit[at:at + n]]
        at += n
        if len(mine):
            out.append((int(chunk), sh.pack_sorted(mine)))
    return out


def _anchored(c: _Chunk, live: np.ndarray, window: int, block: int, shift: int):
    """Starts and both hashes of the whole windows around the chunk's anchor hits."""
    starts, h = c.blocks(block, shift)
    at = np.minimum(np.searchsorted(live, h), len(live) - 1)
    hits = starts[live[at] == h]
    reach = np.minimum(window - block, c.offset[hits])
    edge = np.zeros(len(c.symbols) + 1, np.int32)
    np.add.at(edge, hits - reach, 1)
    np.add.at(edge, hits + 1, -1)
    near = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & (c.left >= window))
    a = sh.Rolling(c.symbols, BASE_A).windows(near, window)
    b = sh.Rolling(c.symbols, BASE_B).windows(near, window)
    return near, a, b


def _distinct(a: np.ndarray, b: np.ndarray):
    """Order by (a, b), first of each distinct pair in it, and its number per row."""
    order = np.lexsort((b, a))
    sa, sb = a[order], b[order]
    new = np.concatenate(([True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])))[:len(a)]
    number = np.zeros(len(a), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def _candidates(tab, replies, window, block, shift, n_ranges, hashes):
    live = sh.sorted_union(replies["live"])
    if not len(live):
        return []
    c = _Chunk(tab, replies, window, hashes)
    near, a, b = _anchored(c, live, window, block, shift)
    if not len(near):
        return []
    order, first, _ = _distinct(a, b)
    owner = np.minimum.reduceat(c.ids[c.row_of[near]][order], first)
    a, b = a[order][first], b[order][first]
    at = (a >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = np.append(cut[1:], len(a))
    return [(int(at[x]), sh.pack_sorted(a[x:y]), sh.pack_ints(b[x:y].view(np.int64)),
             sh.pack_ints(owner[x:y])) for x, y in zip(cut, ends)]


def _earlier(tab: pa.Table) -> list[tuple[int, bytes, int]]:
    """Per chunk: one bit per sent hash, set if a smaller document elsewhere has it."""
    a = [sh.unpack_sorted(x.as_py()) for x in tab["hashes"]]
    sizes = [len(x) for x in a]
    a = np.concatenate(a)
    b = np.concatenate([sh.unpack_ints(x.as_py()) for x in tab["second"]]).view(np.uint64)
    owner = np.concatenate([sh.unpack_ints(x.as_py()) for x in tab["owner"]])
    order, first, number = _distinct(a, b)
    least = np.minimum.reduceat(owner[order], first)
    earlier = least[number] < owner
    out, at = [], 0
    for chunk, n in zip(tab["chunk"].to_pylist(), sizes):
        out.append((int(chunk), sh.pack_bits(earlier[at:at + n]), n))
        at += n
    return out


def _kept_text(text: str, removed: np.ndarray) -> str:
    """The text without the marked words; what stands between kept words stays."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in _WORD.finditer(raw)]
    starts, ends = sh.runs(~removed)
    return b" ".join(raw[spans[s][0]:spans[e - 1][1]] for s, e in zip(starts, ends)).decode(
        "utf-8", "surrogatepass")


def _cut(tab, replies, window, block, shift, hashes, out_schema, with_text):
    """The result rows of a chunk."""
    c = _Chunk(tab, replies, window, hashes)
    removed = np.zeros(len(c.symbols), bool)
    live = sh.sorted_union(replies["live"])
    if len(live) and len(c.symbols):
        near, a, b = _anchored(c, live, window, block, shift)
        if len(near):
            order, first, number = _distinct(a, b)
            ids = c.ids[c.row_of[near]]
            owner = np.minimum.reduceat(ids[order], first)
            earlier = np.zeros(len(first), bool)
            bits = [(r, x, n) for r, x, n in zip(replies["range"].to_pylist(),
                                                 replies["bits"].to_pylist(),
                                                 replies["n"].to_pylist()) if x is not None]
            at = 0
            for _, blob, n in sorted(bits, key=lambda x: x[0]):
                earlier[at:at + n] = sh.unpack_bits(blob, n)
                at += n
            gone = near[earlier[number] | (ids > owner[number])]
            removed = sh.covered(gone, window, len(c.symbols))
    mask_of = {int(r): removed[s:s + n] for r, s, n in zip(c.rows, c.starts, c.lens)}
    texts, shas, n_removed, n_spans = [], [], [], []
    for k, text in enumerate(c.texts):
        mask = mask_of.get(k)
        if c.copy[k] and c.n_words[k] >= window:
            mask = np.ones(c.n_words[k], bool)
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        if mask is not None and mask.any():
            starts, ends = sh.runs(~mask)
            kept = b" ".join(b" ".join(words[s:e]) for s, e in zip(starts, ends))
            n_removed.append(int(mask.sum()))
            n_spans.append(len(sh.runs(mask)[0]))
            if with_text:
                texts.append(_kept_text(text, mask))
        else:
            kept = b" ".join(words)
            n_removed.append(0)
            n_spans.append(0)
            if with_text:
                texts.append(text)
        shas.append(hashlib.sha256(kept).hexdigest())
    cols = {"doc_id": tab["doc_id"], "n_words": pa.array(c.n_words),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
    if with_text:
        cols["kept_text"] = pa.array(texts, pa.string())
    if "rest" in tab.column_names:
        cols["rest"] = tab["rest"]
    return pa.table([cols[f] for f in out_schema], names=out_schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 50, with_text: bool = True,
                   carry: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, n_spans, kept_sha256,
    with `with_text` kept_text, with `carry` the struct `rest` of those columns."""
    block = window // 2
    keys = sh.text_keys(docs, id_col, text_col)
    n_rows, n_bytes = sh.sizes(keys)
    n_chunks = sh.chunk_count(n_bytes + 64 * n_rows, CHUNK_BYTES)
    bits = min(64, max(40, math.ceil(math.log2(n_bytes + 2)) + 12))
    shift = 64 - bits
    range_bits = max(0, math.ceil(math.log2(max(1, n_bytes / 6 / RANGE_WINDOWS))))
    range_shift = bits - range_bits
    n_ranges = max(1, 1 << max(0, range_bits - 1))
    spark = docs.sparkSession
    parts = sh.tasks(spark, 1 << range_bits)
    dealt = sh.chunked(docs, id_col, text_col, n_chunks, carry)
    # a text of `window` words has at least so many bytes
    copied = sh.to_chunks(sh.copies(keys, 2 * window - 1), n_chunks)

    def rows(found, chunk, schema):
        return pa.Table.from_pylist([dict(zip(schema.names, (chunk, *r))) for r in found], schema)

    sent = pa.schema([("chunk", pa.int32()), ("range", pa.int64()), ("hashes", pa.binary()),
                      ("indexed", pa.binary()), ("several", pa.binary())])

    def probe(key, tab, replies):
        found = _probe(tab, replies, window, block, shift, range_shift, _WordHashes()) \
            if tab.num_rows else []
        return rows(found, key[0].as_py(), sent)

    probes = dealt.groupBy("chunk").cogroup(copied.groupBy("chunk")).applyInArrow(
        probe, "chunk int, range long, hashes binary, indexed binary, several binary")

    def live(key, tab):
        found = _live(tab)
        return pa.table({"chunk": pa.array([x[0] for x in found], pa.int32()),
                         "live": pa.array([x[1] for x in found], pa.binary())})

    alive = probes.repartition(parts, "range").groupBy("range").applyInArrow(
        live, "chunk int, live binary").repartition(sh.tasks(spark, n_chunks), "chunk")

    asked = pa.schema([("chunk", pa.int32()), ("range", pa.int64()), ("hashes", pa.binary()),
                       ("second", pa.binary()), ("owner", pa.binary())])

    def candidates(key, tab, replies):
        found = _candidates(tab, replies, window, block, shift, n_ranges, _WordHashes()) \
            if tab.num_rows else []
        return rows(found, key[0].as_py(), asked)

    told = alive.withColumn("copy", F.lit(None).cast("long")).unionByName(
        copied, allowMissingColumns=True)
    whole = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        candidates, "chunk int, range long, hashes binary, second binary, owner binary")

    def earlier(key, tab):
        found = _earlier(tab)
        return pa.table({"chunk": pa.array([x[0] for x in found], pa.int32()),
                         "range": pa.array([key[0].as_py()] * len(found), pa.int64()),
                         "bits": pa.array([x[1] for x in found], pa.binary()),
                         "n": pa.array([x[2] for x in found], pa.int64())})

    verdicts = whole.repartition(parts, "range").groupBy("range").applyInArrow(
        earlier, "chunk int, range long, bits binary, n long")
    replies = told.unionByName(verdicts, allowMissingColumns=True)

    out = [T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
           T.StructField("kept_sha256", T.StringType())]
    if with_text:
        out.append(T.StructField("kept_text", T.StringType()))
    if carry:
        out.append(dealt.schema["rest"])
    names = [f.name for f in out]
    out_schema = to_arrow_schema(T.StructType(out))

    def cut(key, tab, answers):
        if not tab.num_rows:
            return out_schema.empty_table()
        return _cut(tab, answers, window, block, shift, _WordHashes(), names, with_text)

    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        cut, T.StructType(out))
