"""Sequence packing: shortest-pack-first over the length histogram.

1. Each document becomes token ids plus an end id; whole sequences of
   `capacity` ids are cut off its front, the rest is one shorter piece.
2. The histogram of piece lengths (at most `capacity` entries) reaches the
   driver. Lengths are placed longest first; each goes into the packs that
   are shortest so far and have room. The state is a count per packing
   pattern, not per pack, so the work depends on the histogram alone: a
   placement uses up a pattern or ends its length, which keeps the number of
   patterns under twice the number of lengths.
3. Pieces of one length are interchangeable. Each gets a rank within its
   length (numbered in buckets of bounded size, so a length that a third of
   all documents have is many tasks' work), and the rank says which slot of
   which pattern it takes.

Token ids are those of the `tokenizers` library and the named vocabulary. A
text in which no two white-space characters adjoin splits into its
space-separated parts without changing a token, so ids are looked up per part;
a part seen for the first time is encoded with the same vocabulary in its
rank form, which is several times faster. Other texts are encoded whole, and
those with characters beyond U+052F or the text of a special token by
`tokenizers` itself.

Results for odd input: a null or empty text is the end id alone; repeated rows
are packed once each; null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as sh

CAPACITY = 2048
END_ID = 1
BUCKET_ROWS = 50_000      # pieces of one length numbered in one window
PART_CACHE = 150_000      # parts whose ids a task remembers
_ADJOINING = re.compile(r"\s\s|^\s|\s$")
_UNUSUAL = re.compile("[^\x00-ԯ]|<\\|")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        self.vocabulary, self.whole = vocabulary, None
        self.fast = None
        if ranks and pattern:
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table,
                                          special_tokens={})
        encode = self.fast.encode_ordinary if self.fast else None

        class Parts(dict):
            def __missing__(self, part: str) -> bytes:
                if len(self) >= PART_CACHE:
                    self.clear()
                self[part] = ids = np.array(encode(" " + part), "<u4").tobytes()
                return ids

        self.parts = Parts()

    def _by_library(self, text: str) -> bytes:
        if self.whole is None:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            self.whole = Tokenizer.from_file(self.vocabulary)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None or _UNUSUAL.search(text):
            return self._by_library(text)
        if _ADJOINING.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.fast.encode_ordinary(first), "<u4").tobytes() + b"".join(
            map(self.parts.__getitem__, rest))


def pieces(docs: DataFrame, encoder_args: tuple, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): every document's pieces."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = Encoder(*encoder_args)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                for a in range(0, n, capacity):
                    b = min(n, a + capacity)
                    for col, v in zip(cols, (doc_id, a, b - a, zlib.crc32(ids[4 * a:4 * b]), n)):
                        col.append(v)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                                  names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """Packing patterns (number of packs, piece lengths in order) for a length histogram."""
    by_room: dict[int, list] = defaultdict(list)
    rooms: set[int] = set()
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            room = max(rooms, default=0)
            if room < length:
                taken, items, room = left, (), capacity
            else:
                packs, items = by_room[room].pop()
                taken = min(packs, left)
                if packs > taken:
                    by_room[room].append((packs - taken, items))
                elif not by_room[room]:
                    rooms.discard(room)
            by_room[room - length].append((taken, items + (length,)))
            if room > length:
                rooms.add(room - length)
            left -= taken
    return [p for room in sorted(by_room) for p in by_room[room]]


class _Slots:
    """Where rank r of length l goes: arrays sorted by (l, first rank)."""

    def __init__(self, patterns: list[tuple[int, tuple]]):
        used: dict[int, int] = defaultdict(int)
        rows, base = [], 0
        for packs, items in patterns:
            at = 0
            for length in items:
                rows.append((length << 44 | used[length], base, at))
                used[length] += packs
                at += length
            base += packs
        rows.sort()
        self.key = np.array([r[0] for r in rows], np.int64)
        self.base = np.array([r[1] for r in rows], np.int64)
        self.at = np.array([r[2] for r in rows], np.int64)

    def place(self, length: np.ndarray, rank: np.ndarray):
        key = (length << 44) + rank
        i = np.searchsorted(self.key, key, "right") - 1
        return self.base[i] + key - self.key[i], self.at[i]


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    # every stored piece has its own number, so equal rows are spread and ordered, too
    cut = sh.stored(pieces(docs, (vocabulary, ranks, pattern), id_col, text_col, capacity, end_id)
                    .withColumn("nth", F.monotonically_increasing_id()), "pieces")
    histogram = {int(r.length): int(r["count"]) for r in cut.groupBy("length").count().collect()}
    slots = _Slots(shortest_pack_first(histogram, capacity))
    # at most `capacity` rows, so the broadcast is bounded
    spread = spark.createDataFrame([(n, -(-c // BUCKET_ROWS)) for n, c in histogram.items()],
                                   "length long, buckets long")
    dealt = cut.join(F.broadcast(spread), "length").withColumn(
        "bucket", F.expr("pmod(xxhash64(doc_id, start, ids_crc32, nth), buckets)")).drop("buckets")
    group = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "nth")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"))
    ranked = dealt.withColumn("rank", F.row_number().over(group) - 1).join(
        offsets, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("below"))

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            seq, at = slots.place(t["length"].to_numpy(), t["rank"].to_numpy())
            yield from t.drop_columns(["rank"]).append_column(
                "sequence_id", pa.array(seq)).append_column("offset", pa.array(at)).to_batches()

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         F.col("rank").cast("long")).mapInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
             "sequence_id long, offset long")
