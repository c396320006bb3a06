"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is a ring of `segments` consecutive segments. If two
fingerprints differ in at most d bits, some segment starts a chain in which,
for every length l, the first l segments differ in at most l * d / segments
bits together. So the leading segments whose budget is below one bit must be
equal: they are the join key, one per ring position. A pair under a key is
then held against the budgets of the longer chains, and only what survives
gets the full Hamming check.

Copies collapse first: the search runs on distinct fingerprints. Keys are
counted before anything is grouped; a key with many fingerprints is split by
the next chain, whose budget is one bit: its members share the chain's bits
with one masked, and for d = 2 at most 2**14 fingerprints can share all of
that (a segment of 13 bits and the masked bit are left free). Tasks emit a spanning star of the links under a key, never all pairs;
components come from rounds of large-star and small-star on those edges.

Results for odd input: a null or empty text has fingerprint zero and is
linked like any other; repeated rows are all returned; a null id belongs to
its component but never names it (the component of null ids alone is null);
an empty table gives an empty result. `one_of_each` keeps one row of each
component: the one with the smallest id, null ids last, and of several texts
under that id the one with the smallest hash; rows equal in id and text are one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as sh

SEED = 42
HOT_KEY = 2048          # fingerprints under one key before the next chain splits it
BUCKET_ROWS = 100_000   # keyed fingerprints per task group


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the lower-cased (A-Z) text's word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lens)
        starts = (ends - lens)[:len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], SEED)
                  for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
    n, ones = len(hashes), np.zeros(64, np.int64)
    raw = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    for at in range(0, n, 65_536):
        bits = np.unpackbits(raw[at:at + 65_536], axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(doc_id, name, fp): a hash of the text and the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64)
            yield pa.record_batch([b.column("doc_id"), b.column("name"), pa.array(fps.view(np.int64))],
                                  names=["doc_id", "name", "fp"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("name"),
                       text.alias("text")).mapInArrow(run, "doc_id long, name long, fp long")


class Ring:
    """Segment masks and chain budgets of a fingerprint ring."""

    def __init__(self, max_distance: int, segments: int | None = None):
        if max_distance < 0 or max_distance > 20:
            raise ValueError("max_distance must be in 0..20")
        self.d = max_distance
        self.m = segments or 2 * max_distance + 1
        if self.m <= self.d or self.m > 64:
            raise ValueError("segments must be in max_distance + 1 .. 64")
        size = [64 // self.m + (i < 64 % self.m) for i in range(self.m)]
        at = np.concatenate(([0], np.cumsum(size)))
        self.segment = [((1 << int(at[i + 1])) - 1) & ~((1 << int(at[i])) - 1)
                        for i in range(self.m)]
        self.budget = [length * self.d // self.m for length in range(self.m + 1)]
        self.exact = sum(b == 0 for b in self.budget[1:])      # leading segments that are equal
        self.one = sum(b <= 1 for b in self.budget[1:])        # chain with a budget of one bit

    def chain(self, i: int, length: int) -> int:
        mask = 0
        for j in range(length):
            mask |= self.segment[(i + j) % self.m]
        return mask

    def masked_bits(self, i: int) -> list[int]:
        """Bits of chain `one` beyond the exact part: one of them may differ."""
        rest = self.chain(i, self.one) & ~self.chain(i, self.exact)
        return [b for b in range(64) if rest >> b & 1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _near(x: np.ndarray, ring: Ring, i: int) -> np.ndarray:
    """Which of the differences x pass the chains from segment i, then the full check."""
    alive = np.arange(len(x))
    for length in range(ring.exact + 1, ring.m):
        mask = np.uint64(ring.chain(i, length))
        alive = alive[np.bitwise_count(x[alive] & mask) <= ring.budget[length]]
        if not len(alive):
            return alive
    return alive[np.bitwise_count(x[alive]) <= ring.d]


def _stars(fps: np.ndarray, ring: Ring, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (member, root) of the links among fingerprints under one key."""
    left, members, roots = np.sort(fps), [], []
    while len(left) > 1:
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            f = frontier.pop()
            hit = _near(left ^ f, ring, i)
            if len(hit):
                new = left[hit]
                left = np.delete(left, hit)
                members.append(new)
                roots.append(np.full(len(new), root))
                frontier.extend(new)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(members), np.concatenate(roots)) if members else (none, none)


def _linked(tab: pa.Table, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Stars of every key in a bucket of (slot, val, fp) rows."""
    slot = tab["slot"].to_numpy()
    val = tab["val"].to_numpy()
    fp = tab["fp"].to_numpy().view(np.uint64)
    order = np.lexsort((fp, val, slot))
    slot, val, fp = slot[order], val[order], fp[order]
    new = np.concatenate(([True], (slot[1:] != slot[:-1]) | (val[1:] != val[:-1])))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(fp)))
    out_a, out_b = [], []
    for i in np.unique(slot):
        pair = first[(size == 2) & (slot[first] == i)]
        hit = pair[_near(fp[pair] ^ fp[pair + 1], ring, int(i) % ring.m)]
        out_a.append(fp[hit + 1])
        out_b.append(fp[hit])
    for s, n in zip(first[size > 2], size[size > 2]):
        a, b = _stars(fp[s:s + n], ring, int(slot[s]) % ring.m)
        out_a.append(a)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(distinct: DataFrame, max_distance: int = 2, segments: int | None = None) -> DataFrame:
    """(u, v): spanning links, u > v, whose closure joins exactly the fingerprints
    within max_distance of each other. `distinct` has one row per fingerprint `fp`."""
    ring = Ring(max_distance, segments)
    spark = distinct.sparkSession
    fp = F.col("fp")
    if ring.d == 0:
        return spark.createDataFrame([], "u long, v long")
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("slot"),
                 fp.bitwiseAND(F.lit(_signed(ring.chain(i, ring.exact)))).alias("val"))
        for i in range(ring.m)])).alias("k")).select("fp", "k.slot", "k.val")
    counts = keyed.groupBy("slot", "val").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = keyed.join(counts, ["slot", "val"])
    # one masked bit of the next chain: slot i + m * (1 + bit)
    split = F.when(F.col("slot") == ring.m, F.array())
    for i in range(ring.m):
        split = split.when(F.col("slot") == i, F.array(*[
            F.struct(F.lit(i + ring.m * (1 + b)).alias("slot"),
                     fp.bitwiseAND(F.lit(_signed(ring.chain(i, ring.one) & ~(1 << b)))).alias("val"))
            for b in ring.masked_bits(i)]))
    few = shared.filter(F.col("n") <= HOT_KEY).select("slot", "val", "fp")
    many = shared.filter(F.col("n") > HOT_KEY).select("fp", F.explode(split).alias("k")).select(
        "k.slot", "k.val", "fp")
    rows = few.unionByName(many)

    def run(key, tab):
        a, b = _linked(tab, ring)
        return pa.table({"u": pa.array(a.view(np.int64)), "v": pa.array(b.view(np.int64))})

    n = distinct.count()
    buckets = max(sh.partitions(spark), math.ceil(n * ring.m / BUCKET_ROWS))
    return (rows.withColumn("bucket", F.pmod(F.xxhash64("slot", "val"), F.lit(buckets)).cast("int"))
            .groupBy("bucket").applyInArrow(run, "u long, v long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (u, v): root is the least node reachable.

    Alternates large-star (each node ties its larger neighbours to its least
    one) and small-star (each node ties its smaller neighbours to the least)
    until every edge is (node, root). Each round is written to the shared folder.
    """
    edges = sh.stored(edges.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that both sides of the join are plain exchanges and the
        # edges of a node with very many are split over tasks
        least = sh.stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = sh.stored(large, "large")
        least = sh.stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select("u", "v", "m")
        edges = sh.stored(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                          .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = now


def _rooted(prints: DataFrame, max_distance: int, segments: int | None) -> DataFrame:
    """(fp, least, root) of every distinct fingerprint: its least id and its
    component's root fingerprint; stored."""
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = components(links(groups.select("fp"), max_distance, segments))
    return sh.stored(groups.join(comps, groups.fp == comps.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_distance: int = 2,
                    segments: int | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    prints = sh.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(prints, max_distance, segments)
    named = sh.stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    by_print = sh.stored(rooted.join(named, "root").select("fp", "component_id"), "by-print")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One document of each component: smallest id (nulls last), then text hash."""
    prints = sh.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    rooted = _rooted(prints, max_distance, None)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "name")).alias("first")
    # per fingerprint before the join, so a hot fingerprint is one row there
    kept = prints.groupBy("fp").agg(first).join(rooted.select("fp", "root"), "fp").groupBy("root").agg(
        F.min("first").alias("first")).select(F.col("first.doc_id").alias("kept_id"),
                                              F.col("first.name").alias("kept_name"))
    kept = sh.stored(kept, "kept").alias("kept")
    doc_id, text = F.col(f"docs.`{id_col}`"), F.col(f"docs.`{text_col}`").cast("string")
    return docs.alias("docs").join(
        kept, doc_id.cast("long").eqNullSafe(F.col("kept.kept_id"))
        & (F.xxhash64(text) == F.col("kept.kept_name")), "left_semi").dropDuplicates([id_col, text_col])
