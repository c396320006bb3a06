"""Document fingerprints by spot signatures.

1. Anchors: a word is common if its hash bucket (one of 65,536) holds at least
   1/ANCHORS of all words of the corpus, counted over every text in one scan.
   So there are at most ANCHORS common buckets, whatever the corpus. The start
   of a text, line or sentence is an anchor, too.
2. Signature: an anchor and the chain of the next CHAIN content words (words
   that are not common), fewer at the end of the text. A text's spot signatures
   are a set; advertisement, navigation and lists have few anchors and so
   weigh little.
3. Fingerprint: the number of signatures and the KEPT smallest of their 32-bit
   hashes. Texts of up to KEPT signatures keep the whole set.
4. Likeness: the Jaccard coefficient of two sets, over the range of hashes both
   fingerprints cover: exact for whole sets, an unbiased estimate beyond. Sets
   are partitioned by length, and the ratio of lengths bounds the coefficient:
   pairs whose partitions are too far apart to reach FLOOR aren't compared and
   have likeness 0.

`edited` compares every document with its edited text, in which the last third
is replaced by the beginning of the next document in descending order of ids.
Documents are dealt out to blocks of consecutive ids, so the next document is
the next row; the first document of a block is also sent to the block before.
The bounds of the blocks, one key each, are all that reaches the driver.

Results for odd input: a null text is empty; a text without a word has no
signature, two such are alike (1), one such and another are not (0). Rows of
equal id and text are one document for the order and are returned as often as
they occur; rows of one id and different texts are ordered by a hash of the
text; null ids come last. The document after the last is the first, in a table
of one document itself. An empty table gives an empty result; further columns
are not read. A text is held in memory whole, with about thirty times its size
in arrays, twice while it is edited.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as sh
from ._words import Words, by_size, byte_kinds

ANCHORS = 2_000           # a common word is one in so many, at least
CHAIN = 2                 # content words of a signature
KEPT = 256                # signatures of a fingerprint
FLOOR = 0.05              # likeness below which sets aren't compared
BLOCK_BYTES = 32 << 20    # text of one block of documents
BATCH_BYTES = 2 << 20     # text tokenized at a time

_LETTERS = frozenset(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'") | set(range(128, 256))
_BREAKS = b"\n\r\x0b\x0c.!?;:|"
KINDS = byte_kinds(bytes(set(range(256)) - _LETTERS - set(_BREAKS)), _BREAKS)


def common_words(docs: DataFrame, text_col: str = "text", anchors: int = ANCHORS) -> np.ndarray:
    """Which of the 65,536 hash buckets hold a common word (mask)."""

    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            texts = (t.as_py().encode() for t in batch.column(0) if t.is_valid)
            for part in by_size(texts, len, BATCH_BYTES):
                total += np.bincount(Words(part, KINDS).hash >> np.uint64(48), minlength=1 << 16)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])],
                              names=["bucket", "n"])

    counts = sh.stored(docs.select(F.col(text_col).cast("string")).mapInArrow(
        run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")), "words")
    every = counts.agg(F.sum("n")).first()[0] or 0
    mask = np.zeros(1 << 16, bool)
    # at most `anchors` rows: each holds a share of 1 / anchors
    mask[[r.bucket for r in counts.filter(F.col("n") * anchors >= every).collect()]] = True
    return mask


def signatures(texts: list[bytes], common: np.ndarray, chain: int = CHAIN) -> list[np.ndarray]:
    """Each text's set of spot signatures: distinct 32-bit hashes, ascending."""
    words = Words(texts, KINDS)
    n = len(words.hash)
    if not n:
        return [np.zeros(0, np.uint32) for _ in texts]
    common_word = common[words.hash >> np.uint64(48)]
    content = np.flatnonzero(~common_word)
    below = np.cumsum(~common_word) - ~common_word         # content words before each word
    opens = np.flatnonzero(np.diff(words.piece, prepend=-1))
    anchors = np.concatenate((np.flatnonzero(common_word), opens))
    anchor_hash = words.hash[anchors].copy()
    anchor_hash[len(anchors) - len(opens):] = 1             # the start of a line or sentence
    sig, doc = sh.mixed(anchor_hash), words.doc[anchors]
    whole = np.ones(len(anchors), bool)
    padded = np.append(content, n)
    hashes, docs = np.append(words.hash, np.uint64(0)), np.append(words.doc, -1)
    for k in range(chain):
        at = padded[np.minimum(below[anchors] + k, len(content))]
        same = docs[at] == doc
        if k == 0:
            whole = same
        sig = sh.mixed(sig * np.uint64(0x9E3779B97F4A7C15) + np.where(same, hashes[at], np.uint64(0)))
    sig, doc = sig[whole], doc[whole]
    # a text of common words alone: its first two words
    bare = np.setdiff1d(np.flatnonzero(words.counts), doc)
    if len(bare):
        first = words.first[bare]
        second = np.where(words.counts[bare] > 1, words.hash[np.minimum(first + 1, n - 1)], np.uint64(0))
        sig = np.append(sig, sh.mixed(words.hash[first] ^ sh.mixed(second)))
        doc = np.append(doc, bare)
    keys = np.unique(doc.astype(np.uint64) << np.uint64(32) | sig >> np.uint64(32))
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1).astype(np.uint64) << np.uint64(32))
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [low[a:b] for a, b in zip(cuts, cuts[1:])]


def fingerprint(signature_set: np.ndarray, kept: int = KEPT) -> str:
    """`<number of signatures>:<the smallest, 8 hex digits each>`."""
    return f"{len(signature_set):x}:" + signature_set[:kept].astype(">u4").tobytes().hex()


def length_class(size: int, floor: float = FLOOR) -> int:
    """The partition of a set by its length: sets that are two partitions apart
    differ in length by more than 1 / floor times."""
    return int(np.floor(np.log(max(size, 1)) / -np.log(floor)))


def _compare(a: np.ndarray, b: np.ndarray, kept: int, floor: float) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if abs(length_class(len(a), floor) - length_class(len(b), floor)) > 1:
        return 0.0
    if min(len(a), len(b)) < floor * max(len(a), len(b)):
        return 0.0
    reach = min([s[kept - 1] for s in (a, b) if len(s) > kept], default=None)
    a, b = a[:kept], b[:kept]
    if reach is not None:
        a, b = a[:np.searchsorted(a, reach, "right")], b[:np.searchsorted(b, reach, "right")]
    both = np.sort(np.concatenate((a, b)))
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def likeness(a: str, b: str, kept: int = KEPT, floor: float = FLOOR) -> float:
    """Jaccard coefficient of two fingerprints, 0 to 1."""
    def parse(f: str) -> np.ndarray:
        size, digits = f.split(":")
        known = np.frombuffer(bytes.fromhex(digits), ">u4").astype(np.uint32)
        # what is cut off is larger than all that is kept; only its number counts
        return np.concatenate((known, np.full(int(size, 16) - len(known), 0xFFFFFFFF, np.uint32)))
    return _compare(parse(a), parse(b), kept, floor)


_ORDER = "last boolean, turned long, digest long"
_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double, n_signatures long")


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The texts with their sort key: descending ids, nulls last, then a hash."""
    doc_id, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        doc_id.isNull().alias("last"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)).alias("turned"),
        F.xxhash64(text).alias("digest"), text.alias("text"))


def _bounds(rows: DataFrame) -> list[tuple]:
    """The first key of each block of consecutive documents, ascending."""
    spark = rows.sparkSession
    keys = sh.stored(rows.select("last", "turned", "digest", F.octet_length("text").alias("size")), "keys")
    size = keys.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    blocks = sh.tasks(spark, sh.chunk_count(size, BLOCK_BYTES))
    key = F.struct("last", "turned", "digest")
    firsts = (keys.select("last", "turned", "digest").distinct()
              .repartitionByRange(blocks, "last", "turned", "digest")
              .select(F.spark_partition_id().alias("part"), key.alias("key"))
              .groupBy("part").agg(F.min("key").alias("key")))
    return sorted(tuple(r.key) for r in firsts.collect())     # one row a block


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           anchors: int = ANCHORS, chain: int = CHAIN, kept: int = KEPT,
           floor: float = FLOOR) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the
    likeness of its fingerprint to that and to the next document's."""
    spark = docs.sparkSession
    common = common_words(docs, text_col, anchors)
    rows = _ordered(docs, id_col, text_col)
    bounds = _bounds(rows)

    def deal(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            seen: dict = {}
            for i, k in enumerate(keys):       # equal rows travel once, with their number
                seen.setdefault(k, [i, 0])[1] += 1
            take, block, guest, copies = [], [], [], []
            for k, (i, n) in seen.items():
                b = bisect.bisect_right(bounds, k) - 1
                take.append(i), block.append(b), guest.append(False), copies.append(n)
                if bounds[b] == k:
                    take.append(i), block.append((b - 1) % len(bounds))
                    guest.append(True), copies.append(0)
            part = batch.take(pa.array(take, pa.int64()))
            yield pa.record_batch(
                [pa.array(block, pa.int32()), pa.array(guest), *part.columns[:3],
                 pa.array(copies, pa.int64()), part.column(3)],
                names=["block", "guest", "last", "turned", "digest", "copies", "text"])

    def runs(batches):
        """[block, id, copies, text, next text] of each document, in order."""
        held = None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for block, guest, last, turned, digest, copies, text in zip(*columns, batch.column(6)):
                key = (last, turned, digest)
                if held and held[0] == block and not guest and held[1] == key:
                    held[2] += copies
                    continue
                text = text.as_py()
                if held:
                    if held[0] == block:
                        yield held[1], held[2], held[3], text
                    held = None
                if not guest:
                    held = [block, key, copies, text]

    def compare(batches):
        for part in by_size(runs(batches), lambda r: len(r[2]) + len(r[3]), BATCH_BYTES):
            texts = [r[2] for r in part]
            changed = []
            for _, _, text, after in part:
                third = len(text) // 3
                changed.append((text[:len(text) - third] + after[:third]).encode())
            # the next document is mostly the next of this list
            other = [j + 1 if j + 1 < len(part) and texts[j + 1] == r[3] else None
                     for j, r in enumerate(part)]
            extra = [j for j, o in enumerate(other) if o is None]
            sets = signatures([t.encode() for t in texts] + changed
                              + [part[j][3].encode() for j in extra], common, chain)
            n = len(part)
            for k, j in enumerate(extra):
                other[j] = 2 * n + k
            out = []
            for j, ((last, turned, _), copies, text, _) in enumerate(part):
                row = (None if last else ~turned, len(text), hashlib.sha256(changed[j]).hexdigest(),
                       fingerprint(sets[j], kept), fingerprint(sets[n + j], kept),
                       _compare(sets[j], sets[n + j], kept, floor),
                       _compare(sets[j], sets[other[j]], kept, floor), len(sets[j]))
                out.append((row, copies))
            for a in range(0, len(out), 2_000):
                yield from _repeated(out[a:a + 2_000])

    dealt = rows.mapInArrow(deal, f"block int, guest boolean, {_ORDER}, copies long, text string")
    return (dealt.repartition(max(1, len(bounds)), "block")
            .sortWithinPartitions("block", "guest", "last", "turned", "digest")
            .mapInArrow(compare, _EDITED))


_EDITED_TYPES = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()),
                           ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                           ("near_next", pa.float64()), ("n_signatures", pa.int64())])


def _repeated(out: list[tuple]):
    """Record batches of the rows, each as often as its document occurs."""
    batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*(r for r, _ in out)), _EDITED_TYPES)],
                            schema=_EDITED_TYPES)
    index = np.repeat(np.arange(len(out)), [n for _, n in out])
    for a in range(0, len(index), 2_000):
        yield batch.take(pa.array(index[a:a + 2_000]))
