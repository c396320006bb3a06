"""Helpers the operators share: table access, scratch tables, hashed chunks."""

from __future__ import annotations

import math
import uuid

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_ID = np.iinfo(np.int64).max   # a null id sorts after every real one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, or, where that
    is unset (tests), a folder in the session's warehouse. On a cluster a
    warehouse on the machine's own disk is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or spark.conf.get("spark.sql.warehouse.dir")
    own_disk = base.startswith("file:") or "://" not in base
    if not named and own_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/llm-scratch"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts the lineage,
    and a lost executor re-reads it instead of computing it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks(spark: SparkSession, groups: int) -> int:
    """Partitions for so many groups of bounded size: at most four rounds of the
    cluster's shuffle partitions."""
    return max(1, min(groups, 4 * partitions(spark)))


def row_keys(id_col: str, text_col: str):
    """Two independent hashes of id and text: `place` deals rows out to chunks,
    `name` names them within one."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return [F.xxhash64(doc_id, text).alias("place"), F.xxhash64(text, doc_id).alias("name")]


def text_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, place, name, digest, bytes) of every row, stored: what whole-text
    decisions need, a small part of the text's size."""
    text = F.col(text_col).cast("string")
    return stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *row_keys(id_col, text_col),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes")), "keys")


def copies(keys: DataFrame, least_bytes: int) -> DataFrame:
    """The keys of the rows whose whole text, of least_bytes at least, a smaller id
    has too. A digest that very many rows share is split by AQE: both sides of
    the join are plain exchanges."""
    long_enough = keys.filter(F.col("bytes") >= least_bytes)
    first = stored(long_enough.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "first")
    return long_enough.join(first, "digest").filter(
        "first is not null and (doc_id is null or doc_id > first)").select(*keys.columns)


def sizes(keys: DataFrame) -> tuple[int, int]:
    """Rows and bytes of the keyed texts."""
    r = keys.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).first()
    return int(r.n), int(r.b or 0)


def chunked(docs: DataFrame, id_col: str, text_col: str, n_chunks: int,
            carry: list[str] | None = None) -> DataFrame:
    """(chunk, name, doc_id, text, rest): documents dealt by a hash of id and text.

    Several steps of one query read this exchange; Spark runs it once and
    reuses it. A partition may hold several chunks: tasks follow the cluster's
    shuffle partitions, memory the chunk. `carry` names further columns to keep
    in the struct `rest`.
    """
    place, name = row_keys(id_col, text_col)
    cols = [F.pmod(place, F.lit(n_chunks)).cast("int").alias("chunk"), name,
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).cast("string").alias("text")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("rest"))
    return docs.select(*cols).repartition(tasks(docs.sparkSession, n_chunks), "chunk")


def to_chunks(rows: DataFrame, n_chunks: int) -> DataFrame:
    """(chunk, copy): names sent to the chunks their rows were dealt to."""
    return rows.select(
        F.pmod(F.col("place"), F.lit(n_chunks)).cast("int").alias("chunk"),
        F.col("name").alias("copy")).distinct().repartition(tasks(rows.sparkSession, n_chunks), "chunk")


def named_rows(names, wanted) -> np.ndarray:
    """Which rows' names are among the wanted ones (nulls name none)."""
    return np.isin(names.to_numpy(), wanted.drop_null().to_numpy())


def chunk_count(total_bytes: int, chunk_bytes: int) -> int:
    return max(1, math.ceil(total_bytes / chunk_bytes))


# --- packed arrays: sorted hashes as delta byte planes ---------------------

def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending uint64 values as zstd-compressed byte planes of their deltas."""
    deltas = np.diff(values, prepend=np.uint64(0))
    planes = deltas.astype("<u8").view(np.uint8).reshape(-1, 8).T.copy()
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    deltas = raw.reshape(8, -1).T.copy().view("<u8").reshape(-1)
    return np.cumsum(deltas, dtype=np.uint64)


def sorted_union(blobs) -> np.ndarray:
    """All values of a column of packed arrays (nulls skipped), ascending."""
    parts = [unpack_sorted(x.as_py()) for x in blobs if x.as_py() is not None]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def pack_ints(values: np.ndarray) -> bytes:
    """int64 values in any order as zstd-compressed byte planes."""
    planes = values.astype("<i8").view(np.uint8).reshape(-1, 8).T.copy()
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack_ints(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return raw.reshape(8, -1).T.copy().view("<i8").reshape(-1)


def pack_bits(mask: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(mask).tobytes())


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


# --- polynomial window hashes over uint64 symbols --------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads a hash over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Hashes of windows of any length over one symbol array, modulo 2**64.

    `base` is odd, so its inverse exists and a window's hash doesn't depend
    on where the window stands.
    """

    def __init__(self, symbols: np.ndarray, base: int):
        n = len(symbols)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers(base, n), out=self.prefix[1:])
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)

    def windows(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.prefix[starts + length] - self.prefix[starts]) * self.inverse[starts])

    def all_windows(self, length: int) -> np.ndarray:
        return mixed((self.prefix[length:] - self.prefix[:-length])
                     * self.inverse[:len(self.prefix) - length])


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of the positions under any window [s, s + length)."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
