"""Approximate nearest neighbours on shifted Hilbert curves.

Each curve projects the vectors onto a few random orthogonal directions, shifts
the grid, and orders all vectors by their Hilbert key. Spark range-partitions
that order; a query looks at the `window` places on either side of its own on
every curve, and what the windows hold is reranked by exact distance.

The projections' ranges and the window are fitted on a bounded sample of
vectors: the window is the smallest share of all rows whose recall against
brute force on the sample reaches `target` (a sample is thinner than the whole,
so its recall is the lower one). Every vector is indexed. Vectors without
structure need a large share; the work then grows like a search in blocks.

Equal vectors are indexed once and stand for their k + 1 smallest ids, which
is all a result can show of them; any number of copies is one point.

Results for odd input: vectors that are null, zero, of another dimension than
most, or with null or non-finite components take no part; repeated rows count
once; an id with several vectors takes part with each and a result shows its
nearest; null ids take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as sh

CURVES = 16
DIRECTIONS = 8
BITS = 7                    # per direction: 56-bit keys
SAMPLE_ROWS = 20_000        # bound of the fitting sample
SAMPLE_QUERIES = 200
TARGET = 0.95
LEAST_WINDOW = 512
CELL_ROWS = 4096
SHARES = (1 / 512, 1 / 256, 1 / 128, 1 / 64, 1 / 48, 1 / 32, 1 / 24, 1 / 16, 1 / 12, 1 / 8, 1 / 4)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each grid cell (rows of coordinates) along the Hilbert curve.

    Coordinates become the transposed index by undoing the curve's excess
    rotations and reflections from the top bit down, then Gray-decoding.
    """
    x = cells.astype(np.uint64)
    n, dims = x.shape
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for i in range(dims):
            flip = (x[:, i] & q) != 0
            swap = np.where(flip, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(flip, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    fix = np.zeros(n, np.uint64)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        fix ^= np.where((x[:, dims - 1] & q) != 0, q - one, np.uint64(0))
    x ^= fix[:, None]
    key = np.zeros(n, np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[:, i] >> np.uint64(level)) & one)
    return key.astype(np.int64)


class Curves:
    """Projections, ranges and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, directions: int = DIRECTIONS,
                 bits: int = BITS, seed: int = 5):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        p = min(directions, dim)
        self.bits, self.n = bits, curves
        self.axes = [np.linalg.qr(rng.standard_normal((dim, p)))[0] for _ in range(curves)]
        self.low, self.width = [], []
        for axes in self.axes:
            y = sample @ axes
            low, high = np.quantile(y, 0.001, axis=0), np.quantile(y, 0.999, axis=0)
            self.low.append(low)
            self.width.append(max(float((high - low).max()), 1e-12))
        self.shift = rng.random((curves, p)) * 0.25

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        y = (vectors @ self.axes[curve] - self.low[curve]) / self.width[curve]
        top = (1 << self.bits) - 1
        return hilbert_keys(np.clip((y * 0.75 + self.shift[curve]) * (top + 1), 0, top)
                            .astype(np.int64), self.bits)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, each from its own differences."""
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(-1))


def fitted_share(sample: np.ndarray, curves: Curves, k: int, target: float,
                 queries: int = SAMPLE_QUERIES) -> float:
    """Smallest of SHARES whose recall on the sample reaches the target; 1, which
    looks at every vector, if none does."""
    n = len(sample)
    if n <= k + 1:
        return 1.0
    ask = np.linspace(0, n - 1, min(queries, n)).astype(np.int64)
    square = (sample ** 2).sum(1)
    d = square[ask][:, None] + square - 2 * sample[ask] @ sample.T
    d[np.arange(len(ask)), ask] = np.inf
    near = np.argpartition(d, k, axis=1)[:, :k]
    gap = np.full(near.shape, n)                     # least distance in places on any curve
    for c in range(curves.n):
        place = np.empty(n, np.int64)
        place[np.argsort(curves.keys(sample, c), kind="stable")] = np.arange(n)
        gap = np.minimum(gap, np.abs(place[near] - place[ask][:, None]))
    for share in SHARES:
        if (gap <= share * n).mean() >= target:
            return share
    return 1.0


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    kind = dict(vectors.dtypes)[vec_col]
    v = F.col(vec_col) if kind == "array<float>" else F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        "vec_id is not null and v is not null and size(v) > 0").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).filter(
        F.exists("v", lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (sizes.n if sizes else 0))


def _array(column) -> np.ndarray:
    """Rows of a list column of one length as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    n = len(flat)
    if not n:
        return np.zeros((0, 1))
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def search(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id",
           vec_col: str = "embedding", curves: int = CURVES, target: float = TARGET,
           window: int | None = None) -> DataFrame:
    """The k nearest of every query: query_id, rank, vec_id, score.

    `is_query` is a condition on the column vec_id; `window` overrides the
    fitted number of places on either side.
    """
    spark = vectors.sparkSession
    rows = sh.stored(_usable(vectors, id_col, vec_col), "vectors")
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    members = sh.stored(rows.withColumn("nth", F.row_number().over(by_vector)).filter(
        F.col("nth") <= k + 1).withColumn("rep", F.first("vec_id").over(
            by_vector.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))), "members")
    points = members.filter("nth = 1").select("rep", "v")
    asked = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v")
    asked = sh.stored(asked.join(points, "v").select("query_id", "rep"), "asked")
    n = points.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = _array(points.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE_ROWS).select("v")
                    .toArrow()["v"])
    grid = Curves(sample, curves)
    kind = dict(points.dtypes)["v"]
    if window is None:
        window = max(LEAST_WINDOW, math.ceil(fitted_share(sample, grid, k, target) * n))

    def keyed(batches):
        for b in batches:
            v = _array(b.column(1))
            for c in range(grid.n):
                yield pa.record_batch([pa.array(np.full(len(v), c, np.int32)),
                                       pa.array(grid.keys(v, c)), *b.columns],
                                      names=["curve", "key", "rep", "v", "asked"])

    marked = points.join(asked.select("rep", F.lit(True).alias("asked")).distinct(), "rep", "left")
    parts = max(curves, sh.partitions(spark))
    dealt = marked.mapInArrow(
        keyed, f"curve int, key long, rep long, v {kind}, asked boolean"
    ).repartitionByRange(parts, "curve", "key", "rep").sortWithinPartitions("curve", "key", "rep")

    def numbered(batches):
        pid, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve = b.column(0).to_numpy()
            nth = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                mine = np.flatnonzero(curve == c)
                nth[mine] = seen.get(int(c), 0) + np.arange(len(mine))
                seen[int(c)] = seen.get(int(c), 0) + len(mine)
            yield pa.record_batch([b.column(0), pa.array(np.full(len(curve), pid, np.int32)),
                                   pa.array(nth), *b.columns[2:]],
                                  names=["curve", "part", "nth", "rep", "v", "asked"])

    placed = sh.stored(dealt.mapInArrow(
        numbered, f"curve int, part int, nth long, rep long, v {kind}, asked boolean"), "placed")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("rows")).select(
        "curve", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = placed.join(starts, ["curve", "part"]).select(
        "curve", (F.col("start") + F.col("nth")).alias("pos"), "rep", "v", "asked")
    # own column identities: both sides of the cogroup come from `place`
    cells = place.select(F.col("curve").alias("at_curve"),
                         F.floor(F.col("pos") / CELL_ROWS).alias("at_cell"),
                         F.col("pos").alias("at"), F.col("rep").alias("point"),
                         F.col("v").alias("vec"))
    last = (n - 1) // CELL_ROWS
    looks = place.filter("asked").withColumn("cell", F.explode(F.sequence(
        F.greatest(F.lit(0), F.floor((F.col("pos") - window) / CELL_ROWS)),
        F.least(F.lit(last), F.floor((F.col("pos") + window) / CELL_ROWS))))).select(
        "curve", "cell", "pos", "rep", "v")

    def rerank(key, queries, points):
        out = [[], [], []]
        if queries.num_rows and points.num_rows:
            qv, pv = _array(queries["v"]), _array(points["vec"])
            qp, pp = queries["pos"].to_numpy(), points["at"].to_numpy()
            qi, pi = queries["rep"].to_numpy(), points["point"].to_numpy()
            step = max(1, 2_000_000 // (len(pp) * pv.shape[1]))   # bounds the differences' memory
            for at in range(0, len(qp), step):
                d = distances(qv[at:at + step], pv)
                d[np.abs(qp[at:at + step, None] - pp) > window] = np.inf
                for r in range(len(d)):
                    ok = np.flatnonzero(np.isfinite(d[r]))
                    if len(ok) > k + 1:
                        edge = np.partition(d[r][ok], k)[k]
                        ok = ok[d[r][ok] <= edge]
                    ok = ok[np.lexsort((pi[ok], d[r][ok]))][:k + 1]
                    out[0].append(np.full(len(ok), qi[at + r]))
                    out[1].append(pi[ok])
                    out[2].append(d[r][ok])
        cat = [np.concatenate(x) if x else np.zeros(0, t)
               for x, t in zip(out, (np.int64, np.int64, np.float64))]
        return pa.table({"q": pa.array(cat[0], pa.int64()), "rep": pa.array(cat[1], pa.int64()),
                         "score": pa.array(cat[2], pa.float64())})

    found = looks.groupBy("curve", "cell").cogroup(cells.groupBy("at_curve", "at_cell")).applyInArrow(
        rerank, "q long, rep long, score double")
    nearest = found.groupBy("q", "rep").agg(F.min("score").alias("score"))

    def first_of(df, group, count):
        order = Window.partitionBy(group).orderBy("score", "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)

    nearest = first_of(nearest.withColumnRenamed("rep", "vec_id"), "q", k + 1).select(
        "q", F.col("vec_id").alias("rep"), "score")
    expanded = nearest.join(members.select("rep", "vec_id").distinct(), "rep").groupBy(
        "q", "vec_id").agg(F.min("score").alias("score"))
    expanded = first_of(expanded, "q", k + 1).drop("rank")
    answers = asked.join(expanded, asked.rep == expanded.q).filter(
        "query_id != vec_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return first_of(answers, "query_id", k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score")
