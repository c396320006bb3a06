"""Quality classifier: a factorisation machine.

Inputs of a score are the text's hashed words, statistics of its structure and
the named metadata columns. The model is
    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],
the sum-of-squares identity, which scores all pairwise interactions in time
linear in the number of inputs.

It is fitted on at most `max_rows` labelled rows (the bound is a parameter; the
rows are those with the smallest hash of their id). Scoring is a narrow scan
over whole texts.

Results for odd input: a null text scores like an empty one; rows whose label
is null or not 0 or 1 are not learned from, of several labels of an id the
larger counts, of several texts the one with the smallest hash; a null metadata
value has its own input; repeated rows are scored alike; without labelled rows
every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TRAIN_ROWS = 20_000
WORD_BITS = 15
FACTORS = 8
THRESHOLD = 0.3
_STATS = 12
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_DIGITS = b"0123456789"
_UPPER = bytes(range(65, 91))
_WORD_BUCKETS = 1 << WORD_BITS


class _Buckets(dict):
    """Hash bucket of a word; emptied when it holds 200,000."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        self[word] = value = zlib.crc32(word) & (_WORD_BUCKETS - 1)
        return value


def statistics(raw: bytes, words: list[bytes], codes: np.ndarray) -> list[float]:
    """Structure of a text: sizes, shares of character kinds, repetition."""
    n, m = max(1, len(raw)), max(1, len(words))
    same = int((codes[1:] == codes[:-1]).sum()) if len(codes) > 1 else 0
    distinct = len(np.unique(codes)) if len(codes) else 0
    lines = raw.count(b"\n") + 1
    return [math.log1p(len(raw)), math.log1p(len(words)), (n - len(words)) / m / 10,
            (n - len(raw.translate(None, _PUNCT))) / n, (n - len(raw.translate(None, _DIGITS))) / n,
            (n - len(raw.translate(None, _UPPER))) / n, same / m, distinct / m,
            distinct / math.sqrt(m), math.log1p(m / lines),
            (raw.count(b".") + raw.count(b",")) / m, raw.count(b"|") / m]


class Features:
    """Sparse rows (indices, values) of texts and metadata."""

    def __init__(self, n_meta: int):
        self.buckets, self.n_meta = _Buckets(), n_meta
        self.dim = _WORD_BUCKETS + _STATS + 2 * n_meta

    def row(self, text: str | None, meta: list) -> tuple[np.ndarray, np.ndarray]:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        words = raw.split()
        codes = np.fromiter(map(self.buckets.__getitem__, words), np.int32, len(words))
        index, count = np.unique(codes, return_counts=True)
        value = np.log1p(count)
        if len(value):
            value = value / math.sqrt(float(value @ value))
        dense = statistics(raw, words, codes)
        for v in meta:
            known = v is not None and math.isfinite(float(v))
            dense += [math.copysign(math.log1p(abs(float(v))), float(v)) if known else 0.0,
                      0.0 if known else 1.0]
        return (np.concatenate((index, _WORD_BUCKETS + np.arange(len(dense)))).astype(np.int32),
                np.concatenate((value, dense)).astype(np.float32))


class FactorisationMachine:
    def __init__(self, dim: int, factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim, self.w0 = dim, 0.0
        self.w = np.zeros(dim, np.float32)
        self.v = (rng.standard_normal((dim, factors)) * 0.01).astype(np.float32)
        self.shift = np.zeros(dim - _WORD_BUCKETS, np.float32)
        self.scale = np.ones(dim - _WORD_BUCKETS, np.float32)

    def _scaled(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        value = value.copy()
        dense = index >= _WORD_BUCKETS
        at = index[dense] - _WORD_BUCKETS
        value[dense] = np.clip((value[dense] - self.shift[at]) * self.scale[at], -4, 4)
        return value

    def _forward(self, index, value, first):
        v = self.v[index] * value[:, None]
        s = np.add.reduceat(v, first, axis=0)
        pairs = (s * s).sum(1) - np.add.reduceat((v * v).sum(1), first)
        return self.w0 + np.add.reduceat(self.w[index] * value, first) + 0.5 * pairs, v, s

    @staticmethod
    def _stack(rows):
        sizes = np.array([len(i) for i, _ in rows])
        return (np.concatenate([i for i, _ in rows]), np.concatenate([x for _, x in rows]),
                np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)

    def score(self, rows) -> np.ndarray:
        """Probability of label 1 for each sparse row."""
        index, value, first, _ = self._stack(rows)
        z, _, _ = self._forward(index, self._scaled(index, value), first)
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -35, 35)))

    def fit(self, rows, labels: np.ndarray, epochs: int = 12, batch: int = 256,
            rate: float = 0.1, decay: float = 1e-4, seed: int = 11) -> None:
        """AdaGrad on the logistic loss."""
        if not len(rows):
            return
        n_dense = self.dim - _WORD_BUCKETS
        dense = np.stack([x[-n_dense:] for _, x in rows])
        self.shift = dense.mean(0)
        self.scale = (1 / np.maximum(dense.std(0), 1e-3)).astype(np.float32)
        rng = np.random.default_rng(seed)
        rate_at = float(np.clip(labels.mean(), 0.01, 0.99))
        self.w0 = math.log(rate_at / (1 - rate_at))
        g0, gw, gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                take = order[at:at + batch]
                index, value, first, sizes = self._stack([rows[i] for i in take])
                value = self._scaled(index, value)
                z, v, s = self._forward(index, value, first)
                err = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels[take]) / len(take)
                e = np.repeat(err, sizes).astype(np.float32) * value
                dv = e[:, None] * (np.repeat(s, sizes, axis=0) - v)
                by = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[by], prepend=-1))
                used = index[by][starts]
                dw = np.add.reduceat(e[by], starts) + decay * self.w[used]
                dv = np.add.reduceat(dv[by], starts, axis=0) + decay * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * dv / np.sqrt(gv[used])
                g0 += float(err.sum()) ** 2
                self.w0 -= rate * float(err.sum()) / math.sqrt(g0)


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves remainder 0 by 5 (null ids: False)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", meta_cols: tuple[str, ...] = (),
          max_rows: int = MAX_TRAIN_ROWS) -> FactorisationMachine:
    """Fit on at most max_rows labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).cast("long").alias("_id"),
                          F.col(label_col).cast("int").alias("_label")).filter(
        "_label in (0, 1) and _id is not null").filter(~held_out("_id"))
    # at most max_rows rows of two numbers, so the broadcast is bounded
    chosen = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(
        F.xxhash64("_id"), "_id").limit(max_rows)
    n_meta = len(meta_cols)
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"),
        *[F.col(c).cast("double").alias(f"_m{i}") for i, c in enumerate(meta_cols)]).join(
        F.broadcast(chosen), "_id").select(
        "_id", "_label", F.xxhash64("_text").alias("_hash"), "_text", *[f"_m{i}" for i in range(n_meta)])

    def run(batches):
        make = Features(n_meta)
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            feats = [make.row(r[3], list(r[4:])) for r in zip(*cols)]
            yield pa.record_batch([*b.columns[:3],
                                   pa.array([i.astype(np.uint16).tobytes() for i, _ in feats], pa.binary()),
                                   pa.array([x.tobytes() for _, x in feats], pa.binary())],
                                  names=["id", "label", "hash", "index", "value"])

    # one row per chosen id, so at most max_rows rows reach the driver, a partition at a
    # time; it keeps them in three buffers, without objects for each row's bytes
    sample = rows.mapInArrow(run, "id long, label int, hash long, index binary, value binary").groupBy(
        "id").agg(F.min(F.struct("hash", "label", "index", "value")).alias("r")).select(
        "id", "r.label", "r.index", "r.value")
    about, index, value = [], bytearray(), bytearray()
    for one, label, at, x in sample.toLocalIterator():
        about.append((one, label, len(x) // 4))
        index += at
        value += x
    about = np.array(about, np.int64).reshape(-1, 3)
    ends = np.cumsum(about[:, 2])
    index, value = np.frombuffer(index, np.uint16), np.frombuffer(value, np.float32)
    order = np.argsort(about[:, 0], kind="stable")
    feats = [(index[b - n:b], value[b - n:b]) for b, n in zip(ends[order], about[order, 2])]
    model = FactorisationMachine(_WORD_BUCKETS + _STATS + 2 * n_meta)
    model.fit(feats, about[order, 1].astype(np.float32))
    return model


def _scores(model, texts, metas, make) -> np.ndarray:
    out = []
    for at in range(0, len(texts), 512):
        rows = [make.row(t.as_py(), [m[k] for m in metas])
                for k, t in enumerate(texts[at:at + 512], at)]
        out.append(model.score(rows))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id",
          text_col: str = "text", meta_cols: tuple[str, ...] = (),
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    n_meta = len(meta_cols)

    def run(batches):
        make = Features(n_meta)
        for b in batches:
            p = _scores(model, b.column(2), [c.to_pylist() for c in b.columns[3:]], make)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(p),
                                   pa.array((p >= threshold).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"),
                       *[F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(meta_cols)]
                       ).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, model: FactorisationMachine, text_col: str = "text",
             meta_cols: tuple[str, ...] = (), threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored at the threshold or above, with all their columns."""
    n_meta, at = len(meta_cols), docs.columns.index(text_col)
    meta_at = [docs.columns.index(c) for c in meta_cols]

    def run(batches):
        make = Features(n_meta)
        for b in batches:
            p = _scores(model, b.column(at), [b.column(i).to_pylist() for i in meta_at], make)
            yield b.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)
