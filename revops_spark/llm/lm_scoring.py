"""LM scoring by masked pseudo-likelihood.

A bidirectional window network predicts every word from the words on both
sides: the embeddings of the `RADIUS` words before and after it (a padding
embedding beyond the text's ends), one tanh layer, then the word's code. Words
are hashed to 4096 codes of two base-64 digits, predicted one after the other:
log P(high | context) + log P(low | context, high). A document's score is the
sum over all its words.

Training data are the windows around every word of every document, so they grow
with the corpus. Texts are written to the shared folder as their words' codes, which
training and scoring both read; they are dealt into shards, long ones in spans with
the words around, and a shard takes the windows out. In each round every shard
trains the current network on its windows (AdaGrad in numpy) and Spark averages
the shards' parameters by block, weighted by windows; only the average, whose
size is fixed, reaches the driver.

Results for odd input: a null or empty text has no words, score 0 and no
perplexity; repeated rows count and are scored each; null ids are kept; without
any words the untrained network is used; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as sh
from ._words import by_size

DIGIT = 64
CODES = DIGIT * DIGIT
RADIUS = 3
WIDTH = 12                  # of an embedding
HIDDEN = 32
STRIDE = 1                  # every word is a target
SPAN = 16_384               # words in a row
SHARD_WINDOWS = 2_000_000
ROUNDS = 3
BATCH = 1024
SCORED = 2_000_000          # bytes of codes scored at once
RATE = 0.08
BLOCKS = 32                 # parameter blocks averaged apart
AVERAGED = 1024             # shards whose parameters one task averages, 7.5 kB each
_OFFSETS = [o for o in range(-RADIUS, RADIUS + 1) if o]
_SIDES = len(_OFFSETS)
_PAD = CODES


class _Codes:
    """Codes of words, each hashed: a table of the words seen takes longer to search."""

    def __call__(self, words: list[bytes]) -> np.ndarray:
        digests = map(xxhash.xxh3_64_intdigest, words, itertools.repeat(3))
        return (np.fromiter(digests, np.uint64, len(words)) & np.uint64(CODES - 1)).astype(np.int32)


def codes_of(text: str | None, codes: _Codes) -> np.ndarray:
    return codes(text.encode("utf-8", "surrogatepass").split() if text else [])


def padded(codes: np.ndarray) -> np.ndarray:
    pad = np.full(RADIUS, _PAD, np.int32)
    return np.concatenate((pad, codes, pad))


class Network:
    """Parameters and the two directions of the window network."""

    SHAPES = [("embed", (CODES + 1, WIDTH)), ("inner", (_SIDES * WIDTH, HIDDEN)),
              ("inner_bias", (HIDDEN,)), ("high", (HIDDEN, DIGIT)), ("high_bias", (DIGIT,)),
              ("low", (HIDDEN, DIGIT)), ("low_by_high", (DIGIT, DIGIT))]

    def __init__(self, flat: np.ndarray | None = None, seed: int = 1):
        sizes = [int(np.prod(s)) for _, s in self.SHAPES]
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([
                np.zeros(n) if name.endswith("bias") or name == "low_by_high"
                else rng.standard_normal(n) * (0.1 if name == "embed" else 1 / math.sqrt(shape[0]))
                for (name, shape), n in zip(self.SHAPES, sizes)])
        self.flat = flat.astype(np.float32)
        at = 0
        for (name, shape), n in zip(self.SHAPES, sizes):
            setattr(self, name, self.flat[at:at + n].reshape(shape))     # views
            at += n

    # -- training
    def train(self, windows: np.ndarray, seed: int) -> None:
        """One pass of AdaGrad over rows of (context codes, code)."""
        rng = np.random.default_rng(seed)
        grads, seen = Network(np.empty_like(self.flat)), np.full_like(self.flat, 1e-4)
        windows, order = np.ascontiguousarray(windows), rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            batch = windows.take(order[at:at + BATCH], axis=0)
            self._backward(batch[:, :_SIDES], batch[:, _SIDES], grads)
            grad = grads.flat
            step = grad * np.float32(RATE)
            seen += np.multiply(grad, grad, out=grad)
            step /= np.sqrt(seen, out=grad)
            self.flat -= step

    def _gradients(self, context, code):
        grads = Network(np.empty_like(self.flat))
        self._backward(context, code, grads)
        return [(name, getattr(grads, name), None) for name, _ in self.SHAPES]

    def _logits(self, h, high):
        """Of the high digits, and of the low ones after them: (2, n, DIGIT)."""
        out = np.empty((2, len(h), DIGIT), np.float32)
        np.matmul(h, self.high, out=out[0])
        np.matmul(h, self.low, out=out[1])
        out[0] += self.high_bias
        out[1] += self.low_by_high.take(high, axis=0)
        return out

    def _backward(self, context, code, grads: Network) -> None:
        """The mean loss's gradients, written into `grads`."""
        n = len(code)
        code = code.astype(np.intp)
        high, low = code // DIGIT, code % DIGIT
        flat = context.reshape(-1).astype(np.intp)
        x = self.embed.take(flat, axis=0).reshape(n, -1)
        h = x @ self.inner
        h += self.inner_bias
        np.tanh(h, out=h)
        d, sums = _exponentials(lambda: self._logits(h, high))
        d *= np.float32(1 / n) / sums
        place = np.arange(0, n * DIGIT, DIGIT)
        d[0].reshape(-1)[place + high] -= np.float32(1 / n)
        d[1].reshape(-1)[place + low] -= np.float32(1 / n)
        np.matmul(h.T, d[0], out=grads.high)
        np.matmul(h.T, d[1], out=grads.low)
        one = np.ones(n, np.float32)
        np.matmul(one, d[0], out=grads.high_bias)
        _add_rows(grads.low_by_high, _LOW_PAIRS.take(high, axis=0), d[1])
        dz = d[0] @ self.high.T
        dz += d[1] @ self.low.T
        dz *= 1 - h * h
        np.matmul(x.T, dz, out=grads.inner)
        np.matmul(one, dz, out=grads.inner_bias)
        _add_rows(grads.embed, _EMBED_PAIRS.take(flat, axis=0), dz @ self.inner.T)

    # -- scoring
    def log_probabilities(self, sequence: np.ndarray) -> np.ndarray:
        """Of every code in a padded sequence; pads between texts get a value too."""
        out = np.empty(len(sequence) - 2 * RADIUS)
        before, after = np.split(self.inner, 2)
        inner = np.concatenate((before, np.zeros((WIDTH, HIDDEN), np.float32), after))
        for at in range(0, len(out), 1024):
            n = min(1024, len(out) - at)
            near = sequence[at:at + n + 2 * RADIUS]
            # the embeddings around a word lie in a row, its own among them
            row = self.embed.take(near, axis=0).reshape(-1)
            x = np.lib.stride_tricks.sliding_window_view(row, len(inner))[::WIDTH]
            h = np.ascontiguousarray(x) @ inner
            h += self.inner_bias
            np.tanh(h, out=h)
            code = np.minimum(near[RADIUS:RADIUS + n], CODES - 1).astype(np.intp)
            high, low = code // DIGIT, code % DIGIT
            logits = self._logits(h, high)
            place = np.arange(0, n * DIGIT, DIGIT)
            picked = logits[0].reshape(-1)[place + high].astype(np.float64)
            picked += logits[1].reshape(-1)[place + low]
            np.clip(logits, -60, 60, out=logits)
            sums = _sums(np.exp(logits, out=logits))
            out[at:at + n] = picked - np.log(sums).sum(0)[:, 0]
        return out


def _sums(exponentials: np.ndarray) -> np.ndarray:
    """Of every row and digit."""
    return (exponentials.reshape(-1, DIGIT) @ np.ones(DIGIT, np.float32)).reshape(2, -1, 1)


def _exponentials(logits) -> tuple[np.ndarray, np.ndarray]:
    """exp of `logits()` up to a factor for each row and digit, and the sums: where
    float32 would not hold these, the largest logit is taken out first."""
    out = logits()
    with np.errstate(over="ignore"):
        sums = _sums(np.exp(out, out=out))
    if not 1e-26 < sums.min() <= sums.max() < 1e26:
        out = logits()
        out -= out.max(2, keepdims=True)
        sums = _sums(np.exp(out, out=out))
    return out, sums


#: places of a row's columns, two by two
_EMBED_PAIRS = np.arange((CODES + 1) * WIDTH // 2).reshape(CODES + 1, -1)
_LOW_PAIRS = np.arange(DIGIT * DIGIT // 2).reshape(DIGIT, -1)


def _add_rows(total: np.ndarray, pairs: np.ndarray, values: np.ndarray) -> None:
    """total = the sum of the values at each row's place. Two columns are added at
    once, as the parts of a complex number."""
    total[...] = 0
    np.add.at(total.reshape(-1).view(np.complex64), pairs.reshape(-1),
              values.reshape(-1).view(np.complex64))


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, codes, crc): every text as its words' two-byte codes, `RADIUS` paddings
    around, and its checksum, by which a stride's first target is chosen."""

    def run(batches):
        codes = _Codes()
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.record_batch([
                b.column(0),
                pa.array([padded(codes_of(t, codes)).astype(np.uint16).tobytes() for t in texts], pa.binary()),
                pa.array([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.int64())],
                names=["doc_id", "codes", "crc"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, codes binary, crc long")


def training_windows(docs: DataFrame, text_col: str, stride: int) -> DataFrame:
    """The `spans` of texts."""
    return spans(coded(docs.select(F.lit(None).alias("doc_id"), F.col(text_col).alias("text"))), stride)


def spans(words: DataFrame, stride: int) -> DataFrame:
    """(codes, phase, n): spans of `coded` texts as two-byte codes with `RADIUS` codes around,
    the first target's place, and the number of targets, every stride-th word."""

    def run(batches):
        for b in batches:
            cut, phases, count = [], [], []
            for codes, crc in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                phase, n = crc % stride, len(codes) // 2 - 2 * RADIUS
                for a in range(0, n, SPAN):
                    size, first = min(SPAN, n - a), (phase - a) % stride
                    if first < size:
                        cut.append(codes[2 * a:2 * (a + size + 2 * RADIUS)])
                        phases.append(first)
                        count.append(len(range(first, size, stride)))
            yield pa.record_batch([pa.array(cut, pa.binary()), pa.array(phases, pa.int64()),
                                   pa.array(count, pa.int64())], names=["codes", "phase", "n"])

    return words.select("codes", "crc").mapInArrow(run, "codes binary, phase long, n long")


def windows_of(span: bytes, phase: int, stride: int) -> np.ndarray:
    """Rows of (context codes, code), one per target of a span."""
    near = np.lib.stride_tricks.sliding_window_view(np.frombuffer(span, np.uint16), 2 * RADIUS + 1)
    return near[phase::stride][:, [RADIUS + o for o in (*_OFFSETS, 0)]]


def fit(docs: DataFrame, text_col: str = "text", stride: int = STRIDE,
        rounds: int = ROUNDS, words: DataFrame | None = None) -> Network:
    """`words`: the stored `coded` rows of docs, where they are at hand."""
    if words is None:
        samples = sh.stored(training_windows(docs, text_col, stride), "windows")
    else:
        samples = spans(words, stride)
    total = samples.agg(F.sum("n")).first()[0] or 0
    network = Network()
    if not total:
        return network
    # dealt in turn, so that copies of a text don't meet in one shard; stored, so
    # that a row stays in its shard
    shards = max(1, math.ceil(total / SHARD_WINDOWS))
    dealt = sh.stored(samples.repartition(shards).withColumn(
        "shard", F.spark_partition_id()), "shards")
    for turn in range(rounds):
        network = _averaged_round(dealt, network, turn, stride, shards)
    return network


def _averaged_round(dealt: DataFrame, network: Network, turn: int, stride: int, shards: int) -> Network:
    """Every shard trains the network once; the result is their weighted average,
    taken over AVERAGED shards at a time, then over those averages."""
    flat = network.flat
    cuts = np.linspace(0, len(flat), BLOCKS + 1).astype(int)

    def train(key, tab):
        shard = key[0].as_py()
        spans = sorted(zip(tab["codes"].to_pylist(), tab["phase"].to_pylist()))
        rows = np.concatenate([windows_of(x, phase, stride) for x, phase in spans])
        mine = Network(flat.copy())
        mine.train(rows, 1000 * turn + shard)
        return pa.table({
            "block": pa.array(range(BLOCKS), pa.int32()),
            "shard": pa.array([shard] * BLOCKS, pa.int32()),
            "n": pa.array([len(rows)] * BLOCKS, pa.int64()),
            "part": pa.array([mine.flat[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    def average(key, tab):
        order = np.argsort(tab["shard"].to_numpy())     # a fixed order of summation
        n = tab["n"].to_numpy()
        total = sum(np.frombuffer(tab["part"][int(i)].as_py(), np.float32).astype(np.float64)
                    * (n[i] / n.sum()) for i in order)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "shard": pa.array([key[1].as_py()], pa.int32()),
                         "n": pa.array([n.sum()], pa.int64()),
                         "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    columns = "block int, shard int, n long, part binary"
    parts = dealt.groupBy("shard").applyInArrow(train, columns)
    while True:
        parts = parts.withColumn("above", F.floor(F.col("shard") / AVERAGED).cast("int")).groupBy(
            "block", "above").applyInArrow(average, columns)
        shards = math.ceil(shards / AVERAGED)
        if shards == 1:
            break
    parts = parts.toArrow()                            # one row per block
    by = dict(zip(parts["block"].to_pylist(), parts["part"].to_pylist()))
    return Network(np.concatenate([np.frombuffer(by[i], np.float32) for i in range(BLOCKS)]))


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text",
          words: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, log_likelihood, perplexity (null without words).
    `words`: the stored `coded` rows of docs, where they are at hand."""
    flat = network.flat
    words = coded(docs, id_col, text_col) if words is None else words
    return words.select("doc_id", "codes").mapInArrow(
        lambda batches: scored(batches, Network(flat)),
        "doc_id long, n_words long, log_likelihood double, perplexity double")


def scored(batches, network: Network):
    """Batches of (doc_id, codes) with their scores."""
    for b in batches:
        texts, sums = b.column(1).to_pylist(), []
        for some in by_size(texts, len, SCORED):
            logs, at = network.log_probabilities(np.frombuffer(b"".join(some), np.uint16)), 0
            for codes in some:
                sums.append(logs[at:at + len(codes) // 2 - 2 * RADIUS].sum())
                at += len(codes) // 2
        n, sums = np.fromiter(map(len, texts), np.int64, len(texts)) // 2 - 2 * RADIUS, np.array(sums, np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            perplexity = np.exp(-sums / n)
        yield pa.record_batch([b.column(0), pa.array(n), pa.array(sums), pa.array(perplexity, mask=n == 0)],
                              names=["doc_id", "n_words", "log_likelihood", "perplexity"])
