"""Phrase collocations: best-first branch-and-bound growth of phrases.

A phrase's score is the lowest Dice coefficient over its cuts in two parts, in
millionths; a phrase whose words lie inside a longer frequent phrase of nearly
the same count is redundant. Wanted are each language's best `top` of the rest.

1. Roots: all words with their counts, from one scan. Words below `least`
   are in no candidate.
2. Every frequent word is expanded to its frequent pairs: a word alone bounds
   nothing, as a phrase may be as frequent as its first word.
3. From here on a node is a phrase p, and the counts of its prefixes bound what
   can grow from it: an extension q has at most p's count, and what follows its
   first word w is at least as frequent as q, so
   score(q) <= floor(2e6 f(p) / (f(w) + f(p))). The same bounds p's own score.
4. Best first: in each round a language's threshold is the score of its
   `width`-th best candidate known so far. All nodes whose bound reaches the
   threshold are expanded, by one word to the right (their extensions) and to
   the left (which with the former decides whether they are redundant): first
   the pairs, then the triples found. The counts of the last three words of
   a quadruple are looked up where growth has not met them.
5. A language is settled when at least `top` candidates at or above its threshold
   survive, ties included: whatever isn't expanded scores less. If not, the
   next round's frontier is wider, in the end all of it.

An expansion is a scan of the corpus that counts the phrases which pass a bit
filter of the frontier. The filter has 2**FILTER_BITS bits (2 MB), whatever the
frontier's size; what it lets through by chance is counted exactly as well and
does no harm. Tasks add up their counts before the shuffle. Words are 64-bit
hashes of language and word while they are counted, phrases are lists of them.

Results for odd input: null and empty texts hold no words and a null language
is `und`; a language without a candidate has no rows; null ids and repeated rows
count as any other row; scores that tie are ordered by count, then phrase; an empty
table gives an empty result. Further columns are not read. A text is held in
memory whole, with about thirty times its size in arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as sh
from ._words import Words, by_size, byte_kinds

LONGEST = 4               # words of a phrase
LEAST, TOP = 30, 2_000
COVERED = 80              # percent of a phrase's count that make it redundant
FILTER_BITS = 24
BATCH_BYTES = 2 << 20     # text tokenized at a time
HELD_ROWS = 1 << 19       # phrases a task adds up before it sends them
SALTS = 32                # parts of a language's candidates that are ranked by themselves
UNKNOWN = "und"

KINDS = byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _names(size: int) -> list[str]:
    return [f"w{i}" for i in range(1, size + 1)]


def _key(words: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = sh.mixed(out * _STEP + w)
    return out


def _slots(words: list[np.ndarray], bits: int) -> np.ndarray:
    return (_key(words) >> np.uint64(64 - bits)).astype(np.int64)


def _hashed(part: list[tuple[str, bytes]]) -> tuple[Words, np.ndarray]:
    """The words of (language, text) rows and their hashes with the language."""
    words = Words([text for _, text in part], KINDS)
    of_lang = np.array([xxhash.xxh64_intdigest(lang) for lang, _ in part], np.uint64)
    return words, sh.mixed(words.hash ^ of_lang[words.doc])


def _parts(batches, most: int):
    for batch in batches:
        rows = ((lang, text.as_py().encode())
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)) if text.is_valid)
        yield from by_size(rows, lambda r: len(r[1]), most)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, w, word, n) of every word."""
    most, held = BATCH_BYTES, HELD_ROWS // 4

    def run(batches):
        total: dict[int, list] = {}

        def rows():
            cols = list(zip(*((r[0], h, r[1], r[2]) for h, r in total.items()))) or [()] * 4
            return pa.record_batch(
                [pa.array(cols[0], pa.string()), pa.array(np.array(cols[1], np.uint64).view(np.int64)),
                 pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                names=["lang", "w", "word", "n"])

        for part in _parts(batches, most):
            words, hashes = _hashed(part)
            found, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            for h, i, n in zip(found.tolist(), first.tolist(), counts.tolist()):
                row = total.get(h)
                if row is None:
                    total[h] = [part[words.doc[i]][0], words.text(i).decode(), n]
                else:
                    row[2] += n
            if len(total) >= held:
                yield rows()
                total.clear()
        yield rows()

    return texts.mapInArrow(run, "lang string, w long, word string, n long").groupBy(
        "lang", "w", "word").agg(F.sum("n").alias("n"))


def filter_bits(phrases: DataFrame, size: int) -> bytes:
    """A bit filter of phrases: 2**FILTER_BITS bits, packed in slices by Spark."""
    bits_log, slice_bits = FILTER_BITS, min(16, FILTER_BITS)

    def slots(batches):
        for b in batches:
            at = _slots([c.to_numpy().view(np.uint64) for c in b.columns], bits_log) if b.num_rows else []
            yield pa.record_batch([pa.array(at, pa.int64())], names=["slot"])

    def packed(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << slice_bits, bool)
        at = rows["slot"].to_numpy()
        bits[at & ((1 << slice_bits) - 1)] = True
        return pa.table({"slice": [int(at[0]) >> slice_bits], "bits": [np.packbits(bits).tobytes()]},
                        pa.schema([("slice", pa.int64()), ("bits", pa.binary())]))

    found = (phrases.select(*_names(size)).mapInArrow(slots, "slot long").distinct()
             .groupBy(F.shiftright("slot", slice_bits).alias("slice"))
             .applyInArrow(packed, "slice long, bits binary")).collect()
    out = bytearray(1 << (FILTER_BITS - 3))
    step = 1 << (slice_bits - 3)
    for r in found:
        out[r.slice * step:(r.slice + 1) * step] = r.bits
    return bytes(out)


class _Counter:
    """Phrases of one size with their counts, added up by sorting."""

    def __init__(self, size: int):
        self.size, self.held, self.rows = size, [], 0

    def add(self, words: list[np.ndarray]) -> None:
        self.held.append((words, np.ones(len(words[0]), np.int64)))
        self.rows += len(words[0])

    def compact(self) -> None:
        words = [np.concatenate([w[k] for w, _ in self.held]) for k in range(self.size)]
        counts = np.concatenate([n for _, n in self.held])
        order = np.argsort(_key(words))
        words, counts = [w[order] for w in words], counts[order]
        new = np.zeros(len(counts), bool)
        new[:1] = True
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        first = np.flatnonzero(new)
        self.held = [([w[first] for w in words], np.add.reduceat(counts, first))]
        self.rows = len(first)

    def batches(self):
        if not self.rows:
            return
        self.compact()
        (words, counts), = self.held
        for a in range(0, len(counts), 1 << 16):
            yield pa.record_batch(
                [*(pa.array(w[a:a + (1 << 16)].view(np.int64)) for w in words),
                 pa.array(counts[a:a + (1 << 16)])], names=[*_names(self.size), "a"])
        self.held, self.rows = [], 0


def count_phrases(texts: DataFrame, size: int, filters: list[tuple[bytes, int, bool]],
                  least: int) -> DataFrame:
    """(w1, ..., a): the phrases of `size` words that occur at least `least` times
    and pass every filter (bits, words, every): all, or any one, of the phrase's
    parts of so many words are in the bits."""
    most, held = BATCH_BYTES, HELD_ROWS

    def run(batches):
        tests = [(np.unpackbits(np.frombuffer(bits, np.uint8)).view(bool), words, every)
                 for bits, words, every in filters]
        counter = _Counter(size)
        for part in _parts(batches, most):
            words, h = _hashed(part)
            if len(h) < size:
                continue
            at = np.flatnonzero(words.piece[:len(h) - size + 1] == words.piece[size - 1:])
            for bits, within, every in tests:
                keep = None
                for o in range(size - within + 1):
                    hit = bits[_slots([h[at + o + k] for k in range(within)], len(bits).bit_length() - 1)]
                    keep = hit if keep is None else keep & hit if every else keep | hit
                at = at[keep]
            if len(at):
                counter.add([h[at + k] for k in range(size)])
            if counter.rows >= 2 * held:
                counter.compact()
                if counter.rows >= held:
                    yield from counter.batches()
        yield from counter.batches()

    schema = ", ".join(f"{w} long" for w in [*_names(size), "a"])
    return texts.mapInArrow(run, schema).groupBy(*_names(size)).agg(
        F.sum("a").alias("a")).filter(F.col("a") >= least)


def _score(a: str, both: str) -> str:
    """floor(2000000 a / both), in decimals wide enough for any count."""
    return f"((CAST(2000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(19,0))) div ({both}))"


def _wide(*names: str) -> str:
    return " + ".join(f"CAST({n} AS DECIMAL(19,0))" for n in names)


def _with(df: DataFrame, counts: DataFrame, part: tuple[int, ...], name: str, *more: str) -> DataFrame:
    """`df` with the count of the phrase at the places `part` of its words."""
    side = counts.select(*[F.col(f"w{j}").alias(f"w{i}") for j, i in enumerate(part, 1)],
                         F.col("a").alias(name), *more)
    return df.join(side, [f"w{i}" for i in part])


def _scored(phrases: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """Adds l, r, score of the lowest cut, and the bound of what grows from here."""
    options = ", ".join(f"struct({_score('a', _wide(left, right))} AS score, {k} AS k, {left} AS l, {right} AS r)"
                        for k, (left, right) in enumerate(cuts, 1))
    return phrases.withColumn("cut", F.expr(f"array_min(array({options}))")).select(
        *[c for c in phrases.columns if not c.startswith("f_")], "cut.l", "cut.r", "cut.score",
        F.expr(_score("a", _wide("f_1", "a"))).alias("bound"))


def _longer(phrases: DataFrame, size: int) -> DataFrame:
    """(w1, ..., longer): the largest count of a phrase one word longer, to either side."""
    ends = [F.struct(*[F.col(f"w{i + o}").alias(f"w{i}") for i in range(1, size + 1)]) for o in (0, 1)]
    return phrases.select(F.explode(F.array(*ends)).alias("p"), "a").select("p.*", "a").groupBy(
        *_names(size)).agg(F.max("a").alias("longer"))


def _thresholds(known: DataFrame, rank: int) -> DataFrame:
    """(lang, least): the score of each language's rank-th best; 0 where it has fewer.
    Scores are at most 1,000,000, so a language has no more rows here."""
    down = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    steps = known.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "upto", F.sum("n").over(down))
    return steps.groupBy("lang").agg(F.coalesce(
        F.max(F.when(F.col("upto") >= rank, F.col("score"))), F.lit(0).cast("long")).alias("least"))


def _uncovered(phrases: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """The phrases that no longer one covers."""
    covered = F.expr("CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(19,0)) "
                     f">= CAST({COVERED} AS DECIMAL(3,0)) * CAST(a AS DECIMAL(19,0))")
    return phrases.join(_longer(longer, size), _names(size), "left").filter(
        F.col("longer").isNull() | ~covered).drop("longer")


def _round(texts: DataFrame, words: DataFrame, pairs: DataFrame, pair_bits: bytes,
           limits: DataFrame, least: int) -> DataFrame:
    """The surviving candidates at or above each language's limit."""

    def reach(phrases: DataFrame, column: str) -> DataFrame:
        return phrases.join(limits, "lang").filter(F.col(column) >= F.col("least")).drop("least")

    def expanded(nodes: DataFrame, size: int) -> DataFrame:
        bits = filter_bits(reach(nodes, "bound"), size)
        return count_phrases(texts, size + 1, [(bits, size, False), (pair_bits, 2, True)], least)

    triples = _with(sh.stored(expanded(pairs, 2), "triples"), words, (1,), "f_1", "lang")
    for name, part, of in (("f_12", (1, 2), pairs), ("f_23", (2, 3), pairs), ("f_3", (3,), words)):
        triples = _with(triples, of, part, name)
    triples = sh.stored(_scored(triples, [("f_1", "f_23"), ("f_12", "f_3")]), "triples")
    every_four = sh.stored(expanded(triples, 3), "quadruples")
    fours = _with(every_four, words, (1,), "f_1", "lang")
    for name, part, of in (("f_123", (1, 2, 3), triples), ("f_12", (1, 2), pairs),
                           ("f_34", (3, 4), pairs), ("f_4", (4,), words)):
        fours = _with(fours, of, part, name)
    # the first cut's right part is at least as frequent as the phrase
    hoped = " AND ".join(f"{_score('a', _wide(*both))} >= least"
                         for both in (("f_1", "a"), ("f_12", "f_34"), ("f_123", "f_4")))
    fours = sh.stored(fours.join(limits, "lang").filter(hoped).drop("least"), "hoped")
    rest = fours.select(*[F.col(f"w{i + 1}").alias(f"w{i}") for i in (1, 2, 3)]).distinct()
    unmet = sh.stored(rest.join(triples, _names(3), "left_anti"), "unmet")
    tails = triples.select(*_names(3), "a")
    if not unmet.isEmpty():
        looked_up = count_phrases(texts, 3, [(filter_bits(unmet, 3), 3, True)], least)
        tails = tails.unionByName(looked_up.join(unmet, _names(3), "left_semi"))
    fours = _scored(_with(fours, sh.stored(tails, "tails"), (2, 3, 4), "f_234"),
                    [("f_1", "f_234"), ("f_12", "f_34"), ("f_123", "f_4")])

    none = F.lit(None).cast("long")
    found = [_uncovered(reach(pairs, "score"), triples, 2).withColumn("w3", none).withColumn("w4", none),
             _uncovered(reach(triples, "score"), every_four, 3).withColumn("w4", none),
             reach(fours, "score")]
    columns = ["lang", *_names(4), "a", "l", "r", "score"]
    return sh.stored(found[0].select(columns).unionByName(found[1].select(columns))
                     .unionByName(found[2].select(columns)), "survivors")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 least: int = LEAST, top: int = TOP, width: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    texts = _texts(docs, text_col, lang_col)
    every = sh.stored(word_counts(texts), "words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    words = sh.stored(every.filter(F.col("n") >= least).select(
        "lang", F.col("w").alias("w1"), "word", F.col("n").alias("a")), "frequent")
    pairs = sh.stored(count_phrases(texts, 2, [(filter_bits(words, 1), 1, True)], least), "pairs")
    pairs = _with(_with(pairs, words, (1,), "f_1", "lang"), words, (2,), "f_2")
    pairs = sh.stored(_scored(pairs, [("f_1", "f_2")]), "pairs")
    pair_bits = filter_bits(pairs, 2)

    width, known, settled = width or top, pairs.select("lang", "score"), []
    open_langs = pairs.select("lang").distinct()
    while True:
        limits = sh.stored(open_langs.join(_thresholds(known, width), "lang", "left").select(
            "lang", F.coalesce("least", F.lit(0).cast("long")).alias("least")), "limits")
        if limits.isEmpty():
            break
        survivors = _round(texts, words, pairs, pair_bits, limits, least)
        reached = survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        state = sh.stored(limits.join(reached, "lang", "left").select(
            "lang", "least", ((F.col("least") == 0) | (F.coalesce("n", F.lit(0)) >= top)).alias("done")),
            "state")
        settled.append(survivors.join(state.filter("done"), "lang", "left_semi"))
        # the next limit lies below this one, and four times as far down
        open_langs, width = state.filter("NOT done").select("lang"), 4 * width
        known = pairs.join(state.filter("NOT done"), "lang").filter(
            F.col("score") < F.col("least")).select("lang", "score")

    if not settled:
        settled = [pairs.select("lang", "w1", "w2", F.col("w2").alias("w3"), F.col("w2").alias("w4"),
                                "a", "l", "r", "score").limit(0)]
    best = settled[0]
    for more in settled[1:]:
        best = best.unionByName(more)
    # ties at the last score stay until the phrases can be read
    best = best.join(_thresholds(best, top), "lang").filter("score >= least").drop("least")
    for i in range(1, LONGEST + 1):
        best = best.join(words.select(F.col("w1").alias(f"w{i}"), F.col("word").alias(f"t{i}")),
                         f"w{i}", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", *[f"t{i}" for i in range(1, LONGEST + 1)]))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    best = best.select("lang", "phrase", "a", "l", "r", "score", salt).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(
        F.col("rank") <= top)
    return best.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top).join(
        totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
