"""Spelling variants: words one edit apart, by a variable-length gram index.

1. Words and their counts come from one scan; each task adds up its own counts
   before the shuffle.
2. Gram dictionary, pruned by frequency: a gram is extended by a further code
   point only while it is frequent. `frequent` is bounded by a proof, not by a
   cap: a gram counts as frequent above 1/MAX_FREQUENT of all gram occurrences,
   so there are at most MAX_FREQUENT of each length.
3. Each word is decomposed into its variable grams: from every place the
   longest gram of the dictionary, unless an earlier one covers it.
4. Affected grams: for every place of an edit, the grams that contain it, that
   an edit could lengthen, or that a longer gram across the edit could cover.
   Their largest number over all places, `affected`, bounds what one edit
   destroys, so two near words share at least `grams - affected` grams of either.
5. List merging: a word is listed under its `affected + 1` rarest grams alone;
   near words meet in one of these short lists. A list is kept per gram, length
   and place, since an unharmed gram keeps its place or moves by the difference
   in length. The lists of a gram with more than HOT_LIST words are split by
   the rest of the word to the left or the right of the gram: one of both is
   untouched, too. The longer lists are only looked up: a candidate must share
   as many placed grams as the larger bound of the two says.
6. Candidates are verified by their edit distance.

A short word may have no gram that every edit leaves alone. Two such words meet
in the lists of a second dictionary with grams of at most half the least word
length, where the first or the last gram survives any edit.

Results for odd input: null and empty texts hold no words; a null id is
written as nothing before the colon; repeated rows count as often as they
occur; words of equal count tie by code points; an empty table gives an empty
result. Further columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _shared as sh

MIN_CHARS, MIN_COUNT = 6, 5
FORM_FACTOR = 5           # a form is at least so many times as frequent as its variant
EDIT_MODULUS = 199        # the runs of which one code point is deleted
SHORTEST, LONGEST = 2, 5  # gram lengths
MAX_FREQUENT = 20_000     # frequent grams of one length, at most
LEAST_FREQUENT = 16       # occurrences below which a gram is never extended
HOT_LIST = 1_000          # words of a gram whose lists are split
CACHED = 400_000          # distinct words or grams a task adds up at a time


def _is_letter(c: int) -> bool:
    return 65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0


# one byte per code point (Latin-1): letters in lower case (A-Z only), the rest blank
_RUNS = bytes((c + 32 if c <= 90 else c) if _is_letter(c) else 32 for c in range(256))


def _sums(counts: dict, decode=None) -> pa.RecordBatch:
    names = [decode(k) for k in counts] if decode else list(counts)
    return pa.record_batch([pa.array(names, pa.string()), pa.array(counts.values(), pa.int64())],
                           names=["word", "n"])


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                modulus: int = EDIT_MODULUS) -> DataFrame:
    """(word, n): runs of letters in lower case, one code point of every
    modulus-th (by its hash with the id) deleted; words of at least min_chars
    code points that occur at least min_count times."""

    def run(batches):
        total: dict[bytes, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                found = Counter(w for w in text.encode("latin-1", "replace").translate(_RUNS).split()
                                if len(w) >= min_chars)
                for word, n in found.items():
                    name = word if word.isascii() else word.decode("latin-1").encode()
                    h = zlib.crc32(name, seed)
                    if h % modulus == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_chars:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) >= CACHED:
                    yield _sums(total, lambda w: w.decode("latin-1"))
                    total = {}
        yield _sums(total, lambda w: w.decode("latin-1"))

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def frequent_grams(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST,
                   max_frequent: int = MAX_FREQUENT) -> frozenset[str]:
    """The grams that are extended: those above 1/max_frequent of the occurrences."""

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                total.update(word[p:p + q] for q in range(shortest, longest)
                             for p in range(len(word) - q + 1))
                if len(total) >= CACHED:
                    yield _sums(total)
                    total = Counter()
        yield _sums(total)

    grams = sh.stored(words.select("word").mapInArrow(run, "word string, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "gram-counts")
    every = grams.filter(F.length("word") == shortest).agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_FREQUENT, -(-every // max_frequent))
    # at most max_frequent of each length, as no length has more than `every` occurrences
    return frozenset(r.word for r in grams.filter(F.col("n") >= least).select("word").collect())


def decompose(word: str, frequent, shortest: int, longest: int) -> list[tuple[int, int]]:
    """(place, length) of the word's variable grams."""
    out, end, n = [], 0, len(word)
    for p in range(n - shortest + 1):
        size = shortest
        while size < longest and p + size < n and word[p:p + size] in frequent:
            size += 1
        if p + size > end:
            end = p + size
            out.append((p, size))
    return out


def affected(word: str, grams: list[tuple[int, int]], frequent, shortest: int, longest: int) -> int:
    """How many of the word's grams one edit can take away, at most.

    For an edit before place i, grams that end at or before i and start where
    the text up to i is a frequent gram or later may be lengthened or covered
    by a lengthened one. Grams that start after the edit may be covered by a
    gram across it; what such a gram holds of them, less its last code point, is
    part of a frequent gram and so frequent itself.
    """
    n, most = len(word), 0
    before, after = [], []
    for i in range(n + 1):
        a = i
        for j in range(max(0, i - longest + 1), i - shortest + 1):
            if word[j:i] in frequent:
                a = j
                break
        before.append(a)
        b = min(n, i + shortest)
        for e in range(min(n, i + longest - 1), b, -1):
            if word[i:e - 1] in frequent:
                b = e
                break
        after.append(b)
    for i in range(n + 1):
        inserted = replaced = 0
        a, b, b1 = before[i], after[i], after[i + 1] if i < n else n
        for p, size in grams:
            e = p + size
            if e <= i:
                hit = p >= a
                inserted += hit
                replaced += hit
            else:
                if p >= i:
                    inserted += e <= b
                else:
                    inserted += 1
                replaced += p <= i or e <= b1
        most = max(most, inserted, replaced if i < n else 0)
    return most


_DECOMPOSED = ("word string, n long, kind int, bound int, affected int, "
               "grams array<struct<gram: string, place: int>>")


def decomposed(words: DataFrame, frequent: frozenset[str], shortest: int = SHORTEST,
               longest: int = LONGEST, min_chars: int = MIN_CHARS) -> DataFrame:
    """Each word with its grams and bound; kind 0 is the dictionary itself, kind 1
    its part of short grams, for the words that some edit leaves no gram of."""
    gram_type = pa.list_(pa.struct([("gram", pa.string()), ("place", pa.int32())]))
    short = min(longest, min_chars // 2)

    def run(batches):
        for batch in batches:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, most in ((0, longest), (1, short)):
                    grams = decompose(word, frequent, shortest, most)
                    gone = affected(word, grams, frequent, shortest, most)
                    rows.append((word, n, kind, len(grams) - gone, gone,
                                 [{"gram": word[p:p + q], "place": p} for p, q in grams]))
                    if len(grams) > gone:
                        break
            cols = list(zip(*rows)) or [()] * 6
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(),
                                                       pa.int32(), pa.int32(), gram_type))],
                names=["word", "n", "kind", "bound", "affected", "grams"])

    return words.select("word", "n").mapInArrow(run, _DECOMPOSED)


def _lists(found: DataFrame, hot_list: int) -> DataFrame:
    """One row per word and short list: its `affected + 1` rarest grams."""
    placed = found.select("word", "n", "kind", "bound", "affected",
                          F.transform("grams", lambda g: F.xxhash64(g["gram"], g["place"])).alias("marks"),
                          F.transform("grams", lambda g: F.xxhash64(g["gram"], g["place"] - 1)).alias("moved"),
                          F.explode("grams").alias("g")).select("*", "g.gram", "g.place").drop("g")
    # written, so that the join below has a plain exchange on both sides and a
    # gram of very many words can be split
    sizes = sh.stored(found.select("kind", F.explode("grams.gram").alias("gram"))
                      .groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("size")), "gram-lists")
    # a word is a key of its own here: as many rows as it has grams
    ranked = placed.join(sizes, ["kind", "gram"]).groupBy("word", "kind").agg(
        F.first("n").alias("n"), F.first("bound").alias("bound"),
        F.first("affected").alias("affected"), F.first("marks").alias("marks"),
        F.first("moved").alias("moved"),
        F.sort_array(F.collect_list(F.struct("size", "gram", "place"))).alias("lists"))
    return ranked.select(
        "word", "n", "kind", "bound", "marks", "moved", F.length("word").alias("chars"),
        F.explode(F.slice("lists", F.lit(1), F.col("affected") + 1)).alias("l")).select(
        "word", "n", "kind", "bound", "marks", "moved", "chars", "l.gram", "l.place",
        (F.col("l.size") > hot_list).alias("hot"))


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS, shortest: int = SHORTEST,
               longest: int = LONGEST, hot_list: int = HOT_LIST) -> DataFrame:
    """(word, n, near, near_n): each unordered pair of words one edit apart, once;
    the first is not the longer one. `words` has distinct words of at least
    min_chars code points."""
    if min_chars < 2 * shortest or min_chars < 4:
        raise ValueError("words must hold two of the shortest grams")
    frequent = frequent_grams(words, shortest, longest)
    found = sh.stored(decomposed(words, frequent, shortest, longest, min_chars), "decomposed")
    lists = sh.stored(_lists(found, hot_list), "short-lists")
    left = F.expr("substr(word, 1, place)")
    right = F.expr("substr(word, place + length(gram) + 1)")

    def key(side: str, longer: int, shift: int, rest):
        return F.struct(F.lit(side).alias("side"), (F.col("chars") + longer).alias("chars"),
                        (F.col("place") + shift).alias("place"), rest.alias("rest"))

    none = F.lit("")

    def keyed(longer: tuple[int, ...]):
        """The lists a word looks into for words longer by so much."""
        cold = [key("", d, s, none) for d in longer for s in range(d + 1)]
        split = [k for d in longer for k in (key("l", d, 0, left), key("r", d, d, right))]
        return lists.withColumn("key", F.explode(
            F.when(F.col("hot"), F.array(*split)).otherwise(F.array(*cold)))).withColumn(
            "key", F.xxhash64("kind", "gram", "key"))

    own = keyed((0,)).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"),
                             F.col("bound").alias("near_bound"), F.col("marks").alias("near_marks"),
                             F.col("moved").alias("near_moved"), F.col("chars").alias("near_chars"))
    asks = keyed((0, 1)).select("key", "word", "n", "bound", "marks", "chars")
    shared = F.size(F.array_intersect("marks", "near_marks")) + F.when(
        F.col("near_chars") > F.col("chars"),
        F.size(F.array_intersect("marks", "near_moved"))).otherwise(0)
    return asks.join(own, "key").filter(
        ((F.col("chars") < F.col("near_chars"))
         | (F.col("chars") == F.col("near_chars")) & (F.col("word") < F.col("near")))
        & (shared >= F.greatest("bound", "near_bound"))
        & (F.levenshtein("word", "near", 2) == 1)).select(
        "word", "n", "near", "near_n").distinct()


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             factor: int = FORM_FACTOR, modulus: int = EDIT_MODULUS) -> DataFrame:
    """One row per word: word, form (its most frequent near word, if that is at
    least `factor` times as frequent), root (the end of its chain of forms), n,
    n_near, form_n."""
    words = sh.stored(word_counts(docs, id_col, text_col, min_chars, min_count, modulus), "words")
    pairs = sh.stored(near_pairs(words, min_chars), "near-pairs")
    both = pairs.unionByName(pairs.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"),
        F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("n").alias("n"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")).select(
        "word", "n_near", F.when(-F.col("best.less") >= factor * F.col("n"), F.struct(
            F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("f"))
    best = sh.stored(best.select("word", "n_near", "f.form", "f.form_n"), "best")
    # every form is `factor` times as frequent, so chains are short: double the
    # step until it is longer than the longest chain can be
    roots = sh.stored(best.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    steps, longest = 1, 0
    n = words.agg(F.max("n")).first()[0] or 0
    while n >= min_count * factor:
        n //= factor
        longest += 1
    while steps < longest:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        roots = sh.stored(roots.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root")), "roots")
        steps *= 2
    return (words.join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
