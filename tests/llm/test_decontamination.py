import collections

import numpy as np
import pytest

from .conftest import prose
from revops_spark.llm import decontamination as dc
from revops_spark.llm._shared import table


def bags(words, k=5):
    k = min(k, len(words))
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def similar(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def plain_words(text):
    folded = "".join(" " if 33 <= ord(c) < 127 and not c.isalnum() else c.lower() if c.isascii() else c
                     for c in text or "")
    return folded.encode().split()


def brute(text, items, threshold=0.8):
    """Items that some window of their size resembles, by comparing every window."""
    words, found = plain_words(text), []
    for i, item in items:
        want = plain_words(item)
        if not want or len(words) < min(5, len(want)):
            continue
        size = min(len(want), len(words))
        target = bags(want)
        shared = set(target)
        k = min(5, len(want))
        if any(similar([tuple(words[j:j + k]) for j in range(s, s + size - k + 1)], target) >= threshold
               for s in range(len(words) - size + 1)
               if shared & {tuple(words[j:j + k]) for j in range(s, s + size - k + 1)}):
            found.append(i)
    return sorted(found)


ITEMS = [(i, prose(f"item{i}", 14 + 3 * i)) for i in range(14)] + [
    (50, "tiny item"), (51, None), (52, ""), (53, prose("item3", 23)), (None, prose("nameless", 30))]


def planted():
    rows, rng = [], np.random.default_rng(3)
    for i in range(60):
        item = ITEMS[i % 14][1].split()
        for _ in range(i % 3):                                   # zero to two edits
            item[int(rng.integers(0, len(item)))] = f"edit{i}"
        rows.append((i, f"{prose(i, 30)} {' '.join(item)} {prose(i + 500, 30)}"))
    rows += [(100, ITEMS[5][1].upper().replace(" ", ", ")), (101, None), (102, ""), (103, "tiny item!"),
             (104, " ".join(ITEMS[9][1].split()[1:])), (105, prose("clean", 300)), (106, prose("nameless", 30))]
    return rows + [rows[0]]


@pytest.mark.parametrize("block_items", [20_000, 5])
def test_matches_brute_force(spark, block_items):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(((r.doc_id, sorted(r.item_ids, key=repr)) for r in
                  dc.report(docs, bench, block_items=block_items).collect()), key=repr)
    named = [(i if i is not None else -1, t) for i, t in ITEMS]
    want = sorted(((i, sorted((None if x == -1 else x for x in brute(t, named)), key=repr))
                   for i, t in rows), key=repr)
    assert got == want
    assert sum(bool(x) for _, x in got) > 20


def test_the_index_misses_nothing_on_the_test_table(spark):
    """The index against a radius that lets every window through to the exact check."""
    d = "/root/testdata/sf0.01"
    docs, bench = table(spark, d, "documents"), table(spark, d, "benchmark")
    rows = {r.doc_id: r for r in dc.report(docs, bench).collect()}
    every = dc.Items([(r.item_id, r.text) for r in bench.collect()], 64)
    for r in docs.select("doc_id", "text").collect():
        found = every.matches(dc.word_hashes(r.text, dc._WordHashes()), 0.8)
        assert sorted(m[0] for m in found) == list(rows[r.doc_id].item_ids)


def test_pairs_are_the_reported_items(spark):
    docs = spark.createDataFrame(planted()[:-1], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    pairs = dc.pairs(docs, bench).collect()
    listed = {(r.doc_id, i) for r in dc.report(docs, bench).collect() for i in r.item_ids}
    assert {(r.doc_id, r.item_id) for r in pairs} == listed and len(pairs) == len(listed)
    texts = dict(planted())
    for r in pairs:
        window = plain_words(texts[r.doc_id])[r.start:r.start + r.n_words]
        assert r.similarity == pytest.approx(similar(bags(window), bags(plain_words(dict(ITEMS)[r.item_id]))))


def test_clean_keeps_columns_and_clean_rows(odd, odd_docs, spark):
    bench = spark.createDataFrame([(1, prose("passage", 80))], "item_id long, text string")
    kept = dc.clean(odd_docs, bench)
    assert kept.schema == odd_docs.schema
    gone = {r[0] for r in odd} - {r.doc_id for r in kept.collect()}
    assert gone == {120, 121, 122}                  # the null id's other row stays
    assert kept.count() == len(odd) - 4


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.clean(odd_docs, none).count() == odd_docs.count()
    assert {r.contaminated for r in dc.report(odd_docs, none).collect()} == {False}
    assert dc.report(no_docs, spark.createDataFrame(ITEMS, "item_id long, text string")).collect() == []


def test_radius_covers_similar_windows():
    """Fingerprints of windows at the threshold lie well inside the radius."""
    apart = []
    for i in range(200):
        words = prose(f"w{i}", 60).split()
        other = words[:]
        other[len(other) // 2] = "edited"
        a, b = (dc.shingles(dc.word_hashes(" ".join(w), dc._WordHashes())) for w in (words, other))
        assert dc.similarity(a, b) >= 0.8
        fa, fb = (dc.folded(dc.signs(x).sum(0, keepdims=True)) for x in (a, b))
        apart.append(int(np.bitwise_count(fa ^ fb).sum()))
    assert max(apart) <= dc.RADIUS and np.mean(apart) < 12
