import bisect
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from revops_spark.llm import fingerprints as fp
from revops_spark.llm._shared import table
from revops_spark.llm._words import Words

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
           "near_next", "n_signatures"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_words(text):
    """(word, whether it opens a line or sentence) of a text."""
    out = []
    for piece in re.split(r"[\n\r\x0b\x0c.!?;:|]", lower(text)):
        out += [(w, i == 0) for i, w in enumerate(re.findall(r"[0-9a-z'\u0080-\U0010ffff]+", piece))]
    return out


class Common:
    """Whether a word's bucket holds at least 1/anchors of all words; a word that
    editing made is looked up like any other."""

    def __init__(self, texts, anchors=2000):
        counts = Counter(w for t in texts for w, _ in plain_words(t))
        words = list(counts)
        self.bucket = dict(zip(words, self.buckets(words)))
        held = Counter()
        for w, n in counts.items():
            held[self.bucket[w]] += n
        self.common = {b for b, n in held.items() if n * anchors >= sum(counts.values())}

    @staticmethod
    def buckets(words):
        found = Words([w.encode() for w in words], fp.KINDS)
        assert (found.counts == 1).all()
        return (found.hash >> np.uint64(48)).tolist()

    def __contains__(self, word):
        if word not in self.bucket:
            self.bucket[word], = self.buckets([word])
        return self.bucket[word] in self.common


def plain_signatures(text, common):
    words = plain_words(text)
    content = [j for j, (w, _) in enumerate(words) if w not in common]
    out = set()
    for i, (w, opens) in enumerate(words):
        for anchor, at in ((w, i + 1), ("", i)):
            if (w in common) if anchor else opens:
                first = bisect.bisect_left(content, at)
                chain = [words[j][0] for j in content[first:first + 2]]
                if chain:
                    out.add((anchor, *chain))
    return out or ({("bare", *(w for w, _ in words[:2]))} if words else set())


def jaccard(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    if min(len(a), len(b)) < fp.FLOOR * max(len(a), len(b)):
        return 0.0
    return len(a & b) / len(a | b)


def plain_order(rows):
    """Each (id, text) once, in descending order of ids, nulls last."""
    return sorted({(i, t or "") for i, t, *_ in rows}, key=lambda r: (r[0] is None, -(r[0] or 0)))


def check(got, rows, after, anchors=2000):
    """`after`: each (id, text)'s next text."""
    common = Common([t or "" for _, t, *_ in rows], anchors)
    want = Counter()
    for i, text, *_ in rows:
        text = text or ""
        nxt, third = after[(i, text)], len(text) // 3
        edited = text[:len(text) - third] + nxt[:third]
        sets = [plain_signatures(t, common) for t in (text, edited, nxt)]
        want[(i, len(text), hashlib.sha256(edited.encode()).hexdigest(), len(sets[0]),
              jaccard(sets[0], sets[1]), jaccard(sets[0], sets[2]))] += 1
    found = Counter((r.doc_id, r.n_chars, r.edited_sha256, r.n_signatures, r.near_edited, r.near_next)
                    for r in got)
    assert found == want
    for r in got:
        assert fp.likeness(r.fingerprint, r.edited_fingerprint, kept=WHOLE) == r.near_edited


def unique(rows):
    order = plain_order(rows)
    return {k: order[(j + 1) % len(order)][1] for j, k in enumerate(order)}


WHOLE = 100_000           # every signature kept: likeness is exact


def test_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = fp.edited(docs, kept=WHOLE)
    assert got.columns == COLUMNS
    got = got.collect()
    check(got, rows, unique(rows))
    by_print = {}
    texts = dict(rows)
    for r in got:
        by_print.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in by_print.values())


@pytest.mark.parametrize("block", [300, 32 << 20])
def test_odd_documents(spark, odd, odd_docs, monkeypatch, block):
    """Many small blocks and one give the same rows; the ids that two texts or
    nulls share are ordered by a hash, taken from the engine here."""
    monkeypatch.setattr(fp, "BLOCK_BYTES", block)
    digest = {(r.doc_id, r.text or ""): r.h for r in odd_docs.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(digest, key=lambda k: (k[0] is None, -(k[0] or 0), digest[k]))
    after = {k: order[(j + 1) % len(order)][1] for j, k in enumerate(order)}
    check(fp.edited(odd_docs, kept=WHOLE).collect(), odd, after)


def test_repeated_rows_come_back_each(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_BYTES", 200)
    rows = [(i, f"the copy of {i} and one more word. The end {i * i}") for i in range(30)]
    rows += [(7, rows[7][1])] * 500 + [(None, "a null id")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    check(fp.edited(df, anchors=10, kept=WHOLE).collect(), rows, unique(rows), anchors=10)


def test_one_document_follows_itself(spark):
    row, = fp.edited(spark.createDataFrame([(5, "abcdefghi")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and row.near_next == 1.0


def test_empty_table(no_docs):
    assert fp.edited(no_docs).collect() == []


def test_fingerprints_are_bounded(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = fp.edited(docs).collect()
    assert max(r.n_signatures for r in got) > fp.KEPT
    for r in got:
        assert len(r.fingerprint) <= 17 + 8 * fp.KEPT
        assert fp.likeness(r.fingerprint, r.edited_fingerprint) == r.near_edited


def test_estimates_are_close():
    rng = random.Random(3)
    for share in (0.1, 0.5, 0.9):
        a = rng.sample(range(1 << 32), 5000)
        b = a[:int(5000 * share)] + rng.sample(range(1 << 32), 5000 - int(5000 * share))
        sets = [np.unique(np.array(s, np.uint32)) for s in (a, b)]
        exact = jaccard(set(a), set(b))
        assert abs(fp.likeness(*map(fp.fingerprint, sets)) - exact) < 0.12


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=90), st.sets(st.integers(0, 400), max_size=90))
def test_likeness_of_whole_sets_is_jaccard(a, b):
    prints = [fp.fingerprint(np.array(sorted(s), np.uint32)) for s in (a, b)]
    assert fp.likeness(*prints) == pytest.approx(jaccard(a, b))
    assert fp.likeness(prints[0], prints[0]) == 1.0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB é,.日\n'" + "x" * 3, max_size=60), max_size=6))
def test_words_equal_plain_words(texts):
    words = Words([t.encode() for t in texts], fp.KINDS)
    got = [[] for _ in texts]
    opens = np.flatnonzero(np.diff(words.piece, prepend=-1)).tolist()
    for i, d in enumerate(words.doc.tolist()):
        got[d].append((words.text(i).decode(), i in opens))
    assert got == [plain_words(t) for t in texts]
    named = {(words.text(i), h) for i, h in enumerate(words.hash.tolist())}
    assert len(named) == len({w for w, _ in named}) == len({h for _, h in named})
