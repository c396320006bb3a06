import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from revops_spark.llm import _shared as sh, suffix_dedup as sd
from revops_spark.llm._shared import NULL_ID, table
from revops_spark.llm.suffix_array import by_rank_pairs, permuted_common_prefixes, suffix_array


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=120), st.integers(1, 12))
def test_suffix_array_and_prefixes_match_sorting(symbols, repeat):
    text = symbols * (1 + repeat // 6) + [0]
    t = np.array(text, np.uint16)
    order = sorted(range(len(text)), key=lambda i: text[i:])
    sa = suffix_array(t, 5)
    assert sa.tolist() == order and by_rank_pairs(t).tolist() == order
    common = permuted_common_prefixes(t, sa)
    for before, here in zip(order, order[1:]):
        n = 0
        while max(before, here) + n < len(text) and text[before + n] == text[here + n]:
            n += 1
        assert common[here] == n


def brute(rows, length=100):
    first = {}
    texts = [(NULL_ID if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in texts:
        for s in range(len(b) - length + 1):
            key = b[s:s + length]
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for (i, b), row in zip(texts, rows):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (i, s):
                gone[s:s + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        out.append((row[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk_bytes, shard, array", [(1 << 22, 1 << 23, 1 << 22),
                                                       (40_000, 30_000, 5_000)])
def test_matches_brute_force_on_odd_documents(odd, odd_docs, monkeypatch, chunk_bytes, shard, array):
    monkeypatch.setattr(sd, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(sd, "SHARD_TEXT", shard)
    monkeypatch.setattr(sd, "RANGE_ANCHORS", 500)
    real = sd._verdicts

    def small_arrays(tab, length):
        sd.ARRAY_BYTES = array
        return real(tab, length)

    monkeypatch.setattr(sd, "_verdicts", small_arrays)
    assert result(sd.remove_repeated_bytes(odd_docs)) == brute(odd)


def test_matches_brute_force_on_the_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(sd.remove_repeated_bytes(docs, with_text=False)) == brute(rows)


def test_other_lengths(spark):
    rows = [(2, "abcdefgabcdefg"), (1, "xxabcdefgyy"), (3, "aaaaaaaaaaaa"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(sd.remove_repeated_bytes(docs, length=5, gram=3)) == brute(rows, 5)


def test_a_line_in_many_documents_is_split(spark, monkeypatch):
    """A 50-byte line in otherwise different documents: no key brings more text than an array holds."""
    rng = np.random.default_rng(8)
    line = "// Copyright the authors, see the file of licences"
    assert len(line) == 50

    def words(n):
        return " ".join(f"{x:x}" for x in rng.integers(0, 1 << 32, n))

    shared = words(30)
    rows = [(i, f"{words(30)}\n{line}\n{shared if i % 50 == 0 else words(30)}") for i in range(400)]
    rows.append((1000, f"{shared}\n{line}\n{shared}"))
    monkeypatch.setattr(sd, "ARRAY_BYTES", 5_000)
    monkeypatch.setattr(sd, "CHUNK_BYTES", 40_000)
    real = sd._verdicts

    def bounded(tab, length):
        size = {}
        for a, lens in zip(tab["anchors"], tab["lengths"]):
            for k, n in zip(sh.unpack_sorted(a.as_py()).tolist(), sh.unpack_ints(lens.as_py()).tolist()):
                size[k] = size.get(k, 0) + n
        assert max(size.values()) <= 5_000, max(size.values())
        return real(tab, length)

    monkeypatch.setattr(sd, "_verdicts", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(sd.remove_repeated_bytes(docs))
    assert got == brute(rows) and sum(r[2] for r in got) > 2000


def test_empty_table(no_docs):
    assert sd.remove_repeated_bytes(no_docs).collect() == []
