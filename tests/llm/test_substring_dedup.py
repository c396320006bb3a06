import hashlib

import pytest
from pyspark.sql import functions as F

from revops_spark.llm import substring_dedup as sd
from revops_spark.llm._shared import NULL_ID, table


def brute(rows, window=50):
    """Per row: words, removed words and digest, from every window of every text."""
    first = {}
    for i, text, *_ in rows:
        i, words = NULL_ID if i is None else i, (text or "").encode().split()
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, text, *_ in rows:
        words, own = (text or "").encode().split(), NULL_ID if i is None else i
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < own:
                gone[s:s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk_bytes", [1 << 22, 20_000])
def test_matches_brute_force_on_odd_documents(odd, odd_docs, chunk_bytes, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(sd, "RANGE_WINDOWS", 500)
    got = result(sd.remove_repeats(odd_docs))
    assert got == brute(odd)
    assert sum(r[2] for r in got) > 30_000


def test_other_window_lengths(odd, odd_docs):
    assert result(sd.remove_repeats(odd_docs, window=7)) == brute(odd, 7)


def test_kept_text_keeps_the_spacing_between_kept_words(spark):
    from .conftest import prose
    a = prose("p", 60)
    docs = spark.createDataFrame([(1, a), (2, f"x\n y  {a}\tz  w")], "doc_id long, text string")
    kept = {r.doc_id: r.kept_text for r in sd.remove_repeats(docs).collect()}
    assert kept == {1: a, 2: "x\n y z  w"}


def test_carried_columns_come_back(odd_docs):
    df = sd.remove_repeats(odd_docs, carry=["lang", "rest"])
    assert df.filter("rest.rest = 'clash'").count() == odd_docs.count()


def test_empty_table(no_docs):
    assert sd.remove_repeats(no_docs).collect() == []


def test_matches_brute_force_on_the_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(sd.remove_repeats(docs, with_text=False)) == brute(rows)


def test_hot_passage_is_sent_once_per_chunk(spark):
    """A passage in every document: the steps' rows follow chunks, not pairs."""
    from .conftest import prose
    p = prose("hot", 60)
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(p), F.lit(" "), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    rows = sd.remove_repeats(docs).collect()
    assert {r.n_removed for r in rows if r.doc_id} == {60}
    assert [r.n_removed for r in rows if r.doc_id == 0] == [0]
