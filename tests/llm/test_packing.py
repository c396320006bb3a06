import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from revops_spark.llm import packing, queries
from revops_spark.llm._shared import table

PATHS = queries.tokenizer_paths()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATHS[0])


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, docs, library, capacity=2048):
    """Every id in exactly one piece, pieces gapless in their sequences."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    want = defaultdict(int)
    for i, text, *_ in docs:
        ids = ids_of(library, text)
        want[(i, len(ids))] += 1
        found = sorted((r.start, r.length, r.ids_crc32) for r in pieces[(i, len(ids))])
        whole = [(s, n, c) for s, n, c in found
                 if c == zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())]
        at = 0
        for s, n, _ in sorted(set(whole)):
            assert s == at, (i, found)
            at += n
        assert at == len(ids)
    assert sum(r.length for r in rows) == sum(n * k for (_, n), k in want.items())
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return {s: sum(r.length for r in m) for s, m in sequences.items()}


def test_odd_documents(odd, odd_docs, library):
    check(packing.pack(odd_docs, *PATHS).collect(), odd, library)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_test_table_packs_whole_with_little_padding(spark, library, capacity):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = packing.pack(docs, *PATHS, capacity=capacity).collect()
    filled = check(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()],
                   library, capacity)
    assert sum(filled.values()) / (capacity * len(filled)) > 0.985


def test_without_ranks_the_library_alone_encodes(odd, odd_docs):
    few = odd_docs.filter("doc_id < 105")
    a = sorted(map(tuple, packing.pieces(few, PATHS).collect()), key=repr)
    b = sorted(map(tuple, packing.pieces(few, (PATHS[0], None, None)).collect()), key=repr)
    assert a == b


def test_one_length_for_all_is_numbered_in_buckets(spark, monkeypatch, library):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 50)
    docs = [(i, "same text for all") for i in range(1000)] + [(5000 + i, "x " * 40) for i in range(30)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), *PATHS).collect()
    check(rows, docs, library)


def test_empty_table(no_docs):
    assert packing.pack(no_docs, *PATHS).collect() == []


texts = st.text(st.sampled_from(list("aZé 's\n\t.,0123ñ’ 日<|>")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_encoder_equals_the_library(library, text):
    encoder = packing.Encoder(*PATHS)
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(library, text)[:-1]


def test_marker_text_gets_the_id_of_the_plain_call(spark):
    plain = Tokenizer.from_file(PATHS[0])
    text = "a <|endoftext|> b"
    want = plain.encode(text, add_special_tokens=False).ids
    assert 50256 in want
    assert np.frombuffer(packing.Encoder(*PATHS).encode(text), "<u4").tolist() == want
    row, = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), *PATHS).collect()
    assert (row.doc_tokens, row.ids_crc32) == (
        len(want) + 1, zlib.crc32(np.array([*want, packing.END_ID], "<u4").tobytes()))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=30))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = defaultdict(int)
    for packs, items in patterns:
        assert packs > 0 and sum(items) <= 50 and list(items) == sorted(items, reverse=True)
        for n in items:
            held[n] += packs
    assert held == histogram
    assert len(patterns) <= 2 * max(1, len(histogram))


def test_equal_rows_are_spread_over_buckets(spark, monkeypatch, library):
    """Null ids and one row very many times: no bucket holds them all."""
    monkeypatch.setattr(packing, "BUCKET_ROWS", 100)
    rows = [(None, f"word {i % 3}") for i in range(1000)] + [(7, "word 9")] * 2000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(packing.pack(df, *PATHS).collect(), rows, library)
    cut = packing.sh.stored(packing.pieces(df, PATHS).withColumn("nth", packing.F.monotonically_increasing_id()), "p")
    sizes = cut.withColumn("bucket", packing.F.expr("pmod(xxhash64(doc_id, start, ids_crc32, nth), 30)")).groupBy(
        "bucket").count().agg({"count": "max"}).first()[0]
    assert sizes < 2 * 3000 / 30
