import random

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in ("ba", "de", "fi", "go", "hu", "ka", "le", "mi", "no", "pu")
              for b in ("", "r", "s", "tan", "ver", "lim", "so", "quo", "x", "nd")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def odd_rows():
    """Documents with every odd case: nulls, empty, white space, very long,
    copies, near copies, repeated rows, shared passages, odd characters."""
    passage, long_text = prose("passage", 80), prose("long", 30_000)
    base = prose("base", 120)
    rows = [(i, prose(i, 20 + 17 * i), "en", "s0", None) for i in range(20)]
    rows += [
        (100, None, None, None, None), (101, "", "en", None, 0), (102, " \t\n ", None, "s0", 4),
        (103, "one", "en", "s0", 3), (104, "One two", "en", "s0", 7),
        (110, base, "en", "s0", 9), (111, base, "en", "s1", 9), (112, base.upper(), "en", "s0", 9),
        (113, base + " extra", "en", "s0", 9), (114, base, None, None, None),
        (114, base, None, None, None),                                   # a repeated row
        (120, prose(1200, 60) + " " + passage + " " + prose(1201, 60), "en", "s0", 1),
        (121, passage + "\n" + prose(1210, 90), "en", "s0", 1),
        (122, prose(1220, 30) + " " + passage, "fr", "s0", 1),
        (130, long_text, "en", "s0", 1), (131, prose(131, 10) + " " + long_text, "en", "s0", 1),
        (140, "spam " * 5000, "en", "s0", 1), (141, "a" * 3000, "en", "s0", 1),
        (142, "héé 日本語 <|endoftext|> \U0001f600  x\r\n\r\n  y", "xx", "s0", 1),
        (None, base, "en", "s0", 1), (None, passage, "en", "s0", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return odd_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    """The odd documents, with further columns whose names clash with the operators' own."""
    df = spark.createDataFrame(odd, DOCS).repartition(3)
    for name in ("chunk", "rest", "fp", "score", "length", "_id", "_gone", "bench_matches", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
