import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from revops_spark.llm import spelling as sp
from revops_spark.llm._shared import table


def plain_counts(rows, min_chars=6, min_count=5, modulus=199):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def plain_near(words):
    """Words one edit apart, through what is left after deleting one code point."""
    near, cut = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            cut[(i, short)].add(w)
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for (i, _), group in cut.items():
        for w in group:
            near[w] |= {v for v in group if v != w}
    return near


def plain_variants(counts):
    near, form = plain_near(counts), {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def result(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_odd_documents(odd, odd_docs):
    got = sp.variants(odd_docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == plain_variants(plain_counts(odd))


def test_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got, want = result(sp.variants(docs)), plain_variants(plain_counts(rows))
    assert got == want
    assert any(form for _, form, *_ in got)


def test_chains_ties_and_odd_letters(spark):
    words = (["abcdef"] * 5 + ["abcdeg"] * 25 + ["abcdegh"] * 140 + ["xbcdegh"] * 700 +
             ["tiebaa"] * 5 + ["tiebab"] * 30 + ["tiebac"] * 30 + ["ÀÉ×÷ÿê"] * 6 +
             ["ÀÉ×÷ÿ"] * 9 + ["ÀÉ×÷ÿêłê"] * 5)
    random.Random(1).shuffle(words)
    rows = [(i, " 一".join(words[i::7])) for i in range(7)] + [(None, "Abcdeg \U0001f600abcdeg")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(sp.variants(df, modulus=10 ** 9))
    assert got == plain_variants(plain_counts(rows, modulus=10 ** 9))
    by_word = {r[0]: r for r in got}
    assert by_word["abcdef"][2] == "xbcdegh" and by_word["tiebaa"][1] == "tiebab"


def random_words(seed, n, letters):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 13))) for _ in range(n)}
    for w in list(words):
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:],
                  w[:i] + rng.choice(letters) + w[i + 1:]}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("letters,most,hot", [("ab", 50, 3), ("abc", 8, 1000), ("abcdefgh", 2000, 5)])
def test_pairs_equal_all_pairs(spark, monkeypatch, letters, most, hot):
    """Every dictionary, sparse or deep, and lists split or whole, lose no pair."""
    monkeypatch.setattr(sp, "MAX_FREQUENT", most)
    words = random_words(letters, 300, letters)
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [tuple(sorted((r.word, r.near))) for r in sp.near_pairs(df, hot_list=hot).collect()]
    near = plain_near(set(words))
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in near for b in near[a] if a < b}


def test_bounds_hold_for_every_edit():
    """The grams an edit leaves are never fewer than the bound says."""
    rng = random.Random(5)
    for letters in ("ab", "abcd"):
        corpus = random_words(3, 200, letters)
        counts = Counter(w[p:p + q] for w in corpus for q in range(2, 6) for p in range(len(w) - q + 1))
        for least in (1, 20, 300):
            frequent = {g for g, n in counts.items() if n >= least and len(g) < 5}
            for longest in (3, 5):
                for w in rng.sample(corpus, 60):
                    grams = sp.decompose(w, frequent, 2, longest)
                    gone = sp.affected(w, grams, frequent, 2, longest)
                    assert longest > 3 or gone < len(grams)
                    texts = {(w[p:p + q], p) for p, q in grams}
                    for i in range(len(w) + 1):
                        for new in {w[:i] + w[i + 1:], *(w[:i] + c + w[i:] for c in letters),
                                    *(w[:i] + c + w[i + 1:] for c in letters if i < len(w))}:
                            d = len(new) - len(w)
                            other = {(new[p:p + q], p) for p, q in sp.decompose(new, frequent, 2, longest)}
                            kept = sum((g, p) in other and p + len(g) <= i
                                       or (g, p + d) in other and p >= i for g, p in texts)
                            assert kept >= len(grams) - gone, (w, new)


def test_empty_table(no_docs):
    assert sp.variants(no_docs).collect() == []


def test_short_words_need_room():
    with pytest.raises(ValueError):
        sp.near_pairs(None, min_chars=3)
