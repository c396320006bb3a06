import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from revops_spark.llm import simhash_dedup as sd
from revops_spark.llm._shared import table

from .conftest import prose


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.encode().split()]
    if not words:
        return 0
    parts = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(p, seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(fps, distance):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance) + i + 1:
            parent[find(int(j))] = find(i)
    return [find(i) for i in range(len(fps))]


def brute(rows, distance=2):
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots, least = union(fps, distance), {}
    for (i, *_), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, *_), f, r in zip(rows, fps, roots)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_matches_brute_force_on_odd_documents(odd, odd_docs):
    got = result(sd.near_duplicates(odd_docs))
    assert got == brute(odd)
    assert {c for i, _, c in got if i in (100, 101, 102)} == {100}          # fingerprint zero


def test_matches_brute_force_on_the_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(sd.near_duplicates(docs)) == brute(rows)


@pytest.mark.parametrize("hot", [3, 10_000])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_close_to_all_links(spark, monkeypatch, distance, hot):
    """Clouds of fingerprints around a few centres, with keys split and unsplit."""
    monkeypatch.setattr(sd, "HOT_KEY", hot)
    rng = np.random.default_rng(distance)
    fps = set()
    for centre in rng.integers(0, 1 << 63, 6):
        for _ in range(60):
            f = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= 1 << int(b)
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    comps = {r.node: r.root for r in sd.components(sd.links(df, distance)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got, want = {}, {}
    for f, r in zip(signed, union(fps, distance)):
        want.setdefault(r, set()).add(f)
        got.setdefault(comps.get(f, f), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_a_large_near_copy_group_emits_a_forest(spark):
    """All one- and two-bit neighbours of a point: links stay near the number of points."""
    points = [0] + [1 << a for a in range(63)] + [1 << a | 1 << b for a in range(63) for b in range(a)]
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    edges = sd.links(df, 2)
    assert edges.count() <= 8 * len(points)
    assert {r.root for r in sd.components(edges).collect()} == {0}


def test_long_chains_join(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(900, 901)], "u long, v long")
    comps = {r.node: r.root for r in sd.components(edges).collect()}
    assert {comps[i] for i in range(301)} == {0} and comps[901] == comps[900] == 900


def test_one_of_each_keeps_the_smallest_id(odd, odd_docs):
    kept = sd.one_of_each(odd_docs)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({c for _, _, c in brute(odd) if c is not None})
    assert kept.columns == odd_docs.columns


def test_ids_that_repeat_and_null_ids_lose_no_text(spark):
    """One id with two texts keeps both; copies under null ids fall to a kept row."""
    a, b, c = prose("a", 60), prose("b", 60), prose("c", 60)
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "y"), (2, a, "y"), (None, b, "z"), (None, c, "z"),
            (None, c, "z"), (None, c + " ", "z"), (3, None, "n"), (3, "", "n"), (None, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_id string").repartition(4)
    got = sd.one_of_each(df)
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(kept[:], key=repr) == sorted(
        [(1, a), (1, b), max([k for k in kept if (k[1] or "").startswith(c)]),
         *[k for k in kept if not k[1]]], key=repr)
    assert len(kept) == 4


def test_hot_component_is_split(spark):
    """Nine tenths of the fingerprints under one root: the join that names
    components and the star joins may be split by key."""
    plans = []
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rooted = sd.sh.stored(spark.range(60_000).selectExpr(
            "id AS fp", "CASE WHEN id % 10 < 9 THEN 0L ELSE id END AS root", "id AS least").repartition(8), "r")
        named = sd.sh.stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "n")
        joined = rooted.join(named, "root")
        assert joined.count() == 60_000
        plan = joined.select("fp", "component_id")
        plan.write.format("noop").mode("overwrite").save()
        plan.collect()
        plans.append(plan._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plans[0]


def test_empty_table(no_docs):
    assert sd.near_duplicates(no_docs).collect() == []
    assert sd.one_of_each(no_docs).collect() == []


def test_ring_limits():
    with pytest.raises(ValueError):
        sd.Ring(2, segments=2)
    ring = sd.Ring(2)
    assert ring.budget == [0, 0, 0, 1, 1, 2] and ring.exact == 2 and ring.one == 4
