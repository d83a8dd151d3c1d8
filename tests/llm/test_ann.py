import numpy as np
import pytest
from pyspark.sql import functions as F

from quorum.llm import ann


def brute(rows, k, every):
    """rows: id -> vector (usable ones)."""
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], np.float64).reshape(len(ids), -1)
    out = {}
    for q in ids[ids % every == 0]:
        d = np.sqrt(((x - np.array(rows[q], np.float64)) ** 2).sum(axis=1))
        others = [(dist, int(i)) for dist, i in zip(d, ids) if i != q]
        out[int(q)] = sorted(others)[:k]
    return out


def found(df, k, every):
    out = {}
    for r in ann.nearest_neighbours(df, F.col("vec_id") % every == 0, k).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    for q, rows in out.items():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
    return {q: [(s, v) for _, s, v in rows] for q, rows in out.items()}


@pytest.fixture(scope="module")
def schema():
    return "vec_id long, embedding array<float>, label int, node string"


def test_recall_and_exact_scores(spark, schema):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), None, "n") for i, v in enumerate(x)], schema).repartition(4)
    want, got = brute({i: v for i, v in enumerate(x)}, 10, 100), found(df, 10, 100)
    assert set(want) == set(got)
    hits = sum(len({v for _, v in want[q]} & {v for _, v in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for q, rows in got.items():
        for s, v in rows:
            assert s == np.sqrt(((x[v].astype(float) - x[q].astype(float)) ** 2).sum())


def test_odd_vectors_ties_and_copies(spark, schema):
    nan, inf = float("nan"), float("inf")
    good = {i: [float(i % 7), 1.0, -0.0] for i in range(60)} | {200 + i: [1.0, 2.0, 3.0] for i in range(40)}
    bad = [(1000, None), (1100, []), (1200, [0.0, 0.0, 0.0]), (1300, [nan, 1.0, 1.0]), (1400, [inf, 1.0, 1.0]), (1500, [None, 1.0, 1.0]), (1600, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    rows = [(i, v, 0, None) for i, v in [*good.items(), *bad]] + [(20, good[20], 1, "again")]
    got = found(spark.createDataFrame(rows, schema).repartition(3), 10, 20)
    want = brute(good, 10, 20)
    assert got == {q: [(float(s), v) for s, v in rows] for q, rows in want.items()}


def test_few_vectors_and_none(spark, schema):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, ""), (1, [0.0, 1.0], 0, ""), (2, [1.0, 1.0], 0, "")], schema)
    assert found(df, 10, 1) == brute({0: [1.0, 0.0], 1: [0.0, 1.0], 2: [1.0, 1.0]}, 10, 1)
    assert found(df.filter("vec_id = 0"), 10, 1) == {}
    assert found(df.filter("false"), 10, 1) == {}


def recall(df, rows, k=10, every=100):
    want, got = brute(rows, k, every), found(df, k, every)
    assert set(want) == set(got)
    return sum(len({v for _, v in want[q]} & {v for _, v in got[q]}) for q in want) / sum(map(len, want.values()))


def test_tight_clusters_and_one_huge_component(spark, schema):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(2, 24))
    x = (centres[np.arange(3000) % 2] + rng.normal(size=(3000, 24)) * 1e-5).astype(np.float32)
    x[1501, 3] = 1e8
    rows = dict(enumerate(x))
    df = spark.createDataFrame([(i, v.tolist(), None, "n") for i, v in rows.items()], schema).repartition(4)
    assert recall(df, rows) >= 0.9


def test_block_distances_keep_their_bits():
    rng = np.random.default_rng(5)
    x = 1 + rng.normal(size=(300, 16)) * 1e-9
    x[7, 2] = 1e12
    want = ((x[:, None] - x) ** 2).sum(axis=2)
    assert np.allclose(ann._distances(x[:50], x), want[:50], rtol=1e-5, atol=0)


def test_rounds_go_on_until_few_edges_change(spark, schema, monkeypatch):
    """From a poor start, a ring in the order of the ids, with hubs and a beam that are small."""
    x = np.random.default_rng(6).normal(size=(2000, 12)).astype(np.float32)
    ring = [(i, j % 2000, float(((x[i].astype(float) - x[j % 2000]) ** 2).sum())) for i in range(2000) for j in (i + 1, i + 2)]
    monkeypatch.setattr(ann, "_start", lambda nodes, *_: spark.createDataFrame(ring, ann.EDGES))
    monkeypatch.setattr(ann, "JOIN_BLOCK", 16)
    monkeypatch.setattr(ann, "BEAM", 12)
    rows = dict(enumerate(x))
    assert recall(spark.createDataFrame([(i, v.tolist(), None, "n") for i, v in rows.items()], schema).repartition(4), rows) >= 0.9


def test_large_blocks_are_split_by_nearness(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    x = np.repeat(np.arange(20.0), 30)[:, None] * 1000 + np.random.default_rng(7).normal(size=(600, 3))
    nodes = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, v binary")
    blocks = nodes.select(F.lit("0").alias("block"), "node")
    got = {}
    for r in ann._split(blocks, nodes, "<f8").collect():
        got.setdefault(r.block, []).append(r.node)
    assert sorted(n for b in got.values() for n in b) == list(range(600))
    assert all(len(b) <= 40 for b in got.values())
    assert all(max(b) // 30 - min(b) // 30 <= 1 for b in got.values())
