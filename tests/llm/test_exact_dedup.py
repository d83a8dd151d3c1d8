import hashlib
import random

import pytest

from quorum.llm import exact_dedup

GONE = str.maketrans("", "", " \t\n\x0b\x0c\r")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(GONE), []).append((-len(t or ""), i is None, i or 0))
    best = {g: min(v) for g, v in groups.items()}
    out = []
    for i, t in rows:
        g = (t or "").translate(GONE)
        keep = None if best[g][1] else best[g][2]
        out.append((i, keep, len(groups[g]), i == keep, hashlib.sha256(g.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **more):
    return sorted((tuple(r) for r in exact_dedup.exact_duplicates(df, **more).collect()), key=str)


@pytest.mark.parametrize("size", [3, 4096])
def test_against_brute_force(odd, size):
    rows = [(r.doc_id, r.text) for r in odd.collect() if size > 3 or r.doc_id != 7]
    df = odd if size > 3 else odd.filter("doc_id is null or doc_id <> 7")
    assert got(df, block_chars=size) == brute(rows)


def test_many_levels_and_hot_blocks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 8)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(rng.randint(0, 24)))) for i in range(300)]
    rows += [(1000 + i, "aaaa" * 9 + " " * (i % 3)) for i in range(200)] + [(2000 + i, "aaaa" * rng.randint(1, 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df, block_chars=4) == brute(rows)


def test_drop_keeps_columns(odd, empty):
    left = exact_dedup.drop_exact_duplicates(odd)
    assert left.columns == odd.columns
    ids = {r.doc_id for r in left.collect()}
    assert 3 in ids and not {1, 2} & ids
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_native(odd):
    plan = exact_dedup.blocks(odd, "doc_id", "text", 16)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
