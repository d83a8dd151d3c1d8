import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quorum.llm import periodic_runs


def brute(words, least=12):
    """Runs by trying every period at every place."""
    n, out = len(words), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - start
            if length >= max(least, 2 * p) and not any(s == start and m >= length and p % q == 0 for s, m, q in out):
                out.append((start, length, p))
            i += i == start or i + p < n
    return sorted(out, key=lambda r: (r[0], r[2]))


WORDS = st.one_of(
    st.lists(st.integers(0, 2), max_size=70),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=9)).map(
        lambda x: x[2] + x[0] * x[1] + x[2] * 2))


@settings(max_examples=400, deadline=None)
@given(WORDS)
def test_runs_equal_brute_force(words):
    assert periodic_runs.runs_of(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, max_size=5))
def test_stretches_lose_no_run(docs):
    flat = np.array([w for d in docs for w in d], np.int64)
    ends = np.cumsum([len(d) for d in docs], dtype=int)
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    got = sorted((int(of[a]), s + a, n, p) for a, z in periodic_runs.stretches(flat, of) for s, n, p in periodic_runs.runs_of(flat[a:z].tolist()))
    assert got == sorted((k, s + ends[k] - len(d), n, p) for k, d in enumerate(docs) for s, n, p in brute(d))


def test_long_runs_cross_the_range_minimum_blocks():
    words = [k % 7 for k in range(5000)] + list(range(10, 3000)) + [k % 400 for k in range(4000)]
    assert periodic_runs.runs_of(words) == [(0, 5000, 7), (7990, 4000, 400)]


def expected(doc_id, text):
    """The contract by plain Python."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark):
    from quorum.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    short = [r for r in rows if len(r["text"] or "") < 40_000]
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert len(got) == len(rows) and sum(r[1] > 0 for r in got.values()) > 10
    assert [got[r["doc_id"]] for r in short] == [expected(r["doc_id"], r["text"]) for r in short]


def test_odd_rows(spark, odd):
    got = periodic_runs.find_runs(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (10, 11, None)}
    for k in (4, 5, 6):
        assert (by[k]["n_words"], by[k]["runs"], by[k]["collapsed"]) == (0, [], "")
    assert [tuple(r) for r in by[7]["runs"]] == [(0, 3000, 1)] and by[7]["collapsed"] == "word " + "unbrokenrun" * 4000
    assert sum(r["doc_id"] == 11 and r["collapsed"] == "repeated row" for r in got) == 2


def test_empty(empty):
    assert periodic_runs.find_runs(empty).count() == 0
