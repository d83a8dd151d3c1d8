import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quorum.llm import spelling


def brute(rows):
    """The contract by plain Python: word -> (form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes = {}
    for w in words:  # words that differ by one replaced letter share a pattern with a hole
        for i in range(len(w)):
            holes.setdefault((i, w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in words}
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in words:
        for i in range(len(w)):
            if (v := w[:i] + w[i + 1 :]) in words:
                near[w].add(v)
                near[v].add(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def asked(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    from quorum.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = asked(queries.op13_spelling_variants(spark, sf))
    assert got == brute([tuple(r) for r in rows]) and any(f for f, *_ in got.values())


@pytest.fixture(scope="module")
def words(spark):
    """Chains of forms, repeated letters, accents, a very long word, ties."""
    long = "x" + "abcdefgh" * 400
    counts = {"letter": 800, "leter": 60, "lettter": 60, "lettera": 200, "letterab": 90, "letterabc": 30, "letterabcd": 9, "latter": 800,
              "Größe".lower(): 40, "gröse": 3, "ÿellow": 8, "yellow": 16, "aaaaa": 4, "aaaaaa": 8, "aaaaaaa": 16, "other": 5,
              long: 9, long[:50] + long[51:]: 3, long[:-1] + "q": 4, "four": 50, "twice": 2}
    texts = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    return texts, spark.createDataFrame(texts, "doc_id long, text string")


def test_edges_equal_brute_force(words):
    rows, docs = words
    assert asked(spelling.variants(docs)) == brute(rows)


def test_several_passes_give_the_same(words):
    rows, docs = words
    assert asked(spelling.variants(docs, filter_bytes=16)) == brute(rows)


def test_edit_hashes_follow_from_prefix_sums():
    words = ["straße", "aabbcc"]
    edits, own = spelling.Edits(words), lambda w: spelling.Edits([w]).own()[0]
    k, at, h = edits.deleted()
    assert [own(words[w][:i] + words[w][i + 1 :]) for w, i in zip(k, at)] == h.tolist()
    assert sorted(zip(k.tolist(), at.tolist())) == [*((0, i) for i in range(6)), (1, 0), (1, 2), (1, 4)]
    k, at, h = edits.replaced(ord("c"))
    assert [own(words[w][:i] + "c" + words[w][i + 1 :]) for w, i in zip(k, at)] == h.tolist()
    assert sorted(zip(k.tolist(), at.tolist())) == [(0, 3), (1, 0), (1, 1), (1, 2), (1, 3)]


def test_filters_have_no_false_negatives():
    h = np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64)
    rows, block, bits = np.zeros((7, 8), np.uint64), spelling._block(h, 7), spelling._bits(h)
    for k in range(spelling.PROBES):
        lane, bit = spelling._bit(bits, k)
        np.bitwise_or.at(rows, (block, lane), np.uint64(1) << bit)
    assert spelling.known({5: rows}, 5, h).all() and not spelling.known({5: rows}, 6, h).any()


def test_odd_rows(odd):
    got = asked(spelling.variants(odd))
    assert got == brute([(r["doc_id"], r["text"]) for r in odd.collect()])


def test_empty(empty):
    assert asked(spelling.variants(empty)) == {}
