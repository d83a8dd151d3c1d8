import random
import re

import numpy as np
import pytest

from quorum.llm import jaccard_join

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    said = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not said:
        return frozenset()
    return frozenset(tuple(said[i : i + words]) for i in range(max(1, len(said) - words + 1)))


def brute(rows, words, percent):
    """Union of all linked pairs of rows; a row's component is the smallest id that its set reaches."""
    sets = [(i, shingles(t, words)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return sorted(((i, len(s), low[root(k)] if i is not None else None) for k, (i, s) in enumerate(sets)), key=str)


def got(df, **more):
    return sorted((tuple(r) for r in jaccard_join.near_duplicates(df, **more).collect()), key=str)


def corpus(seed):
    """Unrelated texts, families of near copies of several distances, and passages that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(30)]
    rows = []
    for family in range(25):
        base = [word() for _ in range(rng.randint(1, 160))]
        if rng.random() < 0.4:
            base[len(base) // 2 : len(base) // 2] = passage
        for copy in range(rng.choice([1, 1, 2, 3, 12])):
            said = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                at = rng.randrange(len(said))
                said[at : at + rng.randint(0, 1)] = [word()] if rng.random() < 0.7 else []
                said = said or ["x"]
            rows.append((" " if copy % 2 else "\n").join(w.upper() if copy % 3 == 0 else w for w in said))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 90), (2, 3, 90), (3, 5, 80), (4, 2, 50)])
def test_against_all_pairs(spark, seed, words, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, words=words, percent=percent) == brute(rows, words, percent)
    if percent == 80:
        assert got(df, words=words, percent=percent, forest=False) == brute(rows, words, percent)


def test_hot_grams_are_dealt_over_block_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", 7)
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, words=3, percent=90, forest=False) == brute(rows, 3, 90)
    assert got(df, words=5, percent=80) == brute(rows, 5, 80)


@pytest.mark.parametrize("least", [1, 3])
def test_connecting_round_on_frequent_grams(spark, monkeypatch, least):
    monkeypatch.setattr(jaccard_join, "FOREST_ROWS", least)
    rows = corpus(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, words=3, percent=90) == brute(rows, 3, 90)


def test_repeated_ids_with_two_texts(spark):
    rows = [(k // 2, t) for k, (_, t) in enumerate(corpus(6))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == brute(rows, 3, 90)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == brute(rows, 3, 90)
    assert got(empty) == []
    kept = jaccard_join.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert {2, 3} & {r.doc_id for r in kept.collect()} == set()


def test_tree_finds_all_links():
    rng = np.random.default_rng(0)
    for _ in range(40):
        base = np.unique(rng.integers(0, 400, 150)).astype(np.uint64)
        sets = [(k, np.setdiff1d(np.union1d(base, rng.integers(0, 400, k % 9).astype(np.uint64)), rng.choice(base, k % 11))) for k in range(60)]
        probe = np.setdiff1d(base, rng.choice(base, 4))
        linked = {k for k, s in sets if 100 * len(np.intersect1d(s, probe)) >= 90 * len(np.union1d(s, probe))}
        assert set(jaccard_join.PrefixTree(sets).linked(probe, step=16)) == linked


def test_parity_maps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(1)
    for n in (1, 20, 300, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.union1d(a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, n // 10, dtype=np.uint64))
        for percent in (50, 80, 90):
            maps = [jaccard_join.parity(s, percent) for s in (a, b)]
            words = np.array([len(m) // 8 for m in maps])
            table = np.frombuffer(b"".join(m.ljust(8 * jaccard_join.PARITY_WORDS, b"\0") for m in maps), np.uint64).reshape(2, -1)
            assert jaccard_join.differing(table, words, np.array([0]), np.array([1]))[0] <= len(np.setxor1d(a, b))


def test_maps_of_two_sizes_differ_as_the_smaller_ones_do():
    rng = np.random.default_rng(2)
    long = np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    short = long[:150]
    maps = [jaccard_join.parity(s) for s in (long, short)]
    words = np.array([len(m) // 8 for m in maps])
    assert words[0] > words[1]
    table = np.frombuffer(b"".join(m.ljust(8 * jaccard_join.PARITY_WORDS, b"\0") for m in maps), np.uint64).reshape(2, -1)
    size = 64 * int(words[1])
    flips = [np.bincount((s >> np.uint64(20)).astype(np.int64) % size, minlength=size) & 1 for s in (long, short)]
    assert jaccard_join.differing(table, words, np.array([0, 1]), np.array([1, 0])).tolist() == [int((flips[0] ^ flips[1]).sum())] * 2


def test_linked_sets_share_required_prefix_grams():
    """Brute force over small sets: the bounds on prefixes and votes never miss a link."""
    rng = random.Random(9)
    for percent in (50, 80, 90):
        for _ in range(3000):
            a = set(rng.sample(range(60), rng.randint(1, 40)))
            b = set(a)
            for _ in range(rng.randint(0, 6)):
                b.symmetric_difference_update({rng.randrange(60)})
            if not b or 100 * len(a & b) < percent * len(a | b):
                continue
            na, nb = len(a), len(b)
            overlap = jaccard_join.needed(na, nb, percent)
            pa, pb = (jaccard_join.prefix_length(n, percent) for n in (na, nb))
            votes = len(set(sorted(a)[:pa]) & set(sorted(b)[:pb]))
            assert len(a & b) >= overlap
            assert votes >= max(1, min(pa - (na - overlap), pb - (nb - overlap)))


def test_one_large_family_makes_few_pairs(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(400):
        said = list(base)
        said[rng.randrange(300)] = f"own{i}"
        rows.append((i, " ".join(said)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.component_id for r in jaccard_join.near_duplicates(df).collect()} == {0}
