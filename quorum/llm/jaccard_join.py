"""N-gram Jaccard join by a prefix tree (operator 3).

A document's set is its distinct word n-grams.  Two documents link when their
sets' Jaccard similarity reaches a threshold; the operator returns the
connected components of all links, exactly.

Global order: n-grams sort by how many documents hold them, rarest first.  The
counts come from a sketch of fixed size over all documents, so they only
steer the order; any order gives the same result.

Which sets can link: two similar sets share an n-gram among the first few of
their ordered sets (the prefix left by the required overlap), at positions whose
sum the allowed differences bound.

Joining: the candidates of a set are stored in a prefix tree (sets sorted as
sequences, the most frequent n-grams first, with the length that each shares
with the one before).  A traversal keeps the overlap at every depth of the
current path, so sets that share a path share its partial overlap, and leaves
a subtree as soon as the overlap plus what the remaining lengths allow stays
under what the threshold needs.

Components without all pairs: equal sets are one class first.  In a few rounds
every class is joined with one leader of its prefix n-grams that isn't in its
component yet; then only the candidate pairs that still lie in different
components are joined, all of them.  A pair inside one component can't change
the result, so no link between components is lost and large groups of near
copies cost a multiple of their size.  A leader's candidates are salted over
blocks of bounded size.

Defined results: a null or wordless text has no n-gram, links with nothing and
is its own component; a text with fewer words than n is one n-gram; rows with a
null id have a null component and link nothing; rows that repeat an id are
judged by their own texts; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import bit_map, fresh, runs, written

WORDS = 3
PERCENT = 90
#: Counters of the sketch that steers the global order, and counters in one of its rows.
SKETCH, SKETCH_ROW = 1 << 20, 1 << 15
#: Sketch rows that are added up in one group.
SKETCH_GROUP = 64
#: N-grams in a block of candidates.
BLOCK_GRAMS = 1 << 18
#: Rows of an n-gram that are compared in one group before they are dealt over pairs of blocks.
GROUP_ROWS = 4096
#: Rounds of joining with leaders before all candidate pairs across components are joined.
ROUNDS = 1
#: Bits of the map of wanted ids; when it fills up, more sets than needed are made.
MAP_BITS = 1 << 25
#: 64-bit words of a set's parity map at most, and bits of it per n-gram in which linked sets may differ.
PARITY_WORDS, PARITY_BITS = 16, 16
#: N-grams with more rows take part in the round that connects components by few pairs.
FOREST_ROWS = 2
SLICE_ROWS = 256

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


#: A random number for every byte value, and an odd base whose powers place the bytes of a word.
_BYTE = np.frombuffer(hashlib.shake_128(b"bytes").digest(8 * 256), "<u8")
_BASE = 0xD6E8FEB86659FD93
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.ones(size, np.uint64)
        done = 1
        while done < size:
            m = min(done, size - done)
            p[done : done + m] = p[:m] * np.uint64(pow(base, done, 1 << 64))
            done += m
        out.append(p)
    return out[0], out[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def gram_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word n-grams of the text, A-Z lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8) if text else np.zeros(0, np.uint8)
    gap = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << (len(data)).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    hashes = _mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    n = min(words, len(hashes))
    grams = np.full(len(hashes) - n + 1, n, np.uint64)
    for place in range(n):
        grams = _mixed(grams * _MIX[0] + hashes[place : place + len(grams)])
    return np.unique(grams)


def needed(a, b, percent: int = PERCENT):
    """The smallest overlap of linked sets of sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def required(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """The fewest n-grams that the prefixes of linked sets of sizes a and b share.

    The c-th common n-gram comes after at most a - overlap others of the one set (b - overlap of the
    other), so it lies in both prefixes as long as these have room.
    """
    overlap = F.ceil((a + b) * percent / F.lit(100 + percent))
    room = [n - F.ceil(n * percent / F.lit(100)) + 1 - (n - overlap) for n in (a, b)]
    return F.greatest(F.least(*room), F.lit(1))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            yield whole.slice(at, SLICE_ROWS)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """A row per document (doc_id, n, set_key), and each task's rows of the sketch (task, part, counts)."""
    schema = "doc_id long, n int, set_key binary, task int, part int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, task = np.zeros(SKETCH, np.int64), TaskContext.get().partitionId()
        for b in _slices(batches):
            sets = [gram_set(t, words) for t in b.column(1).to_pylist()]
            for s in sets:
                np.add.at(sketch, (s % np.uint64(SKETCH)).astype(np.int64), 1)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            empty = pa.nulls(len(sets), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, sets), pa.int32()), pa.array(keys, pa.binary()), empty, empty, pa.nulls(len(sets), pa.binary())],
                ["doc_id", "n", "set_key", "task", "part", "counts"])
        if sketch.any():
            parts = [sketch[k : k + SKETCH_ROW].tobytes() for k in range(0, SKETCH, SKETCH_ROW)]
            m = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.array([task] * m, pa.int32()), pa.array(range(m), pa.int32()), pa.array(parts, pa.binary())],
                ["doc_id", "n", "set_key", "task", "part", "counts"])

    return docs.mapInArrow(run, schema)


def _ranks(made: DataFrame) -> np.ndarray:
    """For every counter of the sketch a rank from 0 (rare) to 255; of fixed size, so it can go to every task."""
    rows = made.filter("part is not null").select("part", "task", "counts")
    tasks = (rows.agg(F.max("task")).first()[0] or 0) + 1

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_ROW, np.int64)
        for c in t.column("counts").to_pylist():
            total += np.frombuffer(c, np.int64)
        return pa.table({"part": t.column("part")[:1], "task": t.column("task")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    while tasks > 1:
        rows = rows.withColumn("task", F.floor(F.col("task") / SKETCH_GROUP).cast("int")).groupBy("part", "task").applyInArrow(add, "part int, task int, counts binary")
        tasks = -(-tasks // SKETCH_GROUP)
    sketch = np.zeros(SKETCH, np.int64)
    for r in rows.collect():
        sketch[r.part * SKETCH_ROW : (r.part + 1) * SKETCH_ROW] = np.frombuffer(r.counts, np.int64)
    return np.minimum(255, 8 * np.log2(1 + sketch)).astype(np.uint8)


def _ordered(s: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The set in the global order, rarest first: rank, then hash."""
    return np.sort(ranks[(s % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | s >> np.uint64(8))


def parity(s: np.ndarray, percent: int = PERCENT) -> bytes:
    """A bit map in which every n-gram flips one bit: two maps differ in at most as many bits as their sets do in n-grams.

    Maps have 64 bits times a power of two, by the size of the set.  Half of a map laid over the other
    half by exclusive or is the map of half the size.
    """
    most, words = 2 * (len(s) - int(needed(len(s), len(s), percent))), 1
    while words < PARITY_WORDS and 64 * words < PARITY_BITS * most:
        words *= 2
    bits = np.bincount((s >> np.uint64(20)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def differing(maps: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of bits in which the maps of rows ``a`` and ``b`` differ, the larger of two folded to the other's size.

    ``maps`` has ``PARITY_WORDS`` columns, zero beyond the ``words`` of a row.
    """
    out, width = np.zeros(len(a), np.int64), np.minimum(words[a], words[b])
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        apart = (maps[a[at]] ^ maps[b[at]]).reshape(len(at), PARITY_WORDS // w, w)
        out[at] = np.bitwise_count(np.bitwise_xor.reduce(apart, axis=1)).sum(axis=1)
    return out


def _prefixes(docs: DataFrame, classes: DataFrame, shipped, words: int, percent: int) -> DataFrame:
    """(gram, class_id, n, pos, parity): the first n-grams of each class's ordered set; the parity map at pos 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            if not b.num_rows:
                continue
            grams = [np.frombuffer(g, np.int64) for g in b.column("grams").to_pylist()]
            lengths = np.array([len(g) for g in grams])
            place = np.concatenate([np.arange(p, dtype=np.int32) for p in lengths])
            own = np.repeat(np.arange(b.num_rows), lengths)
            maps = b.column("parity").take(pa.array(own, mask=place > 0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(grams)), pa.array(b.column("class_id").to_numpy()[own]), pa.array(b.column("n").to_numpy()[own]), pa.array(place), maps],
                ["gram", "class_id", "n", "pos", "parity"])

    heads = _sequences(docs, classes, shipped, words, percent)
    named = heads.join(classes.select("class_id", "low", "set_key"), ["low", "set_key"]).select("class_id", "n", "grams", "parity")
    return named.mapInArrow(run, "gram long, class_id long, n int, pos int, parity binary")


def _sequences(docs: DataFrame, classes: DataFrame, shipped, words: int, percent: int | None = None) -> DataFrame:
    """(low, set_key, n, grams, parity): the ordered sets of the given classes by their document, and of a few other rows.

    The sets are whole and have no parity map; with ``percent``, they are the first n-grams that links
    of so many percent need, with the map of the whole set.

    The texts stay where they are: a bit map of the wanted ids, of fixed size, goes to them, and only
    the sets of ids in the map are made.  Joins by both columns find the right ones.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    wanted = docs.sparkSession.sparkContext.broadcast(bit_map(classes, place("low"), MAP_BITS))
    names = ["low", "set_key", "n", "grams", "parity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, held = shipped.value, np.frombuffer(wanted.value, np.uint8)
        for b in batches:
            bit = b.column("place").to_numpy()
            keep = np.flatnonzero(held[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
            for at in range(0, len(keep), SLICE_ROWS):
                part = b.take(pa.array(keep[at : at + SLICE_ROWS]))
                sets = [gram_set(t, words) for t in part.column("text").to_pylist()]
                ordered = [_ordered(s, ranks)[: prefix_length(len(s), percent) if percent else len(s)].tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int32()), pa.array(ordered, pa.binary()),
                     pa.array([parity(s, percent) if percent else None for s in sets], pa.binary())], names)

    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", place("doc_id").alias("place"))
    return rows.mapInArrow(run, "low long, set_key binary, n int, grams binary, parity binary")


class PrefixTree:
    """Sets as sequences, the most frequent n-grams first, in sorted order with shared lengths."""

    def __init__(self, sets: list[tuple[int, np.ndarray]]):
        # Big-endian bytes sort as the sequences do.
        paths = sorted((g[::-1].astype(">u8").tobytes(), c) for c, g in sets)
        self.ids = [c for _, c in paths]
        self.paths = [np.frombuffer(p, ">u8").astype(np.uint64) for p, _ in paths]
        self.shared = [0]
        for a, b in zip(self.paths, self.paths[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared.append(int(differ[0]) if len(differ) else m)
        self.shared, self.sizes = np.array(self.shared), np.array([len(p) for p in self.paths])

    def linked(self, grams: np.ndarray, percent: int = PERCENT, step: int = 64) -> list[int]:
        """Ids of the sets that link with the set ``grams`` (ordered, rarest first)."""
        n, found, i = len(grams), [], 0
        overlaps = [0]  # at the depths known on the current path
        while i < len(self.paths):
            path, m = self.paths[i], len(self.paths[i])
            del overlaps[self.shared[i] + 1 :]
            least = int(needed(m, n, percent))
            while True:
                depth, overlap = len(overlaps) - 1, overlaps[-1]
                if depth >= m:
                    if overlap >= least:
                        found.append(self.ids[i])
                    i += 1
                    break
                # What the remaining lengths allow: the path's rest, and what of the set sorts after the path so far.
                rest = n if depth == 0 else int(np.searchsorted(grams, path[depth - 1]))
                if overlap + min(m - depth, rest) < least:
                    i = self._after(i, depth, overlap, rest, n, percent)
                    break
                part = path[depth : depth + step]
                at = np.minimum(np.searchsorted(grams, part), n - 1)
                overlaps += (overlap + np.cumsum(grams[at] == part)).tolist()
        return found

    def _after(self, i: int, depth: int, overlap: int, rest: int, n: int, percent: int) -> int:
        """The next path to look at when path ``i`` can't link from ``depth`` on.

        The whole subtree there is left if none of its lengths allows a link: the spare overlap grows
        with the length up to ``depth + rest``, then falls, so the nearest length there decides.
        """
        leaving = np.flatnonzero(self.shared[i + 1 :] < depth)
        end = i + 1 + (int(leaving[0]) if len(leaving) else len(self.paths) - i - 1)
        sizes = self.sizes[i:end]
        best = min(max(depth + rest, int(sizes.min())), int(sizes.max()))
        return end if overlap + min(best - depth, rest) < int(needed(best, n, percent)) else i + 1


def _joined(pairs: DataFrame, classes: DataFrame, sequences: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those that link.  A repeated row only repeats a set, which changes no link."""
    sized = pairs.join(classes.select(F.col("class_id").alias("b"), "low", "set_key", "n"), "b")
    salts = sized.groupBy("a").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).cast("int").alias("salts"))
    members = sized.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"), F.col("b").alias("class_id"), "low", "set_key", F.lit(1).alias("order"))
    heads = (members.select("a", "salt").distinct().join(classes.select(F.col("class_id").alias("a"), "low", "set_key"), "a")
             .select("a", "salt", F.col("a").alias("class_id"), "low", "set_key", F.lit(0).alias("order")))
    blocks = (
        heads.unionByName(members).join(sequences.select("low", "set_key", "grams"), ["low", "set_key"])
        .withColumn("block", F.concat_ws("/", "a", "salt"))
        .repartition("block").sortWithinPartitions("block", "order").select("block", "class_id", "grams")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, "block"):
            ids = t.column("class_id").to_pylist()
            sets = [np.frombuffer(g, np.uint64) for g in t.column("grams").to_pylist()]
            found = PrefixTree(list(zip(ids[1:], sets[1:]))).linked(sets[0], percent)
            yield pa.RecordBatch.from_arrays([pa.array([ids[0]] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"])

    return blocks.mapInArrow(run, "a long, b long")


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shipped, words: int, percent: int) -> DataFrame:
    pairs = written(pairs, "pairs")
    wanted = classes.join(pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct(), "class_id", "left_semi")
    wanted = written(wanted, "wanted")
    return written(_joined(pairs, wanted, _sequences(docs, wanted, shipped, words), percent), "found")


def components(links: DataFrame) -> DataFrame:
    """(class_id, component): the smallest number that links reach, for all in ``links`` (a, b)."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = written(both.groupBy(F.col("a").alias("class_id")).agg(F.min("b").alias("m"))
                    .select("class_id", F.least("class_id", "m").alias("component")), "components")
    while True:
        near = both.join(state.select(F.col("class_id").alias("b"), "component"), "b").groupBy(F.col("a").alias("class_id")).agg(F.min("component").alias("m"))
        lower = state.join(near, "class_id").select("class_id", F.col("component").alias("old"), F.least("component", "m").alias("component"))
        # Follow the component's own component: chains shrink by half.
        jump = state.select(F.col("class_id").alias("component"), F.col("component").alias("next"))
        state = written(lower.join(jump, "component", "left").select("class_id", F.least("component", "next").alias("component"), "old"), "components")
        if not state.filter("component <> old").limit(1).count():
            return state.select("class_id", "component")
        state = state.select("class_id", "component")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """The rows in groups of at most some ``GROUP_ROWS`` * 2, in which every two rows of an n-gram meet once.

    An n-gram with more rows is dealt into blocks by class, and each pair of blocks is a group of its
    own (``apart``: only rows of different ``side`` are compared there).
    """
    blocks = written(rows.groupBy("gram").agg(F.ceil(F.count("*") / GROUP_ROWS).cast("int").alias("blocks")).filter("blocks > 1"), "blocks")
    own, other = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"), F.col("other")
    dealt = rows.join(blocks, "gram", "left").withColumn("own", own).withColumn(
        "other", F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))))
    low, high = F.least("own", other), F.greatest("own", other)
    several = F.col("blocks").isNotNull()
    # Groups with one hash by chance only give more candidates, which are verified like all others.
    return dealt.withColumns({
        "apart": F.coalesce(several & (low != high), F.lit(False)), "side": F.coalesce(several & (F.col("own") == high), F.lit(False)),
        "gram": F.when(several, F.xxhash64("gram", low, high)).otherwise(F.col("gram"))}).drop("blocks", "own", "other")


def _across(rows: DataFrame, parities: DataFrame, percent: int, forest: bool = False) -> DataFrame:
    """Candidate pairs (a, b) of different components among rows (gram, class_id, n, pos, component).

    ``parities`` (class_id, parity) are the classes' maps; one without a map is compared without that test.

    At the first n-gram that two linked sets share, their positions add up to no more than the
    n-grams in which they may differ, and their parity maps never differ in more bits than that.

    With ``forest`` a task leaves out pairs whose components it has connected already, and pairs whose
    maps are not well inside the bound: few pairs that nearly always link, for a round before all are joined.
    Only n-grams with more than ``FOREST_ROWS`` rows are looked at then, as others have few pairs in any case.
    """
    def pairs(x: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        size = len(x["gram"])
        i, d = np.arange(size), 1
        label = np.unique(x["component"], return_inverse=True)[1]
        root = np.arange(label.max() + 1 if size else 0)
        while len(i := i[i + d < size]):
            i = i[x["gram"][i] == x["gram"][i + d]]
            a, b = i, i + d
            na, nb = x["n"][a].astype(np.int64), x["n"][b].astype(np.int64)
            most = na + nb - 2 * needed(na, nb, percent)
            fits = (root[label[a]] != root[label[b]]) & (~(x["apart"][a] & x["apart"][b]) | (x["side"][a] != x["side"][b])) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (x["pos"][a] + x["pos"][b] <= most)
            a, b, most = a[fits], b[fits], most[fits]
            near = differing(x["parity"], x["words"], a, b) <= (most * 3 // 4 if forest else most)
            near |= ~(x["sure"][a] & x["sure"][b])
            if forest and near.any():
                near = connecting(root, label[a], label[b], near)
            if near.any():
                u, v = x["class_id"][a[near]], x["class_id"][b[near]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])
            d += 1

    def connecting(root: np.ndarray, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Of the near pairs those that connect two roots; ``root`` is brought up to date."""
        kept = np.zeros(len(near), bool)
        for k in np.flatnonzero(near).tolist():
            u, v = int(a[k]), int(b[k])
            while root[u] != u:
                u = int(root[u])
            while root[v] != v:
                v = int(root[v])
            if u != v:
                root[max(u, v)] = min(u, v)
                kept[k] = True
        while (root[root] != root).any():
            root[:] = root[root]
        return kept

    def columns(b: pa.RecordBatch) -> dict[str, np.ndarray]:
        maps = b.column("parity").to_pylist()
        padded = np.frombuffer(b"".join(m.ljust(8 * PARITY_WORDS, b"\0") for m in maps), np.uint64).reshape(len(maps), PARITY_WORDS)
        plain = {n: b.column(n).to_numpy(zero_copy_only=False) for n in b.schema.names if n != "parity"}
        return plain | {"parity": padded, "words": np.array([len(m) // 8 for m in maps], np.int64)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for b in batches:
            new = columns(b)
            held = new if held is None else {n: np.concatenate((held[n], new[n])) for n in new}
            cut = int(np.searchsorted(held["gram"], held["gram"][-1])) if len(held["gram"]) else 0
            yield from pairs({n: v[:cut] for n, v in held.items()})
            held = {n: v[cut:] for n, v in held.items()}
        if held is not None:
            yield from pairs(held)

    if forest:
        rows = written(rows.join(rows.groupBy("gram").count().filter(F.col("count") > FOREST_ROWS).select("gram"), "gram"), "frequent")
    maps = _block_pairs(rows).join(parities, "class_id").withColumns({"sure": F.col("parity").isNotNull(), "parity": F.coalesce("parity", F.lit(bytes(8)))})
    return maps.repartition("gram").sortWithinPartitions("gram", "n", "class_id").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, forest: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``forest`` adds a round that connects components by few pairs, so that large groups that link
    densely don't come with all their pairs; the result is the same without.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = written(_sets(docs, words), "sets")
    rows = made.filter("part is null").select("doc_id", "n", "set_key")
    shipped = spark.sparkContext.broadcast(_ranks(made))  # one byte per counter
    # A class is named by a number of its own, as one id may have several texts.
    classes = written(rows.filter("n > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("low"), F.min("n").alias("n"))
                      .withColumn("class_id", F.monotonically_increasing_id()), "classes")
    prefixes = written(_prefixes(docs, classes, shipped, words, percent), "prefixes")
    shared = prefixes.groupBy("gram").agg(F.count("*").alias("held")).filter("held > 1").select("gram")
    light = written(prefixes.drop("parity").join(shared, "gram"), "shared")
    # A repeated row of a class's document has the same map.
    maps = prefixes.filter("pos = 0").groupBy("class_id").agg(F.min("parity").alias("parity"), F.max("parity").alias("other"))
    parities = written(maps.select("class_id", F.when(F.col("parity") == F.col("other"), F.col("parity")).alias("parity")), "parities")
    links = light.select(F.col("class_id").alias("a"), F.col("class_id").alias("b")).filter("false")
    current = light.withColumn("component", F.col("class_id"))
    for step in range(ROUNDS):
        # Per n-gram one leader, another one each round; per class the leader of most of its n-grams.
        order = F.xxhash64("class_id", F.lit(step))
        leaders = current.groupBy("gram").agg(F.min(order).alias("first"))
        led = current.join(leaders, "gram").filter(order == F.col("first")).select("gram", F.col("class_id").alias("a"), F.col("component").alias("of"), F.col("n").alias("m")).distinct()
        fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
        votes = (current.join(led, "gram").filter((F.col("component") != F.col("of")) & fits)
                 .groupBy("class_id", "a", "n", "m").agg(F.count("*").alias("votes")).filter(F.col("votes") >= required(F.col("n"), F.col("m"), percent)))
        pairs = votes.groupBy("class_id").agg(F.max(F.struct("votes", "a")).alias("best")).select(F.col("best.a").alias("a"), F.col("class_id").alias("b"))
        found = _linked(docs, classes, pairs, shipped, words, percent)
        links = written(links.unionByName(found), "all_links")
        current = _labelled(light, components(links))
    if forest:
        found = _linked(docs, classes, _across(current, parities, percent, forest=True), shipped, words, percent)
        links = written(links.unionByName(found), "all_links")
        current = _labelled(light, components(links))
    links = links.unionByName(_linked(docs, classes, _across(current, parities, percent), shipped, words, percent))
    final = written(components(links).join(classes.select("class_id", "low"), "class_id"), "components_of_classes")
    least = final.groupBy("component").agg(F.min("low").alias("found"))
    named = final.drop("low").join(least, "component").drop("component")
    return (
        rows.join(classes.drop("n"), "set_key", "left").join(named, "class_id", "left")
        .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("found", "low", "doc_id").alias("c"))
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("c")).alias("component_id"))
    )


def _labelled(light: DataFrame, labels: DataFrame) -> DataFrame:
    """The prefix rows of the n-grams that still lie in several components, with their component."""
    rows = light.join(labels, "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    open_ = rows.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("gram")
    return written(rows.join(open_, "gram"), "open")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, forest: bool = True) -> DataFrame:
    """The rows of ``docs`` whose id is their component's smallest, and those without an id."""
    keep = fresh(docs, "keep")
    first = near_duplicates(docs, id_col, text_col, words, percent, forest).filter(F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id")))
    return docs.join(first.select(F.col("doc_id").alias(keep)).distinct(), F.col(id_col).cast("long").eqNullSafe(F.col(keep)), "left_semi")
