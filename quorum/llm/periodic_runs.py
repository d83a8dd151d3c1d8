"""Periodic runs of words by suffix-tree longest common extensions (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), of at least ``LEAST_WORDS`` words and two periods, that no
neighbouring word extends.  Every run is found from a Lyndon root (the runs
theorem): for one order of the words or its reverse, the longest Lyndon word
that begins at a root's first word ends before the next smaller suffix.  Two
Ukkonen trees are built, of the words and of their reversal; leaves met in
order rank the suffixes, and the smallest string depth between two leaves on
the Euler tour, a range minimum in constant time, is the longest common
extension.  Candidates are extended to both sides by them.

Trees are only built for stretches that can hold a run: in a run every word
lies in one of two equal sequences of ``GRAM`` words within the run, so words
of no repeated sequence are set aside, again and again within what remains,
until nothing changes.  That leaves out no run.

Memory grows with the longest such stretch (some 500 bytes a word of it).
Defined results: a null or empty text, or one without words, has no words, no
runs and an empty collapsed text; a text of any length is one row and is
looked at whole; repeated rows give repeated results; an empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 12
#: A run of period q repeats at least max(12 - q, q) neighbouring words at distance q: 6 or more.
GRAM = 6
#: Texts, and bytes of text, looked at together.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 22
#: Places in a block of the range minimum.
RMQ_BLOCK = 32
TERMINAL = -1


def ukkonen(s: list[int]) -> tuple[list[int], list[int], list[dict[int, int] | None]]:
    """Suffix tree of ``s``, whose last number occurs once: edges' starts and ends by node, children by first number."""
    n = len(s)
    start, end, link, kids = [0], [0], [0], [{}]
    node = edge = length = remaining = 0
    for i, c in enumerate(s):
        remaining += 1
        unlinked = 0
        while remaining:
            if not length:
                edge = i
            branch = kids[node]
            to = branch.get(s[edge])
            if to is None:
                branch[s[edge]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                kids.append(None)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                size = end[to] - start[to]
                if length >= size and kids[to] is not None:
                    node, edge, length = to, edge + size, length - size
                    continue
                middle = s[start[to] + length]
                if middle == c:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                split = len(start)
                branch[s[edge]] = split
                start += (start[to], i)
                end += (start[to] + length, n)
                link += (0, 0)
                kids += ({middle: to, c: split + 1}, None)
                start[to] += length
                if unlinked:
                    link[unlinked] = split
                unlinked = split
            remaining -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - remaining + 1
    return start, end, kids


def leaves(tree, n: int, descending: bool = False) -> list[int]:
    """The suffixes in order; the terminal is smallest also when the words' order is reversed."""
    start, end, kids = tree
    out, stack = [], [(0, 0)]
    while stack:
        x, depth = stack.pop()
        branch = kids[x]
        if branch is None:
            out.append(n - depth)
            continue
        # The stack is left from its end: the terminal first, then upwards or downwards.
        last_first = sorted(branch, reverse=not descending)
        if last_first[0] == TERMINAL:
            last_first.append(last_first.pop(0))
        stack += [(branch[c], depth + end[branch[c]] - start[branch[c]]) for c in last_first]
    return out


class Extensions:
    """Longest common prefixes of any two suffixes: depth of the lowest common ancestor on the Euler tour."""

    def __init__(self, tree, n: int):
        start, end, kids = tree
        tour: list[int] = []
        self.first = np.zeros(n, np.int64)
        stack = [(0, 0)]
        while stack:
            x, depth = stack.pop()
            branch = kids[x] if x >= 0 else None
            if branch is not None:
                for to in branch.values():
                    stack.append((-1, depth))
                    stack.append((to, depth + end[to] - start[to]))
            elif x >= 0:
                self.first[n - depth] = len(tour)
            tour.append(depth)
        flat = np.array(tour, np.int32)
        flat = np.concatenate([flat, np.zeros(-len(flat) % RMQ_BLOCK, np.int32)])
        # Minima of 1, 2, 4 ... places for near queries; blocks' minima, and those up to and from a place, for others.
        self.near = [flat]
        while (step := 1 << len(self.near) - 1) < RMQ_BLOCK:
            last = self.near[-1]
            self.near.append(np.minimum(last, np.concatenate([last[step:], last[-1:].repeat(step)])))
        rows = flat.reshape(-1, RMQ_BLOCK)
        self.upto = np.minimum.accumulate(rows, axis=1).reshape(-1)
        self.onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        self.far = [rows.min(axis=1)]
        while (step := 1 << len(self.far) - 1) * 2 <= len(rows):
            last = self.far[-1]
            self.far.append(np.minimum(last[:-step], last[step:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        out = np.minimum(self.onward[a], self.upto[b])
        left, right = a // RMQ_BLOCK + 1, b // RMQ_BLOCK  # whole blocks between
        self._minima(self.far, left, right, right > left, out)
        near = right < left
        out[near] = np.iinfo(np.int32).max
        self._minima(self.near, a, b + 1, near, out)
        return out

    @staticmethod
    def _minima(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, where: np.ndarray, out: np.ndarray) -> None:
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        for k in np.unique(level[where]):
            at = np.flatnonzero(where & (level == k))
            out[at] = np.minimum(out[at], np.minimum(levels[k][a[at]], levels[k][b[at] - (1 << k)]))


def _next_smaller(rank: list[int]) -> np.ndarray:
    """For every place the next one with a smaller rank; the last rank is smallest."""
    out, stack = [0] * (len(rank) - 1), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(words: list[int], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` (numbers of 0 or more), by start, then period."""
    n = len(words)
    if n < least:
        return []
    tree = ukkonen([*words, TERMINAL])
    orders = [leaves(tree, n + 1, d) for d in (False, True)]
    forward = Extensions(tree, n + 1)
    del tree
    backward = Extensions(ukkonen([*reversed(words), TERMINAL]), n + 1)
    i = np.arange(n)
    found = []
    for order in orders:
        rank = [0] * (n + 1)
        for r, suffix in enumerate(order):
            rank[suffix] = r
        j = _next_smaller(rank)
        right = forward.of(i, j)
        left = backward.of(n - i, n - j)
        begin, length, period = i - left, j + right - i + left, j - i
        good = (length >= 2 * period) & (length >= least)
        found.append(np.stack([begin[good], length[good], period[good]], axis=1))
    every = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in every[np.lexsort((every[:, 2], every[:, 0]))].tolist()]


def stretches(words: np.ndarray, doc: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """(start, end) of the stretches of one document each that hold every run there can be."""
    at, part = np.arange(len(words)), doc.astype(np.uint64)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    while len(at) >= least:
        m = len(at) - GRAM + 1
        key = part[:m] * np.uint64(0xC2B2AE3D27D4EB4F)
        for k in range(GRAM):
            key = key * np.uint64(0x100000001B3) + mixed[at[k : m + k]]
        inside = np.flatnonzero(part[:m] == part[GRAM - 1 :])
        order = inside[np.argsort(key[inside], kind="stable")]
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hits = order[twice]
        edges = np.bincount(hits, minlength=len(at) + 1) - np.bincount(hits + GRAM, minlength=len(at) + 1)[: len(at) + 1]
        covered = np.cumsum(edges)[:-1] > 0
        new = np.ones(len(at), bool)
        new[1:] = (part[1:] != part[:-1]) | (covered[1:] != covered[:-1])
        stretch = np.cumsum(new) - 1
        kept = covered & (np.bincount(stretch)[stretch] >= least)
        if kept.all():
            starts = np.flatnonzero(new)
            return [(int(at[a]), int(at[z - 1]) + 1) for a, z in zip(starts, [*starts[1:], len(at)])]
        at, part = at[kept], stretch[kept].astype(np.uint64)
    return []


def _slices(b: pa.RecordBatch) -> Iterator[list]:
    """Rows of a batch in slices of bounded bytes (a longer text is a slice of its own)."""
    held, size = [], 0
    for key, text in zip(b.column(0).to_pylist(), b.column(1)):
        data = (text.as_py() or "").encode()
        if held and (len(held) >= SLICE_ROWS or size + len(data) > SLICE_BYTES):
            yield held
            held, size = [], 0
        held.append((key, data))
        size += len(data)
    if held:
        yield held


RUNS = "array<struct<start: long, length: long, period: long>>"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, its runs by start and period, and the collapsed text.

    The collapsed text joins by one space the words that no run holds after its first period.
    """
    if least < 2 * GRAM:
        raise ValueError(f"runs of fewer than {2 * GRAM} words are not looked for")
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in _slices(b):
                # bytes.split cuts at exactly [\x20\x09-\x0D]+
                texts = [data.split() for _, data in rows]
                number: dict[bytes, int] = {}
                flat = [number.setdefault(w, len(number)) for t in texts for w in t]
                ends = np.cumsum([len(t) for t in texts])
                found: list[list] = [[] for _ in rows]
                collapsed = [None] * len(rows)
                of = np.repeat(np.arange(len(rows)), np.diff(ends, prepend=0))
                for a, z in stretches(np.array(flat, np.int64), of, least):
                    k = int(of[a])
                    first = int(ends[k]) - len(texts[k])
                    found[k] += [(s + a - first, n, p) for s, n, p in runs_of(flat[a:z], least)]
                for k, runs in enumerate(found):
                    words = texts[k]
                    if runs:
                        runs.sort(key=lambda r: (r[0], r[2]))
                        s, n, p = np.array(runs).T
                        cut = np.bincount(s + p, minlength=len(words) + 1) - np.bincount(s + n, minlength=len(words) + 1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(cut)[:-1] == 0).tolist()]
                    collapsed[k] = b" ".join(words).decode()
                yield pa.RecordBatch.from_arrays([
                    pa.array([key for key, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], run_type),
                    pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
