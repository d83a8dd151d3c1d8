"""Packing token sequences by non-negative least squares (operator 9).

Documents are tokenised and followed by one end id.  Whole windows are cut off
a document first; what remains is a piece shorter than the window.  From the
histogram of these lengths (at most ``window - 1`` numbers, the only thing the
driver sees) the plan is made: shallow combinations of lengths that fill a
window exactly (one to three lengths) are enumerated, their repeat counts are
solved by non-negative least squares against the histogram and rounded down to
what the histogram holds, and the residual pieces are laid end to end and cut
greedily at the windows' borders.  What the last window holds is cut into
powers of two, which need no padding.

Pieces find their place by their rank among the pieces of their length.  Ranks
come from a running number in each task plus the sums of the tasks before, so a
very common length is never gathered anywhere.

Defined results: a null text counts as empty and has only the end id; a very
long text is cut into as many windows as it needs; repeated rows are pieces of
their own; an empty table gives an empty result; other columns are ignored.
Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.llm.common import written

WINDOW = 1024
END = 0
#: Lengths from which triples are enumerated: those with most pieces that pairs leave over.
TRIPLE_LENGTHS = 48
#: Pre-tokens of byte-level BPE, as the vocabulary's authors publish it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer texts go to the other library with the same ids, whose pattern needs no stack.
LONG_CHARS = 200_000
SLICE_ROWS = 256


def _byte_of() -> dict[str, int]:
    """Byte-level BPE's printable character for every byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids of a byte-level BPE tokenizer file, without special tokens."""

    def __init__(self, spec: bytes):
        self.slow = tokenizers.Tokenizer.from_str(spec.decode())
        self.slow.encode_special_tokens = True
        model, of = json.loads(spec)["model"], _byte_of()
        special = {i for i, t in self.slow.get_added_tokens_decoder().items() if t.special}
        ranks = {bytes(of[c] for c in t): i for t, i in model["vocab"].items() if i not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        # Ids in the order of merges: the faster library gives the same ids.
        self.fast = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if merged == sorted(merged) else None

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.fast is None or len(text) > LONG_CHARS:
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def byte_bpe(spec: bytes) -> ByteBpe:
    """Once per worker process and vocabulary."""
    return ByteBpe(spec)


PIECES = "task int, k long, doc_id long, start long, length int, doc_tokens long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``window`` ids, each with its running number ``k`` in its task among pieces of its length.

    Without ``with_ids`` only shorter pieces, which may be cut again, have their ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, seen = byte_bpe(spec), TaskContext.get().partitionId(), [0] * (window + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                rows = []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = bpe.ids(text)
                    ids.append(end)
                    data, n = np.array(ids, "<u4").tobytes(), len(ids)
                    for start in range(0, n, window):
                        part = data[4 * start : 4 * (start + window)]
                        length = len(part) // 4
                        rows.append((task, seen[length], doc, start, length, n, zlib.crc32(part), part if with_ids or length < window else None))
                        seen[length] += 1
                columns = list(zip(*rows)) or [()] * 8
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECES)


def combinations(histogram: np.ndarray) -> list[tuple[int, ...]]:
    """Shallow combinations of one to three lengths that fill a window or need no padding."""
    window = len(histogram)
    has = lambda a: 0 < a < window and histogram[a] > 0
    found = [(a,) for a in range(1, window) if has(a) and a & (a - 1) == 0]
    found += [(a, window - a) for a in range(1, window // 2 + 1) if has(a) and has(window - a)]
    paired = np.minimum(histogram[1:], histogram[:0:-1])
    left = np.argsort(-(histogram[1:] - paired), kind="stable")[:TRIPLE_LENGTHS] + 1
    triples = {tuple(sorted((int(a), int(b), window - int(a) - int(b)))) for a in left for b in left if has(window - int(a) - int(b)) and has(a) and has(b)}
    return found + sorted(triples)


def least_squares(a: np.ndarray, h: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative x that makes a @ x closest to h (accelerated projected gradient)."""
    x = y = np.zeros(a.shape[1])
    size, t = max(np.linalg.norm(a, 2) ** 2, 1e-9), 1.0
    for _ in range(steps):
        new = np.maximum(y - a.T @ (a @ y - h) / size, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(histogram: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, int]:
    """Slots (length, first rank, end rank, first sequence, offset), pieces used by length, sequences used.

    ``histogram[n]`` counts the pieces of length n; its size is the window.
    """
    window = len(histogram)
    shapes = combinations(histogram)
    use = np.zeros((window, len(shapes)))
    for j, shape in enumerate(shapes):
        for n in shape:
            use[n, j] += 1
    wanted = least_squares(use, histogram.astype(float)) if shapes else np.zeros(0)
    left, slots, used, sequences = histogram.astype(np.int64).copy(), [], np.zeros(window, np.int64), 0
    # Rounded down first, then whatever the histogram still holds.
    for counts in (np.floor(wanted + 1e-6), np.full(len(shapes), np.inf)):
        for j in np.argsort(-wanted, kind="stable"):
            repeat = int(min(counts[j], *(left[n] // shapes[j].count(n) for n in shapes[j])))
            if repeat <= 0:
                continue
            offset = 0
            for n in shapes[j]:
                slots.append((int(n), int(used[n]), int(used[n]) + repeat, sequences, offset))
                used[n] += repeat
                left[n] -= repeat
                offset += n
            sequences += repeat
    return slots, used, sequences


def _cut(x: Column, length: Column, whole: int, last: list[int], window: int) -> Column:
    """Where a residual piece at x is cut, its own ends included."""
    borders = F.array((F.floor(x / window) + 1) * window, *(F.lit(c).cast("long") for c in [whole * window, *last]))
    inner = F.filter(borders, lambda c: (c > x) & (c < x + length) & ((c <= whole * window) | F.array_contains(F.array(*(F.lit(v).cast("long") for v in [-1, *last])), c)))
    return F.array_sort(F.array_distinct(F.concat(F.array(x), inner, F.array(x + length))))


def pack(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids if asked for.

    Ids are little-endian unsigned 32-bit integers; :func:`sequences` joins them.
    """
    spark = docs.sparkSession
    made = written(pieces(docs, spec, id_col, text_col, window, end, with_ids), "pieces")
    counts = written(made.groupBy("length", "task").agg(F.count("*").alias("n")), "piece_counts")
    # At most one number per length.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    histogram = np.array([totals.get(n, 0) for n in range(window)], np.int64)
    slots, used, sequences = plan(histogram)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (made.drop("ids").join(counts.withColumn("before", before).drop("n"), ["length", "task"])
              .withColumn("rank", F.col("before") + F.col("k")))
    # The plan's rows are bounded by the combinations, whatever the corpus holds.
    places = [(n, a, b, s, o, -1) for n, a, b, s, o in slots]
    at = 0
    for n in range(1, window):
        if histogram[n] > used[n]:
            places.append((n, int(used[n]), int(histogram[n]), 0, 0, at))
            at += int(histogram[n] - used[n]) * n
    whole, rest, last = at // window, at % window, []
    for bit in range(window.bit_length() - 1, -1, -1):
        if rest & 1 << bit:
            last.append((last[-1] if last else whole * window) + (1 << bit))
    full_from = sequences + whole + len(last)
    places.append((window, 0, totals.get(window, 0), full_from, 0, -1))
    placed = ranked.join(
        F.broadcast(spark.createDataFrame(places, "length int, r0 long, r1 long, s0 long, o int, x0 long")), "length",
    ).filter("rank >= r0 and rank < r1")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task", "k", "cut"]
    fitted = placed.filter("x0 < 0").select(
        "*", (F.col("s0") + F.col("rank") - F.col("r0")).alias("sequence_id"), F.col("o").cast("long").alias("offset"), F.lit(-1).alias("cut"))
    x = F.col("x0") + (F.col("rank") - F.col("r0")) * F.col("length")
    ends = placed.filter("x0 >= 0").withColumn("ends", _cut(x, F.col("length"), whole, last, window))
    segments = ends.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("ends") - 2))).withColumn(
        "x", F.get("ends", F.col("i"))).withColumn("size", F.get("ends", F.col("i") + 1) - F.col("x"))
    tail = F.filter(F.array(*(F.lit(v).cast("long") for v in [whole * window, *last])), lambda c: c <= F.col("x"))
    block = F.least(F.floor(F.col("x") / window), F.lit(whole))
    laid = segments.select(
        "doc_id", (F.col("start") + F.col("x") - F.get("ends", F.lit(0))).alias("start"), F.col("size").cast("int").alias("length"), "ids_crc32", "doc_tokens",
        (sequences + F.when(F.col("x") < whole * window, block).otherwise(whole + F.size(tail) - 1)).alias("sequence_id"),
        (F.col("x") - F.when(F.col("x") < whole * window, block * window).otherwise(F.array_max(tail))).alias("offset"),
        "task", "k", F.when(F.size("ends") > 2, F.col("length")).otherwise(-1).alias("cut"),
        (F.col("x") - F.get("ends", F.lit(0))).cast("int").alias("from"))
    rows = fitted.select(*keep, F.lit(0).alias("from")).unionByName(laid)
    out = ["doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    own = F.substring(F.col("ids"), F.col("from") * 4 + 1, F.col("length") * 4)
    if with_ids:
        ids = made.select("task", "k", F.col("length").alias("of"), "ids")
        every = rows.withColumn("of", F.when(F.col("cut") >= 0, F.col("cut")).otherwise(F.col("length"))).join(ids, ["task", "k", "of"])
        return every.withColumn("ids", own).withColumn("ids_crc32", F.crc32("ids")).select(*out, "ids")
    # Only cut pieces need a new checksum, and whole windows are never cut.
    ids = made.filter(F.col("length") < window).select("task", "k", F.col("length").alias("cut"), "ids")
    recut = rows.filter("cut >= 0").join(ids, ["task", "k", "cut"]).withColumn("ids_crc32", F.crc32(own))
    return rows.filter("cut < 0").select(*out).unionByName(recut.select(*out))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): every sequence's ids; a sequence has at most a window of pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
