"""Substring deduplication by unit hashing (operator 2).

Texts are tiled into units: lines, paragraphs, or the sentences of every line.
Units are normalised (A-Z and other capitals lower-cased, white space collapsed)
and hashed to 128 bits.  Digests are grouped over the whole corpus; the
earliest ranked occurrence (smallest doc_id, then smallest start) of a unit
stays, every other one is removed, and the removals keep their offsets in the
original text.

The first occurrence inside a document is known where the document is read, so
the corpus only has to find the smallest doc_id of a digest: a count and a
minimum, aggregated in every task before the shuffle.  The repeated digests are
written, and the texts are read a second time: only units whose digest may be a
repeated one (a bit map of fixed size tells) go to the join with them, with their
offsets.  Both sides of it are plain tables, so a very common unit can be split.
The bit map only saves shuffling: what it lets through too much, all of it where the
corpus has far more repeated digests than it has bits, the join removes.

Units of fewer than ``MIN_WORDS`` words repeat by chance, so a short unit goes only
inside a repeated run: for each short unit the shortest runs of units that begin
and that end with it and have ``MIN_WORDS`` words are hashed too, and the short units
of a run follow its digest.  So a run of whole units with that many words goes
whole, whatever its units are.  Runs that overlap the first of their kind in
the document are part of it.

Defined results: null and empty texts have no unit; a null doc_id ranks last;
rows that repeat a doc_id have equal rank, so what they hold twice stays in
each, and units at the same place are listed once; a short unit of several repeated
runs has the earliest kept document of them and the largest number of copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import SPACE, bit_map, fresh, written

MIN_WORDS = 8
#: Tiles of a text; each holds its delimiter and the white space after it.
TILES = {
    "line": r"[^\n]*\n+|[^\n]+",
    "paragraph": rf"(?:[^\n]+\n)*?[^\n]*\n{SPACE}*\n|[^\n]+(?:\n[^\n]+)*\n?|\n+",
    "sentence": rf"[^\n.!?]*(?:[.!?]+|\n|$){SPACE}*",
}
SLICE_ROWS = 256
#: Digests in a batch that a task gives out.
BATCH = 1 << 16
#: Bits of the map of repeated digests.
MAP_BITS = 1 << 28
LAST = 2**63 - 1
WHITE = " \t\n\x0b\x0c\r"

DIGESTS = "h1 long, h2 long, doc_id long"
UNITS = DIGESTS + ", first boolean, members array<struct<unit: int, start: long, length: long>>"


def _runs(sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """(begin, end) of the shortest runs of ``min_words`` words or more that begin or end with a short unit."""
    out = set()
    for i, own in enumerate(sizes):
        if own >= min_words:
            continue
        for way in (1, -1):
            n, j = 0, i
            while 0 <= j < len(sizes):
                n += sizes[j]
                if n >= min_words:
                    out.add((min(i, j), max(i, j)))
                    break
                j += way
    return sorted(out)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _marks(text: str, tiles: re.Pattern, min_words: int) -> tuple[list[tuple[int, int, int]], list[int], list[tuple[bytes, bool, int, int]]]:
    """A text's units (number, start, end), their words, and (digest, first of its kind, begin, end) of long units and runs."""
    places, sizes, own = [], [], []
    for i, m in enumerate(tiles.finditer(text)):
        words = m.group().lower().split()
        if words:
            places.append((i, m.start(), m.end()))
            sizes.append(len(words))
            own.append(_digest(" ".join(words).encode("utf-8", "surrogatepass")))
    marks, seen = [], {}
    long = [(i, i) for i, n in enumerate(sizes) if n >= min_words]
    for begin, end in [*long, *_runs(sizes, min_words)]:
        # A run is named by the names of its units.
        d = own[begin] if begin == end else _digest(b"".join(own[begin : end + 1]))
        first = d not in seen
        if not first and begin <= seen[d]:
            continue
        seen.setdefault(d, end)
        marks.append((d, first, begin, end))
    return places, sizes, marks


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            b = whole.slice(at, SLICE_ROWS)
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    yield doc, text


def digests(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, id_col="doc_id", text_col="text") -> DataFrame:
    """(h1, h2, doc_id): every unit of ``min_words`` words and every run around a shorter one."""
    tile = TILES[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = re.compile(tile)
        names, ids = [], []

        def batch() -> pa.RecordBatch:
            h = _halves(names)
            return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64())], ["h1", "h2", "doc_id"])

        for doc, text in _documents(batches):
            marks = _marks(text, tiles, min_words)[2]
            names += [m[0] for m in marks]
            ids += [doc] * len(marks)
            if len(names) >= BATCH:
                yield batch()
                names, ids = [], []
        yield batch()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, DIGESTS)


def units(docs: DataFrame, repeated: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, id_col="doc_id", text_col="text") -> DataFrame:
    """Of the rows of ``digests`` those of ``repeated`` (h1, h2) and few others: whether it is the
    first of its kind in its document, and the units that go with it."""
    tile = TILES[unit]
    shipped = docs.sparkSession.sparkContext.broadcast(bit_map(repeated, F.col("h1").bitwiseAND(F.lit(MAP_BITS - 1)), MAP_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = re.compile(tile)
        wanted = np.frombuffer(shipped.value, np.uint8)
        place = pa.list_(pa.struct([("unit", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), place)
        rows = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h1", "h2", "doc_id", "first", "members"])

        for doc, text in _documents(batches):
            places, sizes, marks = _marks(text, tiles, min_words)
            h = _halves([m[0] for m in marks])
            bit = h[:, 0] & (MAP_BITS - 1)
            for k in np.flatnonzero(wanted[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).tolist():
                _, first, begin, end = marks[k]
                members = [{"unit": i, "start": start, "length": len(text[start:stop].rstrip(WHITE))}
                           for (i, start, stop), n in zip(places[begin : end + 1], sizes[begin : end + 1]) if begin == end or n < min_words]
                rows.append((int(h[k, 0]), int(h[k, 1]), doc, first, members))
                if len(rows) >= BATCH:
                    yield batch()
                    rows = []
        yield batch()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, UNITS)


def removed(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, unit, start, length, keep_doc_id, copies: the units to remove and where the kept one lies."""
    rank = F.coalesce("doc_id", F.lit(LAST))
    named = digests(docs, unit, min_words, id_col, text_col)
    repeated = written(named.groupBy("h1", "h2").agg(F.min(rank).alias("keep"), F.count("*").alias("copies")).filter("copies > 1"), "repeated")
    found = units(docs, repeated, unit, min_words, id_col, text_col)
    gone = (found.join(repeated, ["h1", "h2"]).filter((rank > F.col("keep")) | ~F.col("first"))
            .select("doc_id", "keep", "copies", F.inline("members")))
    # A short unit can lie in several repeated runs.
    return (gone.groupBy("doc_id", "unit", "start", "length").agg(F.min("keep").alias("keep"), F.max("copies").alias("copies"))
            .select("doc_id", "unit", "start", "length", F.when(F.col("keep") < LAST, F.col("keep")).alias("keep_doc_id"), "copies"))


def cleaned(docs: DataFrame, spans: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``docs`` without the removed spans; ``removed_spans`` (replaced if there) keeps their original offsets.

    A document's spans are at most its units, so they fit in its row.
    """
    own = fresh(docs, "_id")
    per = (spans.select(F.col("doc_id").alias(own), F.struct("start", "length").alias("s")).distinct()
           .groupBy(own).agg(F.array_sort(F.collect_list("s")).alias("removed_spans")))
    rest = docs.drop(*(c for c in docs.columns if c.lower() == "removed_spans"))
    joined = rest.join(per, rest[id_col].cast("long").eqNullSafe(F.col(own)), "left").drop(own)
    names = joined.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, cut in zip(b.column(text_col).to_pylist(), b.column("removed_spans").to_pylist()):
                if text and cut:
                    parts, at = [], 0
                    for s in cut:
                        parts.append(text[at : s["start"]])
                        at = s["start"] + s["length"]
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_col else b.column(n) for n in names], names)

    return joined.mapInArrow(run, joined.schema)
