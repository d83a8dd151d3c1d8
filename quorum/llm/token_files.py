"""Token files of patched frame-of-reference blocks (operator 11).

Documents are put in ascending order of their ids over ranges, tokenised, and
every range is written as files that hold whole documents.  A file is one
stream of ids in blocks of ``BLOCK``: a block's smallest id is subtracted, the
rest is packed at the width that ``percentile`` percent of the block's numbers
need, and the high bits of the numbers above it are stored in an exception
list.  An index holds every block's base, width, first byte and first
exception, so any stretch of ids is read from its blocks alone
(:func:`ids_between`).

A file, little-endian: ``HEADER`` (magic, ids of a block, range, ids of the
range before the file, documents, ids, blocks, exceptions), documents' ids,
whether they have one, lengths, the blocks' bases, widths, first bytes and
first exceptions, exceptions' positions and high bits, the packed blocks, and
the line feed of Spark's text writer.  That writer makes the files, so their
commit and the recovery of lost tasks are Spark's.

Defined results: a null text counts as empty and has only the end id; a null
doc_id comes before all others and is read back as null; rows of one id follow
each other in the order of their text's hash, repeated rows are documents of
their own and may lie in several ranges; a document of any length lies in one
file; an empty table gives no documents; other columns are ignored.  Strings
of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorum.llm.common import shared_dir, written
from quorum.llm.packing import byte_bpe

BLOCK, PERCENTILE, END = 1024, 98, 2
#: Ids after which a file is closed (some 8 MB), so that a task reads many files within its split.
FILE_IDS = 1 << 22
#: Blocks packed at once.
CHUNK = 64
MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIIQQQQQ")


def packed(ids: np.ndarray, percentile: int = PERCENTILE):
    """Bases, widths, exceptions' (block, position, high bits) and payloads of a matrix with a block a row."""
    base = ids.min(axis=1)
    rest = ids - base[:, None]
    at = max(-(-rest.shape[1] * percentile // 100) - 1, 0)
    width = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1].astype(np.uint8)
    high = rest.astype(np.uint64) >> width[:, None].astype(np.uint64)
    block, position = np.nonzero(high)
    payload: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(rest[rows].astype("<u4").view(np.uint8).reshape(len(rows), -1, 4), axis=2, bitorder="little")
        for row, data in zip(rows, np.packbits(bits[:, :, :w].reshape(len(rows), -1), axis=1, bitorder="little")):
            payload[row] = data.tobytes()
    return base, width, (block, position, high[block, position].astype(np.uint32)), payload


def unpacked(payload: bytes, width: int, block: int = BLOCK) -> np.ndarray:
    """The numbers of consecutive blocks of one width, a block a row."""
    if not width:
        raise ValueError("blocks of width 0 have no bytes")
    bits = np.unpackbits(np.frombuffer(payload, np.uint8), bitorder="little").reshape(-1, width)
    wide = np.zeros((len(bits), 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4").reshape(-1, block)


class Writer:
    """One file: documents go in, its bytes come out."""

    def __init__(self, part: int, first: int, block: int, percentile: int):
        self.part, self.first, self.block, self.percentile = part, first, block, percentile
        self.doc_ids, self.lengths, self.held, self.waiting, self.ids = [], [], [], 0, 0
        self.base, self.width, self.exceptions, self.payload = [], [], [], []
        self.blocks = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= CHUNK * self.block:
            self._pack(self.waiting // self.block * self.block)

    def _pack(self, n: int) -> None:
        stream = np.concatenate(self.held)
        self.held, self.waiting = [stream[n:]], len(stream) - n
        for at in range(0, n, CHUNK * self.block):
            part = stream[at : min(at + CHUNK * self.block, n)]
            base, width, (block, position, high), payload = packed(part.reshape(-1, self.block), self.percentile)
            self.base.append(base)
            self.width.append(width)
            self.exceptions.append((block + self.blocks, position, high))
            self.payload += payload
            self.blocks += len(base)

    def content(self) -> bytes:
        rest = self.waiting % self.block
        if rest:  # the last block is filled up with its last id
            self.held.append(np.repeat(self.held[-1][-1:], self.block - rest))
            self.waiting += self.block - rest
        if self.waiting:
            self._pack(self.waiting)
        joined = lambda arrays, kind: np.concatenate([*arrays, np.zeros(0, kind)]).astype(kind)
        block, position, high = (joined([e[i] for e in self.exceptions], k) for i, k in enumerate(("<i8", "<u2", "<u4")))
        sizes = np.array([len(p) for p in self.payload], "<u8")
        parts = [
            HEADER.pack(MAGIC, self.block, self.part, self.first, len(self.doc_ids), self.ids, self.blocks, len(position)),
            np.array([d or 0 for d in self.doc_ids], "<i8"), np.array([d is not None for d in self.doc_ids], np.uint8),
            np.array(self.lengths, "<u8"), joined(self.base, "<u4"), joined(self.width, np.uint8),
            np.cumsum(sizes, dtype="<u8") - sizes, np.searchsorted(block, np.arange(self.blocks)).astype("<u8"), position, high,
        ]
        return b"".join([p if isinstance(p, bytes) else p.tobytes() for p in parts] + self.payload)


class Reader:
    """The indexes of one file's bytes, and its ids on demand."""

    def __init__(self, content: bytes):
        magic, self.block, self.part, self.first, docs, self.ids, blocks, exceptions = HEADER.unpack_from(content)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.content, self.at = content, HEADER.size
        self.doc_ids, self.known, self.lengths = self._take("<i8", docs), self._take(np.uint8, docs), self._take("<u8", docs)
        self.base, self.width, self.starts = self._take("<u4", blocks), self._take(np.uint8, blocks), self._take("<u8", blocks)
        self.first_exception = self._take("<u8", blocks)
        self.position, self.high = self._take("<u2", exceptions), self._take("<u4", exceptions)

    def _take(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self.content, kind, n, self.at)
        self.at += out.nbytes
        return out

    def blocks(self, first: int, end: int) -> np.ndarray:
        """The ids of blocks ``first`` to ``end``, a block a row."""
        out = np.repeat(self.base[first:end, None], self.block, axis=1).astype(np.uint32)
        # Neighbours of one width lie side by side and are unpacked together.
        edges = np.flatnonzero(np.diff(self.width[first:end])) + 1
        for a, b in zip([0, *edges], [*edges, end - first]):
            w = int(self.width[first + a]) if b > a else 0
            if w:
                at = self.at + int(self.starts[first + a])
                out[a:b] += unpacked(self.content[at : at + (b - a) * w * self.block // 8], w, self.block)
        low = int(self.first_exception[first]) if first < len(self.base) else 0
        high = int(self.first_exception[end]) if end < len(self.base) else len(self.position)
        if high > low:
            of = np.searchsorted(self.first_exception, np.arange(low, high), side="right") - 1
            out[of - first, self.position[low:high]] += self.high[low:high] << self.width[of]
        return out


def ids_between(content: bytes, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a file, from the blocks that hold them."""
    file = Reader(content)
    end = min(end, file.ids)
    if end <= start:
        return np.zeros(0, np.uint32)
    first = start // file.block
    return file.blocks(first, -(-end // file.block)).reshape(-1)[start - first * file.block : end - first * file.block]


def write(docs: DataFrame, spec: bytes, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
          block: int = BLOCK, percentile: int = PERCENTILE, file_ids: int = FILE_IDS) -> None:
    """Write the ids of all documents, ``end`` after each, as files under ``path``."""
    if block % 8 or not 0 < block <= 1 << 16:
        raise ValueError("a block holds a multiple of 8 ids, 65536 at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, done = byte_bpe(spec), TaskContext.get().partitionId(), 0
        file = Writer(part, done, block, percentile)
        said = lambda: pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], ["content"])
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = bpe.ids(text.as_py())
                ids.append(end)
                file.add(doc, np.array(ids, np.uint32))
                if file.ids >= file_ids:
                    done += file.ids
                    yield said()
                    file = Writer(part, done, block, percentile)
        if file.doc_ids:
            yield said()

    # A unique last key lets the ranges split a common id and repeated rows.
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumns(
        {"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange("id", "hash", "row").sortWithinPartitions("id", "hash", "row")
    files = ordered.select("id", "text").mapInArrow(run, "content binary")
    files.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


DOCUMENTS = "part int, doc_id long, first long, n_tokens long, ids_crc32 long, ids binary"


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document of the files under ``path``: its range, id, first id in the range, length, checksum and ids.

    Ids are little-endian unsigned 32-bit integers.
    """
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in DOCUMENTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                file = Reader(content.as_py())
                edges = np.concatenate([[0], np.cumsum(file.lengths.astype(np.int64))])
                rows, at, held = [], 0, np.zeros(0, np.uint32)
                for i, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
                    if z > at + len(held):  # the next blocks, with what is still needed of those before
                        blocks = min(max(-(-z // file.block), (at + len(held)) // file.block + CHUNK), len(file.base))
                        more = file.blocks((at + len(held)) // file.block, blocks).reshape(-1)
                        held, at = np.concatenate([held[a - at :], more]), a
                    data = held[a - at : z - at].astype("<u4").tobytes()
                    rows.append((file.part, int(file.doc_ids[i]) if file.known[i] else None, file.first + a, z - a, zlib.crc32(data), data if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return files.mapInArrow(run, DOCUMENTS)


def round_trip(docs: DataFrame, spec: bytes, path: str | None = None, **how) -> DataFrame:
    """Write the files and read them back: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/quorum-llm/{uuid.uuid4().hex}/token_files"
    write(docs, spec, path, **how)
    back = written(read(spark, path, with_ids=False).drop("ids"), "token_index")
    # One row per range, so as many as there were writing tasks.
    sizes = back.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return back.join(bases, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
