"""Spelling variants by Bloom-guided edit neighbourhoods (operator 13).

Words are counted over all documents.  For each one its edits by one deleted or
replaced letter are generated (an inserted letter is a deletion seen from the
other word, and a pair is generated once, from its longer or smaller word) and
probed in Bloom filters of the vocabulary, one shard for each length, in blocks
of 512 bits.  Only edits that the filters know are shuffled to an exact join
with the vocabulary, which takes false positives out.

Words are hashed by a polynomial modulo 2**64, so that the hash of an edit
follows from the word's prefix sums without building its text.  The filters
are broadcast and hold at most ``FILTER_BYTES``, whatever the vocabulary's
size: a larger vocabulary is dealt by hash over several passes, each with
filters of that bound, and every edit is probed in each.

A word's form is its most frequent neighbour, if that has twice its count.
Counts double along a chain of forms, so it has at most 63 links and pointer
doubling ends in six rounds at most.

Defined results: null and empty texts have no words; a text of any length is
read whole; repeated rows count as often as they occur; a null doc_id is hashed as ``None``; an empty table gives an
empty result; other columns are ignored.  Ties of forms go to the smallest word
in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import written

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in this many (by hash) loses a letter.
FAULT_EVERY = 97
WORD = re.compile("[A-Za-zÀ-ÿ]+")
#: Words counted in a task before their counts go on.
HELD_WORDS = 400_000
#: A filter's bits for a word, bits set by it, and the bytes that all filters of a pass may have.
BITS_PER_WORD, PROBES, FILTER_BYTES = 24, 8, 1 << 26
BLOCK_BITS = 512
SHARDS = 64
#: Words whose edits one task generates.
TASK_WORDS = 20_000
#: Letters of words whose edits are generated together, and bytes of positives held before they go on.
CHUNK_LETTERS, CHUNK_BYTES = 1 << 16, 1 << 24

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def lower_ascii(text: str) -> str:
    """Only A to Z become small letters."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def faulty(doc_id: object) -> Callable[[str], str]:
    """What a document's words become: one letter is lost where the hash of document and word says so."""
    seed = zlib.crc32(f"{doc_id}:".encode())

    def change(word: str) -> str:
        h = zlib.crc32(word.encode(), seed)
        if h % FAULT_EVERY:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1 :]

    return change


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=faulty) -> DataFrame:
    """(word, n) of the words with ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences over all documents.

    ``change(doc_id)`` gives the function from a document's word to what it counts as (None: the word itself).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        said = lambda: pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                new = change(doc) if change else str
                for word, n in Counter(WORD.findall(lower_ascii(text.as_py() or ""))).items():
                    word = new(word)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= HELD_WORDS:
                    yield said()
                    counts.clear()
        yield said()

    parts = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _code(letters: np.ndarray) -> np.ndarray:
    """A letter's number in the polynomial."""
    return (letters.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def _finished(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial's value over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Edits:
    """Hashes of words of one length and of their edits: sum of code(letter k) * BASE ** k."""

    def __init__(self, words: list[str]):
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        n = self.letters.shape[1]
        self.codes, self.power = _code(self.letters), _powers(n + 1)
        self.before = np.zeros((len(words), n + 1), np.uint64)
        np.cumsum(self.codes * self.power[:n], axis=1, dtype=np.uint64, out=self.before[:, 1:])

    def own(self) -> np.ndarray:
        return _finished(self.before[:, -1])

    def deleted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, places whose letter is deleted (of equal neighbours the first), and the edits' hashes."""
        first = np.ones(self.letters.shape, bool)
        first[:, 1:] = self.letters[:, 1:] != self.letters[:, :-1]
        rest = (self.before[:, -1:] - self.before[:, 1:]) * INVERSE
        word, at = np.nonzero(first)
        return word, at, _finished((self.before[:, :-1] + rest)[word, at])

    def replaced(self, letter: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, places of smaller letters, and the hashes of the edits with ``letter`` there."""
        word, at = np.nonzero(self.letters < letter)
        change = (_code(np.array([letter])) - self.codes[word, at]) * self.power[at]
        return word, at, _finished(self.before[word, -1] + change)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, Edits]]:
    """Numbers of words of one length, some ``CHUNK_LETTERS`` letters at once, and their edits."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes).tolist():
        of, step = np.flatnonzero(sizes == n), max(CHUNK_LETTERS // n, 1)
        for i in range(0, len(of), step):
            yield of[i : i + step], Edits([words[k] for k in of[i : i + step]])


def shard(length: int) -> int:
    return min(length, SHARDS - 1)


def _block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (h >> np.uint64(32)) % np.uint64(blocks)


def _bits(h: np.ndarray) -> np.ndarray:
    """A number whose stretches of nine bits, seven apart, name a hash's bits in its block."""
    h2 = h * np.uint64(0x9FB21C651E98DF25)
    return h2 ^ (h2 >> np.uint64(28))


def _bit(of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit lane and bit in it of the ``k``-th probe."""
    place = (of >> np.uint64(7 * k)) & np.uint64(BLOCK_BITS - 1)
    return place >> np.uint64(6), place & np.uint64(63)


def known(filters: dict[int, np.ndarray], of: int, h: np.ndarray) -> np.ndarray:
    """Which hashes a shard's filter (a row of 512 bits a block, as 64-bit numbers) may hold."""
    rows = filters.get(of)
    if rows is None:
        return np.zeros(len(h), bool)
    alive, block, bits = np.arange(len(h)), _block(h, len(rows)), _bits(h)
    for k in range(PROBES):  # most leave at the first bits
        lane, bit = _bit(bits, k)
        ok = (rows[block, lane] >> bit) & np.uint64(1) == 1
        alive, block, bits = alive[ok], block[ok], bits[ok]
    out = np.zeros(len(h), bool)
    out[alive] = True
    return out


LANES = [f"l{k}" for k in range(BLOCK_BITS // 64)]


def filter_blocks(vocabulary: DataFrame, blocks: dict[int, int], passes: int) -> DataFrame:
    """(turn, shard, block, lanes) of the filters, or-ed over all words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).to_pylist()
            for of, edits in _by_length(words):
                h, which = edits.own(), shard(edits.letters.shape[1])
                lanes, bits, row = np.zeros((len(h), len(LANES)), np.uint64), _bits(h), np.arange(len(h))
                for k in range(PROBES):
                    lane, bit = _bit(bits, k)
                    lanes[row, lane] |= np.uint64(1) << bit
                yield pa.RecordBatch.from_arrays([
                    pa.array((h % np.uint64(passes)).astype(np.int32)), pa.array(np.full(len(h), which, np.int32)), pa.array(_block(h, blocks[which]).astype(np.int64)),
                    *(pa.array(np.ascontiguousarray(lanes[:, k]).view(np.int64)) for k in range(len(LANES)))], ["turn", "shard", "block", *LANES])

    made = vocabulary.select("word").mapInArrow(run, ", ".join(["turn int, shard int, block long", *(f"{c} long" for c in LANES)]))
    return made.groupBy("turn", "shard", "block").agg(*(F.bit_or(c).alias(c) for c in LANES))


def positives(vocabulary: DataFrame, filters, letters: list[int]) -> DataFrame:
    """(edit, word, n) of the edits, to one of ``letters`` where one is replaced, that the broadcast filters know."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, held = filters.value, 0, []
        said = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*held)) or [()] * 3, (pa.string(), pa.string(), pa.int64()))], ["edit", "word", "n"])
        for b in batches:
            words, counts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for of, edits in _by_length(words):
                length = edits.letters.shape[1]
                for letter in ["", *letters]:
                    word, at, h = edits.replaced(letter) if letter else edits.deleted()
                    ok, put = known(rows, shard(length if letter else length - 1), h), chr(letter) if letter else ""
                    for k, i in zip(of[word[ok]].tolist(), at[ok].tolist()):
                        held.append((words[k][:i] + put + words[k][i + 1 :], words[k], counts[k]))
                        size += length
                    if size >= CHUNK_BYTES:
                        yield said()
                        size, held = 0, []
        yield said()

    return vocabulary.select("word", "n").mapInArrow(run, "edit string, word string, n long")


def neighbours(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every word's near words, from both sides; ``vocabulary`` (word, n) is a written table."""
    spark = vocabulary.sparkSession
    # At most SHARDS rows.
    sizes = {r["shard"]: r["words"] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(SHARDS - 1)).alias("shard")).agg(F.count("*").alias("words")).collect()}
    passes = max(1, -(-sum(sizes.values()) * BITS_PER_WORD // (8 * filter_bytes)))
    blocks = {of: max(1, -(-n * BITS_PER_WORD // (BLOCK_BITS * passes))) for of, n in sizes.items()}
    bits = written(filter_blocks(vocabulary, blocks, passes), "spelling_filters") if passes > 1 else filter_blocks(vocabulary, blocks, passes)
    # At most 90 letters.
    letters = sorted(ord(r["letter"]) for r in vocabulary.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect() if r["letter"])
    dealt = vocabulary.repartition(max(1, -(-sum(sizes.values()) // TASK_WORDS)), "word")
    found = None
    for turn in range(passes):
        rows = {of: np.zeros((n, BLOCK_BITS // 64), np.uint64) for of, n in blocks.items()}
        # At most filter_bytes and one block a shard, whatever the vocabulary.
        part = bits.filter(F.col("turn") == turn).toPandas()
        for of, lanes in part.groupby("shard"):
            rows[of][lanes["block"]] = lanes[LANES].to_numpy(np.int64).view(np.uint64)
        shared = spark.sparkContext.broadcast(rows)
        exact = positives(dealt, shared, letters).join(vocabulary.select(F.col("word").alias("edit"), F.col("n").alias("edit_n")), "edit")
        pairs = written(exact.select("word", "n", F.col("edit").alias("near"), F.col("edit_n").alias("near_n")), "spelling_pairs")
        shared.destroy()
        found = pairs if found is None else found.unionByName(pairs)
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form, by pointer doubling; ``forms`` (word, form) is a written table."""
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(6):
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(reached.join(onward, "root", "left"), "spelling_roots")
        reached = stepped.select("word", F.coalesce("next", "root").alias("root"))
        if stepped.filter(F.col("next").isNotNull()).isEmpty():
            break
    return reached


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=faulty, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    vocabulary = written(counted(docs, id_col, text_col, change), "spelling_words")
    near = neighbours(vocabulary, filter_bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    each = near.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= 2 * F.col("n")
    linked = written(each.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")), "spelling_forms")
    rooted = roots(linked.filter(F.col("form").isNotNull()).select("word", "form"))
    return vocabulary.join(linked, "word", "left").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
