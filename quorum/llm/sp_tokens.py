"""SentencePiece BPE encoding and decoding by a merge-type prefix table (operator 4).

For every prefix of a text there is exactly one last token of its encoding.
The table of these last tokens is filled from left to right: an automaton over
the pieces gives the tokens that end at a position; the one that follows the
last token of the remaining prefix *compatibly* is entered (two tokens are
compatible when the merges of their joined text never cross their border).
The ids are then recovered backwards from the table's end.

Compatibility is tested on the tokens' merge histories alone and remembered.
Two neighbouring characters that no piece holds next to each other always lie
in different tokens, so a text is cut there, and the parts that words consist
of are encoded once per worker while a bounded cache holds them.

The model file is read where the job is planned and shipped with the tasks
(its size is the vocabulary's); pieces, scores and types are all that is taken
from it.  Characters outside the vocabulary become byte pieces.

Defined results: a null or empty text has only the begin and end ids and
decodes to an empty text; any length of text is encoded whole; an empty table
gives an empty result; other columns pass through.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Entries that a worker's caches of words and of their parts hold before they are emptied.
WORD_ENTRIES, PART_ENTRIES = 200_000, 350_000
#: Characters of the longest word that is held.
LONG = 64
#: Rows that go on at once.
SLICE_ROWS = 256


def _one_replacement_per_byte(e):
    return "�", e.start + 1


codecs.register_error("quorum_per_byte", _one_replacement_per_byte)


class _Cache(dict):
    """Computes what it lacks; emptied when full; long keys are not held."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONG:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value


class PieceModel:
    """Pieces and merge priorities of one sentencepiece BPE model."""

    def __init__(self, proto: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.control = {i for i in range(size) if sp.is_control(i)}
        self.unknown = {i for i in range(size) if sp.is_unknown(i)}
        byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("the model needs byte fallback")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        text = [i for i in range(size) if i not in self.control | self.unknown and not sp.is_byte(i)]
        self.rank = {self.pieces[i]: -sp.get_score(i) for i in text}
        self.id = {self.pieces[i]: i for i in text}
        self.pairs = {p[k : k + 2] for p in self.id for k in range(len(p) - 1)}
        if any(c not in self.id for p in self.id for c in p):
            raise ValueError("every character of a piece must be a piece")
        if any(p[1] == SPACE and p[0] != SPACE for p in self.pairs):
            raise ValueError("no piece may hold a space after another character")
        self.automaton = ahocorasick.Automaton()
        self.histories = {}
        for p, i in self.id.items():
            if (h := self._history(p)) is not None:
                self.histories[i] = h
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.pieces]
        self.packed = [struct.pack("<I", i) for i in range(size)]
        self.compatible: dict[int, bool] = {}
        self.parts, self.words = _Cache(self._encode_part, PART_ENTRIES), _Cache(self._encode_word, WORD_ENTRIES)
        self.raw = [b"" if i in self.control else " ⁇ ".encode() if i in self.unknown else self.pieces[i].replace(SPACE, " ").encode() for i in range(size)]
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([b])

    def _history(self, piece: str):
        """How merging makes the piece: its first and last symbols over time, as (rank, symbol); None if merging ends elsewhere."""
        symbols = list(piece)
        firsts, lasts = [(0.0, symbols[0])], [(0.0, symbols[-1])]
        while len(symbols) > 1:
            found = [(r, k) for k in range(len(symbols) - 1) if (r := self.rank.get(symbols[k] + symbols[k + 1])) is not None]
            if not found:
                return None
            r, k = min(found)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            if k == 0:
                firsts.append((r, symbols[0]))
            if k == len(symbols) - 1:
                lasts.append((r, symbols[-1]))
        return firsts, lasts

    def _test(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two tokens gives these two tokens."""
        lasts, firsts = self.histories[left][1], self.histories[right][0]
        i = j = 0
        while True:
            across = self.rank.get(lasts[i][1] + firsts[j][1])
            left_next = lasts[i + 1][0] if i + 1 < len(lasts) else None
            right_next = firsts[j + 1][0] if j + 1 < len(firsts) else None
            # Of equal ranks the leftmost goes first.
            if across is not None and (left_next is None or across < left_next) and (right_next is None or across <= right_next):
                return False
            if left_next is not None and (right_next is None or left_next <= right_next):
                i += 1
            elif right_next is not None:
                j += 1
            else:
                return True

    def _encode_part(self, part: str) -> bytes:
        if len(part) == 1:
            i = self.id.get(part)
            return self.packed[i] if i is not None else b"".join(self.packed[self.byte_ids[b]] for b in part.encode())
        size, compatible, test = len(self.pieces), self.compatible, self._test
        last: list[int | None] = [None] * (len(part) + 1)
        last[0] = -1
        for end, (token, length) in self.automaton.iter(part):
            end += 1
            if last[end] is None:
                before = last[end - length]
                if before is None:
                    continue
                if before >= 0:
                    fits = compatible.get(before * size + token)
                    if fits is None:
                        if len(compatible) >= PART_ENTRIES:
                            compatible.clear()
                        fits = compatible[before * size + token] = test(before, token)
                    if not fits:
                        continue
                last[end] = token
        ids, at, packed, lengths = [], len(part), self.packed, self.length
        while at:
            token = last[at]
            ids.append(packed[token])
            at -= lengths[token]
        ids.reverse()
        return b"".join(ids)

    def _encode_word(self, word: str) -> bytes:
        pairs, parts, start, out = self.pairs, self.parts, 0, []
        for k, pair in enumerate(map(add, word, word[1:]), 1):
            if pair not in pairs:
                out.append(parts[word[start:k]])
                start = k
        return b"".join([*out, parts[word[start:]]]) if out else parts[word]

    def encode(self, text: str | None) -> bytes:
        """The ids with begin and end, as little-endian unsigned 32-bit integers."""
        ends = np.array([self.bos, self.eos], "<u4").tobytes()
        if not text:
            return ends
        words = re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))
        return ends[:4] + b"".join(map(self.words.__getitem__, words)) + ends[4:]

    def decode(self, ids: bytes) -> str:
        """The library's decode(ids): byte pieces joined, one replacement character per bad byte, the first space dropped."""
        tokens = np.frombuffer(ids or b"", "<u4").tolist()
        inner = self.control.isdisjoint(tokens[1:-1])
        runs = [tokens] if inner else [list(run) for control, run in groupby(tokens, self.control.__contains__) if not control]
        text = "".join(b"".join(map(self.raw.__getitem__, run)).decode("utf-8", "quorum_per_byte") for run in runs)
        first = next((t for t in tokens if t not in self.control), None)
        return text[1:] if first is not None and self.pieces[first].startswith(SPACE) else text


@lru_cache(maxsize=2)
def piece_model(proto: bytes) -> PieceModel:
    """Once per worker process and model."""
    return PieceModel(proto)


def read_model(path: str) -> bytes:
    """The model file, read where the job is planned."""
    with open(path, "rb") as f:
        return f.read()


def _mapped(df: DataFrame, source: str, target: str, kind: T.DataType, arrow: pa.DataType, proto: bytes, method: str) -> DataFrame:
    schema = T.StructType([f for f in df.schema.fields if f.name != target] + [T.StructField(target, kind)])
    names = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = getattr(piece_model(proto), method)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                made = pa.array([apply(x) for x in b.column(source).to_pylist()], arrow)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), made], [*names, target])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, proto: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids (begin and end included) as little-endian unsigned 32-bit integers."""
    return _mapped(docs, text_col, ids_col, T.BinaryType(), pa.binary(), proto, "encode")


def decode(docs: DataFrame, proto: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text that the ids decode to (null ids: empty)."""
    return _mapped(docs, ids_col, text_col, T.StringType(), pa.string(), proto, "decode")
