"""Language identification with hyperdimensional profiles (operator 7).

Every letter has a fixed random vector of +1 and -1 (made from its code point,
so every worker has the same).  A letter n-gram binds its letters' vectors,
each rotated by its place, by multiplication; runs of other characters count as
one boundary symbol.  A document bundles the vectors of all its n-grams by
addition, a language bundles its documents, and a document gets the language
whose prototype has the largest cosine with it, after the mean of all
prototypes is taken from both.

Prototypes are learned from at most ``PER_LANGUAGE`` documents of a language,
chosen by the order of a hash of their id; prediction reads whole texts.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when nothing could be learned; a null language is never learned; ties go to
the language that sorts first; an empty table gives an empty result; other
columns pass through, but for those named lang_pred or score, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quorum.llm.common import appended, held_out

DIMENSIONS = 1024
GRAM = 3
#: Learning takes at most so many documents of a language.
PER_LANGUAGE = 500
SLICE_ROWS = 128
SLICE_CHARS = 600_000
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=100_000)
def _vector(code: int) -> np.ndarray:
    """The letter's random vector of +1 and -1; code 0 is the boundary."""
    bits = np.frombuffer(hashlib.shake_128(b"letter %d" % code).digest(DIMENSIONS // 8), np.uint8)
    return (np.unpackbits(bits).astype(np.int8) * 2 - 1)


def _symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; each run of other characters is one 0."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(_letters()[codes], codes, 0)
    return codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))]


def _bundle(symbols: list[np.ndarray]) -> np.ndarray:
    """The document vectors of some documents' symbols, one row each."""
    every = np.concatenate(symbols)
    alphabet, index = np.unique(every, return_inverse=True)
    size = len(alphabet)
    starts = np.cumsum([0, *map(len, symbols)])
    grams = np.zeros(max(0, len(every) - GRAM + 1), np.int64)
    for place in range(GRAM):
        grams = grams * size + index[place : place + len(grams)]
    doc = np.repeat(np.arange(len(symbols)), np.diff(starts))[: len(grams)]
    inside = np.arange(len(grams)) + GRAM <= starts[doc + 1]
    grams, doc = grams[inside], doc[inside]
    if size**GRAM <= 1 << 22:
        seen = np.zeros(size**GRAM, np.int32)
        seen[grams] = 1
        kinds = np.flatnonzero(seen)
        seen[kinds] = np.arange(len(kinds))
        column = seen[grams]
    else:
        kinds, column = np.unique(grams, return_inverse=True)
    counts = np.bincount(doc * len(kinds) + column, minlength=len(symbols) * len(kinds)).reshape(len(symbols), len(kinds))
    letters = np.stack([_vector(int(c)) for c in alphabet])
    bound = np.ones((len(kinds), DIMENSIONS), np.int8)
    for place in range(GRAM):
        at = kinds // size ** (GRAM - 1 - place) % size
        bound *= np.roll(letters, GRAM - 1 - place, axis=1)[at]
    return counts.astype(np.float32) @ bound.astype(np.float32)


def document_vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts, and which of them have a letter (the others' rows are zero)."""
    symbols = [_symbols(t) if t else np.zeros(0, np.uint32) for t in texts]
    has = np.array([bool(s.any()) for s in symbols], bool)
    out, held, chars = np.zeros((len(texts), DIMENSIONS), np.float32), [], 0
    for i in [*np.flatnonzero(has), -1]:
        if held and (i < 0 or chars + len(symbols[i]) > SLICE_CHARS):
            out[held] = _bundle([symbols[j] for j in held])
            held, chars = [], 0
        if i >= 0:
            held.append(i)
            chars += len(symbols[i])
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms == 0, 1, norms), has


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from documents that aren't held out."""
    # Own names, so that other columns can have any.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    can = rows.filter(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = can.select("id", "lang").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language).select("id").distinct()
    # Bounded by the documented number per language.
    sample = can.join(F.broadcast(chosen), "id", "left_semi").select("lang", "text")

    def bundle(t: pa.Table) -> pa.Table:
        texts, total = t.column("text").to_pylist(), np.zeros(DIMENSIONS)
        for at in range(0, len(texts), SLICE_ROWS):
            total += document_vectors(texts[at : at + SLICE_ROWS])[0].sum(axis=0, dtype=np.float64)
        return pa.table({"lang": [t.column("lang")[0].as_py()], "vector": pa.array([total.tolist()], pa.list_(pa.float64()))})

    sums = sorted(sample.groupBy("lang").applyInArrow(bundle, "lang string, vector array<double>").collect())
    sums = [r for r in sums if any(r.vector)]
    prototypes = np.array([r.vector for r in sums]).reshape(len(sums), DIMENSIONS)
    return [r.lang for r in sums], prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray, text_col="text") -> DataFrame:
    """``docs`` with lang_pred and score ((1 + cosine) / 2) for every row."""
    middle = prototypes.mean(axis=0) if len(languages) > 1 else np.zeros(DIMENSIONS)
    away = prototypes - middle
    away = (away / np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    names, ddl = appended(docs, lang_pred="string", score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                if languages:
                    vectors, has = document_vectors(b.column(text_col).to_pylist())
                    vectors -= middle.astype(np.float32)
                    cosines = vectors @ away.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                    best = cosines.argmax(axis=1)
                    found = [languages[i] if h else UNDETERMINED for i, h in zip(best, has)]
                    scores = np.where(has, np.clip((1 + cosines.max(axis=1)) / 2, 0, 1), 0.0)
                else:
                    found, scores = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(n) for n in names), pa.array(found, pa.string()), pa.array(scores, pa.float64())], [*names, "lang_pred", "score"])

    return docs.mapInArrow(run, ddl)
