"""Quality classifier: a byte-level convolutional network in numpy (operator 5).

Learned filters slide over every byte of a text, read in overlapping chunks
(each chunk repeats the last bytes of the one before, so no window is lost).
Each filter's largest response over the whole document goes through a
rectifier, and the pooled responses are combined into one probability.

A filter's response is a sum of table look-ups (one row per byte value and
place), so neither scoring nor learning needs one-hot vectors; the gradient
reaches only the windows that won the pooling.

Learning uses at most ``PER_LABEL`` labelled documents of each label, of at
most ``LEARN_BYTES`` bytes, chosen by the order of a hash of their id; weights
restore the labels' shares, so the score is a probability.  Scoring reads whole
texts of any length.

Defined results: a null or empty text is scored like a text of padding alone;
a null label is not learned, repeated labels of a document count as the
smallest; without labels of both kinds every score is their share (0.5 without
any); an empty table gives an empty result; other columns pass through, but for
one named score, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import appended, held_out

WIDTH = 8
FILTERS = 8
CHUNK = 1 << 16
#: Learning takes at most so many documents of each label, of at most so many bytes.
PER_LABEL = 1000
LEARN_BYTES = 60_000
EPOCHS = 12
BATCH = 32
RATE = 0.02
SLICE_ROWS = 256


@dataclass
class Network:
    tables: np.ndarray  # place, byte value, filter
    bias: np.ndarray
    out: np.ndarray
    constant: float

    def pooled(self, texts: list[bytes], places: bool = False):
        """Each text's largest response to each filter, and where it starts in its padded bytes."""
        top = np.full((len(texts), self.tables.shape[2]), -np.inf, np.float32)
        where = np.zeros(top.shape, np.int64)
        pad = bytes(WIDTH - 1)
        batch: list[tuple[int, int, np.ndarray]] = []
        size = 0

        def flush():
            nonlocal size
            data = np.concatenate([c for _, _, c in batch])
            windows = len(data) - WIDTH + 1
            response = self.tables[0].take(data[:windows], axis=0)
            for j in range(1, WIDTH):
                response += self.tables[j].take(data[j : j + windows], axis=0)
            start = 0
            for i, offset, c in batch:
                part = response[start : start + len(c) - WIDTH + 1]
                if places:
                    at = part.argmax(axis=0)
                    best = part[at, np.arange(part.shape[1])]
                    where[i] = np.where(best > top[i], at + offset, where[i])
                else:
                    best = part.max(axis=0)
                np.maximum(top[i], best, out=top[i])
                start += len(c)
            batch.clear()
            size = 0

        for i, text in enumerate(texts):
            data = np.frombuffer(pad + text + pad, np.uint8)
            for offset in range(0, len(data) - WIDTH + 1, CHUNK):
                chunk = data[offset : offset + CHUNK + WIDTH - 1]
                batch.append((i, offset, chunk))
                size += len(chunk)
                if size >= CHUNK:
                    flush()
        if batch:
            flush()
        return (top, where) if places else top

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = np.maximum(self.pooled(texts) + self.bias, 0) @ self.out + self.constant
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def learn(texts: list[bytes], labels: list[int], share: float, seed: int = 7) -> Network:
    """Fit the network with Adam; ``share`` is label 1's share among all labelled documents."""
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.choice([-0.5, 0.5], FILTERS).astype(np.float32), 0.0)
    y = np.array(labels, np.float64)
    ones = int(y.sum()) if len(y) else 0
    if not 0 < ones < len(y):
        p = min(max(share, 1e-6), 1 - 1e-6)
        net.out[:], net.constant = 0, float(np.log(p / (1 - p)))
        return net
    weight = np.where(y == 1, share * len(y) / ones, (1 - share) * len(y) / (len(y) - ones))
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("tables", net.tables), ("bias", net.bias), ("out", net.out), ("constant", np.zeros(1)))}
    step, padded = 0, [bytes(WIDTH - 1) + t + bytes(WIDTH - 1) for t in texts]

    def moved(name: str, g: np.ndarray) -> np.ndarray:
        m, v = state[name]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        return rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            top, where = net.pooled([texts[i] for i in rows], places=True)
            z = np.maximum(top + net.bias, 0)
            p = 1 / (1 + np.exp(-np.clip(z @ net.out + net.constant, -40, 40)))
            d = weight[rows] * (p - y[rows]) / len(rows)
            pooled = d[:, None] * net.out * (top + net.bias > 0)
            g = np.zeros_like(net.tables)
            for r, i in enumerate(rows):
                for f in np.flatnonzero(pooled[r]):
                    window = np.frombuffer(padded[i], np.uint8, WIDTH, int(where[r, f]))
                    g[np.arange(WIDTH), window, f] += pooled[r, f]
            net.constant -= float(moved("constant", np.array([d.sum()]))[0])
            net.out -= moved("out", (d @ z).astype(np.float32))
            net.bias -= moved("bias", pooled.sum(axis=0).astype(np.float32))
            net.tables -= moved("tables", g)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", per_label: int = PER_LABEL) -> Network:
    """Learn from a bounded sample of labelled documents that aren't held out."""
    known = (labels.filter(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ids = known.filter("false")
    for label in (0, 1):
        ids = ids.unionByName(known.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_label))
    # Bounded by the documented number of each label.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    sample = (texts.filter(F.octet_length("text") <= LEARN_BYTES).join(F.broadcast(ids), "id")
              .select("id", "label", "text").dropDuplicates(["id"]).limit(2 * per_label))
    rows = sorted(sample.collect(), key=lambda r: r["id"])
    total = sum(counts.values())
    return learn([bytes(r["text"]) for r in rows], [r["label"] for r in rows], counts.get(1, 0) / total if total else 0.5)


def scored(docs: DataFrame, net: Network, text_col="text") -> DataFrame:
    """``docs`` with score, the probability of label 1."""
    names, ddl = appended(docs, score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                b = whole.slice(at, SLICE_ROWS)
                texts = [t or b"" for t in b.column(text_col).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(net.score(texts), pa.float64())], [*names, "score"])

    return docs.mapInArrow(run, ddl)
