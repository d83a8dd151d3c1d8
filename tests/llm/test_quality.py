import zlib

import numpy as np

from quorum.llm import quality
from quorum.llm import queries as Q


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = Q.op5_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    y, p = np.array([label[r.doc_id] for r in held]), np.array([r.predicted for r in held])
    assert np.mean(y == p) >= 0.97
    assert np.mean(p[y == 1] == 1) >= 0.98


def test_pooling_covers_every_byte(monkeypatch):
    """One network response for a text, whatever the chunks."""
    rng = np.random.default_rng(0)
    net = quality.Network(rng.normal(size=(quality.WIDTH, 256, 4)).astype(np.float32), np.zeros(4, np.float32), np.ones(4, np.float32), 0.0)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (0, 1, 7, 8, 9, 63, 64, 65, 500)]
    brute = []
    for t in texts:
        padded = bytes(quality.WIDTH - 1) + t + bytes(quality.WIDTH - 1)
        brute.append([max(sum(net.tables[j, padded[k + j], f] for j in range(quality.WIDTH)) for k in range(len(padded) - quality.WIDTH + 1)) for f in range(4)])
    for chunk in (16, 64, 1 << 16):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        assert np.allclose(net.pooled(texts), brute, atol=1e-4)
        top, where = net.pooled(texts, places=True)
        assert np.allclose(top, brute, atol=1e-4)
        for t, row, at in zip(texts, top, where):
            padded = bytes(quality.WIDTH - 1) + t + bytes(quality.WIDTH - 1)
            for f in range(4):
                assert np.isclose(sum(net.tables[j, padded[at[f] + j], f] for j in range(quality.WIDTH)), row[f], atol=1e-4)


def test_odd_rows_and_labels(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1), (4, 0), (7, 1), (None, 1)], "doc_id long, quality int")
    net = quality.fit(odd, labels)
    rows = quality.scored(odd, net).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    one = quality.fit(odd, labels.filter("quality = 1"))
    assert len({round(r.score, 9) for r in quality.scored(odd, one).collect()}) == 1
    none = quality.fit(empty, labels.filter("false"))
    assert {r.score for r in quality.scored(odd, none).collect()} == {0.5}
    assert quality.scored(empty, none).count() == 0
