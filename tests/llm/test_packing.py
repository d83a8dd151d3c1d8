import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from quorum.llm import packing
from quorum.llm.sp_tokens import read_model

SPEC = read_model(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    t = tokenizers.Tokenizer.from_str(SPEC.decode())
    t.encode_special_tokens = True
    return t


def check(rows, docs, tokenizer, window):
    ids_of = defaultdict(list)
    for i, t in docs:
        ids_of[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    assert {i for i, _ in pieces} == set(ids_of)
    for i, lists in ids_of.items():
        if len(lists) > 1:
            assert sum(r.length for (d, _), v in pieces.items() if d == i for r in v) == sum(map(len, lists))
            continue
        at = 0
        for r in sorted(pieces[i, len(lists[0])], key=lambda r: r.start):
            assert r.start == at
            part = np.array(lists[0][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(lists[0])
    for v in sequences.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("window", [8, 64, 1024])
def test_pieces_cover_every_document_without_padding(spark, odd, tokenizer, window):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    check(packing.pack(odd, SPEC, window=window).collect(), docs, tokenizer, window)


def test_real_documents_and_sequences(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    rows = packing.pack(docs, SPEC, with_ids=True).collect()
    sequences = check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, 1024)
    joined = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    for r in packing.sequences(joined).collect():
        assert len(r.ids) == 4 * sum(p.length for p in sequences[r.sequence_id])


def test_one_common_length(spark, tokenizer):
    docs = [(i, "same words here") for i in range(50)] + [(100 + i, "x") for i in range(7)]
    check(packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), SPEC, window=16).collect(), docs, tokenizer, 16)


def test_plan_uses_no_more_than_there_is():
    rng = np.random.default_rng(3)
    for window in (16, 64):
        h = rng.integers(0, 30, window)
        h[0] = 0
        slots, used, count = packing.plan(h)
        assert (used <= h).all()
        filled = defaultdict(int)
        for n, a, b, s, o in slots:
            for k in range(b - a):
                filled[s + k] += n
        assert len(filled) == count and all(v == window or v & (v - 1) == 0 for v in filled.values())


def test_empty_table(empty):
    assert packing.pack(empty, SPEC).count() == 0
