import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quorum.llm import packing, token_files
from quorum.llm.sp_tokens import read_model


@pytest.fixture(scope="module")
def spec():
    return read_model(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 40), min_size=1, max_size=90), min_size=1, max_size=12),
       st.integers(0, 100), st.sampled_from([8, 64, 1024]))
def test_file_round_trip(docs, percentile, block):
    writer = token_files.Writer(3, 70, block, percentile)
    for k, ids in enumerate(docs):
        writer.add(k or None, np.array(ids, np.uint32))
    content, flat = writer.content() + b"\n", [x for ids in docs for x in ids]
    file = token_files.Reader(content)
    assert (file.part, file.first, file.ids) == (3, 70, len(flat))
    assert file.known.tolist() == [0] + [1] * (len(docs) - 1) and file.lengths.tolist() == [len(d) for d in docs]
    for a, b in [(0, len(flat)), (len(flat) // 3, len(flat) // 2), (len(flat) - 1, len(flat)), (0, 0)]:
        assert token_files.ids_between(content, a, b).tolist() == flat[a:b]


def test_outliers_go_to_the_exception_list():
    ids = np.full((1, 1024), 7, np.uint32)
    ids[0, 5], ids[0, 900] = 2**32 - 1, 600
    base, width, (block, position, high), payload = token_files.packed(ids)
    assert base.tolist() == [7] and width.tolist() == [0] and payload == [b""]
    assert position.tolist() == [5, 900] and high.tolist() == [2**32 - 8, 593]


def expected(rows, bpe, end=2):
    """(doc_id, start, n_tokens, ids_crc32) by ascending id, by the tokenizers library alone."""
    out, at = [], 0
    for doc, text in rows:
        ids = np.array([*(bpe.slow.encode(text, add_special_tokens=False).ids if text else []), end], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark, spec):
    from quorum.llm import queries
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = queries.op11_token_files(spark, sf).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows, packing.byte_bpe(spec))


def test_odd_rows_and_many_files(spark, spec, odd, tmp_path):
    path = f"file://{tmp_path}/files"
    got = token_files.round_trip(odd.repartition(5), spec, path, block=16, file_ids=8).orderBy("start").collect()
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    bpe = packing.byte_bpe(spec)
    given_rows = sorted((r["doc_id"] is not None, r["doc_id"] or 0, *expected([(0, r["text"])], bpe)[0][2:]) for r in odd.collect())
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == given_rows
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1].tolist()
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    assert files.count() > 5
    read = {r["doc_id"]: r["ids"] for r in token_files.read(spark, path).collect()}
    assert np.frombuffer(read[8], "<u4").tolist() == [*bpe.ids("one"), 2] and read[4] == read[5] == np.uint32(2).tobytes()


def test_empty(spark, spec, empty):
    assert token_files.round_trip(empty, spec).count() == 0


def test_ids_are_equal_on_both_sides_of_the_long_text_switch(spec, monkeypatch):
    """Both libraries give the same ids just under and over the length from which the other one is taken."""
    bpe = packing.byte_bpe(spec)
    text = ("Ünïcödé words, don't   split\n\nwrong 12345 " * 6000)[: packing.LONG_CHARS]
    under, over = bpe.ids(text), bpe.ids(text + "!")
    assert under == bpe.slow.encode(text, add_special_tokens=False).ids
    assert over == bpe.fast.encode_ordinary(text + "!")
