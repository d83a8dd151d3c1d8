import zlib

import numpy as np
import pytest

from quorum.llm import langid
from quorum.llm import queries as Q


def test_held_out_accuracy_on_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.op7_langid(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.97


def test_bundle_is_the_sum_of_bound_ngrams():
    text = "Ab, cab ab"
    symbols = langid._symbols(text)
    assert symbols.tolist() == [0, ord("a"), ord("b"), 0, ord("c"), ord("a"), ord("b"), 0, ord("a"), ord("b"), 0]
    total = np.zeros(langid.DIMENSIONS)
    for k in range(len(symbols) - 2):
        bound = np.ones(langid.DIMENSIONS)
        for place in range(3):
            bound *= np.roll(langid._vector(int(symbols[k + place])), 2 - place)
        total += bound
    vectors, has = langid.document_vectors([text, None, "12 .", "x"])
    assert has.tolist() == [True, False, False, True]
    assert np.allclose(vectors[0], total / np.linalg.norm(total), atol=1e-5)


def test_many_letters_use_the_same_vectors():
    rare = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 400))
    alone, _ = langid.document_vectors(["some words"])
    mixed, _ = langid.document_vectors(["some words", rare])
    assert np.allclose(alone[0], mixed[0], atol=1e-5)


def test_odd_rows(spark, odd, empty):
    languages, prototypes = langid.learn(odd)
    rows = langid.predict(odd, languages, prototypes).collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters or not languages)
        assert r.lang_pred != "und" or r.score == 0
    none, nothing = langid.learn(empty)
    assert none == [] and {r.lang_pred for r in langid.predict(odd, none, nothing).collect()} == {"und"}
    assert langid.predict(empty, languages, prototypes).count() == 0


@pytest.mark.parametrize("column", ["lang_pred", "score"])
def test_clashing_names_are_replaced(odd, column):
    df = odd.drop("score").withColumnRenamed("kept", column)
    assert langid.predict(df, ["en"], np.ones((1, langid.DIMENSIONS))).columns.count(column) == 1
