"""The pipeline against a version of its stages without Spark, and on odd tables."""

import re

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from quorum.llm import langid, pii
from quorum.llm.sp_tokens import read_model
from tests.llm.test_exact_dedup import GONE
from tests.llm.test_jaccard_join import brute
from tests.llm.test_packing import check

SF = "/root/testdata/sf0.001"


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_against_plain_python(spark):
    import tokenizers

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "PII", "packing"]

    told = stage["language ID"](spark, docs, SF)
    languages, prototypes = langid.learn(docs)
    middle = prototypes.mean(axis=0)
    kept = []
    for r in docs.collect():
        v, has = langid.document_vectors([r.text])
        away, p = v[0] - middle, prototypes - middle
        best = max(away @ x / np.linalg.norm(away) / np.linalg.norm(x) for x in p)
        if has[0] and (1 + best) / 2 >= corpus_pipeline.LEAST_LANGUAGE_SCORE:
            kept.append(tuple(r))
    assert as_rows(told) == sorted(kept, key=str)

    unique = stage["exact dedup"](spark, told, SF)
    best = {}
    for r in kept:
        best.setdefault((r[1] or "").translate(GONE), []).append((-len(r[1] or ""), r[0], r))
    kept = [min(v)[2] for v in best.values()]
    assert as_rows(unique) == sorted(kept, key=str)

    near = stage["n-gram Jaccard join"](spark, unique, SF)
    component = {i: c for i, _, c in brute([(r[0], r[1]) for r in kept], 5, 80)}
    kept = [r for r in kept if component[r[0]] == r[0]]
    assert as_rows(near) == sorted(kept, key=str)

    private = stage["PII"](spark, near, SF)
    assert private.columns == docs.columns
    after = {r.doc_id: r for r in private.collect()}
    assert set(after) == {r[0] for r in kept}
    mails = {m for r in kept for m in re.findall(r"[\w.]+@[\w.]+\.com", r[1])}
    assert mails and not any(m in r.text for r in after.values() for m in mails)
    assert all(after[r[0]].text == r[1] for r in kept if not re.search("[0-9@]", r[1]))

    packed = stage["packing"](spark, private, SF)
    tokenizer = tokenizers.Tokenizer.from_str(read_model(public_tokenizers.path("byte_bpe_50k.json")).decode())
    tokenizer.encode_special_tokens = True
    check(packed.collect(), [(r.doc_id, r.text) for r in after.values()], tokenizer, 1024)


def test_run_keeps_the_contract(spark):
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_on_odd_tables(spark, odd, empty, which):
    docs = odd if which == "odd" else empty
    for name, stage in corpus_pipeline.STAGES:
        docs, columns = stage(spark, docs, SF), docs.columns
        if name != "packing":
            assert docs.columns == columns, name
        docs.collect()


def test_pseudonyms_use_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = pii.pseudonymised(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
