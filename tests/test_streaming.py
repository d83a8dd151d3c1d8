"""The row-local steps on a file stream equal the batch steps."""

import os

from quorum import survey as S
from quorum.streaming import monthly_files as MF
from quorum.operators import clean, lookup, rules, score


def test_stream_equals_batch(spark, sf, tmp_path):
    sv = S.survey(spark, sf).drop("l_returnflag")
    src = str(tmp_path / "in")
    sv.where("l_orderkey % 2 = 0").write.parquet(os.path.join(src, "m1"))
    sv.where("l_orderkey % 2 = 1").write.parquet(os.path.join(src, "m2"))
    cs, es = S.contract_sheet(spark, sf), S.edited_sheet(spark, sf)
    q = MF.start(spark, src + "/*", sv.schema, cs, es, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = lookup.edited_place(rules.classify(score.row_score(lookup.contract(clean.clean_scored(sv), cs))),
                                es, action=None)
    cols = list(S.KEY_COLUMNS) + ["CONTRATACAO", "CLASSIFICACAO", "LOCAL EDITADO", "NOTA GERAL"]
    a = sorted(tuple(r) for r in got.select(*[f"`{c}`" for c in cols]).collect())
    b = sorted(tuple(r) for r in batch.select(*[f"`{c}`" for c in cols]).collect())
    assert a == b and len(a) > 0
