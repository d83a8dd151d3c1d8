"""Routing and sheet-union scenarios (in the spirit of the reference's unit
tests), null semantics of lookups, overlay strictness and CSV null tokens."""

import pytest
from pyspark.sql import functions as F

from quorum.functions import schema as SCH
from quorum.operators import lookup, route
from quorum.sources import io as IO


def test_sheet_union_keeps_provenance(spark):
    a = spark.createDataFrame([("LABORATORIO", 1)], "CLASSIFICACAO string, v int")
    b = spark.createDataFrame([("HAPCLINICA", 2)], "CLASSIFICACAO string, v int")
    empty = spark.createDataFrame([], "CLASSIFICACAO string, v int")
    u = IO.union_sheets({"aba 1": a, "aba 2": b, "vazia": empty})
    got = sorted((r["CLASSIFICACAO"], r["__origem_aba"]) for r in u.collect())
    assert got == [("HAPCLINICA", "aba 2"), ("LABORATORIO", "aba 1")]
    with pytest.raises(ValueError):
        IO.union_sheets({"vazia": empty})


def test_route_two_sources_with_accented_header(spark):
    scored = spark.createDataFrame([("LABORATORIO",), ("HAPCLINICA",)], "CLASSIFICACAO string")
    negative = spark.createDataFrame([("TELEMEDICINA",), ("ODONTOLOGIA",)], "`CLASSIFICAÇÃO` string")
    col = SCH.resolve_column(negative, "CLASSIFICACAO")
    assert col == "CLASSIFICAÇÃO"
    negative = negative.withColumnRenamed(col, "CLASSIFICACAO")
    routed = route.route({"avaliacoes": scored, "negativas": negative})
    got = sorted((r["GRUPO"], r["ORIGEM"]) for r in routed.collect())
    assert got == [("diagnostico", "avaliacoes"), ("hapclinica", "avaliacoes"),
                   ("odontologia", "negativas"), ("teleconsulta", "negativas")]
    files = {r["GRUPO"]: (r["AVALIACOES"], r["NEGATIVAS"]) for r in route.per_file_counts(routed).collect()}
    assert files["diagnostico"] == (1, 0) and files["teleconsulta"] == (0, 1) and files["hospitalar"] == (0, 0)


def test_class_in_two_groups_is_an_error():
    with pytest.raises(ValueError):
        lookup.class_group_map({"g1": ["CASE"], "g2": ["case "]})


def test_contract_lookup_keep_first_and_null_key(spark):
    fact = spark.createDataFrame([(1, " Loja A"), (2, None), (3, "loja b")], "id int, LOCAL string")
    sheet = spark.createDataFrame([("LOJA A", "Rede Propria ", 2), ("loja a", "rede credenciada", 1),
                                   (None, "rede propria", 5)], "Local string, contratacao string, _ord long")
    got = {r["id"]: r["CONTRATACAO"] for r in lookup.contract(fact, sheet).collect()}
    assert got == {1: "rede credenciada", 2: "rede propria", 3: None}


def test_overlay_strict_ints_raise(spark):
    df = spark.createDataFrame([("1", "x"), (None, "y")], "TIPO string, LOCAL string")
    with pytest.raises(Exception):
        SCH.overlay(df, strict_ints=True).collect()
    assert [r["TIPO"] for r in SCH.overlay(df, strict_ints=False).collect()] == [1, None]


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("TIPO,LOCAL,NUM_BENEFICIARIO\n1,NA,12.0\n2,vazio,7\n3,,1.05\n", encoding="utf-8")
    df = IO.read_survey_csv(spark, str(p))
    rows = [(r["TIPO"], r["LOCAL"], r["NUM_BENEFICIARIO"]) for r in df.orderBy("TIPO").collect()]
    assert rows == [(1, None, "12"), (2, "vazio", "7"), (3, None, "1.05")]
    raw = IO.read_raw_text(spark, str(p)).orderBy("TIPO").collect()
    assert [r["LOCAL"] for r in raw] == ["NA", "vazio", ""]


def test_unit_result_hot_key_and_null_keys(spark):
    from quorum.operators import score
    rows = [("C", "L", None, 4.0)] * 30 + [("C", "L", None, 5.0)] * 10 + [(None, "L", "SP", 3.0)]
    df = spark.createDataFrame(rows, "CLASSIFICACAO string, `LOCAL EDITADO` string, UF string, `NOTA GERAL` double")
    got = {(r["CLASSIFICACAO"], r["UF"]): r["RESULTADO DA UNIDADE"] for r in score.unit_result(df).collect()}
    assert got == {("C", "CE"): 4.25, (None, "SP"): 3.0}


def test_text_functions(spark):
    from quorum.functions import text as tx
    df = spark.createDataFrame([("  Laboratório  Central ",)], "s string")
    r = df.select(tx.strip("s").alias("a"), tx.normalize("s").alias("b"), tx.fold_key("s").alias("c"),
                  tx.slug(F.col("s")).alias("d")).first()
    assert r["a"] == "Laboratório  Central"
    assert r["b"] == "Laboratório Central"
    assert r["c"] == "LABORATORIO CENTRAL"
    assert r["d"] == "laboratorio_central"
