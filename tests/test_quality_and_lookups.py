"""Violation reports, line numbers, lookups by place, unit inspection, reconciliation, on small tables."""

import pytest
from pyspark.sql import functions as F

from quorum.operators import lookup, quality, route, score, summary
from quorum.sources import io as IO


@pytest.fixture
def small_splits(spark):
    """Files are cut into splits of some hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_lines_over_several_splits(spark, small_splits, tmp_path):
    wanted = set()
    for name, rows in (("a", 400), ("b", 3), ("c", 57)):
        (tmp_path / "in" / name).mkdir(parents=True)
        lines = [f"{name}{k},{'x' * (k % 23)}" for k in range(rows)]
        (tmp_path / "in" / name / "part.csv").write_text("ID,LOCAL\n" + "".join(x + "\n" for x in lines))
        wanted |= {(f"{name}{k}", name, k + 2) for k in range(rows)}
    df = IO.read_raw_text(spark, str(tmp_path / "in"), line_numbers=True)
    assert df.columns == ["ID", "LOCAL", IO.FILE, IO.LINE] and df.rdd.getNumPartitions() > 5
    got = {(r.ID, r.ARQUIVO.split("/")[-2], r.LINHA) for r in df.collect()}
    assert got == wanted
    some = IO.read_survey_csv(spark, str(tmp_path / "in"), line_numbers=True).where("LOCAL is null").select("ID", IO.LINE)
    assert {(r.ID, r.LINHA) for r in some.collect()} == {(i, n) for i, _, n in wanted if (n - 2) % 23 == 0}


def test_first_violations_and_the_rest(spark):
    df = spark.range(100).select(F.col("id"), F.when(F.col("id") % 10 == 0, "1.0").otherwise("1").alias("n"), F.lit("z").alias("c"))
    found = quality.violations(df, ["id"], {
        "decimal": (F.col("n").endswith(".0"), F.col("n"), None), "wrong": (F.col("c") != "a", F.col("c"), F.lit("a")),
        "never": (F.col("c").isNull(), F.col("c"), None)})
    rows = quality.first_violations(found, [F.col("id")], 4).collect()
    shown = {(r.CHECAGEM, r.POSICAO, r.id, r.VALOR, r.ESPERADO) for r in rows if r.RESTANTES is None}
    assert shown == {("decimal", k + 1, 10 * k, "1.0", None) for k in range(4)} | {("wrong", k + 1, k, "z", "a") for k in range(4)}
    assert {(r.CHECAGEM, r.POSICAO, r.RESTANTES) for r in rows if r.RESTANTES is not None} == {("decimal", 5, 6), ("wrong", 5, 96)}
    assert quality.first_violations(found.where("false"), [F.col("id")]).count() == 0


def test_sheet_and_output_violations(spark):
    sheet = spark.createDataFrame([(2, "a", "x"), (3, "a", "y"), (4, "", "x"), (5, None, None), (6, "b", "x"), (7, "b", "x")], "n long, k string, v string")
    got = {(r.CHECAGEM, r.LINHA, r.CHAVE, r.VALOR) for r in quality.sheet_violations(sheet, F.col("n"), F.col("k"), F.col("v"), ["x"]).collect()}
    assert got == {("valor invalido", 3, "a", "y"), ("chave vazia", 4, "", "x"), ("chave vazia", 5, "", ""),
                   ("valores conflitantes", None, "a", "x"), ("valores conflitantes", None, "a", "y")}
    out = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "q", "x"), (4, None, "x")], "id int, k string, v string")
    dim = spark.createDataFrame([("a", "x"), ("d", "x")], "dk string, dv string")
    got = {(r.CHECAGEM, r.id, r.VALOR, r.ESPERADO) for r in quality.output_violations(out, dim, ["id"], F.col("k"), "v", "dk", "dv").collect()}
    assert got == {("divergente", 2, "", "x"), ("sem correspondencia", 3, "q", None), ("sem correspondencia", 4, None, None)}


def test_conflicts_are_rows(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", None), (None, "x"), (None, "z")], "k string, v string")
    assert {tuple(r) for r in summary.conflicts(df, "k", "v").collect()} == {("a", "x", 2), ("a", "y", 2), (None, "x", 2), (None, "z", 2)}


def test_places_equal_both_lookups(spark):
    fact = spark.createDataFrame([(1, " Loja A", "old"), (2, None, "old"), (3, "loja b", None), (4, "loja c", " old "), (5, "absent", None)],
                                 "id int, LOCAL string, `LOCAL EDITADO` string")
    contract = spark.createDataFrame([("LOJA A", "Rede Propria ", 2), ("loja a", "rede credenciada", 1), (None, "rede propria", 5), ("loja c", None, 6)],
                                     "Local string, contratacao string, _ord long")
    edited = spark.createDataFrame([("loja a", "", 1), ("Loja A", "A", 2), (None, "N", 3), ("loja b", " B ", 4), ("LOJA C", "C", 7)],
                                   "Local string, local_editado string, _ord long")
    two = lookup.edited_place(lookup.contract(fact, contract), edited, action=None)
    one = lookup.places(fact, contract, edited)
    assert sorted(map(tuple, one.select(*two.columns).collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_values_made_once_are_looked_up(spark):
    df = spark.createDataFrame([(1, "Telé"), (2, None), (3, "Telé"), (4, "")], "id int, c string")
    got = lookup.by_distinct(df, "c", n=F.upper, c=lambda v: F.coalesce(v, F.lit("none")))
    assert got.columns == ["id", "c", "n"]
    assert sorted(map(tuple, got.collect())) == [(1, "Telé", "TELÉ"), (2, "none", None), (3, "Telé", "TELÉ"), (4, "", "")]


def test_unit_inspection_takes_the_first_value_without_sorting(spark):
    rows = [("C", "L", "CE", 2, 4.0, None, None, 3.0), ("C", "L", "CE", 1, 5.0, None, "OP", 3.0), ("C", "L", "CE", 3, None, 4.5, "XX", 3.0),
            (None, "L", "CE", 4, 1.0, None, None, None)]
    df = spark.createDataFrame(rows, "CLASSIFICACAO string, `LOCAL EDITADO` string, UF string, o long, `NOTA GERAL` double, META double, "
                                     "OPERADORA string, `RESULTADO DA UNIDADE` double")
    out = score.unit_inspection(df, score.order_number({"o": 10}))
    got = {(r.CLASSIFICACAO, r.QUANTIDADE_LINHAS, r.NOTA_GERAL_MIN, r.NOTA_GERAL_MAX, r.RESULTADO_DA_UNIDADE, r.META, r.OPERADORA) for r in out.collect()}
    assert got == {("C", 3, 4.0, 5.0, 3.0, 4.5, "OP"), (None, 1, 1.0, 1.0, None, None, None)}
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception, match="more than 1 digits"):
        df.withColumn("o", F.lit(10)).select(score.order_number({"o": 1}).alias("x")).collect()


def test_reconciliation_finds_lost_and_doubled_rows(spark):
    routed = spark.createDataFrame([("a", "g1", 1), ("a", "g1", 2), ("a", None, 3), ("b", "g2", 4)], "ORIGEM string, GRUPO string, id int")
    sent = routed.where("GRUPO is not null and id <> 2").unionByName(routed.where("id = 4"))
    got = {r.ORIGEM: (r.TOTAL_ORIGEM, r.TOTAL_ENVIADO, r.TOTAL_NAO_ENVIADO, r.DIFERENCA, r.OK) for r in route.reconciliation(routed, sent).collect()}
    assert got == {"a": (3, 1, 1, 1, False), "b": (1, 2, 0, -1, False), "total": (4, 3, 1, 0, True)}
    assert {tuple(r) for r in route.delivery_differences(routed, sent).collect()} == {("g1", "a", 2, 1), ("g2", "b", 1, 2)}
    assert route.delivery_differences(routed, routed.where("GRUPO is not null")).count() == 0
