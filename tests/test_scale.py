"""Lookups that move no survey rows, units and classes read once, and cheap tests that find what the searches find."""

import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from quorum.functions import text as tx
from quorum.functions.predicates import plain_words, regex_contains
from quorum.operators import lookup, operator_rules, score


@contextmanager
def setting(spark, key, value):
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fact(spark):
    rows = [(1, " Loja A", "MG"), (2, None, "MG"), (3, "loja b", None), (4, "LOJA A", "SP")]
    return spark.createDataFrame(rows, "id int, LOCAL string, UF string")


@pytest.fixture
def sheet(spark):
    rows = [("loja a", "rede propria", "Casa", 2), ("LOJA A", "Rede Credenciada ", "Casa A", 1), (None, "rede propria", "x", 3)]
    return spark.createDataFrame(rows, "Local string, contratacao string, local_editado string, _ord long")


LOOKUPS = {
    "contract": lambda f, s: lookup.contract(f, s),
    "edited": lambda f, s: lookup.edited_place(f, s),
    "places": lambda f, s: lookup.places(f, s, s),
    "target": lambda f, s: lookup.target(f, s.selectExpr("Local grupo", "1.5D meta", "_ord"), cls="LOCAL"),
    "values": lambda f, s: lookup.by_distinct(f, "LOCAL", alto=F.upper),
    "units": lambda f, s: score.unit_result(f.selectExpr("id", "LOCAL", "UF", "1.0D nota"), ["LOCAL", "UF"], "nota"),
    "unit_map": lambda f, s: operator_rules.with_unit_map(f.withColumnRenamed("LOCAL", "LOCAL EDITADO"), s.selectExpr("Local UNIDADE", "contratacao OPERA", "_ord")),
}


@pytest.mark.parametrize("name", LOOKUPS)
def test_lookup_moves_no_rows(spark, fact, sheet, name):
    """The planner's threshold is below any size, so only the written sheet's size lets it broadcast."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "BroadcastHashJoin" in plan(LOOKUPS[name](fact, sheet))


@pytest.mark.parametrize("name", LOOKUPS)
def test_large_sheet_is_the_planners(spark, fact, sheet, name, monkeypatch):
    small = sorted(map(str, LOOKUPS[name](fact, sheet).collect()))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        df = LOOKUPS[name](fact, sheet)
        assert "BroadcastHashJoin" not in plan(df)
        assert sorted(map(str, df.collect())) == small


def test_unit_inspection_moves_no_rows(spark):
    rows = [("A", "x", "MG", 1.0, 2.0, None, "P", 2), ("A", "x", "MG", 3.0, None, 4.0, None, 1), ("A", "x", "MG", 2.0, 5.0, 6.0, "Q", 3),
            (None, None, None, None, None, None, None, 4)]
    df = spark.createDataFrame(rows, "CLASSIFICACAO string, `LOCAL EDITADO` string, UF string, `NOTA GERAL` double, "
                                     "`RESULTADO DA UNIDADE` double, META double, OPERADORA string, n long")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        out = score.unit_inspection(df, score.order_number({"n": 5}))
        assert "SortMergeJoin" not in plan(out)
        got = {r["CLASSIFICACAO"]: tuple(r)[3:] for r in out.collect()}
    assert got == {"A": (3, 1.0, 3.0, 2.0, 4.0, "P"), None: (1, None, None, None, None, None)} and out.count() == 2


def test_plain_words_find_what_the_search_finds(spark):
    assert plain_words("case|TEA") == ["case", "tea"]
    assert plain_words("prod. coord") == plain_words("a|") == plain_words(r"\bnb\b") == []
    chars = spark.createDataFrame([(chr(i),) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000], "c string")
    letters = "abcdefghijklmnopqrstuvwxyz0123456789 _-"
    wrong = [regex_contains("c", x) != F.coalesce(F.col("c").rlike("(?iu)" + x), F.lit(False)) for x in letters]
    assert chars.where(F.greatest(*[w.cast("int") for w in wrong]) == 1).count() == 0
    texts = spark.createDataFrame([("Sinta-ſE bem",), ("teleKon",), ("İNB",), (None,), ("",), ("TELEMÉDICA",)], "c string")
    for p in ("sinta-se|viver bem", "telekon", "inb", "telem", "TELEM|nb"):
        assert texts.where(regex_contains("c", p) != F.coalesce(F.col("c").rlike("(?iu)" + p), F.lit(False))).count() == 0
    assert "RLIKE" not in plan(texts.where(regex_contains("c", "case|tea")))


def test_normalize_leaves_only_normal_texts(spark):
    texts = ["", " ", "a", "a b", "a  b", " a", "a ", "a b", "ça É", "a\tb", "a\n", "\x1ca", "a\u0085", "a b", "a　", "中 文", "中  文", "a\x00b", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string").select("c", tx.normalize("c").alias("n"))
    for r in df.collect():
        assert r["n"] == (None if r["c"] is None else " ".join(r["c"].split()))


def test_wide_tables_are_written_once(spark, sf):
    from quorum.queries import QUERIES
    QUERIES["pl3_route_class_counts"](spark, sf)
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    names = {n.rsplit("-", 1)[0] for n in os.listdir(f"{base}/quorum-steps")}
    assert {"before_unit", "negativas"} <= names and not {"routed", "avaliacoes"} & names


def test_lines_are_not_shuffled_by_customer(spark, sf):
    from quorum import survey
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        text = survey.survey(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    at = [line for line in text.splitlines() if "Join Inner" in line]
    assert any("c_custkey" in line for line in at)
    depth = {k: next(len(line) - len(line.lstrip(" :+-")) for line in at if k in line.split("Inner")[1]) for k in ("c_custkey", "l_orderkey")}
    assert depth["c_custkey"] > depth["l_orderkey"]


def test_operator_totals_are_made_before_rows_are_multiplied(spark):
    from quorum.operators import summary
    rows = [("PROMED", 1.0), (" PROMED", 2.0), ("HAPVIDA", 4.0), ("CCG", 3.0), ("nan", 5.0), (None, 5.0), ("CCG", None)]
    out = summary.operator_summary(spark.createDataFrame(rows, "OPERADORA string, `NOTA GERAL` double"))
    lines = plan(out).splitlines()
    below = next(k for k, line in enumerate(lines) if "Generate" in line)
    assert any("HashAggregate" in line for line in lines[below:])
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == {"PROMED": (2, 1.5), "HAPVIDA": (1, 4.0), "CCG": (1, 3.0), "PROMED + HAPVIDA": (3, 2.33)}


def test_fold_adds_no_projections(spark, fact):
    """A nullif in the fold puts a projection of its own, with every column, below the one that reads it."""
    from quorum.operators import rules
    steps = [rules.Step(F.col("UF") == uf, F.lit(value), fill) for uf, value, fill in
             (("MG", "a", False), ("SP", "b", True), ("MG", "c", True), ("SP", "d", False))]
    df, fold = rules.fold_frame(fact.withColumn("s", F.when(F.col("id") == 1, "x")), steps, F.col("s"))
    out = df.withColumn("s", fold.final())
    assert "_common_expr" not in plan(out)
    assert {r["id"]: r["s"] for r in out.collect()} == {1: "a", 2: "a", 3: None, 4: "d"}


def test_fold_equals_the_steps_one_by_one(spark):
    from itertools import product
    from quorum.operators import rules
    rows = [(a, b, c, s) for a, b, c in product((True, False), repeat=3) for s in (None, "", "x")]
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean, s string")
    for fills in product((True, False), repeat=3):
        steps = [rules.Step(F.col(m), F.lit(m.upper()), f) for m, f in zip("abc", fills, strict=True)]
        folded, fold = rules.fold_frame(df, steps, F.col("s"))
        for r in folded.select("a", "b", "c", "s", fold.final().alias("out"), fold.applied_array().alias("k")).collect():
            state, applied = r["s"], []
            for k, (m, f) in enumerate(zip("abc", fills, strict=True), start=1):
                if r[m] and (not f or not state):
                    state, applied = m.upper(), [*applied, k]
            assert (r["out"], r["k"]) == (state, applied), (fills, r)


def test_sheets_are_reduced_by_many_tasks(spark, sf):
    from quorum import survey
    for sheet in (survey.contract_sheet, survey.edited_sheet, survey.unit_sheet):
        assert "REPARTITION_BY_COL" in plan(sheet(spark, sf))


def test_small_sheets_need_no_key_column(spark, fact, sheet):
    assert "__fk" not in plan(lookup.contract(fact, sheet)) and "__fk" not in plan(lookup.edited_place(fact, sheet))


def test_operators_are_normalised_when_rules_read_the_state_or_not(spark):
    df = spark.createDataFrame([(1, "MG", "casa"), (2, "SP", None), (3, "RS", " pa  contorno")], "id int, UF string, `LOCAL EDITADO` string")
    df = df.selectExpr("*", "string(null) CLASSIFICACAO", "string(null) CONTRATACAO", "string(null) ESPECIALIDADE")
    units = spark.createDataFrame([("Casa", " ndi  sp", 1)], "UNIDADE string, OPERA string, _ord long")
    one = [{"descricao": "r", "valor_operadora": " ccg  b", "filtros": [{"coluna": "UF", "tipo_filtro": "igual", "valor_filtro": "SP"}]}]
    two = [*one, {"descricao": "s", "valor_operadora": "x", "filtros": [{"coluna": "OPERADORA", "tipo_filtro": "igual", "valor_filtro": " ccg  b"}]}]
    for rules, second in ((one, "CCG B"), (two, "X")):
        out = operator_rules.assign_operator(df, units, rules)
        assert {r["id"]: r["OPERADORA"] for r in out.collect()} == {1: "NDI SP", 2: second, 3: "NDI MG"}
