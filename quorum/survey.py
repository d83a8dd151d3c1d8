"""The ``survey`` fixture view over the driver's TPC-H-like tables.

The driver tables carry no survey, so a survey table and its lookup sheets
are *derived* from them with plain SQL expressions.  The same expression
text is used by the Spark side (``selectExpr``) and by the DuckDB oracle, so
queries and oracles start from identical inputs; everything downstream
(the operators under test) is written independently on each side.

Base: lineitem ⋈ (orders ⋈ customer ⋈ nation) ⋈ part.  At scale the joins on order, customer and
part are sort-merge joins on their keys; the planner broadcasts what is small.  Customers are
joined to the orders, so that lines are not shuffled by customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quorum.session import limit_methods

# Row identity and order: (l_orderkey, l_linenumber, l_partkey, l_suppkey).
KEY_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
ORDER_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _case(number: str, values, otherwise: str) -> str:
    return f"case {number} " + " ".join(f"when {k} then {v}" for k, v in enumerate(values)) + f" else {otherwise} end"


# Words that the class rules look for in places and specialities, and the operator rules in edited places.
PLACE_WORDS = ("qualivida", "Sinta-se bem", "TELEMED", "nosso medico", "Case", "TEA", "gestar bem", "octaviano neves", "Venda Nova",
               "PROCLIN ELDORADO", "hvc day", "hospital vera cruz", "Betim", "raja", "efigencia", "life a", "life b", "contorno")
EDITED_WORDS = {15: "'LIFE CENTER CONTAGEM'", 16: "concat('Hospital ', chr(160), 'Life Center')", 17: "' pa contorno'"}
SPECIALITY_WORDS = ("viver bem", "NB", "alto risco", "case", "TRANSPLANTE", "gestar bem", "MEDPREV", "odontologia", "pgc")
STATES = ("'MG'", "'mg '", "'PR'", "'RS'", "'SP'", "'RJ'", "'CE'", "'BA'", "'PE'", "'MG'")
_EACH = 40  # parts for which the place words come round
PLACE = _case(f"p_partkey % {_EACH}", [f"concat(p_name, ' {w}')" for w in PLACE_WORDS], "p_name")
EDITED = ("case " + " ".join(f"when p_partkey % {_EACH} = {k} then {v}" for k, v in EDITED_WORDS.items())
          + f" else concat(upper({PLACE}), ' - ', p_brand) end")

SURVEY_EXPRS = [
    ("l_orderkey", "l_orderkey"),
    ("l_partkey", "l_partkey"),
    ("l_suppkey", "l_suppkey"),
    ("l_linenumber", "l_linenumber"),
    ("CDUSUARIO", "cast(o_custkey as string)"),
    ("NUM_BENEFICIARIO", "case when l_linenumber % 2 = 0 then concat(cast(l_suppkey as string), '.0') "
                         "else cast(l_suppkey as string) end"),
    ("TELEFONE", "concat('9', cast(o_orderkey as string), case when l_linenumber = 3 then '.0' else '' end)"),
    ("MES", "cast(month(l_shipdate) as bigint)"),
    ("DIA", "cast(day(l_shipdate) as bigint)"),
    ("ANO", "cast(year(l_shipdate) as bigint)"),
    ("TIPO", "cast(1 + (l_partkey + l_linenumber) % 14 as bigint)"),
    ("LOCAL", "case when l_suppkey % 37 = 0 then null "
              f"when l_suppkey % 11 = 0 then concat(chr(160), upper({PLACE}), ' ') "
              f"when l_suppkey % 53 = 0 then concat({PLACE}, ' annex') else {PLACE} end"),
    ("ESPECIALIDADE", "case when l_orderkey % 41 = 0 then null else "
                      + _case("l_orderkey % 31", [f"'{w}'" for w in SPECIALITY_WORDS], "p_type") + " end"),
    ("UF", "case when o_custkey % 29 = 0 then null else " + _case("n_nationkey % 10", STATES, "'AC'") + " end"),
    ("NOTA1", "cast(nullif(cast(l_quantity as int) % 6, 0) as int)"),
    ("NOTA2", "cast(nullif((cast(l_quantity as int) + l_linenumber) % 6, 0) as int)"),
    ("NOTA3", "cast(nullif((l_partkey + l_linenumber) % 6, 0) as int)"),
    ("NOTA4", "cast(nullif(l_suppkey % 6, 0) as int)"),
    ("NOTA5", "cast(nullif(l_orderkey % 6, 0) as double)"),
    ("CLASSIFICACAO", "case when l_linestatus = 'O' and l_linenumber = 1 then 'ORIGINAL' end"),
    ("l_returnflag", "l_returnflag"),
]

SCORE_COLUMNS = ["NOTA1", "NOTA2", "NOTA3", "NOTA4", "NOTA5"]

# Lookup sheets derived from ``part`` (64 names, most with a place word now and then: duplicated,
# conflicting keys, a null key and dirty text, so keep-first is exercised).
CONTRACT_EXPRS = [
    ("Local", f"case when p_partkey % 101 = 0 then null when p_partkey % 5 = 0 then upper({PLACE}) "
              f"when p_partkey % 7 = 0 then concat(chr(160), {PLACE}) else {PLACE} end"),
    ("contratacao", "case when p_partkey % 3 = 0 then 'Rede Credenciada ' else ' rede propria' end"),
    ("_ord", "p_partkey"),
]
EDITED_EXPRS = [
    ("Local", f"case when p_partkey % 97 = 0 then null when p_partkey % 4 = 0 then upper({PLACE}) else {PLACE} end"),
    ("local_editado", f"case when p_partkey % 9 = 0 then '' else {EDITED} end"),
    ("_ord", "p_partkey"),
]
UNIT_SHEET_EXPRS = [
    ("UNIDADE", f"case when p_partkey % 3 = 1 then concat(upper({PLACE}), ' - ', p_brand) end"),
    ("OPERA", "case when p_size % 2 = 0 then 'ndi sp' else 'NDI  RJ' end"),
    ("_ord", "p_partkey"),
]


def meta_rows():
    """(grupo, meta, _ord) rows of the target sheet, generated by rule."""
    from quorum.config.classification import CLASS_NAMES
    rows = []
    for i, name in enumerate(CLASS_NAMES.values()):
        grupo = name.lower() if i % 4 == 1 else name
        rows.append((grupo, 3.5 + (i % 7) * 0.25, i))
    rows.append(("ORIGINAL", 4.0, len(rows)))
    rows.append(("  ", 1.0, len(rows)))
    return rows


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored survey table (avaliacoes) over the whole driver tables."""
    limit_methods(spark)
    # Hash-partition the fact on the order key: at scale this is exactly the
    # distribution the lineitem-orders sort-merge join requires (so it adds
    # no exchange); on small inputs stored as one row group it restores
    # parallelism for every row-local step downstream.
    li = _read(spark, sf_dir, "lineitem").repartition("l_orderkey")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    placed = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    base = li.join(placed, li.l_orderkey == placed.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return base.selectExpr(*[f"{e} AS `{a}`" for a, e in SURVEY_EXPRS])


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The negative-answer table (negativas): every line, no scores."""
    return survey(spark, sf_dir).drop(*SCORE_COLUMNS)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts dealt over tasks: stored as one row group, a sheet made of them would be reduced by a single task."""
    return _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size").repartition("p_partkey")


def contract_sheet(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir).selectExpr(*[f"{e} AS `{a}`" for a, e in CONTRACT_EXPRS])


def edited_sheet(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir).selectExpr(*[f"{e} AS `{a}`" for a, e in EDITED_EXPRS])


def unit_sheet(spark, sf_dir) -> DataFrame:
    return _parts(spark, sf_dir).selectExpr(*[f"{e} AS `{a}`" for a, e in UNIT_SHEET_EXPRS])


def meta_sheet(spark, sf_dir=None) -> DataFrame:
    return spark.createDataFrame(meta_rows(), "grupo string, meta double, _ord long")


# ---------------------------------------------------------------- SQL side
def _sel(exprs):
    return ", ".join(f'{e} AS "{a}"' for a, e in exprs)


SURVEY_SQL = (
    f"SELECT {_sel(SURVEY_EXPRS)} FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey "
    "JOIN part ON l_partkey = p_partkey"
)
NEGATIVES_SQL = (
    "SELECT * EXCLUDE (NOTA1, NOTA2, NOTA3, NOTA4, NOTA5) FROM survey"
)
CONTRACT_SQL = f"SELECT {_sel(CONTRACT_EXPRS)} FROM part"
EDITED_SQL = f"SELECT {_sel(EDITED_EXPRS)} FROM part"
UNIT_SHEET_SQL = f"SELECT {_sel(UNIT_SHEET_EXPRS)} FROM part"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def meta_sql() -> str:
    vals = ", ".join(f"({_sql_str(g)}, CAST({m} AS DOUBLE), CAST({o} AS BIGINT))"
                     for g, m, o in meta_rows())
    return f"SELECT * FROM (VALUES {vals}) AS t(grupo, meta, _ord)"


def with_views(body: str, *extra: tuple[str, str]) -> str:
    """Prefix an oracle query with the fixture views as CTEs."""
    ctes = [("survey", SURVEY_SQL), ("negativas", NEGATIVES_SQL),
            ("contract_sheet", CONTRACT_SQL), ("edited_sheet", EDITED_SQL),
            ("unit_sheet", UNIT_SHEET_SQL), ("meta_sheet", meta_sql())]
    ctes += list(extra)
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body
