"""Registered queries (one per operator of the inventory) and their oracles.

Every query reads the whole driver tables through the fixture views of
:mod:`quorum.survey`; none filters to a subset.  ``ORACLES`` holds the DuckDB
SQL for the same result, built with :mod:`quorum.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorum import oracles as O
from quorum import survey as S
from quorum.operators import clean, lookup, operator_rules, rules, score
from quorum.plans import avaliacoes as PL

QUERIES: dict = {}
ORACLES: dict = {}

KEYS = list(S.KEY_COLUMNS)
KEYS_SQL = ", ".join(KEYS)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def q(c):
    return F.col(f"`{c}`")


def cols_sql(cols):
    return ", ".join(O.qi(c) for c in cols)


# ------------------------------------------------------------------ stages
def _contracted(spark, d):
    return lookup.contract(S.survey(spark, d), S.contract_sheet(spark, d))


def _classified(spark, d):
    return rules.classify(_contracted(spark, d))


def _edited(spark, d, src=None):
    src = _classified(spark, d) if src is None else src
    return lookup.edited_place(src, S.edited_sheet(spark, d), action=None)


def _operated(spark, d):
    return operator_rules.assign_operator(_edited(spark, d), S.unit_sheet(spark, d))


SQL_CONTRACTED = f"({O.contracted('survey')})"
SQL_CLASSIFIED = f"({O.classified(SQL_CONTRACTED)})"
SQL_EDITED = f"({O.edited(SQL_CLASSIFIED)})"
SQL_OPERATED = f"({O.operated(SQL_EDITED)})"


def sql(body: str) -> str:
    return S.with_views(body)


# ------------------------------------------------------------ SC12 / SC13
@query("sc12_row_score", sql(f"""SELECT {KEYS_SQL}, "Quantidade notas validas", "NOTA GERAL"
FROM ({O.scored('survey')})"""))
def sc12_row_score(spark, d):
    return score.row_score(S.survey(spark, d)).select(*KEYS, q("Quantidade notas validas"), q("NOTA GERAL"))


# ---------------------------------------------------------------- JN1
@query("jn1_contract", sql(f"SELECT {KEYS_SQL}, LOCAL, CONTRATACAO FROM {SQL_CONTRACTED}"))
def jn1_contract(spark, d):
    return _contracted(spark, d).select(*KEYS, "LOCAL", "CONTRATACAO")


# ---------------------------------------------------------------- RU1
@query("ru1_classify", sql(f"SELECT {KEYS_SQL}, CLASSIFICACAO FROM {SQL_CLASSIFIED}"))
def ru1_classify(spark, d):
    return _classified(spark, d).select(*KEYS, "CLASSIFICACAO")


@query("ru1_classify_by_values", sql(f"SELECT {KEYS_SQL}, CLASSIFICACAO FROM {SQL_CLASSIFIED}"))
def ru1_classify_by_values(spark, d):
    """The same classes, with every pattern tried once per distinct place or speciality."""
    return rules.classify_by_values(_step(spark, d, "contracted", lambda: _contracted(spark, d))).select(*KEYS, "CLASSIFICACAO")


# ---------------------------------------------------------------- JN3
@query("jn3_edited_place", sql(f"""SELECT {KEYS_SQL}, LOCAL, "LOCAL EDITADO", ACAO_LOCAL_EDITADO
FROM ({O.edited('survey', with_action=True)})"""))
def jn3_edited_place(spark, d):
    return (lookup.edited_place(S.survey(spark, d), S.edited_sheet(spark, d))
            .select(*KEYS, "LOCAL", q("LOCAL EDITADO"), "ACAO_LOCAL_EDITADO"))


# ---------------------------------------------------------------- JN4
@query("jn4_target", sql(f"SELECT {KEYS_SQL}, CLASSIFICACAO, META, GRUPO_ENCONTRADO FROM ({O.targeted(SQL_CLASSIFIED)})"))
def jn4_target(spark, d):
    return (lookup.target(_classified(spark, d), S.meta_sheet(spark, d))
            .select(*KEYS, "CLASSIFICACAO", "META", "GRUPO_ENCONTRADO"))


# ---------------------------------------------------------------- RU9-RU11
@query("ru9_operator", sql(f"""SELECT {KEYS_SQL}, "LOCAL EDITADO", UF, OPERADORA FROM {SQL_OPERATED}"""))
def ru9_operator(spark, d):
    return _operated(spark, d).select(*KEYS, q("LOCAL EDITADO"), "UF", "OPERADORA")


# ---------------------------------------------------------------- AN1 / AN5
_SQL_SCORED_CLASSIFIED_EDITED = f"({O.edited(f'({O.classified(f'({O.scored(SQL_CONTRACTED)})')})')})"


@query("an1_unit_result", sql(f"""SELECT {KEYS_SQL}, CLASSIFICACAO, "LOCAL EDITADO", UF, "RESULTADO DA UNIDADE"
FROM ({O.unit_results(_SQL_SCORED_CLASSIFIED_EDITED)})"""))
def an1_unit_result(spark, d):
    df = PL.step_table(_edited(spark, d, rules.classify(score.row_score(_contracted(spark, d)))), "before_unit")
    return score.unit_result(df).select(*KEYS, "CLASSIFICACAO", q("LOCAL EDITADO"), "UF",
                                        q("RESULTADO DA UNIDADE"))


# ---------------------------------------------------------------- PL1
_PL1_COLS = ["CONTRATACAO", "Quantidade notas validas", "NOTA GERAL", "CLASSIFICACAO",
             "LOCAL EDITADO", "OPERADORA", "UF", "META", "RESULTADO DA UNIDADE", "STATUS UNIDADE"]


def _sql_pl1() -> str:
    cleaned = f"(SELECT * FROM ({O.scored('survey')}) WHERE \"Quantidade notas validas\" > 0)"
    x = f"({O.contracted(cleaned)})"
    x = f"({O.classified(x)})"
    x = f"({O.edited(x)})"
    x = f"({O.operated(x)})"
    x = f"({O.targeted(x)})"
    x = f"({O.unit_results(x)})"
    x = f"({O.statused(x)})"
    return sql(f"SELECT {KEYS_SQL}, {cols_sql(_PL1_COLS)} FROM {x}")


@query("pl1_scored_pipeline", _sql_pl1())
def pl1_scored_pipeline(spark, d):
    df = PL.scored_pipeline(S.survey(spark, d), S.contract_sheet(spark, d), S.edited_sheet(spark, d),
                            S.unit_sheet(spark, d), S.meta_sheet(spark, d))
    return df.select(*KEYS, *[q(c) for c in _PL1_COLS])


# ======================================================================
# Named pipeline stages (Spark side) and their SQL CTEs (oracle side)
# ======================================================================
from quorum.functions import schema as SCH  # noqa: E402
from quorum.functions.predicates import is_blank  # noqa: E402
from quorum.operators import route as R  # noqa: E402
from quorum.operators import summary as SM  # noqa: E402


_STEP_TABLES: dict = {}


def _step(spark, d, name, build):
    """A pipeline step output written once per session and data folder
    (see :func:`quorum.plans.avaliacoes.step_table`) and shared by the
    reports that read it."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _STEP_TABLES:
        _STEP_TABLES[key] = PL.step_table(build(), name)
    return _STEP_TABLES[key]


def _pl1_full(spark, d):
    """The scored table: its rows and its units are written, the unit results are looked up by each report."""
    key = (spark.sparkContext.applicationId, d, "avaliacoes")
    if key not in _STEP_TABLES:
        _STEP_TABLES[key] = PL.scored_pipeline(S.survey(spark, d), S.contract_sheet(spark, d), S.edited_sheet(spark, d),
                                               S.unit_sheet(spark, d), S.meta_sheet(spark, d))
    return _STEP_TABLES[key]


def _pl2_full(spark, d):
    return _step(spark, d, "negativas", lambda: PL.negative_pipeline(
        S.negatives(spark, d), S.contract_sheet(spark, d), S.edited_sheet(spark, d)))


#: Step tables that several queries read.
STEPS = {"avaliacoes": _pl1_full, "negativas": _pl2_full}
#: Digits of the row order's columns in an order number.
ORDER_DIGITS = {"l_orderkey": 14, "l_linenumber": 2, "l_partkey": 11, "l_suppkey": 11}


def _routed(spark, d):
    return R.route({"avaliacoes": _pl1_full(spark, d), "negativas": _pl2_full(spark, d)})


def _edited_action(spark, d):
    return lookup.edited_place(_classified(spark, d), S.edited_sheet(spark, d))


def _targeted(spark, d):
    return lookup.target(_classified(spark, d), S.meta_sheet(spark, d))


_SQL_PL1_STEPS = [
    ("cleaned", "SELECT * FROM (" + O.scored("survey") + ") WHERE \"Quantidade notas validas\" > 0"),
    ("c1", O.contracted("cleaned")), ("c2", O.classified("c1")), ("c3", O.edited("c2")),
    ("c4", O.operated("c3")), ("c5", O.targeted("c4")), ("c6", O.unit_results("c5")),
    ("pl1", O.statused("c6")),
]
STAGES = [
    ("contracted", O.contracted("survey")),
    ("classified", O.classified("contracted")),
    ("edited_act", O.edited("classified", with_action=True)),
    ("edited", O.edited("classified")),
    ("operated", O.operated("edited")),
    ("targeted", O.targeted("classified")),
    *_SQL_PL1_STEPS,
    ("n1", O.contracted("negativas")), ("n2", O.classified("n1")), ("pl2", O.edited("n2")),
    ("routed", f"""SELECT *, {O.group_case('CLASSIFICACAO')} AS GRUPO,
  {O.fold_key('CLASSIFICACAO')} AS CLASSIFICACAO_NORMALIZADA
FROM (SELECT 'avaliacoes' AS ORIGEM, * FROM pl1 UNION ALL BY NAME SELECT 'negativas' AS ORIGEM, * FROM pl2)"""),
]


def sqlx(body: str) -> str:
    return S.with_views(body, *STAGES)


# ---------------------------------------------------------------- clean
@query("fi1_clean_totals", sqlx("""SELECT count(*) AS total_linhas_entrada,
  count(*) FILTER (WHERE "Quantidade notas validas" > 0) AS total_linhas_saida,
  count(*) FILTER (WHERE "Quantidade notas validas" = 0) AS total_linhas_removidas
FROM (""" + O.scored("survey") + ")"))
def fi1_clean_totals(spark, d):
    return clean.clean_totals(S.survey(spark, d))


_REQ = list(clean.SCORED_REQUIRED)


@query("pr2_clean_scored", sqlx(f"""SELECT {KEYS_SQL}, NULL::DOUBLE AS "NOTA GERAL", NULL::VARCHAR AS CONTRATACAO,
  CLASSIFICACAO, NULL::VARCHAR AS OPERADORA, NULL::VARCHAR AS "LOCAL EDITADO", NULL::DOUBLE AS META,
  NULL::DOUBLE AS "RESULTADO DA UNIDADE", NULL::VARCHAR AS "STATUS UNIDADE", "Quantidade notas validas"
FROM ({O.scored('survey')}) WHERE "Quantidade notas validas" > 0"""))
def pr2_clean_scored(spark, d):
    return clean.clean_scored(S.survey(spark, d)).select(*KEYS, *[q(c) for c in _REQ], q(score.VALID))


@query("pr4_audit_base", sqlx(f"""SELECT {KEYS_SQL}, CDUSUARIO, MES, DIA, ANO, TIPO, NULL::VARCHAR AS CONTRATACAO,
  LOCAL, ESPECIALIDADE FROM ({O.scored('survey')}) WHERE "Quantidade notas validas" > 0"""))
def pr4_audit_base(spark, d):
    return clean.project(clean.clean_scored(S.survey(spark, d)), KEYS + list(clean.AUDIT_BASE_COLUMNS))


@query("pr5_schema_overlay", sqlx(f"""SELECT {KEYS_SQL},
  regexp_replace(NUM_BENEFICIARIO, '(\\d)\\.0$', '\\1') AS NUM_BENEFICIARIO,
  regexp_replace(TELEFONE, '(\\d)\\.0$', '\\1') AS TELEFONE, CDUSUARIO,
  CAST(TIPO AS BIGINT) AS TIPO, CAST(MES AS BIGINT) AS MES, CAST(NOTA1 AS BIGINT) AS NOTA1,
  CAST(NOTA5 AS DOUBLE) AS NOTA5 FROM survey"""))
def pr5_schema_overlay(spark, d):
    df = SCH.overlay(S.survey(spark, d), strict_ints=False)
    return df.select(*KEYS, "NUM_BENEFICIARIO", "TELEFONE", "CDUSUARIO", "TIPO", "MES", "NOTA1", "NOTA5")


# ---------------------------------------------------------------- contract
@query("jn11_rows_without_contract", sqlx(f"""SELECT {KEYS_SQL}, CDUSUARIO, UF, LOCAL, DIA, MES, ANO, ESPECIALIDADE
FROM contracted WHERE CONTRATACAO IS NULL"""))
def jn11_rows_without_contract(spark, d):
    df = lookup.unmatched(_contracted(spark, d), q("CONTRATACAO").isNotNull())
    return df.select(*KEYS, "CDUSUARIO", "UF", "LOCAL", "DIA", "MES", "ANO", "ESPECIALIDADE")


@query("ag1_places_without_contract", sqlx("""SELECT coalesce(UF, 'VAZIO') AS UF, coalesce(LOCAL, 'VAZIO') AS LOCAL,
  count(*) AS QUANTIDADE FROM contracted WHERE CONTRATACAO IS NULL GROUP BY 1, 2"""))
def ag1_places_without_contract(spark, d):
    df = _contracted(spark, d).where(q("CONTRATACAO").isNull())
    return SM.sort_count_desc(SM.multi_frequency(df, ["UF", "LOCAL"], fill="VAZIO"), ["UF", "LOCAL"])


@query("ag6_contract_totals", sqlx("""SELECT count(*) FILTER (WHERE CONTRATACAO = 'rede propria') AS total_rede_propria,
  count(*) FILTER (WHERE CONTRATACAO = 'rede credenciada') AS total_rede_credenciada,
  count(*) FILTER (WHERE CONTRATACAO IS NULL) AS total_sem_contratacao FROM contracted"""))
def ag6_contract_totals(spark, d):
    c = q("CONTRATACAO")
    return SM.conditional_totals(_contracted(spark, d), {
        "total_rede_propria": c == "rede propria", "total_rede_credenciada": c == "rede credenciada",
        "total_sem_contratacao": c.isNull()})


@query("ag16_contract_dimension", sqlx(f"""SELECT lower({O.strip('Local')}) AS LOCAL_COMPARACAO,
  arg_min(lower({O.strip('contratacao')}), _ord) AS contratacao FROM contract_sheet GROUP BY 1"""))
def ag16_contract_dimension(spark, d):
    sh = S.contract_sheet(spark, d)
    dim = sh.select(F.lower(lookup.tx.strip(q("Local"))).alias("LOCAL_COMPARACAO"),
                    F.lower(lookup.tx.strip(q("contratacao"))).alias("contratacao"), "_ord")
    return lookup.keep_first(dim, "LOCAL_COMPARACAO", ["contratacao"], "_ord")


@query("ag17_contract_conflicts", sqlx(f"""SELECT DISTINCT k AS LOCAL_COMPARACAO, v AS CONTRATACAO, n AS TOTAL_VALORES
FROM (SELECT *, count(DISTINCT v) OVER (PARTITION BY k) AS n FROM (
  SELECT lower({O.strip('Local')}) AS k, lower({O.strip('contratacao')}) AS v FROM contract_sheet))
WHERE n > 1 AND v IS NOT NULL"""))
def ag17_contract_conflicts(spark, d):
    sh = S.contract_sheet(spark, d).select(F.lower(lookup.tx.strip(q("Local"))).alias("LOCAL_COMPARACAO"),
                                           F.lower(lookup.tx.strip(q("contratacao"))).alias("CONTRATACAO"))
    return SM.conflicts(sh, "LOCAL_COMPARACAO", "CONTRATACAO")


# ---------------------------------------------------------------- score
@query("ag5_valid_score_distribution", sqlx(f"""SELECT "Quantidade notas validas", count(*) AS QUANTIDADE
FROM ({O.scored('survey')}) GROUP BY 1"""))
def ag5_valid_score_distribution(spark, d):
    df = score.row_score(S.survey(spark, d))
    return df.groupBy(q(score.VALID)).agg(F.count(F.lit(1)).alias("QUANTIDADE")).orderBy(q(score.VALID))


# ---------------------------------------------------------------- edited place
@query("ag3_edited_updated", sqlx("""SELECT LOCAL, "LOCAL EDITADO", CONTRATACAO, count(*) AS QUANTIDADE
FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'atualizado' AND LOCAL IS NOT NULL AND "LOCAL EDITADO" IS NOT NULL
  AND CONTRATACAO IS NOT NULL GROUP BY 1, 2, 3"""))
def ag3_edited_updated(spark, d):
    df = _edited_action(spark, d).where(q("ACAO_LOCAL_EDITADO") == "atualizado")
    return SM.multi_frequency(df, ["LOCAL", "LOCAL EDITADO", "CONTRATACAO"])


@query("ag4_edited_not_found", sqlx("""SELECT coalesce(LOCAL, 'VAZIO') AS LOCAL, count(*) AS QUANTIDADE
FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'nao_encontrado' GROUP BY 1"""))
def ag4_edited_not_found(spark, d):
    df = _edited_action(spark, d).where(q("ACAO_LOCAL_EDITADO") == "nao_encontrado")
    return SM.frequency(df, "LOCAL")


@query("ag6_edited_totals", sqlx("""SELECT count(*) FILTER (WHERE ACAO_LOCAL_EDITADO = 'atualizado') AS total_atualizados,
  count(*) FILTER (WHERE ACAO_LOCAL_EDITADO = 'nao_alterado') AS total_nao_alterados,
  count(*) FILTER (WHERE ACAO_LOCAL_EDITADO = 'nao_encontrado') AS total_nao_encontrados FROM edited_act"""))
def ag6_edited_totals(spark, d):
    a = q("ACAO_LOCAL_EDITADO")
    return SM.conditional_totals(_edited_action(spark, d), {
        "total_atualizados": a == "atualizado", "total_nao_alterados": a == "nao_alterado",
        "total_nao_encontrados": a == "nao_encontrado"})


# ---------------------------------------------------------------- target
@query("ag3_target_found_groups", sqlx("""SELECT GRUPO_ENCONTRADO AS GRUPO, count(*) AS QUANTIDADE FROM targeted
WHERE GRUPO_ENCONTRADO IS NOT NULL AND GRUPO_ENCONTRADO <> '' GROUP BY 1"""))
def ag3_target_found_groups(spark, d):
    df = _targeted(spark, d).where(q("GRUPO_ENCONTRADO").isNotNull() & (q("GRUPO_ENCONTRADO") != ""))
    return SM.frequency(df, "GRUPO_ENCONTRADO", None, alias="GRUPO")


@query("ag4_target_not_found", sqlx("""SELECT coalesce(CLASSIFICACAO, 'VAZIO') AS CLASSIFICACAO, count(*) AS QUANTIDADE
FROM targeted WHERE GRUPO_ENCONTRADO IS NULL OR GRUPO_ENCONTRADO = '' GROUP BY 1"""))
def ag4_target_not_found(spark, d):
    df = _targeted(spark, d).where(is_blank(q("GRUPO_ENCONTRADO")))
    return SM.frequency(df, "CLASSIFICACAO")


# ---------------------------------------------------------------- rule audits
def _audit_sql(src: str, rules=None) -> str:
    from quorum.config.classification import CLASSIFICATION_RULES
    rules = CLASSIFICATION_RULES if rules is None else rules
    parts = []
    for k, r in enumerate(rules, 1):
        fo = bool(r.get("aplicar_somente_vazios"))
        bb = f"(__ob AND __fm = {k})"
        ap = f"(__m{k} AND {bb})" if fo else f"__m{k}"
        parts.append(f"""SELECT {k} AS ORDEM_REGRA, {O.s(r['grupo_classificacao'])} AS CHAVE_GRUPO,
  {O.s(O.class_name(r['grupo_classificacao']))} AS CLASSIFICACAO, {O.s(r['nome_lista'])} AS NOME_LISTA,
  {O.s(r['palavra_filtro']) if r.get('palavra_filtro') else 'NULL::VARCHAR'} AS PALAVRA_FILTRO,
  {_rule_text_sql(r)} AS REGRA,
  count(*) FILTER (WHERE __m{k}) AS TOTAL_ATINGIDAS,
  count(*) FILTER (WHERE __m{k} AND {bb}) AS TOTAL_CLASSIFICADAS_VAZIAS,
  count(*) FILTER (WHERE __m{k} AND NOT {bb}) AS TOTAL_JA_CLASSIFICADAS,
  count(*) FILTER (WHERE {ap} AND NOT {bb}) AS TOTAL_SOBRESCRITAS FROM {src}""")
    return "\nUNION ALL\n".join(parts)


def _rule_text_sql(r) -> str:
    """The rule's description, put together by the oracle from its own labels."""
    labels = [("TIPO igual a", "tipo_igual"), ("TIPO diferente de", "tipo_diferente"), ("CONTRATACAO igual a", "contratacao_igual"),
              ("CONTRATACAO diferente de", "contratacao_diferente"), ("LOCAL contem", "filtro_local"),
              ("LOCAL diferente de", "filtro_local_diferente"), ("ESPECIALIDADE contem", "filtro_especialidade"),
              ("ESPECIALIDADE diferente de", "filtro_especialidade_diferente")]
    said = [f"'{text} ' || {O.s(r[field])}" for text, field in labels if r.get(field)]
    said += ["'CLASSIFICACAO vazia'"] if r.get("aplicar_somente_vazios") else []
    return f"concat_ws(' | ', {', '.join(said)})" if said else "'sem filtros'"


def _filter_text_sql(v) -> str:
    if isinstance(v, list) and v:
        return f"array_to_string([{', '.join(map(str, v))}], ' | ')"
    return f"coalesce(nullif(trim({O.s('' if v is None or v == [] else v)}), ''), 'sem filtro')"


@query("ru4_class_rule_audit", sqlx(_audit_sql(f"({O.class_prep('contracted')})")))
def ru4_class_rule_audit(spark, d):
    return rules.class_rule_audit(_contracted(spark, d))


def _overwriting_rules():
    from quorum.config.classification import CLASSIFICATION_RULES
    return [{**r, "aplicar_somente_vazios": False} for r in CLASSIFICATION_RULES]


@query("ru4_class_rule_audit_overwriting", sqlx(_audit_sql(
    f"({O.class_prep('contracted', _overwriting_rules())})", _overwriting_rules())))
def ru4_class_rule_audit_overwriting(spark, d):
    return rules.class_rule_audit(_contracted(spark, d), _overwriting_rules())


def _events_sql(src: str, rules_list, applied: bool) -> str:
    """Overwrite events via per-rule rows and a lag window over each row."""
    parts = [f"SELECT {KEYS_SQL}, 0 AS k, CLASSIFICACAO AS lbl, LOCAL, ESPECIALIDADE, CONTRATACAO FROM {src} WHERE NOT __ob"]
    for k, r in enumerate(rules_list, 1):
        name = O.s(O.class_name(r["grupo_classificacao"]))
        cond = f"__m{k}"
        if applied and r.get("aplicar_somente_vazios"):
            cond = f"(__m{k} AND __ob AND __fm = {k})"
        parts.append(f"SELECT {KEYS_SQL}, {k}, {name}, LOCAL, ESPECIALIDADE, CONTRATACAO FROM {src} WHERE {cond}")
    u = "\nUNION ALL\n".join(parts)
    return f"""SELECT * FROM (SELECT *, lag(k) OVER w AS p, lag(lbl) OVER w AS pl FROM ({u})
  WINDOW w AS (PARTITION BY {KEYS_SQL} ORDER BY k)) WHERE p IS NOT NULL"""


def _label_sql(ev: str, extra_cols: str = "", extra_group: str = "") -> str:
    meta = O.rule_meta_values()
    return f"""SELECT CASE WHEN e.p = 0 THEN 'ORIGINAL' ELSE CAST(e.p AS VARCHAR) END AS ORDEM_REGRA_ANTERIOR,
  CAST(e.k AS INTEGER) AS ORDEM_REGRA_NOVA,
  CASE WHEN e.p = 0 THEN 'BASE DE ENTRADA' ELSE mp.lista END AS NOME_LISTA_ANTERIOR, mn.lista AS NOME_LISTA_NOVA,
  CASE WHEN e.p = 0 THEN 'CLASSIFICACAO_PRE_EXISTENTE' ELSE mp.chave END AS CHAVE_GRUPO_ANTERIOR,
  mn.chave AS CHAVE_GRUPO_NOVA, coalesce(e.pl, 'VAZIO') AS CLASSIFICACAO_ANTERIOR, mn.nome AS CLASSIFICACAO_NOVA
  {extra_cols}, count(*) AS QUANTIDADE
FROM ({ev}) e LEFT JOIN {meta} mp ON e.p = mp.k JOIN {meta} mn ON e.k = mn.k
GROUP BY ALL"""


@query("ru5_class_overwrite_audit", sqlx(_label_sql(_events_sql(
    f"({O.class_prep('contracted', _overwriting_rules())})", _overwriting_rules(), True))))
def ru5_class_overwrite_audit(spark, d):
    return rules.class_overwrite_audit(_contracted(spark, d), _overwriting_rules())


def _ru8_sql() -> str:
    from quorum.config.classification import CLASSIFICATION_RULES as CR
    ev = _events_sql(f"({O.class_prep('contracted')})", CR, False)
    texts = []
    for alias, field in rules.INCREMENTAL_RULE_TEXT:
        texts.append("CASE e.k " + " ".join(
            f"WHEN {k} THEN {_filter_text_sql(r.get(field))}" for k, r in enumerate(CR, 1)) + f" END AS {alias}")
    extra = (", coalesce(e.LOCAL, 'VAZIO') AS LOCAL_LINHA_SOBRESCRITA,"
             " coalesce(e.ESPECIALIDADE, 'VAZIO') AS ESPECIALIDADE_LINHA_SOBRESCRITA,"
             " coalesce(e.CONTRATACAO, 'VAZIO') AS CONTRATACAO_LINHA_SOBRESCRITA,"
             " 'false' AS APLICAR_SOMENTE_VAZIOS_REGRA, " + ", ".join(texts))
    return _label_sql(ev, extra)


@query("ru8_incremental_overwrite_audit", sqlx(_ru8_sql()))
def ru8_incremental_overwrite_audit(spark, d):
    return rules.incremental_overwrite_audit(_contracted(spark, d))


@query("ru7_unclassified_by_local", sqlx("""SELECT coalesce(LOCAL, 'VAZIO') AS LOCAL, count(*) AS QUANTIDADE
FROM classified WHERE coalesce(CLASSIFICACAO, '') = '' GROUP BY 1"""))
def ru7_unclassified_by_local(spark, d):
    return SM.frequency(rules.unclassified(_classified(spark, d)), "LOCAL")


@query("ru7_unclassified_detail", sqlx(f"""SELECT {KEYS_SQL}, CDUSUARIO, UF, MES, DIA, ANO, TIPO, CONTRATACAO, LOCAL,
  ESPECIALIDADE FROM classified WHERE coalesce(CLASSIFICACAO, '') = ''"""))
def ru7_unclassified_detail(spark, d):
    return rules.unclassified(_classified(spark, d)).select(*KEYS, *rules.UNCLASSIFIED_DETAIL)


@query("dq11_all_classified", sqlx("""SELECT count(*) AS TOTAL_LINHAS,
  count(*) FILTER (WHERE coalesce(CLASSIFICACAO, '') = '') AS TOTAL_NAO_CLASSIFICADAS FROM classified"""))
def dq11_all_classified(spark, d):
    return _classified(spark, d).agg(F.count(F.lit(1)).alias("TOTAL_LINHAS"),
                                     F.count(F.when(is_blank(q("CLASSIFICACAO")), 1)).alias("TOTAL_NAO_CLASSIFICADAS"))


# ---------------------------------------------------------------- operator
def _operated_frame(spark, d):
    return _edited(spark, d), S.unit_sheet(spark, d)


def _op_steps_sql(v2: bool = False):
    """(mask, fill_only, name, value-sql, ordem) per operator step, in SQL."""
    from quorum.config import operator as oc
    rules_ = oc.OPERATOR_RULES

    def flt(f):
        c = O.qi(f["coluna"])
        if f["tipo_filtro"] == "igual":
            return f"coalesce({c} = {O.s(f['valor_filtro'])}, false)"
        if v2:
            return f"coalesce(contains(upper({c}), upper({O.s(f['valor_filtro'])})), false)"
        return f"coalesce(regexp_matches({c}, {O.s(f['valor_filtro'])}, 'i'), false)"
    masks = ["(" + " AND ".join(flt(f) for f in r["filtros"]) + ")" for r in rules_]
    name, value, col, place = oc.SPECIAL_FILL_RULE
    n = len(rules_)
    masks += [f"coalesce({O.qi(col)} = {O.s(place)}, false)", "(__mo IS NOT NULL AND __mo <> '')", "true"]
    fills = [False] * n + [True, False, True]
    names = [r["descricao"] for r in rules_] + [name, oc.V2_MAP_BLOCK_NAME if v2 else oc.MAP_RULE_NAME,
                                                 oc.DEFAULT_RULE_NAME]
    vals = [O.s(r["valor_operadora"]) for r in rules_] + [O.s(value), "__mo", O.s(oc.DEFAULT_OPERATOR)]
    shown = [r["valor_operadora"] for r in rules_] + [value, oc.V2_MAP_OPERATOR if v2 else oc.MAP_RULE_VALUE,
                                                      oc.DEFAULT_OPERATOR]
    ordens = list(range(1, n + 2)) + ([n + 5, n + 10] if v2 else [n + 2, n + 3])
    return masks, fills, names, vals, shown, ordens


def _op_applied_sql(masks, fills):
    ob = O.blank("OPERADORA")
    out = []
    for k, (m, fo) in enumerate(zip(masks, fills)):
        before = " OR ".join(["false"] + masks[:k])
        bb = f"({ob} AND NOT ({before}))"
        out.append((f"({m} AND {bb})" if fo else m, bb))
    return out


def _op_audit_sql(v2: bool = False) -> str:
    """Operator audit oracle: per step counts via the closed form in SQL."""
    masks, fills, names, vals, shown, ordens = _op_steps_sql(v2)
    parts = []
    for k, (ap, bb) in enumerate(_op_applied_sql(masks, fills)):
        ordem = ordens[k] if v2 else k + 1
        extra = f", {O.s('sim' if fills[k] else 'nao')} AS APLICAR_SOMENTE_VAZIOS" if v2 else ""
        parts.append(f"""SELECT {ordem} AS ORDEM, {O.s(names[k])} AS REGRA, {O.s(shown[k])} AS OPERADORA_APLICADA{extra},
  count(*) FILTER (WHERE {ap}) AS TOTAL_ATINGIDAS, count(*) FILTER (WHERE {ap} AND {bb}) AS TOTAL_VAZIAS,
  count(*) FILTER (WHERE {ap} AND NOT {bb}) AS TOTAL_SOBRESCRITAS FROM opprep""")
    return "\nUNION ALL\n".join(parts)


def _op_overwrite_log_sql() -> str:
    """v1 overwrite log oracle: applied steps as rows, previous value by lag."""
    masks, fills, names, vals, shown, ordens = _op_steps_sql(False)
    parts = [f"SELECT {KEYS_SQL}, \"LOCAL EDITADO\" AS le, 0 AS k, OPERADORA AS v FROM opprep WHERE NOT {O.blank('OPERADORA')}"]
    for k, (ap, bb) in enumerate(_op_applied_sql(masks, fills)):
        parts.append(f"SELECT {KEYS_SQL}, \"LOCAL EDITADO\", {k + 1}, {vals[k]} FROM opprep WHERE {ap}")
    u = "\nUNION ALL\n".join(parts)
    return f"""SELECT le AS "LOCAL EDITADO", v AS OPERADORA, p AS OPERADORA_ANTERIOR, count(*) AS QUANTIDADE FROM (
  SELECT *, lag(v) OVER (PARTITION BY {KEYS_SQL} ORDER BY k) AS p FROM ({u}))
WHERE p IS NOT NULL AND le IS NOT NULL GROUP BY 1, 2, 3"""


def _opprep_sql(v2: bool = False) -> str:
    n = (lambda x: f"coalesce({O.normalize(x)}, '')") if v2 else O.normalize
    mo = f"{O.s('NDI SP E RJ')}" if v2 else "arg_min(upper(" + O.normalize('OPERA') + "), _ord)"
    return f"""SELECT p.*, d.v AS __mo FROM (SELECT * REPLACE (upper({n('CLASSIFICACAO')}) AS CLASSIFICACAO,
   upper({n('UF')}) AS UF, upper({n('"LOCAL EDITADO"')}) AS "LOCAL EDITADO",
   upper({n('OPERADORA')}) AS OPERADORA) FROM (SELECT *, NULL::VARCHAR AS OPERADORA FROM edited)) p
LEFT JOIN (SELECT upper({O.normalize('UNIDADE')}) AS k, {mo} AS v FROM unit_sheet
           WHERE UNIDADE IS NOT NULL GROUP BY 1) d ON p."LOCAL EDITADO" = d.k"""


@query("ru9_operator_rule_audit", S.with_views(_op_audit_sql(), *STAGES, ("opprep", _opprep_sql())))
def ru9_operator_rule_audit(spark, d):
    df, us = _operated_frame(spark, d)
    return operator_rules.operator_rule_audit(df, us)


@query("ru11_blank_before_default", sqlx(f"""SELECT {KEYS_SQL}, UF, "LOCAL EDITADO", CLASSIFICACAO, CONTRATACAO,
  ESPECIALIDADE FROM operated WHERE OPERADORA = 'HAPVIDA'"""))
def ru11_blank_before_default(spark, d):
    df, us = _operated_frame(spark, d)
    out = operator_rules.assign_operator(df, us, snapshot_col="__blank_before_default")
    return out.where("__blank_before_default").select(*KEYS, "UF", q("LOCAL EDITADO"), "CLASSIFICACAO",
                                                      "CONTRATACAO", "ESPECIALIDADE")


@query("ru11_default_places", sqlx("""SELECT "LOCAL EDITADO", UF, count(*) AS QUANTIDADE FROM operated
WHERE OPERADORA = 'HAPVIDA' AND "LOCAL EDITADO" IS NOT NULL AND UF IS NOT NULL GROUP BY 1, 2"""))
def ru11_default_places(spark, d):
    df, us = _operated_frame(spark, d)
    out = operator_rules.assign_operator(df, us, snapshot_col="__b").where("__b")
    return SM.sort_count_desc(SM.multi_frequency(out, ["LOCAL EDITADO", "UF"]), ["LOCAL EDITADO"])


@query("ag7_places_many_operators", sqlx("""SELECT "LOCAL EDITADO", OPERADORA, QUANTIDADE, TOTAL_OPERADORAS FROM (
  SELECT "LOCAL EDITADO", OPERADORA, count(*) AS QUANTIDADE,
         count(*) OVER (PARTITION BY "LOCAL EDITADO") AS TOTAL_OPERADORAS
  FROM operated WHERE "LOCAL EDITADO" IS NOT NULL AND OPERADORA IS NOT NULL GROUP BY 1, 2)
WHERE TOTAL_OPERADORAS > 1"""))
def ag7_places_many_operators(spark, d):
    return operator_rules.places_with_many_operators(_operated(spark, d))


@query("ag3_place_operator_pairs", sqlx("""SELECT "LOCAL EDITADO", OPERADORA, count(*) AS QUANTIDADE FROM operated
WHERE "LOCAL EDITADO" IS NOT NULL AND OPERADORA IS NOT NULL GROUP BY 1, 2"""))
def ag3_place_operator_pairs(spark, d):
    return SM.multi_frequency(_operated(spark, d), ["LOCAL EDITADO", "OPERADORA"]).orderBy(
        q("LOCAL EDITADO"), "OPERADORA")


# ---------------------------------------------------------------- unit result / status
@query("an5_status_counts", sqlx("""SELECT coalesce("STATUS UNIDADE", 'sem status') AS "STATUS UNIDADE",
  count(*) AS QUANTIDADE FROM pl1 GROUP BY 1"""))
def an5_status_counts(spark, d):
    return SM.frequency(_pl1_full(spark, d), "STATUS UNIDADE", "sem status")


@query("fi16_status_totals", sqlx("""SELECT count(*) FILTER (WHERE "STATUS UNIDADE" = 'dentro da meta') AS total_dentro_meta,
  count(*) FILTER (WHERE "STATUS UNIDADE" = 'fora da meta') AS total_fora_meta,
  count(*) FILTER (WHERE "STATUS UNIDADE" IS NULL) AS total_sem_status FROM pl1"""))
def fi16_status_totals(spark, d):
    st = q("STATUS UNIDADE")
    return SM.conditional_totals(_pl1_full(spark, d), {
        "total_dentro_meta": st == "dentro da meta", "total_fora_meta": st == "fora da meta",
        "total_sem_status": st.isNull()})


_ORD_SQL = "struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_suppkey)"


@query("ag8_unit_inspection", sqlx(f"""SELECT CLASSIFICACAO, "LOCAL EDITADO", UF, count(*) AS QUANTIDADE_LINHAS,
  arg_min("RESULTADO DA UNIDADE", CASE WHEN "RESULTADO DA UNIDADE" IS NOT NULL THEN {_ORD_SQL} END) AS RESULTADO_DA_UNIDADE,
  min("NOTA GERAL") AS NOTA_GERAL_MIN, max("NOTA GERAL") AS NOTA_GERAL_MAX,
  arg_min(META, CASE WHEN META IS NOT NULL THEN {_ORD_SQL} END) AS META,
  arg_min(OPERADORA, CASE WHEN OPERADORA IS NOT NULL THEN {_ORD_SQL} END) AS OPERADORA
FROM pl1 GROUP BY ALL"""))
def ag8_unit_inspection(spark, d):
    return score.unit_inspection(_pl1_full(spark, d), score.order_number(ORDER_DIGITS))


@query("fi15_blank_unit_keys", sqlx(f"""SELECT {KEYS_SQL}, CLASSIFICACAO, "LOCAL EDITADO", UF,
  concat_ws(', ', CASE WHEN coalesce(CLASSIFICACAO, '') = '' THEN 'CLASSIFICACAO' END,
    CASE WHEN coalesce("LOCAL EDITADO", '') = '' THEN 'LOCAL EDITADO' END,
    CASE WHEN coalesce(UF, '') = '' THEN 'UF' END) AS COLUNA_VAZIA
FROM pl1 WHERE coalesce(CLASSIFICACAO, '') = '' OR coalesce("LOCAL EDITADO", '') = '' OR coalesce(UF, '') = ''"""))
def fi15_blank_unit_keys(spark, d):
    return score.blank_key_rows(_pl1_full(spark, d)).select(*KEYS, "CLASSIFICACAO", q("LOCAL EDITADO"), "UF",
                                                            "COLUNA_VAZIA")


# ---------------------------------------------------------------- summaries per class / operator
@query("ag9_class_summary", sqlx(f"""SELECT CLASSIFICACAO, count(*) AS CONTAGEM,
  {O.round2('CAST(sum(CAST(round_even("NOTA GERAL" * 100, 0) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * count(*))')} AS MEDIA_NOTA_GERAL
FROM (SELECT {O.strip('CLASSIFICACAO')} AS CLASSIFICACAO, "NOTA GERAL" FROM pl1)
WHERE CLASSIFICACAO IS NOT NULL AND CLASSIFICACAO NOT IN ('', 'nan', 'None') AND "NOTA GERAL" IS NOT NULL GROUP BY 1"""))
def ag9_class_summary(spark, d):
    return SM.class_summary(_pl1_full(spark, d))


_AG10_BASE = f"""SELECT {O.strip('OPERADORA')} AS OPERADORA, "NOTA GERAL" FROM pl1
  WHERE {O.strip('OPERADORA')} NOT IN ('', 'nan', 'None') AND "NOTA GERAL" IS NOT NULL"""


@query("ag10_operator_summary", S.with_views(f"""SELECT OPERADORA, count(*) AS CONTAGEM,
  {O.round2('CAST(sum(CAST(round_even("NOTA GERAL" * 100, 0) AS BIGINT)) AS DOUBLE) / (100.0::DOUBLE * count(*))')} AS MEDIA_NOTA_GERAL
FROM (SELECT OPERADORA, "NOTA GERAL" FROM ag10_base UNION ALL
      SELECT 'PROMED + HAPVIDA', "NOTA GERAL" FROM ag10_base WHERE OPERADORA IN ('PROMED', 'HAPVIDA'))
GROUP BY 1""", *STAGES, ("ag10_base", _AG10_BASE)))
def ag10_operator_summary(spark, d):
    return SM.operator_summary(_pl1_full(spark, d))


_FAULTY_SCORE = ("case l_linenumber when 3 then 'sem nota' when 4 then '1d' when 5 then null when 6 then ' ' "
                 "else cast(`NOTA GERAL` as string) end")


@query("fi14_discard_counts", sqlx(f"""SELECT count(*) AS LINHAS, count(*) FILTER (WHERE k) AS DESCARTADAS_CHAVE,
  count(*) FILTER (WHERE NOT k AND TRY_CAST(replace(x, '1d', 'x') AS DOUBLE) IS NULL) AS DESCARTADAS_NOTA,
  count(*) FILTER (WHERE NOT k AND x IS NOT NULL AND TRY_CAST(replace(x, '1d', 'x') AS DOUBLE) IS NULL) AS ERRO_CONVERSAO
FROM (SELECT CLASSIFICACAO IS NULL OR trim(CLASSIFICACAO) IN ('', 'nan', 'None') AS k, {_FAULTY_SCORE.replace('`', '"')} AS x FROM pl1)"""))
def fi14_discard_counts(spark, d):
    """Scores with some that are no numbers, so that every counter finds rows."""
    return SM.discard_counts(_pl1_full(spark, d).withColumn("NOTA GERAL", F.expr(_FAULTY_SCORE)), "CLASSIFICACAO")


# ---------------------------------------------------------------- negatives (PL2)
@query("pl2_negative_pipeline", sqlx(f"""SELECT {KEYS_SQL}, LOCAL, CONTRATACAO, CLASSIFICACAO, "LOCAL EDITADO" FROM pl2"""))
def pl2_negative_pipeline(spark, d):
    return _pl2_full(spark, d).select(*KEYS, "LOCAL", "CONTRATACAO", "CLASSIFICACAO", q("LOCAL EDITADO"))


# ---------------------------------------------------------------- routing (PL3)
def _routed_step(spark, d):
    """The routed rows of both written sources, not written again: a class's group is looked up by each report."""
    return _routed(spark, d)


@query("pl3_route_class_counts", sqlx("""SELECT GRUPO, CLASSIFICACAO_NORMALIZADA, ORIGEM, count(*) AS QUANTIDADE
FROM routed WHERE GRUPO IS NOT NULL GROUP BY ALL"""))
def pl3_route_class_counts(spark, d):
    return R.class_counts(_routed_step(spark, d))


def _groups_values():
    from quorum.config.classification import DELIVERY_GROUPS
    return "(SELECT * FROM (VALUES " + ", ".join(f"({O.s(g)})" for g in DELIVERY_GROUPS) + ") AS t(GRUPO))"


@query("ag12_per_file_counts", sqlx(f"""SELECT g.GRUPO, coalesce(c.a, 0) AS AVALIACOES, coalesce(c.n, 0) AS NEGATIVAS,
  coalesce(c.a, 0) + coalesce(c.n, 0) AS TOTAL
FROM {_groups_values()} g LEFT JOIN (SELECT GRUPO, count(*) FILTER (WHERE ORIGEM = 'avaliacoes') AS a,
  count(*) FILTER (WHERE ORIGEM = 'negativas') AS n FROM routed WHERE GRUPO IS NOT NULL GROUP BY 1) c ON g.GRUPO = c.GRUPO"""))
def ag12_per_file_counts(spark, d):
    return R.per_file_counts(_routed_step(spark, d))


def _rule_classes_values():
    from quorum.config.classification import DELIVERY_GROUPS
    from quorum.functions.text import fold_key_py
    rows, seen = [], set()
    for g, classes in DELIVERY_GROUPS.items():
        for c in classes:
            k = fold_key_py(c)
            if (g, k) not in seen:
                seen.add((g, k))
                rows.append(f"({O.s(g)}, {O.s(k)}, {O.s(c)})")
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t(GRUPO, CN, CLASSIFICACAO))"


@query("ag13_per_class_counts", sqlx(f"""SELECT r.GRUPO, r.CLASSIFICACAO, coalesce(c.a, 0) AS AVALIACOES,
  coalesce(c.n, 0) AS NEGATIVAS, coalesce(c.a, 0) + coalesce(c.n, 0) AS TOTAL
FROM {_rule_classes_values()} r LEFT JOIN (SELECT GRUPO, CLASSIFICACAO_NORMALIZADA AS CN,
  count(*) FILTER (WHERE ORIGEM = 'avaliacoes') AS a, count(*) FILTER (WHERE ORIGEM = 'negativas') AS n
  FROM routed WHERE GRUPO IS NOT NULL GROUP BY 1, 2) c ON r.GRUPO = c.GRUPO AND r.CN = c.CN"""))
def ag13_per_class_counts(spark, d):
    return R.per_class_counts(_routed_step(spark, d))


@query("ag14_unassigned_classes", sqlx("""SELECT ORIGEM, coalesce(CLASSIFICACAO, 'VAZIO') AS CLASSIFICACAO,
  count(*) AS QUANTIDADE FROM routed WHERE GRUPO IS NULL GROUP BY 1, 2"""))
def ag14_unassigned_classes(spark, d):
    return R.unassigned(_routed_step(spark, d)).orderBy("ORIGEM", "CLASSIFICACAO")


def _lossy_delivery(spark, d):
    """A written delivery in which rows of one source got lost and some of one group came in twice."""
    def build():
        out = R.delivery(_routed_step(spark, d)).select(*KEYS, "GRUPO", "ORIGEM", "CLASSIFICACAO")
        lost = out.where(~((q("ORIGEM") == "avaliacoes") & (q("l_linenumber") == 6)))
        return lost.unionByName(out.where((q("GRUPO") == "odontologia") & (q("l_linenumber") == 2)))
    return _step(spark, d, "delivery", build)


_SQL_LOSSY = """SELECT * FROM routed WHERE GRUPO IS NOT NULL AND NOT (ORIGEM = 'avaliacoes' AND l_linenumber = 6)
  UNION ALL SELECT * FROM routed WHERE GRUPO = 'odontologia' AND l_linenumber = 2"""


@query("ag15_reconciliation", S.with_views("""SELECT *, DIFERENCA = 0 AS OK FROM (
  SELECT *, TOTAL_ORIGEM - TOTAL_ENVIADO - TOTAL_NAO_ENVIADO AS DIFERENCA FROM (
    SELECT r.o AS ORIGEM, TOTAL_ORIGEM, TOTAL_NAO_ENVIADO, TOTAL_ENVIADO FROM
      (SELECT coalesce(ORIGEM, 'total') AS o, count(*) AS TOTAL_ORIGEM, count(*) FILTER (WHERE GRUPO IS NULL) AS TOTAL_NAO_ENVIADO
       FROM routed GROUP BY ROLLUP (ORIGEM)) r
      JOIN (SELECT coalesce(ORIGEM, 'total') AS o, count(*) AS TOTAL_ENVIADO FROM lossy GROUP BY ROLLUP (ORIGEM)) l ON r.o = l.o))""",
    *STAGES, ("lossy", _SQL_LOSSY)))
def ag15_reconciliation(spark, d):
    return R.reconciliation(_routed_step(spark, d), _lossy_delivery(spark, d))


@query("ag15_delivery_differences", S.with_views("""SELECT GRUPO, ORIGEM, ESPERADO, ENCONTRADO FROM (
  SELECT GRUPO, ORIGEM, sum(e) AS ESPERADO, sum(f) AS ENCONTRADO FROM (
    SELECT GRUPO, ORIGEM, 1 AS e, 0 AS f FROM routed WHERE GRUPO IS NOT NULL
    UNION ALL SELECT GRUPO, ORIGEM, 0, 1 FROM lossy) GROUP BY ALL) WHERE ESPERADO <> ENCONTRADO""", *STAGES, ("lossy", _SQL_LOSSY)))
def ag15_delivery_differences(spark, d):
    return R.delivery_differences(_routed_step(spark, d), _lossy_delivery(spark, d))


@query("io14_delivery_datasets", sqlx(f"""SELECT {KEYS_SQL}, GRUPO, ORIGEM, {O.send_name_case('CLASSIFICACAO')} AS CLASSIFICACAO
FROM routed WHERE GRUPO IS NOT NULL"""))
def io14_delivery_datasets(spark, d):
    from quorum.sources import io as IO
    from datetime import datetime
    run_id = datetime.now().strftime("%Y%m%d_%H%M%S")  # IO16: run-stamped output
    out = (R.delivery(_routed_step(spark, d)).select(*KEYS, "GRUPO", "ORIGEM", "CLASSIFICACAO")
           .withColumn("RUN_ID", F.lit(run_id)))
    path = IO.scratch_path(spark, "delivery")
    IO.write_partitioned(out, path, ["RUN_ID", "GRUPO", "ORIGEM"])
    return spark.read.parquet(path).select(*KEYS, "GRUPO", "ORIGEM", "CLASSIFICACAO")


@query("fi11_one_group_delivery", sqlx(f"""SELECT ORIGEM, count(*) AS QUANTIDADE FROM routed
WHERE {O.fold_key('CLASSIFICACAO')} IN ('HAPCLINICA') GROUP BY 1"""))
def fi11_one_group_delivery(spark, d):
    return R.in_group(_routed_step(spark, d), "hapclinica").groupBy("ORIGEM").agg(F.count(F.lit(1)).alias("QUANTIDADE"))


@query("jn6_send_names", sqlx(f"""SELECT {KEYS_SQL}, {O.send_name_case('CLASSIFICACAO')} AS CLASSIFICACAO FROM pl1"""))
def jn6_send_names(spark, d):
    return lookup.apply_send_names(_pl1_full(spark, d), distinct=True).select(*KEYS, "CLASSIFICACAO")


@query("io7_sheet_union", sqlx("""SELECT __origem_aba, count(*) AS QUANTIDADE, count(CLASSIFICACAO) AS COM_CLASSIFICACAO
FROM (SELECT 'avaliacoes' AS __origem_aba, * FROM pl1 UNION ALL BY NAME SELECT 'negativas' AS __origem_aba, * FROM pl2)
GROUP BY 1"""))
def io7_sheet_union(spark, d):
    from quorum.sources import io as IO
    u = IO.union_sheets({"avaliacoes": _pl1_full(spark, d), "negativas": _pl2_full(spark, d)})
    return u.groupBy("__origem_aba").agg(F.count(F.lit(1)).alias("QUANTIDADE"),
                                         F.count("CLASSIFICACAO").alias("COM_CLASSIFICACAO"))


@query("io8_sheets_with_columns", sqlx("""SELECT ABA_ORIGEM, count(*) AS QUANTIDADE FROM (
  SELECT 'avaliacoes' AS ABA_ORIGEM, CLASSIFICACAO, "NOTA GERAL" FROM pl1) GROUP BY 1"""))
def io8_sheets_with_columns(spark, d):
    from quorum.sources import io as IO
    u = IO.union_sheets_with({"avaliacoes": _pl1_full(spark, d), "negativas": _pl2_full(spark, d)},
                             ["CLASSIFICACAO", "NOTA GERAL"])
    return u.groupBy("ABA_ORIGEM").agg(F.count(F.lit(1)).alias("QUANTIDADE"))


# ---------------------------------------------------------------- splits (IO12 / IO13)
def _split_sql(src, ranges):
    parts = []
    for name, lo, hi in ranges:
        cond = f"TIPO >= {lo}" if hi is None else f"TIPO BETWEEN {lo} AND {hi}"
        parts.append(f"WHEN {cond} THEN {O.s(name)}")
    return f"CASE {' '.join(parts)} ELSE {O.s(R.OUTSIDE)} END"


@query("io12_split_two_ranges", sqlx(f"""SELECT {_split_sql('pl2', R.TWO_WAY)} AS FAIXA, count(*) AS QUANTIDADE
FROM pl2 GROUP BY 1"""))
def io12_split_two_ranges(spark, d):
    from quorum.sources import io as IO
    df = R.split_by_type(_pl2_full(spark, d), R.TWO_WAY)
    path = IO.scratch_path(spark, "split2")
    IO.write_partitioned(df, path, ["FAIXA"])
    return spark.read.parquet(path).groupBy("FAIXA").agg(F.count(F.lit(1)).alias("QUANTIDADE"))


@query("io13_split_three_ranges", sqlx(f"""SELECT {_split_sql('pl1', R.THREE_WAY)} AS FAIXA, count(*) AS QUANTIDADE,
  count(*) FILTER (WHERE regexp_replace(trim(NUM_BENEFICIARIO), '\\.0$', '') LIKE '%.0') AS IDS_COM_DECIMAL
FROM pl1 GROUP BY 1"""))
def io13_split_three_ranges(spark, d):
    from quorum.sources import io as IO
    df = R.split_by_type(_pl1_full(spark, d), R.THREE_WAY)
    path = IO.scratch_path(spark, "split3")
    IO.write_partitioned(df, path, ["FAIXA"])
    back = spark.read.parquet(path)
    return back.groupBy("FAIXA").agg(F.count(F.lit(1)).alias("QUANTIDADE"),
                                     F.count(F.when(F.col("NUM_BENEFICIARIO").endswith(".0"), 1)).alias("IDS_COM_DECIMAL"))


# ---------------------------------------------------------------- one-group form (PL4, IO15)
_ONE_GROUP_KEYS = {g: sorted({O.fold_key_py(c) for c in cs}) for g, cs in R.ONE_GROUP_CLASSES.items()}


@query("pl4_one_group_deliveries", sqlx("\nUNION ALL\n".join(
    f"""SELECT {O.s(g)} AS GRUPO, ORIGEM, count(*) AS QUANTIDADE, CAST(count(LOCAL) AS BIGINT) AS COM_LOCAL FROM routed
WHERE {O.fold_key('CLASSIFICACAO')} IN ({', '.join(O.s(k) for k in ks)}) GROUP BY ORIGEM""" for g, ks in _ONE_GROUP_KEYS.items())))
def pl4_one_group_deliveries(spark, d):
    """The older form: every group delivered on its own, one dataset per source, by its own class lists."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "one-group")
    sources = {"avaliacoes": _pl1_full(spark, d), "negativas": _pl2_full(spark, d)}
    R.deliver_groups(sources, path, R.ONE_GROUP_CLASSES)
    return spark.read.parquet(path).groupBy("GRUPO", "ORIGEM").agg(
        F.count(F.lit(1)).alias("QUANTIDADE"), F.count("LOCAL").alias("COM_LOCAL"))


# ---------------------------------------------------------------- text functions
from quorum.functions import text as TX  # noqa: E402


@query("sc1_text_normalisers", sqlx(f"""SELECT {KEYS_SQL}, {O.strip('LOCAL')} AS SC1_STRIP, lower(LOCAL) AS SC2_LOWER,
  upper(LOCAL) AS SC2_UPPER, replace(LOCAL, chr(160), ' ') AS SC3_NBSP, {O.collapse('LOCAL')} AS SC4_COLLAPSE,
  {O.normalize('LOCAL')} AS SC5_NORMALIZE, coalesce({O.normalize('LOCAL')}, '') AS SC6_NORMALIZE_OR_EMPTY,
  {O.fold_key('LOCAL')} AS SC8_FOLD_KEY,
  regexp_replace({O.strip('TELEFONE')}, '\\.0$', '') AS SC10_DROP_DECIMAL_ZERO FROM survey"""))
def sc1_text_normalisers(spark, d):
    L = q("LOCAL")
    return S.survey(spark, d).select(
        *KEYS, TX.strip(L).alias("SC1_STRIP"), F.lower(L).alias("SC2_LOWER"), F.upper(L).alias("SC2_UPPER"),
        TX.nbsp_to_space(L).alias("SC3_NBSP"), TX.collapse_spaces(L).alias("SC4_COLLAPSE"),
        TX.normalize(L).alias("SC5_NORMALIZE"), TX.normalize_or_empty(L).alias("SC6_NORMALIZE_OR_EMPTY"),
        TX.fold_key(L).alias("SC8_FOLD_KEY"), TX.drop_decimal_zero_trimmed(q("TELEFONE")).alias("SC10_DROP_DECIMAL_ZERO"))


@query("sc7_accent_folding", sqlx(f"""SELECT DISTINCT c AS CLASSE, strip_accents(c) AS SC7_SEM_ACENTO,
  {O.fold_key('c')} AS SC8_FOLD_KEY,
  coalesce(nullif(lower(regexp_replace(regexp_replace(strip_accents(c), '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), ''), 'sem_nome') AS SC19_SLUG
FROM (SELECT {O.send_name_case('CLASSIFICACAO')} AS c FROM pl1) WHERE c IS NOT NULL"""))
def sc7_accent_folding(spark, d):
    c = q("CLASSE")
    classes = _pl1_full(spark, d).select("CLASSIFICACAO").distinct()  # a class is folded once, not in each row
    df = lookup.apply_send_names(classes).select(q("CLASSIFICACAO").alias("CLASSE")).where(c.isNotNull()).distinct()
    return df.select(c, TX.remove_accents(c).alias("SC7_SEM_ACENTO"), TX.fold_key(c).alias("SC8_FOLD_KEY"),
                     TX.slug(c).alias("SC19_SLUG"))


_DIRTY_NUM = ("case l_linenumber when 1 then ' 3 ' when 2 then 'NaN' when 3 then '1d' when 4 then cast(l_partkey as string) "
              "when 5 then '' when 6 then '2.5e1' else 'abc' end")
_DIRTY_FLAG = ("case l_linenumber when 1 then 'sim' when 2 then ' S ' when 3 then 'true' when 4 then '1' "
               "when 5 then 'YES' when 6 then 'nao' else null end")


@query("sc11_numeric_and_flags", sqlx(f"""SELECT {KEYS_SQL}, CASE WHEN regexp_full_match(trim(x), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
  THEN CAST(trim(x) AS DOUBLE) END AS SC11_NUMERO,
  coalesce(lower(trim(f)) IN ('sim', 's', 'true', '1', 'yes'), false) AS SC15_FLAG
FROM (SELECT *, {_DIRTY_NUM} AS x, {_DIRTY_FLAG} AS f FROM survey)"""))
def sc11_numeric_and_flags(spark, d):
    df = S.survey(spark, d).select(*KEYS, F.expr(_DIRTY_NUM).alias("x"), F.expr(_DIRTY_FLAG).alias("f"))
    return df.select(*KEYS, TX.to_number(q("x")).alias("SC11_NUMERO"), TX.flag(q("f")).alias("SC15_FLAG"))


# ---------------------------------------------------------------- FI10 ad-hoc filter
_FI10 = dict(especialidade="small", tipo_diferente=6, local_diferente="gear")


@query("fi10_adhoc_filter", sqlx("""SELECT TIPO, CONTRATACAO, LOCAL, ESPECIALIDADE, CLASSIFICACAO FROM classified
WHERE NOT coalesce(TIPO = 6, false) AND coalesce(contains(lower(trim(ESPECIALIDADE)), 'small'), false)
  AND NOT coalesce(contains(lower(trim(LOCAL)), 'gear'), false)"""))
def fi10_adhoc_filter(spark, d):
    from quorum.functions.predicates import adhoc_filter
    return adhoc_filter(_classified(spark, d), **_FI10)


# ---------------------------------------------------------------- PL5 legacy one-shot
@query("pl5_legacy_score_contract", sqlx(f"""SELECT t.{KEYS_SQL.replace(', ', ', t.')}, t."NOTA GERAL", t."Quantidade notas validas",
  CASE WHEN t."Quantidade notas validas" > 0 THEN c.CONTRATACAO END AS CONTRATACAO
FROM ({O.scored('survey')}) t JOIN contracted c USING ({KEYS_SQL})"""))
def pl5_legacy_score_contract(spark, d):
    from quorum.plans.legacy import legacy_score_contract
    out = legacy_score_contract(S.survey(spark, d), S.contract_sheet(spark, d))
    return out.select(*KEYS, q("NOTA GERAL"), q(score.VALID), "CONTRATACAO")


# ---------------------------------------------------------------- IO1/IO2/IO5 round trip
@query("io1_csv_roundtrip", sqlx(f"""SELECT {KEYS_SQL}, regexp_replace(NUM_BENEFICIARIO, '(\\d)\\.0$', '\\1') AS NUM_BENEFICIARIO,
  LOCAL, CAST(TIPO AS BIGINT) AS TIPO, CAST(NOTA5 AS DOUBLE) AS NOTA5, CLASSIFICACAO FROM survey"""))
def io1_csv_roundtrip(spark, d):
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "survey-csv")
    cols = KEYS + ["NUM_BENEFICIARIO", "LOCAL", "TIPO", "NOTA5", "CLASSIFICACAO"]
    IO.write_survey_csv(S.survey(spark, d).select(*cols), path)
    back = IO.read_survey_csv(spark, path, strict_ints=False)
    return back.select(*[F.col(k).cast("long" if k != "l_linenumber" else "int").alias(k) for k in KEYS],
                       "NUM_BENEFICIARIO", "LOCAL", "TIPO", "NOTA5", "CLASSIFICACAO")


@query("io5_raw_text_ids", sqlx("""SELECT count(*) FILTER (WHERE NUM_BENEFICIARIO LIKE '%.0') AS NUM_BENEFICIARIO_COM_DECIMAL,
  count(*) FILTER (WHERE TELEFONE LIKE '%.0') AS TELEFONE_COM_DECIMAL, count(*) FILTER (WHERE LOCAL IS NULL) AS LOCAL_VAZIO
FROM survey"""))
def io5_raw_text_ids(spark, d):
    """IO5 + DQ4: ids kept as raw text (no null tokens, no overlay) and the
    '.0' check over them."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "raw-csv")
    (S.survey(spark, d).select("NUM_BENEFICIARIO", "TELEFONE", "LOCAL").write.option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    raw = IO.read_raw_text(spark, path)
    return raw.agg(F.count(F.when(F.col("NUM_BENEFICIARIO").endswith(".0"), 1)).alias("NUM_BENEFICIARIO_COM_DECIMAL"),
                   F.count(F.when(F.col("TELEFONE").endswith(".0"), 1)).alias("TELEFONE_COM_DECIMAL"),
                   F.count(F.when(F.col("LOCAL") == "", 1)).alias("LOCAL_VAZIO"))


# ---------------------------------------------------------------- data quality (DQ3-DQ13)
from quorum.operators import quality as DQ  # noqa: E402

_DIRTY_SCORE = ("case l_linenumber when 1 then ' 3 ' when 2 then 'abc' when 3 then '  ' when 4 then '' "
                "when 5 then '7' else cast(NOTA1 as string) end")
_SCORES = ["NOTA1", "NOTA2", "NOTA3", "NOTA4", "NOTA5"]


_DQ3_SQL = f"""SELECT {KEYS_SQL}, COLUNA, VALOR, MOTIVO FROM (
  SELECT *, TRY_CAST(VALOR AS DOUBLE) AS x FROM (
    SELECT {KEYS_SQL}, COLUNA, trim(VALOR) AS VALOR FROM (UNPIVOT (SELECT {KEYS_SQL}, {_DIRTY_SCORE} AS NOTA1,
        CAST(NOTA2 AS VARCHAR) AS NOTA2, CAST(NOTA3 AS VARCHAR) AS NOTA3, CAST(NOTA4 AS VARCHAR) AS NOTA4,
        CAST((NOTA5 + l_linenumber / 10.0)::DOUBLE AS VARCHAR) AS NOTA5 FROM survey)
      ON NOTA1, NOTA2, NOTA3, NOTA4, NOTA5 INTO NAME COLUNA VALUE VALOR)) WHERE VALOR <> '') v,
  LATERAL (SELECT unnest(list_filter([CASE WHEN v.x IS NULL THEN 'valor nao numerico' END,
    CASE WHEN v.x <> floor(v.x) THEN 'valor numerico nao inteiro' END,
    CASE WHEN v.x < 1 OR v.x > 5 THEN 'valor fora do intervalo 1 a 5' END], lambda m: m IS NOT NULL)) AS MOTIVO)"""


@query("dq3_score_violations", sqlx(_DQ3_SQL))
def dq3_score_violations(spark, d):
    # NOTA5 is shifted by l_linenumber/10 so that non-integer and out-of-range values occur, also both
    # at once; NOTA1 holds text and blanks
    sv = S.survey(spark, d).withColumns({"NOTA5": (q("NOTA5") + q("l_linenumber") / 10.0).cast("double"), "NOTA1": F.expr(_DIRTY_SCORE)})
    return DQ.score_violations(sv, _SCORES, KEYS)


@query("dq5_allowed_contract_values", sqlx("""SELECT CONTRATACAO, count(*) AS QUANTIDADE FROM contracted
WHERE CONTRATACAO IS NOT NULL AND CONTRATACAO NOT IN ('rede propria') GROUP BY 1"""))
def dq5_allowed_contract_values(spark, d):
    return DQ.not_in_allowed(_contracted(spark, d), "CONTRATACAO", ["rede propria"])


def _faulty_output(spark, d):
    """The scored output with wrong and empty contracts and with ids and phones as they came in."""
    wrong = F.when(q("l_linenumber") == 3, "outra").when(q("l_linenumber") != 4, q("CONTRATACAO"))
    return _pl1_full(spark, d).withColumn("CONTRATACAO", wrong)


_SQL_FAULTY = """SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN 'outra' WHEN l_linenumber = 4 THEN NULL ELSE CONTRATACAO END AS CONTRATACAO) FROM pl1"""
_SHOWN = 20


def _first_sql(found: str, order: str, columns: str) -> str:
    """The first violations per check with a count of the others, by plain windows."""
    return f"""SELECT CHECAGEM, {columns}, VALOR, ESPERADO, POSICAO, NULL::BIGINT AS RESTANTES FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY CHECAGEM ORDER BY {order}) AS INTEGER) AS POSICAO FROM ({found})) WHERE POSICAO <= {_SHOWN}
UNION ALL BY NAME SELECT CHECAGEM, {_SHOWN + 1} AS POSICAO, count(*) - {_SHOWN} AS RESTANTES FROM ({found}) GROUP BY 1 HAVING count(*) > {_SHOWN}"""


_CONTRACT_DIM_SQL = f"""SELECT lower({O.strip('Local')}) AS k, arg_min(lower({O.strip('contratacao')}), _ord) AS v FROM contract_sheet GROUP BY 1"""
_OUTPUT_FOUND_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS CHECAGEM, {KEYS_SQL}, {value} AS VALOR, {expected} AS ESPERADO FROM faulty LEFT JOIN dim ON lower(LOCAL) IS NOT DISTINCT FROM dim.k WHERE {cond}"
    for name, value, expected, cond in (
        ("id com .0", "NUM_BENEFICIARIO", "NULL::VARCHAR", "NUM_BENEFICIARIO LIKE '%.0'"),
        ("telefone com .0", "TELEFONE", "NULL::VARCHAR", "TELEFONE LIKE '%.0'"),
        ("contratacao invalida", "CONTRATACAO", "NULL::VARCHAR", "coalesce(CONTRATACAO, '') NOT IN ('', 'rede propria', 'rede credenciada')"),
        ("sem correspondencia", "lower(LOCAL)", "NULL::VARCHAR", "coalesce(v, '') = ''"),
        ("divergente", "coalesce(CONTRATACAO, '')", "v", "coalesce(v, '') <> '' AND coalesce(CONTRATACAO, '') <> v")))


@query("dq4_output_violations", S.with_views(_first_sql(_OUTPUT_FOUND_SQL, ", ".join(S.ORDER_COLUMNS) + ", VALOR", KEYS_SQL),
                                             *STAGES, ("faulty", _SQL_FAULTY), ("dim", _CONTRACT_DIM_SQL)))
def dq4_output_violations(spark, d):
    """DQ4, DQ5 and DQ7 as rows: all checks in one scan of the output, the first 20 of each and how many more."""
    dim = ag16_contract_dimension(spark, d)
    j = _faulty_output(spark, d).withColumn("__k", F.lower(q("LOCAL"))).join(
        dim.withColumnRenamed("contratacao", "__v"), F.col("__k").eqNullSafe(F.col("LOCAL_COMPARACAO")), "left")
    found, expected = F.coalesce(q("CONTRATACAO"), F.lit("")), F.nullif(F.col("__v"), F.lit(""))
    checks = {
        "id com .0": (q("NUM_BENEFICIARIO").endswith(".0"), q("NUM_BENEFICIARIO"), None),
        "telefone com .0": (q("TELEFONE").endswith(".0"), q("TELEFONE"), None),
        "contratacao invalida": (~found.isin("", "rede propria", "rede credenciada"), found, None),
        "sem correspondencia": (expected.isNull(), F.col("__k"), None),
        "divergente": (expected.isNotNull() & (found != expected), found, expected)}
    rows = PL.step_table(DQ.violations(j, KEYS, checks), "violations")
    return DQ.first_violations(rows, [F.col(c) for c in (*S.ORDER_COLUMNS, "VALOR")], _SHOWN)


_SHEET_FOUND_SQL = f"""SELECT 'chave vazia' AS CHECAGEM, _ord AS LINHA, k AS CHAVE, v AS VALOR, NULL::VARCHAR AS ESPERADO FROM sheet WHERE k = ''
UNION ALL SELECT 'valor invalido', _ord, k, v, NULL FROM sheet WHERE v NOT IN ('', 'rede propria')
UNION ALL SELECT DISTINCT 'valores conflitantes', NULL::BIGINT, k, v, NULL FROM (
  SELECT k, v, count(DISTINCT v) OVER (PARTITION BY k) AS n FROM sheet WHERE k <> '' AND v <> '') WHERE n > 1"""


@query("dq6_sheet_violations", S.with_views(_first_sql(_SHEET_FOUND_SQL, "LINHA NULLS FIRST, CHAVE, VALOR", "LINHA, CHAVE"), *STAGES, (
    "sheet", f"SELECT _ord, coalesce(lower({O.strip('Local')}), '') AS k, coalesce(lower({O.strip('contratacao')}), '') AS v FROM contract_sheet")))
def dq6_sheet_violations(spark, d):
    """DQ6 as rows: blank keys, values that are not allowed, conflicting keys' values."""
    sheet = S.contract_sheet(spark, d)
    found = DQ.sheet_violations(sheet, F.col("_ord").cast("long"), F.lower(TX.strip(q("Local"))), F.lower(TX.strip(q("contratacao"))), ["rede propria"])
    return DQ.first_violations(PL.step_table(found, "sheet-violations"), [F.col(c) for c in ("LINHA", "CHAVE", "VALOR")], _SHOWN)


_LINES_SQL = f"""SELECT MES, 1 + row_number() OVER (PARTITION BY MES ORDER BY {", ".join(S.ORDER_COLUMNS)}) AS LINHA, *
  EXCLUDE (MES) FROM survey"""


@query("an4_violation_lines", S.with_views(f"""SELECT concat('MES=', MES) AS ARQUIVO, LINHA, COLUNA, VALOR, MOTIVO FROM (
  SELECT * FROM ({_DQ3_SQL}) JOIN (SELECT {KEYS_SQL}, MES, LINHA FROM lines) USING ({KEYS_SQL}))
UNION ALL SELECT concat('MES=', MES), LINHA, 'TELEFONE', TELEFONE, 'terminando em .0' FROM lines WHERE TELEFONE LIKE '%.0'""",
    ("lines", _LINES_SQL)))
def an4_violation_lines(spark, d):
    """DQ3 and DQ4 over a monthly CSV delivery, by file and line (AN4)."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "monthly-csv")
    rows = S.survey(spark, d).withColumns({"NOTA5": (q("NOTA5") + q("l_linenumber") / 10.0).cast("double"), "NOTA1": F.expr(_DIRTY_SCORE)})
    (rows.select(*KEYS, "MES", "TELEFONE", *_SCORES).repartition("MES").sortWithinPartitions("MES", *S.ORDER_COLUMNS)
     .write.partitionBy("MES").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    read = IO.read_raw_text(spark, path, line_numbers=True)
    folder = F.regexp_extract(IO.FILE, "MES=[0-9]+", 0).alias(IO.FILE)
    scores = DQ.score_violations(read, _SCORES, [IO.FILE, IO.LINE]).select(folder, IO.LINE, "COLUNA", "VALOR", "MOTIVO")
    ids = read.where(q("TELEFONE").endswith(".0")).select(
        folder, IO.LINE, F.lit("TELEFONE").alias("COLUNA"), q("TELEFONE").alias("VALOR"), F.lit("terminando em .0").alias("MOTIVO"))
    return scores.unionByName(ids)


@query("dq6_lookup_validity", sqlx(f"""SELECT * FROM (VALUES
  ('CHAVES_VAZIAS', (SELECT count(*) FROM contract_sheet WHERE coalesce(lower({O.strip('Local')}), '') = '')),
  ('VALORES_INVALIDOS', (SELECT count(*) FROM contract_sheet WHERE lower({O.strip('contratacao')}) IS NULL
     OR lower({O.strip('contratacao')}) NOT IN ('rede propria', 'rede credenciada'))),
  ('CHAVES_CONFLITANTES', (SELECT count(*) FROM (SELECT lower({O.strip('Local')}) AS k FROM contract_sheet
     WHERE coalesce(lower({O.strip('Local')}), '') <> '' GROUP BY 1
     HAVING count(DISTINCT lower({O.strip('contratacao')})) > 1)))) AS t(MEDIDA, VALOR)"""))
def dq6_lookup_validity(spark, d):
    sh = S.contract_sheet(spark, d)
    return DQ.lookup_validity(sh, F.lower(TX.strip(q("Local"))), F.lower(TX.strip(q("contratacao"))),
                              ["rede propria", "rede credenciada"])


@query("dq7_contract_vs_lookup", sqlx(f"""SELECT
  count(*) FILTER (WHERE d.v IS NULL) AS SEM_CORRESPONDENCIA,
  count(*) FILTER (WHERE d.v IS NOT NULL AND p.c IS DISTINCT FROM d.v) AS DIVERGENTES
FROM (SELECT LOCAL, CASE WHEN l_linenumber = 3 THEN 'outra' WHEN l_linenumber = 4 THEN NULL ELSE CONTRATACAO END AS c FROM pl1) p LEFT JOIN (SELECT lower({O.strip('Local')}) AS k, arg_min(lower({O.strip('contratacao')}), _ord) AS v
  FROM contract_sheet GROUP BY 1) d ON lower(p.LOCAL) IS NOT DISTINCT FROM d.k"""))
def dq7_contract_vs_lookup(spark, d):
    # Some outputs are made wrong or empty, so that there is something to find.
    dim = ag16_contract_dimension(spark, d)
    wrong = F.when(q("l_linenumber") == 3, "outra").when(q("l_linenumber") != 4, q("CONTRATACAO"))
    return DQ.output_vs_lookup(_pl1_full(spark, d).withColumn("CONTRATACAO", wrong), dim, F.lower(q("LOCAL")), "CONTRATACAO",
                               "LOCAL_COMPARACAO", "contratacao")


@query("dq8_row_counts", sqlx("""SELECT * FROM (VALUES ('entrada', (SELECT count(*) FROM survey)),
  ('limpa', (SELECT count(*) FROM cleaned)), ('saida', (SELECT count(*) FROM pl1)),
  ('negativas_entrada', (SELECT count(*) FROM negativas)), ('negativas_saida', (SELECT count(*) FROM pl2)))
  AS t(TABELA, LINHAS)"""))
def dq8_row_counts(spark, d):
    # Both sources of the fixture are the same rows, so one scan counts what goes in and what cleaning keeps.
    scored = score.count_valid_scores(S.survey(spark, d))
    sources = {"entrada": F.lit(True), "limpa": q(score.VALID) > 0, "negativas_entrada": F.lit(True)}
    return DQ.row_counts({"fontes": (scored, sources), "saida": _pl1_full(spark, d), "negativas_saida": _pl2_full(spark, d)})


_FAULTY_COUNT = 'CASE WHEN l_linenumber = 2 THEN 9 ELSE "Quantidade notas validas" END'
_FAULTY_MEAN = 'CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 5.5 ELSE "NOTA GERAL" END'


@query("dq9_score_recheck", sqlx(f"""SELECT count(*) AS LINHAS,
  count(*) FILTER (WHERE n IS DISTINCT FROM len(s)) AS CONTAGEM_DIVERGENTE,
  count(*) FILTER (WHERE m IS DISTINCT FROM {O.round2('list_avg(s)')}) AS MEDIA_DIVERGENTE,
  count(*) FILTER (WHERE m < 1 OR m > 5) AS MEDIA_FORA_1_A_5
FROM (SELECT list_filter([CAST(NOTA1 AS DOUBLE), CAST(NOTA2 AS DOUBLE), CAST(NOTA3 AS DOUBLE), CAST(NOTA4 AS DOUBLE), NOTA5],
    lambda x: x IS NOT NULL) AS s, {_FAULTY_COUNT} AS n, CAST({_FAULTY_MEAN} AS DOUBLE) AS m FROM pl1)"""))
def dq9_score_recheck(spark, d):
    # Stored counts and means with faults, so that the check has something to find.
    line = q("l_linenumber")
    df = _pl1_full(spark, d).withColumns({
        score.VALID: F.when(line == 2, F.lit(9)).otherwise(q(score.VALID)).cast("long"),
        "NOTA GERAL": F.when(line == 4, F.lit(5.5)).when(line != 3, q("NOTA GERAL"))})
    return DQ.score_recheck(df, _SCORES, score.VALID, "NOTA GERAL")


@query("dq10_summary_totals", sqlx("""SELECT 'total_rede_propria' AS CAMPO, n AS ESPERADO, n + 1 AS ENCONTRADO
FROM (SELECT count(*) AS n FROM contracted WHERE CONTRATACAO = 'rede propria')
UNION ALL SELECT 'total_sem_contratacao', n, NULL FROM (SELECT count(*) AS n FROM contracted WHERE CONTRATACAO IS NULL)"""))
def dq10_summary_totals(spark, d):
    """A written summary with two faults, read back and held against the data."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "resumo-conferido")
    one = F.lit(1).cast("long")
    IO.write_summary_json(ag6_contract_totals(spark, d).select(
        (F.col("total_rede_propria") + one).alias("total_rede_propria"), "total_rede_credenciada"), path)
    return DQ.summary_divergences(spark.read.json(path), ag6_contract_totals(spark, d))


@query("dq12_rule_audit_complete", sqlx("""SELECT CAST(count(*) FILTER (WHERE k = 2) AS BIGINT) AS REGRAS_SEM_AUDITORIA,
  CAST(count(*) FILTER (WHERE k = 9) AS BIGINT) AS AUDITORIAS_SEM_REGRA,
  CAST(count(*) FILTER (WHERE k IN (4, 6)) AS BIGINT) AS CHAVES_OU_NOMES_DIFERENTES FROM """ + O.rule_meta_values()))
def dq12_rule_audit_complete(spark, d):
    """A written audit with a missing rule, an unknown one, a wrong key and a lost name, against the rule list."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "auditoria-conferida")
    k = F.col("ORDEM_REGRA")
    audit = rules.class_rule_audit(_contracted(spark, d)).where(k != 2)
    extra = audit.where(k == 9).withColumn("ORDEM_REGRA", F.lit(99))
    faulty = audit.unionByName(extra).withColumns({
        "CHAVE_GRUPO": F.when(k == 4, F.lit("OUTRA")).otherwise(F.col("CHAVE_GRUPO")),
        "CLASSIFICACAO": F.when(k != 6, F.col("CLASSIFICACAO"))})
    IO.write_partitioned(faulty, path, [])
    return DQ.audit_completeness(spark.read.parquet(path), rules.rule_table(spark))


@query("dq13_side_tables_agree", sqlx("""SELECT * FROM (VALUES
  ('TOTAL_NAO_CLASSIFICADAS', (SELECT count(*) FROM classified WHERE coalesce(CLASSIFICACAO, '') = '')),
  ('LINHAS_DETALHE', (SELECT count(*) FROM classified WHERE coalesce(CLASSIFICACAO, '') = '' AND l_linenumber <> 5)),
  ('SOMA_POR_LOCAL', (SELECT count(*) FROM classified WHERE coalesce(CLASSIFICACAO, '') = ''))) AS t(MEDIDA, VALOR)"""))
def dq13_side_tables_agree(spark, d):
    """The total from the data against the written side tables, of which the detail lost rows."""
    from quorum.sources import io as IO
    classified = PL.step_table(_classified(spark, d), "classified")
    path = IO.scratch_path(spark, "nao-classificados")
    detail = rules.unclassified(classified)
    IO.write_partitioned(detail.where(q("l_linenumber") != 5), f"{path}/detalhe", [])
    IO.write_partitioned(SM.frequency(detail, "LOCAL"), f"{path}/por_local", [])
    total = classified.agg(F.count(F.when(is_blank(q("CLASSIFICACAO")), 1)).alias("TOTAL_NAO_CLASSIFICADAS"))
    lines = spark.read.parquet(f"{path}/detalhe").agg(F.count(F.lit(1)).alias("LINHAS_DETALHE"))
    by_place = spark.read.parquet(f"{path}/por_local").agg(F.sum("QUANTIDADE").cast("long").alias("SOMA_POR_LOCAL"))
    return DQ.measures(total).unionByName(DQ.measures(lines)).unionByName(DQ.measures(by_place))


@query("dq13_edited_side_tables", sqlx("""SELECT * FROM (VALUES
  ('TOTAL_ATUALIZADOS', (SELECT count(*) FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'atualizado')),
  ('SOMA_ATUALIZADOS', (SELECT count(*) FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'atualizado' AND CONTRATACAO = 'rede propria'
     AND LOCAL IS NOT NULL)),
  ('TOTAL_NAO_ENCONTRADOS', (SELECT count(*) FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'nao_encontrado')),
  ('SOMA_NAO_ENCONTRADOS', (SELECT count(*) FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'nao_encontrado')),
  ('TOTAL_NAO_ALTERADOS', (SELECT count(*) FROM edited_act WHERE ACAO_LOCAL_EDITADO = 'nao_alterado'))) AS t(MEDIDA, VALOR)"""))
def dq13_edited_side_tables(spark, d):
    """Updated and not found places: totals from the rows against the written side tables, of which one lost a contract."""
    from quorum.sources import io as IO
    rows = PL.step_table(_edited_action(spark, d), "edited-action")
    path, act = IO.scratch_path(spark, "local-editado"), q("ACAO_LOCAL_EDITADO")
    updated = SM.multi_frequency(rows.where(act == "atualizado"), ["LOCAL", "LOCAL EDITADO", "CONTRATACAO"])
    IO.write_summary_csv(updated.where(q("CONTRATACAO") == "rede propria"), f"{path}/atualizados")
    IO.write_summary_csv(SM.frequency(rows.where(act == "nao_encontrado"), "LOCAL"), f"{path}/nao_encontrados")
    totals = {f"TOTAL_{a.upper()}": act == v for a, v in (("atualizados", "atualizado"), ("nao_encontrados", "nao_encontrado"), ("nao_alterados", "nao_alterado"))}
    sums = [IO.read_csv_columns(spark, f"{path}/{name}", ["QUANTIDADE"]).agg(
        F.coalesce(F.sum(F.col("QUANTIDADE").cast("long")), F.lit(0)).alias(f"SOMA_{name.upper()}")) for name in ("atualizados", "nao_encontrados")]
    out = DQ.measures(SM.conditional_totals(rows, totals))
    for one in sums:
        out = out.unionByName(DQ.measures(one))
    return out


#: Rules that filter on the operator of the moment and on the rule that set it, beside plain ones.
STATE_RULES = [
    ("TELECONSULTA", False, [("CLASSIFICACAO", "contem", "tele")], "tele"),
    ("REDE CREDENCIADA", False, [("CLASSIFICACAO", "contem", "cred")], "cred"),
    ("NDI MG", False, [("UF", "igual", "MG")], "uf mg"),
    ("PROMED", False, [("OPERADORA", "igual", "NDI MG"), ("LOCAL EDITADO", "contem", "Venda Nova")], "venda nova"),
    ("PROMED", False, [("_REGRA_OPERADORA", "igual", "uf mg"), ("LOCAL EDITADO", "contem", "raja")], "raja"),
    ("CCG", True, [("UF", "igual", "RS")], "rs vazia"),
    ("REDE SP", False, [("OPERADORA", "diferente", "TELECONSULTA"), ("UF", "igual", "SP"), ("OPERADORA", "nao_vazio", None)], "sp com operadora"),
    ("SEM REGRA", False, [("_REGRA_OPERADORA", "vazio", None), ("CONTRATACAO", "nao_contem", "credenciada")], "sem regra"),
    ("HAPVIDA", True, [], "fecha"),
]


def _state_sheet(spark):
    rows = []
    for k, (op, fill, filters, name) in enumerate(STATE_RULES, start=1):
        three = [x for f in (*filters, *[(None, None, None)] * (3 - len(filters))) for x in f]
        rows.append((op, "sim" if fill else "nao", *three, str(k), "sim", name, k))
    from quorum.config import operator as oc
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in oc.V2_SHEET_COLUMNS) + ", _ord long")


def _state_rules_sql() -> str:
    """The rules one after the other, each in a query of its own over the state that the one before left."""
    src = """SELECT *, '' AS __rule, ''::VARCHAR AS __op FROM opprep"""
    for k, (op, fill, filters, name) in enumerate(STATE_RULES, start=1):
        conds = ["__op = ''"] if fill else []
        for column, comparator, value in filters:
            c = {"OPERADORA": "__op", "_REGRA_OPERADORA": "__rule"}.get(column, f"coalesce({O.normalize(O.qi(column))}, '')")
            conds.append({"igual": f"{c} = {O.s(value)}", "diferente": f"{c} <> {O.s(value)}", "vazio": f"{c} = ''", "nao_vazio": f"{c} <> ''",
                          "contem": f"contains(upper({c}), upper({O.s(value)}))", "nao_contem": f"NOT contains(upper({c}), upper({O.s(value)}))"}[comparator])
        hit = " AND ".join(conds) or "true"
        src = f"""SELECT * REPLACE (CASE WHEN __h{k} THEN {O.s(op)} ELSE __op END AS __op, CASE WHEN __h{k} THEN {O.s(name)} ELSE __rule END AS __rule),
  __h{k} AND __op = '' AS __b{k} FROM (SELECT *, ({hit}) AS __h{k} FROM ({src}))"""
    return src


@query("ru14_state_rules", S.with_views(f"SELECT {KEYS_SQL}, __op AS OPERADORA, __rule AS REGRA FROM ({_state_rules_sql()})",
                                        *STAGES, ("opprep", _opprep_sql(True))))
def ru14_state_rules(spark, d):
    """FI12/FI13 on the state: rules that filter on OPERADORA and on the rule that set it."""
    out = operator_rules.assign_operator_v2(_edited(spark, d), _state_sheet(spark), keep_rule=True)
    return out.select(*KEYS, "OPERADORA", q(operator_rules.RULE_COL).alias("REGRA"))


_STATE_COUNTS = " UNION ALL ".join(
    f"SELECT {k} AS ORDEM, {O.s(rule[-1])} AS REGRA, count(*) FILTER (WHERE __h{k}) AS TOTAL_ATINGIDAS, count(*) FILTER (WHERE __b{k}) AS TOTAL_VAZIAS, "
    f"count(*) FILTER (WHERE __h{k} AND NOT __b{k}) AS TOTAL_SOBRESCRITAS FROM folded" for k, rule in enumerate(STATE_RULES, start=1))


@query("ru14_state_rules_audit", S.with_views(_STATE_COUNTS, *STAGES, ("opprep", _opprep_sql(True)), ("folded", _state_rules_sql())))
def ru14_state_rules_audit(spark, d):
    return operator_rules.operator_v2_audit(_edited(spark, d), _state_sheet(spark)).drop("OPERADORA_APLICADA", "APLICAR_SOMENTE_VAZIOS")


# ---------------------------------------------------------------- operator rules v2 (RU12-RU17)
def _ru13_sql() -> str:
    """Rule-sheet load + validation written in SQL over the same sheet."""
    from quorum.config import operator as oc
    from quorum.operators.operator_rules import v2_fixed_rows

    def lit(v):
        return "NULL::VARCHAR" if v is None else O.s(v)
    broken = ("X", "nao", "COLUNA_INEXISTENTE", "parecido", None, None, None, None, None, None, None, "x", "sim",
              "regra com problemas", 7)
    vals = ", ".join("(" + ", ".join([lit(x) for x in r[:-1]] + [f"{r[-1]}::BIGINT"]) + ")"
                     for r in v2_fixed_rows() + [broken])
    cols = list(oc.V2_SHEET_COLUMNS) + ["_ord"]
    n = len(oc.OPERATOR_RULES)
    units = f"""SELECT 'NDI SP E RJ', 'nao', 'LOCAL EDITADO', 'igual', k, NULL, NULL, NULL, NULL, NULL, NULL,
  '{n + 5}', 'sim', concat('LOCAL EDITADO igual a ', k), 1000000::BIGINT
  FROM (SELECT DISTINCT upper({O.normalize('UNIDADE')}) AS k FROM unit_sheet WHERE UNIDADE IS NOT NULL)"""
    sheet = f"SELECT * FROM (VALUES {vals}) AS t({', '.join(cols)}) UNION ALL {units}"
    nz = lambda c: f"coalesce({O.normalize(c)}, '')"
    flag = lambda c: f"coalesce(lower(trim({c})) IN ('sim', 's', 'true', '1', 'yes'), false)"
    num = "CASE WHEN regexp_full_match(trim(ORDEM), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN CAST(trim(ORDEM) AS DOUBLE) END"
    texts = {"descricao": "DESCRICAO", "operadora": "OPERADORA", "coluna_1": "COLUNA_FILTRO_1",
             "comparador_1": "COMPARADOR_1", "valor_1": "VALOR_1", "coluna_2": "COLUNA_FILTRO_2",
             "comparador_2": "COMPARADOR_2", "valor_2": "VALOR_2", "coluna_3": "COLUNA_FILTRO_3",
             "comparador_3": "COMPARADOR_3", "valor_3": "VALOR_3"}
    sel = ", ".join(f"{'upper(' + nz(c) + ')' if a == 'operadora' else nz(c)} AS {a}" for a, c in texts.items())
    r = f"SELECT _ord, {num} AS ordem, {sel} FROM ({sheet}) WHERE {flag('STATUS_ATIVO')}"
    base = [a for a, _ in S.SURVEY_EXPRS] + ["CONTRATACAO", "LOCAL EDITADO"]
    base_sql = ", ".join(O.s(c) for c in base)
    comps = ", ".join(O.s(c) for c in oc.V2_COMPARATORS)
    parts = [f"SELECT _ord, 0 AS slot, 'ordem vazia ou invalida' AS problema FROM r WHERE ordem IS NULL",
             f"SELECT _ord, 0, 'operadora vazia' FROM r WHERE operadora = ''"]
    for k in (1, 2, 3):
        c, o, v = f"coluna_{k}", f"comparador_{k}", f"valor_{k}"
        used = f"({c} <> '' OR {o} <> '' OR {v} <> '')"
        parts += [f"SELECT _ord, {k}, {m} FROM r WHERE {used} AND {w}" for m, w in (
            ("'coluna vazia'", f"{c} = ''"),
            (f"concat('coluna inexistente ', {c})", f"{c} <> '' AND {c} NOT IN ({base_sql})"),
            (f"concat('comparador invalido ', {o})", f"{c} <> '' AND {o} NOT IN ({comps})"),
            ("'comparador sem valor'", f"{c} <> '' AND {o} NOT IN ('vazio', 'nao_vazio') AND {v} = ''"))]
    return S.with_views(" UNION ALL ".join(parts), ("r", r))


def _v2_sheet(spark, d):
    return operator_rules.default_v2_rule_table(spark, S.unit_sheet(spark, d))


@query("ru14_operator_v2", sqlx(f"""SELECT {KEYS_SQL}, "LOCAL EDITADO", UF, OPERADORA FROM ({O.operated('edited', v2=True)})"""))
def ru14_operator_v2(spark, d):
    out = operator_rules.assign_operator_v2(_edited(spark, d), _v2_sheet(spark, d))
    return out.select(*KEYS, q("LOCAL EDITADO"), "UF", "OPERADORA")


@query("ru16_blank_before_closing", sqlx(f"""SELECT count(*) AS LINHAS_VAZIAS_ANTES_DO_FECHAMENTO
FROM ({O.operated('edited', v2=True)}) WHERE OPERADORA = 'HAPVIDA'"""))
def ru16_blank_before_closing(spark, d):
    out = operator_rules.assign_operator_v2(_edited(spark, d), _v2_sheet(spark, d), snapshot_col="__snap")
    return out.agg(F.count(F.when(F.col("__snap"), 1)).alias("LINHAS_VAZIAS_ANTES_DO_FECHAMENTO"))


@query("ru14_operator_v2_audit", S.with_views(_op_audit_sql(True), *STAGES, ("opprep", _opprep_sql(True))))
def ru14_operator_v2_audit(spark, d):
    return operator_rules.operator_v2_audit(_edited(spark, d), _v2_sheet(spark, d))


@query("ru17_operator_v2_overwrite_log")
def ru17_operator_v2_overwrite_log(spark, d):
    return operator_rules.operator_v2_overwrite_log(_edited(spark, d), _v2_sheet(spark, d))


@query("ru17_operator_overwrite_log", S.with_views(_op_overwrite_log_sql(), *STAGES, ("opprep", _opprep_sql())))
def ru17_operator_overwrite_log(spark, d):
    df, us = _operated_frame(spark, d)
    return operator_rules.operator_overwrite_log(df, us)


@query("ru13_rule_validation", _ru13_sql())
def ru13_rule_validation(spark, d):
    """Violations of the v2 rule sheet plus one deliberately broken row
    (unknown column, bad comparator, missing value)."""
    sheet = _v2_sheet(spark, d)
    broken = spark.createDataFrame(
        [("X", "nao", "COLUNA_INEXISTENTE", "parecido", None, None, None, None, None, None, None, "x", "sim",
          "regra com problemas", 7)], sheet.schema)
    rules_t = operator_rules.load_rule_table(sheet.unionByName(broken))
    return operator_rules.validate_rule_table(rules_t, _edited(spark, d).columns)


# ---------------------------------------------------------------- top-k / first-n reports (SO5-SO7)
@query("so5_top_places_without_contract", sqlx("""SELECT coalesce(LOCAL, 'VAZIO') AS LOCAL, count(*) AS QUANTIDADE
FROM contracted WHERE CONTRATACAO IS NULL GROUP BY 1 ORDER BY QUANTIDADE DESC, LOCAL ASC LIMIT 50"""))
def so5_top_places_without_contract(spark, d):
    df = _contracted(spark, d).where(q("CONTRATACAO").isNull())
    return SM.top(SM.frequency(df, "LOCAL"), 50, ["LOCAL"])


@query("so6_top_rules", sqlx(f"""SELECT ORDEM_REGRA, CHAVE_GRUPO, TOTAL_ATINGIDAS FROM (
{_audit_sql(f"({O.class_prep('contracted')})")}) ORDER BY TOTAL_ATINGIDAS DESC, ORDEM_REGRA ASC LIMIT 10"""))
def so6_top_rules(spark, d):
    a = rules.class_rule_audit(_contracted(spark, d))
    return a.orderBy(F.col("TOTAL_ATINGIDAS").desc(), "ORDEM_REGRA").limit(10).select(
        "ORDEM_REGRA", "CHAVE_GRUPO", "TOTAL_ATINGIDAS")


@query("so6_top_overwrites", sqlx(f"""SELECT ORDEM_REGRA_ANTERIOR, ORDEM_REGRA_NOVA, QUANTIDADE FROM (
{_label_sql(_events_sql(f"({O.class_prep('contracted', _overwriting_rules())})", _overwriting_rules(), True))})
ORDER BY QUANTIDADE DESC, ORDEM_REGRA_NOVA ASC, ORDEM_REGRA_ANTERIOR ASC LIMIT 20"""))
def so6_top_overwrites(spark, d):
    a = rules.class_overwrite_audit(_contracted(spark, d), _overwriting_rules())
    return a.orderBy(F.col("QUANTIDADE").desc(), "ORDEM_REGRA_NOVA", "ORDEM_REGRA_ANTERIOR").limit(20).select(
        "ORDEM_REGRA_ANTERIOR", "ORDEM_REGRA_NOVA", "QUANTIDADE")


@query("so7_first_violations", sqlx(f"""SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) AS CHAVE, COLUNA, MOTIVO
FROM ({_DQ3_SQL}) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, COLUNA, MOTIVO LIMIT 20)
UNION ALL SELECT 'RESTANTES', NULL, CAST(greatest(count(*) - 20, 0) AS VARCHAR) FROM ({_DQ3_SQL})"""))
def so7_first_violations(spark, d):
    v = dq3_score_violations(spark, d)
    head, rest = SM.first_with_remainder(v, 20, [F.col(c) for c in (*S.ORDER_COLUMNS, "COLUNA", "MOTIVO")])
    head = head.select(F.col("l_orderkey").cast("string").alias("CHAVE"), "COLUNA", "MOTIVO")
    rest = rest.select(F.lit("RESTANTES").alias("CHAVE"), F.lit(None).cast("string").alias("COLUNA"),
                       F.col("RESTANTES").cast("string").alias("MOTIVO"))
    return head.unionByName(rest)


# ---------------------------------------------------------------- summary sinks (IO17 / IO18 / IO19 / PR15 / AG18)
@query("io17_summary_json", sqlx("""SELECT count(*) AS total_linhas_entrada,
  count(*) FILTER (WHERE CONTRATACAO = 'rede propria') AS total_rede_propria,
  count(*) FILTER (WHERE CONTRATACAO = 'rede credenciada') AS total_rede_credenciada,
  count(*) FILTER (WHERE CONTRATACAO IS NULL) AS total_sem_contratacao,
  CAST(count(DISTINCT CASE WHEN CONTRATACAO IS NULL THEN coalesce(LOCAL, 'VAZIO') END) AS BIGINT) AS locais_sem_contratacao
FROM contracted"""))
def io17_summary_json(spark, d):
    from quorum.sources import io as IO
    c = _contracted(spark, d)
    tot = c.agg(F.count(F.lit(1)).alias("total_linhas_entrada"),
                F.count(F.when(q("CONTRATACAO") == "rede propria", 1)).alias("total_rede_propria"),
                F.count(F.when(q("CONTRATACAO") == "rede credenciada", 1)).alias("total_rede_credenciada"),
                F.count(F.when(q("CONTRATACAO").isNull(), 1)).alias("total_sem_contratacao"))
    places = SM.records(SM.frequency(c.where(q("CONTRATACAO").isNull()), "LOCAL"), ["LOCAL", "QUANTIDADE"])
    path = IO.scratch_path(spark, "resumo-json")
    IO.write_summary_json(tot, path, locais_sem_contratacao=places)
    back = spark.read.schema(tot.schema).json(f"{path}/totais")
    listed = spark.read.schema(places.schema).json(f"{path}/locais_sem_contratacao")
    both = back.unionByName(listed.agg(F.count(F.lit(1)).alias("locais_sem_contratacao")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


@query("io18_summary_csv", sqlx("""SELECT ACAO_LOCAL_EDITADO, count(*) AS QUANTIDADE FROM edited_act GROUP BY 1"""))
def io18_summary_csv(spark, d):
    from quorum.sources import io as IO
    t = SM.frequency(_edited_action(spark, d), "ACAO_LOCAL_EDITADO", None)
    path = IO.scratch_path(spark, "resumo-csv")
    IO.write_summary_csv(t, path)
    return spark.read.schema(t.schema).option("header", True).csv(path)


def _ru8_body():
    return _ru8_sql()


@query("io19_rule_audit_partitions", sqlx(f"""SELECT ORDEM_REGRA_NOVA,
  coalesce(nullif(lower(regexp_replace(regexp_replace(strip_accents(NOME_LISTA_NOVA), '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), ''), 'sem_nome') AS SLUG,
  count(*) AS LINHAS, sum(QUANTIDADE) AS QUANTIDADE FROM ({_ru8_body()}) GROUP BY 1, 2"""))
def io19_rule_audit_partitions(spark, d):
    from quorum.sources import io as IO
    a = rules.incremental_overwrite_audit(_contracted(spark, d)).withColumn("SLUG", TX.slug(F.col("NOME_LISTA_NOVA")))
    path = IO.scratch_path(spark, "auditoria-por-regra")
    IO.write_partitioned(a, path, ["ORDEM_REGRA_NOVA", "SLUG"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("ORDEM_REGRA_NOVA").cast("int").alias("ORDEM_REGRA_NOVA"), "SLUG").agg(
        F.count(F.lit(1)).alias("LINHAS"), F.sum("QUANTIDADE").cast("long").alias("QUANTIDADE"))


@query("ag18_total_overwrites", sqlx(f"""SELECT CAST(coalesce(sum(QUANTIDADE), 0) AS BIGINT) AS TOTAL_SOBRESCRITAS FROM (
{_label_sql(_events_sql(f"({O.class_prep('contracted', _overwriting_rules())})", _overwriting_rules(), True))})"""))
def ag18_total_overwrites(spark, d):
    a = rules.class_overwrite_audit(_contracted(spark, d), _overwriting_rules())
    return a.agg(F.coalesce(F.sum("QUANTIDADE"), F.lit(0)).cast("long").alias("TOTAL_SOBRESCRITAS"))


# ---------------------------------------------------------------- remaining sources and traces
@query("io10_rules_file_classify", sqlx(f"SELECT {KEYS_SQL}, CLASSIFICACAO FROM classified"))
def io10_rules_file_classify(spark, d):
    """Rules written to a JSON rule file, read back (IO10) and applied."""
    from quorum.config.classification import CLASSIFICATION_RULES
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "regras")
    IO.write_class_rules(spark, CLASSIFICATION_RULES, path)
    loaded = IO.read_class_rules(spark, path)
    return rules.classify(_contracted(spark, d), loaded).select(*KEYS, "CLASSIFICACAO")


@query("io6_sheet_by_name", sqlx(f"""SELECT lower({O.strip('Local')}) AS LOCAL_COMPARACAO,
  arg_min(lower({O.strip('contratacao')}), _ord) AS contratacao FROM contract_sheet GROUP BY 1"""))
def io6_sheet_by_name(spark, d):
    """Lookup sheets stored one dataset per sheet name (IO6), read back by name."""
    from quorum.sources import io as IO
    base = IO.scratch_path(spark, "insumos")
    S.contract_sheet(spark, d).write.parquet(f"{base}/contratacao")
    sh = IO.read_sheet(spark, base, "contratacao")
    dim = sh.select(F.lower(TX.strip(q("Local"))).alias("LOCAL_COMPARACAO"),
                    F.lower(TX.strip(q("contratacao"))).alias("contratacao"), "_ord")
    return lookup.keep_first(dim, "LOCAL_COMPARACAO", ["contratacao"], "_ord")


@query("io11_missing_lookup", S.with_views(f"""SELECT {KEYS_SQL}, OPERADORA FROM ({O.operated('edited').replace(
    'FROM unit_sheet WHERE', 'FROM (SELECT * FROM unit_sheet WHERE false) WHERE')})""", *STAGES))
def io11_missing_lookup(spark, d):
    """The operator step when the optional unit sheet is missing (IO11)."""
    from quorum.sources import io as IO
    sheet = IO.read_optional(spark, IO.scratch_path(spark, "planilha-ausente"))
    return operator_rules.assign_operator(_edited(spark, d), sheet).select(*KEYS, "OPERADORA")


@query("ru3_rule_trace", sqlx(f"""SELECT {KEYS_SQL},
  CASE WHEN NOT __ob THEN 'ORIGINAL' WHEN __fm IS NOT NULL THEN CAST(__fm AS VARCHAR) END AS _ORDEM_REGRA,
  CASE WHEN NOT __ob THEN 'BASE DE ENTRADA' ELSE m.lista END AS _NOME_LISTA,
  CASE WHEN NOT __ob THEN 'CLASSIFICACAO_PRE_EXISTENTE' ELSE m.chave END AS _CHAVE_GRUPO
FROM ({O.class_prep('contracted')}) p LEFT JOIN {O.rule_meta_values()} m ON p.__fm = m.k"""))
def ru3_rule_trace(spark, d):
    """Which rule set each row's class (RU3 origin tracking)."""
    return rules.classify(_contracted(spark, d), keep_trace=True).select(
        *KEYS, "_ORDEM_REGRA", "_NOME_LISTA", "_CHAVE_GRUPO")


@query("io4_pruned_csv_scan", sqlx("""SELECT TIPO, count(*) AS QUANTIDADE, count(ESPECIALIDADE) AS COM_ESPECIALIDADE
FROM (SELECT CAST(TIPO AS VARCHAR) AS TIPO, ESPECIALIDADE FROM survey) GROUP BY 1"""))
def io4_pruned_csv_scan(spark, d):
    """IO3/IO4: a plain CSV scan pruned to the columns a report needs."""
    from quorum.sources import io as IO
    path = IO.scratch_path(spark, "survey-csv-pruned")
    IO.write_survey_csv(S.survey(spark, d), path, strict_ints=False)  # scores may be missing
    df = IO.read_csv_columns(spark, path, ["TIPO", "ESPECIALIDADE"])
    return df.groupBy("TIPO").agg(F.count(F.lit(1)).alias("QUANTIDADE"),
                                  F.count("ESPECIALIDADE").alias("COM_ESPECIALIDADE"))


def _op_v2_overwrite_log_sql() -> str:
    """v2 overwrite log oracle: applied steps as rows with values and rule
    names (a map block is named after the matched unit), lag for the previous."""
    masks, fills, names, vals, shown, ordens = _op_steps_sql(True)
    block = len(masks) - 2
    parts = []
    for k, (ap, bb) in enumerate(_op_applied_sql(masks, fills)):
        name = ("concat('LOCAL EDITADO igual a ', \"LOCAL EDITADO\")" if k == block else O.s(names[k]))
        val = O.s("NDI SP E RJ") if k == block else vals[k]
        parts.append(f"SELECT {KEYS_SQL}, LOCAL, \"LOCAL EDITADO\" AS le, UF, {k + 1} AS k, {val} AS v, {name} AS r "
                     f"FROM opprep WHERE {ap}")
    u = "\nUNION ALL\n".join(parts)
    return f"""SELECT LOCAL, le AS "LOCAL EDITADO", UF, p AS OPERADORA_ANTERIOR, v AS OPERADORA_NOVA,
  pr AS REGRA_ANTERIOR, r AS REGRA_NOVA, count(*) AS QUANTIDADE FROM (
  SELECT *, lag(v) OVER w AS p, lag(r) OVER w AS pr FROM ({u}) WINDOW w AS (PARTITION BY {KEYS_SQL} ORDER BY k))
WHERE p IS NOT NULL GROUP BY ALL"""


ORACLES["ru17_operator_v2_overwrite_log"] = S.with_views(_op_v2_overwrite_log_sql(), *STAGES,
                                                         ("opprep", _opprep_sql(True)))
