"""SQL fragments for the DuckDB correctness oracles.

These build plain SQL text (no Spark) for the checks in
``__spark_entry__.oracle_sql``: the same semantics written a second time in
SQL, so a query and its oracle only share the fixture view and the rule
values.
"""

from __future__ import annotations

from quorum.config.classification import CLASSIFICATION_RULES, CLASS_NAMES, DELIVERY_GROUPS, class_name
from quorum.config import operator as ocfg
from quorum.functions.text import fold_key_py

WS = r"[\t-\r\x{1C}-\x{1F}\x{85}\pZ]"


def s(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def qi(c: str) -> str:
    return '"' + c + '"'


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def normalize(x: str) -> str:
    return strip(collapse(f"replace({x}, chr(160), ' ')"))


def fold_key(x: str) -> str:
    return f"coalesce({strip(collapse(f'strip_accents(upper({strip(x)}))'))}, '')"


def meta_key(x: str) -> str:
    return f"upper(strip_accents(coalesce({normalize(x)}, '')))"


def blank(x: str) -> str:
    return f"(coalesce({x}, '') = '')"


def round2(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def lit_list(v) -> str:
    v = v if isinstance(v, list) else [v]
    return ", ".join(str(x) for x in v)


def class_mask(r: dict) -> str:
    c = []
    if r.get("tipo_igual") is not None:
        c.append(f"coalesce(TIPO IN ({lit_list(r['tipo_igual'])}), false)")
    if r.get("tipo_diferente") is not None:
        c.append(f"NOT coalesce(TIPO IN ({lit_list(r['tipo_diferente'])}), false)")
    if r.get("contratacao_igual"):
        c.append(f"coalesce(CONTRATACAO = {s(r['contratacao_igual'])}, false)")
    if r.get("contratacao_diferente"):
        c.append(f"coalesce(CONTRATACAO <> {s(r['contratacao_diferente'])}, false)")
    for field, col, neg in (("filtro_local", "LOCAL", False), ("filtro_local_diferente", "LOCAL", True),
                            ("filtro_especialidade", "ESPECIALIDADE", False),
                            ("filtro_especialidade_diferente", "ESPECIALIDADE", True)):
        if r.get(field):
            e = f"coalesce(regexp_matches({col}, {s(r[field])}, 'i'), false)"
            c.append(f"NOT {e}" if neg else e)
    return "(" + (" AND ".join(c) if c else "true") + ")"


def class_names(rules=None):
    rules = CLASSIFICATION_RULES if rules is None else rules
    return [class_name(r["grupo_classificacao"]) for r in rules]


# ------------------------------------------------------------- CTE builders
def contracted(src: str = "survey") -> str:
    """JN1 on ``src``: LOCAL trimmed, CONTRATACAO from the keep-first sheet."""
    return f"""SELECT t.* REPLACE ({strip('t.LOCAL')} AS LOCAL), d.v AS CONTRATACAO
FROM (SELECT COLUMNS(lambda c: c <> 'CONTRATACAO') FROM {src}) t
LEFT JOIN (SELECT lower({strip('Local')}) AS k, arg_min(lower({strip('contratacao')}), _ord) AS v
           FROM contract_sheet GROUP BY 1) d
ON lower({strip('t.LOCAL')}) IS NOT DISTINCT FROM d.k"""


def scored(src: str) -> str:
    """SC12/SC13 on ``src``."""
    cols = ["NOTA1", "NOTA2", "NOTA3", "NOTA4", "NOTA5"]
    n = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in cols)
    tot = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cols)
    return f"""SELECT *, CAST({n} AS BIGINT) AS "Quantidade notas validas",
  CASE WHEN ({n}) > 0 THEN {round2(f'({tot}) / ({n})')} END AS "NOTA GERAL" FROM {src}"""


def classified(src: str, rules=None) -> str:
    """RU1 closed form in SQL: first match, applied flags, last applied wins."""
    rules = CLASSIFICATION_RULES if rules is None else rules
    names = class_names(rules)
    n = len(rules)
    prep = f"""SELECT * REPLACE (TRY_CAST(TIPO AS DOUBLE) AS TIPO, lower({strip('CONTRATACAO')}) AS CONTRATACAO,
  {strip('LOCAL')} AS LOCAL, {strip('ESPECIALIDADE')} AS ESPECIALIDADE, {strip('CLASSIFICACAO')} AS CLASSIFICACAO)
FROM {src}"""
    ms = ", ".join(f"{class_mask(r)} AS __m{k}" for k, r in enumerate(rules, 1))
    fm = "CASE " + " ".join(f"WHEN __m{k} THEN {k}" for k in range(1, n + 1)) + " END"
    def applied(k):
        r = rules[k - 1]
        if r.get("aplicar_somente_vazios"):
            return f"(__m{k} AND {blank('CLASSIFICACAO')} AND __fm = {k})"
        return f"__m{k}"
    final = "CASE " + " ".join(f"WHEN {applied(k)} THEN {s(names[k - 1])}" for k in range(n, 0, -1)) \
        + " ELSE CLASSIFICACAO END"
    drop = ", ".join(f"__m{k}" for k in range(1, n + 1))
    return f"""SELECT * EXCLUDE ({drop}, __fm) REPLACE ({final} AS CLASSIFICACAO) FROM (
  SELECT *, {fm} AS __fm FROM (SELECT *, {ms} FROM ({prep})))"""


def edited(src: str, with_action: bool = False) -> str:
    """JN3 on ``src``."""
    act = ""
    if with_action:
        act = f""", CASE WHEN {_found()} AND NOT {_same()} THEN 'atualizado'
   WHEN {_same()} THEN 'nao_alterado' ELSE 'nao_encontrado' END AS ACAO_LOCAL_EDITADO"""
    return f"""SELECT t.* EXCLUDE ("LOCAL EDITADO", __le0),
  CASE WHEN {_found()} AND NOT {_same()} THEN d.v ELSE t.__le0 END AS "LOCAL EDITADO"{act}
FROM (SELECT * EXCLUDE ("LOCAL EDITADO") REPLACE ({strip('LOCAL')} AS LOCAL),
        {strip('"LOCAL EDITADO"')} AS __le0, "LOCAL EDITADO"
      FROM (SELECT COLUMNS(lambda c: c <> 'LOCAL EDITADO'), NULL::VARCHAR AS "LOCAL EDITADO" FROM {src})) t
LEFT JOIN (SELECT lower({strip('Local')}) AS k, arg_min({strip('local_editado')}, _ord) AS v
           FROM edited_sheet WHERE Local IS NOT NULL GROUP BY 1) d
ON lower(t.LOCAL) = d.k"""


def _found():
    return "(d.v IS NOT NULL AND d.v <> '')"


def _same():
    return f"({_found()} AND coalesce(t.__le0, '') = coalesce(d.v, ''))"


def targeted(src: str) -> str:
    """JN4 on ``src``: META and GRUPO_ENCONTRADO."""
    return f"""SELECT t.* EXCLUDE (META), d.meta AS META, d.grupo AS GRUPO_ENCONTRADO
FROM (SELECT * REPLACE ({strip('CLASSIFICACAO')} AS CLASSIFICACAO)
      FROM (SELECT COLUMNS(lambda c: c NOT IN ('META', 'GRUPO_ENCONTRADO')), NULL::DOUBLE AS META FROM {src})) t
LEFT JOIN (SELECT {meta_key(strip('grupo'))} AS k, arg_min(CAST(meta AS DOUBLE), _ord) AS meta,
                  arg_min({strip('grupo')}, _ord) AS grupo
           FROM meta_sheet WHERE {meta_key(strip('grupo'))} <> '' GROUP BY 1) d
ON {meta_key('t.CLASSIFICACAO')} = d.k"""


def operated(src: str, v2: bool = False) -> str:
    """RU9-RU11 (v1) in SQL: CASE over applied steps, last applied wins.
    ``v2``: literal 'contem', and the unit map gives the block's constant."""
    rules = ocfg.OPERATOR_RULES
    def flt(f):
        c = qi(f["coluna"])
        if f["tipo_filtro"] == "igual":
            return f"coalesce({c} = {s(f['valor_filtro'])}, false)"
        if v2:
            return f"coalesce(contains(upper({c}), upper({s(f['valor_filtro'])})), false)"
        return f"coalesce(regexp_matches({c}, {s(f['valor_filtro'])}, 'i'), false)"
    masks = ["(" + " AND ".join(flt(f) for f in r["filtros"]) + ")" for r in rules]
    vals = [s(r["valor_operadora"]) for r in rules]
    # special fill-only rule, map rule, default
    name, value, col, place = ocfg.SPECIAL_FILL_RULE
    n_json = len(rules)
    any_before = lambda k: "(" + " OR ".join(["false"] + masks[:k]) + ")"
    orig_blank = blank("OPERADORA")
    bb_special = f"({orig_blank} AND NOT {any_before(n_json)})"
    special = f"(coalesce({qi(col)} = {s(place)}, false) AND {bb_special})"
    mapped = "(__mo IS NOT NULL AND __mo <> '')"
    bb_default = f"({bb_special} AND NOT coalesce({qi(col)} = {s(place)}, false) AND NOT {mapped})"
    final = (f"CASE WHEN {bb_default} THEN {s(ocfg.DEFAULT_OPERATOR)} WHEN {mapped} THEN __mo "
             f"WHEN {special} THEN {s(value)} "
             + " ".join(f"WHEN {m} THEN {v}" for m, v in reversed(list(zip(masks, vals))))
             + " ELSE OPERADORA END")
    n = (lambda x: f"coalesce({normalize(x)}, '')") if v2 else normalize
    prep = f"""SELECT * REPLACE (upper({n('CLASSIFICACAO')}) AS CLASSIFICACAO, upper({n('UF')}) AS UF,
   upper({n('"LOCAL EDITADO"')}) AS "LOCAL EDITADO", upper({n('OPERADORA')}) AS OPERADORA,
   lower({n('CONTRATACAO')}) AS CONTRATACAO, {n('ESPECIALIDADE')} AS ESPECIALIDADE)
FROM (SELECT COLUMNS(lambda c: c <> 'OPERADORA'), NULL::VARCHAR AS OPERADORA FROM {src})"""
    dim = f"""SELECT upper({normalize('UNIDADE')}) AS k, arg_min(upper({normalize('OPERA')}), _ord) AS v
FROM unit_sheet WHERE UNIDADE IS NOT NULL GROUP BY 1"""
    if v2:
        dim = f"SELECT k, {s(ocfg.V2_MAP_OPERATOR)} AS v FROM ({dim})"
    return f"""SELECT * EXCLUDE (__mo) REPLACE (upper({normalize(final)}) AS OPERADORA)
FROM (SELECT p.*, d.v AS __mo FROM ({prep}) p LEFT JOIN ({dim}) d ON p."LOCAL EDITADO" = d.k)"""


def unit_results(src: str) -> str:
    """AN1 + PR14 in SQL via a window (a different formulation than Spark's)."""
    k = ["CLASSIFICACAO", '"LOCAL EDITADO"', "UF"]
    prep = f"""SELECT * REPLACE ({normalize('CLASSIFICACAO')} AS CLASSIFICACAO,
   {normalize('"LOCAL EDITADO"')} AS "LOCAL EDITADO",
   CASE WHEN {blank(normalize('UF'))} OR lower({normalize('UF')}) = 'vazio' THEN 'CE' ELSE {normalize('UF')} END AS UF)
FROM {src}"""
    part = ", ".join(k)
    h = 'CAST(round_even("NOTA GERAL" * 100, 0) AS BIGINT)'
    mean = (f"CASE WHEN count(\"NOTA GERAL\") OVER w > 0 THEN "
            f"{round2(f'CAST(sum({h}) OVER w AS DOUBLE) / (100.0::DOUBLE * CAST(count(\"NOTA GERAL\") OVER w AS DOUBLE))')} END")
    return f"""SELECT * EXCLUDE ("RESULTADO DA UNIDADE"), {mean} AS "RESULTADO DA UNIDADE"
FROM (SELECT *, NULL AS "RESULTADO DA UNIDADE" FROM ({prep})) WINDOW w AS (PARTITION BY {part})"""


def statused(src: str) -> str:
    return f"""SELECT *, CASE WHEN "RESULTADO DA UNIDADE" IS NULL OR META IS NULL THEN NULL
  WHEN "RESULTADO DA UNIDADE" < META THEN 'fora da meta' ELSE 'dentro da meta' END AS "STATUS UNIDADE"
FROM {src}"""


def send_name_case(col: str) -> str:
    m = {}
    for k, v in CLASS_NAMES.items():
        m[fold_key_py(k)] = v
        m[fold_key_py(v)] = v
    return ("CASE " + fold_key(col) + " " + " ".join(f"WHEN {s(k)} THEN {s(v)}" for k, v in m.items())
            + f" ELSE {col} END")


def group_case(col: str) -> str:
    parts = []
    for g, classes in DELIVERY_GROUPS.items():
        for c in classes:
            parts.append(f"WHEN {s(fold_key_py(c))} THEN {s(g)}")
    return f"CASE {fold_key(col)} " + " ".join(parts) + " END"


def class_prep(src: str, rules=None) -> str:
    """Prepared rule inputs with per-rule match flags __m1..__mn, first match
    __fm and the input-blank flag __ob (for the audit oracles)."""
    rules = CLASSIFICATION_RULES if rules is None else rules
    n = len(rules)
    prep = f"""SELECT * REPLACE (TRY_CAST(TIPO AS DOUBLE) AS TIPO, lower({strip('CONTRATACAO')}) AS CONTRATACAO,
  {strip('LOCAL')} AS LOCAL, {strip('ESPECIALIDADE')} AS ESPECIALIDADE, {strip('CLASSIFICACAO')} AS CLASSIFICACAO)
FROM {src}"""
    ms = ", ".join(f"{class_mask(r)} AS __m{k}" for k, r in enumerate(rules, 1))
    fm = "CASE " + " ".join(f"WHEN __m{k} THEN {k}" for k in range(1, n + 1)) + " END"
    return f"""SELECT *, {fm} AS __fm, {blank('CLASSIFICACAO')} AS __ob FROM (SELECT *, {ms} FROM ({prep}))"""


def rule_meta_values(rules=None) -> str:
    """VALUES table (k, lista, chave, nome) of the rules."""
    rules = CLASSIFICATION_RULES if rules is None else rules
    rows = [f"({k}, {s(r['nome_lista'])}, {s(r['grupo_classificacao'])}, {s(class_name(r['grupo_classificacao']))})"
            for k, r in enumerate(rules, 1)]
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) AS t(k, lista, chave, nome))"
