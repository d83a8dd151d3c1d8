"""Default operator (OPERADORA) rule set.

FIXED VALUES: the rule list, the closing rules and the default operator
must equal the values of the survey process being reproduced; they are
stated here as plain text, in their original order.  Each rule is a
conjunction of filters ``(coluna, tipo_filtro, valor_filtro)``; ``igual``
is exact equality, ``contem`` a case-insensitive regular-expression search.
"""

from __future__ import annotations


def _rule(descricao, valor_operadora, *filtros):
    return {
        "descricao": descricao,
        "valor_operadora": valor_operadora,
        "filtros": [
            {"coluna": c, "tipo_filtro": t, "valor_filtro": v} for c, t, v in filtros
        ],
    }


# --- fixed values: operator rules (always overwrite), in application order ---
OPERATOR_RULES = [
    _rule('CLASSIFICACAO contem TELE', 'TELECONSULTA', ('CLASSIFICACAO', 'contem', 'TELE')),
    _rule('CLASSIFICACAO contem CRED', 'REDE CREDENCIADA', ('CLASSIFICACAO', 'contem', 'CRED')),
    _rule('UF igual a PR', 'CLINIPAN', ('UF', 'igual', 'PR')),
    _rule('UF igual a RS', 'CCG', ('UF', 'igual', 'RS')),
    _rule('UF igual a MG', 'NDI MG', ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem OCTAVIANO NEVES e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'OCTAVIANO NEVES'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem VENDA NOVA e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'VENDA NOVA'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem PROCLIN ELDORADO e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'PROCLIN ELDORADO'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem HVC DAY UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'HVC'), ('UF', 'igual', 'MG')),
    _rule('HOSPITAL VERA CRUZ e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'HOSPITAL VERA CRUZ'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem BETIM e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'BETIM'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem RAJA e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'RAJA'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO igual a LIFE CENTER CONTAGEM e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'igual', 'LIFE CENTER CONTAGEM'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO igual a HOSPITAL LIFE CENTER e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'igual', 'HOSPITAL LIFE CENTER'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO contem EFIGENCIA e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'contem', 'EFIGENCIA'), ('UF', 'igual', 'MG')),
    _rule('LOCAL EDITADO igual a PA CONTORNO e UF igual a MG', 'PROMED', ('LOCAL EDITADO', 'igual', 'PA CONTORNO'), ('UF', 'igual', 'MG')),
]

# --- fixed values: closing steps after the JSON rules ------------------------
# fill-only special rule: place PA CONTORNO with blank operator -> NDI MG
SPECIAL_FILL_RULE = ("LOCAL EDITADO igual a PA CONTORNO e OPERADORA vazia", "NDI MG",
                     "LOCAL EDITADO", "PA CONTORNO")
# operator taken from the unit sheet (UNIDADE -> OPERA)
MAP_RULE_NAME = "PLANILHA NDI SP E RJ"
MAP_RULE_VALUE = "DINAMICA"
# still-blank rows at the end get the default operator
DEFAULT_OPERATOR = "HAPVIDA"
DEFAULT_RULE_NAME = "OPERADORA vazia no final recebe HAPVIDA"

# Operator pair reported together in the per-operator summary.
COMBINED_OPERATORS = ("PROMED", "HAPVIDA")
COMBINED_LABEL = "PROMED + HAPVIDA"

# --- fixed values: rule-table (v2) format ------------------------------------
V2_SHEET_COLUMNS = {
    "OPERADORA": "operadora",
    "APLICAR_SOMENTE_VAZIO": "aplicar_somente_vazios",
    "COLUNA_FILTRO_1": "coluna_1",
    "COMPARADOR_1": "comparador_1",
    "VALOR_1": "valor_1",
    "COLUNA_FILTRO_2": "coluna_2",
    "COMPARADOR_2": "comparador_2",
    "VALOR_2": "valor_2",
    "COLUNA_FILTRO_3": "coluna_3",
    "COMPARADOR_3": "comparador_3",
    "VALOR_3": "valor_3",
    "ORDEM": "ordem",
    "STATUS_ATIVO": "ativo",
    "DESCRICAO": "descricao",
}
V2_COMPARATORS = ("igual", "contem", "diferente", "nao_contem", "vazio", "nao_vazio")
TRUE_FLAGS = ("sim", "s", "true", "1", "yes")
V2_MAP_OPERATOR = "NDI SP E RJ"
V2_MAP_BLOCK_NAME = "BLOCO NDI SP E RJ"
UNKNOWN_RULE = "DESCONHECIDA"
