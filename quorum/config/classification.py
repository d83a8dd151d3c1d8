"""Default classification rule set and class names.

FIXED VALUES: the rule list, the key -> delivery-name map and the delivery
groups below must equal the values of the survey process being reproduced,
so they are stated here as plain text, in their original order.  Rules are
applied top to bottom; fields left out are "no filter".
"""

from __future__ import annotations

RULE_FIELDS = (
    "grupo_classificacao", "nome_lista", "aplicar_somente_vazios", "palavra_filtro",
    "tipo_igual", "tipo_diferente", "contratacao_igual", "contratacao_diferente",
    "filtro_local", "filtro_local_diferente", "filtro_especialidade",
    "filtro_especialidade_diferente",
)


def _r(**kw):
    return {f: kw.get(f) for f in RULE_FIELDS}


# --- fixed values: classification rules, in application order -------------
CLASSIFICATION_RULES = [
    _r(grupo_classificacao='CRED_ATEND_EMERGENCIA', nome_lista='lista_cred_atend_emergencia', aplicar_somente_vazios=True, tipo_igual=1, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='HOSPITALAR', nome_lista='lista_hospitalar', aplicar_somente_vazios=True, tipo_igual=1, contratacao_igual='rede propria'),
    _r(grupo_classificacao='QUALIVIDA', nome_lista='lista_qualivida_1', aplicar_somente_vazios=True, palavra_filtro='QUALIVIDA|QUALIVITA', tipo_diferente=6, filtro_local='qualivida|qualivita'),
    _r(grupo_classificacao='QUALIVIDA', nome_lista='lista_qualivida_2', aplicar_somente_vazios=True, palavra_filtro='QUALIVIDA|QUALIVITA', tipo_diferente=6, filtro_local='qualivida|qualivita'),
    _r(grupo_classificacao='QUALIVIDA', nome_lista='lista_qualivida_3', aplicar_somente_vazios=True, palavra_filtro='SINTA-SE|SINTASE|SINTA SE|VIVER BEM', tipo_diferente=6, filtro_local='sinta-se|sintase|sinta se|viver bem'),
    _r(grupo_classificacao='QUALIVIDA', nome_lista='lista_qualivida_4', aplicar_somente_vazios=True, palavra_filtro='SINTA-SE|SINTASE|SINTA SE|VIVER BEM', tipo_diferente=6, filtro_especialidade='sinta-se|sintase|sinta se|viver bem'),
    _r(grupo_classificacao='NASCER_BEM', nome_lista='lista_nascer_bem', aplicar_somente_vazios=True, palavra_filtro='NB|RISCO', tipo_diferente=6, filtro_especialidade='\\bnb\\b|risco'),
    _r(grupo_classificacao='TELEMEDICINA', nome_lista='lista_telemedicina', aplicar_somente_vazios=True, palavra_filtro='TELEM', tipo_diferente=6, filtro_local='telemed|telemedicina|telem'),
    _r(grupo_classificacao='PRODUTO_COORDENADO', nome_lista='lista_produto_coordenado', aplicar_somente_vazios=True, palavra_filtro='NOSSO MEDICO|NOTRELIFE|NUCLEO MF|PROD. COORD|PROD.COORD', tipo_diferente=6, filtro_local='nosso medico|notrelife|nucleo MF|prod. coord|prod.coord'),
    _r(grupo_classificacao='CASE', nome_lista='lista_case', aplicar_somente_vazios=True, palavra_filtro='CASE', tipo_diferente=6, filtro_local='case'),
    _r(grupo_classificacao='CASE', nome_lista='lista_case', aplicar_somente_vazios=True, palavra_filtro='CASE', tipo_diferente=6, filtro_especialidade='case'),
    _r(grupo_classificacao='TRANSPLANTE', nome_lista='lista_transplante', aplicar_somente_vazios=True, palavra_filtro='TRANSPL', tipo_diferente=6, filtro_especialidade='transpl'),
    _r(grupo_classificacao='TEA', nome_lista='lista_tea', aplicar_somente_vazios=True, palavra_filtro='TEA', tipo_diferente=6, filtro_local='tea'),
    _r(grupo_classificacao='GESTAR_BEM', nome_lista='lista_gestar_bem', aplicar_somente_vazios=True, palavra_filtro='GESTAR|GESTAR BEM|PGS', tipo_diferente=6, filtro_especialidade='gestar|gestar bem'),
    _r(grupo_classificacao='GESTAR_BEM', nome_lista='lista_gestar_bem', aplicar_somente_vazios=True, palavra_filtro='GESTAR|GESTAR BEM|PGS', tipo_diferente=6, filtro_local='gestar|gestar bem|pgs'),
    _r(grupo_classificacao='TELECONSULTA CASE', nome_lista='lista_teleconsulta', aplicar_somente_vazios=True, palavra_filtro='PGC|TRANSPLANTE|CASE', tipo_igual=6, filtro_especialidade='pgc|transplante|case'),
    _r(grupo_classificacao='TELECONSULTA_ELETIVA', nome_lista='lista_teleconsulta_eletiva', aplicar_somente_vazios=True, tipo_igual=6),
    _r(grupo_classificacao='TELECONSULTA_URGENCIA', nome_lista='lista_teleconsulta_urgencia', aplicar_somente_vazios=True, tipo_igual=7),
    _r(grupo_classificacao='MED_PREV', nome_lista='lista_med_prev', aplicar_somente_vazios=True, tipo_igual=4, contratacao_igual='rede propria'),
    _r(grupo_classificacao='CRED_TRATAMENTO', nome_lista='lista_cred_tratamento', aplicar_somente_vazios=True, tipo_igual=4, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='MED_PREV', nome_lista='lista_med_prev_tipo_2', aplicar_somente_vazios=True, palavra_filtro='MED PREV|MEDPREV|NB', tipo_igual=2, contratacao_igual='rede propria', filtro_especialidade='med prev|medprev|nb'),
    _r(grupo_classificacao='HAPCLINICA', nome_lista='lista_hapclinica', aplicar_somente_vazios=True, tipo_igual=2, contratacao_igual='rede propria'),
    _r(grupo_classificacao='ODONTOLOGIA', nome_lista='lista_odontologia', aplicar_somente_vazios=True, tipo_igual=5),
    _r(grupo_classificacao='ODONTOLOGIA', nome_lista='lista_odontologia_2', aplicar_somente_vazios=True, palavra_filtro='ODONT', filtro_especialidade='odont'),
    _r(grupo_classificacao='CRED_ATEND_ELETIVO', nome_lista='lista_cred_atend_eletivo', aplicar_somente_vazios=True, palavra_filtro='ODONT', tipo_igual=3, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='HAPCLINICA', nome_lista='lista_hapclinica_tipo_3', aplicar_somente_vazios=True, tipo_igual=3, contratacao_igual='rede propria'),
    _r(grupo_classificacao='CRED_ATEND_ELETIVO', nome_lista='lista_cred_atend_eletivo', aplicar_somente_vazios=True, palavra_filtro='ODONT', tipo_igual=3, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='LABORATORIO', nome_lista='lista_laboratorio', aplicar_somente_vazios=True, tipo_igual=8, contratacao_igual='rede propria'),
    _r(grupo_classificacao='CRED_LABORATORIO', nome_lista='lista_cred_laboratorio', aplicar_somente_vazios=True, tipo_igual=8, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='VIDA_IMAGEM', nome_lista='lista_vida_imagem', aplicar_somente_vazios=True, tipo_igual=9, contratacao_igual='rede propria'),
    _r(grupo_classificacao='CRED_EXAMES', nome_lista='lista_cred_exames', aplicar_somente_vazios=True, tipo_igual=9, contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='CRED_INTERNACAO', nome_lista='lista_cred_internacao', aplicar_somente_vazios=True, tipo_igual=[10, 11, 12, 13], contratacao_igual='rede credenciada'),
    _r(grupo_classificacao='INTERNACAO', nome_lista='lista_internacao', aplicar_somente_vazios=True, tipo_igual=[10, 11, 12, 13], contratacao_igual='rede propria'),
    _r(grupo_classificacao='INTERNACAO_PGC', nome_lista='lista_internacao_pgc', aplicar_somente_vazios=True, tipo_igual=14),
]

# --- fixed values: class key -> delivery name --------------------------------
CLASS_NAMES = {
    "CRED_ATEND_EMERGENCIA": "CRED_ATEND EMERGÊNCIA",
    "HOSPITALAR": "HOSPITALAR",
    "QUALIVIDA": "QUALIVIDA",
    "NASCER_BEM": "NASCER BEM",
    "TELEMEDICINA": "TELEMEDICINA",
    "PRODUTO_COORDENADO": "PRODUTO COORDENADO",
    "CASE": "CASE",
    "TRANSPLANTE": "TRANSPLANTE",
    "TEA": "TEA",
    "GESTAR_BEM": "GESTAR BEM",
    "TELECONSULTA": "TELECONSULTA",
    "TELECONSULTA_ELETIVA": "TELECONSULTA ELETIVA",
    "TELECONSULTA_URGENCIA": "TELECONSULTA URGÊNCIA",
    "MED_PREV": "MED PREV",
    "CRED_TRATAMENTO": "CRED_TRATAMENTO",
    "HAPCLINICA": "HAPCLINICA",
    "ODONTOLOGIA": "ODONTOLOGIA",
    "CRED_ATEND_ELETIVO": "CRED_ATEND ELETIVO",
    "LABORATORIO": "LABORATÓRIO",
    "CRED_LABORATORIO": "CRED_LABORATÓRIO",
    "VIDA_IMAGEM": "VIDA IMAGEM",
    "CRED_EXAMES": "CRED_EXAMES",
    "CRED_INTERNACAO": "CRED_INTERNAÇÃO",
    "INTERNACAO": "INTERNAÇÃO",
    "INTERNACAO_PGC": "INTERNAÇÃO PGC",
}

# --- fixed values: delivery group -> classes (routing of both sources) -------
DELIVERY_GROUPS = {
    "diagnostico": ["VIDA IMAGEM", "LABORATORIO"],
    "hapclinica": ["HAPCLINICA"],
    "hospitalar": ["HOSPITALAR", "INTERNACAO"],
    "med prev e programas especiais": [
        "CASE", "GESTAR BEM", "INTERNACAO PGC", "MED PREV", "NASCER BEM",
        "PRODUTO COORDENADO", "TEA", "TRANSPLANTE RENAL", "QUALIVIDA", "TRANSPLANTE",
    ],
    "odontologia": ["ODONTOLOGIA"],
    "rede credenciada": [
        "CRED_ATEND ELETIVO", "CRED_ATEND EMERGENCIA", "CRED_EXAMES",
        "CRED_INTERNACAO", "CRED_LABORATORIO", "CRED_TRATAMENTO",
    ],
    "teleconsulta": [
        "TELECONSULTA ELETIVA", "TELEMEDICINA", "TELECONSULTA CASE", "TELECONSULTA URGÊNCIA",
    ],
}

# Labels the classification fold gives to rows that came in already classified.
ORIGINAL_RULE = ("ORIGINAL", "BASE DE ENTRADA", "CLASSIFICACAO_PRE_EXISTENTE")


def class_name(key: str, names: dict | None = None) -> str:
    """Delivery name of a rule key, falling back to the key with '_' -> ' '."""
    names = CLASS_NAMES if names is None else names
    return names.get(key, key.replace("_", " "))
