"""Schema overlay for survey tables (PR5-PR8).

Known columns are cast when present, unknown columns pass through.  Integer
columns are strict: a null or unparsable value fails the job (``raise_error``
inside the projection, so no extra pass over the data is needed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorum.functions.text import drop_decimal_zero, to_number

# --- fixed values: typed column sets of the survey tables ------------------
TEXT_COLUMNS = (
    "CDATENDIMENTO", "NUM_BENEFICIARIO", "CDEMPRESA", "PROFISSIONAL", "PROCEDIMENTO",
    "ESPECIALIDADE", "DATA_ATENDIMENTO", "LOCAL", "UF", "CLASSIFICACAO_TIPO_DESC",
    "MOTIVADOR1", "DESC_MOTIVADOR1", "MOTIVADOR2", "DESC_MOTIVADOR2", "MOTIVADOR3",
    "DESC_MOTIVADOR3", "MOTIVADOR4", "DESC_MOTIVADOR4", "MOTIVADOR5", "DESC_MOTIVADOR5",
    "CDUSUARIO", "STATUS", "NOME", "TELEFONE", "EMAIL", "DT_RESPOSTA", "CONTRATACAO",
    "CLASSIFICACAO", "OPERADORA", "LOCAL EDITADO", "STATUS UNIDADE",
)
FLOAT_COLUMNS = ("NOTA5", "NOTA GERAL", "META", "RESULTADO DA UNIDADE")
INT_COLUMNS = ("NOTA1", "NOTA2", "NOTA3", "NOTA4", "MES", "DIA", "ANO", "TIPO",
               "Quantidade notas validas")
ID_COLUMNS = ("NUM_BENEFICIARIO", "TELEFONE")
SCORE_COLUMNS = ("NOTA1", "NOTA2", "NOTA3", "NOTA4", "NOTA5")

EXPECTED_TYPES = {
    **{c: T.StringType() for c in TEXT_COLUMNS},
    **{c: T.DoubleType() for c in FLOAT_COLUMNS},
    **{c: T.LongType() for c in INT_COLUMNS},
}


def overlay(df: DataFrame, strict_ints: bool = True) -> DataFrame:
    """PR5: cast the known columns that are present; others untouched.

    Text: cast to string, ids lose a trailing '.0' after a digit.
    Float: numeric coercion, bad value -> null.
    Int: numeric coercion; with ``strict_ints`` a null/bad value raises,
    otherwise it stays null (fixtures that carry nulls on purpose).
    """
    cols = set(df.columns)
    updates = {}
    for c in TEXT_COLUMNS:
        if c in cols:
            v = F.col(f"`{c}`").cast("string")
            updates[c] = drop_decimal_zero(v) if c in ID_COLUMNS else v
    for c in FLOAT_COLUMNS:
        if c in cols:
            src = F.col(f"`{c}`")
            updates[c] = _as_double(df, c, src)
    for c in INT_COLUMNS:
        if c in cols:
            src = F.col(f"`{c}`")
            num = _as_double(df, c, src)
            if strict_ints:
                num = F.when(num.isNull(), F.raise_error(
                    F.lit(f"column '{c}' must be int64 but has empty or invalid values"))
                ).otherwise(num)
            updates[c] = num.cast("long")
    return df.withColumns(updates) if updates else df


def _as_double(df: DataFrame, name: str, src):
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return F.when(~F.isnan(src.cast("double")), src.cast("double"))
    return to_number(src)


def expected_types(df: DataFrame) -> dict:
    """PR7: expected type of each known column present."""
    return {c: t for c, t in EXPECTED_TYPES.items() if c in df.columns}


def type_divergences(spark: SparkSession, df: DataFrame) -> DataFrame:
    """PR8/DQ2: (coluna, tipo_esperado, tipo_encontrado) for mismatches.

    Works on metadata only; the result is a tiny DataFrame.
    """
    rows = []
    for c, t in expected_types(df).items():
        found = df.schema[c].dataType
        if found != t:
            rows.append((c, t.simpleString(), found.simpleString()))
    schema = "coluna string, tipo_esperado string, tipo_encontrado string"
    return spark.createDataFrame(rows, schema)


def missing_columns(df: DataFrame, required) -> list[str]:
    """DQ1: required columns absent from ``df`` (metadata only)."""
    return [c for c in required if c not in df.columns]


def ensure_columns(df: DataFrame, columns: dict) -> tuple[DataFrame, list[str]]:
    """PR2: add missing columns as typed nulls; report which were created."""
    created = [c for c in columns if c not in df.columns]
    if created:
        df = df.withColumns({c: F.lit(None).cast(columns[c]) for c in created})
    return df, created


def resolve_column(df: DataFrame, wanted: str) -> str:
    """PR3: find a column by name ignoring case, accents, spaces, underscores."""
    from quorum.functions.text import header_key
    key = header_key(wanted)
    for c in df.columns:
        if header_key(c) == key:
            return c
    raise ValueError(f"column not found: expected {wanted}")
