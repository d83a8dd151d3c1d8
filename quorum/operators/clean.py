"""Cleaning steps (PR1, PR2, PR4, PR9, PR10, FI1).

The scored table keeps rows with at least one valid score; the negative
table only gets its columns renamed and completed.  All steps are
projections and filters (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.functions.schema import ensure_columns
from quorum.operators.score import SCORES, VALID, keep_scored

# --- fixed values: header renames and mandatory columns of the clean step ---
SCORED_RENAMES = {
    "Nota geral": "NOTA GERAL",
    "Contratacao": "CONTRATACAO",
    "Operadora": "OPERADORA",
    "Local editado": "LOCAL EDITADO",
    "Meta": "META",
    "Resultado da unidade": "RESULTADO DA UNIDADE",
    "Status unidade": "STATUS UNIDADE",
}
SCORED_REQUIRED = {
    "NOTA GERAL": "double", "CONTRATACAO": "string", "CLASSIFICACAO": "string",
    "OPERADORA": "string", "LOCAL EDITADO": "string", "META": "double",
    "RESULTADO DA UNIDADE": "double", "STATUS UNIDADE": "string",
}
NEGATIVE_RENAMES = {
    "Contratacao": "CONTRATACAO",
    "Local editado": "LOCAL EDITADO",
}
NEGATIVE_REQUIRED = {"CONTRATACAO": "string", "CLASSIFICACAO": "string", "LOCAL EDITADO": "string"}
AUDIT_BASE_COLUMNS = ("CDUSUARIO", "MES", "DIA", "ANO", "TIPO", "CONTRATACAO", "LOCAL", "ESPECIALIDADE")


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """PR1: rename the columns present in ``mapping``."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def clean_scored(df: DataFrame, scores=SCORES) -> DataFrame:
    """Clean step of the scored table: rename, add missing columns, count
    valid scores, keep rows with at least one, reset NOTA GERAL."""
    df = rename(df, SCORED_RENAMES)
    df, _ = ensure_columns(df, SCORED_REQUIRED)
    df = keep_scored(df, scores, VALID)
    return df.withColumn("NOTA GERAL", F.lit(None).cast("double"))


def clean_negative(df: DataFrame) -> DataFrame:
    """Clean step of the negative table: rename and add missing columns."""
    df = rename(df, NEGATIVE_RENAMES)
    df, _ = ensure_columns(df, NEGATIVE_REQUIRED)
    return df


def clean_totals(df: DataFrame, scores=SCORES) -> DataFrame:
    """AG6 for the clean step: input rows, kept, removed (one row)."""
    from quorum.functions.text import row_count_valid
    n = row_count_valid([F.col(f"`{s}`") for s in scores])
    return df.agg(F.count(F.lit(1)).alias("total_linhas_entrada"),
                  F.count(F.when(n > 0, 1)).alias("total_linhas_saida"),
                  F.count(F.when(n == 0, 1)).alias("total_linhas_removidas"))


def project(df: DataFrame, columns) -> DataFrame:
    """PR4: column subset."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
