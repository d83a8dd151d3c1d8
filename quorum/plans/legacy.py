"""PL5: the legacy one-shot step (score + contract on scored rows only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorum.operators import clean, lookup, score


def legacy_score_contract(df: DataFrame, sheet: DataFrame | None) -> DataFrame:
    """Rename, ensure columns, score every row; rows with a valid score get
    CONTRATACAO from the sheet (JN2), the others keep theirs (JN12: computed
    on the full table with ``when``, no self-join).  A missing sheet (IO11)
    leaves CONTRATACAO untouched."""
    df = clean.rename(df, clean.SCORED_RENAMES)
    df, _ = clean.ensure_columns(df, clean.SCORED_REQUIRED)
    df = score.row_score(df)
    if sheet is None:
        return df
    keep = F.col("CONTRATACAO").alias("__c0")
    j = lookup.contract(df.select("*", keep), sheet, out="__looked")
    valid = F.col(f"`{score.VALID}`") > 0
    return j.withColumn("CONTRATACAO", F.when(valid, F.col("__looked")).otherwise(F.col("__c0"))) \
            .drop("__looked", "__c0")
