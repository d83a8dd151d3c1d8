"""PL1 / PL2: the scored and negative pipelines as one lazy plan each.

``read -> clean -> contract -> score -> classify -> edited place ->
operator -> target -> unit result -> status``.  All steps are projections,
filters and lookups (contract and edited place by one join, as both go by
LOCAL) except the unit result (one partial aggregate + join
back), which needs its input twice: the stage before it is written once to
shared storage, so the source is read and joined once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quorum.operators import clean, lookup, operator_rules, rules, score
from quorum.sources.io import persist_table, step_table  # noqa: F401


def scored_pipeline(df: DataFrame, contract_sheet: DataFrame, edited_sheet: DataFrame,
                    unit_sheet: DataFrame | None, meta_sheet: DataFrame,
                    class_rules=None, names=None) -> DataFrame:
    """PL1: all ten steps of the scored table (before the split)."""
    df = clean.clean_scored(df)
    df = lookup.places(df, contract_sheet, edited_sheet)
    df = score.row_score(df)
    df = rules.classify(df, class_rules, names)
    df = operator_rules.assign_operator(df, unit_sheet)
    df = lookup.target(df, meta_sheet).drop("GRUPO_ENCONTRADO")
    df = step_table(score.normalize_unit_keys(df), "before_unit")
    df = score.unit_result(df, normalize_keys=False)
    return score.status(df)


def negative_pipeline(df: DataFrame, contract_sheet: DataFrame, edited_sheet: DataFrame,
                      class_rules=None, names=None) -> DataFrame:
    """PL2: clean, contract, classify, edited place (before the split)."""
    df = lookup.places(clean.clean_negative(df), contract_sheet, edited_sheet)
    return rules.classify(df, class_rules, names)
