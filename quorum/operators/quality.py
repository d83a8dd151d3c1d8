"""Data-quality checks (DQ1-DQ13) as jobs that return violation tables.

Each check reads a step's input and/or output and returns rows describing
what is wrong (empty = passed) or a one-row table of totals to compare.
All are scans plus aggregates or left joins against small dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.functions import text as tx
from quorum.functions.predicates import is_blank
from quorum.operators import summary


def q(c: str) -> Column:
    return F.col(f"`{c}`")


def score_violations(df: DataFrame, scores, keys, low=1, high=5) -> DataFrame:
    """DQ3: one row per row, score column and reason that the value is invalid.

    Blank values are skipped; a value can be both no integer and out of range.
    """
    n = len(scores)
    pairs = ", ".join(f"'{s}', cast(`{s}` as string)" for s in scores)
    long = df.select(*[q(k) for k in keys], F.expr(f"stack({n}, {pairs}) as (COLUNA, VALOR)"))
    long = long.withColumn("VALOR", tx.strip(q("VALOR"))).where(~is_blank(q("VALOR")))
    v = tx.to_number(q("VALOR"))
    reasons = F.array_compact(F.array(
        F.when(v.isNull(), F.lit("valor nao numerico")),
        F.when(v != F.floor(v), F.lit("valor numerico nao inteiro")),
        F.when((v < low) | (v > high), F.lit(f"valor fora do intervalo {low} a {high}"))))
    return long.withColumn("MOTIVO", F.explode(reasons))


CHECK, POSITION, REST = "CHECAGEM", "POSICAO", "RESTANTES"


def violations(df: DataFrame, keys, checks: dict) -> DataFrame:
    """DQ4-DQ7: a row per check and row that fails it: check, keys, VALOR, ESPERADO.

    ``checks`` gives (fails, found, expected or None) columns for each name.  All are tested in one
    pass over ``df``.
    """
    none = F.lit(None).cast("string")
    found = [F.when(fails, F.struct(F.lit(name).alias(CHECK), value.cast("string").alias("VALOR"),
                                    (none if expected is None else expected.cast("string")).alias("ESPERADO")))
             for name, (fails, value, expected) in checks.items()]
    rows = df.select(*[q(k) for k in keys], F.explode_outer(F.array_compact(F.array(*found))).alias("v"))
    return rows.where(F.col("v").isNotNull()).select(F.col(f"v.{CHECK}").alias(CHECK), *[q(k) for k in keys], "v.VALOR", "v.ESPERADO")


def first_violations(found: DataFrame, order, shown: int = 20) -> DataFrame:
    """The first ``shown`` violations of each check, and how many more there are.

    ``found`` is a written table.  Every task keeps the first rows of each check before anything is
    shuffled, so a check that all rows fail costs no more than another.  The row after the last shown
    one has ``RESTANTES``, the number of those that are not shown.
    """
    w = Window.partitionBy(CHECK).orderBy(*order)
    head = found.withColumn(POSITION, F.row_number().over(w)).where(F.col(POSITION) <= shown)
    more = found.groupBy(CHECK).agg((F.count(F.lit(1)) - shown).alias(REST)).where(F.col(REST) > 0)
    return head.unionByName(more.withColumn(POSITION, F.lit(shown + 1)), allowMissingColumns=True)


def sheet_violations(sheet: DataFrame, line: Column, key: Column, value: Column, allowed=None) -> DataFrame:
    """DQ6: lookup rows with a blank key or a value that is not allowed, and the values of conflicting keys.

    ``line`` numbers the sheet's rows; a conflict has a row per value and the key instead of a line.
    """
    s = sheet.select(line.alias("LINHA"), F.coalesce(key, F.lit("")).alias("CHAVE"), F.coalesce(value, F.lit("")).alias("VALOR"))
    blank, empty = F.col("CHAVE") == "", F.col("VALOR") == ""
    bad = ~empty & ~F.col("VALOR").isin(*allowed) if allowed is not None else F.lit(False)
    rows = violations(s, ["LINHA", "CHAVE"], {"chave vazia": (blank, F.col("VALOR"), None), "valor invalido": (bad, F.col("VALOR"), None)})
    pairs = summary.conflicts(s.where(~blank & ~empty), "CHAVE", "VALOR")
    return rows.unionByName(pairs.select(F.lit("valores conflitantes").alias(CHECK), F.lit(None).cast("long").alias("LINHA"), "CHAVE", "VALOR",
                                         F.lit(None).cast("string").alias("ESPERADO")))


def output_violations(out: DataFrame, dim: DataFrame, keys, key: Column, col: str, dim_key: str, dim_val: str) -> DataFrame:
    """DQ7: rows for whose key the lookup expects nothing, and rows that differ from what it expects (blank: '')."""
    j = out.withColumn("__k", key).join(dim, F.col("__k").eqNullSafe(dim[dim_key]), "left")
    expected, found = F.nullif(F.col(dim_val), F.lit("")), F.coalesce(q(col), F.lit(""))
    return violations(j, keys, {"sem correspondencia": (expected.isNull(), F.col("__k"), None),
                                "divergente": (expected.isNotNull() & (found != expected), found, expected)})


def not_in_allowed(df: DataFrame, col: str, allowed) -> DataFrame:
    """DQ5: values outside the allowed set (null allowed), with counts."""
    return (df.where(q(col).isNotNull() & ~q(col).isin(*allowed))
            .groupBy(q(col).alias(col)).agg(F.count(F.lit(1)).alias("QUANTIDADE")))


def lookup_validity(sheet: DataFrame, key: Column, value: Column, allowed) -> DataFrame:
    """DQ6: blank keys, values outside the allowed set, keys with conflicting values."""
    s = sheet.select(key.alias("k"), value.alias("v"))
    per_key = s.where(~is_blank(F.col("k"))).groupBy("k").agg(F.count_distinct("v").alias("n"))
    totals = s.agg(F.count(F.when(is_blank(F.col("k")), 1)).alias("CHAVES_VAZIAS"),
                   F.count(F.when(F.col("v").isNull() | ~F.col("v").isin(*allowed), 1)).alias("VALORES_INVALIDOS"))
    conf = per_key.agg(F.count(F.when(F.col("n") > 1, 1)).alias("CHAVES_CONFLITANTES"))
    return measures(totals).unionByName(measures(conf))


def output_vs_lookup(out: DataFrame, dim: DataFrame, key: Column, col: str, dim_key: str, dim_val: str) -> DataFrame:
    """DQ7: output column against the (deduplicated) lookup, one row: rows for
    whose key the lookup expects nothing, and rows that differ from what it expects."""
    j = out.select(key.alias("__k"), q(col).alias("__o")).join(dim, F.col("__k").eqNullSafe(dim[dim_key]), "left")
    expected = F.col(dim_val)
    return j.agg(F.count(F.when(expected.isNull(), 1)).alias("SEM_CORRESPONDENCIA"),
                 F.count(F.when(expected.isNotNull() & ~F.col("__o").eqNullSafe(expected), 1)).alias("DIVERGENTES"))


def measures(one_row: DataFrame) -> DataFrame:
    """A one-row table of totals as (MEDIDA, VALOR) rows."""
    n = len(one_row.columns)
    pairs = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in one_row.columns)
    return one_row.select(F.expr(f"stack({n}, {pairs}) as (MEDIDA, VALOR)"))


def row_counts(frames: dict) -> DataFrame:
    """DQ8: (TABELA, LINHAS) for each named table.

    A value is a table, or a table with conditions by name: the rows that fulfil each are counted in
    one scan.  A written Parquet table is counted from its footers.
    """
    parts = []
    for n, f in frames.items():
        df, conditions = f if isinstance(f, tuple) else (f, {n: F.lit(True)})
        parts.append(measures(df.agg(*[F.count(F.when(c, 1)).alias(name) if len(conditions) > 1 else F.count(F.lit(1)).alias(name)
                                       for name, c in conditions.items()])).withColumnsRenamed({"MEDIDA": "TABELA", "VALOR": "LINHAS"}))
    return reduce(lambda a, b: a.unionByName(b), parts)


def score_recheck(df: DataFrame, scores, count_col: str, mean_col: str) -> DataFrame:
    """DQ9: recompute count and mean; rows where stored values differ, and
    means outside 1..5."""
    cols = [q(s) for s in scores]
    n = tx.row_count_valid(cols)
    m = tx.round2(tx.row_mean(cols))
    return df.agg(F.count(F.lit(1)).alias("LINHAS"),
                  F.count(F.when(~n.eqNullSafe(q(count_col)), 1)).alias("CONTAGEM_DIVERGENTE"),
                  F.count(F.when(~m.eqNullSafe(q(mean_col)), 1)).alias("MEDIA_DIVERGENTE"),
                  F.count(F.when((q(mean_col) < 1) | (q(mean_col) > 5), 1)).alias("MEDIA_FORA_1_A_5"))


def summary_divergences(summary: DataFrame, totals: DataFrame) -> DataFrame:
    """DQ10: fields of a written one-row summary that differ from the totals of the data (absent: null)."""
    fields = totals.columns
    absent = [F.lit(None).cast("long").alias(c) for c in fields if c not in summary.columns]
    found = measures(summary.select(*[q(c) for c in fields if c in summary.columns], *absent))
    both = measures(totals).select(F.col("MEDIDA").alias("CAMPO"), F.col("VALOR").alias("ESPERADO")).join(
        found.select(F.col("MEDIDA").alias("CAMPO"), F.col("VALOR").alias("ENCONTRADO")), "CAMPO", "left")
    return both.where(~F.col("ESPERADO").eqNullSafe(F.col("ENCONTRADO")))


def audit_completeness(audit: DataFrame, rules_table: DataFrame) -> DataFrame:
    """DQ12: full outer join audit <-> rules on the rule order: missing,
    extra, and rows whose key or name differ."""
    a = audit.select(F.col("ORDEM_REGRA").alias("o"), F.col("CHAVE_GRUPO").alias("ka"),
                     F.col("CLASSIFICACAO").alias("na"))
    r = rules_table.select(F.col("ORDEM_REGRA").alias("o2"), F.col("CHAVE_GRUPO").alias("kr"),
                           F.col("CLASSIFICACAO").alias("nr"))
    j = a.join(r, a.o == r.o2, "full")
    return j.agg(F.count(F.when(F.col("o").isNull(), 1)).alias("REGRAS_SEM_AUDITORIA"),
                 F.count(F.when(F.col("o2").isNull(), 1)).alias("AUDITORIAS_SEM_REGRA"),
                 F.count(F.when(F.col("o").isNotNull() & F.col("o2").isNotNull()
                                & ~(F.col("ka").eqNullSafe(F.col("kr")) & F.col("na").eqNullSafe(F.col("nr"))), 1))
                 .alias("CHAVES_OU_NOMES_DIFERENTES"))
