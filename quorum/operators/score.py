"""Row scores, unit results and status (SC12, SC13, AN1, AN5, AG8, FI1).

The unit result is a grouped mean broadcast back to every row.  It is
computed as ``groupBy(keys).agg`` (map-side partial sums of integer
hundredths, so one hot unit holding a third of the rows costs one partial
row per task) and a null-safe left join back to the rows.  The aggregated
side has one row per unit and is written before the join
(:func:`quorum.operators.lookup.sized`), which broadcasts it when it is small
and otherwise leaves the planner a join whose skewed fact partitions AQE splits.  No window over the unit keys is used: that
would shuffle every full row and put a hot unit in a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.functions import text as tx
from quorum.functions.predicates import is_blank
from quorum.operators.lookup import sized
from quorum.sources.io import step_table

SCORES = ("NOTA1", "NOTA2", "NOTA3", "NOTA4", "NOTA5")
UNIT_KEYS = ("CLASSIFICACAO", "LOCAL EDITADO", "UF")
VALID = "Quantidade notas validas"


def q(c: str) -> Column:
    return F.col(f"`{c}`")


def count_valid_scores(df: DataFrame, scores=SCORES, out: str = VALID) -> DataFrame:
    """SC12 count after numeric coercion of each score."""
    return df.withColumn(out, tx.row_count_valid([q(s) for s in scores]))


def keep_scored(df: DataFrame, scores=SCORES, out: str = VALID) -> DataFrame:
    """FI1: rows with at least one valid score (the count column is kept)."""
    return count_valid_scores(df, scores, out).where(q(out) > 0)


def row_score(df: DataFrame, scores=SCORES, out: str = "NOTA GERAL",
              count_out: str = VALID) -> DataFrame:
    """SC12+SC13: count of valid scores and their mean rounded to 2 decimals."""
    cols = [q(s) for s in scores]
    return df.withColumns({
        count_out: tx.row_count_valid(cols),
        out: tx.round2(tx.row_mean(cols)),
    })


def hundredths(c: Column) -> Column:
    return F.rint(c * 100).cast("long")


def mean_of_hundredths(total: Column, n: Column) -> Column:
    """Mean of values given as the sum of their integer hundredths, rounded to 2."""
    return F.when(n > 0, tx.round2(total.cast("double") / (F.lit(100.0) * n.cast("double"))))


def normalize_unit_keys(df: DataFrame, keys=UNIT_KEYS, uf: str = "UF",
                        default_uf: str | None = "CE") -> DataFrame:
    """SC5 on the unit keys; PR14 blank or 'vazio' UF -> default."""
    df = df.withColumns({k: tx.normalize(q(k)) for k in keys})
    if default_uf is not None and uf in keys:
        u = q(uf)
        df = df.withColumn(uf, F.when(is_blank(u) | (F.lower(u) == "vazio"), F.lit(default_uf))
                           .otherwise(u))
    return df


def unit_result(df: DataFrame, keys=UNIT_KEYS, score: str = "NOTA GERAL",
                out: str = "RESULTADO DA UNIDADE", normalize_keys: bool = True) -> DataFrame:
    """AN1: per-unit mean of ``score`` on every row; null keys form units."""
    keys = list(keys)
    if normalize_keys:
        df = normalize_unit_keys(df, keys)
    df = df.withColumn(score, tx.to_number(q(score)))
    renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
    units = (df.groupBy(*[q(k).alias(renamed[k]) for k in keys])
               .agg(F.sum(hundredths(q(score))).alias("__s"), F.count(q(score)).alias("__n"))
               .select(*[F.col(renamed[k]) for k in keys],
                       mean_of_hundredths(F.col("__s"), F.col("__n")).alias("__r")))
    units = sized(units, "units")
    base = df.drop(out)
    cond = reduce(lambda a, b: a & b,
                  [base[f"`{k}`"].eqNullSafe(units[renamed[k]]) for k in keys])
    j = base.join(units, cond, "left").drop(*renamed.values())
    return j.withColumnRenamed("__r", out)


def status(df: DataFrame, result: str = "RESULTADO DA UNIDADE", meta: str = "META",
           out: str = "STATUS UNIDADE") -> DataFrame:
    """AN5: below target -> 'fora da meta', at/above -> 'dentro da meta', missing -> null."""
    r, m = tx.to_number(q(result)), tx.to_number(q(meta))
    return df.withColumn(out, F.when(r.isNull() | m.isNull(), F.lit(None).cast("string"))
                         .when(r < m, "fora da meta").otherwise("dentro da meta"))


def order_number(columns: dict) -> Column:
    """One number that orders rows by several integer columns, each of at most the given number of digits.

    A decimal, so that its minimum is a hash aggregate's; a value with more digits, or below 0, stops the job.
    """
    if sum(columns.values()) > 38:
        raise ValueError("an order number has at most 38 digits")
    parts = []
    for c, n in columns.items():
        fits = (q(c) >= 0) & (q(c) < F.lit(10 ** n).cast("decimal(38,0)"))
        parts.append(F.when(fits, F.lpad(q(c).cast("string"), n, "0")).otherwise(F.raise_error(F.lit(f"{c} has more than {n} digits"))))
    return F.concat(*parts).cast("decimal(38,0)")


def unit_inspection(df: DataFrame, order: Column, keys=UNIT_KEYS, score: str = "NOTA GERAL",
                    result: str = "RESULTADO DA UNIDADE", meta: str = "META",
                    operator: str = "OPERADORA") -> DataFrame:
    """AG8: per unit size, first result, min/max score, first META and OPERADORA (first: not null).

    ``order`` is a unique number of each row (:func:`order_number`).  A hash aggregate finds the
    smallest number with a value per unit and column; the values are then looked up by number in the
    rows that have one of these, which are at most as many as there are units and columns.  The
    numbers are written first and broadcast when they are few (:func:`quorum.operators.lookup.sized`),
    so that no other row is moved.  ``df`` is read twice, so it should be a written table.
    """
    firsts = {"RESULTADO_DA_UNIDADE": result}
    firsts |= {c: c for c in (meta, operator) if c in df.columns}
    rows = df.withColumn("__o", order)
    units = step_table(rows.groupBy(*[q(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("QUANTIDADE_LINHAS"), F.min(q(score)).alias("NOTA_GERAL_MIN"), F.max(q(score)).alias("NOTA_GERAL_MAX"),
        *[F.min(F.when(q(c).isNotNull(), F.col("__o"))).alias(f"__first_{n}") for n, c in enumerate(firsts.values())]), "inspected_units")
    wanted = reduce(lambda a, b: a.union(b), [units.select(F.col(f"__first_{n}").alias("__o")) for n in range(len(firsts))])
    wanted = sized(wanted.where(F.col("__o").isNotNull()).distinct(), "first_rows")
    picked = sized(rows.join(wanted, "__o", "left_semi").select("__o", *[q(c) for c in firsts.values()]), "first_values")
    for n, (out, c) in enumerate(firsts.items()):
        one = picked.select(F.col("__o").alias(f"__first_{n}"), q(c).alias(f"__value_{n}"))
        units = units.join(one, f"__first_{n}", "left")
    return units.select(*[q(k) for k in keys], "QUANTIDADE_LINHAS", "NOTA_GERAL_MIN", "NOTA_GERAL_MAX",
                        *[F.col(f"__value_{n}").alias(out) for n, out in enumerate(firsts)])


def blank_key_rows(df: DataFrame, keys=UNIT_KEYS, out: str = "COLUNA_VAZIA") -> DataFrame:
    """FI15/SC20: rows with any blank unit key, naming the blank keys."""
    cond = reduce(lambda a, b: a | b, [is_blank(q(k)) for k in keys])
    return df.where(cond).withColumn(out, tx.blank_columns(list(keys)))
