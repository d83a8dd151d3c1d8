"""Aggregations, sorts and summary tables (AG*, SO*, SE*, PR13, PR15).

Every summary is a ``groupBy``/``agg`` with map-side partial aggregation,
so a value holding a third of the rows costs one partial row per task.
Results are small (one row per distinct value); ordering is applied last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.functions import text as tx


def q(c: str) -> Column:
    return F.col(f"`{c}`")


def frequency(df: DataFrame, col: str, null_label: str | None = "VAZIO",
              out: str = "QUANTIDADE", alias: str | None = None) -> DataFrame:
    """AG2: value counts of one column; null -> ``null_label`` (or dropped if None)."""
    c = q(col)
    if null_label is None:
        df, key = df.where(c.isNotNull()), c
    else:
        key = F.coalesce(c, F.lit(null_label))
    return df.groupBy(key.alias(alias or col)).agg(F.count(F.lit(1)).alias(out))


def multi_frequency(df: DataFrame, cols, out: str = "QUANTIDADE", fill: str | None = None) -> DataFrame:
    """AG1/AG3: counts over several columns.  ``fill=None`` drops rows with a
    null in any of them (pandas ``value_counts``); otherwise nulls -> ``fill``."""
    cols = list(cols)
    if fill is None:
        df = df.dropna(subset=cols)
        keys = [q(c).alias(c) for c in cols]
    else:
        keys = [F.coalesce(q(c), F.lit(fill)).alias(c) for c in cols]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def conditional_totals(df: DataFrame, conds: dict) -> DataFrame:
    """AG6: one row of ``count_if`` totals, one column per named condition."""
    return df.agg(*[F.count(F.when(c, 1)).alias(n) for n, c in conds.items()])


def sort_count_desc(df: DataFrame, keys, count: str = "QUANTIDADE") -> DataFrame:
    """SO1/SO2: count descending, keys ascending (nulls last) as tie-break."""
    return df.orderBy(F.col(count).desc(), *[q(k).asc_nulls_last() for k in keys])


def top(df: DataFrame, n: int, keys, count: str = "QUANTIDADE") -> DataFrame:
    """SO5/SO6: top-n by count (TakeOrderedAndProject, no full sort)."""
    return sort_count_desc(df, keys, count).limit(n)


def first_with_remainder(df: DataFrame, n: int, order) -> tuple[DataFrame, DataFrame]:
    """SO7: first ``n`` rows in ``order`` and a one-row remainder count."""
    head = df.orderBy(*order).limit(n)
    rest = df.agg(F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0)).alias("RESTANTES"))
    return head, rest


def class_summary(df: DataFrame, cls: str = "CLASSIFICACAO", score: str = "NOTA GERAL") -> DataFrame:
    """AG9 (+FI14): per class row count and mean score rounded to 2.

    Blank-like classes ('', 'nan', 'None' after trimming) and rows whose
    score does not parse are dropped first.
    """
    c = tx.strip(q(cls).cast("string"))
    s = tx.to_number(q(score))
    base = (df.select(F.when(~c.isin("", "nan", "None"), c).alias(cls), s.alias(score))
              .where(q(cls).isNotNull() & q(score).isNotNull()))
    return base.groupBy(cls).agg(F.count(F.lit(1)).alias("CONTAGEM"),
                                 _mean2(q(score)).alias("MEDIA_NOTA_GERAL"))


def _hundredths(c: Column) -> Column:
    return F.rint(c * 100).cast("long")


def _mean_of(total: Column, n: Column) -> Column:
    return tx.round2(total.cast("double") / (F.lit(100.0) * n.cast("double")))


def _mean2(c: Column) -> Column:
    return _mean_of(F.sum(_hundredths(c)), F.count(c))


def discard_counts(df: DataFrame, key: str, score: str = "NOTA GERAL") -> DataFrame:
    """FI14 counters: rows dropped for a blank key, for a null score, and for
    a score that was present but did not parse (one aggregate)."""
    c = tx.strip(q(key).cast("string"))
    blank_key = c.isNull() | c.isin("", "nan", "None")
    s = tx.to_number(q(score))
    return df.agg(
        F.count(F.lit(1)).alias("LINHAS"),
        F.count(F.when(blank_key, 1)).alias("DESCARTADAS_CHAVE"),
        F.count(F.when(~blank_key & s.isNull(), 1)).alias("DESCARTADAS_NOTA"),
        F.count(F.when(~blank_key & s.isNull() & q(score).isNotNull(), 1)).alias("ERRO_CONVERSAO"),
    )


def operator_summary(df: DataFrame, op: str = "OPERADORA", score: str = "NOTA GERAL",
                     combined=None, label: str | None = None) -> DataFrame:
    """AG10: per operator count and mean, plus one combined row for a set of
    operators (omitted when empty).  Rows are counted and summed by operator
    first; only these totals are exploded into the groups they belong to, so
    the combined row costs no second pass."""
    from quorum.config.operator import COMBINED_LABEL, COMBINED_OPERATORS
    combined = list(combined or COMBINED_OPERATORS)
    label = label or COMBINED_LABEL
    scores = df.select(q(op).cast("string").alias("__raw"), tx.to_number(q(score)).alias("__s")).where(F.col("__s").isNotNull())
    totals = scores.groupBy("__raw").agg(F.count(F.lit(1)).alias("__n"), F.sum(_hundredths(F.col("__s"))).alias("__h"))
    c = tx.strip(F.col("__raw"))
    base = (totals.select(F.when(~c.isin("", "nan", "None"), c).alias("__op"), "__n", "__h")
                  .where(F.col("__op").isNotNull()))
    groups = F.array(F.col("__op"), F.when(F.col("__op").isin(*combined), F.lit(label)))
    ex = base.select(F.explode(F.filter(groups, lambda g: g.isNotNull())).alias(op), "__n", "__h")
    n = F.sum("__n")
    return ex.groupBy(op).agg(n.alias("CONTAGEM"), _mean_of(F.sum("__h"), n).alias("MEDIA_NOTA_GERAL"))


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """AG17: keys with more than one distinct value, a row per value.

    The values come from a distributed distinct; nothing is gathered for a key.  Null values are none.
    """
    pairs = df.where(q(value).isNotNull()).select(q(key).alias(key), q(value).alias(value)).distinct()
    many = pairs.groupBy(q(key).alias("__k")).agg(F.count(F.lit(1)).alias("TOTAL_VALORES")).where(F.col("TOTAL_VALORES") > 1)
    return pairs.join(many, q(key).eqNullSafe(F.col("__k"))).select(key, value, "TOTAL_VALORES")


def with_origin(df: DataFrame, origin: str, col: str = "ORIGEM") -> DataFrame:
    """PR13: provenance column in front."""
    return df.select(F.lit(origin).alias(col), *[q(c) for c in df.columns])


def union_sources(frames: dict, col: str = "ORIGEM") -> DataFrame:
    """SE1/SE3/IO7: union by name of tagged sources (missing columns -> null)."""
    tagged = [with_origin(f, name, col) for name, f in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def records(df: DataFrame, cols) -> DataFrame:
    """PR15: rows as text records, null kept; a table, whatever its length."""
    return df.select(*[q(c).cast("string").alias(c) for c in cols])
