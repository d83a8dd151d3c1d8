"""Splits and routing into delivery groups (FI9, IO12-IO15, JN6, JN7, AG11-AG15).

Routing needs no join: the class -> group table is configuration (a few
dozen entries), compiled into a literal map looked up per row.  Delivery
datasets are one write partitioned by (group, origin), not a loop of
filtered writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.config.classification import DELIVERY_GROUPS
from quorum.functions import text as tx
from quorum.functions.predicates import at_least, between
from quorum.operators.lookup import apply_send_names, assign_group, by_distinct, class_group_map
from quorum.operators.summary import union_sources

GROUP, NORM = "GRUPO", "CLASSIFICACAO_NORMALIZADA"

# --- fixed values: TIPO ranges of the two splits -----------------------------
TWO_WAY = (("tipo_1_a_7", 1, 7), ("tipo_8_ou_mais", 8, None))
THREE_WAY = (("tipo_1_a_3", 1, 3), ("tipo_4_a_7", 4, 7), ("tipo_8_ou_mais", 8, None))
OUTSIDE = "fora_do_recorte"


def q(c: str) -> Column:
    return F.col(f"`{c}`")


def range_label(tipo: Column, ranges) -> Column:
    """FI9: label of the first range containing ``tipo``; outside -> OUTSIDE."""
    expr = None
    for name, lo, hi in ranges:
        cond = at_least(tipo, lo) if hi is None else between(tipo, lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OUTSIDE))


def split_by_type(df: DataFrame, ranges=TWO_WAY, tipo: str = "TIPO", out: str = "FAIXA",
                  names: dict | None = None) -> DataFrame:
    """IO12/IO13 preparation: TIPO numeric, ids without '.0', delivery names,
    and the range label used as the output partition column."""
    df = df.withColumn(tipo, tx.to_number(q(tipo)))
    for c in ("NUM_BENEFICIARIO", "TELEFONE"):
        if c in df.columns:
            df = df.withColumn(c, tx.drop_decimal_zero_trimmed(q(c)))
    if "CLASSIFICACAO" in df.columns:
        df = apply_send_names(df, "CLASSIFICACAO", names)
    return df.withColumn(out, range_label(q(tipo), ranges))


def route(sources: dict, cls: str = "CLASSIFICACAO", groups: dict | None = None,
          origin: str = "ORIGEM") -> DataFrame:
    """PL3 core: union the sources (written tables) with their origin and assign each row its
    delivery group (null when the class is in no group).  A class is folded once."""
    groups = DELIVERY_GROUPS if groups is None else groups
    class_group_map(groups)  # validates: a class may be in one group only
    return assign_group(union_sources(sources, origin), cls, groups, GROUP, NORM, distinct=True)


def delivery(routed: DataFrame, cls: str = "CLASSIFICACAO", names: dict | None = None) -> DataFrame:
    """IO14 content: routed rows (a written table), helper columns dropped, delivery names applied."""
    return apply_send_names(routed.where(q(GROUP).isNotNull()).drop(NORM), cls, names, distinct=True)


def class_counts(routed: DataFrame, origin: str = "ORIGEM") -> DataFrame:
    """AG11: rows per (group, normalised class, origin); unrouted rows dropped."""
    return (routed.where(q(GROUP).isNotNull())
            .groupBy(GROUP, NORM, origin).agg(F.count(F.lit(1)).alias("QUANTIDADE")))


def _rule_table(spark, groups):
    rows, seen = [], set()
    for g, classes in groups.items():
        for c in classes:
            k = tx.fold_key_py(c)
            if (g, k) not in seen:
                seen.add((g, k))
                rows.append((g, k, c))
    return spark.createDataFrame(rows, "GRUPO string, CLASSIFICACAO_NORMALIZADA string, CLASSIFICACAO string")


def per_file_counts(routed: DataFrame, groups: dict | None = None, origins=("avaliacoes", "negativas"),
                    origin: str = "ORIGEM") -> DataFrame:
    """AG12: rows per delivery group and origin plus total; zero-filled from the rules."""
    groups = DELIVERY_GROUPS if groups is None else groups
    spark = routed.sparkSession
    g = (routed.where(q(GROUP).isNotNull())
         .groupBy(GROUP).pivot(origin, list(origins)).agg(F.count(F.lit(1))))
    all_groups = spark.createDataFrame([(x,) for x in groups], "GRUPO string")
    out = all_groups.join(g, GROUP, "left").fillna(0, subset=list(origins))
    return out.select(GROUP, *[F.col(o).cast("long").alias(o.upper()) for o in origins],
                      sum(F.col(o) for o in origins).cast("long").alias("TOTAL"))


def per_class_counts(routed: DataFrame, groups: dict | None = None, origins=("avaliacoes", "negativas"),
                     origin: str = "ORIGEM") -> DataFrame:
    """AG13/JN9: rows per rule class and group, zeros included."""
    groups = DELIVERY_GROUPS if groups is None else groups
    spark = routed.sparkSession
    counts = (class_counts(routed, origin).groupBy(GROUP, NORM).pivot(origin, list(origins))
              .agg(F.sum("QUANTIDADE")))
    rules = _rule_table(spark, groups)
    out = rules.join(counts, [GROUP, NORM], "left").fillna(0, subset=list(origins))
    return out.select(GROUP, "CLASSIFICACAO", *[F.col(o).cast("long").alias(o.upper()) for o in origins],
                      sum(F.col(o) for o in origins).cast("long").alias("TOTAL"))


def unassigned(routed: DataFrame, cls: str = "CLASSIFICACAO", origin: str = "ORIGEM") -> DataFrame:
    """AG14: classes that went to no group, per origin (null -> VAZIO)."""
    return (routed.where(q(GROUP).isNull())
            .groupBy(q(origin).alias(origin), F.coalesce(q(cls), F.lit("VAZIO")).alias(cls))
            .agg(F.count(F.lit(1)).alias("QUANTIDADE")))


def reconciliation(routed: DataFrame, delivered: DataFrame, origin: str = "ORIGEM") -> DataFrame:
    """AG15: origin total, sent, not sent, difference and OK flag, per origin and overall.

    Sent is what the written delivery holds, not sent what was given no group; the difference is what
    got lost (or came in twice) between.  Both sides are counted by origin, then the counts meet.
    """
    per = routed.groupBy(origin).agg(F.count(F.lit(1)).alias("TOTAL_ORIGEM"),
                                     F.count(F.when(q(GROUP).isNull(), 1)).alias("TOTAL_NAO_ENVIADO"))
    sent = delivered.groupBy(origin).agg(F.count(F.lit(1)).alias("TOTAL_ENVIADO"))
    each = per.join(sent, origin, "full").fillna(0)
    totals = each.agg(F.lit("total").alias(origin), *[F.sum(c).alias(c) for c in each.columns[1:]])
    out = each.unionByName(totals).withColumn("DIFERENCA", F.col("TOTAL_ORIGEM") - F.col("TOTAL_ENVIADO") - F.col("TOTAL_NAO_ENVIADO"))
    return out.withColumn("OK", F.col("DIFERENCA") == 0)


def delivery_differences(routed: DataFrame, delivered: DataFrame, origin: str = "ORIGEM") -> DataFrame:
    """AG15 by partition: (group, origin) whose written rows are not as many as were routed there, absent ones too."""
    counted = lambda df, n: df.groupBy(GROUP, origin).agg(F.count(F.lit(1)).alias(n))
    both = counted(routed.where(q(GROUP).isNotNull()), "ESPERADO").join(counted(delivered, "ENCONTRADO"), [GROUP, origin], "full").fillna(0)
    return both.where(F.col("ESPERADO") != F.col("ENCONTRADO"))


def in_group(df: DataFrame, group: str, cls: str = "CLASSIFICACAO", groups: dict | None = None) -> DataFrame:
    """FI11/IO15: rows whose normalised class is in one group's class set."""
    groups = DELIVERY_GROUPS if groups is None else groups
    keys = sorted({tx.fold_key_py(c) for c in groups[group]})
    return by_distinct(df, cls, __in=lambda c: tx.fold_key(c).isin(*keys)).where("__in").drop("__in")


# --- fixed values: the older class lists of the one-group form (the other groups are as in DELIVERY_GROUPS)
ONE_GROUP_CLASSES = DELIVERY_GROUPS | {
    "med prev e programas especiais": [
        "CASE", "GESTAR BEM", "INTERNACAO PGC", "MED PREV", "NASCER BEM",
        "PRODUTO COORDENADO", "TEA", "TRANSPLANTE RENAL",
    ],
    "teleconsulta": [
        "HAPCLINICA DIGITAL TELEMEDICINA", "TELECONSULTA - DIGITAL", "TELEMEDICINA FERNANDES LIMA",
        "TELEMEDICINA LOBO FILHO", "TELEMEDICINE RODOLFO FERNANDES",
    ],
}


def deliver_groups(sources: dict, path: str, groups: dict | None = None, only: str | None = None,
                   cls: str = "CLASSIFICACAO", origin: str = "ORIGEM") -> None:
    """IO15/PL4: the rows of every group (or of one) as datasets per group and source, in one write."""
    groups = ONE_GROUP_CLASSES if groups is None else groups
    if only is not None and only not in groups:
        raise ValueError(f"unknown group: {only}")
    rows = assign_group(union_sources(sources, origin), cls, groups if only is None else {only: groups[only]}, GROUP, None, distinct=True)
    rows.where(q(GROUP).isNotNull()).write.mode("overwrite").partitionBy(GROUP, origin).parquet(path)
