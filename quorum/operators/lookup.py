"""Lookups against small dimension sheets (JN1-JN11, AG16).

All lookups are left equi-joins of the (large) survey table against a
deduplicated dimension.  The dimension is deduplicated keep-first by an
explicit order column with ``min_by`` (partial aggregation, so a hot key in
the sheet costs nothing extra).  The reduced sheet is written before the join,
so its size is known when the join is planned: the survey's rows are then not
shuffled by a hot place only to find that the sheet could have been broadcast.
A sheet of more than ``BROADCAST_ROWS`` rows is left to the planner, which
joins by a shuffle whose skewed fact partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.functions import text as tx
from quorum.sources.io import step_table

#: Rows of a reduced sheet that go to every executor; a larger one is broadcast only under the planner's own threshold.
BROADCAST_ROWS = 500_000


def _written(dim: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """A reduced sheet as a written table, and whether it is small (its rows are counted from the files' footers)."""
    written = step_table(dim, name)
    small = written.count() <= BROADCAST_ROWS
    return F.broadcast(written) if small else written, small


def sized(dim: DataFrame, name: str) -> DataFrame:
    """A reduced sheet as a written table, broadcast when it is small."""
    return _written(dim, name)[0]


def keep_first(df: DataFrame, keys, values, order: str) -> DataFrame:
    """AG16/AN2: one row per key, the values of the row with the lowest ``order``.

    Null keys form their own group (like ``drop_duplicates``).  Uses
    ``min_by`` over a struct, so the reduction is map-side combined.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    vals = F.struct(*[F.col(f"`{v}`").alias(v) for v in values])
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys])
              .agg(F.min_by(vals, F.col(order)).alias("_v"))
              .select(*[F.col(f"`{k}`") for k in keys], *[F.col("_v")[v].alias(v) for v in values]))


def _join_dim(fact: DataFrame, dim: DataFrame, name: str, fact_key: Column, dim_key: str,
              null_safe: bool, short: bool = True) -> DataFrame:
    """``fact`` with the columns of the reduced sheet ``dim``, which is written under ``name``.

    A broadcast join evaluates a key once a row, so no column is made of a ``short`` one, which would
    copy every row once more; a join by sorted rows would evaluate it at every comparison.  A long
    expression as a key keeps the optimiser busy.
    """
    dim, small = _written(dim, name)
    fk, bare = "__fk", small and short
    f = fact if bare else fact.withColumn(fk, fact_key)
    key = fact_key if bare else F.col(fk)
    cond = key.eqNullSafe(F.col(dim_key)) if null_safe else (key == F.col(dim_key))
    return f.join(dim, cond, "left").drop(fk, dim_key)


def contract(fact: DataFrame, sheet: DataFrame, local: str = "LOCAL",
             out: str = "CONTRATACAO", sheet_local: str = "Local",
             sheet_value: str = "contratacao", order: str = "_ord") -> DataFrame:
    """JN1: LOCAL -> CONTRATACAO.

    LOCAL is trimmed in place; key = lower(LOCAL) on both sides; the sheet is
    deduplicated keep-first (a null key is a key too and matches null
    places); the result, trimmed and lower-cased, overwrites ``out`` and is
    null when the place is not in the sheet.
    """
    dim = (sheet.select(F.lower(tx.strip(F.col(sheet_local))).alias("__dk"),
                        F.lower(tx.strip(F.col(sheet_value))).alias("__dv"),
                        F.col(order).alias("__o")))
    dim = keep_first(dim, "__dk", ["__dv"], "__o")
    fact = fact.withColumn(local, tx.strip(F.col(f"`{local}`")))
    out_df = _join_dim(fact, dim, "contract", F.lower(F.col(f"`{local}`")), "__dk", True)
    return out_df.withColumn(out, F.col("__dv")).drop("__dv")


def edited_place(fact: DataFrame, sheet: DataFrame, local: str = "LOCAL",
                 out: str = "LOCAL EDITADO", sheet_local: str = "Local",
                 sheet_value: str = "local_editado", order: str = "_ord",
                 action: str | None = "ACAO_LOCAL_EDITADO") -> DataFrame:
    """JN3: LOCAL -> LOCAL EDITADO, updating only when found, non-blank and different.

    ``action`` (if given) labels each row ``atualizado`` / ``nao_alterado`` /
    ``nao_encontrado``; null sheet keys are dropped.
    """
    dim = (sheet.select(F.lower(tx.strip(F.col(sheet_local))).alias("__dk"),
                        tx.strip(F.col(sheet_value)).alias("__dv"),
                        F.col(order).alias("__o"))
           .where(F.col("__dk").isNotNull()))
    dim = keep_first(dim, "__dk", ["__dv"], "__o")
    if out not in fact.columns:
        fact = fact.withColumn(out, F.lit(None).cast("string"))
    fact = fact.withColumns({local: tx.strip(F.col(f"`{local}`")),
                             out: tx.strip(F.col(f"`{out}`"))})
    j = _join_dim(fact, dim, "edited_place", F.lower(F.col(f"`{local}`")), "__dk", False)
    new = F.col("__dv")
    found = new.isNotNull() & (new != "")
    same = found & (F.coalesce(F.col(f"`{out}`"), F.lit("")) == F.coalesce(new, F.lit("")))
    upd = found & ~same
    cols = {out: F.when(upd, new).otherwise(F.col(f"`{out}`"))}
    if action:
        cols[action] = (F.when(upd, "atualizado").when(same, "nao_alterado")
                        .otherwise("nao_encontrado"))
    return j.withColumns(cols).drop("__dv")


def places(fact: DataFrame, contract_sheet: DataFrame, edited_sheet: DataFrame, local: str = "LOCAL",
           contract_out: str = "CONTRATACAO", edited_out: str = "LOCAL EDITADO", order: str = "_ord") -> DataFrame:
    """JN1 and JN3 by one join: both sheets have the key lower(trim(Local)).

    The sheets are stacked and reduced to a row per place, each value keep-first among its own sheet's
    rows.  The null place is a key of the contract sheet alone.
    """
    key = F.lower(tx.strip(F.col("Local"))).alias("__dk")
    none, first = F.lit(None).cast("string"), lambda v, o: F.min_by(F.struct(v), o)
    c = contract_sheet.select(key, F.lower(tx.strip(F.col("contratacao"))).alias("__c"), none.alias("__e"),
                              F.col(order).alias("__co"), F.lit(None).cast("long").alias("__eo"))
    e = edited_sheet.select(key, none.alias("__c"), tx.strip(F.col("local_editado")).alias("__e"),
                            F.lit(None).cast("long").alias("__co"), F.col(order).alias("__eo")).where(F.col("__dk").isNotNull())
    dim = c.unionByName(e).groupBy("__dk").agg(first("__c", "__co").alias("__c"), first("__e", "__eo").alias("__e")).select(
        "__dk", F.col("__c")["__c"].alias("__dc"), F.col("__e")["__e"].alias("__de"))
    if edited_out not in fact.columns:
        fact = fact.withColumn(edited_out, F.lit(None).cast("string"))
    fact = fact.withColumns({local: tx.strip(F.col(f"`{local}`")), edited_out: tx.strip(F.col(f"`{edited_out}`"))})
    j = _join_dim(fact, dim, "places", F.lower(F.col(f"`{local}`")), "__dk", True)
    new = F.nullif(F.col("__de"), F.lit(""))
    return j.withColumns({contract_out: F.col("__dc"), edited_out: F.coalesce(new, F.col(f"`{edited_out}`"))}).drop("__dc", "__de")


def target(fact: DataFrame, sheet: DataFrame, cls: str = "CLASSIFICACAO",
           out: str = "META", found_col: str = "GRUPO_ENCONTRADO",
           sheet_group: str = "grupo", sheet_value: str = "meta", order: str = "_ord") -> DataFrame:
    """JN4: CLASSIFICACAO -> META (+ the sheet's original group name).

    Key on both sides: nbsp/space collapse, trim, accent removal, upper;
    blank sheet keys removed; keep-first.
    """
    dim = (sheet.select(tx.meta_key(tx.strip(F.col(sheet_group))).alias("__dk"),
                        F.col(sheet_value).cast("double").alias("__dv"),
                        tx.strip(F.col(sheet_group)).alias("__dg"),
                        F.col(order).alias("__o"))
           .where(F.col("__dk") != ""))
    dim = keep_first(dim, "__dk", ["__dv", "__dg"], "__o")
    fact = fact.withColumn(cls, tx.strip(F.col(f"`{cls}`"))).drop(out, found_col)
    j = _join_dim(fact, dim, "target", tx.meta_key(F.col(f"`{cls}`")), "__dk", False, short=False)
    return j.withColumnsRenamed({"__dv": out, "__dg": found_col})


def unit_operator_map(sheet: DataFrame, unit: str = "UNIDADE", value: str = "OPERA",
                      order: str = "_ord") -> DataFrame:
    """JN5 dimension: UNIDADE -> OPERA, both normalised and upper-cased."""
    dim = (sheet.select(F.upper(tx.normalize(F.col(unit))).alias("__dk"),
                        F.upper(tx.normalize(F.col(value))).alias("__dv"),
                        F.col(order).alias("__o"))
           .where(F.col("__dk").isNotNull()))
    return keep_first(dim, "__dk", ["__dv"], "__o")


def by_distinct(df: DataFrame, col: str, **made) -> DataFrame:
    """Columns made once for each distinct value of ``col`` and looked up by the rows.

    ``made`` gives a function of the value for each name.  ``df`` is read twice, the first time for
    one column only, so it should be a written table.  Rows keep their order of columns; a made
    column that exists is replaced.
    """
    value = F.col("__value")
    values = df.select(F.col(f"`{col}`").alias("__value")).distinct().select("__value", *[f(value).alias(f"__{n}") for n, f in made.items()])
    values = sized(values, "values")
    j = df.join(values, F.col(f"`{col}`").eqNullSafe(F.col("__value")), "left").drop("__value")
    return j.withColumns({n: F.col(f"`__{n}`") for n in made}).drop(*[f"__{n}" for n in made])


def send_name_map(names: dict) -> dict:
    """JN6 map: folded key -> name and folded name -> name (later entries win)."""
    m = {}
    for k, v in names.items():
        m[tx.fold_key_py(k)] = v
        m[tx.fold_key_py(v)] = v
    return m


def literal_map(d: dict) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def send_name(names: dict | None = None):
    """JN6 as a function of the class column: its delivery name when known, else the class."""
    from quorum.config.classification import CLASS_NAMES
    m = literal_map(send_name_map(CLASS_NAMES if names is None else names))
    return lambda c: F.coalesce(F.element_at(m, tx.fold_key(c)), c)


def apply_send_names(df: DataFrame, col: str = "CLASSIFICACAO", names: dict | None = None, distinct: bool = False) -> DataFrame:
    """JN6: replace the class by its delivery name when known, else keep it; ``distinct``: see :func:`by_distinct`."""
    if distinct:
        return by_distinct(df, col, **{col: send_name(names)})
    return df.withColumn(col, send_name(names)(F.col(f"`{col}`")))


def class_group_map(groups: dict) -> dict:
    """JN7: folded class -> group; a class in two groups is an error."""
    out = {}
    for g, classes in groups.items():
        for c in classes:
            k = tx.fold_key_py(c)
            if k in out and out[k] != g:
                raise ValueError(f"class '{c}' is in groups '{out[k]}' and '{g}'")
            out[k] = g
    return out


def assign_group(df: DataFrame, col: str = "CLASSIFICACAO", groups: dict | None = None,
                 out: str = "GRUPO", norm_out: str | None = "CLASSIFICACAO_NORMALIZADA", distinct: bool = False) -> DataFrame:
    """JN7 on rows: folded class looked up in the literal class -> group map; ``distinct``: see :func:`by_distinct`."""
    from quorum.config.classification import DELIVERY_GROUPS
    m = literal_map(class_group_map(DELIVERY_GROUPS if groups is None else groups))
    made = {out: lambda c: F.element_at(m, tx.fold_key(c))}
    if norm_out:
        made[norm_out] = tx.fold_key
    if distinct:
        return by_distinct(df, col, **made)
    return df.withColumns({n: f(F.col(f"`{col}`")) for n, f in made.items()})


def unmatched(fact: DataFrame, found: Column) -> DataFrame:
    """JN11: rows whose lookup found nothing (filter on the same left join)."""
    return fact.where(~found)
