"""Reads and sinks (IO1-IO19).

CSV inputs are read with an explicit all-string schema taken from the
header (never inferred), the survey process's null tokens are mapped to
null, and the schema overlay types the known columns.  Sinks are single
partitioned writes (``partitionBy``), never loops of filtered writes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quorum.functions.schema import overlay

# --- fixed values: CSV tokens read as null (pandas defaults the process relies on)
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
ID_READ_AS_TEXT = ("NUM_BENEFICIARIO", "TELEFONE")


def _header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the header line only (one small read, no inference, no columns from folder names)."""
    first = spark.read.option("header", False).option("sep", sep).option("recursiveFileLookup", True).csv(path).limit(1).collect()
    if not first:
        raise ValueError(f"empty CSV: {path}")
    return [c.lstrip("﻿") if c else c for c in first[0]]


def _csv(spark, path, names, sep=",", multi_line=False, line_numbers=False):
    """All columns as text.  Folders are read to any depth, their names give no columns.  Every file's header is checked against ``names``, so a file with its
    columns in another order stops the read.  Files are split over tasks unless fields hold line
    feeds (``multi_line``)."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in names])
    scan = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("enforceSchema", False)
            .option("escape", '"').option("sep", sep).option("recursiveFileLookup", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))
    return numbered_lines(scan) if line_numbers else scan


FILE, LINE = "ARQUIVO", "LINHA"


def numbered_lines(scan: DataFrame) -> DataFrame:
    """AN4: a file scan with each row's file and line, the first row after the header on line 2.

    Rows are numbered within their split; the splits' row counts, summed up in each file by where the
    split begins, give the lines before it.  So nothing is sorted or moved but one row per split.
    ``scan`` must be the reader's own DataFrame.  Blank lines and line feeds in fields count as the
    reader counts them: rows, not physical lines.
    """
    rows = scan.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("__begin"),
                       F.monotonically_increasing_id().alias("__at"))
    splits = rows.groupBy(FILE, "__begin").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first"))
    earlier = Window.partitionBy(FILE).orderBy("__begin").rowsBetween(Window.unboundedPreceding, -1)
    shift = splits.select(FILE, "__begin", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 2).alias("__shift"))
    return rows.join(shift, [FILE, "__begin"]).withColumn(LINE, F.col("__at") + F.col("__shift")).select(*scan.columns, FILE, LINE)


def read_survey_csv(spark: SparkSession, path: str, strict_ints: bool = True, sep: str = ",",
                    multi_line: bool = False, line_numbers: bool = False) -> DataFrame:
    """IO1: typed survey CSV scan (all text, null tokens, schema overlay), with file and line if asked for."""
    names = _header(spark, path, sep)
    df = _csv(spark, path, names, sep, multi_line, line_numbers)
    df = df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")) for c in names})
    return overlay(df, strict_ints=strict_ints)


def read_csv_columns(spark: SparkSession, path: str, columns, sep: str = ",") -> DataFrame:
    """IO3/IO4: plain CSV scan pruned to ``columns`` (null tokens applied)."""
    df = _csv(spark, path, _header(spark, path, sep), sep).select(*[F.col(f"`{c}`") for c in columns])
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")) for c in columns})


def read_raw_text(spark: SparkSession, path: str, sep: str = ",", line_numbers: bool = False) -> DataFrame:
    """IO5: every field as text, no null tokens (empty fields -> ''), with file and line if asked for."""
    names = _header(spark, path, sep)
    df = _csv(spark, path, names, sep, line_numbers=line_numbers)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names})


def write_survey_csv(df: DataFrame, path: str, mode: str = "overwrite", strict_ints: bool = True) -> None:
    """IO2: header CSV, overlay applied first (integer columns checked); whitespace kept as is."""
    (overlay(df, strict_ints=strict_ints).write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_sheet(spark: SparkSession, base: str, sheet: str, fmt: str = "parquet") -> DataFrame:
    """IO6: one lookup dataset per sheet name under ``base``."""
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{sheet}")


def read_optional(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame | None:
    """IO11: an optional lookup; None when absent (the enrichment is skipped)."""
    if not path:
        return None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # the step runs without the lookup
            return None
        raise


def union_sheets(sheets: dict, tag: str = "__origem_aba") -> DataFrame:
    """IO7: non-empty sheets unioned by name with their sheet name; error if none."""
    kept = [df.withColumn(tag, F.lit(name)) for name, df in sheets.items() if not df.isEmpty()]
    if not kept:
        raise ValueError("no non-empty sheet")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)


def union_sheets_with(sheets: dict, needed, tag: str = "ABA_ORIGEM") -> DataFrame:
    """IO8: sheets that carry all ``needed`` columns, pruned to them and tagged."""
    kept = [df.select(*[F.col(f"`{c}`") for c in needed]).withColumn(tag, F.lit(name))
            for name, df in sheets.items() if set(needed) <= set(df.columns)]
    if not kept:
        raise ValueError("no sheet has the needed columns")
    return reduce(lambda a, b: a.unionByName(b), kept)


def write_partitioned(df: DataFrame, path: str, by, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """IO12-IO16/IO19: one write, one folder per partition value."""
    df.write.mode(mode).partitionBy(*by).format(fmt).save(path)


def write_summary_json(df: DataFrame, path: str, **lists: DataFrame) -> None:
    """IO17: summary totals as JSON, and each list of records as a JSON table of its own beside them.

    Without lists the totals are written to ``path`` itself, else to ``path/totais``.  A one-row
    aggregate is one partition and so one file; lists have as many files as they need.
    """
    df.write.mode("overwrite").json(f"{path}/totais" if lists else path)
    for name, records in lists.items():
        records.write.mode("overwrite").json(f"{path}/{name}")


def write_summary_csv(df: DataFrame, path: str) -> None:
    """IO18: a summary table as CSV with a header, a file for each partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session."""
    import uuid
    from quorum.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quorum-io/{name}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Cut lineage by writing a Parquet table to shared storage and reading it back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def step_table(df: DataFrame, name: str) -> DataFrame:
    """Write a step's output once under the session's shared checkpoint folder
    (``spark.checkpoint.dir``) and continue from the written table.

    Several reports read the same step output; writing it once cuts the
    lineage (an executor loss re-reads files instead of replaying the
    pipeline), keeps downstream plans small, and gives the reports column
    pruning and filter pushdown on Parquet.
    """
    import uuid
    from quorum.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return persist_table(df, f"{base}/quorum-steps/{name}-{uuid.uuid4().hex}")


# --- rule files (IO10) --------------------------------------------------------
CLASS_RULE_SCHEMA = T.StructType(
    [T.StructField(f, T.BooleanType() if f == "aplicar_somente_vazios" else T.StringType(), True)
     for f in ("grupo_classificacao", "nome_lista", "aplicar_somente_vazios", "palavra_filtro",
               "tipo_igual", "tipo_diferente", "contratacao_igual", "contratacao_diferente",
               "filtro_local", "filtro_local_diferente", "filtro_especialidade",
               "filtro_especialidade_diferente")])


def write_class_rules(spark: SparkSession, rules, path: str) -> None:
    """Write a rule list as a JSON rule file (one array, like the source files)."""
    import json
    rows = [{k: (json.dumps(v) if k.startswith("tipo_") and v is not None else v) for k, v in r.items()}
            for r in rules]
    spark.createDataFrame(rows, CLASS_RULE_SCHEMA).coalesce(1).write.mode("overwrite").json(path)


def read_class_rules(spark: SparkSession, path: str, max_rules: int = 10_000) -> list[dict]:
    """IO10: rule file -> ordered rule list (a small configuration table).

    ``tipo_*`` are read as text and parsed: '[..]' -> list of ints, a number
    -> int.  Order is the file order (``monotonically_increasing_id`` right
    after the scan).  Rules are configuration, bounded by ``max_rules``.
    """
    import json
    df = (spark.read.schema(CLASS_RULE_SCHEMA).option("multiLine", False).json(path)
          .withColumn("_ord", F.monotonically_increasing_id()))
    rows = df.orderBy("_ord").limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError("rule file too large")
    out = []
    for r in rows:
        d = r.asDict()
        d.pop("_ord")
        for k in ("tipo_igual", "tipo_diferente"):
            v = d[k]
            if v is not None:
                v = json.loads(v) if v.strip().startswith("[") else int(float(v))
            d[k] = v
        out.append(d)
    return out
