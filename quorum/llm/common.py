"""Helpers shared by the training-data operators.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (shared by driver and executors), so a lost executor
only costs re-reading files.  A scratch folder of this machine is used in
plain local mode alone, where driver and executors are one process.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in plain local mode a scratch folder when none is set."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    d = tempfile.mkdtemp(prefix="quorum-llm-")
    spark.conf.set("spark.checkpoint.dir", d)
    return d


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable where Python functions run, once per application.

    Nothing to do where it is installed for the executors already: named in PYTHONPATH, or
    submitted with the job.  Otherwise its sources go out as Spark's own job files do.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or spark.conf.get("spark.submit.pyFiles", ""):
        return
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        with zipfile.ZipFile(Path(tempfile.mkdtemp(prefix="quorum-src-")) / "quorum_src.zip", "w") as z:
            for f in sorted((root / "quorum").rglob("*.py")):
                z.write(f, f.relative_to(root))
        context.addPyFile(z.filename)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quorum-llm/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bit_map(df: DataFrame, place: Column, bits: int) -> bytes:
    """A map of ``bits`` bits, least significant first, with those set that ``place`` (0 to bits - 1) names in any row."""
    at = place + 1  # the built-in numbers buckets and positions from 1
    # Partial maps would be as many as tasks; the places themselves are smaller, and evenly spread by their callers.
    rows = (df.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("position")).repartition("bucket")
            .groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits")))
    out = bytearray(bits // 8)
    for r in rows.toLocalIterator():  # at most one row per 32,768 bits
        out[(r.bucket - 1) * 4096 : (r.bucket - 1) * 4096 + len(r.bits)] = r.bits
    return bytes(out)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the package ready for what is done to it."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until ``df`` has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def appended(df: DataFrame, **more: str) -> tuple[list[str], str]:
    """The columns of ``df`` that stay when columns of the given names and types are added, and the DDL of all."""
    taken = {n.lower() for n in more}
    stay = [f for f in df.schema.fields if f.name.lower() not in taken]
    ddl = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in stay), *(f"{n} {t}" for n, t in more.items())])
    return [f.name for f in stay], ddl


def held_out(doc_id: Column) -> Column:
    """The fold of the contracts: crc32 of the id as text is divisible by 5 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Consecutive rows with one key, as tables, from batches sorted by that key.

    At most one run and one batch are held; callers bound the size of a run.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_pylist()
        start = 0
        for i, k in enumerate(keys):
            if held or i > start:
                if k != current:
                    if i > start:
                        held.append(b.slice(start, i - start))
                    yield current, pa.Table.from_batches(held)
                    held, start, current = [], i, k
            else:
                current = k
        held.append(b.slice(start))
        current = keys[-1]
    if held:
        yield current, pa.Table.from_batches(held)
