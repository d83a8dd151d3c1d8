"""The row-local steps on a stream of monthly survey files.

The survey process has no streaming semantics (one file per month), so
nothing stateful is added: new files landing in a folder run through the
same row-local steps (clean, contract, score, classify, edited place) and
are appended to a Parquet sink.  Lookup sheets are static DataFrames
joined per micro-batch (stream-static joins).  The unit result (a mean over
all rows of a unit) is not computed on the stream: it needs the complete
month and runs as the batch step on the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quorum.operators import clean, lookup, rules, score


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int = 1) -> DataFrame:
    """Files landing in ``folder``, one (or ``max_files``) per micro-batch."""
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", max_files).load(folder))


def row_local_steps(stream: DataFrame, contract_sheet: DataFrame, edited_sheet: DataFrame) -> DataFrame:
    """The scored table's row-local steps, unchanged, on a streaming frame.

    The lookups are joined without the broadcast size check (a count is an
    action, not allowed on a stream); lookup sheets are small static tables
    and AQE/planner statistics decide the join.
    """
    df = clean.clean_scored(stream)
    df = lookup.contract(df, contract_sheet)
    df = score.row_score(df)
    df = rules.classify(df)
    return lookup.edited_place(df, edited_sheet, action=None)


def start(spark: SparkSession, src: str, schema: T.StructType, contract_sheet: DataFrame,
          edited_sheet: DataFrame, sink: str, checkpoint: str, once: bool = True):
    """Run the steps from ``src`` into the Parquet folder ``sink``.

    ``checkpoint`` must be on shared storage; with ``once`` every file
    present is processed and the query stops (``availableNow``).
    """
    out = row_local_steps(read_stream(spark, src, schema), contract_sheet, edited_sheet)
    w = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start()
