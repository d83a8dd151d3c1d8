"""Exact deduplication by deterministic block naming (operator 10).

A text without white space is cut into blocks of fixed size.  The distinct
blocks are sorted (in every hash partition) and numbered: equal blocks get one
integer name, different blocks never share one, as names are decided by
comparing the blocks themselves.  Then adjacent names of a document are paired
and the distinct pairs are named in the same way, until every document has one
name.  Documents with the same number of blocks and the same last name have
equal texts, with no chance of a collision.

Hot groups: blocks are pre-aggregated in every task before they are sorted.  A
light count of block hashes (for routing only, never for identity) finds the
blocks that hold more than ``1 / HOT_SHARE`` of all blocks; there are at most
``HOT_SHARE`` of them.  Their rows are salted over many tasks, each salt gets a
name of its own, and the few names of one block are unified afterwards.  Pair
names and groups are joined as written tables of plain integers, which
adaptive execution can split where a key is skewed.

Defined results: a null text counts as empty; empty texts are one group; the
row that stays has most code points in the original text, then the smallest
doc_id (null last); rows that repeat a doc_id with equal text share its
decision; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorum.llm.common import SPACE, fresh, written

BLOCK_CHARS = 4096
#: A block is hot when it makes up more than 1 / HOT_SHARE of all blocks.
HOT_SHARE = 10_000
#: Least rows of a hot block, and rows that one salt of it takes.
HOT_ROWS = 256

LAST = 2**63 - 1


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def blocks(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(row, doc_id, n_chars, sha, n_blocks, pos, block); the digest only at pos 0."""
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"),
        normalised(F.col(text_col)).alias("norm"),
    )
    last = F.greatest(F.lit(0), F.floor((F.length("norm") - 1) / F.lit(size))).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("last")),
                      lambda i: F.substring(F.col("norm"), i * size + 1, F.lit(size)))
    return (
        base.withColumn("last", last)
        .select("row", "doc_id", "n_chars", (F.col("last") + 1).alias("n_blocks"),
                F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.posexplode(cut).alias("pos", "block"))
        .withColumn("sha", F.when(F.col("pos") == 0, F.col("sha")))
    )


def _block_names(cut: DataFrame) -> DataFrame:
    """One row per block of a document, with its integer name instead of its text."""
    seen = written(cut.groupBy(F.xxhash64("block").alias("h")).agg(F.count("*").alias("n"))
                   .filter(F.col("n") >= HOT_ROWS), "block_counts")
    total = seen.agg(F.sum("n")).first()[0] or 0
    # At most HOT_SHARE rows: each holds more than that share of what was counted.
    hot = (seen.filter(F.col("n") * HOT_SHARE > total)
           .select("h", F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("salts")))
    salted = (
        cut.withColumn("h", F.xxhash64("block"))
        .join(F.broadcast(hot), "h", "left")
        # From the id, not the row number: both sides of the join below read the table on their own.
        .withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id", "pos"), F.col("salts"))).otherwise(F.lit(-1)).cast("int"))
        .drop("h", "salts")
    )
    ranked = F.coalesce("doc_id", F.lit(LAST))
    names = (
        salted.groupBy("block", "salt").agg(F.min(ranked).alias("first"))
        .sortWithinPartitions("block", "salt")
        .select("block", "salt", "first", F.monotonically_increasing_id().alias("name"))
    )
    named = written(
        salted.join(names, ["block", "salt"])
        .select("row", "doc_id", "n_chars", "n_blocks", "sha", "pos", "name",
                F.when((F.col("salt") >= 0) & (ranked == F.col("first")), F.col("block")).alias("hot_block")),
        "block_names")
    # The salts of one hot block: about one row each, so the smallest name of a block is found from few rows.
    of_hot = named.filter(F.col("hot_block").isNotNull()).select("hot_block", "name").distinct()
    one = of_hot.groupBy("hot_block").agg(F.min("name").alias("one"))
    unified = of_hot.join(one, "hot_block").select("name", "one")
    return (named.drop("hot_block").join(unified, "name", "left")
            .withColumn("name", F.coalesce("one", "name")).drop("one"))


def _pair_names(state: DataFrame, level: int) -> DataFrame:
    """Name adjacent pairs: half as many rows per document."""
    paired = written(
        state.groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
        .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
             F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("b")),
        f"pairs_{level}")
    names = written(
        paired.groupBy("a", "b").agg(F.lit(1).alias("_")).sortWithinPartitions("a", "b")
        .select("a", "b", F.monotonically_increasing_id().alias("name")),
        f"pair_names_{level}")
    return written(paired.join(names, ["a", "b"]).select("row", "n_blocks", "pos", "name"), f"level_{level}")


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_chars, sha, n_blocks, name) per row: (n_blocks, name) is the identity of the text."""
    named = written(_block_names(blocks(docs, id_col, text_col, block_chars)), "names")
    heads = named.filter("pos = 0").select("row", "doc_id", "n_chars", "sha", "n_blocks", "name")
    done = heads.filter("n_blocks = 1")
    state = named.filter("n_blocks > 1").select("row", "n_blocks", "pos", "name")
    left, level = (named.agg(F.max("n_blocks")).first()[0] or 1), 0
    if left == 1:
        return heads
    while left > 1:
        state, left, level = _pair_names(state, level), (left + 1) // 2, level + 1
    long = heads.filter("n_blocks > 1").drop("name").join(state.select("row", "name"), "row")
    return done.unionByName(long)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One decision per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(identities(docs, id_col, text_col, block_chars), "identities")
    groups = written(
        rows.groupBy("n_blocks", "name").agg(
            F.min(F.struct((-F.col("n_chars")).alias("n"), F.coalesce("doc_id", F.lit(LAST)).alias("d"))).alias("best"),
            F.count("*").alias("group_size")),
        "groups")
    return rows.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.when(F.col("best.d") == LAST, F.lit(None).cast("long")).otherwise(F.col("best.d")).alias("keep_id"),
        "group_size",
        (F.coalesce("doc_id", F.lit(LAST)) == F.col("best.d")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns (one decision for all rows of an id)."""
    keep = fresh(docs, "keep")
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(F.col("doc_id").alias(keep)).distinct()
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(keep)), "left_semi")
