"""Exact duplicates by sorting content, with DataFrame functions only.

Texts are normalised by deleting white space. The normalised bytes are range-partitioned by sampled
splitters and sorted (externally, when they do not fit), which makes equal texts neighbours; the window
over them starts a new group wherever a row's full text differs from its neighbour's. The order is by the first
``LEAD`` characters, then by a hash of the text, then by the whole text: the splitters, which pass the driver, stay
short, and texts that share a long beginning still spread over partitions.

Groups that hold more rows than a fair share of one partition are found beforehand by counting digests.
There are at most as many of them as partitions, so their list has a fixed bound and is broadcast. Their
rows get a salt in the sort key, so no task gathers such a group, and the heads of its parts are merged.

Defined cases: a null text counts as empty, and all empty texts are one group; of equal texts the row with
most code points, then the smallest id stays (null ids last); of fully equal rows any one stays, and only
one is ``kept``. An empty table gives no rows. Other columns are not read by :func:`groups`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from emberline.llm.text import SPACE_CLASS, filled, packed_rows, unpacked
from emberline.session import cut_lineage

# Salted parts aim at this share of a fair partition.
PART_SHARE = 0.25
# Characters of a text that the sampled splitters hold.
LEAD = 64


def normalised(text: Column | str) -> Column:
    return F.regexp_replace(filled(text), f"{SPACE_CLASS}+", "")


def hot_digests(docs: DataFrame, text: str, parts: int) -> DataFrame:
    """Digests of texts with more rows than a ``parts``-th of all: fewer than ``parts`` rows."""
    total = docs.count()
    counts = docs.groupBy(F.sha2(normalised(text), 256).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    salts = F.ceil(F.col("_rows") * F.lit(parts / (PART_SHARE * max(total, 1)))).cast("int")
    return counts.where((F.col("_rows") > 1) & (F.col("_rows") > total / parts)).select("_hot", salts.alias("_salts"))


def grouped(docs: DataFrame, id_column: str = "doc_id", text: str = "text", *keep: Column) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(
        F.struct(*keep).alias("_keep"),
        F.col(id_column).alias("_id"),
        F.length(filled(text)).alias("_len"),
        normalised(text).alias("_norm"),
    ).withColumns(
        {
            "text_sha256": F.sha2("_norm", 256),
            "_lead": F.substring("_norm", 1, LEAD),
            "_rest": F.xxhash64("_norm"),
        }
    )
    salted = base.join(F.broadcast(hot_digests(docs, text, parts)), F.col("text_sha256") == F.col("_hot"), "left")
    # Rows are dealt by id and place in their file: also rows without an id, or with one and the same.
    dealt = F.pmod(F.xxhash64("_id", F.monotonically_increasing_id()), F.col("_salts"))
    salt = F.when(F.col("_salts").isNotNull(), dealt + 1).otherwise(F.lit(0))
    in_order = salted.withColumn("_salt", salt).drop("_hot", "_salts").repartitionByRange("_lead", "_rest", "_salt")
    equal = Window.partitionBy("_lead", "_rest", "_norm", "_salt")
    best = equal.orderBy(F.col("_len").desc(), F.col("_id").asc_nulls_last())
    local = cut_lineage(
        in_order.withColumns(
            {
                "_place": F.row_number().over(best),
                "_head": F.first(F.struct("_id", "_len")).over(best),
                "_n": F.count(F.lit(1)).over(equal),
            }
        ).drop("_norm", "_lead", "_rest", "_id", "_len")
    )
    # One row per hot digest, so below the number of partitions.
    rank = F.struct((-F.col("_head._len")).alias("a"), F.col("_head._id").isNull().alias("b"), "_head._id", "_salt")
    merged = (
        local.where("_salt > 0 AND _place = 1")
        .groupBy(F.col("text_sha256").alias("_digest"))
        .agg(F.min(rank).alias("_best"), F.sum("_n").alias("_all"))
    )
    joined = local.join(F.broadcast(merged), (F.col("_salt") > 0) & (F.col("text_sha256") == F.col("_digest")), "left")
    split = F.col("_digest").isNotNull()
    return joined.select(
        "_keep.*",
        F.when(split, F.col("_best._id")).otherwise(F.col("_head._id")).alias("keep_id"),
        F.when(split, F.col("_all")).otherwise(F.col("_n")).cast("long").alias("group_size"),
        ((F.col("_place") == 1) & (~split | (F.col("_best._salt") == F.col("_salt")))).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; the rows travel with their sort key."""
    rows = packed_rows(docs).select("row", F.col("row.doc_id").alias("_id"), F.col("row.text").alias("_text"))
    return unpacked(grouped(rows, "_id", "_text", F.col("row")).where("kept"), docs.columns)
