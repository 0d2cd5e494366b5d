"""What the two substring operators share: texts under a row key, and spans gathered per text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from emberline.session import cut_lineage, scratch_path

#: Units of text (bytes) that a task turns into arrays at a time, or one text.
AT_ONCE = 1_000_000
#: A row's key: its id and two 64-bit hashes of its text. Rows that agree in all three are equal in id and text.
KEY = ["did", "th", "tw"]
NO_ID = -(2**63)


def keyed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(did, th, tw, data): id, two hashes of the text that tell rows with one id apart, the text's bytes."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("did"),
        F.xxhash64(data).alias("th"),
        F.xxhash64(F.lit(1), data).alias("tw"),
        data.alias("data"),
    )


def with_facts(
    rows: DataFrame, sample: DataFrame, keys: list[str], facts: dict[str, Column], finer: str = "", order: list[str] = []
) -> DataFrame:
    """``rows`` (keys, did, th, ...) with the aggregates ``facts`` over all rows of their keys, by one shuffle.

    Keys that fill more than a quarter of a partition by the ``sample`` of rows are dealt over several tasks by
    row, and their facts are added up with partial sums; so a hot key is never in one task. At most four times
    as many keys as partitions can be that hot, so their list and their facts are broadcast. The sample decides
    on the dealing only; the facts are of all rows.

    With ``finer``, rows of a key that agree in that column as well get ``m``, their number, and ``first``, whether
    a row is the first of them by ``order``; of a key that is dealt out, both hold within a task.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = cut_lineage(sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")))
    total = counts.agg(F.sum("k")).head()[0] or 1
    share = F.col("k") * F.lit(4.0 * parts / total)
    hot = counts.where((share > 1) & (F.col("k") > 1)).select(*keys, F.ceil(share).cast("int").alias("salts"))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("did", "th", F.monotonically_increasing_id()), F.col("salts")), F.lit(-1)).cast("int")
    )
    own = Window.partitionBy(*keys, "salt")
    local = dealt.drop("salts").repartition(*keys, "salt")
    if finer:
        alike = Window.partitionBy(*keys, "salt", finer)
        local = local.withColumn("first", F.row_number().over(alike.orderBy(*order)) == 1)
        local = local.withColumn("m", F.count(F.lit(1)).over(alike))
    local = local.withColumns({n: c.over(own) for n, c in facts.items()})
    whole = rows.join(F.broadcast(hot.drop("salts")), keys).groupBy(*keys)
    whole = whole.agg(*[c.alias(f"all_{n}") for n, c in facts.items()])
    joined = local.join(F.broadcast(whole), keys, "left")
    chosen = {n: F.coalesce(F.col(f"all_{n}"), F.col(n)) for n in facts}
    return joined.withColumns(chosen).drop("salt", *[f"all_{n}" for n in facts])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def sampled(texts: DataFrame) -> DataFrame:
    """Texts whose anchors tell which ones are hot: every 32nd by hash."""
    return texts.where(F.pmod(F.xxhash64(*KEY), F.lit(32)) == 0)


def original_id(name: str = "did") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and where each row's begin (with the end as last entry); null is empty."""
    array = batch.column(name)
    sizes = np.array([0 if n is None else n for n in array.value_lengths().to_pylist()], np.int64)
    return array.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes)))


def record(**columns: np.ndarray | list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))


def per_text(spans: DataFrame) -> DataFrame:
    """Begins and ends of all spans (did, th, tw, b, e) of a text as two lists; a text's own size bounds them.

    Equal rows have equal spans: as a set they are kept once, however often the row is there.
    """
    found = spans.groupBy(*KEY).agg(F.collect_set(F.struct("b", "e")).alias("s"))
    return found.select(*KEY, F.col("s.b").alias("b"), F.col("s.e").alias("e"))


def cleaned(texts: DataFrame, spans: DataFrame, rows, schema: str) -> DataFrame:
    """Every text with its spans, through ``rows``."""
    both = texts.join(per_text(spans), KEY, "left")
    return both.select("did", "data", "b", "e").mapInArrow(rows, schema)


def each_text(batches: Iterator[pa.RecordBatch]):
    """(batch, texts, begins, ends): the last two are per text."""
    for batch in batches:
        b, at = lists(batch, "b")
        e, _ = lists(batch, "e")
        cuts = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
        yield batch, batch.column("data").to_pylist(), [b[x:y] for x, y in cuts], [e[x:y] for x, y in cuts]
