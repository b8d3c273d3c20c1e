"""Contiguous shards of equal bytes, by DataFrame functions alone.

Law `bytes`: documents stand in ascending doc_id (ties by text checksum, size, then
scan position; null ids first). A document whose middle byte lies in the i-th
of `shards` equal stretches of all bytes goes to shard i, so shard sizes differ
from the target by less than one document at either end.

Defined cases: null text has size 1 and checksum 0; an empty table gives an empty
result; repeated rows each get a slot; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.session import staged


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs."""
    text = F.col(text_col)
    narrow = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("__row"),
        ),
        "shard-sizes",
    )
    order = ["doc_id", "text_crc32", "size", "__row"]
    # Rows are dealt by range, so each partition is a contiguous stretch of the global order;
    # they are staged because later jobs rely on the partition number of each row.
    dealt = staged(narrow.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "shard-ranges")

    # First pass: one total for each partition, turned into offsets (a row for each partition).
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        dealt.groupBy("__part")
        .agg(F.sum("size").alias("__bytes"), F.count("*").alias("__rows"))
        .select(
            "__part",
            F.coalesce(F.sum("__bytes").over(before), F.lit(0)).alias("__bytes_before"),
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
            F.sum("__bytes").over(everything).alias("__total"),
        )
    )

    # Second pass: running sums inside each partition on top of its offset.
    inside = Window.partitionBy("__part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        dealt.withColumn("__upto", F.sum("size").over(running))
        .withColumn("__nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "__part")  # at most one row for each shuffle partition
        .withColumn("__middle2", 2 * (F.col("__bytes_before") + F.col("__upto")) - F.col("size"))
        .withColumn("__position", F.col("__rows_before") + F.col("__nth") - 1)
        .withColumn("shard", F.expr(f"CAST(least({shards} - 1, (__middle2 * {shards}) div (2 * __total)) AS INT)"))
    )
    starts = placed.groupBy("shard").agg(F.min("__position").alias("__start"))
    return placed.join(F.broadcast(starts), "shard").select(  # one row for each shard
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("__position") - F.col("__start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
