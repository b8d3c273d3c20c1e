"""Samples, shards and contrastive batches; none depends on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinloom.session import staged


def least_rows(df: DataFrame, k: int, hashed: Column, *key: str) -> DataFrame:
    """The k rows of least hash (a long), ties by key: of 65,536 classes of the hash those below the one that the
    k-th row falls into are taken whole, and only that one is sorted."""
    given = df.withColumn("__hash", hashed).withColumn("__class", F.shiftright("__hash", 48))
    counts = given.groupBy("__class").agg(F.count("*").alias("n")).collect()  # a row for each class
    below, last = 0, None
    for r in sorted(counts, key=lambda r: r["__class"]):
        if below + r["n"] >= k:
            last = r["__class"]
            break
        below += r["n"]
    if last is None:
        return df
    cut = given.where(F.col("__class") == last).orderBy("__hash", *key).limit(k - below)
    return given.where(F.col("__class") < last).unionByName(cut).drop("__hash", "__class")


def uniform_sample(df: DataFrame, k: int, seed: int, *key: str) -> DataFrame:
    """k rows, or all, of least hash: uniform without replacement."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *key))
    # The first 60 bits of the digest, in its order.
    return least_rows(df, k, F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") * 8, *key)


def sample_by_group(df: DataFrame, group: str, k: int, *order: str) -> DataFrame:
    """The first k rows of each group."""
    at = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("__at", at).where(F.col("__at") <= k).drop("__at")


def dense_numbers(df: DataFrame, *order: str, name: str = "rid") -> DataFrame:
    """Rows numbered 1 to n in the given order: dealt by range, counted, then numbered on top of
    the counts before, so no task sees all rows."""
    dealt = staged(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.join(F.broadcast(counts), "__part").withColumn(name, F.col("__before") + at).drop("__part", "__before")


def stride_shard(number: Column, world: int) -> Column:
    """Shard of a 1-based number when shards take turns."""
    return F.pmod(number - 1, F.lit(world)).cast("int")


def range_shard(number: Column, n: Column, world: int) -> Column:
    """Shard of a 1-based number when shard r holds rows floor(n r / world) to floor(n (r + 1) / world)."""
    return F.floor((number * world - 1) / n).cast("int")


#: Lanes in which the scan of a country runs, whatever the cluster.
LANES = 64


def contrastive_batches(positives: DataFrame, batch_size: int, lane: Column | None = None) -> DataFrame:
    """positives with a batch number by country and lane: in order of (ordinal, shuffle, sid, eid), a new
    batch begins where a cluster repeats or the batch is full.

    The scan is sequential by nature; countries run in parallel, and within one, `lane` (LANES classes
    of the cluster's hash, if not given) splits the scan, so that no task gets a country whole. Spark sorts a lane, on disk where need be; the scan holds one Arrow batch and
    the clusters of one batch."""
    given = positives.withColumn("lane", F.pmod(F.xxhash64("cluster"), F.lit(LANES)).cast("int") if lane is None else lane.cast("int"))
    schema = given.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",batch:int"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, batch = None, set(), 0
        for some in batches:
            numbers = []
            for at in zip(*[some.column(c).to_pylist() for c in ("country", "lane", "cluster")], strict=True):
                if at[:2] != own:
                    own, seen, batch = at[:2], set(), 0
                if at[2] in seen or len(seen) >= batch_size:
                    batch, seen = batch + 1, set()
                seen.add(at[2])
                numbers.append(batch)
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(numbers, pa.int32())], names=[*some.schema.names, "batch"])

    order = [F.asc_nulls_last(c) for c in ("ordinal", "shuffle", "sid", "eid")]
    return given.repartition("country", "lane").sortWithinPartitions("country", "lane", *order).mapInArrow(scan, schema)


def lone_batches(batches: DataFrame) -> DataFrame:
    """(country, lane, batch) of a single positive, which needs a partner of another cluster."""
    return batches.groupBy("country", "lane", "batch").agg(F.count("*").alias("n"), F.first("cluster").alias("cluster")).where("n = 1")


def partners(lone: DataFrame, positives: DataFrame) -> DataFrame:
    """A positive of another cluster for each lone batch, of the same country if there is one.

    Two candidates of different clusters for each country, and two over all, suffice: at
    most one of them has the cluster that is to be avoided."""
    by = lambda *group: positives.groupBy(*group, "cluster").agg(F.min(F.struct("sid", "eid")).alias("p"))
    first = lambda df, *group: df.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy("cluster"))).where("at <= 2")
    near = first(by("country"), "country").select("country", F.col("cluster").alias("other"), "p", F.lit(0).alias("far"))
    ends = positives.agg(F.min("cluster").alias("lo"), F.max("cluster").alias("hi"))
    two = ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("cluster"))
    anywhere = by().join(F.broadcast(two), "cluster").select(F.col("cluster").alias("other"), "p", F.lit(1).alias("far"))  # two rows
    options = lone.join(near, "country").unionByName(lone.join(F.broadcast(anywhere), F.lit(True)))
    fit = options.where("other <> cluster")
    return fit.groupBy("country", "lane", "batch").agg(F.min(F.struct("far", "other", "p")).alias("m")).select("country", "lane", "batch", "m.p.sid", "m.p.eid")
