"""Nearest neighbours by inner product of unit vectors, in partitions of equal country and source.

Below a partition size the search is exact: blocks of queries meet blocks of references as
matrices. Beyond it, each partition has an index of compressed lists (`operators.ivf`)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinloom.config import DenseConfig
from kinloom.functions.similarity import dot, unit_vector  # noqa: F401
from kinloom.operators import ivf
from kinloom.session import ship_package

#: Rows of a block of queries or references that meet as matrices.
BLOCK = 2048
_TOP = "q long, r long, cosine double"


def units(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """df with its vectors at length 1; a value that is no finite number is an error."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checked = F.when(bad, F.raise_error(F.lit("embedding with a value that is not finite"))).otherwise(F.col(vector))
    return df.withColumn(vector, unit_vector(checked))


def exact_top_k(queries: DataFrame, references: DataFrame, k: int, on: str = "part") -> DataFrame:
    """(q, r, cosine, rank): each query's k nearest in its partition, ties by r.

    queries: q, `on`, embedding; references: r, `on`, embedding. Both are cut in blocks; a task
    gets one pair of blocks and keeps k for each query, so no partition is gathered whole."""
    ship_package(queries.sparkSession)
    sizes = lambda df: df.groupBy(on).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    q_sizes, r_sizes = sizes(queries).withColumnRenamed("blocks", "q_blocks"), sizes(references).withColumnRenamed("blocks", "r_blocks")
    grid = q_sizes.join(r_sizes, on)  # a row for each partition
    left = queries.join(F.broadcast(grid), on).withColumn("qb", F.pmod(F.xxhash64("q"), F.col("q_blocks"))).withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)))
    right = references.join(F.broadcast(grid), on).withColumn("rb", F.pmod(F.xxhash64("r"), F.col("r_blocks")).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    left = left.select(on, F.col("qb").cast("int").alias("qb"), "rb", "q", "embedding")
    right = right.select(on, "qb", "rb", "r", "embedding").toDF("r_part", "r_qb", "r_rb", "r", "embedding")

    def nearest(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if own.empty or others.empty:
            return pd.DataFrame({"q": [], "r": [], "cosine": []}).astype({"q": "int64", "r": "int64", "cosine": "float64"})
        others = others.sort_values("r")
        products = np.stack(own["embedding"].to_numpy()) @ np.stack(others["embedding"].to_numpy()).T
        best = np.argsort(-products, axis=1, kind="stable")[:, :k]
        rows = np.repeat(np.arange(len(own)), best.shape[1])
        return pd.DataFrame({"q": own["q"].to_numpy()[rows], "r": others["r"].to_numpy()[best.ravel()], "cosine": products[rows, best.ravel()]})

    found = left.groupBy(on, "qb", "rb").cogroup(right.groupBy("r_part", "r_qb", "r_rb")).applyInPandas(nearest, _TOP)
    # Which partition a pair is of follows from r; the rank counts within it.
    tagged = found.join(references.select("r", on).toDF("r", on), "r")
    return ranked(tagged, k, on)


def ranked(pairs: DataFrame, k: int, on: str) -> DataFrame:
    at = F.row_number().over(Window.partitionBy("q", on).orderBy(F.desc("cosine"), "r"))
    return pairs.withColumn("rank", at).where(F.col("rank") <= k).select("q", "r", "cosine", "rank", on)


def neighbours(records: DataFrame, config: DenseConfig) -> DataFrame:
    """(q, r, neural_cosine, neural_rank): channel G.

    records: rid, source, country_key, embedding. A reference's partition is its country and source; a
    query of known country looks into its own and the unknown one, others into all;
    ranks count within a partition."""
    given = units(records)
    part = lambda country, source: F.concat_ws("|", country, source.cast("string"))
    references = given.where("source IN (2, 3)").select(F.col("rid").alias("r"), part(F.col("country_key"), F.col("source")).alias("part"), "embedding")
    partitions = given.where("source IN (2, 3)").groupBy("country_key", "source").agg(F.count("*").alias("n")).withColumnsRenamed({"country_key": "p_country", "source": "p_source"})
    own = given.where("source = 1").select(F.col("rid").alias("q"), "country_key", "embedding")
    known = own.where("country_key <> ''").withColumn("p_country", F.explode(F.array("country_key", F.lit("")))).join(partitions, "p_country")
    whole = partitions.agg(F.collect_list(F.struct("p_country", "p_source", "n")).alias("all"))  # countries x 2 entries
    unknown = own.where("country_key = ''").join(F.broadcast(whole), F.lit(True)).withColumn("p", F.explode("all")).select("q", "embedding", "p.*")
    queries = known.select("q", "embedding", "p_country", "p_source", "n").unionByName(unknown).withColumn("part", part(F.col("p_country"), F.col("p_source")))
    small = F.col("n") < config.exact_below
    sized = references.join(F.broadcast(partitions.select(part(F.col("p_country"), F.col("p_source")).alias("part"), "n")), "part")
    found = exact_top_k(queries.where(small).drop("n"), sized.where(small).drop("n"), config.ann_top_k)
    large = sized.where(~small).drop("n")
    if large.head(1):
        found = found.unionByName(ivf.top_k(queries.where(~small).drop("n"), large, config))
    return found.select("q", "r", F.col("cosine").alias("neural_cosine"), F.col("rank").alias("neural_rank"))
