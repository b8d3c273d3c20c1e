"""Tables in and out: strict TSV, ZIP archives, Parquet, ordered lists, small JSON documents."""

from __future__ import annotations

import csv
import io
import json
import re
import time
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinloom.operators.labeling import require_none
from kinloom.operators.sampling import dense_numbers
from kinloom.schemas import RAW_COLUMNS
from kinloom.session import ship_package
from kinloom.sources import archives, files

_CORRUPT = "_corrupt_record"


def find_one(spark: SparkSession, root: str, pattern: str) -> str:
    """The only file below root whose name matches; an error if there is none or several."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    found = [r["path"] for r in names.where(F.regexp_extract("path", r"[^/]*$", 0).rlike(f"^(?:{pattern})$")).limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"expected exactly one file {pattern} below {root}, found {len(found)}")
    return found[0]


def refuse_sample(spark: SparkSession, root: str) -> None:
    """A folder or archive that is marked as a sample must not be submitted from."""
    if root.endswith(".zip"):
        if archives.can_open(root):
            archives.member_names(root)
        return  # else the reader of its members refuses it
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", archives.SAMPLE_MARK).load(root).select("path")
    if names.head(1):
        raise ValueError(f"{root} holds a sample, not the full data")


def read_tsv(spark: SparkSession, path: str, required: list[str] | None = None, forbidden: list[str] | None = None) -> DataFrame:
    """A tab-separated file (plain or gzip) as strings: no inference, no missing-value words,
    a byte order mark dropped; rows of a wrong length are errors."""
    options = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}
    names = [c.removeprefix("\ufeff") for c in spark.read.options(**options).option("inferSchema", False).csv(path).columns]
    if lacking := sorted(set(required or []) - set(names)):
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    if clashing := sorted(set(forbidden or []) & set(names)):
        raise ValueError(f"{path} already has {', '.join(clashing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    read = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, nullValue="\x00", emptyValue="", enforceSchema=True).schema(schema).csv(path)
    require_none(read.where(F.col(_CORRUPT).isNotNull()), f"malformed rows in {path}")
    return read.select(*[F.coalesce(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def read_zip_member(spark: SparkSession, path: str, pattern: str, columns: list[str]) -> DataFrame:
    """Rows of the one TSV member of a ZIP whose base name matches, as strings.

    Archives in stores that Arrow opens are read in place, whatever their size (`sources.archives`). Of any other
    store Spark's binary reader brings the archive into one task, which bounds it at 2 GB."""
    if archives.can_open(path):
        found = archives.member_names(path, pattern)
        if len(found) != 1:
            raise ValueError(f"expected exactly one member {pattern}, found {len(found)}")
        return archives.read_members(spark, path, pattern, columns).select(*columns)
    ship_package(spark)
    archive = spark.read.format("binaryFile").load(path).select("content")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as packed:
                    if any(archives.base_name(n) == archives.SAMPLE_MARK for n in packed.namelist()):
                        raise ValueError("the archive holds a sample, not the full data")
                    found = [n for n in packed.namelist() if re.fullmatch(pattern, n.rsplit("/", 1)[-1])]
                    if len(found) != 1:
                        raise ValueError(f"expected exactly one member {pattern}, found {len(found)}")
                    with packed.open(found[0]) as raw:
                        lines = csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline=""), delimiter="\t")
                        if lacking := sorted(set(columns) - set(lines.fieldnames or [])):
                            raise ValueError(f"{found[0]} lacks {', '.join(lacking)}")
                        rows = []
                        for line in lines:
                            rows.append({c: line[c] for c in columns})
                            if len(rows) == 4096:
                                yield pd.DataFrame(rows, columns=columns)
                                rows = []
                        yield pd.DataFrame(rows, columns=columns)

    return archive.mapInPandas(unpack, schema)


def read_source(spark: SparkSession, root: str, split: str, number: int) -> DataFrame:
    """Raw records of one source from a folder (plain or gzip) or from a ZIP."""
    if root.endswith(".zip"):
        rows = read_zip_member(spark, root, rf"{split}_source{number}\.tsv", RAW_COLUMNS)
    else:
        rows = read_tsv(spark, find_one(spark, root, rf"{split}_source{number}\.tsv(?:\.gz)?"), RAW_COLUMNS, ["country_key", "name_basic"])
    require_none(rows.where(F.trim("entity_id") == "").select(*RAW_COLUMNS), f"empty id in {split} source {number}")
    require_none(rows.where(~F.col("entity_id").startswith(f"S{number}-")).select("entity_id"), f"id of another source in {split} source {number}")
    return rows.withColumn("source", F.lit(number))


def read_truth(spark: SparkSession, root: str) -> DataFrame:
    if root.endswith(".zip"):
        return read_zip_member(spark, root, r"train_ground_truth\.tsv", ["source1_entity_id", "matched_entity_ids"])
    return read_tsv(spark, find_one(spark, root, r"train_ground_truth\.tsv"), ["source1_entity_id", "matched_entity_ids"])


def numbered_records(sources: list[DataFrame]) -> DataFrame:
    """Sources united, each in its own order, with dense numbers from 1 in `rid`.

    A row's place in its file is its scan position: kept by files that one task reads."""
    placed = [s.withColumn("__place", F.monotonically_increasing_id()) for s in sources]
    united = placed[0]
    for more in placed[1:]:
        united = united.unionByName(more, allowMissingColumns=True)
    numbered = dense_numbers(united, "source", "__place").drop("__place")
    require_none(numbered.groupBy("entity_id").agg(F.count("*").alias("n")).where("n > 1"), "repeated entity id")
    n, least, most = numbered.agg(F.count("*"), F.min("rid"), F.max("rid")).first()
    if n and (least, most) != (1, n):
        raise ValueError("record numbers have gaps")
    counts = {r["source"]: r["n"] for r in numbered.groupBy("source").agg(F.count("*").alias("n")).collect()}
    if not counts.get(1) or not (counts.get(2, 0) + counts.get(3, 0)):
        raise ValueError("need queries (source 1) and references (sources 2, 3)")
    return numbered


def write_parquet(df: DataFrame, path: str) -> None:
    """Published whole or not at all; an existing folder is an error."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def write_by_split(labeled: DataFrame, path: str) -> None:
    labeled.write.mode("errorifexists").partitionBy("dataset_split").option("compression", "zstd").parquet(path)


def write_cleaned(df: DataFrame, path: str, original: list[str]) -> None:
    """Gzip TSV: the original columns, then the derived ones by name."""
    derived = sorted(set(df.columns) - set(original))
    df.select(*original, *derived).write.mode("errorifexists").options(sep="\t", header=True, compression="gzip", escape='"', emptyValue="").csv(path)


def write_lists(df: DataFrame, path: str, order: str = "rid") -> None:
    """TSV parts in global order of `order`, which is not written itself; part names sort as their rows do."""
    df.orderBy(order).drop(order).write.mode("errorifexists").options(sep="\t", header=True, emptyValue="", escape='"').csv(path)


def write_json(spark: SparkSession, document: dict, path: str) -> None:
    """A small document, published whole in any store that Spark writes to; NaN is refused."""
    files.write_text(spark, path, json.dumps(document, ensure_ascii=False, allow_nan=False, sort_keys=True))


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(files.read_text(spark, path))


def log_metrics(spark: SparkSession, path: str, stage: str, step: int, **metrics: float) -> None:
    """One more JSON line of a run's log; NaN is refused."""
    line = json.dumps({"stage": stage, "step": step, "time": time.time(), **metrics}, allow_nan=False, sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)


def read_metrics(spark: SparkSession, path: str) -> list[dict]:
    """All lines of a log by time."""
    return sorted((json.loads(r["value"]) for r in spark.read.text(path).collect()), key=lambda x: x["time"])
