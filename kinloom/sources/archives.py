"""Members of ZIP archives as a data source: the central directory is read first, each member is a partition and is streamed.

The archive is opened by Arrow's file systems, which read at any place of a file of any size; of it only the
directory and the members asked for are read. A member is one deflate stream, so one task reads it, row by row."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kinloom.session import ship_package

SAMPLE_MARK = "SAMPLE_README.txt"
#: Rows of a batch.
ROWS = 4096
#: Schemes that Arrow opens, by its own names.
_SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def scheme(path: str) -> str:
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else ""


def can_open(path: str) -> bool:
    return scheme(path) in _SCHEMES


@contextmanager
def opened(path: str) -> Iterator[zipfile.ZipFile]:
    from pyarrow import fs

    own = scheme(path)
    if _SCHEMES[own] == "file":
        system, inner = fs.LocalFileSystem(), re.sub(r"^file:(?://(?=/))?", "", path)
    else:
        system, inner = fs.FileSystem.from_uri(_SCHEMES[own] + path[len(own) :])
    with system.open_input_file(inner) as raw, zipfile.ZipFile(raw) as archive:
        yield archive


def base_name(member: str) -> str:
    return member.rsplit("/", 1)[-1]


def member_names(path: str, pattern: str = ".*") -> list[str]:
    """Names of the members whose base name matches; an archive that is marked as a sample is refused."""
    with opened(path) as archive:
        names = [n for n in archive.namelist() if not n.endswith("/")]
    if any(base_name(n) == SAMPLE_MARK for n in names):
        raise ValueError(f"{path} holds a sample, not the full data")
    return [n for n in names if re.fullmatch(pattern, base_name(n))]


class Member(InputPartition):
    def __init__(self, name: str) -> None:
        self.name = name


class ZipReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.path, self.pattern, self.columns = options["path"], options["pattern"], json.loads(options["columns"])

    def partitions(self) -> list[Member]:
        return [Member(n) for n in member_names(self.path, self.pattern)]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        names = [*self.columns, "member", "place"]
        schema = pa.schema([(c, pa.string()) for c in names[:-1]] + [("place", pa.int64())])
        with opened(self.path) as archive, archive.open(partition.name) as raw:
            lines = csv.DictReader(io.TextIOWrapper(raw, "utf-8-sig", newline=""), delimiter="\t")
            if lacking := sorted(set(self.columns) - set(lines.fieldnames or [])):
                raise ValueError(f"{partition.name} lacks {', '.join(lacking)}")
            rows: list[dict] = []
            for place, line in enumerate(lines):
                if None in line or None in line.values():
                    raise ValueError(f"malformed row {place + 1} in {partition.name}")
                rows.append({**{c: line[c] for c in self.columns}, "member": partition.name, "place": place})
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


class ZipSource(DataSource):
    """Options: path, pattern (of base names), columns (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return "zip_tsv"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in [*json.loads(self.options["columns"]), "member"]] + [T.StructField("place", T.LongType())])

    def reader(self, schema: T.StructType) -> ZipReader:
        return ZipReader(schema, self.options)


def read_members(spark: SparkSession, path: str, pattern: str, columns: list[str]) -> DataFrame:
    """The columns of all matching TSV members as strings, with `member` and the row's `place` in it."""
    ship_package(spark)
    spark.dataSource.register(ZipSource)
    return spark.read.format("zip_tsv").option("pattern", pattern).option("columns", json.dumps(columns)).load(path)
