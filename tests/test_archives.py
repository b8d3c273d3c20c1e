"""ZIP archives: large ones, several members, the sample mark, malformed rows."""

import os
import zipfile

import pytest

from kinloom.sources import archives, tables

ROWS = "entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t\"a\nb\"\tNA\tUS\nS1-2\t\t\t\n"


def test_an_archive_over_two_gigabytes(spark, tmp_path):
    """2.2 GB stand before the archive's own data (a hole in the file); only the directory and the member are read."""
    path = tmp_path / "large.zip"
    with open(path, "wb") as f:
        f.truncate(2_200_000_000)
    with zipfile.ZipFile(path, "a", zipfile.ZIP_DEFLATED) as packed:
        packed.writestr("inner/train_source1.tsv", ROWS)
        packed.writestr("inner/train_source2.tsv", ROWS.replace("S1", "S2"))
    assert os.path.getsize(path) > 2**31
    for where in (str(path), f"file://{path}"):
        rows = tables.read_source(spark, where, "train", 1).orderBy("entity_id").collect()
        assert [tuple(r)[:5] for r in rows] == [("S1-1", "a\nb", "NA", "US", 1), ("S1-2", "", "", "", 1)]


def test_a_partition_for_each_member(spark, tmp_path):
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for i in range(5):
            packed.writestr(f"d{i}/part{i}.tsv", "\ufeffa\tb\n" + "".join(f"{i}\t{j}\n" for j in range(10_000)))
        packed.writestr("other.txt", "x")
    read = archives.read_members(spark, str(path), r"part\d\.tsv", ["b", "a"])
    assert read.columns == ["b", "a", "member", "place"] and read.rdd.getNumPartitions() == 5
    assert {(r["a"], r["n"]) for r in read.where("cast(b as long) = place").groupBy("a").count().withColumnRenamed("count", "n").collect()} == {(str(i), 10_000) for i in range(5)}
    with pytest.raises(ValueError, match="exactly one"):
        tables.read_zip_member(spark, str(path), r"part\d\.tsv", ["a"])
    with pytest.raises(Exception, match="lacks c"):
        archives.read_members(spark, str(path), r"part0\.tsv", ["c"]).collect()


def test_marked_archives_are_refused(spark, tmp_path):
    path = tmp_path / "sample.zip"
    with zipfile.ZipFile(path, "w") as packed:
        packed.writestr("x/train_source1.tsv", ROWS)
        packed.writestr("x/SAMPLE_README.txt", "a sample")
    for read in (lambda: tables.refuse_sample(spark, str(path)), lambda: tables.read_source(spark, str(path), "train", 1).collect()):
        with pytest.raises(ValueError, match="sample"):
            read()
    with pytest.raises(Exception, match="sample"):
        archives.read_members(spark, str(path), r".*\.tsv", ["entity_id"]).collect()


def test_malformed_rows_are_errors(spark, tmp_path):
    path = tmp_path / "bad.zip"
    with zipfile.ZipFile(path, "w") as packed:
        packed.writestr("train_source1.tsv", ROWS + "S1-3\tonly two\n")
    with pytest.raises(Exception, match="malformed row 3"):
        tables.read_source(spark, str(path), "train", 1).collect()


def test_paths():
    assert archives.can_open("/a/b.zip") and archives.can_open("s3a://bucket/b.zip") and not archives.can_open("viewfs://store/b.zip")
