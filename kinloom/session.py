"""Session builder and the shared-folder helpers every multi-job operator uses."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Spark then deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What Spark decides by the bytes of files and shuffles: tables to broadcast, partitions to put together.
BY_BYTES = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}

#: The same without broadcasts, but small shuffles are put together: at most 4 MB to a task, and no more than a core's share beyond 64 KB.
FEW_TASKS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
}


def get_session(app: str = "kinloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; callers' settings win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, so that a local folder is seen by all."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local master gets a temporary
    one (tests); on a cluster each executor would write to its own disk, so that is an error."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not folder:
        if not is_local(spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinloom-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def staged(df: DataFrame, tag: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read instead of a recomputation. What was shuffled for it goes at once.
    `settings` hold while it is written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    wanted = {SHUFFLE_CLEANUP: "true"} | (settings or {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinloom_staged = path
    return out


def staged_by_shuffle(df: DataFrame, tag: str) -> DataFrame:
    """staged for tables of records: Spark judges them by their bytes on disk, which repeated values make small, and
    would send millions of rows through the driver, or to one task."""
    return staged(df, tag, BY_BYTES)


def staged_in_few_tasks(df: DataFrame, tag: str) -> DataFrame:
    """The same for tables of distinct values and for many small steps in a row, whose tasks would cost more than their rows."""
    return staged(df, tag, FEW_TASKS)


def unstage(*frames: DataFrame) -> None:
    """Delete the folders of staged frames that nothing reads any more."""
    for df in frames:
        path = df.__dict__.get("_kinloom_staged")
        if path:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, through Spark's own file server, once a context."""
    context = spark.sparkContext
    if getattr(context, "_kinloom_shipped", False):
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="kinloom-")) / "kinloom.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(home.rglob("*.py")):
            packed.write(module, f"{home.name}/{module.relative_to(home)}")
    context.addPyFile(str(archive))
    context._kinloom_shipped = True
