"""Session builder, table access and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[*]", app: str = "lamina", **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE; on one machine, few shuffle partitions (a cluster's own hold elsewhere)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master.startswith("local["):
        b = b.config("spark.sql.shuffle.partitions", "8")
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table `name` of the folder; instants are zone-free."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: list[str] = []
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Only where that setting is absent (a local session, as in tests) a temporary folder of this machine
    is made and set as the checkpoint folder; it is removed when the interpreter ends.
    """
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="lamina-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return "file://" + _LOCAL[0]


def shared_table(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    at = f"{shared_dir(spark)}/lamina/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(at)
    return at


def forget(spark: SparkSession) -> int:
    """Deletes the shared tables this process wrote; call it when no frame that reads them is needed any more."""
    n = len(_WRITTEN)
    while _WRITTEN:
        fs, p = hadoop_path(spark, _WRITTEN.pop())
        fs.delete(p, True)
    return n


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, and lost executors cost nothing."""
    at = shared_table(df.sparkSession, label)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of a path, through Hadoop's own client."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fits(df: DataFrame, rows: int) -> bool:
    """Whether the frame has at most `rows` rows; reads no more than it must."""
    return df.limit(rows + 1).agg(F.count("*")).first()[0] <= rows


def env_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)
