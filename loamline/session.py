"""Spark sessions and the storage that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that the library is written for; a cluster's own settings win."""
    b = SparkSession.builder.master(master).appName("loamline")
    for k, v in ({"spark.sql.shuffle.partitions": str(partitions), "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.driver.memory": "8g"} | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process: local, local[4], local[*, 2]; local-cluster is not."""
    return re.match(r"local(\[|$)", master) is not None


def shared_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local run has a temporary folder of its own; a cluster raises, as its machines share no such folder."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(sc, "_loamline_dir", None)
    if not base:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = sc._loamline_dir = "file://" + tempfile.mkdtemp(prefix="loamline-")
    return base.rstrip("/")


#: Folders that this process made; they go when it ends, as results are read from them until then.
MADE: dict[str, SparkSession] = {}


def new_dir(spark: SparkSession, label: str) -> str:
    """URI of a folder of our own below the shared one."""
    uri = f"{shared_root(spark)}/loamline/{label}-{uuid.uuid4().hex}"
    MADE[uri] = spark
    return uri


def deleted(spark: SparkSession, uri: str) -> None:
    """Deletes a folder through Spark's own file systems, so in any store that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    MADE.pop(uri, None)


@atexit.register
def tidy() -> None:
    for uri, spark in list(MADE.items()):
        with contextlib.suppress(Exception):  # gone already, or the JVM is
            deleted(spark, uri)


def written(df: DataFrame, label: str, codec: str = "uncompressed") -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts lineage, and what was computed survives lost executors.

    Hashes and ids don't compress, and compressors take memory outside the heap; tables of texts are written with codec "zstd".
    """
    spark, path = df.sparkSession, new_dir(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._loamline_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() made and no later plan reads."""
    for df in tables:
        deleted(df.sparkSession, df._loamline_path)


#: Names of schemes to Spark, and to Arrow's file systems.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss"}


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, for binary files that executors write and read: local, HDFS, S3, Google and Azure stores, with what their machines are set up with.

    Any other scheme raises a ValueError that names it; callers ask on the driver before anything runs.
    """
    scheme, sep, rest = uri.partition("://")
    if not sep and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    try:
        return pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + sep + rest if sep else uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as e:
        raise ValueError(f"binary files can't be written under {uri!r}: Arrow has no file system for it; name a folder in another store ({e})") from e


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage ended in the checkpoint folder of the session; see shared_root() for runs without one."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = shared_root(df.sparkSession)
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def unused(name: str, *tables: DataFrame) -> str:
    """The name, with as many underscores before it as it takes to differ from all columns."""
    have = {c.lower() for df in tables for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name
