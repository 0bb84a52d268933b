"""Intermediate tables in the shared folder of the cluster, and the package on its workers."""

import os
import tempfile
import threading
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Applications whose workers have the package.
_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="talkweave-")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started. Spark's file server hands it out.

    Once per application: its sessions, of which every micro-batch of a stream has one of its own, share the file server.
    """
    application = spark.sparkContext.applicationId
    with _SHIPPING:
        if application in _SHIPPED:
            return
        package = Path(__file__).parent
        archive = os.path.join(tempfile.mkdtemp(prefix="talkweave-"), "talkweave-package.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Several branches can then scan just the columns they need, an executor loss
    costs no recomputation, and side effects upstream (model calls) happen once.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
