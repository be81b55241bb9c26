"""Session-level helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under ``sf_dir`` (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests on one machine) a fresh temporary folder is chosen and
    set; on a cluster a missing setting is an error, as every machine would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="tidegrid-shared-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/tidegrid/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage by a table written to the shared folder, and read that table.

    The table outlives executors. It keeps the number of files Spark chose, so its size follows the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    discard_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def discard_at_end(spark: SparkSession, path: str) -> None:
    """Delete a scratch table when the driver ends; ``release_scratch`` does so earlier."""
    fs, hpath = hadoop_fs(spark, path)
    fs.deleteOnExit(hpath(path))


def release_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables in the shared folder. Results that still read them can't be read afterwards."""
    root = f"{shared_dir(spark)}/tidegrid"
    fs, hpath = hadoop_fs(spark, root)
    fs.delete(hpath(root), True)


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, Path class) of a path, for listing and renaming on whatever storage holds it."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path
    return hpath(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def add_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers on other machines (a no-op where it already is)."""
    import shutil

    root = os.path.dirname(os.path.abspath(__file__))
    sc = spark.sparkContext
    if getattr(sc, "_tidegrid_shipped", False):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="tidegrid-pkg-"), "tidegrid")
    sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root)))
    sc._tidegrid_shipped = True
