"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; a local one is made only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="claimgrid-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new URI in the shared folder, in one folder for each application, which goes when the application ends.

    A root without a scheme lies in the cluster's default file system.
    """
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = files.Path(f"{shared_root(spark).rstrip('/')}/claimgrid-{spark.sparkContext.applicationId}")
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folder = store.makeQualified(folder)
    if not store.exists(folder):
        store.mkdirs(folder)
        store.deleteOnExit(folder)
    uri = str(folder.toUri())
    return f"{uri if '://' in uri else uri.replace(':/', ':///', 1)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, safe from lost executors, without its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, name: str, column: str, n: int) -> Iterator[DataFrame]:
    """df as a table in the shared folder, dealt into n parts by a column and sorted by it within them: joins and aggregations by it
    don't deal it again, and of a stretch of its values little else is read.

    Spark knows of the parts by its catalog, which forgets the table at the end of the block; its files stay like others.
    """
    path = shared_path(df.sparkSession, name)
    table = path.rpartition("/")[2].replace("-", "_")
    try:
        df.repartition(n, column).write.format("parquet").bucketBy(n, column).sortBy(column).options(path=path, compression="zstd").saveAsTable(table)
        yield df.sparkSession.table(table)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
