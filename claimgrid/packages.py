"""Packages: a folder of any store with the MD5 digests of its files, computed and compared by tasks."""

from __future__ import annotations

import hashlib
import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrid.sources.readers import mounted_path

MANIFEST = "MANIFEST.md5"


def _place(spark: SparkSession, path: str):
    """The store of a path and its whole path there; paths without a scheme lie in the default file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, store.makeQualified(at)


def _child(spark: SparkSession, folder, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)


def _plain(path: str) -> str:
    """A path in which Spark finds no pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def packed(spark: SparkSession, folder: str) -> bool:
    store, at = _place(spark, folder)
    return store.exists(_child(spark, at, MANIFEST))


def _files(spark: SparkSession, folder: str) -> tuple[str, DataFrame, DataFrame]:
    """The folder's whole path, its files as Spark lists them, and the (path, name) of those that hold nothing, which a scan
    leaves out. Names that begin with a dot or an underscore are hidden, as are folders with such names."""
    root = _place(spark, folder)[1].toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_plain(root))
    every = [(re.sub("^file:/+", "file:/", unquote(u)),) for u in files.inputFiles()]  # as many as the index has listed
    name = F.expr(f"substring(path, {len(root) + 2})")
    empty = spark.createDataFrame(every, "path string").join(files.select("path"), "path", "left_anti").withColumn("name", name)
    return root, files.withColumn("name", name), empty


def _streamed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        digests = []
        for path in part["path"]:
            with open(mounted_path(path), "rb") as f:
                digests.append(hashlib.file_digest(f, "md5").hexdigest())
        yield pd.DataFrame({"name": part["name"], "length": part["length"], "md5": digests})


def digests(spark: SparkSession, folder: str, stream: bool = True) -> DataFrame:
    """(name, length, md5) of a folder's files but its manifest, named by their way from the folder.

    Spark deals files to tasks by their sizes. On a mounted file system a task streams its files, whatever their size; in
    other stores, or without ``stream``, it holds one at a time, of up to 2 GB, a larger one being an error.
    """
    root, files, empty = _files(spark, folder)
    files = files.where(F.col("name") != MANIFEST)
    if stream and mounted_path(root) is not None:
        own = files.select("path", "name", "length").mapInPandas(_streamed, "name string, length long, md5 string")
    else:
        own = files.select("name", "length", F.md5("content").alias("md5"))
    return own.union(empty.where(F.col("name") != MANIFEST).select("name", F.lit(0).cast("long"), F.md5(F.lit(b""))))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(name, md5) of a folder's manifest."""
    lines = spark.read.text(_plain(_child(spark, _place(spark, folder)[1], MANIFEST).toString()))
    return lines.where("value <> ''").select(F.expr("substring(value, 35)").alias("name"), F.expr("left(value, 32)").alias("md5"))


def states(spark: SparkSession, folder: str, stream: bool = True) -> DataFrame:
    """(name, state) of files that lie in a packed folder or that its manifest lists: same, changed, missing or new."""
    was, now = listed(spark, folder).withColumnRenamed("md5", "was"), digests(spark, folder, stream).select("name", F.col("md5").alias("now"))
    state = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "missing").when(F.col("was") == F.col("now"), "same").otherwise("changed")
    return was.join(now, "name", "full").select("name", state.alias("state"))


def changed(spark: SparkSession, folder: str) -> DataFrame:
    """(name, state) of files of a package that are missing or differ from its manifest."""
    return states(spark, folder).where("state in ('missing', 'changed')")


def _copied(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each file beside its place, then put there in one move: a task that runs again does no harm."""
    for part in parts:
        for source, target in zip(part["path"], part["target"], strict=True):
            os.makedirs(os.path.dirname(target), exist_ok=True)
            beside = os.path.join(os.path.dirname(target), f".{uuid.uuid4().hex}")
            shutil.copy2(mounted_path(source), beside)
            os.replace(beside, target)
        yield part[["target"]]


def copy(spark: SparkSession, source: str, folder: str) -> None:
    """Copies a file, or a folder's files, into a folder, under the last name of its path.

    Between mounted file systems tasks copy; else the driver streams file by file.
    """
    root, files, empty = _files(spark, source)
    name = _place(spark, source)[1].getName()
    single = _place(spark, source)[0].getFileStatus(_place(spark, source)[1]).isFile()
    to = _place(spark, folder)[1].toString().rstrip("/")
    target = F.lit(f"{to}/{name}") if single else F.concat(F.lit(f"{to}/{name}/"), F.col("name"))
    pairs = files.select("path", "name").union(empty).select("path", target.alias("target"))
    if mounted_path(root) is not None and mounted_path(to) is not None:
        local = F.concat(F.lit(mounted_path(to)), F.expr(f"substring(target, {len(to) + 1})"))
        pairs.withColumn("target", local).mapInPandas(_copied, "target string").write.format("noop").mode("overwrite").save()
        return
    util = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil
    for r in pairs.toLocalIterator():
        (from_store, at), (to_store, there) = _place(spark, r["path"]), _place(spark, r["target"])
        to_store.mkdirs(there.getParent())
        util.copy(from_store, at, to_store, there, False, True, spark.sparkContext._jsc.hadoopConfiguration())


def package(spark: SparkSession, folder: str, overwrite: bool = False, sources: Iterable[str] = ()) -> str:
    """Copies files and folders into a folder and writes its manifest, a file of lines ``md5  name`` sorted by name, whose path
    is returned; refuses to replace one unless told to.

    Only the lines go to one task, which sorts them; the file takes its place by one move.
    """
    store, at = _place(spark, folder)
    path = _child(spark, at, MANIFEST)
    if store.exists(path) and not overwrite:
        raise FileExistsError(path.toString())
    store.mkdirs(at)
    for s in sources:
        copy(spark, s, folder)
    beside = _child(spark, at, f"_manifest-{uuid.uuid4().hex}")
    lines = digests(spark, folder).repartition(1).sortWithinPartitions("name")
    lines.select(F.concat("md5", F.lit("  "), "name")).write.text(beside.toString())
    parts = [f.getPath() for f in store.listStatus(beside) if f.getPath().getName().startswith("part-")]
    store.delete(path, False)
    if parts:
        store.rename(parts[0], path)
    else:
        store.create(path).close()
    store.delete(beside, True)
    return path.toString()
