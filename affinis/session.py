"""Where intermediate tables are kept, and how a long lineage is cut."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Spark's setting to remove the shuffle files of a query as soon as it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or else the session's warehouse folder.

    On a cluster that folder has to be named: a warehouse on the local disk would be another one on each machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    scheme = urlsplit(warehouse).scheme or _file_system(spark, warehouse)[0].getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def publish(spark: SparkSession, built: str, path: str) -> bool:
    """Move the folder ``built`` to ``path`` in one step; if something is there already, ``built`` goes and the answer is no."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    _, source = _file_system(spark, built)
    files, target = _file_system(spark, path)
    files.mkdirs(target.getParent())
    rename = getattr(hadoop, "Options$Rename")
    never_replace = spark.sparkContext._gateway.new_array(rename, 1)
    never_replace[0] = rename.valueOf("NONE")
    try:
        hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, target, never_replace)
    except Py4JJavaError:
        if not files.exists(target):
            raise
        files.delete(source, True)
        return False
    return True


def job_dir(spark: SparkSession) -> str:
    """The folder of this application's tables; it goes when the application ends."""
    path = f"{shared_dir(spark)}/affinis-{spark.sparkContext.applicationId}"
    files, where = _file_system(spark, path)
    if not files.exists(where):
        files.mkdirs(where)
        files.deleteOnExit(where)
    return path


def new_path(spark: SparkSession, label: str) -> str:
    return f"{job_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table", instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Unlike cached blocks the table survives lost executors, is read back with
    column pruning, and gives the planner true sizes for join selection.
    ``instead_of`` is a written table that nobody needs once this one is there.
    A table that has been written is returned as it is.
    """
    if getattr(df, "_affinis_path", None) and instead_of is None:
        return df
    out = materialize_in_turn([df], label)
    if instead_of is not None:
        remove(instead_of)
    return out


def materialize_in_turn(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """One written table of all ``parts``; a part's shuffle files go as it is written, so the disk holds those of one part."""
    path = kind = spark = None
    for part in parts:
        spark, kind = part.sparkSession, part.schema
        path = path or new_path(spark, label)
        before = spark.conf.get(CLEAN_UP, None)
        spark.conf.set(CLEAN_UP, "true")
        try:
            part.write.mode("append").parquet(path)
        finally:
            spark.conf.set(CLEAN_UP, before) if before is not None else spark.conf.unset(CLEAN_UP)
    out = spark.read.schema(kind).parquet(path)
    out._affinis_path = path
    return out


def remove(table: DataFrame) -> None:
    """Delete a table of ``materialize`` that nobody reads any more."""
    if hasattr(table, "_affinis_path"):
        files, where = _file_system(table.sparkSession, table._affinis_path)
        files.delete(where, True)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed now.

    Spark removes them once the driver's garbage collection finds their plans
    gone; a job of many steps with a small driver rarely needs one, and would keep all of them to its end.
    Plans are held by tables on the Python side, too, of which some are in cycles.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column position.

    Spark 4.1 lets a union keep the partitioning its inputs have in common and
    plans a following aggregate without a shuffle. Adaptive execution may then
    merge the partitions of each input differently, and rows with equal keys
    never meet (seen on 4.1.2 with ``distinct`` over two ranked tables). The
    session is told not to do that.
    """
    first.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    out = first
    for df in others:
        out = out.unionAll(df)
    return out
