"""Stored results and the shared folder that intermediate tables live in."""

from __future__ import annotations

import functools
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Names below a path target: Spark's readers pass over what begins with an underscore.
POINTER = "_current"
VERSION = "version-"


def save_table(
    df: DataFrame, target: str, *, fmt: str = "parquet", partition_by: list[str] | None = None
) -> DataFrame:
    """Replace ``target`` by ``df`` and return the stored table.

    A target with a slash or a scheme is a path, anything else a table name.  A path holds
    versions: a new one is written beside the old, then the file that names the current one is
    replaced in one step.  A write that fails leaves the old table, and ``df`` may read
    its target.  ``load_table`` reads the current version; the one before stays for readers under way.
    """
    spark = df.sparkSession
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        versions = _Versions(spark, target)
        version = f"{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex}"
        writer.save(f"{target}/{version}")
        versions.point_to(version)
        return spark.read.format(fmt).schema(df.schema).load(f"{target}/{version}")
    # The old table goes only when the new one is whole; df may read it.
    fresh = f"{target}_{uuid.uuid4().hex}"
    writer.saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
    return spark.table(target)


def load_table(spark: SparkSession, target: str, *, fmt: str = "parquet") -> DataFrame:
    """The table that ``save_table`` stored last under a path or name."""
    if "/" not in target:
        return spark.table(target)
    version = _Versions(spark, target).current()
    if version is None:
        raise FileNotFoundError(f"{target} holds no table")
    return spark.read.format(fmt).load(f"{target}/{version}")


class _Versions:
    """The versions below a path and the file that names the current one."""

    def __init__(self, spark: SparkSession, target: str):
        hadoop = spark._jvm.org.apache.hadoop
        self._fs_package = hadoop.fs
        self.root = hadoop.fs.Path(target)
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self.root.getFileSystem(self._conf)
        self._io = hadoop.io.IOUtils
        self._spark = spark

    def _path(self, name: str):
        return self._fs_package.Path(self.root, name)

    def current(self) -> str | None:
        pointer = self._path(POINTER)
        if not self._files.exists(pointer):
            return None
        stream = self._files.open(pointer)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def point_to(self, version: str) -> None:
        before = self.current()
        fresh = self._path(f"{POINTER}-{uuid.uuid4().hex}")
        stream = self._files.create(fresh)
        stream.writeUTF(version)
        stream.close()
        context = self._fs_package.FileContext.getFileContext(self.root.toUri(), self._conf)
        options = self._spark._sc._gateway.new_array(self._spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        qualified = [self._files.makeQualified(p) for p in (fresh, self._path(POINTER))]
        context.rename(*qualified, options)
        for status in self._files.listStatus(self.root):
            name = status.getPath().getName()
            # Newer ones may be under way.
            if name.startswith(VERSION) and name < version and name != before:
                self._files.delete(status.getPath(), True)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    """One folder for all runs of a local process."""
    return tempfile.mkdtemp(prefix="linkloom-")


class RunStore:
    """Tables of one run, written once each under the shared folder.

    A table that a previous driver finished is read back instead of written
    again, so a run restarted under its old ``run_id`` repeats no request of a
    finished round.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/linkloom/{run_id or uuid.uuid4()}"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _file_system(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def finished(self, name: str) -> bool:
        marker = self._path(f"{name}/_SUCCESS")
        return self._file_system(marker).exists(marker)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        if not self.finished(name):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def guard(self, name: str, value: str) -> None:
        """Note what the run is about; raise if it was started about something else."""
        noted = self.write(name, self.spark.createDataFrame([(value,)], "value string")).first()[0]
        if noted != value:
            raise ValueError(f"{self.root} is a run with another {name}: {noted}, not {value}")

    def read_all(self, name: str, schema: StructType) -> DataFrame:
        """All files below ``name``, whatever folders they are in, as one table."""
        reader = self.spark.read.schema(schema).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.root}/{name}")

    def drop(self) -> None:
        """Delete the run's tables; frames that read them stop working."""
        root = self._path("")
        self._file_system(root).delete(root, True)
