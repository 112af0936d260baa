"""Shared folder, safe columns and batch sizes: what several operators of this package need."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW_BATCH_BYTES = 8 * 1024**2
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What operators with Python in tasks need of a session.

    Batches sent to Python stay near 8 MB however long the texts are, and executors get this package,
    which a cluster need not have installed.
    """
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[1]
        bundle = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(bundle))
        _shipped.add(application)
    if int(spark.conf.get(_BYTES_SETTING, str(2**31 - 1)).rstrip("b") or 0) > ARROW_BATCH_BYTES:
        spark.conf.set(_BYTES_SETTING, str(ARROW_BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Without one, the warehouse will do for a local master alone: its folder is often a local one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not named and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


class Workspace:
    """A fresh folder in the shared place for tables that cut lineage. Survives lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = f"{name}_{uuid.uuid4().hex}"
        self.folder = f"{shared_folder(spark)}/{self.name}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def put(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """Writes a table and returns it as read back; `by` makes one folder for each of its values."""
        writer = df.write.option("compression", "zstd").mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(self.path(name))
        return self.get(name, df.schema)

    def get(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Deletes a table that no result refers to any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Lets Spark delete the shuffle files of finished steps; it does so as plans are collected."""
        gc.collect()
        self.spark._jvm.System.gc()


def required(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that no further column of the input can clash with our own."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df.select(*[F.col(f"`{n}`") for n in names])


def whole_text(column: str = "text") -> Column:
    """The text, or the empty text for NULL."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def text_bytes(column: str = "text") -> Column:
    return whole_text(column).cast("binary")
