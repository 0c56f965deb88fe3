"""Tables in the folder that driver and executors share, to cut lineage and to settle paid work once."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names. A temporary one only where none is set and driver and executors are
    one process; elsewhere each machine would have its own, and what is written would be lost."""
    found = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sheafline-")
        spark.conf.set(CHECKPOINT_DIR, found)
    return found.rstrip("/")


def drop(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


class Scratch:
    """Written tables of one run; whatever is left goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/sheafline-{name}-{uuid.uuid4().hex}"
        self.count = 0
        atexit.register(self.clear)

    def path(self) -> str:
        self.count += 1
        return f"{self.root}/{self.count}"

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = self.path()
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def table(self, df: DataFrame) -> DataFrame:
        return self.write(df)[0]

    def clear(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                drop(self.spark, self.root)
        except Exception:  # the session may have ended before the driver does
            pass
