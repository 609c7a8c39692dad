"""Cut lineage in storage that every executor can reach."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where none is set, as in tests."""
    sc = spark.sparkContext
    set_dir = sc._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(conf or tempfile.mkdtemp(prefix="checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder; later uses read the files, also after a lost executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


@dataclass
class Stored:
    """A table of columns in the checkpoint folder; compressed, and removed as soon as its maker needs it no more."""

    df: DataFrame
    path: str

    def remove(self) -> None:
        jvm, path = self.df.sparkSession._jvm, self.path
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def stored(df: DataFrame) -> Stored:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()  # Spark deletes the shuffle files of finished plans when the driver collects their handles
    return Stored(spark.read.schema(df.schema).parquet(path), path)
