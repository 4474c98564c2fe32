"""Session settings and stored steps shared by operators."""

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def build_session(cores: str | int = "*", app: str = "patio") -> SparkSession:
    """Local session for tests and benchmarks; a cluster passes its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    if shared_folder(spark) is None:  # a cluster names its own
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="patio-"))
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder the cluster names in ``spark.checkpoint.dir``."""
    base = shared_folder(spark)
    if base is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(base, _run_folder(spark), f"{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame) -> DataFrame:
    """Write a result once and go on from the written table.

    Lineage ends there, later reads are columnar, and the planner knows the table's size.
    """
    path = scratch_folder(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete the stored steps under the session's shared folder. Results that still read them fail
    afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_folder(spark), _run_folder(spark)))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _run_folder(spark: SparkSession) -> str:
    return os.path.join("patio-tables", spark.sparkContext.applicationId)


def scalar_struct(one_row: DataFrame) -> Column:
    """All columns of a one-row aggregate as a struct scalar subquery."""
    return one_row.select(F.struct(*one_row.columns)).scalar()
