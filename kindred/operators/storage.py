"""The folder that driver and executors share, and tables written there."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in spark.checkpoint.dir; in local mode alone that may be unset, and a temporary folder serves."""
    folder, app = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _OWN.setdefault(app, tempfile.mkdtemp(prefix="kindred-"))
    return f"{folder.rstrip('/')}/kindred-{app}"


def written(df: DataFrame) -> DataFrame:
    """df by way of a table in the shared folder, which cuts its lineage and outlives executors."""
    path = f"{shared_folder(df.sparkSession)}/er-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete what this application left in the shared folder; call it when its results have been read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
