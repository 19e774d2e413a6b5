"""Helpers the training-data operators share: word rules, shared storage, joins whose size is checked."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space as the corpus defines it, for use inside a regular-expression class.
WS = r"\x20\x09-\x0D"
WORD = f"[^{WS}]+"

#: A table is broadcast only when a count of it proved at most this many rows.
BROADCAST_ROWS = 200_000
#: Narrow rows (ids, links, keys) that make a file of their own worth its while.
FILE_ROWS = 250_000


def text_of(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.array_remove(F.split(text_of(text), f"[{WS}]+"), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def workdir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or a folder of our own where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = _OWN.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="kindred-"))
    return folder.rstrip("/")


_OWN: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{workdir(spark)}/kindred-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    The written table cuts the lineage, and outlives any executor.  Where its
    rows are known to be at most `rows`, and these fill fewer files of
    FILE_ROWS than a shuffle has partitions, they are dealt evenly into as many
    files, at least one for each core: small tables stay free of tiny files.
    """
    spark = df.sparkSession
    if rows is not None:
        files = max(spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS))
        if files < int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.repartition(files)
    path = new_folder(spark, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete what materialize() and the file writers of this application left in the shared folder."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{workdir(spark)}/kindred-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sized_join(big: DataFrame, table: DataFrame, on, how: str, limit: int | None = None) -> DataFrame:
    """Join big with a materialized table: broadcast when a count proves it small, else shuffle both.

    The shuffled form is a plain sort-merge join, whose hot keys AQE splits.
    """
    small = table.limit((limit or BROADCAST_ROWS) + 1).count() <= (limit or BROADCAST_ROWS)
    return big.join(F.broadcast(table) if small else table.hint("merge"), on, how)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="kindred-zip-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()
