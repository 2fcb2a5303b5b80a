"""Where intermediate tables go, and small helpers the operators share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark's setting to remove the shuffle files of a query when it has ended.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written as Parquet to the shared folder and read again.

    The table survives lost executors and its lineage ends here, so the shuffle files of the
    write are of no more use and go when it has ended.
    """
    spark = rows.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(FREES_SHUFFLES, "false")
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(FREES_SHUFFLES, before)
    table = spark.read.schema(rows.schema).parquet(path)
    table._stored_at = path
    return table


def released(*tables: DataFrame) -> None:
    """Delete stored tables of which nothing is read any more, since all that did is stored itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def whole_text(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
