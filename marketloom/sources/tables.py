"""Stored tables: optional reads, rate-limited streams, bootstrap, registration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder, so that readers see all of it or nothing."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    file_system = jvm_path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(jvm_path(target).getParent())
    if not file_system.rename(jvm_path(source), jvm_path(target)):
        raise OSError(f"could not move {source} to {target}")


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    table_format: str = "parquet",
    exact: bool = False,
) -> DataFrame | None:
    """The table at ``path``, or None when there is none.

    A partitioned table has its partition columns too; ``exact`` keeps those of ``schema`` only.
    """
    reader = spark.read.format(table_format)
    if schema is not None and table_format != "delta":
        reader = reader.schema(schema)
    try:
        table = reader.load(path)
        return table.select(*schema.names) if exact and schema is not None else table
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND", "DELTA_PATH_DOES_NOT_EXIST"):
            return None
        raise


def read_table_or_empty(
    spark: SparkSession, path: str, schema: StructType, *, table_format: str = "parquet"
) -> DataFrame:
    """The table at ``path``, or an empty frame of the same schema."""
    table = read_table(spark, path, schema, table_format=table_format)
    return spark.createDataFrame([], schema) if table is None else table


def read_tables(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, StructType],
    *,
    table_format: str = "parquet",
) -> dict[str, DataFrame | None]:
    """Several tables by name, None for each that does not exist."""
    return {
        name: read_table(spark, path, schemas.get(name), table_format=table_format)
        for name, path in paths.items()
    }


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    table_format: str = "parquet",
    max_files_per_trigger: str | int | None = None,
) -> DataFrame:
    """The rows appended to a table, optionally so many files at a time."""
    reader = spark.readStream.format(table_format)
    if schema is not None and table_format != "delta":
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def ensure_table(
    spark: SparkSession, path: str, schema: StructType, *, table_format: str = "parquet"
) -> bool:
    """Write an empty table unless one exists, so that a stream over it can start.

    Returns whether it was written.
    """
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.format(table_format).mode("ignore").save(path)
    return True


def register_tables(
    spark: SparkSession,
    database: str,
    paths: Mapping[str, str],
    *,
    table_format: str = "parquet",
    statistics: Mapping[str, Sequence[str]] | None = None,
) -> list[str]:
    """Create the database and an external table per existing path; returns their names.

    Registering again finds new partitions. The optimizer gets every table's size, which reads
    file lists only; ``statistics`` names columns of tables that are scanned for their row count,
    ranges and distinct values as well.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    registered = []
    for name, path in paths.items():
        if not path_exists(spark, path):
            continue
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` USING {table_format} LOCATION '{path}'"
        )
        columns = spark.catalog.listColumns(f"`{database}`.`{name}`")
        if any(column.isPartition for column in columns):
            spark.catalog.recoverPartitions(f"`{database}`.`{name}`")
        spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS NOSCAN")
        if chosen := (statistics or {}).get(name):
            names = ", ".join(f"`{column}`" for column in chosen)
            spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS FOR COLUMNS {names}")
        registered.append(name)
    return registered
