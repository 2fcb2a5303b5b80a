"""Registry of queries and their SQL, and the common output form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampType

from marketloom.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the equivalent over the same tables."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(function(pin_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def presented(rows: DataFrame) -> DataFrame:
    """Output in types that both engines hand over alike.

    Decimals become doubles with six digits, instants and dates text, arrays joined text.
    """
    columns = []
    for field in rows.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            column = F.round(column.cast("double"), 6)
        elif isinstance(field.dataType, TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, "; ")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def instant_sql(expression: str) -> str:
    """SQL text of an instant as ``presented`` writes it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
