"""Reads from the source systems, and their landing as Parquet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlake import schemas as S

JDBC_TABLES = ("users", "products", "orders", "order_items")
CORRUPT = "_corrupt_record"


def jdbc_predicates(pages: int, parts: int) -> list[str]:
    """One WHERE clause per partition, by physical page: the server reads just those pages.

    ``pages`` is the table's size in pages as the catalog has it (``relpages``), which may lag: the
    last clause is open above, so every row meets exactly one clause whatever the true size is.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    parts = min(parts, max(1, pages))
    edges = [pages * i // parts for i in range(1, parts)]
    lower = ["", *(f"ctid >= '({e},0)'::tid" for e in edges)]
    upper = [*(f"ctid < '({e},0)'::tid" for e in edges), ""]
    return [" AND ".join(filter(None, both)) or "TRUE" for both in zip(lower, upper)]


def jdbc_properties(user: str, password: str, fetch_rows: int = 10_000) -> dict[str, str]:
    """A fetch size makes PostgreSQL stream; without one the driver buffers the whole result.

    Stamps without zone stay without zone: read as instants they would move with the session zone.
    """
    return {
        "driver": "org.postgresql.Driver",
        "user": user,
        "password": password,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
    }


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], parts: int = 64
) -> DataFrame:
    if table not in JDBC_TABLES:
        raise ValueError(f"{table!r} is none of the source's tables {JDBC_TABLES}")
    size = spark.read.jdbc(
        url, f"(SELECT relpages FROM pg_class WHERE oid = '{table}'::regclass) AS size",
        properties=dict(properties),
    )
    pages = int(size.first()[0])
    return spark.read.jdbc(
        url, table, predicates=jdbc_predicates(pages, parts), properties=dict(properties)
    )


def land(df: DataFrame, path: str) -> int:
    """Write a raw table and return its row count, taken while writing: no second scan."""
    seen = Observation("landing")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "compression", "snappy"
    ).parquet(path)
    return seen.get["rows"]


def ingest_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of the landed tables."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines events with a fixed schema of text: no inference pass over the data.

    Lines that are no JSON come as rows of NULLs with their text in ``_corrupt_record``. Event
    cleaning has no use for them; ``corrupt_lines`` puts them into the quarantine.
    """
    schema = T.StructType([*S.CLICKSTREAM_JSON.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def corrupt_lines(events: DataFrame) -> DataFrame:
    """Quarantine rows of lines that are no JSON."""
    return events.filter(F.col(CORRUPT).isNotNull()).select(
        F.lit(S.FACT_EVENTS_LOG.name).alias("table_name"), F.col("event_id").alias("row_key"),
        F.lit(CORRUPT).alias("column_name"), F.col(CORRUPT).alias("raw_value"),
        F.lit("unreadable line").alias("reason"),
    )


def read_tickets(spark: SparkSession, directory: str, with_issue_type: bool = True) -> DataFrame:
    """All ticket drops of a directory: the first full one and every dated one after it.

    Columns are text and typed in cleaning. The header of each file is checked against the schema.
    """
    fields = [f for f in S.TICKET_CSV.fields if with_issue_type or f.name != "Issue_Type"]
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(f"{directory.rstrip('/')}/CS_Tickets*.csv")
    )


def append_events(events: DataFrame, path: str, ingest_date: str) -> int:
    """Append a batch to its day's partition; an empty batch is accepted as 0."""
    seen = Observation("append")
    (
        events.withColumn("ingest_date", F.lit(ingest_date).cast("date"))
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy("ingest_date")
        .json(path, ignoreNullFields=False)
    )
    return seen.get["rows"]
