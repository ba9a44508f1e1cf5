"""The file-reference table: one schema, stated once."""

from __future__ import annotations

from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

# Names, order and types of the table's columns.
FILE_REFS_SCHEMA = StructType([
    StructField("reporting_entity_name", StringType(), True),
    StructField("reporting_entity_type", StringType(), True),
    StructField("plan_name", StringType(), True),
    StructField("plan_id", StringType(), True),
    StructField("plan_market_type", StringType(), True),
    StructField("file_url", StringType(), True),
    StructField("file_network", StringType(), True),
    StructField("file_type", StringType(), True),
    StructField("file_date", DateType(), True),
    StructField("extracted_ts", TimestampType(), True),
])
FILE_REFS_COLUMNS = [f.name for f in FILE_REFS_SCHEMA.fields]
PARTITION_COLUMN = "file_date"


def file_refs_ddl(table: str, provider: str = "parquet", location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for the file-reference table."""
    cols = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in FILE_REFS_SCHEMA.fields)
    loc = f"\nLOCATION '{location}'" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n) USING {provider}\n"
        f"PARTITIONED BY ({PARTITION_COLUMN}){loc}"
    )
