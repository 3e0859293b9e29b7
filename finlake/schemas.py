"""Schemas at the ingestion edges and of the stored tables.

Fixed values: field names, types and order are the contract of the files and
tables that other programs read and write."""
from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw transaction files (bronze). Every field is nullable: a file read does
# not enforce nullability, presence is enforced later by ``dropna``.
RAW_TRANSACTION = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("transaction_type", StringType()),
        StructField("status", StringType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
        StructField("metadata", StringType()),
    ]
)
RAW_COLUMNS = RAW_TRANSACTION.fieldNames()

SILVER_EXTRA = StructType(
    [
        StructField("amount_usd", DoubleType()),
        StructField("has_currency_issue", BooleanType()),
        StructField("transaction_date", DateType()),
        StructField("transaction_year", IntegerType()),
        StructField("transaction_month", IntegerType()),
        StructField("_etl_loaded_at", TimestampType()),
    ]
)
SILVER = StructType(RAW_TRANSACTION.fields + SILVER_EXTRA.fields)

# JSON payload of one stream event.
EVENT = StructType(
    [
        StructField("event_id", StringType()),
        StructField("transaction_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("event_type", StringType()),
        StructField("event_time", TimestampType()),
    ]
)
EVENT_COLUMNS = EVENT.fieldNames()

# Stored stream table: payload + ingest stamp + date parts.
EVENT_TABLE = StructType(
    EVENT.fields
    + [
        StructField("ingested_at", TimestampType()),
        StructField("transaction_date", DateType()),
        StructField("event_year", IntegerType()),
        StructField("event_month", IntegerType()),
    ]
)
EVENT_TABLE_DDL = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in EVENT_TABLE)
