"""The catalogue: the relational store of parsed filings as tables of the session's catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables and their columns.
TABLES = {
    "filings": (
        "filing_id string, accession_number string, form_type string, public_document_count string, acceptance_datetime string, date_as_of_change string, effectiveness_date string, company_name string, sic string, irs_number string, "
        "state_of_incorporation string, fiscal_year_end string, form_type_from_filing_values string, sec_act string, sec_file_number string, film_number string, cik string, filed_as_of_date string, period_of_report string, "
        "source_relpath string, source_filename string, source_size_bytes bigint, source_sha256 string, processing_status string, delete_safe boolean"
    ),
    "header_fields": "filing_id string, section string, field_name string, field_value string, occurrence bigint",
    "company_data": "filing_id string, conformed_name string, cik string, sic string, irs_number string, state_of_incorporation string, fiscal_year_end string",
    "addresses": "filing_id string, address_kind string, street1 string, street2 string, city string, state string, postal_code string, phone string",
    "former_names": "filing_id string, ordinal int, former_name string, date_of_name_change string",
    "filing_items": "filing_id string, ordinal int, item_information string",
    "documents": (
        "filing_id string, sequence string, document_type string, filename string, description string, relative_path string, sha256 string, encoding_status string, zip_error string, "
        "size_bytes bigint, zip_extracted_files bigint, zip_extracted_bytes bigint"
    ),
    "archive_members": "filing_id string, sequence string, member_name string, extracted_path string, sha256 string, size_bytes bigint",
    "processing_warnings": "filing_id string, warning string",
}


def create_tables(spark: SparkSession, location: str, database: str = "filings_store") -> str:
    """Create what is missing of the database and its tables, as Parquet below ``location``; existing tables stay as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet LOCATION '{location}/{name}'")
    return database


def save(tables: dict[str, DataFrame], database: str) -> None:
    """Replace the contents of the tables by those of the same names; columns go by name."""
    for name, df in tables.items():
        if name in TABLES:
            df.select(*df.sparkSession.table(f"{database}.{name}").columns).write.mode("overwrite").insertInto(f"{database}.{name}")


def columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, position, column_name, data_type) of the database's tables."""
    rows = [(name, k, f.name, f.dataType.simpleString()) for name in TABLES for k, f in enumerate(spark.table(f"{database}.{name}").schema)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")
