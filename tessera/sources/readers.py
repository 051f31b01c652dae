"""Sources: filing indexes, manifests, inventories, text parts, records and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalars import FORM_ORDER, canonical_form, cik_any, index_path, index_url, strip, year_and_folder
from tessera.operators.relational import require_columns

# The columns of the manifest, of the download log and of a text record.
MANIFEST = ("cik", "company_name", "form_type", "date_filed", "filename", "filing_url", "output_path")
ARCHIVE_ROOT = "https://www.sec.gov/Archives/"
DOWNLOAD_LOG = T.StructType([T.StructField(c, T.StringType()) for c in ("timestamp", "filing_url", "output_path", "status")] + [T.StructField("bytes_written", T.LongType()), T.StructField("error_message", T.StringType())])
DOC_TEXT = ("doc_id", "rel_path", "part_id", "year", "form_type", "cik", "entity_name", "filing_date", "period_of_report", "acceptance_datetime", "accession", "primary_doc_type", "primary_doc_filename", "clean_text")


def index_rows(lines: DataFrame, value: str = "value") -> DataFrame:
    """Rows of a quarterly index: of the lines after the rule those of exactly five parts, whatever is in them."""
    parts = F.transform(F.split(F.col(value), r"\|"), lambda p: strip(p))
    rows = lines.select(parts.alias("_p")).filter(F.size("_p") == 5)
    out = rows.select(*(F.col("_p")[k].alias(c) for k, c in enumerate(MANIFEST[:5])))
    return out.withColumn("filing_url", F.concat(F.lit(ARCHIVE_ROOT), "filename"))


def read_master_index(spark: SparkSession, path: str) -> DataFrame:
    """Index files in Latin-1, one row of the scan each (a quarter is some 50 MB). What stands above the first line that begins with dashes is
    no row; a file without such a line is an error when it is read."""
    files = spark.read.format("binaryFile").load(path)
    halves = files.select("path", F.split(F.decode("content", "ISO-8859-1"), r"(?md)^-----[^\n]*\n?", 2).alias("_h"))
    rest = F.when(F.size("_h") == 2, F.col("_h")[1]).otherwise(F.raise_error(F.concat(F.lit("no rule of dashes in "), F.col("path"))))
    return index_rows(halves.select(F.explode(F.split(rest, "\r?\n")).alias("value")))


def quarters(spark: SparkSession, first_year: int, last_year: int, now: tuple[int, int] | None = None) -> DataFrame:
    """(year, quarter, url, local_path) from ``first_year`` on, up to the current quarter ``now``."""
    if first_year > last_year or (now and last_year > now[0]):
        raise ValueError("the years must be in order and not in the future")
    out = spark.range(4 * (last_year - first_year + 1)).select((F.lit(first_year) + F.floor(F.col("id") / 4)).cast("int").alias("year"), (F.col("id") % 4 + 1).cast("int").alias("quarter"))
    if now:
        out = out.filter((F.col("year") < now[0]) | ((F.col("year") == now[0]) & (F.col("quarter") <= now[1])))
    return out.withColumn("url", index_url(F.col("year"), F.col("quarter"))).withColumn("local_path", index_path(F.col("year"), F.col("quarter")))


def read_csv(spark: SparkSession, path: str, *required: str) -> DataFrame:
    """A CSV file with a header; a byte order mark is not part of the first name; all columns are text."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    return require_columns(df.toDF(*(c.removeprefix("﻿").strip() for c in df.columns)), *required)


def read_csv_or_empty(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The CSV file, or no rows where it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p):
        return read_csv(spark, path, *columns)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def _relpath(path: Column, root: str) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"^[a-z]+:/+", "/"), f"^{root.rstrip('/')}/", "")


def inventory(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("txt", "html", "htm"), with_content: bool = False) -> DataFrame:
    """Files below ``root``: relpath, year, form_folder, file_name, size and modification time; contents are only read if wanted.
    Files without a byte are not listed: Spark's file sources pass over them."""
    glob = "*.{" + ",".join(x for s in suffixes for x in (s, s.upper())) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    rel = _relpath(F.col("path"), root)
    place = year_and_folder(F.col("relpath"))
    out = files.select(rel.alias("relpath"), F.col("length").alias("file_size_bytes"), (F.unix_micros("modificationTime") * 1000).alias("source_mtime_ns"), *(["content"] if with_content else []))
    return out.select("*", place["year"].alias("year"), place["folder"].alias("form_folder"), F.element_at(F.split("relpath", "/"), -1).alias("file_name"))


def scan_submissions(spark: SparkSession, root: str) -> DataFrame:
    """(relpath, content) of ``<4-digit year>/<form>/*.txt`` below ``root``."""
    return inventory(spark, root, ("txt",), with_content=True).filter(F.col("year").rlike("^[0-9]{4}$") & (F.col("form_folder") != ""))


def purge_scan(spark: SparkSession, root: str) -> DataFrame:
    """Text files of any form below a folder that is a year; contents are not read."""
    return inventory(spark, root, ("txt",)).filter(F.col("year").rlike("^[0-9]{4}$"))


def form_inventory(spark: SparkSession, root: str, forms: tuple[str, ...] = FORM_ORDER) -> DataFrame:
    """The inventory of the folders of the given forms (blanks in a form are underscores in its folder)."""
    return inventory(spark, root).filter(canonical_form(F.col("form_folder")).isin(*forms))


def part_names(spark: SparkSession, path: str) -> DataFrame:
    """(part, size_bytes) of the files of a folder, ordered by name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("part"), F.col("length").alias("size_bytes")).orderBy("part")


def last_of(records: DataFrame, key: str, *order: str) -> DataFrame:
    """One record a key: the last by ``order`` (of equals the greatest record); null keys have none. Combined before the shuffle."""
    rest = [c for c in records.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("_r")
    return records.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, *(F.col(f"_r.{c}").alias(c) for c in rest))


def processed_values(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct values of one column over all CSV parts; a folder that is not there has none."""
    return read_csv_or_empty(spark, path, (column,)).select(column).filter(F.col(column).isNotNull()).distinct()


def read_text_parts(spark: SparkSession, path: str, columns: tuple[str, ...] = DOC_TEXT) -> DataFrame:
    """Text records from JSON lines, compressed or not; blank lines give none."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).json(path).filter(F.coalesce(*(F.col(c) for c in columns)).isNotNull())


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Nested recovery records, one JSON document per file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def existing_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct paths, and distinct (cik, accession), of documents there are."""
    return docs.select("rel_path").distinct(), docs.filter("accession <> ''").select(cik_any(F.col("cik")).alias("cik"), "accession").distinct()


def year_coverage(rows: DataFrame) -> DataFrame:
    """(year, doc_count) from text columns; unreadable rows are dropped."""
    return rows.select(F.col("year").try_cast("int").cast("string").alias("year"), F.col("doc_count").try_cast("bigint").alias("doc_count")).filter("year IS NOT NULL AND doc_count IS NOT NULL")


def target_per_year(spark: SparkSession, path: str, override: int | None = None) -> int:
    """The positive target a balance report names, unless overridden."""
    value = override or spark.read.json(path, multiLine=True).select(F.col("target_per_year").cast("bigint")).head()[0]
    if not value or value <= 0:
        raise ValueError("no positive target per year")
    return int(value)
