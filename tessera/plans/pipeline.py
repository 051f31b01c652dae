"""The pipeline end to end: from index lines to a manifest, from submissions to tables, from submissions to text products."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import FORM_ORDER, filing_path, form_key
from tessera.operators import quota, relational, sections, submission
from tessera.session import stored
from tessera.sources.readers import index_rows


def manifest(index_lines: DataFrame, universe: DataFrame | None = None, forms: tuple[str, ...] = FORM_ORDER) -> DataFrame:
    """Rows of the wanted forms and companies with the path each filing is kept at."""
    rows = index_rows(index_lines).filter(relational.wanted_form(F.col("form_type"), list(forms))).withColumn("form_type", form_key(F.col("form_type")))
    path = filing_path(F.col("form_type"), F.col("cik"), F.col("date_filed"), F.col("filename"), F.col("company_name"))
    out = rows.withColumn("output_path", path)
    if universe is None:
        return out
    return relational.manifest_reasons(out, universe, list(forms)).filter("reason = 'kept'").drop("reason")


def decompose(files: DataFrame) -> dict[str, DataFrame]:
    """(relpath, content) to the filings table, its children and the errors; files are parsed once."""
    parsed = stored(submission.parse_submissions(files))
    filings = submission.filings_table(parsed)
    return {"filings": filings.drop("record"), **submission.children(filings), "errors": submission.errors(parsed)}


def text_products(files: DataFrame, universe: DataFrame, weights: dict[str, float] | None = None, at_least: int = 1000, cap: int = 5, seed: int = 42) -> dict[str, DataFrame]:
    """Cleaned documents, sections, coverage, quality, the balanced set and chunks of it."""
    docs = stored(submission.text_record(files, universe))
    kept = docs.filter("status = 'ok' AND is_company_in_universe = 1")
    cut = stored(sections.extract_sections(kept, ["doc_id", "year", "form_type"], text="clean_text"))
    years = kept.groupBy("year").agg(F.count("*").alias("doc_count"))
    usable = years.filter(F.col("doc_count") >= at_least)
    targets = usable.select("year", F.min("doc_count").over(Window.partitionBy()).alias("target"))  # one row per year
    balanced = stored(quota.balanced(kept.drop("clean_text"), targets, weights or quota.parse_weights(None), cap, seed))
    return {
        "docs": docs, "sections": cut, "coverage": relational.coverage(kept), "section_coverage": cut.groupBy("year", "form_type", "section_name").agg(F.count("*").alias("section_count")),
        "length_stats": relational.length_stats(kept, "form_type", "clean_text_words"), "duplicates": relational.duplicate_keys(kept), "presence": relational.presence_histogram(cut),
        "balanced": balanced, "chunks": sections.route(sections.document_chunks(kept, ["doc_id"], text="clean_text"), balanced),
    }
