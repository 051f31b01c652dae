"""Queries of the general data problems: history (p1), wide table (p2), timestamps (p3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.codes import PLACEHOLDERS, STATES, bracket_code, plain_cik, real_text, squeezed, state_code, year_end
from tessera.functions.timeparse import normal_date
from tessera.operators.history import CHANGE_COLUMNS, HistoryStore
from tessera.operators.timestamps import normal_values
from tessera.operators.wide import to_wide, wanted_columns, wide_cells
from tessera.plans import time_sql
from tessera.session import shared_dir, stored, table

#: A filing processed more days after its filing date than this arrives as a late update of the history.
LATE_DAYS = 90


def company_changes(company_data: DataFrame, filings: DataFrame, former_names: DataFrame) -> DataFrame:
    """Raw changes of sic, state_of_incorporation, fiscal_year_end and conformed_name, with ``late``.

    Snapshots are dated by the filing (filings not in ``filings`` or without date give none); former names by their own
    date. Both are late with the filing that tells them. Values are compared by meaning; placeholders and unreadable values are passed
    over. All joins are on filing_id, which no filer shares, so a large filer is spread.
    """
    dated = (
        filings.filter("filing_id IS NOT NULL").select("filing_id", normal_date(F.col("filed_as_of_date")).alias("at"), F.to_date("processed_at_utc").alias("arrived"))
        .groupBy("filing_id").agg(F.max("at").alias("at"), F.min("arrived").alias("arrived"))
        .select("filing_id", "at", F.coalesce(F.datediff("arrived", "at") > LATE_DAYS, F.lit(False)).alias("late"))
    )
    values = {
        "sic": bracket_code(F.col("sic")),
        "state_of_incorporation": state_code(F.col("state_of_incorporation")),
        "fiscal_year_end": year_end(F.col("fiscal_year_end")),
        "conformed_name": squeezed(F.upper(real_text(F.col("conformed_name")))),
    }
    said = (
        company_data.filter("filing_id IS NOT NULL").select("filing_id", plain_cik(F.col("cik")).alias("entity"), *(v.alias(k) for k, v in values.items()))
        .groupBy("filing_id").agg(F.max("entity").alias("entity"), *(F.max(k).alias(k) for k in values))
        .filter("entity IS NOT NULL")
    )
    told = said.join(dated, "filing_id", "left").withColumn("late", F.coalesce("late", F.lit(False)))
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("attribute"), F.col(k).alias("value")) for k in values)))
    snapshots = (
        told.filter("at IS NOT NULL").select("entity", "at", F.col("filing_id").alias("source"), pairs.alias("p"), "late").filter("p.value IS NOT NULL")
        .select("entity", "p.attribute", "at", "source", "p.value", F.when(F.col("p.attribute") != "conformed_name", F.lit(False)).alias("ends"), "late")
    )
    names = (
        former_names.filter("filing_id IS NOT NULL").select("filing_id", normal_date(F.col("date_of_name_change")).alias("day"), F.coalesce(squeezed(F.upper(F.col("former_name"))), F.lit("")).alias("value"))
        .filter("day IS NOT NULL").distinct().join(told.select("filing_id", "entity", "late"), "filing_id")
        .select("entity", F.lit("conformed_name").alias("attribute"), F.col("day").alias("at"), F.col("filing_id").alias("source"), "value", F.lit(True).alias("ends"), "late")
    )
    return snapshots.unionByName(names)


def company_history(spark: SparkSession, d: str) -> DataFrame:
    """Chains after a first load of what came in time and a batch of what came late, through the store."""
    changes = stored(company_changes(table(spark, d, "company_data"), table(spark, d, "filings"), table(spark, d, "former_names")))
    store = HistoryStore(spark, shared_dir(spark))
    store.apply(changes.filter("NOT late"))
    store.apply(changes.filter("late"))
    return store.chains()


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    starts = company_history(spark, d).filter("version > 1")
    return starts.select(F.col("entity").alias("cik"), "attribute", F.col("valid_from").cast("string").alias("valid_from")).distinct()


def p1_history(spark: SparkSession, d: str) -> DataFrame:
    shown = F.when(F.col("attribute") == "sic", F.when(F.length("value") < 4, F.lpad("value", 4, "0")).otherwise(F.col("value"))).otherwise(F.nullif("value", F.lit("")))
    return company_history(spark, d).select(F.col("entity").alias("cik"), "attribute", "version", "valid_from", "valid_to", shown.alias("value"))


def p2_wide(spark: SparkSession, d: str) -> DataFrame:
    return to_wide(table(spark, d, "header_fields"), table(spark, d, "wide_columns"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return wide_cells(p2_wide(spark, d), [c for c, _ in wanted_columns(table(spark, d, "wide_columns"))])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return normal_values(table(spark, d, "filings"), "filing_id", "processed_at_utc", ["acceptance_datetime"], ["filed_as_of_date", "period_of_report"])


_SPACES = "trim(regexp_replace(field_value, '\\s+', ' ', 'g'))"
_KEY = "regexp_replace(lower({}), '[^a-z0-9]+', '', 'g')"

_CELLS = f"""h AS (SELECT filing_id, {_KEY.format('section')} AS s, {_KEY.format('field_name')} AS f, occurrence, {_SPACES} AS v FROM header_fields WHERE filing_id IS NOT NULL AND regexp_matches({_SPACES}, '[A-Za-z0-9]')
      AND upper({_SPACES}) NOT IN ('N/A', 'NA', 'NONE', 'NULL', 'NIL', 'UNKNOWN', 'TBD', 'PENDING', 'VARIOUS', 'SOON', 'SEE NOTE', 'SEE HEADER', 'NOT AVAILABLE', 'NOT APPLICABLE')),
      w AS (SELECT {_KEY.format('section')} AS s, {_KEY.format('field_name')} AS f, column_name, data_type FROM wide_columns),
      c AS (SELECT filing_id, column_name, occurrence, CASE data_type WHEN 'string' THEN v
        WHEN 'bigint' THEN CASE WHEN regexp_matches(v, '^[0-9,]+$') THEN try_cast(replace(v, ',', '') AS BIGINT)::VARCHAR END
        WHEN 'date' THEN strftime(coalesce(try_strptime(v, '%Y%m%d'), try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%m/%d/%Y')), '%Y-%m-%d')
        WHEN 'code' THEN nullif(ltrim(coalesce(nullif(regexp_extract(v, '\\[ *([0-9]+) *\\]', 1), ''), regexp_extract(v, '^([0-9]+)$', 1)), '0'), '')
        WHEN 'digits' THEN CASE WHEN regexp_matches(v, '^[0-9 ./-]+$') THEN regexp_replace(v, '[^0-9]', '', 'g') END END AS cell_value FROM h JOIN w USING (s, f)),
      cells AS (SELECT filing_id, column_name, arg_min(cell_value, (coalesce(occurrence, 9223372036854775807), cell_value)) AS cell_value FROM c WHERE cell_value IS NOT NULL GROUP BY 1, 2)"""
# The columns of the wide table and how SQL types them.
_WIDE = [
    *((c, "VARCHAR") for c in (
        "accession_number", "business_city", "business_state", "business_zip", "company_name", "file_number", "fiscal_year_end", "inc_state", "industry_code", "irs_number",
        "mail_city", "mail_state", "mail_zip", "submission_type", "values_form",
    )),
    *((c, "BIGINT") for c in ("company_cik", "document_count", "film_number")), *((c, "DATE") for c in ("changed_on", "filed_on", "period_of_report")),
]

SQL = {
    "p1_found": time_sql.p1(STATES, PLACEHOLDERS),
    "p1_history": time_sql.p1_history(STATES, PLACEHOLDERS),
    "p3_found": time_sql.P3,
    "p2_found": f"WITH {_CELLS} SELECT filing_id, column_name, cell_value FROM cells",
    # Below RANGE_BYTES there is one range, whose entities stand in order.
    "p2_wide": f"""WITH {_CELLS}, ids AS (SELECT filing_id, row_number() OVER (ORDER BY filing_id) - 1 AS entity_ordinal FROM (SELECT DISTINCT filing_id FROM header_fields WHERE filing_id IS NOT NULL))
      SELECT entity_ordinal, filing_id, {", ".join(f"max(CASE WHEN column_name = '{c}' THEN cell_value END)::{t} AS {c}" for c, t in _WIDE)} FROM ids LEFT JOIN cells USING (filing_id) GROUP BY 1, 2""",
}

QUERIES = {"p1_found": p1_found, "p1_history": p1_history, "p2_found": p2_found, "p2_wide": p2_wide, "p3_found": p3_found}
