"""Queries of the filing pipeline's own operators over the test tables, with the SQL that tells their results.

Roles of the tables: ``filings`` is the manifest and the document inventory, ``company_data`` the company universe,
``documents`` the texts, ``events`` the download log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import scalars as S
from tessera.functions.codes import year_end
from tessera.operators import quota as Q
from tessera.operators import relational as R
from tessera.operators import sections as X
from tessera.operators import submission as P
from tessera.operators.upsert import upsert_latest
from tessera.plans import section_sql
from tessera.plans.time_sql import month_day
from tessera.session import spread, table
from tessera.sources import readers

FORMS = list(S.FORM_ORDER)
SEED = 42
CORE = "('10-K', '10-Q', '8-K', 'DEF 14A')"

# ---- SQL of the scalar functions


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _form(x: str) -> str:
    return f"upper({_strip(f'coalesce({x}, chr(32))')})"


def _loose(x: str) -> str:
    s = _strip(f"coalesce({x}, '')")
    return f"CASE WHEN regexp_matches({s}, '^[0-9]+$') THEN coalesce(nullif(ltrim({s}, '0'), ''), '0') ELSE {s} END"


def _any(x: str) -> str:
    return f"ltrim({_strip(f'coalesce({x}, chr(32))')}, '0')"


def _iso(x: str) -> str:
    s = _strip(x)
    return f"CASE WHEN regexp_matches({s}, '^[0-9]{{8}}$') THEN substr({s},1,4)||'-'||substr({s},5,2)||'-'||substr({s},7,2) ELSE {x} END"


_DOCS = f"""docs AS (SELECT filing_id AS doc_id, split_part(source_relpath, '/', 2) AS year, {_form('form_type')} AS form_type, {_any('cik')} AS cik,
  coalesce(accession_number, '') AS accession, source_size_bytes FROM filings WHERE source_relpath IS NOT NULL)"""
#: The universe of these queries: the companies whose fiscal year, however written, is the calendar year.
_UNIVERSE = f"universe AS (SELECT DISTINCT {_any('cik')} AS cik FROM company_data WHERE {month_day('fiscal_year_end')} = '1231' AND {_any('cik')} <> '')"


def manifest(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    return f.select("filing_id", "cik", "company_name", "form_type", S.iso_date(F.col("filed_as_of_date")).alias("date_filed"), F.col("source_relpath").alias("output_path"))


def universe(spark: SparkSession, d: str) -> DataFrame:
    """The companies whose fiscal year is the calendar year."""
    return R.universe(table(spark, d, "company_data").filter(year_end(F.col("fiscal_year_end")) == "1231").select("cik"))


def docs(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").filter("source_relpath IS NOT NULL")
    return f.select(
        F.col("filing_id").alias("doc_id"), S.year_and_folder(F.col("source_relpath"))["year"].alias("year"), S.form_key(F.col("form_type")).alias("form_type"), S.cik_any(F.col("cik")).alias("cik"),
        F.coalesce("accession_number", F.lit("")).alias("accession"), "source_size_bytes",
    )


def texts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Documents for work that is heavy per text."""
    return spread(table(spark, d, "documents").select("doc_id", "text", *columns))


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- filters and memberships


@query(f"SELECT {_form('form_type')} AS form_type, count(*) AS n FROM filings WHERE {_form('form_type')} IN {CORE} GROUP BY 1")
def manifest_form_filter(spark, d):
    return manifest(spark, d).filter(R.wanted_form(F.col("form_type"), FORMS)).groupBy(S.form_key(F.col("form_type")).alias("form_type")).agg(F.count("*").alias("n"))


@query(f"SELECT filing_id, form_type FROM filings WHERE {_form('form_type')} IN {CORE} OR {_form('form_type')} LIKE '424B%'")
def manifest_form_or_prefix(spark, d):
    return manifest(spark, d).filter(R.wanted_form(F.col("form_type"), FORMS, ("424B",))).select("filing_id", "form_type")


@query(f"WITH {_UNIVERSE} SELECT filing_id, {_loose('cik')} AS cik FROM filings WHERE {_loose('cik')} IN (SELECT cik FROM universe)")
def manifest_in_universe(spark, d):
    return manifest(spark, d).withColumn("cik", S.cik_loose(F.col("cik"))).join(universe(spark, d), "cik", "left_semi").select("filing_id", "cik")


@query(f"WITH {_UNIVERSE} SELECT filing_id, {_loose('cik')} AS cik FROM filings WHERE {_loose('cik')} NOT IN (SELECT cik FROM universe)")
def manifest_outside_universe(spark, d):
    return R.pending(manifest(spark, d).withColumn("cik", S.cik_loose(F.col("cik"))), universe(spark, d), ["cik"]).select("filing_id", "cik")


@query(f"""WITH {_UNIVERSE} SELECT CASE WHEN {_form('form_type')} NOT IN {CORE} THEN 'form' WHEN {_loose('cik')} NOT IN (SELECT cik FROM universe) THEN 'cik' ELSE 'kept' END AS reason,
  count(*) AS n FROM filings GROUP BY 1""")
def manifest_reason_counts(spark, d):
    return R.reason_counts(R.manifest_reasons(manifest(spark, d), universe(spark, d), FORMS))


@query(f"""WITH {_UNIVERSE} SELECT CASE WHEN {_form('form_type')} NOT IN {CORE} THEN 'form'
  WHEN NOT coalesce(try_cast(substr({_strip(_iso('filed_as_of_date'))}, 1, 4) AS INTEGER) BETWEEN 2005 AND 2015, false) THEN 'year'
  WHEN {_loose('cik')} NOT IN (SELECT cik FROM universe) THEN 'cik' ELSE 'kept' END AS reason, count(*) AS n FROM filings GROUP BY 1""")
def manifest_reason_counts_with_years(spark, d):
    return R.reason_counts(R.manifest_reasons(manifest(spark, d), universe(spark, d), FORMS, (2005, 2015)))


@query(f"""SELECT DISTINCT cik, CASE WHEN length(cik) < 10 THEN lpad(cik, 10, '0') ELSE cik END AS padded_cik FROM
  (SELECT {_any('cik')} AS cik FROM filings UNION ALL SELECT {_any('cik')} FROM company_data) WHERE cik <> ''""")
def universe_union(spark, d):
    u = R.universe(table(spark, d, "filings").select("cik"), table(spark, d, "company_data").select("cik"))
    return u.select("cik", S.padded_cik(F.col("cik")).alias("padded_cik"))


@query(f"""WITH {_UNIVERSE} SELECT doc_id, CASE WHEN {_any('cik')} IN (SELECT cik FROM universe) THEN 1 ELSE 0 END AS in_universe FROM documents""")
def documents_universe_flag(spark, d):
    return R.in_universe(table(spark, d, "documents"), universe(spark, d), S.cik_any(F.col("cik"))).select("doc_id", "in_universe")


# ---- aggregates


@query(f"""WITH {_DOCS} SELECT CASE WHEN grouping(form_type) = 0 THEN 'year_form' WHEN grouping(cik) = 0 THEN 'year_company' ELSE 'year' END AS level, year, form_type, cik, count(*) AS doc_count
  FROM docs GROUP BY GROUPING SETS ((year), (year, form_type), (year, cik))""")
def coverage(spark, d):
    return R.coverage(docs(spark, d))


@query(f"WITH {_DOCS} SELECT cik, accession, count(*) AS n FROM docs WHERE accession <> '' GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_accessions(spark, d):
    return R.duplicate_keys(docs(spark, d))


@query(f"""SELECT form_type, count(*) AS docs, avg(n) AS avg_size, list_sort(list(n))[(count(*) // 2 + 1)::BIGINT] AS median_size FROM
  (SELECT {_form('document_type')} AS form_type, len(regexp_extract_all(coalesce(text, ''), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}\\p{{Pc}}\\x{{200c}}\\x{{200d}}]+'))::BIGINT AS n FROM documents) GROUP BY 1""")
def length_stats(spark, d):
    return R.length_stats(texts(spark, d, "document_type").select(S.form_key(F.col("document_type")).alias("form_type"), S.count_words(F.col("text")).alias("n_words")))


def _year_counts(spark, d) -> DataFrame:
    return docs(spark, d).groupBy("year").agg(F.count("*").alias("doc_count"))


@query(f"WITH {_DOCS}, c AS (SELECT year, count(*) AS doc_count FROM docs GROUP BY 1) SELECT year, doc_count, doc_count AS target_per_year FROM c WHERE doc_count >= 10 ORDER BY doc_count, year LIMIT 1")
def weakest_year(spark, d):
    return R.weakest_year(_year_counts(spark, d), 10)


@query(f"""WITH {_DOCS}, c AS (SELECT year, count(*) AS doc_count FROM docs GROUP BY 1), t AS (SELECT floor(avg(doc_count))::BIGINT AS target FROM c)
  SELECT year, doc_count, target - doc_count AS deficit FROM c, t WHERE doc_count < target""")
def weak_years(spark, d):
    counts = _year_counts(spark, d)
    return R.weak_years(counts, counts.agg(F.floor(F.avg("doc_count")).alias("target")))


def _files(spark, d) -> DataFrame:
    """The inventory as a purge sees it: names start with the company number for nine of ten files."""
    f = table(spark, d, "filings").filter("source_relpath IS NOT NULL")
    number = F.regexp_extract("cik", "([0-9]{1,10})", 1)
    name = F.when(F.coalesce(number, F.lit("")) != "", F.concat(number, F.lit("__x.txt"))).otherwise("x.txt")
    return f.select(S.year_and_folder(F.col("source_relpath"))["year"].alias("year"), name.alias("file_name"), F.col("source_size_bytes").alias("size_bytes"))


@query(f"""WITH {_UNIVERSE}, f AS (SELECT split_part(source_relpath, '/', 2) AS year, regexp_extract(coalesce(cik, ''), '([0-9]{{1,10}})', 1) AS n, source_size_bytes AS b FROM filings WHERE source_relpath IS NOT NULL),
  c AS (SELECT year, b, CASE WHEN n = '' THEN 'unclassified' WHEN coalesce(nullif(ltrim(n, '0'), ''), '0') IN (SELECT cik FROM universe) THEN 'allowed' ELSE 'undesired' END AS k FROM f)
  SELECT year, count(*) AS filing_files_scanned, count(*) FILTER (k = 'allowed') AS allowed_cik_files, count(*) FILTER (k = 'unclassified') AS unclassified_files_left_untouched,
  count(*) FILTER (k = 'undesired') AS undesired_files, coalesce(sum(b) FILTER (k = 'undesired'), 0)::BIGINT AS undesired_bytes, 0::BIGINT AS deleted_files, 0::BIGINT AS deleted_bytes, 0::BIGINT AS delete_failures FROM c GROUP BY ROLLUP (year)""")
def purge_report(spark, d):
    return R.purge_report(R.purge_candidates(_files(spark, d), universe(spark, d)))


# ---- download log

_STATUS = "CASE event_id % 7 WHEN 0 THEN '404' WHEN 1 THEN '410' WHEN 2 THEN 'failed' ELSE 'downloaded' END"


def _log(spark, d) -> DataFrame:
    k = F.col("event_id") % 7
    status = F.when(k == 0, "404").when(k == 1, "410").when(k == 2, "failed").otherwise("downloaded")
    return table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("filing_url"), status.alias("status"))


@query(f"SELECT DISTINCT 'u' || user_id AS filing_url FROM events WHERE {_STATUS} IN ('404', '410')")
def permanent_failures(spark, d):
    return R.permanent_failures(_log(spark, d))


@query(f"""WITH gone AS (SELECT DISTINCT 'u' || user_id AS u FROM events WHERE {_STATUS} IN ('404', '410')), m AS (SELECT 'u' || o_custkey AS u, 'p' || o_orderkey AS p FROM orders),
  x AS (SELECT 'p' || l_orderkey AS p, max(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_partkey END)::BIGINT AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
  s AS (SELECT CASE WHEN m.u IN (SELECT u FROM gone) THEN 'permanent' WHEN b > 0 THEN 'existing' WHEN b = 0 THEN 'zero_byte' ELSE 'pending' END AS state, b FROM m LEFT JOIN x USING (p))
  SELECT count(*) AS total_rows, count(*) FILTER (state = 'existing') AS skip_existing, count(*) FILTER (state = 'permanent') AS skip_permanent, count(*) FILTER (state IN ('pending', 'zero_byte')) AS pending,
  count(*) FILTER (state = 'zero_byte') AS zero_byte_existing, floor(avg(b) FILTER (state = 'existing') * count(*) FILTER (state IN ('pending', 'zero_byte')))::BIGINT AS estimated_required_bytes FROM s""")
def download_prescan(spark, d):
    m = table(spark, d, "orders").select(F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("filing_url"), F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("output_path"))
    there = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.concat(F.lit("p"), F.col("l_orderkey").cast("string")).alias("output_path"), F.when(F.col("l_linenumber") == 1, 0).otherwise(F.col("l_partkey")).alias("size_bytes"))
    return R.prescan_summary(R.prescan(m, R.permanent_failures(_log(spark, d)), there))


@query("SELECT event_type, count(*) AS n, sum((props->>'$.k')::BIGINT)::BIGINT AS k_sum FROM events GROUP BY 1")
def event_records(spark, d):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k_sum"))


# ---- scalars


@query(f"""SELECT filing_id, sha256(coalesce(source_relpath, '') || '|' || coalesce(accession_number, '') || '|' || coalesce(nullif({_any('cik')}, ''), '')) AS durable_id,
  coalesce(nullif(regexp_replace(substr(regexp_replace(coalesce(company_name, ''), '[^A-Za-z0-9._-]+', '_', 'g'), 1, 200), '^_+|_+$', '', 'g'), ''), 'unknown') AS file_name,
  regexp_replace(regexp_replace(source_relpath, '^.*/', ''), '\\.txt$', '') AS accession, {_iso('filed_as_of_date')} AS filed FROM filings""")
def filing_scalars(spark, d):
    cik = S.cik_or_null(F.col("cik"))
    return table(spark, d, "filings").select(
        "filing_id", S.filing_id(F.col("source_relpath"), F.col("accession_number"), cik).alias("durable_id"), S.sanitize_filename(F.col("company_name")).alias("file_name"),
        S.accession_of(F.col("source_relpath")).alias("accession"), S.iso_date(F.col("filed_as_of_date")).alias("filed"),
    )


@query("""SELECT o_orderkey, 'raw/' || strftime(o_orderdate, '%Y') || '/' || regexp_replace(regexp_replace(o_orderpriority, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') || '/' || lpad(o_custkey::VARCHAR, 10, '0') || '__' ||
  strftime(o_orderdate, '%Y-%m-%d') || '__' || o_orderkey || '__Customer_' || o_custkey || '.txt' AS output_path FROM orders""")
def output_paths(spark, d):
    o = table(spark, d, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return o.select("o_orderkey", S.filing_path(F.col("o_orderpriority"), cust, F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("edgar/data/"), key, F.lit(".txt")), F.concat(F.lit("Customer #"), cust)).alias("output_path"))


_PARTS = "list_filter(string_split(p, '/'), lambda x: x NOT IN ('', '.'))"


@query(f"""WITH t AS (SELECT doc_id, {_strip("regexp_replace(coalesce(relative_path, ''), '\\\\', '/', 'g')")} AS p FROM documents), x AS (SELECT doc_id, p, {_PARTS} AS l FROM t),
  y AS (SELECT *, CASE WHEN lower(l[1]) = 'raw' THEN l[2:] ELSE l END AS i FROM x)
  SELECT doc_id, CASE WHEN e IS NULL THEN array_to_string(i, '/') END AS path, e AS error FROM (SELECT *, CASE WHEN p = '' THEN 'empty' WHEN starts_with(p, '/') THEN 'absolute' WHEN list_contains(l, '..') THEN 'unsafe'
    WHEN contains(l[1], ':') THEN 'drive' WHEN len(i) < 3 THEN 'structure' END AS e FROM y)""")
def document_paths(spark, d):
    place = S.path_parts(F.col("relative_path"))
    return table(spark, d, "documents").select("doc_id", F.array_join(place["parts"], "/").alias("path"), place["error"].alias("error"))


@query("""SELECT y::INTEGER AS year, q::INTEGER AS quarter, 'https://www.sec.gov/Archives/edgar/full-index/' || y || '/QTR' || q || '/master.idx' AS url, 'index/' || y || '/QTR' || q || '/master.idx' AS local_path
  FROM range(1993, 2025) t(y), range(1, 5) u(q) WHERE y < 2024 OR q <= 2""")
def index_quarters(spark, d):
    return readers.quarters(spark, 1993, 2024, (2024, 2))


# ---- texts

_WORD = "'[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}\\x{200c}\\x{200d}]+'"
_SPACE = "'[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'"


@query(f"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS n_words FROM documents")
def word_counts(spark, d):
    return texts(spark, d).select("doc_id", S.count_words(F.col("text")).alias("n_words"))


@query("SELECT doc_id, len(regexp_extract_all(lower(coalesce(text, '')), '\\bitem\\s+[0-9]{1,2}[a-z]?(\\.[0-9]{2})?\\b'))::BIGINT AS hints FROM documents")
def section_hints(spark, d):
    return texts(spark, d).select("doc_id", S.section_hints(F.col("text")).alias("hints"))


_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {_SPACE}), lambda w: w <> '')"


@query(f"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, len(w), 300)) AS k FROM w), c AS (SELECT doc_id, k, w[k + 1:k + 350] AS c FROM s WHERE len(w) > 0)
  SELECT doc_id, (k // 300)::INTEGER AS chunk_index, len(c)::BIGINT AS word_count, md5(array_to_string(c, ' ')) AS chunk_md5 FROM c WHERE len(c) >= 116""")
def word_chunks(spark, d):
    cut = texts(spark, d).select("doc_id", F.posexplode(X.chunk_words(F.col("text"))).alias("chunk_index", "c"))
    return cut.select("doc_id", "chunk_index", "c.word_count", F.md5("c.chunk_text").alias("chunk_md5"))


def _sections(spark, d) -> DataFrame:
    t = texts(spark, d, "document_type").withColumn("form_type", S.form_key(F.col("document_type")))
    return X.extract_sections(t, ["doc_id", "form_type"])


@query(f"{section_sql.SECTIONS} SELECT doc_id, form_type, section_name, section_rank::INTEGER AS section_rank, source_mode, length(s)::INTEGER AS n_chars, md5(s) AS section_md5 FROM a")
def sections(spark, d):
    s = _sections(spark, d)
    return s.select("doc_id", "form_type", "section_name", "section_rank", "source_mode", F.length("section_text").alias("n_chars"), F.md5("section_text").alias("section_md5"))


@query(f"{section_sql.SECTIONS} SELECT form_type, section_name, count(*) AS section_count FROM a GROUP BY 1, 2")
def section_coverage(spark, d):
    return _sections(spark, d).groupBy("form_type", "section_name").agg(F.count("*").alias("section_count"))


@query(f"{section_sql.SECTIONS}, c AS (SELECT doc_id, count(DISTINCT section_name) AS n_sections FROM a GROUP BY 1) SELECT n_sections, count(*) AS doc_count FROM c GROUP BY 1")
def section_presence(spark, d):
    return R.presence_histogram(_sections(spark, d))


_PRIORITY = " ".join(f"WHEN '{n}' THEN {p}" for n, p in X.SECTION_PRIORITY.items())


@query(f"""{section_sql.SECTIONS}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE section_name {_PRIORITY} ELSE {X.OTHER_PRIORITY} END, section_rank) AS k FROM a),
  b AS (SELECT *, max(length(s) >= 500) OVER (PARTITION BY doc_id) AS ok FROM o WHERE k <= 3), w AS (SELECT doc_id, section_name, k, list_filter(regexp_split_to_array(s, {_SPACE}), lambda v: v <> '') AS w FROM b WHERE length(s) >= 500 OR (NOT ok AND k = 1)),
  i AS (SELECT *, unnest(range(0, len(w), 300)) AS j FROM w WHERE len(w) > 0), c AS (SELECT doc_id, section_name, k, j, w[j + 1:j + 350] AS c FROM i)
  SELECT doc_id, section_name AS source_name, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) - 1 AS chunk_index, len(c)::BIGINT AS word_count, md5(array_to_string(c, ' ')) AS chunk_md5 FROM c WHERE len(c) >= 116""")
def section_chunks(spark, d):
    t = texts(spark, d, "document_type").withColumn("form_type", S.form_key(F.col("document_type")))
    return X.document_chunks(t, ["doc_id"]).select("doc_id", "source_name", "chunk_index", "word_count", F.md5("chunk_text").alias("chunk_md5"))


@query(f"""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\\n{{2,}}'), lambda p: regexp_replace(p, '^' || {_SPACE} || '|' || {_SPACE} || '$', '', 'g')), lambda p: length(p) >= 250)[1:20] AS ps FROM documents)
  SELECT doc_id, length(array_to_string(ps, chr(10) || chr(10)))::INTEGER AS n_chars, md5(array_to_string(ps, chr(10) || chr(10))) AS section_md5 FROM p WHERE len(ps) > 0""")
def fallback_sections(spark, d):
    s = texts(spark, d).select("doc_id", F.explode(X.fallback_section(F.coalesce("text", F.lit("")))).alias("s"))
    return s.select("doc_id", F.length("s.text").alias("n_chars"), F.md5("s.text").alias("section_md5"))


# ---- sampling


def _quota_docs(spark, d) -> DataFrame:
    """One row per filing; its repeated rows may lack the company, never the year or the form."""
    q = docs(spark, d).filter(F.col("form_type").isin(*FORMS))
    return q.groupBy("doc_id").agg(F.max("year").alias("year"), F.max("form_type").alias("form_type"), F.max("cik").alias("cik"))


_TARGET = "(SELECT (count(DISTINCT doc_id) // 40)::BIGINT AS target FROM docs WHERE form_type IN " + CORE + ")"
_QDOCS = f"{_DOCS}, qd AS (SELECT doc_id, any_value(year) AS year, any_value(form_type) AS form_type, max(cik) AS cik FROM docs WHERE form_type IN {CORE} GROUP BY 1)"


def _targets(spark, d) -> DataFrame:
    q = _quota_docs(spark, d)
    return q.select("year").distinct().withColumn("target", q.agg(F.floor(F.count("*") / 40)).scalar())


_ALLOCATION = f"""{_QDOCS}, w(form_type, weight, ord) AS (VALUES ('10-K', 0.3, 0), ('10-Q', 0.3, 1), ('8-K', 0.3, 2), ('DEF 14A', 0.1, 3)), t AS {_TARGET},
  a AS (SELECT year, form_type, count(*) AS available FROM qd GROUP BY 1, 2), f AS (SELECT a.*, weight, ord, target, least(round_even(target * weight, 0)::BIGINT, available) AS take FROM a JOIN w USING (form_type), t),
  m AS (SELECT *, greatest(target - sum(take) OVER (PARTITION BY year), 0) AS missing FROM f), s AS (SELECT *, unnest(range(1, available - take + 1)) AS k FROM m WHERE available > take),
  r AS (SELECT year, form_type, row_number() OVER (PARTITION BY year ORDER BY k, weight DESC, available DESC, ord) AS n, missing FROM s), x AS (SELECT year, form_type, count(*) AS extra FROM r WHERE n <= missing GROUP BY 1, 2),
  quotas AS (SELECT year, target, form_type, available, (take + coalesce(extra, 0))::BIGINT AS quota FROM m LEFT JOIN x USING (year, form_type))"""


@query(f"WITH {_ALLOCATION} SELECT * FROM quotas")
def form_allocation(spark, d):
    have = _quota_docs(spark, d).groupBy("year", "form_type").agg(F.count("*").alias("available"))
    return Q.allocate(have.join(_targets(spark, d), "year"), Q.parse_weights(None))


@query(f"""WITH {_QDOCS} SELECT doc_id, year, form_type, cik FROM qd QUALIFY row_number() OVER (PARTITION BY year, form_type, cik ORDER BY md5('{SEED}|' || doc_id), doc_id) <= 5""")
def company_cap(spark, d):
    ids = docs(spark, d).filter(F.col("form_type").isin(*FORMS)).groupBy("doc_id").agg(F.min("year").alias("year"), F.min("form_type").alias("form_type"), F.max("cik").alias("cik"))
    return Q.cap_per_company(ids, 5, SEED)


@query(f"""WITH {_QDOCS} SELECT doc_id, year, form_type FROM qd QUALIFY row_number() OVER (PARTITION BY year, form_type ORDER BY md5('{SEED}|' || doc_id), doc_id) <= 7""")
def quota_sample(spark, d):
    q = _quota_docs(spark, d).select("doc_id", "year", "form_type")
    return Q.draw(q, q.select("year", "form_type").distinct().withColumn("quota", F.lit(7)), SEED)


@query(f"""WITH {_QDOCS}, k AS (SELECT *, row_number() OVER (PARTITION BY year, cik ORDER BY md5('{SEED}|' || doc_id), doc_id) AS turn FROM qd)
  SELECT doc_id, year, cik, turn FROM k QUALIFY row_number() OVER (PARTITION BY year ORDER BY turn, md5('{SEED}|' || cik), cik) <= 30""")
def round_robin(spark, d):
    ids = docs(spark, d).filter(F.col("form_type").isin(*FORMS)).groupBy("doc_id").agg(F.min("year").alias("year"), F.max("cik").alias("cik"))
    return Q.round_robin(ids, ids.select("year").distinct().withColumn("quota", F.lit(30)), ["year"], SEED, "doc_id").select("doc_id", "year", "cik", "turn")


@query(f"""WITH {_ALLOCATION}, c AS (SELECT * FROM qd QUALIFY row_number() OVER (PARTITION BY year, form_type, cik ORDER BY md5('{SEED}|' || doc_id), doc_id) <= 5),
  n AS (SELECT *, row_number() OVER (PARTITION BY year, form_type ORDER BY md5('{SEED + 1}|' || doc_id), doc_id) AS n FROM c) SELECT doc_id, year, form_type, cik FROM n JOIN quotas USING (year, form_type) WHERE n <= quota""")
def balanced_set(spark, d):
    return Q.balanced(_quota_docs(spark, d), _targets(spark, d), Q.parse_weights(None), 5, SEED).select("doc_id", "year", "form_type", "cik")


# ---- state


@query("SELECT sha256, doc_id, filename FROM documents WHERE coalesce(trim(sha256), '') <> '' QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY doc_id) = 1")
def first_of_equal_texts(spark, d):
    return R.first_by(table(spark, d, "documents").select("sha256", "doc_id", "filename"), "sha256", ["doc_id"])


@query("""SELECT source_relpath, arg_min(filing_id, (processed_at_utc, filing_id)) AS filing_id, epoch_us(max(processed_at_utc)) AS processed_us FROM filings WHERE source_relpath IS NOT NULL AND processed_at_utc IS NOT NULL GROUP BY 1""")
def upsert_state(spark, d):
    return upsert_latest(table(spark, d, "filings").filter("processed_at_utc IS NOT NULL").select("source_relpath", "filing_id", "processed_at_utc")).select("source_relpath", "filing_id", F.unix_micros("processed_at_utc").alias("processed_us"))


@query("SELECT doc_id FROM documents WHERE filing_id NOT IN (SELECT filing_id FROM filings WHERE filing_id IS NOT NULL)")
def documents_not_arrived(spark, d):
    return R.pending(table(spark, d, "documents").filter("filing_id IS NOT NULL"), table(spark, d, "filings").select("filing_id"), ["filing_id"]).select("doc_id")


@query("""SELECT filing_id, source_size_bytes FROM (SELECT DISTINCT filing_id, source_relpath, source_size_bytes FROM filings) WHERE source_relpath IS NOT NULL AND source_size_bytes IS NOT NULL AND source_size_bytes % 10 = 0""")
def changed_files(spark, d):
    files = table(spark, d, "filings").select("filing_id", "source_relpath", "source_size_bytes").distinct().filter("source_relpath IS NOT NULL AND source_size_bytes IS NOT NULL").withColumn("source_mtime_ns", F.lit(1))
    known = files.select("source_relpath", F.when(F.col("source_size_bytes") % 10 == 0, -1).otherwise(F.col("source_size_bytes")).alias("source_size_bytes"), "source_mtime_ns")
    return R.needs_work(files, known).select("filing_id", "source_size_bytes")
