"""Queries over submissions and what the text pipeline makes of them. The submissions are put together of the documents, one each, so that
their tables and texts are known to SQL."""

from __future__ import annotations

import binascii
import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import scalars as S
from tessera.operators import quota as Q
from tessera.operators import relational as R
from tessera.operators import sections as X
from tessera.operators import submission as P
from tessera.plans import pipeline, section_sql
from tessera.plans.files import local
from tessera.plans.reference import _DOCS, _PRIORITY, _QDOCS, _SPACE, _UNIVERSE, _WORD, CORE, FORMS, SEED, _any, _form, _quota_docs, _strip, docs, universe
from tessera.plans.register import registry
from tessera.session import spread, table
from tessera.sources import readers, writers

QUERIES, SQL, query = registry()


# ---- submissions: a text, an archive, an encoded text and, for some, a document without a body


@F.arrow_udf(T.BinaryType())
def _uu(bodies: pa.Array) -> pa.Array:
    coded = lambda b: b"begin 644 x\n" + b"".join(binascii.b2a_uu(b[k : k + 45]) for k in range(0, len(b), 45)) + b"`\nend\n"
    return pa.array([coded(b or b"") for b in bodies.to_pylist()], pa.binary())


@F.arrow_udf(T.BinaryType())
def _zip(texts: pa.Array, names: pa.Array, safe: pa.Array) -> pa.Array:
    def packed(text: str | None, name: str, fine: bool) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("a/text.txt" if fine else "../x", text or "")
            z.writestr("N.txt", name)
        return out.getvalue()

    return pa.array([packed(*x) for x in zip(texts.to_pylist(), names.to_pylist(), safe.to_pylist())], pa.binary())


def _submissions(spark: SparkSession, d: str) -> DataFrame:
    t = spread(table(spark, d, "documents").select("doc_id", "filing_id", "cik", "source", "lang", "document_type", "filename", "description", "text"))
    key, some = F.col("doc_id").cast("string"), lambda c: F.coalesce(c, F.lit(""))
    line = lambda tag, c: F.when(c.isNotNull(), F.concat(F.lit(f"<{tag}>"), c, F.lit("\n"))).otherwise("")
    head = F.concat(
        F.lit("<SEC-DOCUMENT>\n<SEC-HEADER>\n<ACCEPTANCE-DATETIME>20200102030405\nACCESSION NUMBER:\t\t"), some(F.col("filing_id")), F.lit("\nCONFORMED SUBMISSION TYPE:\t8-K\nFILED AS OF DATE:\t20200102\nITEM INFORMATION:\tOther Events\nITEM INFORMATION:\t"),
        some(F.col("lang")), F.lit("\nFILER:\n\tCOMPANY DATA:\n\t\tCOMPANY CONFORMED NAME:\t"), some(F.col("source")), F.lit("\n\t\tCENTRAL INDEX KEY:\t000"), some(F.col("cik")),
        F.lit("\n\tBUSINESS ADDRESS:\n\t\tCITY:\tX\n\t\tCITY:\tY\n\t\tZIP:\t\n\tMAIL ADDRESS:\n\t\tSTATE:\t"), some(F.col("lang")), F.lit("\n\tFORMER COMPANY:\n\t\tFORMER CONFORMED NAME:\tOLD "), key,
        F.lit("\n\t\tDATE OF NAME CHANGE:\t19990101\n\tFORMER COMPANY:\n\t\tSOMETHING ELSE:\tx\n</SEC-HEADER>\n"),
    )
    body = F.when(F.col("text").isNotNull(), F.concat(F.lit("<TEXT>\nText "), key, F.lit("\n"), F.col("text"), F.lit("\n</TEXT>\n"))).otherwise("")
    first = F.concat(F.lit("<DOCUMENT>\n"), line("TYPE", F.col("document_type")), F.lit("<SEQUENCE>7\n"), line("FILENAME", F.col("filename")), line("DESCRIPTION", F.col("description")), body, F.lit("</DOCUMENT>\n"))
    last = F.when(F.col("description").isNull(), "<DOCUMENT>\n<TYPE>EX-99\n</DOCUMENT>\n").otherwise("")
    raw = lambda c: F.encode(c, "UTF-8")
    content = F.concat(
        raw(F.concat(head, first, F.lit("<DOCUMENT>\n<TYPE>ZIP\n<FILENAME>a/b/"), key, F.lit(".zip\n<TEXT>\n"))), _uu(_zip(F.col("text"), key, F.col("lang").isNotNull())),
        raw(F.lit("</TEXT>\n</DOCUMENT>\n<DOCUMENT>\n<TYPE>EX-97\n<FILENAME>enc.txt\n<TEXT>\n")), _uu(raw(F.col("text"))), raw(F.concat(F.lit("</TEXT>\n</DOCUMENT>\n"), last, F.lit("</SEC-DOCUMENT>\n"))),
    )
    folder = F.when(S.form_key(F.col("document_type")) == "10-K", "10-K").otherwise("8-K")  # the header says 8-K of all
    return t.select(F.concat_ws("/", F.lit("raw/2020"), folder, F.concat(key, F.lit(".txt"))).alias("relpath"), content.alias("content"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return P.parse_submissions(_submissions(spark, d))


def _children(spark: SparkSession, d: str, name: str) -> DataFrame:
    return P.children(P.filings_table(_parsed(spark, d)))[name]


_SAFE = "left(coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(coalesce({0}, ''), '^.*/', ''), '[^A-Za-z0-9._() -]+', '_', 'g'), '^[ .]+|[ .]+$', '', 'g'), ''), '{1}'), 180)"
_FN = _strip("filename")
_SUB = f"""s AS (SELECT *, CASE WHEN {_form('document_type')} = '10-K' THEN '10-K' ELSE '8-K' END AS folder, 'raw/2020/' || folder || '/' || doc_id || '.txt' AS relpath, coalesce(text, '') AS txt, {_strip("coalesce(lang, '')")} AS lg,
    ltrim({_strip("'000' || coalesce(cik, '')")}, '0') AS company, {_SAFE.format(_FN, 'document_0001.txt')} AS safe FROM documents),
  ok AS (SELECT *, sha256(relpath || '|' || {_strip("coalesce(filing_id, '')")} || '|' || company) AS fid, text IS NOT NULL AND lower(safe) LIKE '%.zip' AS no_zip FROM s WHERE folder = '8-K')"""
_TXT = "'Text ' || doc_id || chr(10) || text || chr(10)"


@query(f"""WITH {_SUB} SELECT relpath, '7' AS sequence, {_strip('document_type')} AS document_type, {_FN} AS filename, {_strip('description')} AS description, CASE WHEN text IS NOT NULL THEN 'documents/0001_' || safe END AS relative_path,
    CASE WHEN text IS NULL THEN 'no_text_block' ELSE 'plain' END AS encoding_status, CASE WHEN text IS NULL THEN 0 ELSE octet_length(encode({_TXT})) END::BIGINT AS size_bytes, sha256({_TXT}) AS sha256, no_zip AS bad_zip FROM ok
  UNION ALL SELECT relpath, '3', 'EX-97', 'enc.txt', NULL, 'documents/0003_enc.txt', 'uuencoded', octet_length(encode(txt)), sha256(txt), false FROM ok
  UNION ALL SELECT relpath, '4', 'EX-99', NULL, NULL, NULL, 'no_text_block', 0, NULL, false FROM ok WHERE description IS NULL""")
def submission_documents(spark, d):
    rows = _parsed(spark, d).filter("record.error_type IS NULL").select("relpath", F.explode("record.documents").alias("d")).filter("coalesce(d.document_type, '') <> 'ZIP'")
    return rows.select("relpath", *(f"d.{c}" for c in ("sequence", "document_type", "filename", "description", "relative_path", "encoding_status", "size_bytes", "sha256")), F.col("d.zip_error").isNotNull().alias("bad_zip"))


@query(f"""WITH {_SUB} SELECT fid AS filing_id, '2' AS sequence, unnest(['a/text.txt', 'N.txt']) AS member_name, 'extracted/0002_' || doc_id || '/' || member_name AS extracted_path,
  CASE member_name WHEN 'N.txt' THEN sha256(doc_id::VARCHAR) ELSE sha256(txt) END AS sha256, CASE member_name WHEN 'N.txt' THEN length(doc_id::VARCHAR) ELSE octet_length(encode(txt)) END::BIGINT AS size_bytes FROM ok WHERE lang IS NOT NULL""")
def archive_members(spark, d):
    return _children(spark, d, "archive_members")


@query(f"""WITH {_SUB} SELECT fid AS filing_id, s AS section, f AS field_name, v AS field_value, o::BIGINT AS occurrence FROM ok, LATERAL (VALUES ('filing', 'ACCEPTANCE-DATETIME', '20200102030405', 0), ('filing', 'ACCESSION NUMBER', {_strip("coalesce(filing_id, '')")}, 0),
  ('filing', 'CONFORMED SUBMISSION TYPE', '8-K', 0), ('filing', 'FILED AS OF DATE', '20200102', 0), ('company_data', 'COMPANY CONFORMED NAME', {_strip("coalesce(source, '')")}, 0), ('company_data', 'CENTRAL INDEX KEY', {_strip("'000' || coalesce(cik, '')")}, 0),
  ('business_address', 'CITY', 'X', 0), ('business_address', 'CITY', 'Y', 1), ('business_address', 'ZIP', '', 0), ('mail_address', 'STATE', lg, 0), ('former_company', 'FORMER CONFORMED NAME', 'OLD ' || doc_id, 0),
  ('former_company', 'DATE OF NAME CHANGE', '19990101', 0), ('former_company', 'SOMETHING ELSE', 'x', 0)) t(s, f, v, o)""")
def submission_header_fields(spark, d):
    return _children(spark, d, "header_fields")


@query(f"""WITH {_SUB} SELECT fid AS filing_id, {_strip("coalesce(filing_id, '')")} AS accession_number, '8-K' AS form_type, '20200102030405' AS acceptance_datetime, {_strip("coalesce(source, '')")} AS company_name, nullif(company, '') AS cik,
  '2020-01-02' AS filed_as_of_date, relpath AS source_relpath, doc_id || '.txt' AS source_filename, CASE WHEN w THEN 'complete_with_warnings' ELSE 'complete' END AS processing_status, NOT w AS delete_safe
  FROM (SELECT *, description IS NULL OR text IS NULL OR lang IS NULL OR no_zip AS w FROM ok)""")
def submission_filings(spark, d):
    f = P.filings_table(_parsed(spark, d))
    return f.select("filing_id", "accession_number", "form_type", "acceptance_datetime", "company_name", "cik", "filed_as_of_date", "source_relpath", "source_filename", "processing_status", "delete_safe")


@query(f"""WITH {_SUB} SELECT fid AS filing_id, 'business' AS address_kind, NULL::VARCHAR AS street1, NULL::VARCHAR AS street2, 'Y' AS city, NULL::VARCHAR AS state, NULL::VARCHAR AS postal_code, NULL::VARCHAR AS phone FROM ok
  UNION ALL SELECT fid, 'mailing', NULL, NULL, NULL, nullif(lg, ''), NULL, NULL FROM ok""")
def submission_addresses(spark, d):
    return _children(spark, d, "addresses")


@query(f"WITH {_SUB} SELECT fid AS filing_id, 0 AS ordinal, 'OLD ' || doc_id AS former_name, '19990101' AS date_of_name_change FROM ok")
def submission_former_names(spark, d):
    return _children(spark, d, "former_names")


@query(f"WITH {_SUB} SELECT fid AS filing_id, 0 AS ordinal, 'Other Events' AS item_information FROM ok UNION ALL SELECT fid, 1, lg FROM ok")
def submission_items(spark, d):
    return _children(spark, d, "filing_items")


@query(f"""WITH {_SUB} SELECT fid AS filing_id, 'document sequence 4 has no <TEXT> body' AS warning FROM ok WHERE description IS NULL UNION ALL SELECT fid, 'document sequence 7 has no <TEXT> body' FROM ok WHERE text IS NULL
  UNION ALL SELECT fid, 'zip extraction failed for a/b/' || doc_id || '.zip: unsafe member path: ''../x''' FROM ok WHERE lang IS NULL UNION ALL SELECT fid, 'zip extraction failed for ' || {_FN} || ': File is not a zip file' FROM ok WHERE no_zip""")
def submission_warnings(spark, d):
    return _children(spark, d, "processing_warnings")


@query(f"WITH {_SUB} SELECT relpath, 'ValueError' AS error_type, 'form mismatch: folder ''10-K'', header ''8-K''' AS error_message FROM s WHERE folder = '10-K'")
def submission_errors(spark, d):
    return P.errors(_parsed(spark, d))


@query(f"WITH {_SUB} SELECT relpath, {_strip("coalesce(filing_id, '')")} AS accession_number, 'Other Events|' || lg AS items, 13 AS n_fields, 3 + (description IS NULL)::INTEGER AS n_documents FROM ok")
def recovery_records(spark, d):
    """The nested record of each submission as a JSON file of its own, and read again."""
    parsed, root = _parsed(spark, d).filter("record.error_type IS NULL"), local(spark)
    light = F.struct("relpath", F.col("record").withField("documents", F.transform("record.documents", lambda x: x.dropFields("body"))).alias("record"))
    schema = parsed.select(light.alias("r")).schema["r"].dataType
    name = F.concat(F.regexp_replace("relpath", r"\.txt$", ""), F.lit(".json"))
    writers.write_payloads(parsed.select(name.alias("relpath"), F.encode(F.to_json(light), "UTF-8").alias("content")), root).count()
    back = readers.read_records(spark, f"{root}/raw/2020/*/*.json", schema)
    return back.select("relpath", "record.filing.accession_number", F.array_join("record.items", "|").alias("items"), F.size("record.header_fields").alias("n_fields"), F.size("record.documents").alias("n_documents"))


# ---- cleaned texts

_C1 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
_REF = "&#(?:[0-9]+|[xX][0-9a-fA-F]+);?|&(?:amp|lt|gt|quot|nbsp|middot|copy);"
_NUMBER = "CASE WHEN regexp_matches(r, '^&#[xX]') THEN ('0x' || regexp_extract(r, '([0-9a-fA-F]+);?$', 1))::INTEGER ELSE regexp_extract(r, '([0-9]+)', 1)::INTEGER END"
_PLAIN = f"""CASE r WHEN '' THEN '' WHEN '&amp;' THEN '&' WHEN '&lt;' THEN '<' WHEN '&gt;' THEN '>' WHEN '&quot;' THEN '"' WHEN '&nbsp;' THEN chr(160) WHEN '&middot;' THEN '·' WHEN '&copy;' THEN '©'
  ELSE (CASE WHEN ({_NUMBER}) BETWEEN 128 AND 159 THEN substr('{_C1}', ({_NUMBER}) - 127, 1) ELSE chr({_NUMBER}) END) END"""


def clean(x: str) -> str:
    """SQL of the readable text of ``x``: references, tags, white space."""
    plain = f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{_REF}'), regexp_extract_all({x}, '{_REF}') || ['']), lambda z: z[1] || (list_transform([coalesce(z[2], '')], lambda r: {_PLAIN}))[1]), '')"
    for pattern in ("<script.*?>.*?</script>", "<style.*?>.*?</style>", "<!--.*?-->", "<[^>]+>"):
        plain = f"regexp_replace({plain}, '(?is){pattern}', ' ', 'g')"
    flat = f"regexp_replace(regexp_replace(replace(regexp_replace({plain}, '[\\x{{a0}}\\x{{200b}}]+', ' ', 'g'), chr(0), ' '), '\\r\\n?', chr(10), 'g'), '[ \\t\\f\\x0b]+', ' ', 'g')"
    return f"regexp_replace(regexp_replace({flat}, '\\n{{3,}}', chr(10) || chr(10), 'g'), '^{_SPACE[1:-1]}|{_SPACE[1:-1]}$', '', 'g')"


@query(f"SELECT doc_id, length(c)::INTEGER AS n_chars, md5(c) AS text_md5 FROM (SELECT doc_id, CASE WHEN text IS NOT NULL THEN {clean('text')} END AS c FROM documents)")
def cleaned_texts(spark, d):
    cleaned = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", S.clean_text(F.col("text")).alias("t"))
    return cleaned.select("doc_id", F.length("t").alias("n_chars"), F.md5("t").alias("text_md5"))


# ---- text records: raw files of three documents, some of them in Latin-1, some without a form in the header


def _raw_texts(spark: SparkSession, d: str) -> DataFrame:
    t = spread(table(spark, d, "documents").select("doc_id", "filing_id", "cik", "lang", "document_type", "filename", "text"))
    key, named = F.col("doc_id").cast("string"), lambda c, none: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(none))
    block = lambda kind, name, text: F.concat(F.lit("<DOCUMENT>\n<TYPE>"), kind, F.lit("\n<FILENAME>"), name, F.lit("\n<TEXT>\nfirst line\n"), text, F.lit("\n</TEXT>\n</DOCUMENT>\n"))
    form = F.when(F.col("lang").isNotNull(), "CONFORMED SUBMISSION TYPE:\t8-K\n").otherwise("")
    content = F.concat(
        F.lit("<ACCEPTANCE-DATETIME>20200102030405\nCOMPANY CONFORMED NAME:\t\té Company "), key, F.lit("\nACCESSION NUMBER:\t0001-20-"), key, F.lit("\n"), form, F.lit("CENTRAL INDEX KEY:\t000"), F.regexp_extract(F.coalesce("cik", F.lit("")), "([0-9]+)", 1), F.lit("9\nFILED AS OF DATE:\t20200102\n"),
        block(F.lit("EX-10"), F.lit("ex.txt"), F.lit("An exhibit that is as long as it need be")), block(named(F.col("document_type"), "NONE"), named(F.col("filename"), "none.txt"), F.coalesce("text", F.lit(""))),
        block(F.lit("OTHER"), F.lit("other.txt"), F.expr("repeat('filler ', cast(doc_id % 7 * 20 as int))")),
    )
    latin = F.coalesce(F.col("text").rlike(r"^[\x00-\xFF]*$"), F.lit(True)) & F.coalesce(F.concat("document_type", "filename").rlike(r"^[\x00-\xFF]*$"), F.lit(True))
    year = F.concat(F.lit("20"), F.lpad((F.col("doc_id") % 20).cast("string"), 2, "0"))
    path = F.concat_ws("/", F.lit("raw"), year, F.when(F.col("lang").isNull(), "DEF_14A").otherwise("8-K"), F.concat(key, F.lit(".txt")))
    return t.select(path.alias("relpath"), F.when(latin, F.encode(content, "ISO-8859-1")).otherwise(F.encode(content, "UTF-8")).alias("content"))


_TYPE = "trim(coalesce(nullif(trim(document_type), ''), 'NONE'))"
_FILLER = "repeat('filler ', (doc_id % 7 * 20)::INTEGER)"
_RECORDS = f"""b AS (SELECT doc_id, coalesce(text, '') AS txt, '20' || lpad((doc_id % 20)::VARCHAR, 2, '0') AS year, CASE WHEN lang IS NULL THEN 'DEF_14A' ELSE '8-K' END AS folder, CASE WHEN lang IS NULL THEN 'DEF 14A' ELSE '8-K' END AS form,
    {_TYPE} AS kind, upper(kind) AS k, coalesce(nullif(trim(filename), ''), 'none.txt') AS fn, ltrim('000' || regexp_extract(coalesce(cik, ''), '([0-9]+)', 1) || '9', '0') AS company FROM documents),
  w AS (SELECT *, CASE WHEN form = '8-K' THEN replace(k, ' ', '') = '8-K' ELSE k IN ('DEF 14A', 'DEF14A', 'DEF_14A') OR replace(k, ' ', '') IN ('DEF14A', 'DEF_14A') END AS declared, NOT starts_with(k, 'EX-') AND k NOT IN ('GRAPHIC', 'XML', 'ZIP', 'PDF') AND length(txt) >= length({_FILLER}) AS longest FROM b),
  tr AS (SELECT *, 'raw/' || year || '/' || folder || '/' || doc_id || '.txt' AS relpath, declared OR longest AS own, {clean("(CASE WHEN declared OR longest THEN txt ELSE " + _FILLER + " END || chr(10) || '</TEXT>' || chr(10))")} AS clean FROM w)"""


@query(f"""WITH {_RECORDS}, {_UNIVERSE} SELECT relpath, year, form AS form_type, folder AS folder_form, company AS cik, 'é Company ' || doc_id AS entity_name, '2020-01-02' AS filing_date, '' AS period_of_report, '20200102030405' AS acceptance_datetime,
  '0001-20-' || doc_id AS accession, CASE WHEN own THEN kind ELSE 'OTHER' END AS primary_doc_type, CASE WHEN own THEN fn ELSE 'other.txt' END AS primary_doc_filename, length(clean)::BIGINT AS clean_text_chars, md5(clean) AS text_md5, 'ok' AS status,
  (company IN (SELECT cik FROM universe))::INTEGER AS is_company_in_universe FROM tr""")
def text_records(spark, d):
    """The cleaned-document table of raw files: header search, fallback form, primary document, cleaning, universe."""
    r = P.text_record(_raw_texts(spark, d), universe(spark, d))
    kept = ("relpath", "year", "form_type", "folder_form", "cik", "entity_name", "filing_date", "period_of_report", "acceptance_datetime", "accession", "primary_doc_type", "primary_doc_filename", "clean_text_chars", "status", "is_company_in_universe")
    return r.select(*kept, F.md5("clean_text").alias("text_md5"))


_ALL = "u AS (SELECT DISTINCT company AS cik FROM tr JOIN documents USING (doc_id) WHERE description IS NOT NULL)"
_KEPT_SECTIONS = f"WITH {_RECORDS}, {_ALL}, kept AS (SELECT doc_id, form AS document_type, clean AS text, year FROM tr WHERE company IN (SELECT cik FROM u)), {section_sql.SECTIONS.replace('FROM documents', 'FROM kept')[5:]}"


def _products(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The pipeline over the raw files; its universe is the companies that describe a document."""
    number = F.concat(F.lit("000"), F.regexp_extract(F.coalesce("cik", F.lit("")), "([0-9]+)", 1), F.lit("9"))
    known = R.universe(table(spark, d, "documents").filter("description IS NOT NULL").select(number.alias("cik")))
    return pipeline.text_products(_raw_texts(spark, d), known, at_least=1)


@query(f"{_KEPT_SECTIONS} SELECT year, a.form_type, section_name, count(*) AS section_count FROM a JOIN kept USING (doc_id) GROUP BY 1, 2, 3")
def product_sections(spark, d):
    """Sections per year, form and name, of documents that are kept."""
    return _products(spark, d)["section_coverage"]


@query(f"""WITH {_RECORDS}, {_ALL}, kept AS (SELECT * FROM tr WHERE company IN (SELECT cik FROM u)) SELECT CASE WHEN grouping(form) = 0 THEN 'year_form' WHEN grouping(company) = 0 THEN 'year_company' ELSE 'year' END AS level, year, form AS form_type, company AS cik, count(*) AS doc_count
  FROM kept GROUP BY GROUPING SETS ((year), (year, form), (year, company))""")
def product_coverage(spark, d):
    return _products(spark, d)["coverage"]


@query(f"WITH {_RECORDS}, {_SUB}, {_ALL} SELECT 'docs' AS stage, 'ok' AS status, count(*) AS n FROM tr UNION ALL SELECT 'filings', CASE WHEN description IS NULL OR text IS NULL OR lang IS NULL OR no_zip THEN 'complete_with_warnings' ELSE 'complete' END, count(*) FROM ok GROUP BY 2")
def stage_status(spark, d):
    """How many rows of each stage have which status."""
    filings = P.filings_table(_parsed(spark, d)).select(F.col("processing_status").alias("status"))
    return R.status_report(docs=P.text_record(_raw_texts(spark, d)), filings=filings)


@query(f"""WITH {_RECORDS}, {_ALL}, kept AS (SELECT *, len(regexp_extract_all(clean, {_WORD}))::BIGINT AS n FROM tr WHERE company IN (SELECT cik FROM u)) SELECT form AS form_type, count(*) AS docs, avg(n) AS avg_size, list_sort(list(n))[(count(*) // 2 + 1)::BIGINT] AS median_size FROM kept GROUP BY 1""")
def product_lengths(spark, d):
    return _products(spark, d)["length_stats"]


# ---- sections by choice, chunks with and without sections


@query(f"{section_sql.SECTIONS} SELECT doc_id, section_name, section_rank::INTEGER AS section_rank, (lang = 'en')::INTEGER AS is_balanced FROM (SELECT a.*, coalesce(lang, '') AS lang FROM a JOIN documents USING (doc_id))")
def routed_sections(spark, d):
    """Sections with a flag where their document is in a chosen set."""
    t = table(spark, d, "documents").select("doc_id", "text", "lang", S.form_key(F.col("document_type")).alias("form_type"))
    return X.route(X.extract_sections(t, ["doc_id"]), t.filter("lang = 'en'")).select("doc_id", "section_name", "section_rank", "is_balanced")


@query(f"""{section_sql.SECTIONS}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE section_name {_PRIORITY} ELSE {X.OTHER_PRIORITY} END, section_rank) AS k FROM a),
  m AS (SELECT *, max(length(s) >= 500) OVER (PARTITION BY doc_id) AS ok FROM o WHERE k <= 3), w AS (SELECT doc_id, section_name, k, list_filter(regexp_split_to_array(s, {_SPACE}), lambda v: v <> '') AS w FROM m WHERE length(s) >= 500 OR (NOT ok AND k = 1)
    UNION ALL SELECT doc_id, 'full_document', 1, list_filter(regexp_split_to_array(coalesce(text, ''), {_SPACE}), lambda v: v <> '') FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM a)),
  i AS (SELECT *, unnest(range(0, len(w), 300)) AS j FROM w WHERE len(w) > 0), c AS (SELECT doc_id, section_name, k, j, w[j + 1:j + 350] AS c FROM i)
  SELECT doc_id, section_name AS source_name, row_number() OVER (PARTITION BY doc_id ORDER BY k, j) - 1 AS chunk_index, len(c)::BIGINT AS word_count, md5(array_to_string(c, ' ')) AS chunk_md5 FROM c WHERE len(c) >= 116""")
def chunks_or_whole(spark, d):
    """Chunks of the chosen sections, and of the whole text where a document has no section."""
    t = table(spark, d, "documents").select("doc_id", "text", S.form_key(F.col("document_type")).alias("form_type"))
    c = X.chunks_or_whole(t, X.extract_sections(t, ["doc_id"]))
    return c.select("doc_id", "source_name", "chunk_index", "word_count", F.md5("chunk_text").alias("chunk_md5"))


# ---- quality, targets, quotas


_FORM_VALUES = ", ".join(f"('{f}')" for f in (*FORMS, "NO SUCH FORM"))


@query(f"""WITH n AS (SELECT {_form('document_type')} AS form_type, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS n FROM documents)
  SELECT f.form_type, count(n) AS docs, coalesce(avg(n), 0.0::DOUBLE) AS avg_size, coalesce(list_sort(list(n) FILTER (n IS NOT NULL))[(count(n) // 2 + 1)::BIGINT], 0) AS median_size FROM (VALUES {_FORM_VALUES}) f(form_type) LEFT JOIN n USING (form_type) GROUP BY 1""")
def form_stats(spark, d):
    """Counts and lengths of the corpus's forms only, zeros for a form without documents."""
    t = table(spark, d, "documents").select(S.form_key(F.col("document_type")).alias("form_type"), S.count_words(F.col("text")).alias("n_words"))
    return R.form_stats(t, (*FORMS, "NO SUCH FORM"))


@query(f"WITH {_DOCS} SELECT unnest(list_sort(list(DISTINCT year))) AS year, generate_subscripts(list_sort(list(DISTINCT year)), 1) - 1 AS place FROM docs")
def years_covered(spark, d):
    return R.years_covered(docs(spark, d)).select(F.posexplode("years").alias("place", "year")).select("year", F.col("place").cast("bigint").alias("place"))


@query(f"WITH {_DOCS}, c AS (SELECT year, count(*) AS doc_count FROM docs GROUP BY 1) SELECT year, doc_count, least(doc_count, 12) AS target_per_year FROM c WHERE doc_count >= 10 ORDER BY doc_count, year LIMIT 1")
def weakest_year_overridden(spark, d):
    return R.weakest_year(docs(spark, d).groupBy("year").agg(F.count("*").alias("doc_count")), 10, 12)


def _allocation(weights: dict[str, float]) -> str:
    """CTEs after ``have`` (year, form_type, available) and ``goal`` (year, target): quotas."""
    values = ", ".join(f"('{f}', {w!r}::DOUBLE, {k})" for k, (f, w) in enumerate(weights.items()))
    return f"""w(form_type, weight, ord) AS (VALUES {values}), f AS (SELECT have.*, weight, ord, target, least(round_even(target * weight, 0)::BIGINT, available) AS take FROM have JOIN w USING (form_type) JOIN goal USING (year)),
  m AS (SELECT *, greatest(target - sum(take) OVER (PARTITION BY year), 0) AS missing FROM f), sp AS (SELECT *, unnest(range(1, available - take + 1)) AS k FROM m WHERE available > take),
  r AS (SELECT year, form_type, row_number() OVER (PARTITION BY year ORDER BY k, weight DESC, available DESC, ord) AS n, missing FROM sp), x AS (SELECT year, form_type, count(*) AS extra FROM r WHERE n <= missing GROUP BY 1, 2),
  quotas AS (SELECT year, target, form_type, available, (take + coalesce(extra, 0))::BIGINT AS quota FROM m LEFT JOIN x USING (year, form_type))"""


_WEIGHTS = "8-K=0.5,10-Q=0.27,10-K=0.09,DEF_14A=0.14,X=3"


@query(f"WITH {_QDOCS}, have AS (SELECT year, form_type, count(*) AS available FROM qd GROUP BY 1, 2), goal AS (SELECT year, (count(*) // 3)::BIGINT AS target FROM qd GROUP BY 1), {_allocation(Q.parse_weights(_WEIGHTS))} SELECT * FROM quotas")
def weighted_allocation(spark, d):
    """Quotas by weights that are told as text."""
    q = _quota_docs(spark, d)
    goal = q.groupBy("year").agg(F.floor(F.count("*") / 3).alias("target"))
    return Q.allocate(q.groupBy("year", "form_type").agg(F.count("*").alias("available")).join(goal, "year"), Q.parse_weights(_WEIGHTS))


def _turns(source: str, keys: str, seed: int) -> str:
    one = f"SELECT *, row_number() OVER (PARTITION BY {keys}, cik ORDER BY md5('{seed}|' || url), url) AS turn FROM {source}"
    return f"SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY turn, md5('{seed}|' || cik), cik) AS n FROM ({one})"


@query(f"""WITH {_UNIVERSE}, fl AS (SELECT filing_id AS url, {_form('form_type')} AS form_type, substr({_strip('filed_as_of_date')}, 1, 4) AS year, {_any('cik')} AS cik, {_strip("coalesce(accession_number, '')")} AS accession, {_strip("replace(coalesce(source_relpath, ''), chr(92), '/')")} AS path FROM filings),
  lack AS (SELECT year, least(count(*), 30)::BIGINT AS target FROM fl WHERE year BETWEEN '2001' AND '2012' GROUP BY 1), done AS (SELECT DISTINCT path, cik, accession FROM fl WHERE md5(url) < '4'),
  c0 AS (SELECT * FROM fl WHERE form_type IN {CORE} AND year IN (SELECT year FROM lack) AND cik IN (SELECT cik FROM universe) AND path NOT IN (SELECT path FROM done) AND (cik, accession) NOT IN (SELECT (cik, accession) FROM done WHERE accession <> '')),
  c AS (SELECT url, year, form_type, cik, max(accession) AS accession FROM c0 GROUP BY 1, 2, 3, 4), have AS (SELECT year, form_type, count(*) AS available FROM c GROUP BY 1, 2), goal AS (SELECT * FROM lack), {_allocation(Q.parse_weights(None))},
  first AS (SELECT t.* FROM ({_turns('c', 'year, form_type', 3)}) t JOIN quotas USING (year, form_type) WHERE n <= quota), g AS (SELECT year, target - count(url) AS quota FROM lack LEFT JOIN first USING (year) GROUP BY year, target),
  rest AS (SELECT * FROM c WHERE (cik, accession, url) NOT IN (SELECT (cik, accession, url) FROM first)), extra AS (SELECT t.* FROM ({_turns('rest', 'year', 1002)}) t JOIN g USING (year) WHERE n <= quota),
  all_ AS (SELECT url, cik, accession, year, form_type FROM first UNION ALL SELECT url, cik, accession, year, form_type FROM extra)
  SELECT url AS filing_url, (arg_min(row(year, form_type, cik), (cik, accession, url, year, form_type))).* FROM all_ GROUP BY 1""".replace("(arg_min(row(year, form_type, cik), (cik, accession, url, year, form_type))).*", "arg_min(year, (cik, accession, year, form_type)) AS year, arg_min(form_type, (cik, accession, year, form_type)) AS form_type, min(cik) AS cik"))
def topped_up(spark, d):
    """Weak years filled from manifest rows that are wanted, known to the universe and not there yet."""
    f = table(spark, d, "filings").select("cik", "form_type", F.col("filed_as_of_date").alias("date_filed"), F.col("source_relpath").alias("output_path"), F.col("accession_number").alias("accession"), F.col("filing_id").alias("filing_url"))
    year = F.substring(S.strip(F.col("date_filed")), 1, 4)
    lack = f.select(year.alias("year")).filter("year BETWEEN '2001' AND '2012'").groupBy("year").agg(F.least(F.count("*"), F.lit(30)).alias("deficit"))
    done = f.filter(F.md5("filing_url") < "4").withColumn("accession", S.strip(F.coalesce("accession", F.lit(""))))
    c = Q.top_up_candidates(f, lack, universe(spark, d), done.select(F.col("output_path").alias("rel_path")), done.select("cik", "accession"))
    one = c.groupBy("filing_url", "year", "form_type", "cik").agg(F.max("accession").alias("accession"))  # repeated rows of a filing
    return Q.top_up(one, lack, Q.parse_weights(None), 3, "filing_url", ("cik", "accession", "filing_url")).select("filing_url", "year", "form_type", "cik")


# ---- names and numbers as shown

_B = "source_size_bytes"
_UNITS = "CASE " + " ".join(f"WHEN {_B} < {1024 ** (k + 1)} THEN printf('%.2f {u}', {_B} / {1024.0**k}::DOUBLE)" for k, u in enumerate(("B", "KB", "MB", "GB"))) + f" WHEN {_B} IS NOT NULL THEN printf('%.2f TB', {_B} / {1024.0**4}::DOUBLE) END"


@query(f"""SELECT filing_id, {_UNITS} AS size, CASE WHEN {_B} * 36 < 60 THEN printf('%.1fs', {_B} * 36::DOUBLE) WHEN {_B} * 36 < 3600 THEN printf('%.1fm', {_B} * 36 / 60::DOUBLE) WHEN {_B} IS NOT NULL THEN printf('%.2fh', {_B} * 36 / 3600::DOUBLE) END AS elapsed,
  {_SAFE.format("replace(company_name, chr(92), '/')", 'document.txt')} AS file_name, replace(form_type, '_', ' ') AS form FROM filings""")
def shown_values(spark, d):
    t = table(spark, d, "filings")
    return t.select("filing_id", S.human_bytes(F.col(_B)).alias("size"), S.elapsed_text(F.col(_B) * 36).alias("elapsed"), S.safe_filename(F.col("company_name")).alias("file_name"), S.canonical_form(F.col("form_type")).alias("form"))
