"""Queries over sources and sinks: each writes the rows of a whole table to the shared folder and reads them back through the source."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.upsert import children_of, publication, upsert_latest
from tessera.plans.reference import _DOCS, _UNIVERSE, FORMS, _iso, docs, manifest, universe
from tessera.plans.register import registry
from tessera.session import shared_dir, stored, table
from tessera.sources import fetch as net
from tessera.sources import readers, tables, writers
from tessera.streaming import incremental

QUERIES, SQL, query = registry()


def local(spark: SparkSession) -> str:
    """A fresh folder."""
    return shared_dir(spark)


# ---- index files


@query("""SELECT * FROM (SELECT c_custkey::VARCHAR AS cik, c_name || ' é' AS company_name, '10-K' AS form_type, '2020-01-01' AS date_filed, 'edgar/' || c_custkey || '.txt' AS filename FROM customer
    UNION ALL SELECT DISTINCT 'X' || (c_custkey // 100), 'not a number', '8-K', '2020-01-02', 'edgar/x.txt' FROM customer), LATERAL (SELECT 'https://www.sec.gov/Archives/' || filename AS filing_url)""")
def master_index(spark, d):
    """Index files of a hundred companies each, with lines before the rule and of other lengths that are no rows."""
    key, block = F.col("c_custkey").cast("string"), F.floor(F.col("c_custkey") / 100).cast("string")
    line = F.concat_ws("|", key, F.concat(F.lit(" "), F.col("c_name"), F.lit(" é\t")), F.lit("10-K"), F.lit("2020-01-01"), F.concat(F.lit("edgar/"), key, F.lit(".txt")))
    head = F.lit("Description: Master Index\nCIK|Company Name|Form Type|Date Filed|Filename\n--------\n\n1|2|3|4\n1|2|3|4|5|6\nX")
    lines = table(spark, d, "customer").groupBy(block.alias("block")).agg(F.collect_list(line).alias("l"))  # a hundred lines
    text = F.concat(head, F.col("block"), F.lit("|not a number|8-K|2020-01-02|edgar/x.txt\n"), F.array_join("l", "\n"))
    root = local(spark)
    writers.write_payloads(lines.select(F.concat(F.lit("QTR1/"), F.col("block"), F.lit(".idx")).alias("relpath"), F.encode(text, "ISO-8859-1").alias("content")), root).count()
    return readers.read_master_index(spark, f"{root}/QTR1/*.idx")


# ---- CSV, JSON lines, reports, tables


@query(f"SELECT filing_id, nullif(cik, '') AS cik, nullif(company_name, '') AS company_name, nullif(form_type, '') AS form_type, nullif({_iso('filed_as_of_date')}, '') AS date_filed, source_relpath AS output_path FROM filings")
def manifest_file(spark, d):
    """The manifest as CSV; an empty text comes back as null."""
    root = local(spark)
    writers.write_manifest(manifest(spark, d), f"{root}/manifest")
    return readers.read_csv(spark, f"{root}/manifest", "cik", "output_path")


@query("SELECT event_type, count(*) * 2 AS n, sum(event_id)::BIGINT * 2 AS ids FROM events GROUP BY 1")
def appended_logs(spark, d):
    """A log appended to twice, as CSV and as JSON lines; the rows of the one and of the other are the same."""
    root, rows = local(spark), table(spark, d, "events").select("event_id", "event_type")
    for _ in range(2):
        writers.append_log(rows, f"{root}/log")
        writers.append_events(rows, f"{root}/events")
    csv = readers.read_csv_or_empty(spark, f"{root}/log", ("event_id", "event_type")).select(F.col("event_id").cast("bigint").alias("event_id"), "event_type")
    lines = spark.read.schema("event_id long, event_type string").json(f"{root}/events")
    counts = lambda df: df.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    return counts(csv).intersect(counts(lines))


@query("SELECT DISTINCT c_mktsegment AS segment FROM customer")
def processed_segments(spark, d):
    """Values of one column over all parts; of parts that are not there, none."""
    root = local(spark)
    table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), "c_custkey").write.csv(f"{root}/parts", header=True)
    return readers.processed_values(spark, f"{root}/parts", "segment").unionByName(readers.processed_values(spark, f"{root}/none", "segment"))


@query("SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5, count(*) OVER () AS n FROM documents")
def text_parts(spark, d):
    """Compressed JSON lines in two parts, the second of which replaces what the first says of a document."""
    root, t = local(spark), table(spark, d, "documents")
    writers.write_text_parts(t.select("doc_id", F.lit("part_1").alias("part_id"), F.lit("older").alias("clean_text")), f"{root}/a")
    writers.write_text_parts(t.select("doc_id", F.lit("part_2").alias("part_id"), F.col("text").alias("clean_text")), f"{root}/b")
    last = readers.last_of(readers.read_text_parts(spark, f"{root}/*").select("doc_id", "part_id", "clean_text"), "doc_id", "part_id")
    n = last.agg(F.count("*")).scalar()
    return last.select("doc_id", F.md5("clean_text").alias("text_md5"), n.alias("n"))


@query(f"WITH {_DOCS}, c AS (SELECT year, count(*) AS n FROM docs GROUP BY 1) SELECT row_number() OVER (ORDER BY year) - 1 AS place, year, n FROM c")
def year_report(spark, d):
    """A JSON report whose rows are in the order of their keys."""
    text = writers.report_json(docs(spark, d).groupBy("year").agg(F.count("*").alias("n")), "year")
    return spark.createDataFrame([(k, r["year"], r["n"]) for k, r in enumerate(json.loads(text))], "place long, year string, n long")


@query("SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment AS \"market, segment\" FROM customer")
def merged_export(spark, d):
    """One CSV file put together of parts, with one header."""
    path = f"{local(spark)}/customers.csv"
    writers.export_single(table(spark, d, "customer").repartition(3).select("c_custkey", "c_name", F.col("c_mktsegment").alias("market, segment")), path)
    return readers.read_csv(spark, path, "market, segment")


@query(f"WITH {_DOCS} SELECT year, count(*) AS n FROM docs WHERE form_type = '10-K' AND year BETWEEN '2005' AND '2015' GROUP BY 1")
def pruned_table(spark, d):
    """A table by form and year, written over an older one; only the folders asked for are read."""
    path = f"{local(spark)}/docs"
    for _ in range(2):
        writers.write_table(docs(spark, d).filter(F.col("form_type").isin(*FORMS)), path)
    rows = spark.read.schema("doc_id string, form_type string, year string").option("basePath", path).parquet(path)
    return rows.filter("form_type = '10-K' AND year BETWEEN '2005' AND '2015'").groupBy("year").agg(F.count("*").alias("n"))


@query("SELECT 'kept' AS stage, count(*) AS n FROM region")
def reset_stages(spark, d):
    """Two stages written, one of them reset: what is left."""
    root, rows = local(spark), table(spark, d, "region")
    for stage in ("kept", "dropped"):
        rows.write.parquet(f"{root}/{stage}")
    writers.reset_stages(spark, root, ("dropped", "never_there"))
    there = readers.part_names(spark, f"{root}/*/*.parquet")
    return spark.read.parquet(f"{root}/*").agg(F.max(F.when(F.lit(there.count() > 0), F.lit("kept"))).alias("stage"), F.count("*").alias("n"))


@query(f"WITH {_DOCS}, c AS (SELECT year, count(*) AS n FROM docs GROUP BY 1), t AS (SELECT max(n) AS target FROM c) SELECT year, n AS doc_count, target, least(target - n, 50) AS deficit FROM c, t WHERE n < target")
def year_targets(spark, d):
    """Years below the target a balance report names, from a coverage file; what they lack, at most 50."""
    root = local(spark)
    counts = docs(spark, d).groupBy("year").agg(F.count("*").alias("doc_count"))
    counts.write.csv(f"{root}/coverage", header=True)
    counts.agg(F.max("doc_count").alias("target_per_year")).write.json(f"{root}/balance")
    covered = readers.year_coverage(readers.read_csv(spark, f"{root}/coverage", "year", "doc_count"))
    target = readers.target_per_year(spark, f"{root}/balance")
    return R.weak_years(covered, spark.range(1).select(F.lit(target).cast("bigint").alias("t")), 50).withColumn("target", F.lit(target).cast("bigint"))


@query("""SELECT count(DISTINCT relative_path) AS paths, (SELECT count(*) FROM (SELECT DISTINCT ltrim(trim(cik), '0'), filing_id FROM documents WHERE filing_id <> '')) AS keys FROM documents""")
def existing_keys(spark, d):
    t = table(spark, d, "documents").select(F.col("relative_path").alias("rel_path"), F.coalesce("cik", F.lit("")).alias("cik"), F.col("filing_id").alias("accession"))
    paths, keys = readers.existing_keys(t)
    return paths.agg(F.count("rel_path").alias("paths")).select("paths", keys.agg(F.count("*")).scalar().alias("keys"))


@query("SELECT 'raw/2020/8-K/' || doc_id || '.txt' AS relpath, octet_length(encode(text))::BIGINT AS size_bytes, sha256(text) AS sha256, '2020' AS year, '8-K' AS form_folder FROM documents WHERE text <> ''")
def payload_files(spark, d):
    """Texts as files of a year and a form, found again by the scan; files of no year, of other kinds, half-written and empty ones are not."""
    t, root = table(spark, d, "documents").filter("text IS NOT NULL"), local(spark)
    name = F.concat(F.lit("raw/2020/8-K/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    writers.write_payloads(t.select(name.alias("relpath"), F.encode("text", "UTF-8").alias("content")), root).count()
    others = spark.createDataFrame([("raw/misc/8-K/a.txt",), ("raw/2020/8-K/b.htm",), ("raw/2020/8-K/c.txt.part",), ("raw/2020/d.txt",)], "relpath string")
    writers.write_payloads(others.withColumn("content", F.encode(F.lit("x"), "UTF-8")), root).count()
    found = readers.scan_submissions(spark, root)
    return found.select("relpath", F.col("file_size_bytes").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), "year", "form_folder")


# ---- a purge, from the files to the log


def _filing_files(spark: SparkSession, d: str) -> DataFrame:
    """One file per filing, named after its company, with the filing's id in it."""
    f = docs(spark, d).groupBy(F.col("doc_id").alias("id")).agg(F.max("year").alias("year"), F.max("cik").alias("cik"))
    number = F.regexp_extract("cik", "([0-9]{1,10})", 1)
    start = F.when(number != "", F.concat(number, F.lit("__"))).otherwise("none_")
    return f.select(F.concat_ws("/", F.lit("raw"), "year", F.lit("10-K"), F.concat(start, F.col("id"), F.lit(".txt"))).alias("relpath"), F.encode("id", "UTF-8").alias("content"))


_FILES = f"""{_UNIVERSE}, {_DOCS}, g AS (SELECT doc_id, max(year) AS year, regexp_extract(max(cik), '([0-9]{{1,10}})', 1) AS n FROM docs GROUP BY 1),
  fl AS (SELECT year, 'raw/' || year || '/10-K/' || CASE WHEN n = '' THEN 'none_' ELSE n || '__' END || doc_id || '.txt' AS relpath, octet_length(encode(doc_id))::BIGINT AS b,
    CASE WHEN n = '' THEN 'unclassified' WHEN coalesce(nullif(ltrim(n, '0'), ''), '0') IN (SELECT cik FROM universe) THEN 'allowed' ELSE 'undesired' END AS k FROM g)"""


def _purge(spark: SparkSession, d: str, dry_run: bool) -> tuple[DataFrame, DataFrame]:
    """(files by class, log) of a purge that also has a file to delete that is not there any more."""
    root = local(spark)
    writers.write_payloads(_filing_files(spark, d), root).count()
    scanned = readers.purge_scan(spark, root).select("relpath", "year", "file_name", F.col("file_size_bytes").alias("size_bytes"))
    classified = stored(R.purge_candidates(scanned, universe(spark, d)))
    plan = R.deletion_plan(classified, not dry_run).select("relpath").unionByName(spark.createDataFrame([("raw/2001/10-K/gone.txt",)], "relpath string"))
    return classified, stored(writers.delete_files(plan, root, dry_run))


@query(f"""WITH {_FILES} SELECT relpath, unnest(['delete_started', 'deleted']) AS status, b AS size_bytes FROM fl WHERE k = 'undesired' UNION ALL SELECT 'raw/2001/10-K/gone.txt', 'missing_before_delete', NULL""")
def deletion_log(spark, d):
    return _purge(spark, d, False)[1]


@query(f"""WITH {_FILES} SELECT relpath, 'dry_run' AS status, b AS size_bytes FROM fl WHERE k = 'undesired' UNION ALL SELECT 'raw/2001/10-K/gone.txt', 'missing_before_delete', NULL""")
def deletion_dry_run(spark, d):
    return _purge(spark, d, True)[1]


@query(f"""WITH {_FILES} SELECT year, count(k) AS filing_files_scanned, count(*) FILTER (k = 'allowed') AS allowed_cik_files, count(*) FILTER (k = 'unclassified') AS unclassified_files_left_untouched,
  count(*) FILTER (k = 'undesired') AS undesired_files, coalesce(sum(b) FILTER (k = 'undesired'), 0)::BIGINT AS undesired_bytes, count(*) FILTER (k = 'undesired') AS deleted_files,
  coalesce(sum(b) FILTER (k = 'undesired'), 0)::BIGINT AS deleted_bytes, count(*) FILTER (k IS NULL) AS delete_failures FROM (SELECT year, b, k FROM fl UNION ALL SELECT '2001', NULL, NULL) GROUP BY ROLLUP (year)""")
def purge_run(spark, d):
    """The eight measures of a purge, per year and in total."""
    classified, log = _purge(spark, d, False)
    return R.purge_report(classified, log.select(F.split("relpath", "/")[1].alias("year"), "status", "size_bytes"))


@query("""SELECT form_folder, count(*) AS n, sum(b)::BIGINT AS bytes FROM (SELECT regexp_extract(source_relpath, '^raw/[^/]+/([^/]+)/', 1) AS form_folder, max(octet_length(encode(filing_id))) AS b FROM filings WHERE source_relpath IS NOT NULL GROUP BY filing_id, source_relpath)
  WHERE replace(form_folder, '_', ' ') IN ('10-K', '10-Q', '8-K', 'DEF 14A') GROUP BY 1""")
def form_folders(spark, d):
    """The inventory of the folders of the corpus's forms."""
    root, f = local(spark), table(spark, d, "filings").filter("source_relpath IS NOT NULL").select("filing_id", "source_relpath").distinct()
    path = F.regexp_replace("source_relpath", r"[^/]+$", "")
    writers.write_payloads(f.select(F.concat(path, F.col("filing_id"), F.lit(".txt")).alias("relpath"), F.encode("filing_id", "UTF-8").alias("content")), root).count()
    return readers.form_inventory(spark, root).groupBy("form_folder").agg(F.count("*").alias("n"), F.sum("file_size_bytes").alias("bytes"))


# ---- fetching


class Archive:
    """A transport without a network: what is answered follows from the url, and nothing is transient twice."""

    def __init__(self):
        self.asked: set[str] = set()

    def __call__(self, url: str) -> net.Response:
        kind = int(url.rpartition("/")[2]) % 6
        first = url not in self.asked
        self.asked.add(url)
        if kind == 5 and first:
            return net.Response(503, b"", "0")
        return (net.Response(404), net.Response(410), net.Response(200), net.Response(503, b"", "0"), net.Response(200, url.encode()), net.Response(200, url.encode()))[kind]


@query("""SELECT 'http://x/' || o_orderkey AS filing_url, unnest(['first', 'again']) AS run, (['404', '410', 'failed', 'failed', 'downloaded', 'downloaded'])[o_orderkey % 6 + 1] AS s,
    CASE WHEN s = 'downloaded' AND run = 'again' THEN 'exists' ELSE s END AS status, CASE WHEN status = 'downloaded' THEN length('http://x/' || o_orderkey) ELSE 0 END::BIGINT AS bytes_written,
    CASE WHEN status = 'exists' THEN 0 WHEN o_orderkey % 6 = 3 THEN 2 WHEN o_orderkey % 6 = 5 THEN 2 ELSE 1 END::INTEGER AS attempts,
    (['404 Client Error', '410 Client Error', 'empty body', 'HTTP 503', '', ''])[o_orderkey % 6 + 1] AS error_message FROM orders""".replace("SELECT 'http", "SELECT * EXCLUDE (s) FROM (SELECT 'http", 1) + ")")
def fetched_rows(spark, d):
    """Every order fetched, and fetched again: what is there is not asked for, what failed is."""
    key = F.col("o_orderkey").cast("string")
    rows = table(spark, d, "orders").select(F.concat(F.lit("http://x/"), key).alias("filing_url"), F.concat(F.lit("raw/2020/8-K/"), key, F.lit(".txt")).alias("output_path"))
    root = local(spark)
    one = stored(net.fetch(rows, root, Archive(), retries=1, interval=0.0, reserve=1)).withColumn("run", F.lit("first"))
    two = stored(net.fetch(rows, root, Archive(), retries=1, interval=0.0)).withColumn("run", F.lit("again"))
    return one.unionByName(two).select("filing_url", "run", "status", "bytes_written", "attempts", "error_message")


# ---- state


@query("""WITH f AS (SELECT source_relpath, filing_id, processed_at_utc, source_size_bytes, processing_status FROM filings WHERE source_relpath IS NOT NULL AND processed_at_utc IS NOT NULL)
  SELECT source_relpath, arg_min(filing_id, (processed_at_utc, filing_id)) AS filing_id, max(processed_at_utc) AS latest, arg_max(row(source_size_bytes, processing_status), (processed_at_utc, source_size_bytes::VARCHAR, processing_status)) AS r FROM f GROUP BY 1""".replace("SELECT source_relpath, arg_min", "SELECT source_relpath, filing_id, epoch_us(latest) AS processed_us, r[1] AS source_size_bytes, r[2] AS processing_status FROM (SELECT source_relpath, arg_min", 1) + ")")
def upserted_rows(spark, d):
    rows = table(spark, d, "filings").filter("processed_at_utc IS NOT NULL").select("source_relpath", "filing_id", "processed_at_utc", "source_size_bytes", "processing_status")
    return upsert_latest(rows).select("source_relpath", "filing_id", F.unix_micros("processed_at_utc").alias("processed_us"), "source_size_bytes", "processing_status")


@query("""WITH l AS (SELECT DISTINCT filing_id FROM filings WHERE year(processed_at_utc) >= 2020 AND filing_id IS NOT NULL)
  SELECT filing_id, former_name_id, former_name FROM former_names WHERE filing_id IS NULL OR filing_id NOT IN (SELECT filing_id FROM l)
  UNION ALL SELECT filing_id, former_name_id, upper(former_name) FROM former_names WHERE filing_id IN (SELECT filing_id FROM l)""")
def replaced_children(spark, d):
    """Former names after a batch that tells those of the filings processed since 2020 anew."""
    names = table(spark, d, "former_names").select("filing_id", "former_name_id", "former_name")
    ids = table(spark, d, "filings").filter("year(processed_at_utc) >= 2020").select("filing_id")
    batch = names.join(ids.distinct(), "filing_id", "left_semi").withColumn("former_name", F.upper("former_name"))
    return children_of(names, batch, ids)


@query("""WITH i AS (SELECT doc_id, relative_path, sha256, coalesce(encoding_status, '') = 'plain' AS safe FROM documents WHERE relative_path IS NOT NULL), p AS (SELECT relative_path, max(sha256) AS sha FROM documents WHERE relative_path IS NOT NULL AND lang IS NOT NULL GROUP BY 1)
  SELECT doc_id, CASE WHEN p.relative_path IS NULL THEN 'publish' WHEN p.sha IS NOT DISTINCT FROM i.sha256 THEN 'refresh' ELSE 'conflict' END AS action,
  CASE WHEN p.relative_path IS NOT NULL AND p.sha IS DISTINCT FROM i.sha256 THEN 'conflict' WHEN safe THEN 'processed_and_raw_deleted' ELSE 'processed_with_warnings_raw_retained' END AS status FROM i LEFT JOIN p USING (relative_path)""")
def publications(spark, d):
    """What is to be done with documents whose path may be published already, with the same or other content."""
    t = table(spark, d, "documents").filter("relative_path IS NOT NULL")
    incoming = t.select("doc_id", F.col("relative_path").alias("source_relpath"), F.col("sha256").alias("source_sha256"), (F.coalesce("encoding_status", F.lit("")) == "plain").alias("delete_safe"))
    there = t.filter("lang IS NOT NULL").select(F.col("relative_path").alias("source_relpath"), F.col("sha256").alias("source_sha256"))
    return publication(incoming, there, delete_raw=True).select("doc_id", "action", "status")


@query(f"""SELECT shard, count(*) AS n, sum(b)::BIGINT AS bytes FROM (SELECT b, CASE WHEN place // 8 % 2 = 0 THEN place % 8 ELSE 7 - place % 8 END::INTEGER AS shard FROM
  (SELECT coalesce(size_bytes, 0) AS b, row_number() OVER (ORDER BY coalesce(size_bytes, 0) DESC, doc_id) - 1 AS place FROM documents)) GROUP BY 1""")
def size_shards(spark, d):
    """Files dealt out to shards of nearly equal size, the largest first."""
    return R.size_shards(table(spark, d, "documents").select("doc_id", "size_bytes"), 8, "doc_id", "size_bytes").groupBy("shard").agg(F.count("*").alias("n"), F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"))


@query("SELECT 8::BIGINT AS shards, count(*) AS n, sum(size_bytes)::BIGINT AS bytes FROM documents")
def shard_totals(spark, d):
    dealt = R.size_shards(table(spark, d, "documents").select("doc_id", "size_bytes"), 8, "doc_id", "size_bytes").groupBy("shard").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))
    return R.shard_totals(dealt, "shard", "n", "bytes")


_COLUMNS = ", ".join(f"('{t}', {k}, '{c.split()[0]}', '{c.split()[1]}')" for t, cs in tables.TABLES.items() for k, c in enumerate(cs.split(", ")))


@query(f"SELECT * FROM (VALUES {_COLUMNS}) t(table_name, position, column_name, data_type)")
def catalogue_columns(spark, d):
    """The columns of the store's tables as the catalogue has them."""
    return tables.columns(spark, tables.create_tables(spark, local(spark), "filings_store_" + local(spark)[-8:]))


# ---- streams


#: Folders of streamed_filings, each with a stream.
STREAMS = 4


@query("SELECT 'raw/2020/8-K/' || doc_id || '.txt' AS source_relpath, '8-K' AS form_type, octet_length(encode('<DOCUMENT>' || chr(10) || '<TEXT>' || chr(10) || text || chr(10) || '</TEXT>' || chr(10) || '</DOCUMENT>' || chr(10)))::BIGINT AS source_size_bytes FROM documents WHERE text IS NOT NULL")
def streamed_filings(spark, d):
    """Submissions taken in by streams in batches of bounded size, in two runs; the second reads no file of the first again. They lie in
    a few folders with a stream each, since a stream takes one batch after another."""
    root, t = local(spark), table(spark, d, "documents").filter("text IS NOT NULL")
    name = F.concat(F.lit("raw/2020/8-K/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    content = F.encode(F.concat(F.lit("<DOCUMENT>\n<TEXT>\n"), F.col("text"), F.lit("\n</TEXT>\n</DOCUMENT>\n")), "UTF-8")
    files = t.select(F.crc32(name).alias("h"), name.alias("name"), content.alias("content"))
    placed = files.select("h", F.concat_ws("/", F.floor(F.col("h") / 2) % STREAMS, "name").alias("relpath"), "content")
    tasks = max(1, spark.sparkContext.defaultParallelism // STREAMS)
    for run in range(2):
        writers.write_payloads(placed.filter(F.col("h") % 2 == run), f"{root}/in").count()
        incremental.await_all([incremental.stream_submissions(spark, f"{root}/in/{k}", f"{root}/out", f"{root}/checkpoint/{k}", 400, f"{k}_", tasks) for k in range(STREAMS)])
    return incremental.current_state(spark, f"{root}/out").select("source_relpath", "form_type", "source_size_bytes")
