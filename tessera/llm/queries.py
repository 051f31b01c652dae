"""Queries of the training-data problems p4 to p9."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.codes import plain_cik
from tessera.functions.timeparse import normal_date
from tessera.llm import addresses, encoding, mixing, sampling, splitting, tokens
from tessera.plans import time_sql
from tessera.session import spread, table

#: A parameter table read by the driver has at most so many rows.
MAX_PARAMETERS = 10_000


def texts(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Documents for work that is heavy per text."""
    return spread(table(spark, d, "documents").select("doc_id", "text", *columns))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs, _, _ = addresses.place_pairs(table(spark, d, "addresses"))
    return pairs.select(F.col("a_id").alias("address_id_a"), F.col("b_id").alias("address_id_b"))


def p4_places(spark: SparkSession, d: str) -> DataFrame:
    return addresses.places(table(spark, d, "addresses"))


def _limit(spark: SparkSession, d: str) -> Column:
    rows = table(spark, d, "size_limits").select("document_type", "max_bytes", "overlap_bytes").filter("document_type IS NOT NULL").limit(MAX_PARAMETERS + 1).collect()
    if len(rows) > MAX_PARAMETERS:
        raise ValueError(f"over {MAX_PARAMETERS} limits")
    return splitting.limits_of(F.col("document_type"), [tuple(r) for r in rows])


def _pieces(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    return splitting.split(texts(spark, d, "relative_path", "document_type"), ["doc_id", "relative_path"], "text", _limit(spark, d), with_text)


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d, True)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d, False).filter("piece = 0 AND pieces > 1").select("doc_id")


def p5_rejoined(spark: SparkSession, d: str) -> DataFrame:
    """Per document what its pieces tell: that they are numbered, within the limit, overlap as they should and make up the text."""
    fresh = F.decode(F.substring(F.encode("piece_text", "UTF-8"), F.col("overlap_bytes").cast("int") + 1, F.octet_length("piece_text")), "UTF-8")
    told = F.struct("piece", "pieces", "start_byte", "end_byte", "overlap_bytes", F.octet_length("piece_text").alias("bytes"), fresh.alias("fresh"))
    # The pieces of one document, and so one text, in a row.
    whole = _pieces(spark, d, True).groupBy("doc_id").agg(F.array_sort(F.collect_list(told)).alias("p"))
    limits = table(spark, d, "documents").select("doc_id", _limit(spark, d)["max_bytes"].alias("most"), _limit(spark, d)["overlap_bytes"].alias("overlap"))
    fits = F.forall("p", lambda x: (x["bytes"] == x["end_byte"] - x["start_byte"]) & ((x["bytes"] <= F.col("most")) | (F.col("n") == 1) & F.col("most").isNull()))
    in_turn = F.forall("p", lambda x: x["pieces"] == F.col("n")) & F.forall(F.sequence(F.lit(1), F.col("n")), lambda k: F.get("p", k - 1)["piece"] == k - 1)
    overlaps = F.forall("p", lambda x: F.when(x["piece"] == 0, x["overlap_bytes"] == 0).otherwise(x["overlap_bytes"].between(F.col("overlap") - 3, F.col("overlap"))))
    return whole.join(limits, "doc_id").withColumn("n", F.size("p")).select(
        "doc_id", fits.alias("fits"), in_turn.alias("in_turn"), overlaps.alias("overlaps"), F.md5(F.array_join(F.transform("p", lambda x: x["fresh"]), "")).alias("text_md5")
    )


def filing_items(filings: DataFrame) -> DataFrame:
    """(item, category, company, year): one row per filing, whatever its repeated rows leave out."""
    rows = filings.filter("filing_id IS NOT NULL").select(
        "filing_id", sampling.category_key(F.col("form_type")).alias("category"), plain_cik(F.col("cik")).alias("company"), F.year(normal_date(F.col("filed_as_of_date"))).alias("year")
    )
    return rows.groupBy(F.col("filing_id").alias("item")).agg(F.max("category").alias("category"), F.max("company").alias("company"), F.max("year").alias("year"))


def _sample(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return sampling.sample(filing_items(table(spark, d, "filings")), table(spark, d, "sample_targets"))


def p6_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[0].select("period_label", "form_type", F.col("item").alias("filing_id"), F.col("company").alias("cik"))


def p6_shortfalls(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[1]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d)[1].filter("short").select("period_label", "form_type")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return texts(spark, d).select("doc_id", tokens.encode(F.col("text"), tokens.vocabulary(spark)).alias("ids"))


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Per document: whether its ids decode to the text, and whether the spans of the tokens cover it without gaps."""
    words = tokens.vocabulary(spark)
    coded = texts(spark, d).select("doc_id", "text", tokens.encode_with_spans(F.col("text"), words).alias("t")).select("doc_id", "text", "t.*")
    length = F.coalesce(F.length("text"), F.lit(0))
    # A token begins where the one before ends, or within the character that both hold bytes of.
    joined = F.forall(F.sequence(F.lit(1), F.greatest(F.size("starts") - 1, F.lit(1))), lambda k: F.coalesce(F.get("starts", k).between(F.get("ends", k - 1) - 1, F.get("ends", k - 1)), F.lit(True)))
    covered = (F.coalesce(F.array_min("starts"), F.lit(0)) == 0) & (F.coalesce(F.array_max("ends"), F.lit(0)) == length) & joined
    return coded.select("doc_id", (tokens.decode(F.col("ids"), words) == F.coalesce("text", F.lit(""))).alias("restored"), covered.alias("covered"))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, d, "mix_targets")
    sized = mixing.sized_documents(texts(spark, d, "source"), targets, tokens.count_tokens(F.col("text"), tokens.vocabulary(spark)))
    return mixing.mix(sized, targets)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[1].filter("short").select("source")


def _mix_of_bytes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The same mix sized in bytes of text, four for each token of the targets: what SQL can follow."""
    targets = table(spark, d, "mix_targets").withColumn("total_tokens", F.col("total_tokens") * 4)
    sized = table(spark, d, "documents").select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_tokens"))
    return mixing.mix(sized, targets)


def p8_mix_of_bytes(spark: SparkSession, d: str) -> DataFrame:
    return _mix_of_bytes(spark, d)[0]


def p8_shares_of_bytes(spark: SparkSession, d: str) -> DataFrame:
    return _mix_of_bytes(spark, d)[1]


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.find_garbled(texts(spark, d), ["doc_id"])


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.find_garbled(texts(spark, d), ["doc_id"], with_text=False).select("doc_id")


QUERIES = {
    "p4_found": p4_found, "p4_places": p4_places, "p5_found": p5_found, "p5_pieces": p5_pieces, "p5_rejoined": p5_rejoined, "p6_found": p6_found, "p6_sample": p6_sample, "p6_shortfalls": p6_shortfalls,
    "p7_ids": p7_ids, "p7_roundtrip": p7_roundtrip, "p8_found": p8_found, "p8_mix": p8_mix, "p8_shares": p8_shares, "p8_mix_of_bytes": p8_mix_of_bytes, "p8_shares_of_bytes": p8_shares_of_bytes,
    "p9_found": p9_found, "p9_restored": p9_restored,
}

_FORM = "nullif(regexp_replace(upper({}), '[^A-Z0-9/]', '', 'g'), '')"
# Ends with i: the filings that count, with company, form and day.
_ITEMS = f"""{time_sql.FILED}, f AS (SELECT filing_id, max({time_sql.CIK.format('cik')}) AS cik, max({_FORM.format('form_type')}) AS form FROM filings WHERE filing_id IS NOT NULL GROUP BY 1),
  i AS (SELECT * FROM f JOIN filed USING (filing_id) WHERE cik IS NOT NULL AND form IS NOT NULL AND day IS NOT NULL)"""

_CELLS = f"""{_ITEMS}, t AS (SELECT *, {_FORM.format('form_type')} AS cat, greatest(min_rows, (target_pct * sample_size + 99) // 100) AS wanted FROM sample_targets),
  x AS (SELECT t.period_label, t.cat, i.cik, i.filing_id, substr(md5('11|' || i.filing_id), 1, 15) AS mark, t.company_cap FROM t JOIN i ON i.form = t.cat AND year(i.day) BETWEEN t.first_year AND t.last_year),
  k AS (SELECT *, row_number() OVER (PARTITION BY period_label, cat, cik ORDER BY mark, filing_id) <= company_cap AS fits FROM x),
  n AS (SELECT period_label, cat, count(*) AS seen, count(*) FILTER (fits) AS available FROM k GROUP BY 1, 2),
  c AS (SELECT t.*, coalesce(seen, 0) AS seen, coalesce(available, 0) AS available FROM t LEFT JOIN n USING (period_label, cat))"""
# The places of a sample dealt one by one: minima, then wanted numbers, then what is left, by highest averages.
_QUOTAS = f"""{_CELLS}, u AS (SELECT period_label, cat, sample_size, min_rows, wanted, target_pct, unnest(range(1, least(available, sample_size) + 1)) AS k FROM c),
  o AS (SELECT period_label, cat, row_number() OVER (PARTITION BY period_label ORDER BY CASE WHEN k <= min_rows THEN 0 WHEN k <= wanted THEN 1 ELSE 2 END,
    CASE WHEN k <= min_rows THEN k / min_rows::DOUBLE ELSE (2 * k - 1) / target_pct::DOUBLE END, cat) AS turn, sample_size FROM u WHERE k <= min_rows OR target_pct > 0),
  q AS (SELECT period_label, cat, count(*) AS quota FROM o WHERE turn <= sample_size GROUP BY 1, 2)"""

_SOURCE = "lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g'))"
# Ends with e: every document of a wanted source with its place and copies.
_MIX = f"""w AS (SELECT {_SOURCE} AS key, min(source) AS src, max(target_pct)::BIGINT AS pct, max(max_repeats)::BIGINT AS repeats, (max(total_tokens) * 4)::BIGINT AS total FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
  d AS (SELECT doc_id, key, n, substr(md5('7|' || doc_id), 1, 15) AS mark, length(bin(n + 1)) - 1 AS octave FROM (SELECT doc_id, {_SOURCE} AS key, coalesce(octet_length(encode(text)), 0)::BIGINT AS n FROM documents) JOIN w USING (key)),
  z AS (SELECT key, sum(n)::BIGINT AS tokens, count(*) AS documents FROM d GROUP BY 1),
  r AS (SELECT w.*, coalesce(tokens, 0) AS tokens, coalesce(documents, 0) AS documents, CASE WHEN tokens > 0 THEN least(repeats::DOUBLE, (pct * total / 100) / tokens) ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('7|offset|' || key), 1, 15))::BIGINT / pow(2.0::DOUBLE, 60) AS offs FROM w LEFT JOIN z USING (key)),
  p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY 4 * octave + floor((n + 1) * 4 / pow(2.0::DOUBLE, octave)), mark, doc_id) AS place FROM d JOIN r USING (key)),
  e AS (SELECT *, (CASE WHEN rate >= repeats THEN repeats ELSE least(floor(rate * place + offs) - floor(rate * (place - 1) + offs), repeats) END)::INTEGER AS copies FROM p)"""

SQL: dict[str, str] = {
    "p5_rejoined": "SELECT doc_id, true AS fits, true AS in_turn, true AS overlaps, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL",
    "p7_roundtrip": "SELECT doc_id, true AS restored, true AS covered FROM documents",
    "p8_mix_of_bytes": f"WITH {_MIX} SELECT doc_id, src AS source, n AS n_tokens, unnest(range(1, copies + 1))::INTEGER AS copy FROM e WHERE copies > 0",
    "p8_shares_of_bytes": f"""WITH {_MIX}, m AS (SELECT key, sum(n * copies)::BIGINT AS mixed FROM e GROUP BY 1), a AS (SELECT r.*, coalesce(mixed, 0) AS mixed FROM r LEFT JOIN m USING (key))
      SELECT src AS source, pct * total / 100 AS target_tokens, tokens AS available_tokens, documents, rate, mixed AS mixed_tokens, pct / 100 AS target_share,
      coalesce(mixed / nullif(sum(mixed) OVER ()::BIGINT, 0), 0.0::DOUBLE) AS actual_share, tokens * repeats * 100 < pct * total AS short FROM a""",
    "p6_found": f"WITH {_CELLS} SELECT period_label, form_type FROM c WHERE available < wanted",
    "p6_sample": f"""WITH {_QUOTAS}, r AS (SELECT period_label, cat, filing_id, cik, row_number() OVER (PARTITION BY period_label, cat ORDER BY mark, filing_id) AS place FROM k WHERE fits)
      SELECT period_label, form_type, filing_id, cik FROM r JOIN q USING (period_label, cat) JOIN (SELECT period_label, cat, form_type FROM t) USING (period_label, cat) WHERE place <= quota""",
    "p6_shortfalls": f"""WITH {_QUOTAS} SELECT period_label, form_type, wanted, coalesce(quota, 0) AS quota, seen, available, coalesce(quota, 0) AS sampled, available < wanted AS short, greatest(wanted - coalesce(quota, 0), 0) AS unmet
      FROM c LEFT JOIN q USING (period_label, cat)""",
    "p5_found": """WITH l AS (SELECT upper(trim(document_type)) AS t, max_bytes FROM size_limits), m AS (SELECT doc_id, octet_length(encode(text)) AS b,
      (SELECT arg_max(max_bytes, length(t)) FROM l WHERE t <> 'OTHER' AND starts_with(upper(trim(coalesce(document_type, ''))), t)) AS own FROM documents WHERE text IS NOT NULL)
      SELECT doc_id FROM m WHERE b > coalesce(own, (SELECT max_bytes FROM l WHERE t = 'OTHER'))""",
}
