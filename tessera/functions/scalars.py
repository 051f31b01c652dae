"""Scalar functions of the filing domain as Column expressions; all run in the JVM but for the two Arrow ones at the end."""

from __future__ import annotations

import hashlib
import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The forms of the corpus, in reporting order, and the default weights of a balanced set.
FORM_ORDER = ("10-K", "10-Q", "8-K", "DEF 14A")
FORM_WEIGHTS = {"10-K": 0.30, "10-Q": 0.30, "8-K": 0.30, "DEF 14A": 0.10}
#: Java's \s and \w are ASCII unless told otherwise; strip means what Unicode calls white space.
_OUTER = r"(?U)\A\s+|\s+\z"


def strip(c: Column) -> Column:
    """Outer white space of any kind removed (``trim`` only removes blanks)."""
    return F.regexp_replace(c, _OUTER, "")


def _no_zeros(c: Column) -> Column:
    return F.regexp_replace(c, "^0+", "")


def cik_loose(c: Column) -> Column:
    """Digits lose leading zeros (all zeros: "0"), other texts stay, null gives ""."""
    s = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(s.rlike(r"^[0-9]+$"), F.coalesce(F.nullif(_no_zeros(s), F.lit("")), F.lit("0"))).otherwise(s)


def cik_strict(c: Column) -> Column:
    """As :func:`cik_loose`, but anything that is not a number gives ""."""
    s = cik_loose(c)
    return F.when(s.rlike(r"^[0-9]+$"), s).otherwise(F.lit(""))


def cik_any(c: Column) -> Column:
    """Leading zeros cut off any text; null gives ""."""
    return _no_zeros(strip(F.coalesce(c.cast("string"), F.lit(""))))


def cik_or_null(c: Column) -> Column:
    """As stored with a parsed filing: leading zeros cut, nothing left gives null."""
    return F.nullif(cik_any(c), F.lit(""))


def padded_cik(c: Column) -> Column:
    """Ten digits at least; longer values are never cut (``lpad`` would)."""
    s = strip(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(F.length(s) < 10, F.lpad(s, 10, "0")).otherwise(s)


def form_key(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def sanitize_filename(c: Column, max_len: int = 200) -> Column:
    s = F.substring(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "[^A-Za-z0-9._-]+", "_"), 1, max_len)
    return F.coalesce(F.nullif(F.regexp_replace(s, "^_+|_+$", ""), F.lit("")), F.lit("unknown"))


def safe_filename(c: Column, fallback: str = "document.txt", max_len: int = 180) -> Column:
    last = F.element_at(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", "/"), "/"), -1)
    s = F.regexp_replace(F.regexp_replace(last, "[^A-Za-z0-9._() -]+", "_"), "^[ .]+|[ .]+$", "")
    return F.substring(F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback)), 1, max_len)


def base_name(c: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(c, r"\\", "/"), "/"), -1)


def accession_of(filename: Column) -> Column:
    return F.regexp_replace(base_name(filename), r"\.txt$", "")


def index_url(year: Column, quarter: Column, root: str = "https://www.sec.gov/Archives/edgar/full-index") -> Column:
    return F.format_string(f"{root}/%d/QTR%d/master.idx", year, quarter)


def index_path(year: Column, quarter: Column, root: str = "index") -> Column:
    """Where the index of a quarter is kept: ``<root>/<year>/QTR<quarter>/master.idx``."""
    return F.format_string(f"{root}/%d/QTR%d/master.idx", year, quarter)


def filing_path(form: Column, cik: Column, date_filed: Column, filename: Column, company: Column) -> Column:
    """``raw/<year>/<form>/<cik, ten digits>__<date>__<accession>__<company>.txt``."""
    name = F.concat_ws("__", padded_cik(cik), date_filed, accession_of(filename), sanitize_filename(company))
    return F.concat_ws("/", F.lit("raw"), F.substring(date_filed, 1, 4), sanitize_filename(form), F.concat(name, F.lit(".txt")))


def path_parts(c: Column) -> Column:
    """struct(parts, error) of a relative path below ``raw``: Windows or POSIX, never absolute, with a drive or with ``..``."""
    s = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", "/"))
    parts = F.filter(F.split(s, "/"), lambda p: ~p.isin("", "."))
    inner = F.when(F.lower(F.try_element_at(parts, F.lit(1))) == "raw", F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)
    error = (
        F.when(s == "", "empty").when(s.startswith("/"), "absolute").when(F.array_contains(parts, ".."), "unsafe")
        .when(F.try_element_at(parts, F.lit(1)).contains(":"), "drive").when(F.size(inner) < 3, "structure")
    )
    return F.struct(F.when(error.isNull(), inner).alias("parts"), error.alias("error"))


def year_and_folder(c: Column) -> Column:
    """struct(year, folder) of a path of at least three parts below ``raw``; else both empty."""
    parts = path_parts(c)["parts"]
    at = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k)), F.lit(""))
    return F.struct(at(1).alias("year"), at(2).alias("folder"))


def canonical_form(folder: Column) -> Column:
    return F.replace(folder, F.lit("_"), F.lit(" "))


def iso_date(c: Column) -> Column:
    """yyyymmdd as yyyy-mm-dd; anything else unchanged (no calendar check)."""
    s = strip(c)
    return F.when(s.rlike("^[0-9]{8}$"), F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))).otherwise(c)


def year_between(c: Column, first: int, last: int) -> Column:
    """Whether the first four characters are a year in the range; false where they are none."""
    return F.coalesce(F.substring(strip(c), 1, 4).try_cast("int").between(first, last), F.lit(False))


def cik_of_file(name: Column) -> Column:
    """The company number a file name starts with, "" where it does not."""
    return cik_strict(F.regexp_extract(name, "^([0-9]{1,10})__", 1))


def decode_text(raw: Column) -> Column:
    """UTF-8 where valid, else Latin-1."""
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), F.decode(raw, "ISO-8859-1"))


# What counts as markup, white space and a word in cleaned texts.
def normalize_space(c: Column) -> Column:
    s = F.regexp_replace(F.replace(c, F.lit("\x00"), F.lit(" ")), "\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(s, "[ \t\f\\x0B]+", " "), "\n{3,}", "\n\n"))


def strip_tags(c: Column) -> Column:
    for pattern in (r"(?is)<script.*?>.*?</script>", r"(?is)<style.*?>.*?</style>", r"(?is)<!--.*?-->", r"(?is)<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    return c


def clean_text(c: Column) -> Column:
    """Readable text of a filing body: entities first, then tags, leftovers and spaces."""
    s = strip_tags(unescape_html(c))
    s = F.regexp_replace(s, r"(?imd)^\s*<[^>\n]+>\s*$", " ")
    return normalize_space(F.regexp_replace(s, "[ ​]+", " "))


def count_words(c: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?U)\b\w+\b"), F.lit(0))).cast("bigint")


def words(c: Column) -> Column:
    """White-space separated words."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def section_hints(c: Column) -> Column:
    """How many mentions like "item 7a" or "item 2.02"."""
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?iU)\bitem\s+[0-9]{1,2}[a-z]?(?:\.[0-9]{2})?\b"), F.lit(0))).cast("bigint")


# Header patterns, tried in order.
HEADER_PATTERNS = {
    "cik": (r"CENTRAL INDEX KEY:\s*([0-9]+)", r"CIK:\s*([0-9]+)"),
    "entity_name": (r"COMPANY CONFORMED NAME:\s*(.+)", r"COMPANY:\s*(.+)", r"CONFORMED NAME:\s*(.+)"),
    "form_type": (r"CONFORMED SUBMISSION TYPE:\s*([^\n<]+)", r"FORM TYPE:\s*([^\n<]+)"),
    "filing_date": (r"FILED AS OF DATE:\s*([0-9]{8})", r"FILING DATE:\s*([0-9]{8})"),
    "period_of_report": (r"CONFORMED PERIOD OF REPORT:\s*([0-9]{8})", r"PERIOD OF REPORT:\s*([0-9]{8})"),
    "acceptance_datetime": (r"ACCEPTANCE-DATETIME[:>]\s*([0-9]{14})",),
    "accession": (r"ACCESSION NUMBER:\s*([0-9-]+)",),
}
HEADER_WINDOW = 250_000  # the header is looked for in the first part of a submission


def header_value(text: Column, field: str) -> Column:
    window = F.substring(text, 1, HEADER_WINDOW)
    found = [F.nullif(strip(F.regexp_extract(window, f"(?id){p}", 1)), F.lit("")) for p in HEADER_PATTERNS[field]]
    return F.coalesce(*found, F.lit(""))


def form_candidates(form: Column) -> Column:
    f = form_key(form)
    return F.array_distinct(F.array(f, F.replace(f, F.lit("/A"), F.lit("")), F.replace(f, F.lit(" "), F.lit("")), F.replace(f, F.lit(" "), F.lit("_"))))


def filing_id(relpath: Column, accession: Column, cik: Column) -> Column:
    return F.sha2(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in (relpath, accession, cik))), 256)


def human_bytes(n: Column) -> Column:
    units = ("B", "KB", "MB", "GB", "TB")
    # Halves go to the even digit; the formatter alone would round them up.
    shown = [F.format_string(f"%.2f {u}", F.bround(n / 1024.0**k, 2)) for k, u in enumerate(units)]
    out = F.when(n < 1024.0, shown[0])
    for k in range(1, len(units) - 1):
        out = out.when(n < 1024.0 ** (k + 1), shown[k])
    return F.when(n.isNotNull(), out.otherwise(shown[-1]))


def elapsed_text(seconds: Column) -> Column:
    s = seconds.cast("double")
    return F.when(s < 60, F.format_string("%.1fs", F.bround(s, 1))).when(s < 3600, F.format_string("%.1fm", F.bround(s / 60, 1))).when(s.isNotNull(), F.format_string("%.2fh", F.bround(s / 3600, 2)))


def seeded_order(seed: int, *cols: Column) -> Column:
    """A reproducible random order: text that sorts as if shuffled."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)))


@F.arrow_udf(T.StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())


def unescape_html(c: Column) -> Column:
    return _unescape(c)


@F.arrow_udf(T.StringType())
def _blake(rows: pa.Array) -> pa.Array:
    out = []
    for parts in rows.to_pylist():
        h = hashlib.blake2b(digest_size=16)
        for p in parts:
            h.update((p or "").encode() + b"\x1f")
        out.append(h.hexdigest()[:16])
    return pa.array(out, pa.string())


def hash_id(*parts: Column) -> Column:
    """16 hex digits of BLAKE2b over the parts, compatible with identifiers made elsewhere."""
    return _blake(F.array(*(p.cast("string") for p in parts)))
