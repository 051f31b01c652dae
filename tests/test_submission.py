import base64
import binascii
import hashlib
import io
import zipfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import submission as P

HEADER = b"""<SEC-DOCUMENT>0001.txt : 20200102
<SEC-HEADER>0001.hdr.sgml : 20200102
<ACCEPTANCE-DATETIME>20200102030405
ACCESSION NUMBER:\t\t0001-20-1
CONFORMED SUBMISSION TYPE:\t8-K
ITEM INFORMATION:\t\tOther Events
ITEM INFORMATION:\t\tExhibits
FILED AS OF DATE:\t\t20200102
FILER:
\tCOMPANY DATA:
\t\tCOMPANY CONFORMED NAME:\t\tA CO
\t\tCENTRAL INDEX KEY:\t\t0000012345
\tBUSINESS ADDRESS:
\t\tSTREET 1:\t1 MAIN ST
\t\tZIP:\t\t12345
\tFORMER COMPANY:
\t\tFORMER CONFORMED NAME:\tOLD CO
\t\tDATE OF NAME CHANGE:\t19990101
\tFORMER COMPANY:
\t\tSOMETHING ELSE:\tX
FILER:
\tCOMPANY DATA:
\t\tCENTRAL INDEX KEY:\t\t0000000777
</SEC-HEADER>
"""


def doc(body, kind=b"8-K", name=b"a.txt", close=b"</TEXT>\n"):
    return b"<DOCUMENT>\n<TYPE>" + kind + b"\n<SEQUENCE>1\n<FILENAME>" + name + b"\n<TEXT>\n" + body + close + b"</DOCUMENT>\n"


def test_header_fields_and_contexts():
    r = P.parse_submission(HEADER + doc(b"hello\r\n\xff\n") + b"</SEC-DOCUMENT>\n", "8-K")
    assert r["filing"]["cik"] == "0000000777" and r["filing"]["accession_number"] == "0001-20-1"  # several filers: the last wins
    assert [(f["section"], f["field_value"], f["occurrence"]) for f in r["header_fields"] if f["field_name"] == "CENTRAL INDEX KEY"] == [("company_data", "0000012345", 0), ("company_data", "0000000777", 1)]
    assert r["items"] == ["Other Events", "Exhibits"] and r["former_names"] == [{"former_name": "OLD CO", "date_of_name_change": "19990101"}]
    assert r["addresses"] == [{"address_kind": "business", "street1": "1 MAIN ST", "street2": None, "city": None, "state": None, "postal_code": "12345", "phone": None}]
    d = r["documents"][0]
    assert d["body"] == b"hello\r\n\xff\n" and d["sha256"] == hashlib.sha256(d["body"]).hexdigest() and r["warnings"] == [] and r["delete_safe"]


def test_malformed_submissions():
    with pytest.raises(ValueError):
        P.parse_submission(HEADER)
    with pytest.raises(ValueError):
        P.parse_submission(HEADER + b"<DOCUMENT>\n<TYPE>8-K\n</DOCUMENT>\n")
    with pytest.raises(ValueError):
        P.parse_submission(HEADER + doc(b"x"), "10-K")
    unclosed = P.parse_submission(doc(b"x\n", close=b""))
    assert unclosed["documents"][0]["body"] == b"x\n</DOCUMENT>\n" and "SEC-HEADER block not found" in unclosed["warnings"]
    end = P.parse_submission(b"<DOCUMENT>\n<TYPE>X\n<TEXT>\nabc")
    assert end["documents"][0]["body"] == b"abc" and any("EOF" in w for w in end["warnings"]) and not end["delete_safe"]
    twice = P.parse_submission(b"<DOCUMENT>\n<TEXT>\none\n</TEXT>\n<TEXT>\ntwo\n</TEXT>\n<FILENAME>late.txt\n</DOCUMENT>\n")
    assert twice["documents"][0]["body"] == b"two\n" and twice["documents"][0]["filename"] == "late.txt"
    with pytest.raises(ValueError):  # an unclosed header takes the rest
        P.parse_submission(HEADER.replace(b"</SEC-HEADER>\n", b"") + doc(b"x"))
    missing = P.parse_submission(doc(b"x\n") + b"<DOCUMENT>\n<TYPE>EX-1\n</DOCUMENT>\n")
    assert [d["encoding_status"] for d in missing["documents"]] == ["plain", "no_text_block"]


def test_uuencoded_bodies():
    raw = bytes(range(90))
    lines = b"".join(binascii.b2a_uu(raw[k : k + 45]) for k in (0, 45))
    d = P.parse_submission(doc(b"begin 644 x.bin\n" + lines + b"`\nend\n"))["documents"][0]
    assert (d["body"], d["encoding_status"]) == (raw, "uuencoded")
    d = P.parse_submission(doc(b"begin 644 x.bin\n" + b"\x80\x81not uu\n"))["documents"][0]
    assert d["encoding_status"] == "uuencoded_decode_failed_kept_original" and d["body"].startswith(b"begin")


def archive(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def test_archives():
    members = P.zip_members(archive(("a/b.txt", b"one"), ("c.txt", b"three")), "extracted/0001_x")
    assert [(m["member_name"], m["extracted_path"], m["size_bytes"]) for m in members] == [("a/b.txt", "extracted/0001_x/a/b.txt", 3), ("c.txt", "extracted/0001_x/c.txt", 5)]
    link = zipfile.ZipInfo("l")
    link.external_attr = 0o120777 << 16
    for bad in (archive(("../x", b"")), archive(("/x", b"")), archive(("C:/x", b"")), archive(("A.txt", b""), ("a.txt", b"")), archive((link, b"t")), archive(("a//b", b""))):
        with pytest.raises(ValueError):
            P.zip_members(bad, "f")
    with pytest.raises(ValueError):
        P.zip_members(archive(("a", b"12345")), "f", max_bytes=4)
    with pytest.raises(ValueError):
        P.zip_members(archive(("a", b""), ("b", b"")), "f", max_members=1)
    text = base64.b64encode(b"no archive").decode().encode()
    d = P.parse_submission(doc(text, name=b"x.zip"))
    assert d["documents"][0]["zip_error"] and not d["delete_safe"]


def test_tables_of_submissions(spark):
    zipped = binascii.hexlify(archive(("m.txt", b"hi")))
    files = [("raw/2020/8-K/a.txt", HEADER + doc(b"x\n") + doc(binascii.unhexlify(zipped), b"ZIP", b"z.zip", b"\n</TEXT>\n") + b"</SEC-DOCUMENT>\n"), ("raw/2020/10-K/b.txt", HEADER + doc(b"x\n")), ("c.txt", None)]
    parsed = P.parse_submissions(spark.createDataFrame(files, "relpath string, content binary"))
    filings = P.filings_table(parsed)
    f = filings.collect()
    assert [(r.source_relpath, r.cik, r.filed_as_of_date, r.processing_status) for r in f] == [("raw/2020/8-K/a.txt", "777", "2020-01-02", "complete")]
    t = P.children(filings)
    assert {n: df.count() for n, df in t.items()} == {"header_fields": 12, "company_data": 1, "addresses": 1, "former_names": 1, "filing_items": 2, "documents": 2, "archive_members": 1, "processing_warnings": 0}
    assert rows(t["archive_members"].select("member_name", "size_bytes")) == [("m.txt", 2)]
    assert sorted(rows(P.errors(parsed).select("relpath", "error_type"))) == [("c.txt", "ValueError"), ("raw/2020/10-K/b.txt", "ValueError")]


def test_text_records_and_the_primary_document(spark):
    body = b"the line after the TEXT tag goes with it\n<p>Tom &amp; <b>Ann</b></p><script>x()</script>&lt;i&gt;y&lt;/i&gt; caf\xe9\n\n\n\nItem 2.02 results"
    data = HEADER.replace(b"<ACCEPTANCE-DATETIME>", b"ACCEPTANCE-DATETIME: ") + doc(b"exhibit", b"EX-99") + doc(body, b"8-K", b"main.htm") + doc(b"longer than all the others " * 20, b"10-Q")
    df = spark.createDataFrame([("raw/2020/8-K/a.txt", data), ("raw/2020/8-K/b.txt", b"plain text"), ("raw/2020/DEF_14A/c.txt", doc(b"short", b"EX-1") + doc(b"a longer one", b"GRAPHIC") + doc(b"chosen", b"OTHER"))], "relpath string, content binary")
    universe = spark.createDataFrame([("12345",)], "cik string")
    out = {r.relpath[-5:]: r for r in P.text_record(df, universe).collect()}
    a = out["a.txt"]
    assert (a.cik, a.form_type, a.filing_date, a.acceptance_datetime, a.accession, a.primary_doc_filename) == ("12345", "8-K", "2020-01-02", "20200102030405", "0001-20-1", "main.htm")
    assert a.clean_text == "Tom & Ann y café\n\nItem 2.02 results" and a.section_hint_count == 1 and a.is_company_in_universe == 1 and a.clean_text_words == 8
    assert out["b.txt"].clean_text == "plain text" and out["b.txt"].status == "ok"
    assert out["c.txt"].form_type == "DEF 14A" and out["c.txt"].primary_doc_type == "OTHER" and len(out["c.txt"].doc_id) == 16
    assert F is not None
