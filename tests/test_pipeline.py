import re
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F
from test_submission import HEADER, doc

from tessera.operators.sections import chunks_or_whole
from tessera.operators.upsert import publication
from tessera.plans import pipeline


def test_manifest_and_decomposition(spark):
    lines = spark.createDataFrame([("CIK|Company Name|Form Type|Date Filed|Filename",), ("-----",), ("320| A, Co. |8-k|2020-01-02|edgar/data/1.txt",), ("321|B|8-K|2020-01-02|edgar/data/2.txt",), ("320|A|S-1|2020-01-02|edgar/data/3.txt",)], "value string")
    out = pipeline.manifest(lines, spark.createDataFrame([("320",)], "cik string"))
    assert rows(out.select("form_type", "output_path")) == [("8-K", "raw/2020/8-K/0000000320__2020-01-02__1__A_Co..txt")]
    t = pipeline.decompose(spark.createDataFrame([("raw/2020/8-K/a.txt", HEADER + doc(b"x\n")), ("raw/2020/8-K/b.txt", b"")], "relpath string, content binary"))
    assert {n: df.count() for n, df in t.items() if n in ("filings", "documents", "errors", "header_fields")} == {"filings": 1, "documents": 1, "errors": 1, "header_fields": 12}


def test_text_products(spark):
    body = b"\nintro\nItem 2.02 Results of Operations\n" + b"word " * 400 + b"\nItem 9.01 Exhibits\nshort\n"
    files = [(f"raw/{year}/8-K/{k}.txt", HEADER + doc(b"gone\n" + body)) for year in (2019, 2020) for k in range(3 if year == 2019 else 5)]
    files += [("raw/2021/8-K/x.txt", HEADER.replace(b"0000012345", b"0000099999") + doc(b"gone\n" + body))]
    out = pipeline.text_products(spark.createDataFrame(files, "relpath string, content binary"), spark.createDataFrame([("12345",)], "cik string"), at_least=2, cap=4)
    assert out["docs"].count() == 9 and out["sections"].select("section_name").distinct().count() == 1
    assert {(r.year, r["count"]) for r in out["balanced"].groupBy("year").count().collect()} == {("2019", 3), ("2020", 3)}
    assert out["chunks"].filter("is_balanced = 1").select("doc_id").distinct().count() == 6 and out["chunks"].select("doc_id").distinct().count() == 8


def test_fallbacks_and_publication(spark):
    docs = spark.createDataFrame([(1, "w " * 400), (2, "v " * 400), (3, None)], "doc_id long, text string")
    s = spark.createDataFrame([(1, "mda", 1, "w " * 400)], "doc_id long, section_name string, section_rank int, section_text string")
    assert sorted(rows(chunks_or_whole(docs, s).select("doc_id", "source_name").distinct())) == [(1, "mda"), (2, "full_document")]
    new = spark.createDataFrame([("a", "1", True), ("b", "1", False), ("c", "2", True)], "source_relpath string, source_sha256 string, delete_safe boolean")
    old = spark.createDataFrame([("b", "1"), ("c", "9")], "source_relpath string, source_sha256 string")
    out = {r.source_relpath: (r.action, r.status) for r in publication(new, old, delete_raw=True).collect()}
    assert out == {"a": ("publish", "processed_and_raw_deleted"), "b": ("refresh", "processed_with_warnings_raw_retained"), "c": ("conflict", "conflict")}


def test_nothing_imports_the_training_data_subpackage():
    root = Path(pipeline.__file__).parents[1]
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import) tessera\.llm", f.read_text(), re.M), f


def test_queries_and_sql_have_the_same_names():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and callable(e.entry) and len(e.queries()) > 40
    assert F is not None
