import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.operators import wide as wide_module
from tessera.operators.wide import to_wide, wide_cells

SPEC = [("filing", "ACCESSION NUMBER", "accession", "string"), ("filing", "FILED AS OF DATE", "filed", "date"), ("company_data", "CIK", "cik", "bigint"), ("company_data", "SIC", "sic", "code"), ("company_data", "EIN", "irs", "digits"), ("company_data", "IRS NUMBER", "irs", "digits")]
EAV = "filing_id string, section string, field_name string, field_value string, occurrence long"


@pytest.fixture(scope="module")
def spec(spark):
    return spark.createDataFrame(SPEC, "section string, field_name string, column_name string, data_type string")


def wide(spark, spec, data, **kw):
    return {r.filing_id: r.asDict() for r in to_wide(spark.createDataFrame(data, EAV), spec, **kw).collect()}


def test_names_types_and_the_lowest_fitting_occurrence(spark, spec):
    out = wide(
        spark, spec,
        [
            ("a", "FILING", "\tAccession-Number:", "  0001  x ", 0), ("a", "filing ", "filed_as_of_date", "soon", 0), ("a", "filing", "FILED AS OF DATE", "01/24/2014", 1), ("a", "Company Data", "cik", "12O4", 0), ("a", "company-data", "CIK", "20,151", 2),
            ("a", "company_data", "SIC", "FARM CROPS[0100]", 0), ("a", "company_data", "ein", "pending", 0), ("a", "company_data", "IRS NUMBER", "07-8249032", 1), ("a", "company_data", "IRS NUMBER", "111111111", None),
            ("b", "filing", "NOT ASKED", "x", 0), ("b", "filing", "ACCESSION NUMBER", "n/a", 0), (None, "filing", "ACCESSION NUMBER", "z", 0), ("c", None, None, None, None), ("c", "filing", "ACCESSION NUMBER", "y" * 200_000, 0),
        ],
    )
    assert sorted(out) == ["a", "b", "c"] and sorted(r["entity_ordinal"] for r in out.values()) == [0, 1, 2]
    a = out["a"]
    assert (a["accession"], str(a["filed"]), a["cik"], a["sic"], a["irs"]) == ("0001 x", "2014-01-24", 20151, "100", "078249032")
    assert all(out["b"][c] is None for c in ("accession", "filed", "cik", "sic", "irs"))
    assert out["c"]["accession"] == "y" * 200_000


def test_ordinals_have_no_gaps_over_many_ranges(spark, spec):
    data = spark.range(3000).select(F.concat(F.lit("f"), (F.col("id") % 1000).cast("string")).alias("filing_id"), F.lit("filing").alias("section"), F.lit("ACCESSION NUMBER").alias("field_name"), F.concat(F.lit("v"), (F.col("id") % 1000).cast("string")).alias("field_value"), F.lit(0).cast("long").alias("occurrence"))
    hot = spark.range(1500).select(F.lit("f1").alias("filing_id"), F.lit("filing").alias("section"), F.lit("ACCESSION NUMBER").alias("field_name"), F.lit("w").alias("field_value"), F.col("id") + 1)
    out = to_wide(data.union(hot), spec, ranges=17)
    got = out.select("entity_ordinal", "filing_id", "accession").collect()
    assert sorted(r[0] for r in got) == list(range(1000))
    assert sorted(map(tuple, got)) == sorted(map(tuple, to_wide(data.union(hot), spec, ranges=17).select("entity_ordinal", "filing_id", "accession").collect()))
    assert all(r[2] == "v" + r[1][1:] for r in got)


def test_ranges_that_share_a_task_and_follow_the_size(spark, spec, monkeypatch, tmp_path):
    data = spark.range(5000).select(F.concat(F.lit("f"), (F.col("id") % 900).cast("string")).alias("filing_id"), F.lit("filing").alias("section"), F.lit("ACCESSION NUMBER").alias("field_name"), F.col("id").cast("string").alias("field_value"), F.col("id").alias("occurrence"))
    data.write.parquet(f"{tmp_path}/eav")
    eav = spark.read.parquet(f"{tmp_path}/eav")
    monkeypatch.setattr(wide_module, "MAX_TASKS", 3)
    monkeypatch.setattr(wide_module, "BROADCAST_RANGES", 4)
    monkeypatch.setattr(wide_module, "RANGE_BYTES", 1 << 10)
    got = to_wide(eav, spec).select("entity_ordinal", "filing_id", "accession").collect()
    assert sorted(r[0] for r in got) == list(range(900)) and all(r[1] == f"f{r[2]}" for r in got)


def test_cells_empty_tables_and_clashing_columns(spark, spec):
    df = spark.createDataFrame([("a", "filing", "ACCESSION NUMBER", "1", 0)], EAV).withColumn("slot", F.lit(5)).withColumn("entity", F.lit("q")).withColumn("cell", F.lit("z"))
    assert rows(wide_cells(to_wide(df, spec), ["accession", "cik"])) == [("a", "accession", "1")]
    empty = to_wide(df.filter("false"), spec)
    assert empty.count() == 0 and empty.columns == ["entity_ordinal", "filing_id", "accession", "cik", "filed", "irs", "sic"]
    with pytest.raises(ValueError):
        to_wide(df, spec.withColumn("column_name", F.lit("filing_id")))
